"""Periodic runs against brute force, and the registered query against a plain version."""

import hashlib
import random
import zlib

import pytest

from millrace.llm import queries, runs

from rows_for_tests import ODD, table


def plain(words):
    """Runs by extending every period from every place."""
    found = set()
    for period in range(1, len(words) // 2 + 1):
        i = 0
        while i + period < len(words):
            j = i
            while j + period < len(words) and words[j] == words[j + period]:
                j += 1
            length = j - i + period
            if length >= max(12, 2 * period):
                part = words[i:i + length]
                if not any(all(part[x] == part[x + d] for x in range(length - d)) for d in range(1, period)):
                    found.add((i, length, period))
            i = max(j, i + 1)
    return sorted(found)


def test_runs_of_random_words_are_those_of_brute_force():
    rng = random.Random(3)
    for _ in range(1500):
        documents = []
        for _ in range(rng.randrange(1, 5)):
            n, letters = rng.randrange(0, 70), rng.choice([1, 2, 2, 3, 5])
            words = [b"%d" % rng.randrange(letters) for _ in range(n)]
            if n and rng.random() < 0.5:
                first = rng.randrange(n)
                period = 1 + (n - first) // rng.randrange(3, 8)
                words = [words[i] if i < first else words[first + (i - first) % period] for i in range(n)]
            documents.append(words)
        assert runs.runs_of(documents) == [plain(d) for d in documents]


def test_long_repetitions_are_fast():
    assert runs.runs_of([[b"a"] * 200_000]) == [[(0, 200_000, 1)]]
    unit = [b"%d" % (i * 7919 % 3001) for i in range(1000)]
    assert runs.runs_of([unit * 200, [], [b"x"] * 12, unit * 2]) == [[(0, 200_000, 1000)], [], [(0, 12, 1)], [(0, 2000, 1000)]]


def expected(doc_id, text):
    words = [w for w in "".join(" " if c in "\t\n\v\f\r" else c for c in text or "").split(" ") if w]
    n, h = len(words), None if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h is not None and h % 10 == 0 and n:
        a, p = h // 10 % n, 1 + (n - h // 10 % n) // (3 + h // 10 % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = plain(words)
    best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=None)
    gone = {i for s, length, p in found for i in range(s + p, s + length)}
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    return (doc_id, len(found), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
            hashlib.sha256("".join("%d,%d,%d\n" % r for r in found).encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest())


def in_order(rows):
    return sorted(rows, key=lambda r: [str(v) for v in r])


@pytest.fixture(scope="module")
def repeats(spark):
    rng, texts = random.Random(5), []
    for i in range(300):
        words = ["".join(rng.choices("abé", k=rng.randrange(1, 3))) for _ in range(rng.randrange(0, 120))]
        if i % 3 == 0:
            words += ["spam", "and", "eggs"][:rng.randrange(1, 4)] * rng.randrange(1, 12)
        texts.append(rng.choice([" ", "\n", " \t"]).join(words))
    return texts, table(spark, texts)


def test_registered_query_on_repeats_and_planted_rows(spark, repeats, monkeypatch):
    texts, df = repeats
    monkeypatch.setattr(queries, "_documents", lambda *_: df)
    got = [tuple(r) for r in queries.op13_runs(spark, "").collect()]
    assert in_order(got) == in_order([expected(i, t) for i, t in enumerate(texts)])
    assert sum(r[1] for r in got) > 50


def test_registered_query_on_odd_rows(spark, odd, none, monkeypatch):
    short = [(i, t) for i, t, _ in ODD if len(t or "") < 100_000]
    monkeypatch.setattr(queries, "_documents", lambda *_: odd.where("coalesce(length(text), 0) < 100000"))
    assert in_order([tuple(r) for r in queries.op13_runs(spark, "").collect()]) == in_order([expected(i, t) for i, t in short])
    monkeypatch.setattr(queries, "_documents", lambda *_: none)
    assert queries.op13_runs(spark, "").count() == 0
    assert runs.collapsed(odd.where("length(text) > 100000")).select("n_words").first()[0] == 30_003
