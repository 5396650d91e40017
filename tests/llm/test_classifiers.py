"""Classifiers, secret scans, fingerprints and mixing."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import common, mix, quality, queries, secrets, sketch, toxicity

from rows_for_tests import ODD, rows_of, SCHEMA, table


def test_trees_separate_and_walk_like_a_loop():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(600, 5))
    y = ((x[:, 0] > 0.3) ^ (x[:, 3] > 0)).astype(float)
    model = quality.grow(x, y)
    score = quality.walk(model, x)
    assert ((score > 0.5) == (y > 0)).mean() > 0.97
    for row, value in zip(x[:20], score):
        total = model.start
        for t in range(len(model.leaf)):
            node = 0
            while node < model.statistic.shape[1]:
                node = 2 * node + 1 + int(row[model.statistic[t, node]] > model.border[t, node])
            total += model.leaf[t, node - model.statistic.shape[1]]
        assert abs(1 / (1 + np.exp(-total)) - value) < 1e-12
    assert np.allclose(quality.walk(quality.grow(x, np.ones(600)), x), 600.5 / 601)


@pytest.fixture(scope="module")
def corpus(spark):
    """Good prose, shouting, toxic texts; labels by kind."""
    rng, texts, good, toxic = random.Random(9), [], [], []
    for i in range(400):
        words = ["".join(rng.choices(["ta", "ri", "mo", "ne", "su", "lo"], k=rng.randrange(1, 4))) for _ in range(rng.randrange(20, 90))]
        is_good, is_toxic = i % 4 != 0, i % 5 == 0
        if is_toxic:
            for _ in range(3):
                words.insert(rng.randrange(len(words)), rng.choice(["vilex", "grumpo", "nastify", "nastifies"]))
        text = ". ".join(" ".join(words[k:k + 9]) for k in range(0, len(words), 9))
        texts.append(text if is_good else text.upper().replace(" ", "!! "))
        good.append(int(is_good))
        toxic.append(int(is_toxic))
    rows = [(i, good[i], toxic[i]) for i in range(400)]
    return texts, table(spark, texts), spark.createDataFrame(rows, "doc_id bigint, quality int, toxic int")


def outside(i):
    return zlib.crc32(str(i).encode()) % 4 == 2


def test_held_out_rows_are_never_sampled(corpus):
    _, docs, labels = corpus
    assert {r["doc_id"] for r in quality.labelled_sample(labels, "quality").collect()} == {i for i in range(400) if not outside(i)}
    assert {r["doc_id"]: r["h"] for r in docs.select("doc_id", common.held_out().alias("h")).collect()} == {i: outside(i) for i in range(400)}
    assert 20 < quality.labelled_sample(labels, "quality", rows=60).count() < 100


def test_quality_of_held_out_rows(corpus):
    _, docs, labels = corpus
    got = {r["doc_id"]: r["score"] for r in quality.scored(docs, labels).collect()}
    assert all((got[i] >= 0.7) == (i % 4 != 0) for i in range(400) if outside(i))
    assert all(0 <= s <= 1 for s in got.values())
    left = quality.accepted(docs, labels, 0.7)
    assert left.columns == docs.columns
    assert {r["doc_id"] for r in left.collect()} == {i for i, s in got.items() if s >= 0.7}


def test_quality_of_odd_rows(odd, none, labels):
    assert Counter(r["doc_id"] for r in quality.scored(odd, labels).collect()) == Counter(i for i, _, _ in ODD)
    assert quality.scored(none, labels).count() == 0 == quality.accepted(none, labels).count()
    assert {r["score"] for r in quality.scored(odd, labels.limit(0)).collect()} == {0.5}


def test_marginals_by_enumeration():
    rng = np.random.default_rng(3)
    emission, first, move = [rng.normal(size=n) for n in (1, 4, 2, 6)], rng.normal(size=2), rng.normal(size=(2, 2))
    got, steps = toxicity.forward_backward(emission, first, move)
    want_steps = np.zeros((2, 2))
    for e, g in zip(emission, got):
        total, want, pairs = 0.0, np.zeros(len(e)), np.zeros((2, 2))
        for tags in itertools.product((0, 1), repeat=len(e)):
            w = np.exp(first[tags[0]] + sum(e[i] * t for i, t in enumerate(tags)) + sum(move[a, b] for a, b in zip(tags, tags[1:])))
            total, want = total + w, want + w * np.array(tags)
            for a, b in zip(tags, tags[1:]):
                pairs[a, b] += w
        want_steps += pairs / total
        assert np.allclose(want / total, g)
    assert np.allclose(steps, want_steps)


def test_toxic_spans_and_scores(corpus):
    texts, docs, labels = corpus
    got = {r["doc_id"]: r for r in toxicity.tagged(docs, labels).collect()}
    for i in filter(outside, range(400)):
        assert (got[i]["score"] >= 0.3) == (i % 5 == 0)
        found = [texts[i][s["start"]:s["end"]].lower() for s in got[i]["spans"]]
        said = [m.group().lower() for m in re.finditer("(?i)vilex|grumpo|nastif[a-z]+", texts[i])]
        assert sorted(w for f in found for w in re.findall(r"\w+", f)) == sorted(said)


def test_the_field_learns_from_late_sentences():
    """The evidence of the last documents counts though many sentences come before it; equal sentences count as often as they are."""
    rng = random.Random(3)

    def text(word, lines):
        return ". ".join(f"{word} {rng.choice('abcde')} {rng.choice('fghij')}" for _ in range(lines))

    texts = [text("vilex", 60) for _ in range(100)] + [text("plain", 60) for _ in range(100)] + [text("grumpo", 3) for _ in range(20)]
    toxic = [True] * 100 + [False] * 100 + [True] * 20
    model = toxicity.fit(texts, toxic)
    assert model.weight[model.evidence["vilex"]] > 1 and model.weight[model.evidence["grumpo"]] > 1
    (score, spans), = toxicity.tag([texts[-1]], model, toxicity.Evidence(model.evidence))
    assert score > 0.5 and [(a, b) for a, b, _ in spans] == [(m.start(), m.end()) for m in re.finditer("grumpo", texts[-1])]


def test_a_sentence_counted_twice_is_two_sentences():
    sequences = [[(0,), (), (1,)], [(), (), ()], [(1,), (0,)]]
    tags = [np.array([1.0, 0, 0]), np.zeros(3), np.array([0.0, 1])]
    once = toxicity.fit_field([sequences[0], *sequences], [tags[0], *tags], 2)
    counted = toxicity.fit_field(sequences, tags, 2, [2, 1, 1])
    assert all(np.allclose(a, b) for a, b in zip(once, counted))


def test_toxicity_of_odd_rows(odd, none, labels):
    got = toxicity.tagged(odd, labels).collect()
    assert Counter(r["doc_id"] for r in got) == Counter(i for i, _, _ in ODD) and all(0 <= r["score"] <= 1 for r in got)
    assert toxicity.tagged(none, labels).count() == 0
    assert {r["score"] for r in toxicity.tagged(odd, labels.limit(0)).collect()} == {0.5}


def plain_spans(text):
    assign = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    found = [(m.start(), 0, m.end()) for m in re.finditer(assign, text, re.I | re.A) if len(m.group(2)) >= 8]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m.group()) >= 16]
    return sorted(found + [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m.group()) >= 32])


def test_secrets(spark, odd, none):
    rng = random.Random(6)
    parts = ["password", "PassWd", " = ", ":", "'", '"', "abcdefgh", "AKIA", "AKIA1234567890ABCD", "0123456789abcdef" * 2, "f", " ", "tOKEN",
             "api_key", "apikey", "K", "ſecret", "ü", "-._=+/", "\n"]
    texts = ["".join(rng.choices(parts, k=rng.randrange(0, 14))) for _ in range(400)]
    plain = ["ordinary words and identifiers like transactionProcessorFactory or internationalization_settings"] * 40
    drawn = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", k=40)) for _ in range(10)]
    plain += [f"see {d} there, password=Ab3dEf6h{k}" for k, d in enumerate(drawn)]
    names = ("assign", "access", "hex", "markov")
    for docs, rows in ((table(spark, texts), list(enumerate(texts))), (odd, [(i, t) for i, t, _ in ODD])):
        got = secrets.scanned(docs).collect()
        base = [(r["doc_id"], [(s["start"], s["kind"], s["end"]) for s in r["base"]]) for r in got]
        assert sorted(map(str, base)) == sorted(str((i, plain_spans(t or ""))) for i, t in rows)
    marked = secrets.scanned(table(spark, plain)).select("*", secrets.written(F.concat("base", "added")).alias("w"))
    got = {r["doc_id"]: r for r in marked.collect()}
    assert all(not got[i]["added"] for i in range(40))
    for k in range(40, 50):
        assert [(s["start"], s["end"]) for s in got[k]["added"]] == [(4, 44)]
        both = sorted([(s["start"], s["kind"], s["end"]) for s in got[k]["base"] + got[k]["added"]])
        assert len(both) == 2 and got[k]["w"] == ",".join(f"{names[n]}:{a}:{b}" for a, n, b in both)
    assert secrets.scanned(none).count() == 0


def test_fingerprints(spark, odd, none, monkeypatch):
    monkeypatch.setattr(sketch, "ROWS_PER_SLICE", 4)
    rows = sorted((i is None, i if i is not None else 0, t or "", i) for i, t, _ in ODD)
    want = []
    for k, (_, _, text, i) in enumerate(rows):
        following = rows[(k + 1) % len(rows)][2]
        half = len(text) // 2
        edited = text[:len(text) - half] + following[:half]
        a, b = sketch.hashes(text), sketch.hashes(edited)
        want.append((i, len(text), hashlib.sha256(edited.encode()).hexdigest(), sketch.written(a), sketch.written(b),
                     sketch.likeness(a, b), sketch.likeness(a, sketch.hashes(following))))
    assert sorted(map(str, want)) == sorted(str(tuple(r)) for r in sketch.fingerprints(odd).collect())
    assert sketch.fingerprints(none).count() == 0
    one = sketch.fingerprints(odd.where("doc_id = 5")).collect()
    assert len(one) == 1 and one[0]["near_next"] == 1.0


def test_sketches_estimate_containment_and_merge():
    rng = random.Random(12)
    long = "".join(rng.choices("abcdefghij ", k=60_000))
    part, other = long[10_000:14_000], "".join(rng.choices("klmnopqrst ", k=5_000))
    a, b, c = map(sketch.hashes, (long, part, other))
    assert sketch.likeness(a, b) > 0.95 and sketch.likeness(a, c) < 0.05
    half = sketch.hashes(part[:2_000] + other[:2_000])
    assert abs(sketch.likeness(b, half) - 0.5) < 0.15
    whole = np.union1d(a, c)
    assert np.array_equal(sketch.merged(a, c), whole)
    tiny = sketch.hashes("abc def ghi jkl")
    assert len(tiny) == 1 and sketch.likeness(tiny, sketch.hashes("abc def ghi jkl")) == 1.0


def test_mix(spark, odd, none):
    rng = random.Random(2)
    sources = ["a", "b", "c", "d", "e", None]
    texts = [(i, "w " * rng.randrange(0, 60), rng.choices(sources, [30, 9, 5, 3, 2, 1])[0]) for i in range(3_000)]
    for docs, rows in ((spark.createDataFrame(rows_of(texts), SCHEMA), texts), (odd, ODD), (none, [])):
        by = mix.targets(docs).collect()
        sizes = Counter()
        for _, t, s in rows:
            sizes[s] += len((t or "").encode().split())
        assert {r["source"]: r["source_size"] for r in by} == sizes
        total = sum(sizes.values())
        assert sum(r["target"] for r in by) == pytest.approx(1.5 * total) and all(r["target"] <= 2 * r["source_size"] + 1e-6 for r in by)
        order = sorted(by, key=lambda r: (r["source"] is None, r["source"] or ""))
        free = {r["target"] / (5, 2, 1)[k % 3] for k, r in enumerate(order) if r["target"] < 2 * r["source_size"] - 1e-6}
        assert max(free, default=0) == pytest.approx(min(free, default=0))
        con = duckdb.connect()
        documents = docs.select("doc_id", "text", "source").toPandas()  # noqa: F841
        con.execute("CREATE TABLE documents AS SELECT doc_id::BIGINT AS doc_id, text::VARCHAR AS text, source::VARCHAR AS source FROM documents")
        size = mix.words_in("row.text")
        got = mix.mixed(docs).select("row.doc_id", size, "source_size", "target", F.col("copies") * size).collect()
        want = con.execute(queries.OP7_SQL).fetchall()
        plain = lambda row: tuple(None if v is None or v != v else float(v) for v in row)
        assert sorted(map(str, map(plain, got))) == sorted(map(str, map(plain, want)))
    taken = mix.mix(spark.createDataFrame(rows_of(texts), SCHEMA))
    assert taken.columns == odd.columns
    words = {r["source"]: r["n"] for r in taken.groupBy("source").agg(F.sum(mix.words_in()).alias("n")).collect()}
    goal = {r["source"]: r["target"] for r in mix.targets(spark.createDataFrame(rows_of(texts), SCHEMA)).collect()}
    assert abs(words["a"] / goal["a"] - 1) < 0.1
