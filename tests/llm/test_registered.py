"""Registered queries against plain versions of their contract, on odd rows."""

import hashlib
import random
import re
import string
import time
import zlib

import pytest

from millrace.llm import bpe, queries, secrets

from rows_for_tests import ODD, table


def plain_secrets(text):
    """Base spans as the contract words them, kinds in its order."""
    spans = []
    for kind, pattern, least in (
            (0, r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 8),
            (1, r"AKIA[A-Z0-9]+", 16), (2, r"[0-9a-f]+", 32)):
        for m in re.finditer(pattern, text, re.I | re.A if kind == 0 else 0):
            if len(m.group(2) if kind == 0 else m.group()) >= least:
                spans.append((m.start(), kind, m.end()))
    return sorted(spans)


def test_secret_counts_and_spans(spark, monkeypatch):
    extra = [(100 + i, t, "a") for i, t in enumerate((
        "password=" + "a1" * 20, "x " + "deadbeef" * 5 + " api_key: 'abcdefgh' AKIA" + "A1" * 8, "TOKEN=\"" + "0123456789abcdef" * 2 + "\"",
        "secret = short", "AKIAAKIA" + "Z" * 12 + " é passwd:'" + "f" * 40 + "'"))]
    plain = [(i, t) for i, t, _ in ODD] + [(i, t) for i, t, _ in extra]
    docs = spark.createDataFrame(plain, "doc_id bigint, text string").repartition(3)
    monkeypatch.setattr(queries, "_documents", lambda *_: docs)
    got = sorted((str(r.doc_id), r.n_assign, r.n_access, r.n_hex, r.base_sha256) for r in queries.op4_secrets(spark, "").collect())
    expected = []
    for doc, text in plain:
        spans = plain_secrets(text or "")
        written = ",".join(f"{secrets.KINDS[k]}:{s}:{e}" for s, k, e in spans)
        expected.append((str(doc), *(sum(k == kind for _, k, _ in spans) for kind in range(3)), hashlib.sha256(written.encode()).hexdigest()))
    assert got == sorted(expected)
    assert sum(e[1] + e[2] + e[3] for e in expected) >= 8


def test_planted_random_strings_are_found(spark):
    """Random strings no base pattern knows, in a corpus of words and identifiers: at least nine in ten are added, few words are."""
    rng = random.Random(11)
    syllables = ["ta", "ri", "mo", "ne", "su", "lo", "con", "der", "ing", "ver"]
    texts, planted = [], []
    for i in range(400):
        words = ["".join(rng.choices(syllables, k=rng.randrange(1, 5))) for _ in range(60)]
        words += ["_".join(rng.choices(words, k=4)), "".join(w.capitalize() for w in rng.choices(words, k=4))]
        if i % 5 == 0:
            secret = "".join(rng.choices(string.ascii_letters + string.digits, k=rng.randrange(24, 40)))
            planted.append((i, secret))
            words.insert(rng.randrange(len(words)), secret)
        if i % 9 == 0:
            words.append("password=" + "".join(rng.choices(string.ascii_letters + string.digits, k=20)))
        texts.append(" ".join(words))
    found = {r.doc_id: {texts[r.doc_id][s.start:s.end] for s in r.added} for r in secrets.scanned(table(spark, texts)).collect()}
    assert sum(secret in found[i] for i, secret in planted) >= 0.9 * len(planted)
    assert sum(len(v) for v in found.values()) <= 1.1 * len(planted)


def test_long_runs_of_one_character_are_encoded_in_time(spark):
    public_tokenizers = pytest.importorskip("public_tokenizers")
    tiktoken = pytest.importorskip("tiktoken")
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rows = bpe.start(ranks, public_tokenizers.PATTERN, True)
    texts = [c * (200_000 // len(c)) for c in ("=", "-", "_", "a", "=-", "ab1 ")] + ["".join(random.Random(2).choices("ab=-é", k=50_000))]
    began = time.time()
    out = rows(list(range(len(texts))), texts)
    assert time.time() - began < 20
    assert out["ids"] == [library.encode_ordinary(t) for t in texts]
    assert out["decoded_sha256"] == [hashlib.sha256(t.encode()).hexdigest() for t in texts]


def test_borders_are_stable_exactly_if_the_merges_say_so():
    public_tokenizers = pytest.importorskip("public_tokenizers")
    codec = bpe.Codec(bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")))
    rng = random.Random(3)
    for _ in range(4000):
        left, right = rng.randrange(50_000), rng.randrange(50_000)
        whole = codec.bytes_of[left] + codec.bytes_of[right]
        assert codec.stable(left, right) == (codec.merged(whole) == (left, right))
        assert codec._merged_by_heap(whole, bpe.NEVER) == codec.merged(whole)


def test_planted_repetition_follows_the_contract():
    words = [b"%d" % i for i in range(50)]
    for doc in range(400):
        h = zlib.crc32(str(doc).encode())
        got = queries.planted(doc, words)
        if h % 10:
            assert got == words
        else:
            a = h // 10 % 50
            p = 1 + (50 - a) // (3 + h // 10 % 8)
            assert got == [words[i] if i < a else words[a + (i - a) % p] for i in range(50)]
    assert queries.planted(None, words) == words and queries.planted(7, []) == []
