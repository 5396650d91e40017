"""Packing: cuts against the cheapest of all, ids against the library, and the registered query against the texts."""

import random
import zlib
from collections import defaultdict
from functools import cache

import numpy as np
import pytest

from millrace.llm import packing, queries

from rows_for_tests import ODD, table

public_tokenizers = pytest.importorskip("public_tokenizers")


def least_cost(ends, soft, costs):
    """The cheapest windows when every position may be cut, by trying all of them."""
    total, ends, soft = ends[-1], set(ends), set(soft)

    @cache
    def upto(x):
        if x == 0:
            return 0
        here = costs.window + (0 if x in ends else costs.sentence if x in soft else costs.inside)
        return here + min(upto(y) + costs.length - x + y for y in range(max(0, x - costs.length), x))

    return upto(total)


def price(windows, ends, soft, costs):
    value, y = 0, 0
    for x in windows:
        assert 0 < x - y <= costs.length
        value += costs.window + (0 if x in ends else costs.sentence if x in soft else costs.inside)
        value += 0 if x - y in costs.free else costs.length - x + y
        y = x
    return value


def test_windows_are_the_cheapest_ones():
    rng, cheaper = random.Random(2), 0
    for _ in range(300):
        costs = packing.Costs(32, window=rng.choice([0, 2]), sentence=rng.choice([1, 4]), inside=rng.choice([5, 9, 40]), free=())
        borders = sorted(rng.sample(range(1, 240), rng.randrange(1, 40)))
        ends = sorted({*rng.sample(borders, rng.randrange(1, len(borders) + 1)), borders[-1]})
        soft = sorted(set(borders) - set(ends))
        windows = packing.cuts(np.array(ends), np.array(soft, int), costs)
        assert windows[-1] == ends[-1] and windows == sorted(set(windows))
        best = least_cost(tuple(ends), tuple(soft), costs)
        assert price(windows, set(ends), set(soft), costs) == best
        costs = costs._replace(free=(16, 8, 4))
        found = price(packing.cuts(np.array(ends), np.array(soft, int), costs), set(ends), set(soft), costs)
        assert found <= best
        cheaper += found < best
    assert cheaper > 50


def test_ids_are_those_of_the_library():
    from tokenizers import Tokenizer

    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as file:
        definition = file.read()
    encoder, library = packing.Encoder(definition, public_tokenizers.PATTERN), Tokenizer.from_str(definition)
    rng = random.Random(4)
    texts = ["", " ", "  a", "a  b ", "a \n b", "x<|endoftext|> y <|endoftext|>", "a\x1c b \x1fc", "don't 's  it's", " \u0085x",
             "=" * 5000, " " * 1_500_000, *("".join(rng.choices(" \n\tab'sé　 😀1_", k=40)) for _ in range(500))]
    for text in texts:
        assert encoder.encode(text).tolist() == library.encode(text, add_special_tokens=False).ids
    with pytest.raises(ValueError):
        packing.byte_ranks(definition.replace('"add_prefix_space":false', '"add_prefix_space":true').replace(
            '"add_prefix_space": false', '"add_prefix_space": true'))


def follows_contract(rows, texts):
    """Checks the pieces of documents given as (id, text); returns the share of padding."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    wanted = defaultdict(list)
    for doc, text in texts:
        wanted[doc].append(np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [0], "<u4"))
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    assert set(pieces) == set(wanted)
    for doc, ids in wanted.items():
        found = sorted((r.doc_tokens, r.start, r.length, r.ids_crc32) for r in pieces[doc])
        assert sum(f[2] for f in found) == sum(map(len, ids))
        if len(ids) == 1:
            place = 0
            for tokens, start, length, crc in found:
                assert (tokens, start) == (len(ids[0]), place) and length > 0
                assert crc == zlib.crc32(ids[0][start:start + length].tobytes())
                place += length
    padding = 0
    for members in sequences.values():
        place = 0
        for r in sorted(members, key=lambda r: r.offset):
            assert r.offset == place
            place += r.length
        assert place <= 1024
        padding += 0 if place & (place - 1) == 0 else 1024 - place
    return padding / sum(r.length for r in rows)


def test_registered_query_follows_the_contract(spark, odd, none, monkeypatch):
    monkeypatch.setattr(queries, "_documents", lambda *_: odd)
    follows_contract(queries.op11_packing(spark, "").collect(), [(i, t) for i, t, _ in ODD])
    monkeypatch.setattr(queries, "_documents", lambda *_: none)
    assert queries.op11_packing(spark, "").count() == 0
    rng = random.Random(8)
    texts = [" ".join(rng.choice(["Tea.", "coffee", "is", "hot!", "cold\n"]) for _ in range(rng.randrange(0, 900))) for _ in range(200)]
    docs = table(spark, texts)
    monkeypatch.setattr(queries, "_documents", lambda *_: docs)
    rows = queries.op11_packing(spark, "").collect()
    assert follows_contract(rows, list(enumerate(texts))) < 0.02
    # Documents keep their order.
    first = {r.doc_id: (r.sequence_id, r.offset) for r in rows if r.start == 0}
    assert [first[i] for i in range(200)] == sorted(first.values())


def test_slices_and_blocks(spark, monkeypatch):
    texts = [f"Document {i}. " * (i % 50) for i in range(300)]
    docs = table(spark, texts)
    path = public_tokenizers.path("byte_bpe_50k.json")
    pieces = packing.packed(docs, path, public_tokenizers.PATTERN, rows_per_slice=40).collect()
    assert len({r.sequence_id >> 32 for r in pieces}) > 4
    assert sum(r.length for r in pieces) == sum({r.doc_id: r.doc_tokens for r in pieces}.values())
    assert all(len(r.ids) == 4 * r.length for r in pieces)
