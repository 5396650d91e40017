"""Tokenizers against their libraries."""

import hashlib
import random

import public_tokenizers
import pytest
import sentencepiece
import tiktoken
from hypothesis import given, settings, strategies as st

from millrace.llm import bpe, token_count

from rows_for_tests import ODD

ALPHABETS = ["a b  the   ing\n\t▁<s></s><unk><0x0A>日本é😀\x00,.!&&$ 12 ", "etaoin shrdlu", " a▁b", "the ing er on", "aab"]


@pytest.fixture(scope="module")
def codec():
    return bpe.Codec(bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")))


@pytest.fixture(scope="module")
def counter():
    return token_count.Counter(token_count.Transducer(token_count.read_pieces(public_tokenizers.path("piece_bpe_32k.model"))))


@pytest.fixture(scope="module")
def library(codec):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=codec.ranks, special_tokens={})


@pytest.fixture(scope="module")
def pieces():
    return sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


def test_every_token_encodes_to_itself(codec):
    assert all(codec.merged(token) == (rank,) for token, rank in codec.ranks.items())


@settings(max_examples=200, deadline=None)
@given(st.text(st.sampled_from("etaoinshrd lu"), max_size=60), st.integers(0, 60))
def test_join_is_the_encoding_of_the_whole(codec, text, cut):
    raw = text.encode()
    assert codec.join(codec.merged(raw[:cut]), codec.merged(raw[cut:])) == codec.merged(raw) == codec.encode(raw) if raw else True
    assert codec.decode(codec.encode(raw)) == raw


def test_long_piece(codec, library):
    rng = random.Random(3)
    word = "".join(rng.choices("etaoinshr", k=20_000))
    assert list(codec.encode(word.encode())) == library.encode_ordinary(word)


def test_bpe_rows(codec, library, odd, none):
    got = bpe.encoded(odd, codec.ranks, public_tokenizers.PATTERN).collect()
    want = []
    for i, text, _ in ODD:
        ids = library.encode_ordinary(text or "")
        want.append((i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256((text or "").encode()).hexdigest(), ids))
    assert sorted(map(str, want)) == sorted(str(tuple(r)) for r in got)
    assert bpe.encoded(none, codec.ranks, public_tokenizers.PATTERN).count() == 0


def test_portions_of_long_texts(codec, library, monkeypatch):
    monkeypatch.setattr(bpe, "LONG", 10)
    monkeypatch.setattr(bpe, "PORTION", 3)
    text = "some words, 12 numbers  and   spaces\n"
    assert bpe.start(codec.ranks, public_tokenizers.PATTERN, True)([1], [text])["ids"] == [library.encode_ordinary(text)]


def test_counts_like_the_library(counter, pieces):
    rng = random.Random(1)
    for _ in range(3000):
        text = "".join(rng.choices(rng.choice(ALPHABETS), k=rng.randint(0, 60)))
        assert counter.tokens(text) == counter.tokens(text, chunk=rng.randint(1, 9)) == len(pieces.encode(text)), repr(text)


def test_chunk_maps_compose_in_any_grouping(counter):
    rng = random.Random(2)
    for _ in range(300):
        text = "▁" + "".join(rng.choices("ab ▁the", k=40)).replace(" ", "▁")
        maps = [counter.chunk_map(text[i:i + 5]) for i in range(0, len(text), 5)]
        left = maps[0]
        for m in maps[1:]:
            left = counter.compose(left, m)
        right = maps[-1]
        for m in reversed(maps[:-1]):
            right = counter.compose(m, right)
        totals = [counter.total(m) for m in counter.scan(maps)]
        assert counter.total(left) == counter.total(right) == totals[-1]
        assert totals == [counter.total(counter.chunk_map(text[:5 * k + 5])) for k in range(len(maps))]


def test_count_rows(counter, pieces, odd, none):
    vocabulary = counter.transducer.pieces
    got = token_count.counted(odd, vocabulary, limit=100).collect()
    want = [(i, len((t or "").encode()), len(pieces.encode(t or "")), len(pieces.encode(t or "")) > 100) for i, t, _ in ODD]
    assert sorted(map(str, want)) == sorted(str(tuple(r)) for r in got)
    assert token_count.counted(none, vocabulary).count() == 0
