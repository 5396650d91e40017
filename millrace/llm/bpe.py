"""Byte-level BPE by monoid tree reduction.

A piece is encoded by encoding its halves and joining the two token lists. A join re-encodes a window around the border that
grows until the tokens next to it stay as they are: a token list is the encoding of its bytes exactly if every two neighbours
are the encoding of theirs, so a window whose outer neighbours pass that test settles the whole list. Joining is associative,
so any split gives the same tokens. Decoding concatenates token bytes up the same tree.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Callable, Iterator
from heapq import heapify, heappop, heappush
from itertools import chain, islice

from pyspark.sql import DataFrame

from millrace.llm.common import map_texts

REMEMBERED = 400_000  # pieces and halves a task remembers before it starts afresh
LONG = 1_000_000  # texts of more characters are split into pieces in portions
PORTION = 200_000
SHORT = 48  # bytes up to which pairs are looked through, instead of kept in a heap
NEVER = 1 << 60


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: base64 of the token's bytes and its rank on each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class Codec:
    """Encoder and decoder for one vocabulary; every single byte must have a rank."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self._halves: dict[bytes, tuple[int, ...]] = {}
        self._stable: dict[tuple[int, int], bool] = {}
        self._pairs: dict[tuple[int, int], tuple[int, ...]] = {}
        self._split: dict[int, tuple[int, int] | None] = {}

    def merged(self, piece: bytes, below: int = NEVER) -> tuple[int, ...]:
        """The definition: merge the adjacent pair of lowest rank (under `below`), leftmost first, until none is left."""
        if len(piece) > SHORT:
            return self._merged_by_heap(piece, below)
        parts, rank = [piece[i:i + 1] for i in range(len(piece))], self.ranks.get
        order = [rank(a + b, NEVER) for a, b in zip(parts, parts[1:])]
        while order and (best := min(order)) < below:
            at = order.index(best)
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
            del order[at]
            if at:
                order[at - 1] = rank(parts[at - 1] + parts[at], NEVER)
            if at < len(order):
                order[at] = rank(parts[at] + parts[at + 1], NEVER)
        return tuple([self.ranks[p] for p in parts])

    def _merged_by_heap(self, piece: bytes, below: int) -> tuple[int, ...]:
        """The same over linked parts: a part is known by its start, `ends` has its end, `starts` the start of the one that ends there."""
        rank, n = self.ranks.get, len(piece)
        ends, starts = list(range(1, n + 1)), [0, *range(n)]
        heap = [(r, i, i + 1, i + 2) for i in range(n - 1) if (r := rank(piece[i:i + 2], NEVER)) < below]
        heapify(heap)
        while heap:
            _, i, middle, end = heappop(heap)
            if ends[i] != middle or middle >= n or ends[middle] != end:
                continue  # one of the two has been merged with another part
            ends[i], starts[end], ends[middle] = end, i, -1
            if end < n and (r := rank(piece[i:ends[end]], NEVER)) < below:
                heappush(heap, (r, i, end, ends[end]))
            if i and (r := rank(piece[starts[i]:end], NEVER)) < below:
                heappush(heap, (r, starts[i], i, end))
        out, i = [], 0
        while i < n:
            out.append(self.ranks[piece[i:ends[i]]])
            i = ends[i]
        return tuple(out)

    def pair(self, left: int, right: int) -> tuple[int, ...]:
        """The encoding of the bytes of two tokens side by side."""
        known = self._pairs.get((left, right))
        if known is None:
            if len(self._pairs) > REMEMBERED:
                self._pairs.clear()
            known = self._pairs[left, right] = self.merged(self.bytes_of[left] + self.bytes_of[right])
        return known

    def split(self, token: int) -> tuple[int, int] | None:
        """The two tokens whose merge makes this one; None for a single byte."""
        if token not in self._split:
            piece = self.bytes_of[token]
            self._split[token] = self.merged(piece, token) if len(piece) > 1 else None
        return self._split[token]

    def stable(self, left: int, right: int) -> bool:
        """Whether the encoding of the bytes of two tokens side by side is those two.

        The merges that made both are undone, the later one first. Whenever what then touches at the border could be merged at a
        rank below the merge just undone, that merge would have come first.
        """
        known = self._stable.get((left, right))
        if known is None:
            if len(self._stable) > REMEMBERED:
                self._stable.clear()
            known = self._stable[left, right] = self._holds(left, right)
        return known

    def _holds(self, left: int, right: int) -> bool:
        limit: float = NEVER
        while True:
            if self.ranks.get(self.bytes_of[left] + self.bytes_of[right], NEVER) < limit:
                return False
            a, b = self.split(left), self.split(right)
            if a is None and b is None:
                return True
            # Of equal ranks the left one is merged first, so it is undone last.
            if b is None or (a is not None and left > right):
                left, limit = a[-1], left
            else:
                right, limit = b[0], right + 1

    def join(self, left: tuple[int, ...], right: tuple[int, ...]) -> tuple[int, ...]:
        """The encoding of the concatenation of what two encodings stand for."""
        if not left or not right or self.stable(left[-1], right[0]):
            return left + right
        i = j = 1
        window = self.pair(left[-1], right[0])
        while True:
            fits_left = i == len(left) or self.stable(left[-i - 1], window[0])
            fits_right = j == len(right) or self.stable(window[-1], right[j])
            if fits_left and fits_right:
                return left[:len(left) - i] + window + right[j:]
            i = i if fits_left else min(len(left), 2 * i)
            j = j if fits_right else min(len(right), 2 * j)
            window = self.merged(self.decode(left[len(left) - i:] + right[:j]))

    def encode(self, piece: bytes) -> tuple[int, ...]:
        """Tokens of one piece, by halves."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return (whole,)
        known = self._halves.get(piece)
        if known is None:
            # Long pieces are cut at powers of two, where runs of one character stay in step with their tokens.
            middle = len(piece) // 2 if len(piece) <= 64 else 1 << (len(piece) - 1).bit_length() - 1
            known = self.join(self.encode(piece[:middle]), self.encode(piece[middle:])) if piece else ()
            if len(piece) <= 12:
                if len(self._halves) > REMEMBERED:
                    self._halves.clear()
                self._halves[piece] = known
        return known

    def decode(self, tokens: tuple[int, ...]) -> bytes:
        """Bytes of the tokens, concatenated up the tree."""
        if len(tokens) <= 64:
            return b"".join([self.bytes_of[t] for t in tokens])
        middle = len(tokens) // 2
        return self.decode(tokens[:middle]) + self.decode(tokens[middle:])


class _Pieces(dict):
    """Piece of text to (the tokens as text, the bytes they decode to, how many they are, the tokens), filled as pieces appear."""

    def __init__(self, codec: Codec):
        super().__init__()
        self.codec = codec

    def __missing__(self, piece: str) -> tuple:
        tokens = self.codec.encode(piece.encode())
        value = " ".join(map(str, tokens)), self.codec.decode(tokens), len(tokens), tokens
        if len(piece) <= 32:
            self[piece] = value
        return value


def _portions(pattern, text: str) -> Iterator[list[str]]:
    if len(text) <= LONG:
        yield pattern.findall(text)
        return
    found = (m.group() for m in pattern.finditer(text))
    while portion := list(islice(found, PORTION)):
        yield portion


def start(ranks: dict[bytes, int], pattern: str, with_ids: bool) -> Callable[[list, list], dict]:
    import gc

    import regex

    pieces, splitter = _Pieces(Codec(ranks)), regex.compile(pattern)
    gc.set_threshold(100_000, 50, 100)  # what is remembered has no cycles: look for them seldom

    def rows(ids: list, texts: list) -> dict:
        out: dict = {"doc_id": ids, "n_tokens": [], "ids_sha256": [], "decoded_sha256": []}
        if with_ids:
            out["ids"] = []
        for text in texts:
            if len(pieces) > REMEMBERED:
                pieces.clear()
            n, digest, decoded, tokens = 0, hashlib.sha256(), hashlib.sha256(), []
            for portion in _portions(splitter, text):
                if not portion:
                    continue
                written, raw, counts, lists = zip(*map(pieces.__getitem__, portion))
                digest.update(((" " if n else "") + " ".join(written)).encode())
                decoded.update(b"".join(raw))
                n += sum(counts)
                if with_ids:
                    tokens += chain.from_iterable(lists)
            out["n_tokens"].append(n)
            out["ids_sha256"].append(digest.hexdigest())
            out["decoded_sha256"].append(decoded.hexdigest())
            if with_ids:
                out["ids"].append(tokens)
        return out

    return rows


def encoded(docs: DataFrame, ranks: dict[bytes, int], pattern: str, with_ids: bool = True) -> DataFrame:
    """Tokens of every whole text: `doc_id, n_tokens, ids_sha256, decoded_sha256` and, if asked for, `ids`.

    Each match of `pattern` is encoded separately, without special tokens; NULL and empty texts have no tokens. Digests are
    lowercase hex SHA-256, of the decimal ids joined by one space and of the bytes the ids decode to. One row per row of
    `docs`, repeated rows included; other columns are not looked at. Nothing is shuffled.
    """
    schema = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string" + (", ids array<int>" if with_ids else "")
    return map_texts(docs, lambda: start(ranks, pattern, with_ids), schema)
