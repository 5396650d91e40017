"""Periodic runs of words by enumeration of maximal pairs.

A run is a stretch with smallest period q, at least twice as long as q and at least LEAST words long, that no neighbouring word
extends. Equal stretches at i and j = i + q of length l that neither the words before nor the words after them prolong are a
maximal pair; it is a run of length q + l exactly if q <= l and q + l >= LEAST. So l is at least half of LEAST, and only those
LCP intervals of the suffix array are built whose value is that large.

The suffixes that open with a repeated half are sorted by doubling; the ranks of all levels then give the LCP of neighbours. The
intervals are swept bottom-up. Each carries its positions in text order with the class of their left word. Where two children
meet, a pair with the interval's LCP is looked for between positions that become neighbours, of different left class: if
another position stood between i and j, its stretch would overlap both and q would not be their smallest period. Every run is met
once, and none needs to be extended.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Callable, Iterator
from itertools import compress

from pyspark.sql import DataFrame

from millrace.llm.common import map_texts

LEAST = 12  # words in a run
HALF = LEAST // 2  # the least LCP of a pair that is a run
TOGETHER = 200_000  # words of several documents that are sorted together; a longer document is sorted alone
KNOWN_WORDS = 1_000_000  # a task starts its word numbers afresh beyond this


class _Codes(dict):
    """Numbers of words, given as they appear."""

    def __missing__(self, word: bytes) -> int:
        code = self[word] = len(self)
        return code


def _repeated(codes, document):
    """Positions whose next HALF words occur again in the same document (and a few others, by chance of a hash)."""
    import numpy as np

    n = len(codes) - HALF + 1
    with np.errstate(over="ignore"):
        h = document[:n].astype(np.uint64)
        for i in range(HALF):
            h = (h ^ (h >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + codes[i:n + i].view(np.uint64)
        h = (h ^ (h >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)
    order = h.argsort()
    same = np.flatnonzero(h[order[1:]] == h[order[:-1]])
    found = np.zeros(n, bool)
    found[order[same]] = found[order[same + 1]] = True
    return np.flatnonzero(found)


def suffixes(codes, document):
    """Sorted suffixes that open with a repeated half, and the LCP of each with the one before it (0 below HALF).

    `codes` ends with HALF numbers that occur nowhere else, and each document with one; stretches of different documents differ.
    """
    import numpy as np

    repeated = _repeated(codes, document)
    if not len(repeated):
        return repeated, repeated
    # A suffix with a repeated half is compared next by what follows that half, so those suffixes need a rank as well.
    places = np.union1d(repeated, repeated + HALF)
    padded = np.concatenate([codes, np.arange(HALF) + (1 << 62)])
    columns = [document[places], *(padded[places + i] for i in range(HALF))]
    order = np.lexsort(columns[::-1])
    starts = np.ones(len(order), bool)
    starts[1:] = False
    for column in columns:
        starts[1:] |= column[order[1:]] != column[order[:-1]]
    slot = np.arange(len(order))
    rank = np.empty(len(order), np.int64)
    rank[order] = np.maximum.accumulate(np.where(starts, slot, 0))
    at = np.zeros(len(padded), np.int64)
    at[places] = slot
    levels, step = [rank], HALF
    while True:
        # Slots of groups with several members; all other suffixes have their final rank.
        single = starts & np.append(starts[1:], True)
        open_slots = np.flatnonzero(~single)
        if not len(open_slots):
            break
        members = order[open_slots]
        following = rank[at[places[members] + step]]
        own = rank[members]
        inner = np.lexsort((following, own))
        members, following, own = members[inner], following[inner], own[inner]
        fresh = np.ones(len(members), bool)
        fresh[1:] = (own[1:] != own[:-1]) | (following[1:] != following[:-1])
        order[open_slots] = members
        starts = starts.copy()
        starts[open_slots] = fresh
        rank = rank.copy()
        rank[members] = np.maximum.accumulate(np.where(fresh, open_slots, 0))
        levels.append(rank)
        step *= 2
    sorted_places = places[order]
    a, b = sorted_places[:-1], sorted_places[1:]
    alike = np.flatnonzero(levels[0][order[:-1]] == levels[0][order[1:]])
    a, b = a[alike], b[alike]
    lcp = np.zeros(len(alike), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        lcp += (levels[k][at[a + lcp]] == levels[k][at[b + lcp]]) * (HALF << k)
    more = np.ones(len(alike), bool)
    for _ in range(HALF - 1):
        more &= padded[a + lcp] == padded[b + lcp]
        lcp += more
    out = np.zeros(len(order), np.int64)
    out[alike + 1] = lcp
    return sorted_places, out


def _meet(a: list, b: list, value: int, left: list, found: list) -> list:
    """The positions of two child intervals together; pairs between new neighbours that are runs go to `found`."""
    if len(a) < len(b):
        a, b = b, a
    last, before = len(b) - 1, -1
    for k, place in enumerate(b):
        at = bisect_left(a, place)
        if at and (other := a[at - 1]) != before:
            gap = place - other
            if gap <= value and gap + value >= LEAST and left[other] != left[place]:
                found.append((other, gap + value, gap))
        if at < len(a):
            other = a[at]
            gap = other - place
            if gap <= value and gap + value >= LEAST and left[other] != left[place] and (k == last or b[k + 1] > other):
                found.append((place, gap + value, gap))
        a.insert(at, place)
        before = place
    return a


def maximal_pairs(codes, document) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run, sorted."""
    import numpy as np

    places, lcp = suffixes(codes, document)
    if not len(places):
        return []
    left = np.concatenate([[-(1 << 62)], codes]).tolist()  # the word before each position
    found: list = []
    stack: list = []
    current: list = []
    for place, value in zip(places.tolist(), lcp.tolist()):
        while stack and stack[-1][1] > value:
            child, joint = stack.pop()
            current = _meet(child, current, joint, left, found)
        if value:
            stack.append((current, value))
        current = [place]
    while stack:
        child, joint = stack.pop()
        current = _meet(child, current, joint, left, found)
    return sorted(found)


def runs_of(documents: list[list[bytes]], codes_of: dict | None = None) -> list[list[tuple[int, int, int]]]:
    """Runs of each of several documents, given as lists of words; starts are word numbers in the document."""
    import numpy as np

    codes_of = _Codes() if codes_of is None else codes_of
    out: list = [[] for _ in documents]
    flat: list = []
    borders = [0]
    for number, words in enumerate(documents):
        flat += map(codes_of.__getitem__, words)
        flat.append(-1 - number)
        borders.append(len(flat))
    flat += range(-1 - len(documents) - HALF, -1 - len(documents))
    if len(flat) <= HALF:
        return out
    document = np.repeat(np.arange(len(documents) + 1), np.diff([*borders, len(flat)]))
    for start, length, period in maximal_pairs(np.array(flat, np.int64), document):
        number = int(document[start])
        out[number].append((start - borders[number], length, period))
    return out


def _portions(documents: list) -> Iterator[slice]:
    first, words = 0, 0
    for i, d in enumerate(documents):
        words += len(d)
        if words >= TOGETHER:
            yield slice(first, i + 1)
            first, words = i + 1, 0
    if first < len(documents):
        yield slice(first, len(documents))


SCHEMA = "doc_id bigint, n_words bigint, runs array<struct<start:bigint,length:bigint,period:bigint>>, kept_text string"


def collapsed(docs: DataFrame, change: Callable[[int | None, list], list] | None = None) -> DataFrame:
    """Runs of every whole text, and the text without what they repeat: `doc_id, n_words, runs, kept_text`.

    Words are what ASCII white space separates, compared as they are. `runs` is sorted by start, then period. A word goes if a run
    contains it after the first `period` words of that run; the others are joined by one space. `change(doc_id, words)` may give
    other words for a document before it is searched. NULL, empty and blank texts have no words and no runs, their kept text
    is empty. One row per row of `docs`, repeated rows included; other columns are not looked at. A text is sorted in one
    task, however long, in time n log n. Nothing is shuffled.
    """

    def start() -> Callable[[list, list], dict]:
        held = {"codes": _Codes()}

        def rows(ids: list, texts: list) -> dict:
            out: dict = {"doc_id": ids, "n_words": [], "runs": [], "kept_text": []}
            documents = [t.encode().split() for t in texts]
            if change is not None:
                documents = [change(i, d) for i, d in zip(ids, documents)]
            for part in _portions(documents):
                if len(held["codes"]) > KNOWN_WORDS:
                    held["codes"] = _Codes()
                some = documents[part]
                for words, runs in zip(some, runs_of(some, held["codes"])):
                    out["n_words"].append(len(words))
                    out["runs"].append([{"start": s, "length": n, "period": p} for s, n, p in runs])
                    if runs:
                        keep = bytearray(b"\1") * len(words)
                        for s, n, p in runs:
                            keep[s + p:s + n] = bytes(n - p)
                        words = compress(words, keep)
                    out["kept_text"].append(b" ".join(words).decode())
            return out

        return rows

    return map_texts(docs, start, SCHEMA)
