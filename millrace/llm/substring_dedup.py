"""Repeated passages: compressed FM-index per shard, searched backward for matching statistics of streamed documents.

A window is WINDOW consecutive words of a document. Its anchor is the smallest hash of the ANCHOR-word sequences in it, so equal
windows have equal anchors wherever they stand. Consecutive windows with the same anchor form a segment.

1. Anchors of all segments are dealt to tasks by value, at most once for each portion of text; where an anchor occurs twice,
   its segments become candidates (also where both are in one segment). A window that occurs twice lies in candidates only.
2. Candidate segments are dealt to shards by anchor. A shard sorts the suffixes of its distinct segments to the depth of a
   window, keeps their Burrows-Wheeler transform in a wavelet matrix of packed bits, and streams all windows of the segments
   through it: backward search yields how far each is repeated and, at full length, the interval of its occurrences. If the
   earliest of these is not the window itself, its words are removed.
3. Ranges go back to their documents.

Segments with the same words are indexed once, and a portion of text sends each at most once, so passages shared by very many
documents load no shard. A phrase in very many documents with different words around it gives each of them a segment of its
own under one anchor. Such a hot anchor has no shard: its windows are dealt one by one by a hash of all their words, so equal
windows meet and the occurrences of the phrase are spread over all shards; the earliest of equal windows stays. All three steps
see each word a constant number of times; nothing grows faster than the corpus. Words are compared by 40-bit hashes, which for
twenty of them in a row and a 64-bit anchor leaves errors out of reach, and so do the 96 bits of a window of a hot anchor.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

from pyspark.sql import DataFrame, functions as F

from millrace.llm.common import body

WINDOW = 20
ANCHOR = 6
PORTION = 1_000_000  # words that a task handles at once
ANCHOR_WORDS = 4_000_000  # words of the corpus for each task of step 1
SHARD_WORDS = 1_500_000  # words of the corpus for each shard of step 2
HOT = 2_000  # segments from which on an anchor's windows are dealt one by one
HOT_HERE = 100  # the same within a portion
MOST_TASKS = 50_000  # beyond, a task does several shards one after the other


def _scrambled(values):
    import numpy as np

    v = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    v = (v ^ (v >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return v ^ (v >> np.uint64(31))


class Words(dict):
    """Word to its 64-bit hash."""

    def __missing__(self, word: bytes) -> int:
        from xxhash import xxh3_64_intdigest

        value = xxh3_64_intdigest(word)
        if len(self) < 2_000_000:
            self[word] = value
        return value


def segments(codes, doc):
    """Segments of concatenated documents, from word hashes and the document of each word.

    Starts, window counts, anchors, and whether the anchor occurs twice in the segment (which can then repeat itself).
    """
    import numpy as np

    empty = np.zeros(0, np.int64)
    n = len(codes) - WINDOW + 1
    if n <= 0:
        return empty, empty, np.zeros(0, np.uint64), np.zeros(0, bool)
    grams = np.zeros(len(codes) - ANCHOR + 1, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(ANCHOR):
            grams = _scrambled(grams * np.uint64(0x9E3779B97F4A7C15) + codes[i:len(grams) + i])
    least, span = grams, 1
    width = WINDOW - ANCHOR + 1
    while 2 * span <= width:
        least, span = np.minimum(least[:-span], least[span:]), 2 * span
    anchor = np.minimum(least[:n], least[width - span:width - span + n])
    whole = doc[:n] == doc[WINDOW - 1:]
    new = whole.copy()
    new[1:] &= (anchor[1:] != anchor[:-1]) | (doc[1:n] != doc[:n - 1])
    starts = np.flatnonzero(new)
    counts = np.add.reduceat(whole.astype(np.int64), starts) if len(starts) else empty
    anchor = anchor[starts]
    inside, begins = _take(grams, starts, counts + width - 1)
    there = np.add.reduceat((inside == np.repeat(anchor, counts + width - 1)).astype(np.int64), begins) if len(starts) else empty
    return starts, counts, anchor, there > 1


class FmIndex:
    """Burrows-Wheeler transform of a text over small whole numbers, sorted to `depth`, in a wavelet matrix of packed bits.

    0 separates and occurs in no pattern. Patterns of up to `depth` symbols can be searched.
    """

    def __init__(self, text, depth: int = WINDOW):
        import numpy as np

        n = len(text)
        self.size = n
        rank, reach = text.astype(np.int64), 1
        while reach < depth:
            step = min(reach, depth - reach)
            key = rank * (int(rank.max(initial=0)) + 1)
            key[:n - step] += rank[step:]
            reach += step
            if reach < depth:
                rank = np.unique(key, return_inverse=True)[1]
        self.order = np.argsort(key, kind="stable").astype(np.int32)
        last = text[self.order - 1]
        symbols = int(text.max(initial=0)) + 1
        self.below = np.concatenate([[0], np.bincount(text, minlength=symbols).cumsum()])[:-1]
        self.levels = max(1, (symbols - 1).bit_length())
        self.words, self.counts, self.zeros = [], [], []
        for level in range(self.levels):
            bits = (last >> (self.levels - 1 - level)) & 1
            padded = np.zeros((n // 64 + 1) * 64, np.uint8)
            padded[:n] = bits
            words = np.packbits(padded, bitorder="little").view(np.uint64)
            self.words.append(words)
            self.counts.append(np.concatenate([[0], np.bitwise_count(words).cumsum()])[:-1].astype(np.int32))
            ones = bits.astype(bool)
            self.zeros.append(n - int(ones.sum()))
            last = np.concatenate([last[~ones], last[ones]])
        self.first = self._descend(np.arange(symbols), np.zeros(symbols, np.int64))

    def _ones(self, level: int, at):
        import numpy as np

        word = at >> 6
        mask = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.counts[level][word] + np.bitwise_count(self.words[level][word] & mask)

    def _descend(self, symbol, at):
        import numpy as np

        for level in range(self.levels):
            ones = self._ones(level, at)
            one = ((symbol >> (self.levels - 1 - level)) & 1).astype(bool)
            at = np.where(one, self.zeros[level] + ones, at - ones)
        return at

    def step(self, symbol, low, high):
        """Intervals of `symbol` followed by what the intervals stand for."""
        import numpy as np

        both = self._descend(np.concatenate([symbol, symbol]), np.concatenate([low, high]))
        base = self.below[symbol] - self.first[symbol]
        return base + both[:len(symbol)], base + both[len(symbol):]

    def statistics(self, text, ends, depth: int = WINDOW):
        """Backward from each end: how many symbols, up to `depth`, are found at least twice, and the interval of them."""
        import numpy as np

        low, high = np.zeros(len(ends), np.int64), np.full(len(ends), self.size, np.int64)
        length, live = np.zeros(len(ends), np.int64), np.arange(len(ends))
        for back in range(1, depth + 1):
            lo, hi = self.step(text[ends[live] - back], low[live], high[live])
            going = hi - lo >= 2
            live = live[going]
            low[live], high[live], length[live] = lo[going], hi[going], back
        return length, low, high


def _content(symbols, starts, lengths):
    """A 64-bit hash of each segment's symbols."""
    import numpy as np

    with np.errstate(over="ignore"):
        place = np.arange(len(symbols)) - np.repeat(starts, lengths)
        mixed = _scrambled(symbols + _scrambled(place.astype(np.uint64) + np.uint64(1)))
        return _scrambled(np.add.reduceat(mixed, starts) + lengths.astype(np.uint64)) if len(starts) else np.zeros(0, np.uint64)


def _take(symbols, starts, lengths):
    """The symbols of the chosen segments, one after the other, and where each begins."""
    import numpy as np

    begins = np.concatenate([[0], lengths.cumsum()])[:-1].astype(np.int64)
    index = np.arange(int(lengths.sum())) - np.repeat(begins - starts, lengths)
    return symbols[index], begins


def _earliest(content):
    """Which segments are the first with their content, given in order of place."""
    import numpy as np

    first = np.zeros(len(content), bool)
    first[np.unique(content, return_index=True)[1]] = True
    return first


def _window_hashes(codes, at):
    """Two hashes, of 64 and of 32 bits, of the windows that start at these places."""
    import numpy as np

    one, two = np.zeros(len(at), np.uint64), np.ones(len(at), np.uint64)
    with np.errstate(over="ignore"):
        for i in range(WINDOW):
            code = codes[at + i]
            one = _scrambled(one * np.uint64(0x9E3779B97F4A7C15) + code)
            two = (two ^ (two >> np.uint64(29)) ^ code) * np.uint64(0xD6E8FEB86659FD93)
    return one, (_scrambled(two) >> np.uint64(32)).astype(np.uint32)


def _firsts(one, two):
    """Which windows are the first with their two hashes, given in order of place."""
    import numpy as np

    order = np.lexsort((two, one))
    new = np.ones(len(order), bool)
    new[1:] = (one[order[1:]] != one[order[:-1]]) | (two[order[1:]] != two[order[:-1]])
    first = np.zeros(len(order), bool)
    first[order[new]] = True
    return first


def _places(ids, ties, place):
    """Indices in order of id, tie and place, each place once."""
    import numpy as np

    order = np.lexsort((place, ties, ids))
    same = np.zeros(len(order), bool)
    same[1:] = (ids[order[1:]] == ids[order[:-1]]) & (ties[order[1:]] == ties[order[:-1]]) & (place[order[1:]] == place[order[:-1]])
    return order[~same]


def repeated_windows(symbols, starts, lengths):
    """For distinct segments in order of place: (segment, first window, windows) of each run of windows that occur earlier."""
    import numpy as np

    codes, dense = np.unique(symbols, return_inverse=True)
    del codes
    text = np.zeros(len(symbols) + len(starts), np.int32)
    shift = np.repeat(np.arange(len(starts)), lengths)
    text[np.arange(len(symbols)) + shift] = dense + 1
    begins = starts + np.arange(len(starts))
    index = FmIndex(text)
    counts = lengths - WINDOW + 1
    offset = np.arange(int(counts.sum())) - np.repeat(np.concatenate([[0], counts.cumsum()])[:-1], counts)
    segment = np.repeat(np.arange(len(starts)), counts)
    at = np.repeat(begins, counts) + offset
    length, low, high = index.statistics(text, at + WINDOW)
    full = np.flatnonzero(length == WINDOW)
    if not len(full):
        return np.zeros((0, 3), np.int64)
    # Intervals of full length are equal or disjoint: the earliest occurrence is taken once for each.
    left, where = np.unique(low[full], return_inverse=True)
    right = np.zeros(len(left), np.int64)
    right[where] = high[full]
    edges = np.stack([left, right], axis=1).ravel()
    earliest = np.minimum.reduceat(np.append(index.order, np.int32(2**31 - 1)), edges)[::2]
    again = full[earliest[where] < at[full]]
    new = np.ones(len(again), bool)
    new[1:] = (segment[again[1:]] != segment[again[:-1]]) | (offset[again[1:]] != offset[again[:-1]] + 1)
    heads = np.flatnonzero(new)
    many = np.diff(np.append(heads, len(again)))
    return np.stack([segment[again[heads]], offset[again[heads]], many], axis=1)


def _portions(batches: Iterator, texts_at: int) -> Iterator[list]:
    """Rows of the batches as tuples, in lists of about PORTION words."""
    held, size = [], 0
    for batch in batches:
        columns = [batch.column(i).to_pylist() for i in range(batch.num_columns)]
        for row in zip(*columns):
            held.append(row)
            size += len(row[texts_at]) // 5
            if size >= PORTION:
                yield held
                held, size = [], 0
    if held:
        yield held


def _encoded(rows: list, words: Words, text_at: int):
    """Documents in order of (id, tie), each once: their rows, word hashes and the document of each word."""
    import numpy as np

    unique = list({(r[0], r[1]): r for r in rows}.values())
    unique.sort(key=lambda r: (r[0], r[1]))
    codes = [np.array(list(map(words.__getitem__, r[text_at].encode().split())), np.uint64) for r in unique]
    sizes = np.array([len(c) for c in codes], np.int64)
    return unique, np.concatenate(codes), np.repeat(np.arange(len(unique)), sizes), np.concatenate([[0], sizes.cumsum()])[:-1]


def _by_task(task, tasks: int):
    """Rows of each task that has any."""
    import numpy as np

    order = np.argsort(task, kind="stable")
    edges = np.searchsorted(task[order], np.arange(tasks + 1))
    for t in np.flatnonzero(np.diff(edges)):
        yield int(t), order[edges[t]:edges[t + 1]]


KINDS = ("<u8", "<i8", "<u4", "<i4", "<u2", "|u1", "|b1")  # number types a blob may hold


def _packed(arrays: list) -> bytes:
    """Arrays as bytes, with five bytes of description each: blobs stay small where shards are many."""
    heads = [struct.pack("<BI", KINDS.index(a.dtype.str), len(a)) for a in arrays]
    return b"".join([*heads, *(a.tobytes() for a in arrays)])


def _unpacked(blob: bytes, many: int) -> list:
    import numpy as np

    at, out = 5 * many, []
    for i in range(many):
        kind, length = struct.unpack_from("<BI", blob, 5 * i)
        out.append(np.frombuffer(blob, KINDS[kind], length, at))
        at += out[-1].nbytes
    return out


ANCHOR_ARRAYS, SEGMENT_ARRAYS = 10, 15  # in the blobs of the two steps


def _blobs(found: list):
    import pyarrow as pa

    return pa.RecordBatch.from_arrays(
        [pa.array([t for t, _ in found], pa.int32()), pa.array([b for _, b in found], pa.binary())], names=["shard", "blob"])


def _groups(batches: Iterator, many: int) -> Iterator[tuple[int, list]]:
    """Blobs of each shard; rows come sorted by shard."""
    now, held = None, []
    for batch in batches:
        for shard, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if shard != now and held:
                yield now, held
                held = []
            now = shard
            held.append(_unpacked(blob, many))
    if held:
        yield now, held


def _send_anchors(tasks: int):
    def run(batches: Iterator) -> Iterator:
        import numpy as np

        words = Words()
        for rows in _portions(batches, 2):
            docs, codes, doc, base = _encoded(rows, words, 2)
            starts, _, anchor, twice = segments(codes, doc)
            ids, ties = np.array([r[0] for r in docs], np.int64), np.array([r[1] for r in docs], np.int32)
            value, first, where, many = np.unique(anchor, return_index=True, return_inverse=True, return_counts=True)
            known = many > 1  # within the portion: only one is sent on, all are candidates
            known[where[twice]] = True
            here = np.where(known, many, 0)
            # Segments of anchors that are hot here need not learn it from the anchor's task and stay out of it.
            hot = here[where] >= HOT_HERE
            home = (value % np.uint64(tasks)).astype(np.int64)[where] if len(value) else where
            away = (_scrambled(ids[doc[starts]].view(np.uint64)) % np.uint64(tasks)).astype(np.int64)
            told_in = {t: r for t, r in _by_task(np.where(hot, away, home), tasks)}
            one_in = {t: r for t, r in _by_task(home[first], tasks)}
            rank, out, nobody = np.zeros(len(value), np.int64), [], np.zeros(0, np.int64)
            for t in sorted(told_in.keys() | one_in.keys()):
                one, told = first[one_in.get(t, nobody)], told_in.get(t, nobody)
                told = told[known[where[told]]]
                # In the order of the anchors sent, those already known to be hot last.
                rank[where[one]] = np.arange(len(one))
                told = told[np.argsort(np.where(hot[told], len(one), rank[where[told]]), kind="stable")]
                if not len(one) and not len(told):
                    continue
                count = here[where[one]]
                blob = [anchor[one], count.astype(np.min_scalar_type(int(count.max(initial=0))))]
                for chosen in (one, told):
                    holders, place = np.unique(doc[starts[chosen]], return_inverse=True)
                    kind = np.uint16 if len(holders) < 65_536 else np.uint32
                    blob += [ids[holders], ties[holders], place.astype(kind), (starts[chosen] - base[doc[starts[chosen]]]).astype(np.int32)]
                blob[-1] = np.where(hot[told], -1 - blob[-1], blob[-1])
                out.append((t, _packed(blob)))
            if out:
                yield _blobs(out)

    return run


def _found(ids, ties, values):
    import pyarrow as pa

    return pa.RecordBatch.from_arrays([pa.array(ids), pa.array(ties), pa.array(values.astype("int64"))], names=["id", "tie", "found"])


def _find_candidates(batches: Iterator) -> Iterator:
    """Segments whose anchor occurs twice, as starts within their documents; -1 - start if the anchor is hot."""
    import numpy as np

    for _, blobs in _groups(batches, ANCHOR_ARRAYS):
        anchor, here = (np.concatenate([b[k] for b in blobs]) for k in range(2))
        here = here.astype(np.int64)
        _, where, many = np.unique(anchor, return_inverse=True, return_counts=True)
        hot = np.bincount(where, np.maximum(here, 1), len(many)) >= HOT
        hot[where[here >= HOT_HERE]] = True
        hot = hot[where]
        # A single row is enough where its portion has the anchor twice; its holders were told already.
        chosen = (many[where] > 1) & (here == 0)
        ids, ties, starts = (np.concatenate([b[k][b[4]] if k < 4 else b[5] for b in blobs]) for k in (2, 3, 5))
        told = [np.concatenate([b[k][b[8]] if k < 8 else b[9] for b in blobs]) for k in (6, 7, 9)]
        starts = np.where(hot, -1 - starts, starts)
        of = np.repeat(hot, np.where(here < HOT_HERE, here, 0))  # of the segments told, for those that do not know
        open_ = told[2] >= 0
        told[2] = told[2].copy()
        told[2][open_] = np.where(of, -1 - told[2][open_], told[2][open_])
        yield _found(*(np.concatenate([x[chosen], y]) for x, y in zip((ids, ties, starts), told)))


def _hot_windows(codes, doc, starts, counts, hot):
    """Of the hot segments: the first of equal windows, their two hashes, and (start, words) of runs of the other windows."""
    import numpy as np

    at = _take(np.arange(len(codes)), starts[hot], counts[hot])[0]
    one, two = _window_hashes(codes, at)
    first = _firsts(one, two)
    rest = at[~first]
    heads = np.flatnonzero(np.diff(rest, prepend=-2) != 1)
    many = np.diff(np.append(heads, len(rest)))
    return at[first], (one[first], two[first]), (rest[heads], many + WINDOW - 1)


def _send_segments(tasks: int):
    def run(batches: Iterator) -> Iterator:
        import numpy as np

        words = Words()
        for rows in _portions(batches, 2):
            docs, codes, doc, base = _encoded(rows, words, 2)
            starts, counts, anchor, _ = segments(codes, doc)
            told = [np.array(r[3], np.int64) for r in docs]
            hot = np.concatenate(told) < 0
            wanted = np.concatenate([np.where(x < 0, -1 - x, x) + base[i] for i, x in enumerate(told)])
            ids, ties = np.array([r[0] for r in docs], np.int64), np.array([r[1] for r in docs], np.int32)
            windows, whose, over = _hot_windows(codes, doc, starts, counts, np.isin(starts, wanted[hot]))
            chosen = np.isin(starts, wanted[~hot])
            starts, lengths, anchor = starts[chosen], counts[chosen] + WINDOW - 1, anchor[chosen]
            symbols, begins = _take(codes, starts, lengths)
            first = _earliest(_content(symbols, begins, lengths))
            # Known repeats need no shard, so those of one passage are dealt by their holders.
            again = np.concatenate([starts[~first], over[0]])
            reach = np.concatenate([lengths[~first], over[1]])
            starts, lengths, begins, anchor = starts[first], lengths[first], begins[first], anchor[first]
            rows_in = [dict(_by_task((key % np.uint64(tasks)).astype(np.int64), tasks)) for key in (
                anchor, _scrambled(ids[doc[again]].view(np.uint64)), whose[0])]
            out, nobody = [], np.zeros(0, np.int64)
            for t in sorted(set().union(*rows_in)):
                one, later, alone = (r.get(t, nobody) for r in rows_in)
                mine = _take(symbols, begins[one], lengths[one])[0]
                blob = []
                for at, length in ((starts[one], lengths[one]), (again[later], reach[later]), (windows[alone], None)):
                    holder = doc[at]
                    blob += [ids[holder], ties[holder], (at - base[holder]).astype(np.int32)]
                    blob += [] if length is None else [length.astype(np.int32)]
                out.append((t, _packed([
                    *blob[:4], (mine & np.uint64(0xFFFFFFFF)).astype(np.uint32), ((mine >> np.uint64(32)) & np.uint64(0xFF)).astype(np.uint8),
                    *blob[4:], whose[0][alone], whose[1][alone]])))
            if out:
                yield _blobs(out)

    return run


def _search_shards(batches: Iterator) -> Iterator:
    """Ranges of words to remove from the segments of each shard: begin and end in the upper and lower half of a number."""
    import numpy as np

    for _, blobs in _groups(batches, SEGMENT_ARRAYS):
        ids, ties, place, lengths, low, top, *rest = (np.concatenate([b[k] for b in blobs]) for k in range(SEGMENT_ARRAYS))
        later, alone = rest[:4], rest[4:]
        lengths = lengths.astype(np.int64)
        symbols = low.astype(np.uint64) | (top.astype(np.uint64) << np.uint64(32))
        starts = np.concatenate([[0], lengths.cumsum()])[:-1].astype(np.int64)
        order = _places(ids, ties, place)  # rows that repeat id and text are one document
        content = _content(symbols, starts, lengths)[order]
        first = _earliest(content)
        indexed, copies = order[first], order[~first]
        text, begins = _take(symbols, starts[indexed], lengths[indexed])
        runs = repeated_windows(text, begins, lengths[indexed])
        of = indexed[runs[:, 0]]
        alone = [x[_places(*alone[:3])] for x in alone]
        alone = [x[~_firsts(*alone[3:])] for x in alone]
        at = [place[of] + runs[:, 1], place[copies], later[2], alone[2]]
        to = [at[0] + runs[:, 2] + WINDOW - 1, place[copies] + lengths[copies], later[2] + later[3], alone[2] + WINDOW]
        yield _found(np.concatenate([ids[of], ids[copies], later[0], alone[0]]), np.concatenate([ties[of], ties[copies], later[1], alone[1]]),
                     (np.concatenate(at).astype(np.int64) << 32) | np.concatenate(to))


def _remove(batches: Iterator) -> Iterator:
    """Words of each document and those that stay."""
    import numpy as np
    import pyarrow as pa

    for batch in batches:
        sizes, removed, kept = [], [], []
        for text, found in zip(batch.column("text").to_pylist(), batch.column("ranges").to_pylist()):
            words = text.encode().split()
            n = len(words)
            if found:
                edges = np.zeros(n + 1, np.int64)
                ranges = np.array(found, np.int64)
                np.add.at(edges, ranges >> 32, 1)
                np.add.at(edges, ranges & 0xFFFFFFFF, -1)
                stays = (edges.cumsum()[:n] == 0).tolist()
                words = [w for w, s in zip(words, stays) if s]
            sizes.append(n)
            removed.append(n - len(words))
            kept.append(b" ".join(words))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())],
            names=["doc_id", "n_words", "n_removed", "kept_text"])


def _dealt(sent: DataFrame, tasks: int) -> DataFrame:
    return sent.repartition(tasks, "shard").sortWithinPartitions("shard")


def deduplicated(docs: DataFrame) -> DataFrame:
    """`doc_id, n_words, n_removed, kept_text` of every whole text, one row per row of `docs`.

    A word goes if a window over it also starts earlier (a smaller doc_id, or earlier in the same document); windows are judged
    on the input. kept_text is the other words, joined by one space. NULL and empty texts have no words; a text of fewer than
    WINDOW words keeps them all. A NULL id counts as the smallest. Rows that repeat id and text are one document; texts that
    share an id only are ordered by a hash. Other columns are not looked at.
    """
    lowest = -(2**63)
    keyed = docs.select(
        F.coalesce(F.col("doc_id").cast("bigint"), F.lit(lowest)).alias("id"), F.hash(body()).alias("tie"), body().alias("text"), "doc_id")
    words = (docs.agg(F.sum(F.octet_length(body()))).first()[0] or 0) // 6
    anchor_tasks = min(MOST_TASKS, max(8, words // ANCHOR_WORDS))
    shards = max(8, words // SHARD_WORDS)
    anchors = keyed.select("id", "tie", "text").mapInArrow(_send_anchors(anchor_tasks), "shard int, blob binary")
    found = "id bigint, tie int, found bigint"
    candidates = _dealt(anchors, anchor_tasks).mapInArrow(_find_candidates, found).groupBy("id", "tie").agg(
        F.collect_list("found").alias("starts"))
    # The same columns as in the last join, so both read one shuffle of the texts.
    sent = keyed.join(candidates, ["id", "tie"]).select("id", "tie", "text", "starts", "doc_id").mapInArrow(
        _send_segments(shards), "shard int, blob binary")
    ranges = _dealt(sent, min(MOST_TASKS, shards)).mapInArrow(_search_shards, found).groupBy("id", "tie").agg(
        F.collect_list("found").alias("ranges"))
    return keyed.join(ranges, ["id", "tie"], "left").select("doc_id", "text", "ranges").mapInArrow(
        _remove, "doc_id bigint, n_words bigint, n_removed bigint, kept_text string")
