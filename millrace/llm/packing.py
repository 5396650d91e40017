"""Packing documents into sequences by order-preserving dynamic programming.

The tokens of documents, in their order, are one stream that is cut into windows of at most LENGTH tokens. A window costs the
padding it needs and a little for itself; a cut costs nothing between documents, little at the end of a sentence, more inside
one. For cuts at these borders the cheapest way to end at x is, over all earlier states y within LENGTH of x, the least
cost(y) + y, less x and plus a constant, so a monotone queue holds the candidates: a state leaves it at the back as soon as a
later one is no dearer, and at the front once its window is full. A state that leaves at the front is continued by a cut inside the
sentence, exactly where its window is full, which is the only useful place for such a cut. Windows whose length is a power of two
need no padding and are looked up by their length.

Spark puts the documents in order in slices; a slice is read as a stream and solved in blocks of whole documents.
"""

from __future__ import annotations

import json
from collections import deque
from collections.abc import Callable, Iterator
from typing import NamedTuple

from pyspark.sql import DataFrame, functions as F

from millrace.llm.common import body, ready
from millrace.operators import ordered

ROWS_PER_SLICE = 4_000  # documents that one task puts in order
BLOCK = 1 << 20  # tokens from which on a block of whole documents is solved
LAST = (1 << 63) - 1  # where rows without an id are put
FREE = (512, 256, 128, 64, 32, 16)  # powers of two below LENGTH that windows are looked up by


class Costs(NamedTuple):
    """What is minimised, in tokens of padding."""

    length: int = 1024
    window: int = 2
    sentence: int = 4
    inside: int = 16
    free: tuple[int, ...] = FREE


def cuts(ends, soft, costs: Costs = Costs()) -> list[int]:
    """Ends of the windows of a stream, ascending; the last is the end of the stream.

    `ends` are the ends of documents, `soft` those of sentences, both ascending arrays of positions after which may be cut.
    """
    import numpy as np

    length, window, inside = costs.length, costs.window, costs.inside
    soft = np.setdiff1d(soft, ends, assume_unique=False)
    borders = np.concatenate([ends, soft])
    order = borders.argsort(kind="stable")
    price = np.where(order < len(ends), window, window + costs.sentence)
    # A state: the position of a cut, the cost up to it, the state before it.
    place, cost, before = [0], [0], [-1]
    known = {0: 0}
    queue = deque([0])
    free = [f for f in costs.free if f < length]

    def reach(position: int, total: int, origin: int) -> None:
        state = len(place)
        place.append(position)
        cost.append(total)
        before.append(origin)
        known[position] = state
        key = total + position
        while queue and cost[queue[-1]] + place[queue[-1]] >= key:
            queue.pop()
        queue.append(state)

    for x, extra in zip(borders[order].tolist(), price.tolist()):
        while place[queue[0]] + length < x:
            origin = queue.popleft()
            if place[origin] + length > place[-1]:
                reach(place[origin] + length, cost[origin] + window + inside, origin)
        origin = queue[0]
        best = cost[origin] + length - x + place[origin]
        for f in free:
            other = known.get(x - f)
            if other is not None and cost[other] < best:
                origin, best = other, cost[other]
        reach(x, best + extra, origin)
    out, state = [], known[int(ends[-1])]
    while state > 0:
        out.append(place[state])
        state = before[state]
    return out[::-1]


def byte_ranks(definition: str) -> tuple[dict[bytes, int], dict[str, int]]:
    """Ids of all byte strings and of the special tokens in a byte-level BPE definition of the tokenizers library.

    Raises ValueError unless ids rise in the order of merges, so that merging the pair with the least id is what the library does.
    """
    whole = json.loads(definition)
    model, split = whole["model"], whole["pre_tokenizer"] or {}
    special = {t["content"]: t["id"] for t in whole["added_tokens"]}
    merged = [model["vocab"]["".join(m if isinstance(m, list) else m.split(" "))] for m in model["merges"]]
    plain = not any((whole["normalizer"], split.get("add_prefix_space"), model.get("dropout"), model.get("ignore_merges")))
    if not plain or model["type"] != "BPE" or split.get("type") != "ByteLevel" or merged != sorted(merged):
        raise ValueError("not a plain byte-level BPE definition with ids in the order of merges")
    # The byte-level alphabet: printable Latin-1 characters stand for themselves, the other bytes follow from U+0100 on.
    itself = [b for b in range(256) if 33 <= b < 127 or 161 <= b < 256 and b != 173]
    others = [b for b in range(256) if b not in itself]
    byte_of = {chr(b): b for b in itself} | {chr(256 + i): b for i, b in enumerate(others)}
    return {bytes(map(byte_of.__getitem__, t)): i for t, i in model["vocab"].items() if t not in special}, special


class Encoder:
    """Ids of whole texts as the tokenizers library gives them, as bytes of little-endian whole numbers.

    The same merges run in tiktoken, which is several times faster. What its pattern engine gives up on, such as millions of white
    space characters in a row, goes to the tokenizers library itself.
    """

    def __init__(self, definition: str, pattern: str):
        import tiktoken

        self.definition = definition
        self.ranks, self.special = byte_ranks(definition)
        self.fast = tiktoken.Encoding("packing", pat_str=pattern, mergeable_ranks=self.ranks, special_tokens=self.special)
        self.library = None
        self.size = max([*self.ranks.values(), *self.special.values()]) + 1
        self.dtype = "<u2" if self.size <= 1 << 16 else "<u4"

    def encode(self, text: str):
        import numpy as np

        try:
            ids = self.fast.encode_to_numpy(text, allowed_special="all")
        except ValueError:
            from tokenizers import Tokenizer

            self.library = self.library or Tokenizer.from_str(self.definition)
            ids = np.array(self.library.encode(text, add_special_tokens=False).ids)
        return ids.astype(self.dtype)

    def sentence_marks(self):
        """For each id whether its token may end a sentence if the next one opens with white space, ends a line, and so opens."""
        import numpy as np

        closes, lines, opens = np.zeros((3, self.size), bool)
        stops = tuple(s.encode() for s in ".!?。！？")
        for token, i in self.ranks.items():
            closes[i] = token.rstrip(b"\"')]}*_").endswith(stops)
            lines[i] = b"\n" in token
            opens[i] = token[:1] in (b" ", b"\n")
        return closes, lines, opens


def pieces(documents: list[tuple], encoder_marks, dtype: str, costs: Costs) -> dict:
    """Columns of the pieces of a block of documents, each (doc_id, ids as bytes with the end id)."""
    import numpy as np

    closes, lines, opens = encoder_marks
    ids = np.frombuffer(b"".join([d[1] for d in documents]), dtype)
    width = ids.dtype.itemsize
    ends = np.cumsum([len(d[1]) // width for d in documents])
    soft = np.flatnonzero(lines[ids[:-1]] | (closes[ids[:-1]] & opens[ids[1:]])) + 1
    windows = np.array(cuts(ends, soft, costs))
    stops = np.union1d(ends, windows)
    starts = np.concatenate([[0], stops[:-1]])
    number = np.searchsorted(ends, starts, "right")
    first = np.concatenate([[0], ends])
    sequence = np.searchsorted(windows, starts, "right")
    wide = ids.astype("<u4")
    return {
        "doc_id": [documents[i][0] for i in number.tolist()], "start": starts - first[number], "length": stops - starts,
        "doc_tokens": ends[number] - first[number], "sequence": sequence, "offset": starts - np.concatenate([[0], windows])[sequence],
        "ids": [wide[a:b].tobytes() for a, b in zip(starts.tolist(), stops.tolist())], "sequences": len(windows)}


SCHEMA = "doc_id bigint, start bigint, length bigint, doc_tokens bigint, sequence_id bigint, offset bigint, ids binary"


def packed(
    docs: DataFrame, tokenizer: str, pattern: str, end_id: int = 0, costs: Costs = Costs(), rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """Pieces of all documents in sequences of at most `costs.length` tokens, one row for each piece.

    `doc_id, start, length, doc_tokens, sequence_id, offset, ids`: where the piece starts in its document and in its sequence, how
    many tokens it and its document have, and its ids as little-endian 32-bit numbers. `tokenizer` is the path of a byte-level
    BPE definition of the tokenizers library, `pattern` what it splits texts by. A document is its ids without added special tokens and then `end_id`, so NULL and
    empty texts have one token. Documents follow each other by doc_id, rows without an id last, rows of one id by a hash of
    their text; repeated rows are packed as often as they occur. Other columns are not looked at. The pieces of a sequence
    have offsets without gaps; sequence_id is the number of the slice in the upper half and a count in the lower.

    Ids are shuffled once, two bytes a token where the vocabulary allows it. A document of any length is in one task.
    """
    spark = ready(docs.sparkSession)
    with open(tokenizer, encoding="utf-8") as file:
        definition = file.read()
    byte_ranks(definition)
    text = body()
    rows = docs.select(F.coalesce(F.col("doc_id").cast("bigint"), F.lit(LAST)).alias("_order"), F.xxhash64(text).alias("_tie"),
                       F.col("doc_id").cast("bigint").alias("doc_id"), text.alias("text"))
    rows = ordered.sliced(rows, "_order", "_tie", rows_per_slice)

    def encode(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        encoder = Encoder(definition, pattern)
        end = np.array([end_id], encoder.dtype).tobytes()
        for batch in batches:
            ids = pa.array([encoder.encode(t).tobytes() + end for t in batch.column("text").to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in ("_slice", "_order", "_tie", "doc_id")] + [ids], schema=pa.schema([
                pa.field("_slice", pa.int32()), *(pa.field(c, pa.int64()) for c in ("_order", "_tie", "doc_id")), pa.field("ids", pa.binary())]))

    def pack(batches: Iterator) -> Iterator:
        import pyarrow as pa

        encoder = Encoder(definition, pattern)
        marks, width = encoder.sentence_marks(), int(encoder.dtype[-1])
        block: list = []
        at, done, held = None, 0, 0

        def solved() -> pa.RecordBatch:
            nonlocal block, done, held
            found = pieces(block, marks, encoder.dtype, costs)
            found["sequence_id"] = found["sequence"] + (at << 32) + done
            done += found["sequences"]
            block, held = [], 0
            return pa.RecordBatch.from_arrays([pa.array(found[f.name], f.type) for f in arrow], schema=arrow)

        for batch in batches:
            for place, doc, ids in zip(*(batch.column(c).to_pylist() for c in ("_slice", "doc_id", "ids"))):
                if block and (place != at or held >= BLOCK):
                    yield solved()
                if place != at:
                    at, done = place, 0
                block.append((doc, ids))
                held += len(ids) // width
        if block:
            yield solved()

    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    arrow = to_arrow_schema(_parse_datatype_string(SCHEMA))
    encoded = rows.select(F.col(ordered.SLICE).cast("int").alias("_slice"), "_order", "_tie", "doc_id", "text").mapInArrow(
        encode, "_slice int, _order bigint, _tie bigint, doc_id bigint, ids binary")
    parts = (rows.agg(F.max(ordered.SLICE)).first()[0] or 0) + 1
    placed = encoded.repartitionById(parts, F.col("_slice")).sortWithinPartitions("_slice", "_order", "_tie")
    return placed.select("_slice", "doc_id", "ids").mapInArrow(pack, SCHEMA)
