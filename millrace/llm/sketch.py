"""Document fingerprints: threshold-scaled sketches.

A fingerprint keeps every shingle hash below a fixed fraction of the hash range, so it grows with the text and any two can be
merged or compared: at a common threshold both hold all their hashes, whatever their lengths, which makes containment of a
short text in a long one as good an estimate as likeness of equals. Texts with fewer than FLOOR hashes below the fraction
keep their FLOOR smallest ones instead; their own largest hash is then the threshold up to which they are complete.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

from pyspark.sql import DataFrame, functions as F

from millrace.llm.common import body
from millrace.operators import ordered

WIDTH = 16  # code points in a shingle, a power of two; a shorter text is one shingle
SCALE = 64  # one of so many hashes is kept
FLOOR = 16
ROWS_PER_SLICE = 4_000  # documents that one task puts in order
LAST = (1 << 63) - 1  # where rows without an id are put


def hashes(text: str):
    """Sorted distinct 64-bit shingle hashes that the fingerprint of the text keeps."""
    import numpy as np

    codes = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.uint64)
    if not len(codes):
        return codes
    with np.errstate(over="ignore"):
        h = _scrambled(codes + np.uint64(1))
        span, factor = 1, np.uint64(0x9E3779B97F4A7C15)
        if len(codes) < WIDTH:
            total = np.uint64(len(codes))
            for value in h:
                total = total * factor + value
            h = np.array([total])
        else:
            while span < WIDTH:  # hashes of twice the width from two neighbours
                h = h[:-span] * factor + h[span:]
                span, factor = 2 * span, factor * factor + np.uint64(2 * span)
                factor |= np.uint64(1)
        h = _scrambled(h)
    kept = np.unique(h[h < np.uint64(2**64 // SCALE)])
    if len(kept) < FLOOR:
        kept = np.unique(h)[:FLOOR]
    return kept


def _scrambled(values):
    import numpy as np

    v = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    v = (v ^ (v >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return v ^ (v >> np.uint64(31))


def complete_to(kept) -> int:
    """The hash up to which a fingerprint lacks none of its text's."""
    least = 2**64 // SCALE
    if len(kept) < FLOOR:
        return 2**64 - 1
    return max(least - 1, int(kept[-1]))


def merged(a, b):
    """Fingerprint of the two texts' shingles together, from their fingerprints."""
    import numpy as np

    both = np.union1d(a, b)
    both = both[both <= np.uint64(min(complete_to(a), complete_to(b)))]
    below = int(np.searchsorted(both, np.uint64(2**64 // SCALE)))
    return both[:max(below, FLOOR)]


def likeness(a, b) -> float:
    """Estimated share of the smaller text's shingles that the other one has too; of two empty texts 1, of one 0."""
    import numpy as np

    if not len(a) or not len(b):
        return float(len(a) == len(b))
    limit = np.uint64(min(complete_to(a), complete_to(b)))
    a, b = a[:np.searchsorted(a, limit, "right")], b[:np.searchsorted(b, limit, "right")]
    least = min(len(a), len(b))
    return len(np.intersect1d(a, b, assume_unique=True)) / least if least else 0.0


def written(kept) -> str:
    """Fingerprint as text: base64 of the little-endian hashes."""
    return base64.b64encode(kept.astype("<u8").tobytes()).decode()


def with_next(docs: DataFrame) -> DataFrame:
    """Rows with their follower, in slices: `_slice, _guest, doc_id, text`, each slice in one task and sorted.

    Order is by doc_id (NULL last), rows of one id by text. Each slice also gets, as guests after its own rows, the first rows
    of the next slice (the last one those of the first), so no task must see another's rows. The text is shuffled once.
    """
    rows = docs.select(F.coalesce(F.col("doc_id").cast("bigint"), F.lit(LAST)).alias("_order"), "doc_id", body().alias("text"))
    sliced = ordered.sliced(rows, "_order", rows_per_slice=ROWS_PER_SLICE)
    # At most one row for each slice, of which there is a fixed number.
    firsts = sorted(tuple(r) for r in sliced.groupBy(ordered.SLICE).agg(F.min("_order")).collect())
    spark = docs.sparkSession
    guests = spark.createDataFrame([(first, firsts[i - 1][0]) for i, (_, first) in enumerate(firsts)], "_first bigint, _host int")
    placed = sliced.join(F.broadcast(guests), F.col("_order") == F.col("_first"), "left")
    own = F.struct(F.col(ordered.SLICE).cast("int").alias("_slice"), F.lit(0).alias("_guest"))
    guest = F.struct(F.col("_host").alias("_slice"), F.lit(1).alias("_guest"))
    places = F.explode(F.when(F.col("_host").isNull(), F.array(own)).otherwise(F.array(own, guest)))
    spread = placed.select(places.alias("_at"), "_order", "doc_id", "text").select("_at.*", "_order", "doc_id", "text")
    parts = max((s for s, _ in firsts), default=0) + 1
    return spread.repartitionById(parts, F.col("_slice")).sortWithinPartitions("_slice", "_guest", "_order", "text").drop("_order")


SCHEMA = ("doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
          "near_edited double, near_next double")


def fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprint of every whole text and of its edited text, and how like the first is to the second and to the next text.

    The edited text has its last floor(n / 2) code points replaced by the first as many of the following document, the first
    document following the last. NULL is the empty text; an empty text has the empty fingerprint. Rows that repeat an id follow
    each other by text. One row per row of `docs`; other columns are not looked at.
    """

    def run(batches: Iterator) -> Iterator:
        import hashlib

        import pyarrow as pa

        def one(held: tuple, following: str, after) -> tuple:
            doc, text, kept = held
            n = len(text)
            half = n // 2
            edited = text[:n - half] + following[:half]
            changed = hashes(edited)
            return (doc, n, hashlib.sha256(edited.encode()).hexdigest(), written(kept), written(changed), likeness(kept, changed),
                    likeness(kept, after))

        held, at = None, None
        for batch in batches:
            out: list = []
            for place, guest, doc, text in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if at is not None and place != at:
                    held = None
                at = place
                if held is None and guest:
                    continue
                kept = hashes(text)
                if held is not None:
                    out.append(one(held, text, kept))
                held = None if guest else (doc, text, kept)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*out), arrow)], schema=arrow)

    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    arrow = to_arrow_schema(_parse_datatype_string(SCHEMA))
    return with_next(docs).select("_slice", "_guest", "doc_id", "text").mapInArrow(run, SCHEMA)
