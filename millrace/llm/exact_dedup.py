"""Exact de-duplication that takes the frequent texts out of the shuffle.

Misra-Gries summaries of the digests are kept per batch stream and merged; what can be frequent is counted exactly, and these
verified winners (at most `counters` of them) are broadcast, so rows of a frequent text are decided where they are read. All
other digests have too few rows to overload a task and are grouped by an ordinary shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Window, functions as F

from millrace.llm.common import body
from millrace.session import materialise

COUNTERS = 1024  # a text with over 2 / COUNTERS of all rows is found; so many winners are broadcast at most


def _summaries(digests: DataFrame, counters: int) -> DataFrame:
    """Misra-Gries per task: `digest, seen` with seen a lower bound, and a row without digest holding the undercount."""

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        kept: dict = {}
        short = 0
        for batch in batches:
            values = batch.column(0).value_counts()
            for digest, n in zip(values.field("values").to_pylist(), values.field("counts").to_pylist()):
                kept[digest] = kept.get(digest, 0) + n
            if len(kept) > counters:  # subtract the size of the first counter that has to go from all
                cut = int(np.partition(np.fromiter(kept.values(), np.int64), len(kept) - counters - 1)[len(kept) - counters - 1])
                short += cut
                kept = {d: n - cut for d, n in kept.items() if n > cut}
        keys, counts = [*kept, None], [*kept.values(), short]
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(counts, pa.int64())], names=["digest", "seen"])

    return digests.select("_digest").mapInArrow(run, "digest string, seen bigint")


def winners(digests: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """The frequent digests with their exact group: `_digest, _size, _keep`; at most `counters` rows."""
    found = materialise(_summaries(digests, counters).groupBy("digest").agg(F.sum("seen").alias("seen")), "mg")
    rows = digests.count()
    least = 2 * rows / counters
    short = found.where("digest IS NULL").agg(F.sum("seen")).first()[0] or 0
    # Lower bounds add up to `rows` at most, so with short <= rows / counters no more than `counters` digests pass.
    able = found.where(F.col("digest").isNotNull() & (F.col("seen") + short >= least))
    hot = digests.join(F.broadcast(able.select(F.col("digest").alias("_digest"))), "_digest", "left_semi")
    return materialise(_groups(hot).where(F.col("_size") >= least), "mg-winners")


def _groups(digests: DataFrame) -> DataFrame:
    """Size and largest id per digest, summed before the shuffle."""
    by_id = F.struct(F.col("doc_id").isNotNull().alias("there"), F.col("doc_id").alias("id"))
    grouped = digests.groupBy("_digest").agg(F.count("*").alias("_size"), F.max(by_id).alias("_top"))
    return grouped.select("_digest", "_size", F.col("_top.id").alias("_keep"))


def decisions(docs: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """`doc_id, keep_id, group_size, kept, text_sha256`, one row for each row of `docs`.

    Texts are equal when their code points are (NULL is the empty text), judged by SHA-256. Of equal texts the largest doc_id
    stays (NULL below all others). Rows repeated with the same id and text are all marked kept; `deduplicated` leaves one.
    """
    digests = materialise(docs.select("doc_id", F.sha2(body().cast("binary"), 256).alias("_digest")), "digests")
    hot = winners(digests, counters)
    shipped = F.broadcast(hot)
    decided = digests.join(shipped, "_digest")
    rest = digests.join(F.broadcast(hot.select("_digest")), "_digest", "left_anti")
    group = Window.partitionBy("_digest")
    ordinary = rest.select("_digest", "doc_id", F.count("*").over(group).alias("_size"), F.max("doc_id").over(group).alias("_keep"))
    both = decided.select("_digest", "doc_id", "_size", "_keep").unionByName(ordinary)
    return both.select(
        "doc_id", F.col("_keep").alias("keep_id"), F.col("_size").alias("group_size"),
        F.col("doc_id").eqNullSafe(F.col("_keep")).alias("kept"), F.col("_digest").alias("text_sha256"))


def deduplicated(docs: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """The rows of `docs` that stay, all columns, one for each distinct text."""
    kept = decisions(docs, counters).where("kept").groupBy(F.col("doc_id").alias("of"), F.col("text_sha256").alias("digest")).agg(
        F.count("*").alias("ties"))
    row = F.struct(*[docs[c] for c in docs.columns]).alias("row")
    rows = docs.select(row, docs["doc_id"].alias("id"), F.sha2(body().cast("binary"), 256).alias("sha"))
    joined = rows.join(kept, F.col("id").eqNullSafe(F.col("of")) & (F.col("sha") == F.col("digest"))).select("row", "of", "digest", "ties")
    # Rows that repeat id and text: any one of them, chosen by its other columns.
    order = Window.partitionBy("of", "digest").orderBy(F.xxhash64("row"))
    repeated = joined.where("ties > 1").withColumn("nth", F.row_number().over(order)).where("nth = 1")
    return joined.where("ties = 1").select("row.*").unionByName(repeated.select("row.*"))
