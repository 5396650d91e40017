"""Mixing sources to target weights, with DataFrame functions only.

Token totals are aggregated per source, from which each source's repetition rate follows; every document is then emitted
floor(rate) times, plus once more if a coin seeded by its id falls below the fraction. No source is ever gathered: the one
wide step is the aggregation, which sums before it shuffles.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from millrace.llm.common import WORD, body, key_fraction
from millrace.session import materialise

BROADCAST_SOURCES = 10_000  # rows of the source table (a name and four numbers) that are shipped to every task
SALT = "mix"


def words_in(column: str = "text") -> Column:
    """How many words the text has; NULL has none."""
    return F.regexp_count(body(column), F.lit(WORD)).cast("bigint")


def _positions(sources: DataFrame) -> DataFrame:
    """Add `position`, the rank by code point with NULL last, without sorting the table in one task."""
    context = sources.sparkSession.sparkContext
    ranges = materialise(
        sources.repartitionByRange(context.defaultParallelism, F.col("source").isNull(), F.col("source"))
        .sortWithinPartitions(F.col("source").isNull(), F.col("source"))
        .withColumn("_row", F.monotonically_increasing_id())
        .withColumn("_part", F.shiftright("_row", 33)), "mix-sources")
    # One row for each range: as many as the cluster has cores, whatever the table holds.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranges.groupBy("_part").count().select("_part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_start"))
    inside = F.col("_row").bitwiseAND(F.lit((1 << 33) - 1))
    return ranges.join(F.broadcast(starts), "_part").withColumn("position", inside + F.col("_start")).drop("_row", "_part", "_start")


def targets(
    docs: DataFrame, weights: Sequence[int] = (5, 2, 1), share: tuple[int, int] = (3, 2), ceiling: int = 2
) -> DataFrame:
    """One row per source: `source, source_size, target, rate`.

    Sources in code-point order (NULL is a source of its own, last) weigh `weights`, repeated. Together they get share[0] /
    share[1] of all words; none gets more than `ceiling` times its own, and what is left over is shared again by weight. The
    rate of a source without words is 1. An empty table gives no rows.
    """
    times, per = share
    sizes = docs.groupBy("source").agg(F.sum(words_in()).alias("source_size"))
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("position") % len(weights) + 1).cast("int"))
    sources = materialise(_positions(sizes).withColumn("weight", weight.cast("bigint")), "mix-weights")
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    # Whole numbers until the last division: `spare` and the limits are in units of 1 / per words.
    level = None
    full = F.lit(False)
    while True:
        got = sources.where(~full).agg(F.sum("weight"), F.count("*")).first()
        taken = sources.where(full).agg(F.sum("source_size")).first()[0] or 0
        spare, open_weight = times * total - per * ceiling * taken, got[0] or 0
        reached = (spare, open_weight)
        if reached == level or not open_weight:
            break
        level = reached
        full = F.lit(spare) * F.col("weight") >= F.lit(per * ceiling) * F.col("source_size") * F.lit(open_weight)
    spare, open_weight = level or (0, 1)
    part = (F.lit(spare).cast("bigint") * F.col("weight")).cast("double") / F.lit(float(per * open_weight))
    target = F.round(F.least(part, F.lit(float(ceiling)) * F.col("source_size")), 6)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(1.0))
    return sources.select("source", "source_size", target.alias("target")).withColumn("rate", rate)


def mixed(docs: DataFrame, **options) -> DataFrame:
    """Every document once: `row` (all its columns), `source_size, target, copies`; copies is how often the mix takes it.

    The coin depends on doc_id alone, so repeated rows of one id share it and reruns agree; a NULL id counts as one id.
    """
    by_source = targets(docs, **options).withColumnRenamed("source", "of")
    if by_source.count() <= BROADCAST_SOURCES:
        by_source = F.broadcast(by_source)
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"))
    whole = F.floor("rate")
    coin = (key_fraction("row.doc_id", SALT) < F.col("rate") - whole).cast("int")
    return rows.join(by_source, F.col("row.source").eqNullSafe(F.col("of"))).select(
        "row", "source_size", "target", (whole + coin).cast("int").alias("copies"))


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: rows of `docs`, each as often as its source's rate asks for."""
    taken = mixed(docs, **options).where("copies > 0")
    return taken.select("row", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("row.*")
