"""Scans over a whole table in one global order, without moving the table into one task.

A window without a partition key puts every row into a single task. Here the order is cut into slices at
approximate quantiles of the order column; rows are windowed inside their slice, and what a slice must know
about all earlier ones (a sum, a last value, a row count) is aggregated per slice with map-side combine, scanned
over the small slice table and joined back. An order value holding more than one slice's share of rows is cut
again by the tie-break id. Slice borders only steer the layout: any borders give the same result.
"""

from __future__ import annotations

import json
import math
from collections import Counter
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from millrace.operators.joins import join_small
from millrace.session import materialise

ROWS_PER_SLICE = 2_000_000
MAX_SLICES = 2_000
SLICE = "_slice"


def sortable(df: DataFrame, name: str) -> Column:
    """The order column as a number that sorts the same way."""
    dtype = df.schema[name].dataType
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(F.col(name).cast("timestamp"))
    if isinstance(dtype, T.DateType):
        return F.unix_date(F.col(name)).cast("bigint")
    if isinstance(dtype, T.IntegralType):
        return F.col(name).cast("bigint")
    return F.col(name).cast("double")


def _grid(column: str) -> Column:
    """Evenly spaced approximate quantiles, MAX_SLICES steps."""
    probs = ", ".join(f"{i / MAX_SLICES}D" for i in range(MAX_SLICES + 1))
    return F.expr(f"percentile_approx({column}, array({probs}), 10000)").alias("grid")


def _thin(grid: list, parts: int) -> list:
    """parts-1 inner cut points taken evenly from a fine quantile grid."""
    return [grid[min(len(grid) - 1, round(i * (len(grid) - 1) / parts))] for i in range(1, parts)]


def _cut_points(df: DataFrame, order: str, tie: str | None, rows_per_slice: int) -> list[tuple]:
    key = sortable(df, order)
    row = df.select(key.alias("k")).agg(F.count("k").alias("n"), _grid("k")).first()
    parts = min(MAX_SLICES, math.ceil(row["n"] / rows_per_slice)) if row["n"] else 1
    if parts <= 1:
        return []
    repeats = Counter(_thin(row["grid"], parts))
    hot = [value for value, times in repeats.items() if times > 1]
    cuts = [(value, None) for value in repeats]
    if hot and tie is not None:
        found = (
            df.where(key.isin(hot)).select(key.alias("k"), F.col(tie).cast("bigint").alias("t"))
            .groupBy("k").agg(_grid("t")).collect()
        )
        for r in found:
            cuts += [(r["k"], t) for t in sorted(set(_thin(r["grid"], repeats[r["k"]] + 1)))]
    return sorted(cuts, key=lambda c: (c[0], -math.inf if c[1] is None else c[1]))


def _slice_number(df: DataFrame, order: str, tie: str | None, cuts: list[tuple]) -> Column:
    """How many cut points are at or below the row; beyond 64 cuts, first a coarse step, then a fine one."""
    if not cuts:
        return F.lit(0)
    key = sortable(df, order)
    key_type = "bigint" if isinstance(cuts[0][0], int) else "double"
    lowest = -(2**63)
    if any(t is not None for _, t in cuts):
        position = F.struct(key.cast(key_type).alias("k"), F.col(tie).cast("bigint").alias("t"))
        rows, item_type = [{"k": k, "t": lowest if t is None else t} for k, t in cuts], f"struct<k:{key_type},t:bigint>"
    else:
        position, rows, item_type = key.cast(key_type), [k for k, _ in cuts], key_type

    def literal(items):
        return F.from_json(F.lit(json.dumps(items)), f"array<{item_type}>")

    def at_or_below(array):
        return F.size(F.filter(array, lambda c: c <= position))

    if len(rows) <= 64:
        return at_or_below(literal(rows))
    step = math.isqrt(len(rows))
    coarse = at_or_below(literal(rows[::step]))
    start = (F.greatest(coarse, F.lit(1)) - 1) * step
    return start + at_or_below(F.slice(literal(rows), start + 1, F.lit(step)))


def sliced(df: DataFrame, order: str, tie: str | None = None, rows_per_slice: int = ROWS_PER_SLICE) -> DataFrame:
    """Add the slice number. `order` must not be NULL; `(order, tie)` must be unique; `tie` is a whole number."""
    return df.withColumn(SLICE, _slice_number(df, order, tie, _cut_points(df, order, tie, rows_per_slice)))


def _order_columns(order: str, tie: str | None) -> list[str]:
    return [order] if tie is None else [order, tie]


def _join_carry(df: DataFrame, carry: DataFrame, by: Sequence[str]) -> DataFrame:
    # Without further keys the carry table has at most one row per slice, a fixed small bound.
    return join_small(df, carry, [*by, SLICE]) if by else df.join(F.broadcast(carry), SLICE, "left")


def running_sums(
    rows: DataFrame, totals: DataFrame, order: Sequence[str], sums: dict[str, str | Column], by: Sequence[str] = ()
) -> DataFrame:
    """Running sums over sliced rows, given the same sums per slice.

    `totals` may come from a cheaper table than `rows`, for example from rows not yet grouped by the order column.
    """
    inner = Window.partitionBy(*by, SLICE).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    outer = Window.partitionBy(*by).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    carry = totals.groupBy(*by, SLICE).agg(*[F.sum(c).alias(f"_t_{o}") for o, c in sums.items()]).select(
        *by, SLICE, *[F.coalesce(F.sum(f"_t_{o}").over(outer), F.lit(0)).alias(f"_c_{o}") for o in sums])
    running = rows.select("*", *[F.sum(c).over(inner).alias(f"_r_{o}") for o, c in sums.items()])
    kept = [c for c in rows.columns if c != SLICE]
    return _join_carry(running, carry, by).select(*kept, *[(F.col(f"_r_{o}") + F.col(f"_c_{o}")).alias(o) for o in sums])


def prefix_sums(
    df: DataFrame, order: str, sums: dict[str, str | Column], tie: str | None = None, by: Sequence[str] = (),
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """Running sums (own row included) of several columns in the global order, separately for each `by` key."""
    base = sliced(df, order, tie, rows_per_slice)
    return running_sums(base, base, _order_columns(order, tie), sums, by)


def row_index(
    df: DataFrame, order: str, tie: str | None = None, out: str = "row_index", rows_per_slice: int = ROWS_PER_SLICE
) -> DataFrame:
    """Zero-based position of each row in the global order."""
    counted = prefix_sums(df, order, {out: F.lit(1).cast("bigint")}, tie, rows_per_slice=rows_per_slice)
    return counted.withColumn(out, F.col(out) - 1)


def resetting_sum(
    df: DataFrame, value: str, order: str, tie: str | None = None, threshold: float = 0.3, out: str = "running",
    by: Sequence[str] = (), rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """Running total that falls to zero at, and restarts after, every value below the threshold.

    A missing value makes the total missing until the next reset.
    """
    base = sliced(df, order, tie, rows_per_slice).withColumn("_v", F.coalesce(F.col(value).cast("double"), F.lit(float("nan"))))
    cols = _order_columns(order, tie)
    here = F.struct(*cols)
    resets = F.col("_v") < F.lit(threshold)
    added = F.when(resets, F.lit(0.0)).otherwise(F.col("_v"))

    last = base.groupBy(*by, SLICE).agg(F.max(F.when(resets, here)).alias("_last"))
    tails = (
        _join_carry(base, last, by)
        .groupBy(*by, SLICE)
        .agg(
            F.sum(F.when(F.col("_last").isNull() | (here > F.col("_last")), F.col("_v")).otherwise(F.lit(0.0))).alias("_tail"),
            F.max(F.col("_last").isNotNull().cast("int")).alias("_has"),
        )
    )
    upto = Window.partitionBy(*by).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, 0)
    run = Window.partitionBy(*by, "_seg").orderBy(SLICE).rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy(*by).orderBy(SLICE)
    carry = (
        tails.withColumn("_seg", F.sum("_has").over(upto))
        .withColumn("_run", F.sum("_tail").over(run))
        .select(*by, SLICE, F.coalesce(F.lag("_run").over(before), F.lit(0.0)).alias("_carry"))
    )
    inner = Window.partitionBy(*by, SLICE).orderBy(*cols).rowsBetween(Window.unboundedPreceding, 0)
    segment = Window.partitionBy(*by, SLICE, "_seg").orderBy(*cols).rowsBetween(Window.unboundedPreceding, 0)
    local = base.withColumn("_seg", F.sum(resets.cast("int")).over(inner)).withColumn("_local", F.sum(added).over(segment))
    total = F.col("_local") + F.when(F.col("_seg") == 0, F.col("_carry")).otherwise(F.lit(0.0))
    return _join_carry(local, carry, by).select(*df.columns, F.nanvl(total, F.lit(None).cast("double")).alias(out))


def forward_fill(
    df: DataFrame, columns: Sequence[str], order: str, tie: str | None = None, by: Sequence[str] = (),
    fill_start: bool = False, rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """Replace missing values by the last earlier one; with `fill_start` the leading gap takes the first later one."""
    base = sliced(df, order, tie, rows_per_slice)
    cols = _order_columns(order, tie)
    here = F.struct(*cols)
    lasts = base.groupBy(*by, SLICE).agg(
        *[F.max_by(c, F.when(F.col(c).isNotNull(), here)).alias(f"_l_{c}") for c in columns],
        *[F.min_by(c, F.when(F.col(c).isNotNull(), here)).alias(f"_f_{c}") for c in columns])
    past = Window.partitionBy(*by).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy(*by).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    carry = lasts.select(
        *by, SLICE,
        *[F.last(f"_l_{c}", ignorenulls=True).over(past).alias(f"_p_{c}") for c in columns],
        *[F.first(f"_f_{c}", ignorenulls=True).over(every).alias(f"_n_{c}") for c in columns])
    inner = Window.partitionBy(*by, SLICE).orderBy(*cols).rowsBetween(Window.unboundedPreceding, 0)
    filled = base.select("*", *[F.last(c, ignorenulls=True).over(inner).alias(f"_w_{c}") for c in columns])
    joined = _join_carry(filled, carry, by)

    def value(c):
        parts = [F.col(f"_w_{c}"), F.col(f"_p_{c}")] + ([F.col(f"_n_{c}")] if fill_start else [])
        return F.coalesce(*parts).alias(c)

    return joined.select(*[value(c) if c in columns else F.col(c) for c in df.columns])


def scan_by_key(df: DataFrame, by: Sequence[str], order: Sequence[str], function, schema: str | T.StructType) -> DataFrame:
    """A user scan with state: `function` gets the rows of one key as a sorted pandas table and returns one.

    The rows of a key meet in one task; without a key, or with a very hot one, use `scan_in_slices` or the scans above.
    """
    cols = list(order)

    def each(rows):
        return function(rows.sort_values(cols, kind="stable").reset_index(drop=True))

    return df.groupBy(*by).applyInPandas(each, schema)


def scan_in_slices(
    df: DataFrame, by: Sequence[str], order: str, tie: str | None, summary, combine, function, schema: str | T.StructType,
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """A user scan with state, over keys of any size: no user function gets more of a key than a slice.

    `summary(rows)` tells in bytes what a slice of a key, a sorted pandas table, does to the state; `combine(state, summary)` gives
    the state after it, from the state before it (None at a key's start); `function(rows, state)` gets the slice with the state
    before it and returns the result rows. Keys of up to `rows_per_slice` rows are one slice and need no state: they are handed over
    whole, once. Only larger keys are cut, every `rows_per_slice` of their own rows: summaries are made for all their slices at
    once, combined in order for each key (a few bytes a slice), and handed to their slices. So the calls are as many as the keys
    and the slices' worth of rows, whatever the order of the rows. Rows must have an order value; a missing key is a key.
    """
    cols, columns = _order_columns(order, tie), df.columns
    names = [f"_k{i}" for i in range(len(by))]
    renamed = [F.col(c).alias(n) for c, n in zip(by, names)]
    sizes = df.groupBy(*renamed).agg(F.count(F.lit(1)).alias("_n"))
    large = materialise(sizes.where(F.col("_n") > rows_per_slice).select(*names, F.lit(True).alias("_large")), "scan-large")
    keyed = join_small(df.select(*columns, *renamed), large, names)
    small = keyed.where(F.col("_large").isNull()).drop("_large")

    def sorted_rows(part):
        return part[columns].sort_values(cols, kind="stable").reset_index(drop=True)

    done = small.groupBy(*names).applyInPandas(lambda part: function(sorted_rows(part), None), schema)
    if large.isEmpty():
        return done
    # The position of a row in its key is counted in wide slices, which no user function sees.
    wide = min(ROWS_PER_SLICE, 100 * rows_per_slice)
    counted = prefix_sums(keyed.where("_large").drop("_large"), order, {"_upto": F.lit(1).cast("bigint")}, tie, names, wide)
    cut = materialise(counted.withColumn(SLICE, F.expr(f"(_upto - 1) div {rows_per_slice}").cast("int")).drop("_upto"), "scan-slices")
    key = [*names, SLICE]

    def summarise(part):
        return part[key].iloc[:1].reset_index(drop=True).assign(_does=[summary(sorted_rows(part))])

    fields = [cut.schema[n] for n in key]
    does = cut.groupBy(*key).applyInPandas(summarise, T.StructType([*fields, T.StructField("_does", T.BinaryType())]))

    def chain(part):
        part = part.sort_values(SLICE).reset_index(drop=True)
        state, states = None, []
        for one in part["_does"]:
            states.append(state)
            state = combine(state, one)
        return part.assign(_state=states)[[*key, "_state"]]

    states = does.groupBy(*names).applyInPandas(chain, T.StructType([*fields, T.StructField("_state", T.BinaryType())]))
    states = materialise(states, "scan-states")

    def apply(rows, state):
        return function(sorted_rows(rows), state["_state"].iloc[0])

    sliced_rows = cut.groupBy(*key).cogroup(states.groupBy(*key)).applyInPandas(apply, schema)
    return done.unionByName(sliced_rows)


def centered_mean(
    df: DataFrame, columns: dict[str, str], order: str, tie: str | None = None, half: int = 3,
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """Mean over the row, `half` rows before and `half` after, missing values skipped; `columns` maps output to input.

    Rows are numbered, cut into blocks of equal length, and each block also receives the `half` rows beyond its borders.
    """
    if rows_per_slice <= 2 * half:
        raise ValueError("a block must be longer than the window")
    numbered = row_index(df, order, tie, "_pos", rows_per_slice)

    def block(offset: int) -> Column:
        return F.floor((F.col("_pos") + offset) / F.lit(rows_per_slice)).cast("bigint")

    copies = F.explode(F.array_distinct(F.array(block(-half), block(0), block(half))))
    spread = numbered.withColumn("_block", copies)
    w = Window.partitionBy("_block").orderBy("_pos").rowsBetween(-half, half)
    return (
        spread.select("*", *[F.avg(c).over(w).alias(o) for o, c in columns.items()])
        .where(F.col("_block") == block(0))
        .select(*df.columns, *columns)
    )
