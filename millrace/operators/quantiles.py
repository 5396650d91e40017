"""Exact quantiles of whole columns in bounded memory.

Spark's exact `percentile` keeps every distinct value of a column in one task. Here approximate quantiles give a
bracket around each wanted rank, one counting pass checks the bracket, and it is narrowed until few distinct values
are left; those are counted and the exact order statistics read off. Every pass is one scan with map-side combine
for all columns together; only scalars and the last bracket's few value counts reach the driver.
"""

from __future__ import annotations

import math
from bisect import bisect_right
from collections.abc import Sequence
from dataclasses import dataclass
from itertools import accumulate

from pyspark.sql import DataFrame, functions as F

# Largest number of distinct values per bracket that is counted value by value at the end.
FINAL_DISTINCT = 20_000
ACCURACY = 10_000
MAX_PASSES = 60


@dataclass
class _Bracket:
    """An interval [low, high] known to hold the values of the ranks first..last (zero-based)."""

    column: str
    first: int
    last: int
    low: float
    high: float
    below: int
    inside: int
    distinct: int


def exact_quantiles(
    df: DataFrame, columns: Sequence[str], probs: Sequence[float], final_distinct: int = FINAL_DISTINCT
) -> dict[str, list[float | None]]:
    """Quantiles with linear interpolation, missing values ignored: column -> one value per probability."""
    values = df.select(*[F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")).alias(c) for c in columns])
    stats = values.agg(
        *[f(F.col(c)).alias(f"{name}_{i}") for i, c in enumerate(columns)
          for name, f in (("n", F.count), ("lo", F.min), ("hi", F.max), ("d", F.approx_count_distinct))]
    ).first()
    brackets: dict[tuple[int, int], _Bracket] = {}
    for i, c in enumerate(columns):
        n = stats[f"n_{i}"]
        for j, p in enumerate(probs):
            if n:
                at = p * (n - 1)
                brackets[i, j] = _Bracket(c, math.floor(at), math.ceil(at), stats[f"lo_{i}"], stats[f"hi_{i}"], 0, n,
                                          stats[f"d_{i}"])
    for _ in range(MAX_PASSES):
        wide = [b for b in brackets.values() if b.low != b.high and b.distinct > max(final_distinct, 2)]
        if not wide:
            break
        stuck = _narrow(values, wide)
        if stuck:
            _step_over_edges(values, stuck)
    else:
        raise RuntimeError("quantile brackets did not settle")
    found = _read_off(values, list(brackets.values()))
    result: dict[str, list[float | None]] = {}
    for i, c in enumerate(columns):
        row = []
        for j, p in enumerate(probs):
            b = brackets.get((i, j))
            if b is None:
                row.append(None)
                continue
            low, high = found[id(b)]
            at = p * (stats[f"n_{i}"] - 1)
            row.append(low + (high - low) * (at - math.floor(at)))
        result[c] = row
    return result


def _by_span(brackets: list[_Bracket]) -> dict[tuple[str, float, float], list[_Bracket]]:
    """Brackets that currently cover the same interval of the same column; they share their aggregates."""
    spans: dict[tuple[str, float, float], list[_Bracket]] = {}
    for b in brackets:
        spans.setdefault((b.column, b.low, b.high), []).append(b)
    return spans


def _narrow(values: DataFrame, brackets: list[_Bracket]) -> list[_Bracket]:
    """Two scans: propose a tighter interval inside each bracket, then count whether it holds the wanted ranks.

    Returns the brackets that did not get smaller, which happens when both borders are very frequent values.
    """
    spans = list(_by_span(brackets).items())
    aggregates = []
    for i, ((column, low, high), members) in enumerate(spans):
        probs = []
        for b in members:
            # The approximation is exact while it keeps every value; beyond that its rank error is n / ACCURACY.
            margin = 2.0 / ACCURACY if b.inside > ACCURACY else 1.0 / b.inside
            probs += [max(0.0, (b.first - b.below) / b.inside - margin), min(1.0, (b.last - b.below + 1) / b.inside + margin)]
        held = F.when(F.col(column).between(low, high), F.col(column))
        aggregates.append(F.percentile_approx(held, probs, ACCURACY).alias(f"p_{i}"))
    row = values.agg(*aggregates).first()
    proposed = {id(b): (row[f"p_{i}"][2 * j], row[f"p_{i}"][2 * j + 1])
                for i, (_, members) in enumerate(spans) for j, b in enumerate(members)}
    checks = []
    for i, b in enumerate(brackets):
        c, (lo, hi) = F.col(b.column), proposed[id(b)]
        checks += [F.count_if(c < lo).alias(f"b_{i}"), F.count_if(c <= hi).alias(f"u_{i}")]
    counted = values.agg(*checks).first()
    stuck = []
    for i, b in enumerate(brackets):
        lo, hi = proposed[id(b)]
        below, upto = counted[f"b_{i}"], counted[f"u_{i}"]
        # A proposal that misses a rank on one side keeps the old border on that side.
        if below > b.first:
            lo, below = b.low, b.below
        if upto <= b.last:
            hi, upto = b.high, b.below + b.inside
        if lo == b.low and hi == b.high:
            stuck.append(b)
        # There cannot be more distinct values than rows; a few very frequent ones end in equal borders instead.
        b.low, b.high, b.below, b.inside, b.distinct = lo, hi, below, upto - below, min(b.distinct, upto - below)
    return stuck


def _step_over_edges(values: DataFrame, brackets: list[_Bracket]) -> None:
    """Count the border values themselves: a rank on a border is found, otherwise the border moves to the next value."""
    aggregates = []
    for i, b in enumerate(brackets):
        c = F.col(b.column)
        aggregates += [F.count_if(c == b.low).alias(f"nl_{i}"), F.count_if(c == b.high).alias(f"nh_{i}"),
                       F.min(F.when(c > b.low, c)).alias(f"up_{i}"), F.max(F.when(c < b.high, c)).alias(f"down_{i}")]
    row = values.agg(*aggregates).first()
    for i, b in enumerate(brackets):
        at_low, at_high, top = row[f"nl_{i}"], row[f"nh_{i}"], b.below + b.inside
        if b.last < b.below + at_low:
            b.high, b.inside, b.distinct = b.low, at_low, 1
        elif b.first >= top - at_high:
            b.low, b.below, b.inside, b.distinct = b.high, top - at_high, at_high, 1
        elif b.first < b.below + at_low and b.last >= top - at_high:
            b.distinct = 2  # neighbouring ranks on the two borders: nothing lies between
        else:
            if b.first >= b.below + at_low:
                b.low, b.below, b.inside = row[f"up_{i}"], b.below + at_low, b.inside - at_low
            if b.last < top - at_high:
                b.high, b.inside = row[f"down_{i}"], b.inside - at_high


def _read_off(values: DataFrame, brackets: list[_Bracket]) -> dict[int, tuple[float, float]]:
    """Count the few distinct values left in each bracket and walk to the wanted ranks."""
    done = {id(b): (b.low, b.high) for b in brackets if b.low == b.high}
    spans = list(_by_span([b for b in brackets if id(b) not in done]).items())
    if not spans:
        return done
    entries = [F.when(F.col(column).between(low, high), F.struct(F.lit(i).alias("b"), F.col(column).alias("v")))
               for i, ((column, low, high), _) in enumerate(spans)]
    held = F.array_compact(F.array(*entries))
    counts = values.select(F.explode(held).alias("e")).groupBy("e.b", "e.v").count().orderBy("b", "v").collect()
    by_span: dict[int, list] = {}
    for r in counts:
        by_span.setdefault(r["b"], []).append((r["v"], r["count"]))
    for i, (_, members) in enumerate(spans):
        values_up = [v for v, _ in by_span[i]]
        running = list(accumulate(n for _, n in by_span[i]))
        for b in members:
            done[id(b)] = (values_up[bisect_right(running, b.first - b.below)], values_up[bisect_right(running, b.last - b.below)])
    return done


def median(df: DataFrame, columns: Sequence[str]) -> dict[str, float | None]:
    return {c: v[0] for c, v in exact_quantiles(df, columns, [0.5]).items()}
