"""Calendar jobs: dense resampling, day-of-year climatology, continuity audit."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from millrace.functions.temporal import day_month, on_common_year
from millrace.operators.profile import numbered
from millrace.operators.ordered import centered_mean

# Resampling frequencies and their calendar unit.
FREQUENCIES = {"D": "day", "W": "week", "M": "month", "Q": "quarter", "Y": "year"}
# Climate stations.
STATION_IDS = [96741, 96745, 96747]

_STEP = {"D": "interval 1 day", "W": "interval 7 days", "M": "interval 1 month", "Q": "interval 3 months",
         "Y": "interval 1 year"}


def _bin_start(c: str | Column, freq: str) -> Column:
    return F.date_trunc(FREQUENCIES[freq], c).cast("timestamp_ntz")


def _bin_label(c: Column, freq: str) -> Column:
    """Days are labelled by their start, longer periods by their last day (weeks end on Sunday)."""
    if freq == "D":
        return c
    return (c + F.expr(_STEP[freq])) - F.expr("interval 1 day")


def resample(df: DataFrame, ts: str, value: str, freq: str = "D") -> DataFrame:
    """Statistics per calendar bin, with a row for every bin between the first and the last.

    An empty bin has sum 0 and count 0, its other statistics are NULL. The spine is built from the aggregated bins,
    so its size is the number of calendar bins, not of rows.
    """
    bins = df.groupBy(_bin_start(ts, freq).alias("_bin")).agg(
        F.avg(value).alias(f"{value}_mean"), F.sum(value).alias(f"{value}_sum"), F.min(value).alias(f"{value}_min"),
        F.max(value).alias(f"{value}_max"), F.count(value).alias(f"{value}_count"))
    bins = bins.where("_bin is not null")
    spine = bins.agg(F.min("_bin").alias("a"), F.max("_bin").alias("b")).where("a is not null").select(
        F.explode(F.sequence("a", "b", F.expr(_STEP[freq]))).alias("_bin"))
    return spine.join(bins, "_bin", "left").select(
        _bin_label(F.col("_bin"), freq).alias(ts), f"{value}_mean",
        F.coalesce(f"{value}_sum", F.lit(0.0)).alias(f"{value}_sum"), f"{value}_min", f"{value}_max",
        F.coalesce(f"{value}_count", F.lit(0)).alias(f"{value}_count"))


def date_range(spark, start: str, end: str | None = None, periods: int | None = None, freq: str = "6 hours") -> DataFrame:
    """Evenly spaced timestamps from `start` through `end`, or `periods` of them: one column `timestamp`."""
    first = f"timestamp_ntz'{start}'"
    at = F.expr(f"{first} + id * interval {freq}").alias("timestamp")
    if periods is not None:
        return spark.range(periods).select(at)
    # No month is shorter than nine tenths of any other: so many steps reach the end, and what is beyond is left out.
    span, step = spark.range(1).select(
        F.expr(f"timestampdiff(MICROSECOND, {first}, timestamp_ntz'{end}')"),
        F.expr(f"timestampdiff(MICROSECOND, {first}, {first} + interval {freq})")).first()
    if step <= 0:
        raise ValueError("the step must lead forward")
    steps = 0 if span < 0 else span * 10 // (step * 9) + 2
    return spark.range(steps).select(at).where(F.col("timestamp") <= F.expr(f"timestamp_ntz'{end}'"))


def rolling_climatology(daily: DataFrame, values: Sequence[str], key: str = "DayMonth", half: int = 3) -> DataFrame:
    """Day-month means in calendar order with a centered rolling mean; days a common year lacks are dropped.

    The input has at most one row per day of the year.
    """
    dated = daily.withColumn("plot_date", on_common_year(key)).where("plot_date is not null")
    columns = {f"{v}_{2 * half + 1}d_rolling_mean": v for v in values}
    return centered_mean(dated, columns, "plot_date", half=half)


def climatology(df: DataFrame, date: str, values: Sequence[str], keep: Column | None = None) -> DataFrame:
    """Filter stations, average each calendar day over all years, then smooth over a week."""
    rows = df if keep is None else df.where(keep)
    daily = rows.groupBy(day_month(date).alias("DayMonth")).agg(*[F.avg(v).alias(v) for v in values])
    return rolling_climatology(daily, values)


def observed_days(df: DataFrame, date: str, by: Sequence[str] = ()) -> DataFrame:
    return df.where(F.col(date).isNotNull()).groupBy(*by, F.col(date).cast("date").alias("day")).agg(
        F.count(F.lit(1)).alias("n"))


def expected_days(days: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Every day between the first and the last observed one, per group."""
    span = days.groupBy(*by).agg(F.min("day").alias("a"), F.max("day").alias("b")).where("a is not null")
    return span.select(*by, F.explode(F.sequence("a", "b", F.expr("interval 1 day"))).alias("day"))


def missing_days(df: DataFrame, date: str, by: Sequence[str] = ()) -> DataFrame:
    days = observed_days(df, date, by)
    return expected_days(days, by).join(days, [*by, "day"], "left_anti")


def duplicate_days(df: DataFrame, date: str, by: Sequence[str] = ()) -> DataFrame:
    """Every occurrence of a day after its first one."""
    extra = observed_days(df, date, by).where("n > 1")
    return numbered(extra.withColumn("n", F.col("n") - 1), "n", "repeat").select(*by, "day", "repeat")


def continuity_report(df: DataFrame, date: str, by: Sequence[str] = ()) -> DataFrame:
    """Per group: total and expected rows, missing days, duplicate rows, and whether there is one row for each day.

    One shuffle of the rows (already reduced to days); the spine meets only the reduced table.
    """
    days = observed_days(df, date, by)
    report = days.groupBy(*by).agg(
        F.sum("n").alias("total_rows"),
        (F.datediff(F.max("day"), F.min("day")) + 1).cast("bigint").alias("expected_rows"),
        F.count(F.lit(1)).alias("_days"))
    missing = F.col("expected_rows") - F.col("_days")
    duplicates = F.col("total_rows") - F.col("_days")
    return report.select(*by, "total_rows", "expected_rows", missing.alias("missing_days"),
                         duplicates.alias("duplicate_rows"), ((missing == 0) & (duplicates == 0)).alias("is_continuous"))
