"""Date and time expressions. Naive timestamps stay `timestamp_ntz`; the session time zone is UTC."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from millrace.functions.clean import as_column

# The date spellings met in the data, month before day where ambiguous.
DATE_FORMATS = ["yyyy-MM-dd", "MM/dd/yyyy", "yyyy.MM.dd", "dd-MMM-yyyy"]


def parse_date_or_null(c: str | Column, formats: Sequence[str] = DATE_FORMATS) -> Column:
    """First format that fits, NULL when none does."""
    c = as_column(c)
    return F.coalesce(*[F.try_to_timestamp(c, F.lit(f)).cast("timestamp_ntz") for f in formats])


def parse_date(c: str | Column, formats: Sequence[str] = DATE_FORMATS) -> Column:
    """First format that fits; a text that fits none fails the job."""
    c = as_column(c)
    parsed = parse_date_or_null(c, formats)
    failure = F.raise_error(F.concat(F.lit("unknown date format: "), c)).cast("timestamp_ntz")
    return F.when(c.isNull() | parsed.isNotNull(), parsed).otherwise(failure)


def date_parts(c: str | Column) -> list[Column]:
    c = as_column(c)
    return [
        F.year(c).alias("year"),
        F.month(c).alias("month"),
        F.dayofmonth(c).alias("day"),
        F.hour(c).alias("hour"),
    ]


def plus_days(c: str | Column, days: int) -> Column:
    """A fixed duration."""
    return as_column(c) + F.expr(f"interval {int(days)} days")


def plus_months(c: str | Column, months: int) -> Column:
    """Calendar months: clipped to the month's end, time of day kept (`add_months` would drop it)."""
    return as_column(c) + F.expr(f"interval {int(months)} months")


def whole_days_between(start: Column, end: str | Column) -> Column:
    """Whole elapsed days (floor of the duration, not a difference of calendar dates)."""
    return F.floor((F.unix_micros(as_column(end).cast("timestamp")) - F.unix_micros(start.cast("timestamp")))
                   / F.lit(86_400_000_000).cast("double")).cast("bigint")


def as_utc(c: str | Column) -> Column:
    """Attach UTC to a naive timestamp: the result is an instant (the session time zone is UTC)."""
    return as_column(c).cast("timestamp")


def wall_clock(c: str | Column, zone: str) -> Column:
    """Wall clock of a naive UTC timestamp in another zone."""
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), as_column(c).cast("timestamp_ntz"))


def day_month(c: str | Column) -> Column:
    return F.date_format(as_column(c), "dd-MM")


def on_common_year(day_month_text: str | Column, year: int = 1900) -> Column:
    """A dd-MM text as a date of one non-leap year; days that year lacks (29-02) become NULL."""
    text = as_column(day_month_text)
    iso = F.concat_ws("-", F.lit(str(year)), F.substring(text, 4, 2), F.substring(text, 1, 2))
    return F.try_to_timestamp(iso, F.lit("yyyy-MM-dd")).cast("date")
