"""Row-wise steps and table-wide fills. Each factory returns a step for `df.transform(step)`."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from millrace.functions import clean
from millrace.operators.quantiles import median

Step = Callable[[DataFrame], DataFrame]


def chain(*steps: Step) -> Step:
    """One step that applies the given steps in order; the whole chain stays one logical plan."""

    def run(df: DataFrame) -> DataFrame:
        for step in steps:
            df = df.transform(step)
        return df

    return run


def select_existing(names: Sequence[str]) -> Step:
    """Keep the named columns; names the table lacks are ignored."""
    return lambda df: df.select(*[n for n in names if n in df.columns])


def where(condition: str | Column) -> Step:
    return lambda df: df.where(condition)


def between(column: str, low, high) -> Step:
    return lambda df: df.where(F.col(column).between(low, high))


def time_slice(column: str, first_day: str, last_day: str) -> Step:
    """Rows from the start of the first day through the end of the last day."""
    start = F.lit(first_day).cast("timestamp_ntz")
    stop = F.lit(last_day).cast("timestamp_ntz") + F.expr("interval 1 day")
    return lambda df: df.where((F.col(column) >= start) & (F.col(column) < stop))


def members(column: str, values: Sequence) -> Step:
    return lambda df: df.where(F.col(column).isin(list(values)))


def drop_missing(columns: Sequence[str]) -> Step:
    """Drop rows with NULL or NaN in any of the columns."""
    return lambda df: df.dropna(subset=list(columns))


def nan_as_null(df: DataFrame) -> DataFrame:
    """NaN to NULL in every floating-point column."""
    return df.select(*[
        clean.nan_to_null(f.name).alias(f.name) if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else F.col(f.name)
        for f in df.schema.fields])


def assign(**columns: Column) -> Step:
    return lambda df: df.withColumns(columns)


def drop(*names: str) -> Step:
    return lambda df: df.drop(*names)


def fill(values: Mapping[str, object]) -> Step:
    """Replace missing values (NULL or NaN) by a constant per column."""
    return lambda df: df.withColumns({c: F.coalesce(_present(df, c), F.lit(v)) for c, v in values.items()})


def fill_median(columns: Sequence[str]) -> Step:
    """Replace missing values by the column's exact median."""

    def step(df: DataFrame) -> DataFrame:
        found = median(df, columns)
        return df.withColumns({c: F.coalesce(_present(df, c), F.lit(found[c])) for c in columns})

    return step


def _present(df: DataFrame, column: str) -> Column:
    if isinstance(df.schema[column].dataType, (T.DoubleType, T.FloatType)):
        return clean.nan_to_null(column)
    return F.col(column)


def enforce_schema(schema: Mapping[str, str], domains: Mapping[str, Sequence[str]] | None = None) -> Step:
    """Cast the declared columns; a missing column or a value that does not fit fails the job.

    Whole-number targets reject fractions; columns with a domain keep only its values. Other columns pass through.
    """
    domains = domains or {}

    def target(name: str, dtype: str) -> Column:
        whole = dtype in ("tinyint", "smallint", "int", "bigint")
        column = clean.whole_number(name, dtype) if whole else F.col(name).cast(dtype)
        return clean.keep_domain(column, domains[name]) if name in domains else column

    return lambda df: df.withColumns({name: target(name, dtype) for name, dtype in schema.items()})


def apply_rows(out: str, function: Callable, dtype: str, *columns: str) -> Step:
    """A user function over columns as a new column: it gets pandas series and returns one, batch by batch through Arrow.

    For what column expressions cannot say; those stay in the JVM and are faster.
    """
    return lambda df: df.withColumn(out, F.pandas_udf(function, dtype)(*columns))


def split_target(df: DataFrame, target: str) -> tuple[list[str], str]:
    """Feature names and target name of one table; both stay in one DataFrame."""
    if target not in df.columns:
        raise ValueError(f"no column {target}")
    return [c for c in df.columns if c != target], target
