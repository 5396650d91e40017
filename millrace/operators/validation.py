"""Declared checks over a table: all counts in one scan, examples only for checks that failed.

A `Suite` is a list of rules. `Suite.report(df)` is a lazy table (check, column, invalid_count, passed, examples);
`Suite.errors(df)` runs it and returns messages; `Suite.step()` fails a pipeline with one error that carries all
messages and otherwise passes the table through unchanged.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window, functions as F

from millrace.functions.clean import holds, matches_from_start
from millrace.functions.temporal import parse_date_or_null
from millrace.operators.profile import missing

EXAMPLES = 3


class ValidationError(Exception):
    """One error for all failed checks of a suite."""

    def __init__(self, errors: Sequence[str]):
        self.errors = list(errors)
        super().__init__(f"{len(self.errors)} failed check(s): " + "; ".join(self.errors))

    def report(self) -> dict:
        return {"is_valid": False, "error_count": len(self.errors), "errors": self.errors}


@dataclass(frozen=True)
class Rule:
    """`invalid(df)` flags bad rows (never NULL). `distinct` examples list each bad value once."""

    check: str
    column: str
    invalid: Callable[[DataFrame], Column]
    expectation: str
    distinct: bool = False


@dataclass(frozen=True)
class Suite:
    """Checks in the order they were added; every method returns a new suite."""

    schema_rules: tuple[tuple[str, str, object], ...] = ()
    rows: tuple[Rule, ...] = ()
    not_empty_rule: bool = False
    null_limits: tuple[tuple[str, float], ...] = ()
    unique_columns: tuple[str, ...] = ()
    references: tuple[tuple[str, DataFrame, str], ...] = field(default=(), compare=False)

    def _with(self, **changes) -> "Suite":
        return Suite(**{**self.__dict__, **changes})

    def _row(self, *args, **kw) -> "Suite":
        return self._with(rows=(*self.rows, Rule(*args, **kw)))

    # -- checks ---------------------------------------------------------------------------------------------------
    def not_empty(self) -> "Suite":
        return self._with(not_empty_rule=True)

    def columns_exist(self, columns: Sequence[str]) -> "Suite":
        return self._with(schema_rules=(*self.schema_rules, ("columns_exist", "", tuple(columns))))

    def dtype(self, column: str, expected: str) -> "Suite":
        """Skipped when the column is absent."""
        return self._with(schema_rules=(*self.schema_rules, ("dtype", column, expected)))

    def in_range(self, column: str, low: float, high: float) -> "Suite":
        """Inclusive; a missing value is invalid."""
        return self._row("range", column, lambda df: ~holds(df[column].between(low, high)), f"[{low}, {high}]")

    def no_nulls(self, column: str) -> "Suite":
        return self._row("no_nulls", column, lambda df: missing(df, column), "no missing values")

    def null_percentage(self, column: str, max_percent: float) -> "Suite":
        """Fails above, not at, the limit; an empty table passes."""
        return self._with(null_limits=(*self.null_limits, (column, max_percent)))

    def unique(self, column: str) -> "Suite":
        return self._with(unique_columns=(*self.unique_columns, column))

    def foreign_key(self, column: str, reference: DataFrame, ref_column: str) -> "Suite":
        return self._with(references=(*self.references, (column, reference, ref_column)))

    def allowed(self, column: str, values: Sequence) -> "Suite":
        """A missing value is invalid."""
        return self._row("allowed", column, lambda df: ~holds(df[column].isin(list(values))), f"one of {list(values)}",
                         distinct=True)

    def date_range(self, column: str, first: str, last: str) -> "Suite":
        """Inclusive; a missing or unreadable date is invalid."""

        def invalid(df: DataFrame) -> Column:
            text = df.schema[column].dataType.typeName() == "string"
            value = parse_date_or_null(column) if text else df[column].cast("timestamp_ntz")
            return ~holds(value.between(F.lit(first).cast("timestamp_ntz"), F.lit(last).cast("timestamp_ntz")))

        return self._row("date_range", column, invalid, f"[{first}, {last}]")

    def regex(self, column: str, pattern: str, description: str = "pattern") -> "Suite":
        """The pattern must match from the start; a missing value does not match."""
        return self._row("regex", column, lambda df: ~matches_from_start(column, pattern), description)

    def positive(self, column: str) -> "Suite":
        """A missing value is valid."""
        return self._row("positive", column, lambda df: holds(df[column] <= 0), "above 0")

    # -- evaluation -----------------------------------------------------------------------------------------------
    def schema_errors(self, df: DataFrame) -> list[str]:
        """Checks that need no job."""
        errors = []
        for check, column, expected in self.schema_rules:
            if check == "columns_exist":
                absent = [c for c in expected if c not in df.columns]
                if absent:
                    errors.append(f"missing columns {absent}")
            elif column in df.columns and df.schema[column].dataType.simpleString() != expected:
                errors.append(f"{column}: type {df.schema[column].dataType.simpleString()}, expected {expected}")
        return errors

    def counts(self, df: DataFrame) -> DataFrame:
        """(check, column, invalid_count, passed) of the data checks.

        Row checks share one scan. Uniqueness and foreign keys need their own shuffle, pre-aggregated per value.
        """
        rules = [r for r in self.rows if r.column in df.columns]
        aggregates = [F.count(F.lit(1)).alias("n")]
        aggregates += [F.count_if(r.invalid(df)).alias(f"r{i}") for i, r in enumerate(rules)]
        aggregates += [F.count_if(missing(df, c)).alias(f"p{i}") for i, (c, _) in enumerate(self.null_limits)]
        entries = []

        def entry(check, column, count, passed=None):
            passed = count == 0 if passed is None else passed
            entries.append(F.struct(F.lit(check).alias("check"), F.lit(column).alias("column"),
                                    count.alias("invalid_count"), passed.alias("passed")))

        zero = F.lit(0).cast("bigint")
        if self.not_empty_rule:
            entry("not_empty", "", F.when(F.col("n") == 0, F.lit(1).cast("bigint")).otherwise(zero))
        for i, r in enumerate(rules):
            entry(r.check, r.column, F.col(f"r{i}"))
        for i, (c, limit) in enumerate(self.null_limits):
            share = F.try_divide(F.col(f"p{i}") * F.lit(100.0), F.col("n"))
            entry("null_percentage", c, F.col(f"p{i}"), ~holds(share > F.lit(float(limit))))
        parts = []
        if entries:
            parts.append(df.agg(*aggregates).select(F.explode(F.array(*entries)).alias("e")).select("e.*"))
        for c in self.unique_columns:
            extra = df.groupBy(c).count().agg(F.coalesce(F.sum(F.col("count") - 1), zero).alias("k"))
            parts.append(extra.select(F.lit("unique").alias("check"), F.lit(c).alias("column"),
                                      F.col("k").alias("invalid_count"), (F.col("k") == 0).alias("passed")))
        for c, reference, ref_column in self.references:
            bad = self._orphans(df, c, reference, ref_column).agg(F.coalesce(F.sum("n"), zero).alias("k"))
            parts.append(bad.select(F.lit("foreign_key").alias("check"), F.lit(c).alias("column"),
                                    F.col("k").alias("invalid_count"), (F.col("k") == 0).alias("passed")))
        result = parts[0]
        for p in parts[1:]:
            result = result.unionByName(p)
        return result

    @staticmethod
    def _orphans(df: DataFrame, column: str, reference: DataFrame, ref_column: str) -> DataFrame:
        """(value, n) of values absent from the reference; rows are counted per value before the join."""
        values = df.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n"))
        keys = reference.select(F.col(ref_column).alias("_ref")).distinct()
        return values.join(keys, values["value"].eqNullSafe(keys["_ref"]), "left_anti")

    def examples(self, df: DataFrame, order: str) -> DataFrame:
        """(check, column, examples): the first bad values in `order`, at most three per check.

        The rank limit runs before the shuffle, so a check that fails everywhere sends three rows per task.
        """
        rules = [r for r in self.rows if r.column in df.columns]

        def top(tagged: DataFrame, sort: Column) -> DataFrame:
            w = Window.partitionBy("check", "column").orderBy(sort, F.col("value"))
            kept = tagged.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= EXAMPLES)
            listed = F.array_sort(F.collect_list(F.struct("_rn", "value")))
            return kept.groupBy("check", "column").agg(F.transform(listed, lambda s: s["value"]).alias("examples"))

        def failing(chosen: Sequence[Rule]) -> DataFrame:
            flagged = [F.when(r.invalid(df), F.struct(F.lit(r.check).alias("check"), F.lit(r.column).alias("column"),
                                                      F.coalesce(df[r.column].cast("string"), F.lit("NULL")).alias("value")))
                       for r in chosen]
            return df.select(F.col(order).alias("_order"), F.explode(F.array_compact(F.array(*flagged))).alias("e")).select(
                "_order", "e.*")

        plain, once = [r for r in rules if not r.distinct], [r for r in rules if r.distinct]
        parts = []
        if plain:
            parts.append(top(failing(plain), F.col("_order")))
        if once:
            first_seen = failing(once).groupBy("check", "column", "value").agg(F.min("_order").alias("_order"))
            parts.append(top(first_seen, F.col("_order")))
        for c, reference, ref_column in self.references:
            bad = self._orphans(df, c, reference, ref_column).select(
                F.lit("foreign_key").alias("check"), F.lit(c).alias("column"),
                F.coalesce(F.col("value").cast("string"), F.lit("NULL")).alias("value"))
            parts.append(top(bad, F.col("value")))
        result = parts[0]
        for p in parts[1:]:
            result = result.unionByName(p)
        return result

    def report(self, df: DataFrame, order: str) -> DataFrame:
        return self.counts(df).join(self.examples(df, order), ["check", "column"], "left")

    def errors(self, df: DataFrame, order: str | None = None) -> list[str]:
        errors = self.schema_errors(df)
        failed = self.counts(df).where(~F.col("passed")).collect()
        shown = {}
        if failed and order is not None and (self.rows or self.references):
            shown = {(r["check"], r["column"]): r["examples"] for r in self.examples(df, order).collect()}
        expected = {(r.check, r.column): r.expectation for r in self.rows}
        for r in failed:
            key = (r["check"], r["column"])
            text = f"{r['column'] or 'table'}: {r['check']} failed for {r['invalid_count']} value(s)"
            if key in expected:
                text += f", expected {expected[key]}"
            if key in shown:
                text += f", for example {shown[key]}"
            errors.append(text)
        return errors

    def validate(self, df: DataFrame, order: str | None = None) -> DataFrame:
        errors = self.errors(df, order)
        if errors:
            raise ValidationError(errors)
        return df

    def step(self, order: str | None = None) -> Callable[[DataFrame], DataFrame]:
        return lambda df: self.validate(df, order)
