"""Pipeline observability: what each step did to the table, measured inside the one job that writes the result.

Every step's input and output carry an `observe()` node, so row counts, numeric statistics and cardinalities come
with the final action instead of a job per step. An observe node stops filters from being pushed into the scan: put
source filters before the first observed step.
"""

from __future__ import annotations

import logging
import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, Row, SparkSession, functions as F

from millrace.operators.profile import numeric_columns

DRIFT_LIMIT = 0.3
log = logging.getLogger("millrace.pipeline")


@dataclass
class _Point:
    """One measured place between two steps."""

    observation: Observation
    numeric: list[str]
    counted: list[str]
    types: dict[str, str]
    values: dict = field(default_factory=dict)


def failure_text(what: str, cause: Exception) -> str:
    """The one wording of failures, in logs and in the error list."""
    return f"{what} stopped with {type(cause).__name__}: {cause}"


class StepFailed(Exception):
    def __init__(self, step: str, cause: Exception):
        self.step, self.cause = step, cause
        super().__init__(failure_text(f"step {step}", cause))


class ObservedPipeline:
    """Runs named steps over a table and reports per step: row change, columns changed, warnings, plan time."""

    def __init__(self, steps: Sequence[Callable[[DataFrame], DataFrame]], drift_limit: float = DRIFT_LIMIT,
                 cardinality_limit: float = 1.0):
        self.steps = list(steps)
        self.drift_limit = drift_limit
        self.cardinality_limit = cardinality_limit
        self.metrics: list[dict] = []
        self.warnings: list[dict] = []
        self.errors: list[str] = []
        self.action_seconds: float | None = None

    def _measure(self, df: DataFrame, label: str) -> tuple[DataFrame, _Point]:
        point = _Point(Observation(label), numeric_columns(df), list(df.columns),
                       {f.name: f.dataType.simpleString() for f in df.schema.fields})
        aggregates = [F.count(F.lit(1)).alias("rows")]
        for i, c in enumerate(point.numeric):
            aggregates += [F.min(c).cast("double").alias(f"min_{i}"), F.max(c).cast("double").alias(f"max_{i}"),
                           F.avg(c).alias(f"mean_{i}")]
        aggregates += [F.approx_count_distinct(c).alias(f"distinct_{i}") for i, c in enumerate(point.counted)]
        return df.observe(point.observation, *aggregates), point

    def run(self, df: DataFrame, write: Callable[[DataFrame], None] | None = None) -> DataFrame:
        """Build the plan, run it once through `write` (or a job without output) and collect the measurements."""
        self.metrics, self.warnings, self.errors = [], [], []
        current, point = self._measure(df, "0_input")
        points, timings, names = [point], [], []
        try:
            for i, step in enumerate(self.steps, 1):
                name = getattr(step, "__name__", f"step_{i}")
                names.append(name)
                started = time.monotonic()
                try:
                    out = step(current)
                except Exception as cause:
                    raise StepFailed(name, cause) from cause
                timings.append(time.monotonic() - started)
                current, point = self._measure(out, f"{i}_{name}")
                points.append(point)
            started = time.monotonic()
            if write is None:
                current.write.format("noop").mode("overwrite").save()
            else:
                write(current)
            self.action_seconds = time.monotonic() - started
        except Exception as failure:
            text = str(failure) if isinstance(failure, StepFailed) else failure_text("the action", failure)
            self.errors.append(text)
            log.error(text)
            raise failure.cause if isinstance(failure, StepFailed) else failure
        for p in points:
            p.values = p.observation.get
        for name, seconds, before, after in zip(names, timings, points, points[1:]):
            self._compare(name, seconds, before, after)
        for m in self.metrics:
            log.info("%s", m)
        for w in self.warnings:
            log.warning("%s", w)
        return current

    def _compare(self, step: str, seconds: float, before: _Point, after: _Point) -> None:
        common = [c for c in before.types if c in after.types]
        self.metrics.append({
            "step": step,
            "delta_rows": after.values["rows"] - before.values["rows"],
            "cols_added_removed": len(set(before.types) ^ set(after.types)),
            "plan_seconds": seconds,
        })

        def warn(kind, column, old, new, change=None):
            self.warnings.append({"step": step, "kind": kind, "column": column, "before": str(old), "after": str(new),
                                  "relative_change": change})

        for c in common:
            if before.types[c] != after.types[c]:
                warn("dtype_change", c, before.types[c], after.types[c])
        for c in common:
            if c in before.numeric and c in after.numeric:
                i, j = before.numeric.index(c), after.numeric.index(c)
                for stat in ("min", "max", "mean"):
                    old, new = before.values[f"{stat}_{i}"], after.values[f"{stat}_{j}"]
                    if old in (None, 0) or new is None:
                        continue
                    change = abs((new - old) / old)
                    if change > self.drift_limit:
                        warn("numeric_drift", f"{c}_{stat}", old, new, change)
        for c in common:
            i, j = before.counted.index(c), after.counted.index(c)
            old, new = before.values[f"distinct_{i}"], after.values[f"distinct_{j}"]
            if old and (new - old) / old > self.cardinality_limit:
                warn("cardinality_change", c, old, new, (new - old) / old)

    def summary(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(
            [Row(**m) for m in self.metrics],
            "step string, delta_rows bigint, cols_added_removed int, plan_seconds double")

    def warning_table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(
            [Row(**w) for w in self.warnings],
            "step string, kind string, column string, before string, after string, relative_change double")

    def save(self, spark: SparkSession, folder: str) -> None:
        """Append summary and warnings to parquet tables under a folder."""
        self.summary(spark).write.mode("append").parquet(f"{folder}/steps")
        self.warning_table(spark).write.mode("append").parquet(f"{folder}/warnings")


def observe_step(step: Callable[[DataFrame], DataFrame]) -> Callable[[DataFrame], DataFrame]:
    """Decorator for a single step: schema changes are logged when the plan is built, errors are logged and re-raised."""

    def wrapped(df: DataFrame) -> DataFrame:
        started = time.monotonic()
        try:
            out = step(df)
        except Exception as cause:
            log.error(failure_text(f"step {step.__name__}", cause))
            raise
        before = {f.name: f.dataType.simpleString() for f in df.schema.fields}
        after = {f.name: f.dataType.simpleString() for f in out.schema.fields}
        changed = {c: f"{before[c]} -> {after[c]}" for c in before if c in after and before[c] != after[c]}
        log.info("%s | columns changed %d | planned in %.6f s", step.__name__, len(set(before) ^ set(after)),
                 time.monotonic() - started)
        if changed:
            log.warning("%s | type changes %s", step.__name__, changed)
        return out

    wrapped.__name__ = step.__name__
    return wrapped
