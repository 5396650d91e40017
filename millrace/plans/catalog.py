"""The registry of queries and, where SQL can say the same, their SQL text."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from importlib import import_module

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from millrace.session import prepare

MODULES = (
    "storage", "relational", "scalars", "timeseries", "quality", "preprocessing", "selection", "sampling", "scoring", "training",
)


class Tables:
    """Tables of one folder, read when asked for: `t("orders")`, `t.spark`."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}.parquet"

    def __call__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))


@dataclass(frozen=True)
class Query:
    name: str
    covers: tuple[str, ...]
    build: Callable[[Tables], DataFrame]
    sql: str | None

    def run(self, spark: SparkSession, folder: str) -> DataFrame:
        return self.build(Tables(prepare(spark), folder))


REGISTRY: dict[str, Query] = {}


def register(name: str, covers: str, sql: str | None = None):
    """Decorator: `covers` lists the operators of the blueprint a query exercises."""

    def add(build: Callable[[Tables], DataFrame]):
        if name in REGISTRY:
            raise ValueError(f"query {name} registered twice")
        REGISTRY[name] = Query(name, tuple(covers.split()), build, sql)
        return build

    return add


def load() -> dict[str, Query]:
    for module in MODULES:
        import_module(f"millrace.plans.{module}")
    return REGISTRY


def rounded(c: str | Column, digits: int = 6, name: str | None = None) -> Column:
    """Doubles are published with fixed digits: sums in different orders differ in the last bits."""
    column = F.round(F.col(c) if isinstance(c, str) else c, digits)
    return column.alias(name or c) if name or isinstance(c, str) else column


def sql_hash(text: str, seed: int | str = 42) -> str:
    """SQL text of the key hash of an expression."""
    return f"('0x' || substr(md5(concat({text}, '#{seed}')), 1, 13))::BIGINT"
