"""File scans, sinks and the chunk-wise run of a user chain."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from millrace.operators.rows import enforce_schema

Chain = Callable[[DataFrame], DataFrame]


def read_csv(spark: SparkSession, path: str, schema: str | None = None, header: bool = False) -> DataFrame:
    """CSV with inferred types, or with declared ones: then a value that does not fit fails the scan."""
    reader = spark.read.option("header", header)
    if schema is None:
        return reader.option("inferSchema", True).csv(path)
    return reader.option("mode", "FAILFAST").schema(schema).csv(path)


def read_csv_dayfirst(spark: SparkSession, path: str, schema: str, date_format: str = "dd-MM-yyyy") -> DataFrame:
    """CSV with a header and day-first dates; the schema declares them as DATE."""
    return (spark.read.option("header", True).option("mode", "FAILFAST").option("dateFormat", date_format)
            .schema(schema).csv(path))


def read_json_rows(spark: SparkSession, path: str, types: Sequence[str], names: Sequence[str] | None = None) -> DataFrame:
    """JSON files that hold one array of rows, each row an array of values by position.

    Such a file is one JSON value and cannot be split: one file is one task.
    """
    names = list(names or [f"_c{i}" for i in range(len(types))])
    rows = F.explode(F.from_json("value", "array<array<string>>", {"mode": "FAILFAST"})).alias("r")
    table = spark.read.text(path, wholetext=True).select(rows)
    return table.select(*[F.get("r", i).cast(t).alias(n) for i, (t, n) in enumerate(zip(types, names))])


def read_parquet(spark: SparkSession, path: str, schema: Mapping[str, str] | None = None) -> DataFrame:
    """Parquet, optionally cast to declared types."""
    table = spark.read.parquet(path)
    return table if schema is None else enforce_schema(schema)(table)


def run_in_chunks(
    df: DataFrame, chain: Callable[[pd.DataFrame], pd.DataFrame], schema: str | T.StructType, rows: int = 10_000
) -> DataFrame:
    """Apply a pandas chain to every chunk of at most `rows` rows and put the results together.

    Partitions are the chunks' carriers: batches stream through each task, nothing is gathered. A chain of Spark steps
    needs no chunks: use `df.transform(chain)`.
    """

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for start in range(0, len(batch), rows):
                yield chain(batch.iloc[start:start + rows].reset_index(drop=True))

    return df.mapInPandas(each, schema)


def save_parquet(path: str, partition_by: Sequence[str] = (), mode: str = "overwrite") -> Chain:
    """Step that writes the table and passes it on; object-store paths (s3a://...) go through the same writer.

    The result reads the written files back, so later steps do not compute the table twice.
    """

    def step(df: DataFrame) -> DataFrame:
        writer = df.write.mode(mode)
        (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
        return df.sparkSession.read.schema(df.schema).parquet(path)

    return step


def save_feather(path: str) -> Chain:
    """Step that writes one Arrow file for each task and passes the table on; `path` is a folder all executors share."""

    def step(df: DataFrame) -> DataFrame:
        def write(batches):
            import uuid

            import pyarrow as pa
            from pyarrow import fs

            store, folder = fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")
            store.create_dir(folder, recursive=True)
            name, rows, sink = f"{folder}/part-{uuid.uuid4().hex}.feather", 0, None
            for batch in batches:
                if sink is None:
                    out = store.open_output_stream(name)
                    sink = pa.ipc.new_file(out, batch.schema)
                sink.write_batch(batch)
                rows += batch.num_rows
            if sink is not None:
                sink.close()
                out.close()
            yield pa.RecordBatch.from_arrays([pa.array([rows], pa.int64())], names=["rows"])

        df.mapInArrow(write, "rows bigint").agg(F.sum("rows")).collect()
        return df

    return step


def save_csv(path: str, columns: Sequence[str] | None = None, drop: Sequence[str] = (), mode: str = "overwrite") -> Chain:
    """Step that writes chosen columns as CSV with a header and passes the table on."""

    def step(df: DataFrame) -> DataFrame:
        chosen = [c for c in (columns or df.columns) if c not in drop]
        df.select(*chosen).write.mode(mode).option("header", True).csv(path)
        return df

    return step
