"""Feather (Arrow IPC file) scan through the Python Data Source API.

Files hold record batches with a footer index, so the scan plans one task per run of batches and each task seeks to
its own batches. Usage: `register(spark)`, then `spark.read.format("feather").load(path)` (a file, folder or glob).
"""

from __future__ import annotations

import glob
import os

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.pandas.types import from_arrow_schema
from pyspark.sql.types import StructType

BATCHES_PER_TASK = 64


def _list_files(path: str) -> tuple[fs.FileSystem, list[str]]:
    if "://" in path:
        store, root = fs.FileSystem.from_uri(path)
    else:
        store, root = fs.LocalFileSystem(), os.path.abspath(path)
        if any(ch in root for ch in "*?["):
            return store, sorted(glob.glob(root))
    info = store.get_file_info(root)
    if info.type == fs.FileType.Directory:
        inside = store.get_file_info(fs.FileSelector(root, recursive=True))
        return store, sorted(f.path for f in inside if f.is_file and not f.base_name.startswith(("_", ".")))
    return store, [root]


class _Batches(InputPartition):
    def __init__(self, path: str, first: int, last: int):
        self.path, self.first, self.last = path, first, last


class FeatherReader(DataSourceReader):
    def __init__(self, path: str, schema: StructType):
        self.path, self.names = path, schema.fieldNames()

    def partitions(self):
        store, files = _list_files(self.path)
        parts = []
        for name in files:
            with store.open_input_file(name) as source:
                count = pa.ipc.open_file(source).num_record_batches
            parts += [_Batches(name, i, min(i + BATCHES_PER_TASK, count)) for i in range(0, count, BATCHES_PER_TASK)]
        return parts

    def read(self, partition):
        store, _ = _list_files(self.path)
        with store.open_input_file(partition.path) as source:
            table = pa.ipc.open_file(source)
            for i in range(partition.first, partition.last):
                yield table.get_batch(i).select(self.names)


class FeatherSource(DataSource):
    @classmethod
    def name(cls):
        return "feather"

    def schema(self):
        store, files = _list_files(self.options["path"])
        if not files:
            raise ValueError(f"no files under {self.options['path']}")
        with store.open_input_file(files[0]) as source:
            return from_arrow_schema(pa.ipc.open_file(source).schema, prefer_timestamp_ntz=True)

    def reader(self, schema):
        return FeatherReader(self.options["path"], schema)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(FeatherSource)


def read_feather(spark: SparkSession, path: str):
    register(spark)
    return spark.read.format("feather").load(path)
