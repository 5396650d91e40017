"""What the operators of this folder share: session settings, reading, label folds and Arrow helpers."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from millrace.session import prepare

# Texts differ in length by four orders of magnitude; batches are bounded by rows and by bytes.
ARROW = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    "spark.sql.execution.arrow.maxBytesPerBatch": "16m",
}
WORD = "[^\\x20\\x09-\\x0D]+"  # a word, as the contracts define it


def ready(spark: SparkSession) -> SparkSession:
    """Session with the settings of the library and of the Arrow batches used here."""
    prepare(spark)
    for key, value in ARROW.items():
        spark.conf.set(key, value)
    return spark


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return ready(spark).read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def body(column: str = "text") -> Column:
    """The text, NULL as the empty text."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def held_out(column: str = "doc_id") -> Column:
    """Rows whose label may not be learnt from: crc32 of the id as text leaves 2 when divided by 4; NULL ids are not."""
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def key_fraction(column: str | Column, salt: str) -> Column:
    """A number in [0, 1) that depends on the value and the salt alone; other engines can compute it too."""
    value = F.col(column) if isinstance(column, str) else column
    text = F.concat(F.coalesce(value.cast("string"), F.lit("NULL")), F.lit(f"#{salt}"))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("bigint") / F.lit(2.0**52)


def key_fraction_sql(expression: str, salt: str) -> str:
    """SQL text of `key_fraction`."""
    return f"(('0x' || substr(md5(coalesce({expression}::VARCHAR, 'NULL') || '#{salt}'), 1, 13))::BIGINT / {2.0**52:.1f})"


def map_texts(df: DataFrame, start: Callable[[], Callable[[list, list], dict]], schema: str) -> DataFrame:
    """Columns `doc_id` and `text` of every Arrow batch to the columns of `schema`.

    `start()` runs once in each task and returns `rows(ids, texts)`, which gets lists (NULL texts as empty) and returns a
    dict of equally long columns.
    """
    wanted = df.select(F.col("doc_id"), body().alias("text"))
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        from_spark, rows = arrow_schema, start()
        for batch in batches:
            if batch.num_rows:
                out = rows(batch.column(0).to_pylist(), batch.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays([pa.array(out[n], from_spark.field(n).type) for n in from_spark.names], schema=from_spark)

    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    arrow_schema = to_arrow_schema(_parse_datatype_string(schema))
    return wanted.mapInArrow(run, schema)
