"""Chunk-wise processing of a folder as a stream: files not yet processed form the next chunks.

Row-wise steps (cleaning, typing, filters, date expressions) accept a streaming table unchanged. The checkpoint
records finished chunks, so a restarted run neither repeats nor skips one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from millrace.session import checkpoint_folder


def process_new_files(
    spark: SparkSession, source: str, schema: str, chain: Callable[[DataFrame], DataFrame], sink: str, name: str,
    file_format: str = "parquet", files_per_chunk: int = 1_000,
) -> None:
    """Run the chain over every unprocessed file of the folder, append the results to a parquet table, then stop."""
    stream = (spark.readStream.schema(schema).format(file_format)
              .option("maxFilesPerTrigger", files_per_chunk).load(source))
    (
        stream.transform(chain).writeStream.format("parquet").option("path", sink)
        .option("checkpointLocation", f"{checkpoint_folder(spark)}/{name}")
        .outputMode("append").trigger(availableNow=True).start().awaitTermination()
    )
