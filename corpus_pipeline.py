"""The corpus pipeline: stages over documents, each written and read again as the next one's documents.

Quality classifier, exact de-duplication, near-duplicates, mixing, byte-level BPE. A stage takes (spark, docs, folder), works on
every row its predecessor kept and returns the columns of documents, the last one tokens. Documents go where a classifier
scores them below the line of the quality query, where an equal text with a larger id stays, and where a text of smaller id is
linked by five-word shingles at 0.8 or more; the mix then repeats or leaves out documents by the rate of their source.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from millrace.llm import bpe, common, exact_dedup, mix, near_dedup, quality
from millrace.session import materialise

LEAST_QUALITY = 0.7


def keep_quality(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    return quality.accepted(docs, common.table(spark, folder, "labels"), LEAST_QUALITY)


def drop_copies(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    common.ready(spark)
    return exact_dedup.deduplicated(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    common.ready(spark)
    return near_dedup.deduplicated(docs, near_dedup.Shape(width=5, percent=80))


def mix_sources(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    common.ready(spark)
    return mix.mix(docs)


def encode(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    import public_tokenizers

    common.ready(spark)
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return bpe.encoded(docs, ranks, public_tokenizers.PATTERN, with_ids=True)


STAGES = [
    ("quality", keep_quality), ("exact_dedup", drop_copies), ("near_dedup", drop_near_copies), ("mix", mix_sources), ("bpe", encode)]

ORACLE_SQL = None  # a trained classifier and tokens are beyond SQL; tests compare every stage with a plain version


def run(spark: SparkSession, folder: str) -> DataFrame:
    """All stages over documents; intermediate tables are written under the checkpoint folder."""
    docs = common.table(spark, folder, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, folder), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, folder)
