"""Approximate k-nearest-neighbour join by locality-sensitive hashing.

`BucketedRandomProjectionLSH` hashes every vector by TABLES x DEPTH random projections. In each table rows first meet by one of
its projections; a bucket that holds more than `bucket_rows` donors is hashed again, by the table's next projection as well, until
it is small enough, so a dense region or a far too wide bucket never becomes all pairs of its rows. What DEPTH projections cannot
split is cut into blocks, and every block of queries meets every block of donors. Buckets are compared by the block kernel of
the exact join: at most k rows per query and bucket are written, and the tables' answers are merged.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.ml.feature import BucketedRandomProjectionLSH
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, Window, functions as F

from millrace.operators.joins import join_small
from millrace.operators.neighbours import FOUND, _again, _collapse, _complete, _listed, _matrix, nearest_in_block
from millrace.session import materialise

TABLES = 12
DEPTH = 10  # projections of a table, taken one by one while a bucket is too large
BUCKET_ROWS = 2_000  # donors in a bucket that is not hashed again
SAMPLE = 2_000  # donors, chosen by hash, whose distances set the width of buckets
WIDTH = 4.0  # width of a bucket in typical distances to the k-th neighbour


def typical_distance(donors: DataFrame, k: int, sample: int = SAMPLE) -> float:
    """Median distance from a sampled donor to its k-th nearest sampled one of its group.

    A sample is sparser than the table, so this is too large rather than too small, and buckets too wide rather than too narrow.
    """
    n = donors.count()
    share = F.pmod(F.xxhash64(F.lit("typical"), "rep"), F.lit(1 << 52)) / F.lit(2.0**52)
    rows = donors.where(share < sample / max(n, 1)).select("grp", "rep", "vec").orderBy("rep").limit(2 * sample).toPandas()
    found = []
    for _, part in rows.groupby("grp"):
        points, kth = _matrix(part["vec"].tolist()), {}
        for i, _, distance in zip(*nearest_in_block(points, points, np.arange(len(points)), k + 1)):
            kth[i] = max(kth.get(i, 0.0), distance)
        found += [d for d in kth.values() if d > 0]
    return float(np.median(found)) if found else 1.0


def _hashed(rows: DataFrame, model, tables: int, depth: int) -> DataFrame:
    """`grp, rep, hashes, bucket` of each row and table, `hashes` being the projections of that table."""
    values = F.transform("_hashes", lambda v: vector_to_array(v)[0].cast("bigint"))
    flat = model.transform(rows.withColumn("_point", array_to_vector("vec"))).select("grp", "rep", values.alias("flat"))
    each = flat.select("grp", "rep", F.explode(F.array(*[
        F.struct(F.lit(t).alias("t"), F.slice("flat", t * depth + 1, depth).alias("hashes")) for t in range(tables)])).alias("e"))
    return each.select("grp", "rep", "e.hashes", F.xxhash64("grp", "e.t", F.col("e.hashes")[0]).alias("bucket"))


def _finer(rows: DataFrame, large: DataFrame, level: int) -> DataFrame:
    """Rows of the listed buckets in buckets of their next projection as well."""
    marked = join_small(rows, large.withColumn("_large", F.lit(True)), ["bucket"])
    deeper = F.when(F.col("_large"), F.xxhash64("bucket", F.col("hashes")[level])).otherwise(F.col("bucket"))
    return materialise(marked.withColumn("bucket", deeper).drop("_large"), "lsh-buckets")


def approximate_knn_join(
    queries: DataFrame, donors: DataFrame, k: int, exclude_self: bool = False, tables: int = TABLES, depth: int = DEPTH,
    bucket_rows: int = BUCKET_ROWS, width: float = WIDTH, seed: int = 42, report: list | None = None,
) -> DataFrame:
    """(grp, query_id, donor_id, distance, rank): of the donors a query shares a bucket with, the k nearest, by exact distance.

    Tables as for `knn_join`: `id bigint`, `vec array<double>`, `grp string`; rows with missing parts have no neighbours. All rows
    are indexed; only the width of buckets is set from a sample. `report`, if given, gets the number of large buckets of each
    round and the largest bucket that is left.
    """
    alone = queries is donors
    donors = _complete(donors)
    queries = donors if alone else _complete(queries)
    wanted = k + 1 if exclude_self else k
    d = materialise(_collapse(donors.select("id", "vec", "grp"), wanted), "lsh-donors")
    q = (d if alone else materialise(_collapse(queries.select("id", "vec", "grp"), 1), "lsh-queries")).select("grp", "vec", "rep")
    if d.isEmpty():
        return d.sparkSession.createDataFrame([], "grp string, query_id bigint, donor_id bigint, distance double, rank int")
    d_rows = d.select("grp", "rep", "vec")
    lsh = BucketedRandomProjectionLSH(inputCol="_point", outputCol="_hashes", bucketLength=width * typical_distance(d_rows, wanted),
                                      numHashTables=tables * depth, seed=seed)
    model = lsh.fit(d_rows.withColumn("_point", array_to_vector("vec")))
    donor_side = materialise(_hashed(d_rows, model, tables, depth), "lsh-hashed")
    query_side = donor_side if alone else materialise(_hashed(q, model, tables, depth), "lsh-hashed")
    for level in range(1, depth):
        sizes = donor_side.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
        large = materialise(sizes.where(F.col("n") > bucket_rows).select("bucket"), "lsh-large")
        if report is not None:
            report.append(large.count())
        if large.isEmpty():
            break
        donor_side = _finer(donor_side, large, level)
        query_side = donor_side if alone else _finer(query_side, large, level)
    blocks = donor_side.groupBy("bucket").agg(F.ceil(F.count(F.lit(1)) / bucket_rows).cast("int").alias("dblocks")).join(
        query_side.groupBy(F.col("bucket").alias("bucket")).agg(F.ceil(F.count(F.lit(1)) / bucket_rows).cast("int").alias("qblocks")), "bucket")
    blocks = materialise(blocks, "lsh-blocks")
    if report is not None:
        report.append(donor_side.groupBy("bucket").count().agg(F.max("count")).first()[0])

    def numbered(side: DataFrame, points: DataFrame, own: str, own_n: str, other: str, other_n: str) -> DataFrame:
        rows = side.select("grp", "rep", "bucket").join(blocks, "bucket").join(points.select("grp", "rep", "vec"), ["grp", "rep"])
        return rows.select("grp", "rep", "vec", "bucket", F.pmod(F.xxhash64("rep"), F.col(own_n)).cast("int").alias(own),
                           F.explode(F.sequence(F.lit(0), F.col(other_n) - 1)).alias(other))

    def compare(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        ids, reps = a["rep"].to_numpy(np.int64), b["rep"].to_numpy(np.int64)
        if not len(ids) or not len(reps):
            return pd.DataFrame({"grp": [], "rep": [], "donor": [], "distance": []})
        i, j, far = nearest_in_block(_matrix(a["vec"].tolist()), _matrix(b["vec"].tolist()), reps, wanted)
        return pd.DataFrame({"grp": a["grp"].iloc[0], "rep": ids[i], "donor": reps[j], "distance": far})

    key = ["bucket", "qb", "db"]
    left = numbered(query_side, q, "qb", "qblocks", "db", "dblocks").groupBy(*key)
    right = _again(numbered(donor_side, d_rows, "db", "dblocks", "qb", "qblocks")).groupBy(*key)
    # A bucket's hash holds its group, so all its rows are of one group.
    met = left.cogroup(right).applyInPandas(compare, FOUND)
    best = Window.partitionBy("grp", "rep").orderBy("distance", "donor")
    found = met.distinct().withColumn("_rn", F.row_number().over(best)).where(F.col("_rn") <= wanted).drop("_rn")
    return _listed(found, q, d, queries, k, exclude_self)


def recall(found: DataFrame, exact: DataFrame) -> DataFrame:
    """`query_id, wanted, hits`: how many of the exact neighbours of each query an approximate join found."""
    there = found.select("grp", "query_id", "donor_id", F.lit(1).alias("hit"))
    return exact.join(there, ["grp", "query_id", "donor_id"], "left").groupBy("query_id").agg(
        F.count(F.lit(1)).alias("wanted"), F.count("hit").alias("hits"))
