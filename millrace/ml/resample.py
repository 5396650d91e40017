"""Class-imbalance resampling of training rows: DataFrame in, DataFrame out.

Every choice (which rows, which neighbour, how far) comes from hashes of the row key, so results are repeatable. Row
keys are non-negative whole numbers; synthetic rows get negative ones. A missing label is a class of its own. A row with a
missing feature has no neighbours and is nobody's neighbour: SMOTE repeats it as it is, cleaning keeps it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from millrace.functions.keys import key_hash, key_uniform
from millrace.ml.split import hash_prefix, hash_rank
from millrace.operators.joins import join_null_safe, join_small
from millrace.operators.neighbours import knn_join, vectors
from millrace.session import materialise

COPIES_PER_CHUNK = 10_000


def class_sizes(df: DataFrame, label: str) -> DataFrame:
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("_n"))


def repeat_rows(df: DataFrame, key: str, copies: str, out: str) -> DataFrame:
    """Each row `copies` times, numbered from 0.

    A row needing very many copies is first cut into chunks that are spread over tasks, so a tiny class can grow to the
    size of a huge one.
    """
    chunks = df.where(F.col(copies) > 0).withColumn(
        "_chunk", F.explode(F.sequence(F.lit(0).cast("bigint"), F.expr(f"({copies} - 1) div {COPIES_PER_CHUNK}"))))
    start = F.col("_chunk") * COPIES_PER_CHUNK
    stop = F.least(start + COPIES_PER_CHUNK, F.col(copies)) - 1
    return chunks.repartition(key, "_chunk").withColumn(
        out, F.explode(F.sequence(start, stop))).drop("_chunk")


def _with_quota(df: DataFrame, key: str, label: str, seed: int | str) -> DataFrame:
    """Adds `_extra`: how many more copies of the row bring its class up to the largest class."""
    sizes = class_sizes(df, label)
    largest = sizes.agg(F.max("_n")).scalar()
    wanted = sizes.withColumn("_want", largest - F.col("_n"))
    ranked = join_small(hash_rank(df, key, [label], seed, "_rank"), wanted, [label])
    extra = F.expr("_want div _n") + (F.col("_rank") <= F.col("_want") % F.col("_n")).cast("bigint")
    return ranked.withColumn("_extra", extra).select(*df.columns, "_extra")


def random_over_sample(df: DataFrame, key: str, label: str, seed: int | str = 42, out: str = "copy") -> DataFrame:
    """Repeat rows of smaller classes until all classes are as large as the largest; copy 0 is the original."""
    quota = _with_quota(df, key, label, seed).withColumn("_copies", F.col("_extra") + 1)
    return repeat_rows(quota, key, "_copies", out).select(*df.columns, out)


def random_under_sample(df: DataFrame, key: str, label: str, seed: int | str = 42) -> DataFrame:
    """Keep as many rows of every class as the smallest class has."""
    smallest = class_sizes(df, label).agg(F.min("_n")).scalar()
    return hash_rank(df, key, [label], seed, "_rank").where(F.col("_rank") <= smallest).drop("_rank")


def smote(
    df: DataFrame, key: str, label: str, features: Sequence[str], k: int = 5, categorical: Sequence[str] = (),
    categorical_value: str = "random", seed: int | str = 42, **join_options,
) -> DataFrame:
    """Synthetic rows until all classes are equally large.

    A synthetic row lies between a row and one of its k nearest rows of the same class (distance over `features` only).
    Categorical columns take the value of a random one of the k neighbours, or their most frequent value with
    categorical_value='mode'. A class of one row is repeated as it is. Result: key, label, columns, base (the row it
    grew from) and is_synthetic.
    """
    rows = materialise(df.select(F.col(key).cast("bigint").alias("_id"), F.col(label).alias("_y"),
                                 F.array(*[F.col(c).cast("double") for c in features]).alias("_v"), *categorical), "smote")
    quota = _with_quota(rows, "_id", "_y", seed)
    numbered = hash_prefix(quota, "_id", {"_upto": F.col("_extra")}, seed=seed)
    growing = numbered.where(F.col("_extra") > 0)
    small = join_null_safe(rows, growing.select("_y").distinct(), ["_y"], "left_semi")
    points = small.select(F.col("_id").alias("id"), F.col("_v").alias("vec"), F.coalesce(
        F.col("_y").cast("string"), F.lit("\x00missing")).alias("grp"))
    near = knn_join(points, points, k, exclude_self=True, **join_options)
    donors = rows.select(F.col("_id").alias("donor_id"), F.struct("_v", *categorical).alias("_d"))
    # At most k entries per row.
    listed = near.join(donors, "donor_id").groupBy(F.col("query_id").alias("_id")).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("rank", "_d"))), lambda s: s["_d"]).alias("_near"))
    grown = repeat_rows(growing.join(listed, "_id", "left"), "_id", "_extra", "_copy")
    count = F.greatest(F.coalesce(F.size("_near"), F.lit(0)), F.lit(1))

    def pick(what: str) -> Column:
        return (F.pmod(key_hash("_id", "_copy", seed=f"{seed}:{what}"), count) + 1).cast("int")

    u = key_uniform("_id", "_copy", seed=f"{seed}:step")
    other = F.try_element_at("_near", pick("neighbour"))
    grown = grown.withColumns({"_other": other, "_u": u})
    # A row without neighbours, or a missing feature, stays as it is.
    between = F.zip_with("_v", F.col("_other")["_v"], lambda x, o: F.coalesce(x + F.col("_u") * (o - x), x))
    made = {}
    for c in categorical:
        if categorical_value == "mode":
            values = F.transform("_near", lambda d: d[c])
            ranked = F.transform(F.array_distinct(values), lambda v: F.struct(
                (-F.size(F.filter(values, lambda x: x.eqNullSafe(v)))).alias("n"), v.alias("v")))
            chosen = F.array_min(ranked)["v"]
        else:
            chosen = F.try_element_at("_near", pick(f"category:{c}"))[c]
        made[c] = F.when(F.size("_near") > 0, chosen).otherwise(F.col(c))
    new_id = F.col("_copy") - F.col("_upto")  # -upto .. -upto + extra - 1: unique over all rows
    synthetic = grown.select(new_id.alias("_id"), "_y", F.coalesce(between, "_v").alias("_v"), *[e.alias(c) for c, e in made.items()],
                             F.col("_id").alias("base"), F.lit(True).alias("is_synthetic"))
    original = rows.select("_id", "_y", "_v", *categorical, F.col("_id").alias("base"), F.lit(False).alias("is_synthetic"))
    every = materialise(original.unionByName(synthetic), "smote-grown")
    return every.select(F.col("_id").alias(key), F.col("_y").alias(label), *[F.col("_v")[i].alias(c) for i, c in enumerate(features)],
                        *categorical, "base", "is_synthetic")


def tomek_links(df: DataFrame, key: str, label: str, features: Sequence[str], **join_options) -> DataFrame:
    """(a, b, a_label, b_label): rows of different classes that are each other's nearest row, in both directions."""
    points = vectors(df, key, features)
    nearest = knn_join(points, points, 1, exclude_self=True, **join_options).select(
        F.col("query_id").alias("a"), F.col("donor_id").alias("b"))
    back = nearest.select(F.col("a").alias("b"), F.col("b").alias("a"))
    mutual = nearest.join(back, ["a", "b"])
    labels = df.select(F.col(key).cast("bigint").alias("_k"), F.col(label).alias("_l"))
    a = labels.withColumnsRenamed({"_k": "a", "_l": "a_label"})
    b = labels.withColumnsRenamed({"_k": "b", "_l": "b_label"})
    return mutual.join(a, "a").join(b, "b").where("NOT a_label <=> b_label")


def drop_tomek_links(
    df: DataFrame, key: str, label: str, features: Sequence[str], drop: str = "majority",
    sizes: DataFrame | None = None, **join_options,
) -> DataFrame:
    """Remove from each link the row of the larger class (the higher label on ties), or both rows with drop='both'.

    `sizes` (label, _n) can give the class sizes of the data before synthetic rows were added.
    """
    links = tomek_links(df, key, label, features, **join_options)
    if drop == "both":
        doomed = links.select(F.col("a").alias("_doomed"))
    else:
        sizes = class_sizes(df, label) if sizes is None else sizes
        a = sizes.select(F.col(label).alias("a_label"), F.col("_n").alias("a_n"))
        b = sizes.select(F.col(label).alias("b_label"), F.col("_n").alias("b_n"))
        sized = join_small(join_small(links, a, ["a_label"]), b, ["b_label"])
        higher = F.struct("a_label") > F.struct("b_label")  # a missing label is the lowest
        larger = (F.col("a_n") > F.col("b_n")) | ((F.col("a_n") == F.col("b_n")) & higher)
        doomed = sized.where(larger).select(F.col("a").alias("_doomed"))
    return df.join(doomed, F.col(key).cast("bigint") == F.col("_doomed"), "left_anti")


def edited_neighbours(
    df: DataFrame, key: str, label: str, features: Sequence[str], k: int = 3, rule: str = "majority", **join_options
) -> DataFrame:
    """Drop rows most of whose k nearest rows have another class; rule='any' drops on a single one."""
    points = vectors(df, key, features)
    near = knn_join(points, points, k, exclude_self=True, **join_options)
    labels = df.select(F.col(key).cast("bigint").alias("_k"), F.col(label).alias("_l"))
    other = labels.withColumnsRenamed({"_k": "donor_id", "_l": "_other"})
    own = labels.withColumnsRenamed({"_k": "query_id", "_l": "_own"})
    votes = near.join(other, "donor_id").join(own, "query_id").groupBy("query_id").agg(
        F.count_if(~F.col("_other").eqNullSafe(F.col("_own"))).alias("_against"), F.count(F.lit(1)).alias("_all"))
    wrong = F.col("_against") * 2 > F.col("_all") if rule == "majority" else F.col("_against") > 0
    doomed = votes.where(wrong).select(F.col("query_id").alias("_doomed"))
    return df.join(doomed, F.col(key).cast("bigint") == F.col("_doomed"), "left_anti")


def smote_tomek(df: DataFrame, key: str, label: str, features: Sequence[str], k: int = 5, seed: int | str = 42,
                drop: str = "majority", **join_options) -> DataFrame:
    """SMOTE, then Tomek-link cleaning; "majority" refers to the class sizes before SMOTE."""
    grown = materialise(smote(df, key, label, features, k, seed=seed, **join_options), "smote")
    return drop_tomek_links(grown, key, label, features, drop, class_sizes(df, label), **join_options)


def smote_enn(df: DataFrame, key: str, label: str, features: Sequence[str], k: int = 5, enn_k: int = 3,
              rule: str = "majority", seed: int | str = 42, **join_options) -> DataFrame:
    """SMOTE, then removal of rows their neighbours disagree with."""
    grown = materialise(smote(df, key, label, features, k, seed=seed, **join_options), "smote")
    return edited_neighbours(grown, key, label, features, enn_k, rule, **join_options)
