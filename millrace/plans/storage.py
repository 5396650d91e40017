"""Files written from the given tables and read back."""

import uuid

import pandas as pd
from pyspark.sql import functions as F

from millrace.plans.catalog import register
from millrace.session import checkpoint_folder
from millrace.sources import files


def folder(t, name):
    """A fresh folder every executor can reach."""
    return f"{checkpoint_folder(t.spark)}/millrace/{name}-{uuid.uuid4().hex}"


@register("csv_with_declared_types", "A2 A12", "SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders")
def csv_declared(t):
    path = folder(t, "csv")
    t("orders").transform(files.save_csv(path, columns=["o_orderkey", "o_totalprice", "o_orderstatus"]))
    return files.read_csv(t.spark, path, "o_orderkey bigint, o_totalprice double, o_orderstatus string", header=True)


@register("csv_with_inferred_types", "A1", "SELECT s_suppkey::INTEGER AS _c0, s_name AS _c1, s_acctbal > 0 AS _c2 FROM supplier")
def csv_inferred(t):
    path = folder(t, "csv")
    t("supplier").select("s_suppkey", "s_name", (F.col("s_acctbal") > 0).alias("positive")).write.csv(path)
    return files.read_csv(t.spark, path)


@register("csv_with_dayfirst_dates", "A3", "SELECT o_orderkey, o_orderdate::DATE AS date FROM orders")
def csv_dayfirst(t):
    path = folder(t, "csv")
    t("orders").select("o_orderkey", F.date_format("o_orderdate", "dd-MM-yyyy").alias("date")).transform(files.save_csv(path))
    return files.read_csv_dayfirst(t.spark, path, "o_orderkey bigint, date date")


@register("parquet_sink_passes_on", "A10", "SELECT l_orderkey, l_partkey, l_quantity, l_returnflag FROM lineitem WHERE l_quantity > 10")
def parquet_sink(t):
    lines = t("lineitem").select("l_orderkey", "l_partkey", "l_quantity", "l_returnflag")
    return lines.transform(files.save_parquet(folder(t, "parquet"), partition_by=["l_returnflag"])).where("l_quantity > 10").select(
        *lines.columns)


@register("csv_in_chunks", "A8 I2", """
SELECT l_orderkey, l_linenumber, l_quantity * l_extendedprice AS total FROM lineitem WHERE l_quantity >= 25""")
def csv_in_chunks(t):
    """A pandas chain over chunks of a CSV file."""
    path = folder(t, "csv")
    t("lineitem").transform(files.save_csv(path, columns=["l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice"]))
    lines = files.read_csv(t.spark, path, "l_orderkey bigint, l_linenumber bigint, l_quantity double, l_extendedprice double", header=True)

    def chain(chunk):
        large = chunk[chunk["l_quantity"] >= 25]
        return large.assign(total=large["l_quantity"] * large["l_extendedprice"])[["l_orderkey", "l_linenumber", "total"]]

    return files.run_in_chunks(lines, chain, "l_orderkey bigint, l_linenumber bigint, total double", rows=1_000)


@register("json_rows", "A4", "SELECT c_custkey, c_name, c_acctbal FROM customer")
def json_rows(t):
    """Files of one JSON array of rows each, one for every nation."""
    path = folder(t, "json")
    row = F.array(F.col("c_custkey").cast("string"), "c_name", F.col("c_acctbal").cast("string"))
    arrays = t("customer").groupBy("c_nationkey").agg(F.to_json(F.collect_list(row)).alias("value"))
    arrays.write.partitionBy("c_nationkey").text(path)
    return files.read_json_rows(t.spark, path, ["bigint", "string", "double"], ["c_custkey", "c_name", "c_acctbal"])


@register("feather_round_trip", "A7", "SELECT s_suppkey, s_name, s_acctbal FROM supplier")
def feather_round_trip(t):
    from millrace.sources.feather import read_feather

    path = folder(t, "feather")
    t("supplier").select("s_suppkey", "s_name", "s_acctbal").transform(files.save_feather(path))
    return read_feather(t.spark, path)


@register("user_function_on_rows", "I2", "SELECT p_partkey, CASE WHEN p_size > 25 THEN 'large' ELSE 'small' END AS kind FROM part")
def user_function_on_rows(t):
    from millrace.operators.rows import apply_rows

    def kind(size: pd.Series) -> pd.Series:
        return size.gt(25).map({True: "large", False: "small"})

    return t("part").transform(apply_rows("kind", kind, "string", "p_size")).select("p_partkey", "kind")


@register("user_scan_by_key", "I4", """
SELECT event_id, user_id, value - lag(value, 1, value) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS step FROM events""")
def user_scan_by_key(t):
    """A pandas scan over each user's events in time order."""
    from millrace.operators.ordered import scan_by_key

    def steps(rows):
        return rows.assign(step=rows["value"].diff().fillna(0.0))[["event_id", "user_id", "step"]]

    rows = t("events").select("event_id", "user_id", "ts", F.col("value").cast("double").alias("value"))
    schema = ", ".join(f"{c} {dict(rows.dtypes)[c]}" for c in ("event_id", "user_id")) + ", step double"
    return scan_by_key(rows, ["user_id"], ["ts", "event_id"], steps, schema)


@register("user_scan_in_slices", "I4", """
SELECT event_id, user_id, value - lag(value, 1, value) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS step
FROM (SELECT * REPLACE (CASE WHEN event_id % 3 = 0 THEN 0 ELSE user_id END AS user_id) FROM events)""")
def user_scan_in_slices(t):
    """The same scan when one user holds a third of the rows: slices of 2,000 rows carry the last value on."""
    import struct

    from millrace.operators.ordered import scan_in_slices

    def last(rows):
        return struct.pack("<d", rows["value"].iloc[-1])

    def steps(rows, state):
        before = rows["value"].iloc[0] if state is None else struct.unpack("<d", state)[0]
        return rows.assign(step=rows["value"].diff().fillna(rows["value"].iloc[0] - before))[["event_id", "user_id", "step"]]

    user = F.when(F.col("event_id") % 3 == 0, F.lit(0)).otherwise(F.col("user_id")).cast(dict(t("events").dtypes)["user_id"])
    rows = t("events").select("event_id", user.alias("user_id"), "ts", F.col("value").cast("double").alias("value"))
    schema = ", ".join(f"{c} {dict(rows.dtypes)[c]}" for c in ("event_id", "user_id")) + ", step double"
    return scan_in_slices(rows, ["user_id"], "ts", "event_id", last, lambda state, does: does, steps, schema, rows_per_slice=2_000)
