"""Filters, joins, grouping, distinct, ordering, set operations."""

from pyspark.sql import functions as F

from millrace.functions import clean
from millrace.operators import profile, quantiles, relational as rel, rows
from millrace.plans.catalog import register, rounded, sql_hash
from millrace.sources.files import read_parquet, run_in_chunks

# Price bucket edges of the flagship query.
PRICE_EDGES = [0, 100000, 250000, 600000]
SEGMENT_SYNONYMS = {"AUTOMOBILE": "AUTO", "MACHINERY": "MACHINE"}


def gappy_customers(t):
    """Customers with untidy segment texts and missing balances, both made from the key."""
    segment = F.concat(F.lit(" "), F.lower("c_mktsegment"), F.lit(" "))
    return t("customer").select(
        F.col("c_custkey").alias("o_custkey"),
        F.when(F.col("c_custkey") % 2 == 0, segment).otherwise(F.col("c_mktsegment")).alias("segment"),
        F.when(F.col("c_custkey") % 7 != 0, F.col("c_acctbal")).alias("balance"))


def cleaned_orders(t):
    wanted = ["o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority", "no_such_column"]
    return t("orders").transform(rows.chain(
        rows.select_existing(wanted),
        rows.where("o_totalprice > 0"),
        rel.left_join(gappy_customers(t), "o_custkey"),
        rel.keep_first(["o_custkey"], ["o_orderkey"]),
        rows.assign(segment=clean.missing_tokens_to_null("segment")),
        rows.assign(segment=clean.canonical_label("segment", SEGMENT_SYNONYMS)),
        rows.fill_median(["balance"]),
        rows.drop_missing(["segment", "o_totalprice"]),
        rows.assign(is_large=clean.holds(F.col("o_totalprice") >= 250000),
                    weighted=clean.linear("o_totalprice", "balance")),
        rows.assign(price_bucket=clean.right_closed_bucket("o_totalprice", PRICE_EDGES)),
    ))


_CLEANED = """
WITH c AS (
  SELECT c_custkey,
         CASE WHEN c_custkey % 2 = 0 THEN ' ' || lower(c_mktsegment) || ' ' ELSE c_mktsegment END AS segment,
         CASE WHEN c_custkey % 7 <> 0 THEN c_acctbal END AS balance
  FROM customer),
j AS (
  SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority, segment, balance,
         row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS rn
  FROM orders LEFT JOIN c ON c.c_custkey = orders.o_custkey WHERE o_totalprice > 0),
d AS (SELECT * FROM j WHERE rn = 1),
m AS (SELECT quantile_cont(balance::DOUBLE, 0.5) AS med FROM d),
s AS (
  SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority,
         CASE upper(trim(segment)) WHEN 'AUTOMOBILE' THEN 'AUTO' WHEN 'MACHINERY' THEN 'MACHINE'
              ELSE upper(trim(segment)) END AS segment,
         coalesce(balance, (SELECT med FROM m)) AS balance,
         coalesce(o_totalprice >= 250000, false) AS is_large,
         CASE WHEN o_totalprice > 0 AND o_totalprice <= 100000 THEN '(0, 100000]'
              WHEN o_totalprice > 100000 AND o_totalprice <= 250000 THEN '(100000, 250000]'
              WHEN o_totalprice > 250000 AND o_totalprice <= 600000 THEN '(250000, 600000]' END AS price_bucket
  FROM d WHERE segment IS NOT NULL)
"""


@register("flagship_segment_summary", "A5 B1 B2 B6 B8 B10 C1 D1 D9 F1 H1 H2 H13 I1", _CLEANED + """
SELECT segment, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS sum_per_group, round(avg(o_totalprice), 4) AS avg_per_group,
       count(o_orderkey) AS count_per_group, count(DISTINCT o_orderpriority) AS unique_per_group
FROM s GROUP BY segment ORDER BY avg_per_group DESC""")
def flagship(t):
    money = cleaned_orders(t).withColumn("price", F.col("o_totalprice").cast("decimal(18,2)"))
    summary = rel.group_summary("segment", "price", "o_orderkey", "o_orderpriority")(money)
    return summary.select("segment", F.col("sum_per_group").cast("double").alias("sum_per_group"),
                          F.round(F.col("avg_per_group").cast("double"), 4).alias("avg_per_group"),
                          "count_per_group", "unique_per_group").transform(rel.sort_rows(("avg_per_group", False), ("segment", True)))


@register("cleaned_order_rows", "B8 B9 B10 B11 H13", _CLEANED + """
SELECT o_orderkey, segment, round(balance, 6) AS balance, is_large, price_bucket, round(o_totalprice + 2 * balance, 4) AS weighted FROM s""")
def cleaned_rows(t):
    return cleaned_orders(t).transform(rows.drop("o_custkey", "o_totalprice", "o_orderpriority")).select(
        "o_orderkey", "segment", rounded("balance"), "is_large", "price_bucket", rounded("weighted", 4))


@register("group_statistics_on_rows", "E1", """
WITH g AS (SELECT CASE WHEN o_custkey % 11 = 0 THEN NULL ELSE o_orderpriority END AS grp, * FROM orders),
a AS (SELECT grp, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS sum_per_group, avg(o_totalprice) AS avg_per_group,
             count(o_custkey) AS count_per_group, count(DISTINCT o_orderstatus) AS unique_per_group
      FROM g WHERE grp IS NOT NULL GROUP BY grp)
SELECT o_orderkey, g.grp, sum_per_group, round(avg_per_group, 4) AS avg_per_group, count_per_group, unique_per_group
FROM g LEFT JOIN a ON a.grp = g.grp""")
def statistics_on_rows(t):
    orders = t("orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", F.col("o_totalprice").cast("decimal(18,2)").alias("price"),
        F.when(F.col("o_custkey") % 11 != 0, F.col("o_orderpriority")).alias("grp"))
    done = rel.with_group_summary("grp", "price", "o_custkey", "o_orderstatus")(orders)
    return done.select("o_orderkey", "grp", F.col("sum_per_group").cast("double").alias("sum_per_group"),
                       F.round(F.col("avg_per_group").cast("double"), 4).alias("avg_per_group"), "count_per_group", "unique_per_group")


@register("range_and_membership_filter", "B2 B3 B5", """
SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders
WHERE o_totalprice > 50000 AND month(o_orderdate) BETWEEN 3 AND 9 AND o_orderstatus IN ('O', 'F')""")
def range_and_membership(t):
    return t("orders").transform(rows.chain(
        rows.where("o_totalprice > 50000"), rows.members("o_orderstatus", ["O", "F"]),
        rows.assign(month=F.month("o_orderdate")), rows.between("month", 3, 9))).select("o_orderkey", "o_orderstatus", "o_totalprice")


@register("drop_and_fill_missing", "B6 B7", """
SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_orderstatus END AS status,
       coalesce(CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_totalprice END, 0.0::DOUBLE) AS price
FROM orders WHERE o_orderkey % 5 <> 0""")
def drop_and_fill(t):
    nan = F.lit(float("nan"))
    gappy = t("orders").select("o_orderkey", F.when(F.col("o_orderkey") % 5 != 0, F.col("o_orderstatus")).alias("status"),
                               F.when(F.col("o_orderkey") % 3 != 0, F.col("o_totalprice")).otherwise(nan).alias("price"))
    return gappy.transform(rows.chain(rows.nan_as_null, rows.drop_missing(["status"]), rows.fill({"price": 0.0})))


@register("conditional_and_fallback", "B12 B13", """
SELECT o_orderkey,
       CASE WHEN o_totalprice > 300000 THEN 'high' WHEN o_totalprice > 100000 THEN 'middle' ELSE 'low' END AS level,
       coalesce(try_cast(CASE WHEN o_orderkey % 4 = 0 THEN o_orderpriority ELSE substr(o_orderpriority, 1, 1) END AS INTEGER), -1) AS priority,
       coalesce(CASE WHEN o_custkey % 6 <> 0 THEN round(o_totalprice / (o_custkey % 6), 4) END, -1.0::DOUBLE) AS ratio
FROM orders""")
def conditional_and_fallback(t):
    price = F.col("o_totalprice")
    text = F.when(F.col("o_orderkey") % 4 == 0, F.col("o_orderpriority")).otherwise(F.substring("o_orderpriority", 1, 1))
    return t("orders").select(
        "o_orderkey", F.when(price > 300000, "high").when(price > 100000, "middle").otherwise("low").alias("level"),
        F.coalesce(text.try_cast("int"), F.lit(-1)).alias("priority"),
        F.coalesce(F.round(F.try_divide(price, F.col("o_custkey") % 6), 4), F.lit(-1.0)).alias("ratio"))


@register("left_join_customers", "C1", """
SELECT o_orderkey, o_custkey, c_mktsegment, c_nationkey FROM orders LEFT JOIN
  (SELECT * FROM customer WHERE c_acctbal > 0) c ON c.c_custkey = orders.o_custkey""")
def left_join_customers(t):
    customers = t("customer").where("c_acctbal > 0").select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment", "c_nationkey")
    return t("orders").select("o_orderkey", "o_custkey").transform(rel.left_join(customers, "o_custkey"))


@register("left_join_missing_keys_match", "C2", """
WITH o AS (SELECT o_orderkey, nullif(o_custkey % 50, 0) AS k FROM orders),
n AS (SELECT nullif(n_nationkey, 0) AS k, n_name FROM nation)
SELECT o_orderkey, o.k AS k, n_name FROM o LEFT JOIN n ON o.k IS NOT DISTINCT FROM n.k""")
def left_join_null_safe(t):
    orders = t("orders").select("o_orderkey", F.nullif(F.col("o_custkey") % 50, F.lit(0)).alias("k"))
    nations = t("nation").select(F.nullif(F.col("n_nationkey"), F.lit(0)).cast("bigint").alias("k"), "n_name")
    return orders.transform(rel.left_join(nations, "k", null_safe=True))


@register("values_absent_from_reference", "C3", """
SELECT o_orderkey, nullif(o_custkey, 5) AS k FROM orders WHERE o_custkey = 5 OR o_custkey NOT IN
  (SELECT c_custkey FROM customer WHERE c_acctbal > 1000)""")
def absent(t):
    orders = t("orders").select("o_orderkey", F.nullif("o_custkey", F.lit(5)).alias("k"))
    return orders.transform(rel.absent_from(t("customer").where("c_acctbal > 1000"), "k", "c_custkey"))


@register("values_present_in_reference", "C5 B5", """
SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')""")
def present(t):
    return t("orders").select("o_orderkey", "o_custkey").transform(
        rel.present_in(t("customer").where("c_mktsegment = 'BUILDING'"), "o_custkey", "c_custkey"))


@register("group_means", "D2", """
SELECT l_returnflag, l_linestatus, round(avg(l_quantity), 6) AS l_quantity, round(avg(l_extendedprice), 4) AS l_extendedprice
FROM lineitem GROUP BY ALL""")
def means(t):
    done = rel.group_means(["l_returnflag", "l_linestatus"], ["l_quantity", "l_extendedprice"])(t("lineitem"))
    return done.select("l_returnflag", "l_linestatus", rounded("l_quantity"), rounded("l_extendedprice", 4))


@register("group_summary", "D1", """
SELECT l_suppkey, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS sum_per_group, round(avg(l_extendedprice), 4) AS avg_per_group,
       count(l_orderkey) AS count_per_group, count(DISTINCT l_partkey) AS unique_per_group
FROM lineitem GROUP BY l_suppkey""")
def group_summary(t):
    money = t("lineitem").select("l_suppkey", "l_orderkey", "l_partkey", F.col("l_extendedprice").cast("decimal(18,2)").alias("price"))
    done = rel.group_summary("l_suppkey", "price", "l_orderkey", "l_partkey")(money)
    return done.select("l_suppkey", F.col("sum_per_group").cast("double").alias("sum_per_group"),
                       F.round(F.col("avg_per_group").cast("double"), 4).alias("avg_per_group"), "count_per_group", "unique_per_group")


@register("exact_quartiles", "D3 D5", """
SELECT 'l_extendedprice' AS "column", round(quantile_cont(l_extendedprice, 0.25), 6) AS q1, round(quantile_cont(l_extendedprice, 0.5), 6) AS median,
       round(quantile_cont(l_extendedprice, 0.75), 6) AS q3 FROM lineitem
UNION ALL SELECT 'l_quantity', round(quantile_cont(l_quantity, 0.25), 6), round(quantile_cont(l_quantity, 0.5), 6),
       round(quantile_cont(l_quantity, 0.75), 6) FROM lineitem""")
def quartiles(t):
    found = quantiles.exact_quantiles(t("lineitem"), ["l_extendedprice", "l_quantity"], [0.25, 0.5, 0.75])
    return t.spark.createDataFrame([(c, *v) for c, v in found.items()], "`column` string, q1 double, median double, q3 double").select(
        "column", rounded("q1"), rounded("median"), rounded("q3"))


@register("numeric_profile", "D4 D6", """
SELECT 'l_quantity' AS "column", min(l_quantity) AS "min", max(l_quantity) AS "max", round(avg(l_quantity), 6) AS mean FROM lineitem
UNION ALL SELECT 'l_extendedprice', min(l_extendedprice), max(l_extendedprice), round(avg(l_extendedprice), 4) FROM lineitem
UNION ALL SELECT 'l_linenumber', min(l_linenumber), max(l_linenumber), round(avg(l_linenumber), 6) FROM lineitem""")
def numeric_profile(t):
    done = profile.numeric_profile(t("lineitem").select("l_quantity", "l_extendedprice", "l_linenumber"))
    digits = F.when(F.col("column") == "l_extendedprice", F.round("mean", 4)).otherwise(F.round("mean", 6))
    return done.select("column", "min", "max", digits.alias("mean"))


@register("population_moments", "D6", """
SELECT round(avg(l_quantity), 6) AS mean, round(stddev_pop(l_quantity), 6) AS std FROM lineitem""")
def moments(t):
    return t("lineitem").agg(rounded(F.avg("l_quantity"), name="mean"), rounded(F.stddev_pop("l_quantity"), name="std"))


@register("most_frequent_values", "D7", """
SELECT 'o_orderstatus' AS "column", (SELECT o_orderstatus FROM orders GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1) AS value
UNION ALL SELECT 'o_orderpriority', (SELECT o_orderpriority FROM orders GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)""")
def most_frequent(t):
    return profile.modes(t("orders"), ["o_orderstatus", "o_orderpriority"])


@register("correlation_pairs", "D8", """
SELECT 'l_quantity' AS "left", 'l_extendedprice' AS "right", round(corr(l_quantity, l_extendedprice), 6) AS corr FROM lineitem
UNION ALL SELECT 'l_quantity', 'l_discount', round(corr(l_quantity, CASE WHEN l_linenumber <> 3 THEN l_discount END), 6) FROM lineitem
UNION ALL SELECT 'l_extendedprice', 'l_discount', round(corr(l_extendedprice, CASE WHEN l_linenumber <> 3 THEN l_discount END), 6) FROM lineitem""")
def correlation_pairs(t):
    gappy = t("lineitem").select("l_quantity", "l_extendedprice", F.when(F.col("l_linenumber") != 3, F.col("l_discount")).alias("l_discount"))
    return profile.correlations(gappy, gappy.columns).select("left", "right", rounded("corr"))


@register("embedding_correlations", "D8", """
WITH e AS (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings)
SELECT 'x' || (i - 1) AS "left", 'x' || (j - 1) AS "right", round(corr(v[i], CASE WHEN (vec_id + j) % 11 <> 0 THEN v[j] END), 6) AS corr
FROM e, range(1, 65) a(i), range(1, 65) b(j) WHERE i < j AND (vec_id + i) % 11 <> 0 GROUP BY i, j""")
def embedding_correlations(t):
    """All pairs of 64 columns, each with gaps of its own."""
    gaps = F.transform(F.col("embedding").cast("array<double>"), lambda x, i: F.when((F.col("vec_id") + i + 1) % 11 != 0, x))
    found = profile.wide_correlations(t("embeddings"), [f"x{i}" for i in range(64)], gaps)
    return found.select("left", "right", rounded("corr"))


@register("first_row_per_key", "D9", """
SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS rn
FROM lineitem) WHERE rn = 1""")
def first_row(t):
    lines = t("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_suppkey", "l_extendedprice")
    kept = rel.keep_first(["l_orderkey"], ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"])(lines)
    return kept.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")


@register("duplicate_counts", "D10 D15", """
SELECT count(*) AS total, count(DISTINCT coalesce(k, -1)) AS distinct_values, count(*) - count(DISTINCT coalesce(k, -1)) AS duplicates
FROM (SELECT nullif(o_custkey % 900, 0) AS k FROM orders)""")
def duplicate_counts(t):
    return profile.duplicate_counts(t("orders").select(F.nullif(F.col("o_custkey") % 900, F.lit(0)).alias("k")), "k")


@register("repeated_values", "D10", """
SELECT o_custkey, CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS BIGINT) AS repeat FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) > 1""")
def repeated(t):
    return profile.repeated_values(t("orders"), "o_custkey")


@register("missing_profile", "D11", """
WITH g AS (SELECT CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE o_totalprice END AS price, CASE WHEN o_orderkey % 4 = 1 THEN NULL ELSE o_orderstatus END AS status FROM orders)
SELECT 'price' AS "column", count(*) - count(price) AS null_count, round((count(*) - count(price)) * 100.0::DOUBLE / count(*), 6) AS null_pct FROM g
UNION ALL SELECT 'status', count(*) - count(status), round((count(*) - count(status)) * 100.0::DOUBLE / count(*), 6) FROM g""")
def missing_profile(t):
    gappy = t("orders").select(F.when(F.col("o_orderkey") % 9 != 0, F.col("o_totalprice")).alias("price"),
                               F.when(F.col("o_orderkey") % 4 != 1, F.col("o_orderstatus")).alias("status"))
    return profile.missing_profile(gappy).select("column", "null_count", rounded("null_pct"))


@register("column_cardinality", "D12 K5", """
SELECT 'o_custkey' AS "column", count(DISTINCT o_custkey) AS distinct_values FROM orders
UNION ALL SELECT 'o_orderpriority', count(DISTINCT o_orderpriority) FROM orders
UNION ALL SELECT 'joined', count(DISTINCT o_orderpriority || '_' || o_custkey) FROM orders""")
def column_cardinality(t):
    orders = t("orders").withColumn("joined", F.concat_ws("_", "o_orderpriority", F.col("o_custkey").cast("string")))
    return profile.cardinality(orders, ["o_custkey", "o_orderpriority", "joined"])


@register("balanced_class_weights", "D13 N7", """
SELECT quality, count(*) AS n, round((SELECT count(*) FROM labels)::DOUBLE / ((SELECT count(DISTINCT quality) FROM labels) * count(*)), 6) AS weight
FROM labels GROUP BY quality""")
def balanced_weights(t):
    return profile.class_weights(t("labels"), "quality").select("quality", "n", rounded("weight"))


@register("table_size", "D15", "SELECT count(*) AS rows, count(*) = 0 AS is_empty FROM lineitem")
def table_size(t):
    return profile.size_check(t("lineitem"))


@register("sorted_descending", "F1 F2 F3", """
SELECT o_orderkey, CASE WHEN o_orderkey % 8 = 0 THEN NULL ELSE o_totalprice END AS price FROM orders ORDER BY price DESC NULLS LAST, o_orderkey""")
def sorted_descending(t):
    gappy = t("orders").select("o_orderkey", F.when(F.col("o_orderkey") % 8 != 0, F.col("o_totalprice")).alias("price"))
    return gappy.transform(rel.sort_rows(("price", False), ("o_orderkey", True)))


@register("best_rows_by_score", "F6 F7", """
SELECT l_suppkey, round(avg(l_discount), 8) AS score FROM lineitem GROUP BY l_suppkey ORDER BY score DESC, l_suppkey LIMIT 10""")
def best(t):
    scores = t("lineitem").groupBy("l_suppkey").agg(F.round(F.avg("l_discount"), 8).alias("score"))
    return rel.best_rows("score", "l_suppkey", 10)(scores)


@register("keyed_row_sample", "A15", f"""
SELECT o_orderkey, o_totalprice FROM orders ORDER BY {sql_hash('o_orderkey')}, o_orderkey LIMIT 100""")
def keyed_sample(t):
    return t("orders").select("o_orderkey", "o_totalprice").transform(rel.sample_rows(100, "o_orderkey"))


@register("union_by_name", "G1", """
SELECT c_custkey AS key, c_acctbal AS balance, c_mktsegment AS segment FROM customer
UNION ALL SELECT s_suppkey, s_acctbal, NULL FROM supplier""")
def union_by_name(t):
    customers = t("customer").select(F.col("c_custkey").alias("key"), F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment"))
    suppliers = t("supplier").select(F.col("s_acctbal").alias("balance"), F.col("s_suppkey").alias("key"))
    return rel.union_all([customers, suppliers])


@register("set_difference", "G2 C4", """
SELECT c_custkey AS k FROM customer EXCEPT SELECT o_custkey FROM orders WHERE o_totalprice > 200000""")
def set_difference(t):
    return rel.values_missing_from(t("customer").select(F.col("c_custkey").alias("k")),
                                   t("orders").where("o_totalprice > 200000").select(F.col("o_custkey").alias("k")))


@register("distinct_values", "G3", "SELECT DISTINCT l_shipdate FROM lineitem")
def distinct_values(t):
    return t("lineitem").select("l_shipdate").distinct()


@register("parquet_with_declared_types", "A6 H8 H9 H12", """
SELECT l_orderkey::INTEGER AS l_orderkey, l_linenumber::TINYINT AS l_linenumber, l_quantity::BIGINT AS l_quantity, l_discount::FLOAT AS l_discount,
       CASE WHEN l_returnflag IN ('A', 'R') THEN l_returnflag END AS l_returnflag
FROM lineitem""")
def declared_types(t):
    columns = ["l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_returnflag"]
    step = rows.enforce_schema({"l_orderkey": "int", "l_linenumber": "tinyint", "l_quantity": "bigint", "l_discount": "float",
                                "l_returnflag": "string"}, domains={"l_returnflag": ["A", "R"]})
    return read_parquet(t.spark, t.path("lineitem")).select(*columns).transform(step)


@register("parquet_in_chunks", "A8 A9 I2 I3", """
SELECT o_orderkey, o_orderstatus, round(o_totalprice * 1.1::DOUBLE, 4) AS gross FROM orders WHERE o_totalprice > 100000""")
def in_chunks(t):
    def chunk_chain(pdf):
        return pdf[pdf["o_totalprice"] > 100000].assign(gross=lambda d: d["o_totalprice"] * 1.1)[["o_orderkey", "o_orderstatus", "gross"]]

    table = t("orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    return run_in_chunks(table, chunk_chain, "o_orderkey bigint, o_orderstatus string, gross double", rows=10_000).withColumn(
        "gross", F.round("gross", 4))
