"""Fitted preprocessing: fit on training rows, apply to training and test rows."""

from pyspark.sql import functions as F

from millrace.ml import clip, encode, impute, scale
from millrace.ml.base import ColumnRouter
from millrace.ml.split import train_test_split
from millrace.plans.catalog import register, rounded, sql_hash
from millrace.session import materialise

# Orders with outliers, gaps and a target, all made from the key; a fifth of the rows is the test part.
ORDERS_SQL = f"""
WITH o AS (SELECT o_orderkey, o_orderpriority AS priority, o_orderstatus AS status, o_custkey % 97 AS city,
  CASE WHEN o_orderkey % 50 = 0 THEN o_totalprice * 10 ELSE o_totalprice END AS price,
  CASE WHEN o_orderkey % 6 <> 0 THEN o_custkey::DOUBLE END AS cust,
  CASE WHEN o_orderkey % 9 <> 0 THEN o_orderstatus END AS status_gap,
  (o_totalprice > 250000)::INTEGER AS target,
  row_number() OVER (ORDER BY {sql_hash('o_orderkey')}, o_orderkey) <= ceil(0.2::DOUBLE * (SELECT count(*) FROM orders)) AS is_test FROM orders),
tr AS (SELECT * FROM o WHERE NOT is_test)
"""


def orders(t):
    k, price = F.col("o_orderkey"), F.col("o_totalprice")
    table = t("orders").select(
        "o_orderkey", F.col("o_orderpriority").alias("priority"), F.col("o_orderstatus").alias("status"),
        (F.col("o_custkey") % 97).alias("city"), F.when(k % 50 == 0, price * 10).otherwise(price).alias("price"),
        F.when(k % 6 != 0, F.col("o_custkey").cast("double")).alias("cust"),
        F.when(k % 9 != 0, F.col("o_orderstatus")).alias("status_gap"), (price > 250000).cast("int").alias("target"))
    # Stored once: fitting and applying make several passes, which must not repeat the split.
    return materialise(train_test_split(table, "o_orderkey", 0.2), "orders")


def fit_on_train(estimator, table):
    return estimator.fit(table.where(~F.col("is_test")))


@register("iqr_clipped", "L1 D5 H14 I5 I8", ORDERS_SQL + """
, b AS (SELECT quantile_cont(price, 0.25) AS q1, quantile_cont(price, 0.75) AS q3 FROM tr)
SELECT o_orderkey, is_test, round(least(greatest(price, q1 - 1.5::DOUBLE * (q3 - q1)), q3 + 1.5::DOUBLE * (q3 - q1)), 4) AS price FROM o, b""")
def iqr_clipped(t):
    table = orders(t)
    return fit_on_train(clip.IQRClipper(["price"], 1.5), table).transform(table).select("o_orderkey", "is_test", rounded("price", 4))


@register("zscore_clipped", "L2 D6 H14 I8", ORDERS_SQL + """
, b AS (SELECT avg(price) AS m, stddev_pop(price) AS s FROM tr)
SELECT o_orderkey, is_test, round(least(greatest(price, m - 3 * s), m + 3 * s), 4) AS price FROM o, b""")
def zscore_clipped(t):
    table = orders(t)
    return fit_on_train(clip.ZScoreClipper(["price"], 3.0), table).transform(table).select("o_orderkey", "is_test", rounded("price", 4))


@register("median_imputed_with_indicator", "L3 L4 I8", ORDERS_SQL + """
SELECT o_orderkey, coalesce(cust, (SELECT quantile_cont(cust, 0.5) FROM tr)) AS cust, (cust IS NULL)::INTEGER AS missing_cust, price FROM o""")
def median_imputed(t):
    table = orders(t)
    model = fit_on_train(impute.MedianImputer(["cust", "price"], indicators=True), table)
    return model.transform(table).select("o_orderkey", "cust", "missing_cust", "price")


@register("mode_imputed", "L5 D7", ORDERS_SQL + """
SELECT o_orderkey, coalesce(status_gap, (SELECT status_gap FROM tr WHERE status_gap IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)) AS status_gap FROM o""")
def mode_imputed(t):
    table = orders(t)
    return fit_on_train(impute.ModeImputer(["status_gap"]), table).transform(table).select("o_orderkey", "status_gap")


DIMS = [f"x{i}" for i in range(64)]


def _gappy(t):
    """The embedding's dimensions as columns, three or four of each row missing."""
    gaps = F.transform(F.col("embedding").cast("array<double>"), lambda x, i: F.when((F.col("vec_id") + i + 1) % 19 != 0, x))
    return t("embeddings").select(F.col("vec_id").alias("id"), gaps.alias("v")).select("id", *[F.col("v")[i].alias(c) for i, c in enumerate(DIMS)])


@register("knn_imputed", "L6 C6", f"""
WITH e AS (SELECT vec_id AS id, list_transform(embedding::DOUBLE[], lambda x, i: CASE WHEN (vec_id + i) % 19 <> 0 THEN x END) AS v FROM embeddings),
gaps AS (SELECT q.id, q.v AS qv, d.id AS donor, d.v AS dv, list_transform(list_zip(q.v, d.v), lambda p: (p[1] - p[2]) ^ 2) AS parts FROM e q JOIN e d ON true),
far AS (SELECT id, qv, donor, dv, sqrt({len(DIMS)}.0::DOUBLE / len(list_filter(parts, lambda x: x IS NOT NULL)) * list_sum(parts)) AS dist FROM gaps),
near AS (SELECT id, i, dv[i] AS v, dist FROM far, range(1, {len(DIMS) + 1}) r(i) WHERE qv[i] IS NULL AND dv[i] IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY id, i ORDER BY dist, donor) <= 5),
fills AS (SELECT id, i, CASE WHEN count(*) FILTER (WHERE dist = 0) > 0 THEN avg(v) FILTER (WHERE dist = 0) ELSE sum(v / dist) / sum(1 / dist) END AS v
  FROM near GROUP BY id, i),
wide AS (SELECT id, {", ".join(f"max(v) FILTER (WHERE i = {i + 1}) AS {c}" for i, c in enumerate(DIMS))} FROM fills GROUP BY id)
SELECT e.id, {", ".join(f"round(coalesce(e.v[{i + 1}], w.{c}), 6) AS {c}" for i, c in enumerate(DIMS))} FROM e LEFT JOIN wide w ON w.id = e.id""")
def knn_imputed(t):
    points = _gappy(t)
    done = impute.KNNImputer(DIMS, key="id", k=5).fit(points).transform(points)
    return done.select("id", *[rounded(c) for c in DIMS])


@register("chained_regression_imputed", "L7", """
WITH o AS (SELECT o_orderkey, CASE WHEN o_orderkey % 5 <> 0 THEN o_totalprice END AS x, CASE WHEN o_orderkey % 7 <> 0 THEN o_totalprice * 0.5 + o_custkey * 10 END AS y FROM orders),
a AS (SELECT *, coalesce(x, (SELECT avg(x) FROM o)) AS x0, coalesce(y, (SELECT avg(y) FROM o)) AS y0 FROM o),
b AS (SELECT *, coalesce(x, (SELECT regr_intercept(x, y0) FROM a) + (SELECT regr_slope(x, y0) FROM a) * y0) AS x1 FROM a),
c AS (SELECT *, coalesce(y, (SELECT regr_intercept(y, x1) FROM b) + (SELECT regr_slope(y, x1) FROM b) * x1) AS y1 FROM b),
d AS (SELECT *, coalesce(x, (SELECT regr_intercept(x, y1) FROM c) + (SELECT regr_slope(x, y1) FROM c) * y1) AS x2 FROM c),
e AS (SELECT *, coalesce(y, (SELECT regr_intercept(y, x2) FROM d) + (SELECT regr_slope(y, x2) FROM d) * x2) AS y2 FROM d)
SELECT o_orderkey, round(x2, 3) AS x, round(y2, 3) AS y FROM e""")
def chained(t):
    k, price = F.col("o_orderkey"), F.col("o_totalprice")
    table = t("orders").select("o_orderkey", F.when(k % 5 != 0, price).alias("x"),
                               F.when(k % 7 != 0, price * F.lit(0.5) + F.col("o_custkey") * 10).alias("y"))
    done = impute.MICEImputer(["x", "y"], max_iter=2, tol=0.0).fit(table).transform(table)
    return done.select("o_orderkey", rounded("x", 3), rounded("y", 3))


@register("one_hot_encoded", "L9 I8", ORDERS_SQL + """
SELECT o_orderkey, coalesce((s = 'F')::INTEGER, 0) AS status_F, coalesce((s = 'O')::INTEGER, 0) AS status_O, coalesce((s = 'P')::INTEGER, 0) AS status_P FROM
  (SELECT o_orderkey, CASE WHEN o_orderkey % 40 = 0 THEN 'unseen' ELSE status END AS s FROM o)""")
def one_hot(t):
    table = orders(t)
    seen = F.when(F.col("o_orderkey") % 40 == 0, "unseen").otherwise(F.col("status")).alias("status")
    model = fit_on_train(encode.OneHotEncoder(["status"]), table)
    return model.transform(table.select("o_orderkey", seen)).select("o_orderkey", "status_F", "status_O", "status_P")


@register("ordinal_encoded", "L10", """
SELECT o_orderkey, CASE o_orderpriority WHEN '5-LOW' THEN 0 WHEN '3-MEDIUM' THEN 1 WHEN '2-HIGH' THEN 2 WHEN '1-URGENT' THEN 3 ELSE -1 END AS o_orderpriority FROM orders""")
def ordinal(t):
    table = t("orders").select("o_orderkey", "o_orderpriority")
    return encode.OrdinalEncoder({"o_orderpriority": ["5-LOW", "3-MEDIUM", "2-HIGH", "1-URGENT"]}).fit(table).transform(table)


@register("target_encoded", "L11 I8", ORDERS_SQL + """
, p AS (SELECT avg(target) AS prior FROM tr),
g AS (SELECT city, sum(target)::DOUBLE AS s, count(*) AS n, 1.0::DOUBLE / (1.0::DOUBLE + exp(-(count(*) - 20) / 10.0::DOUBLE)) AS w FROM tr GROUP BY city)
SELECT o_orderkey, round(coalesce(prior * (1 - w) + s / n * w, prior), 8) AS city FROM o LEFT JOIN g ON g.city = o.city AND o.city <> 13, p""")
def target_encoded(t):
    table = orders(t).withColumn("city", F.when(F.col("city") != 13, F.col("city")))
    model = fit_on_train(encode.TargetEncoder(["city"], target="target"), table)
    return model.transform(table).select("o_orderkey", rounded("city", 8))


@register("leave_one_out_encoded", "L12", ORDERS_SQL + """
, p AS (SELECT avg(target) AS prior FROM tr), g AS (SELECT city, sum(target)::DOUBLE AS s, count(*) AS n FROM tr GROUP BY city)
SELECT o_orderkey, is_test, round(coalesce(CASE WHEN is_test THEN s / n WHEN n > 1 THEN (s - target) / (n - 1) END, prior), 8) AS city
FROM o LEFT JOIN g ON g.city = o.city, p""")
def leave_one_out(t):
    table = orders(t)
    model = fit_on_train(encode.LeaveOneOutEncoder(["city"], target="target"), table)
    both = model.encode_training(table.where(~F.col("is_test"))).unionByName(model.transform(table.where("is_test")))
    return both.select("o_orderkey", "is_test", rounded("city", 8))


@register("binary_encoded", "L13", f"""
WITH c AS (SELECT k, row_number() OVER (ORDER BY {sql_hash('k', 'code')}, k) AS code FROM (SELECT DISTINCT o_custkey % 55 AS k FROM orders))
SELECT o_orderkey, ((code >> 5) & 1)::INTEGER AS city_0, ((code >> 4) & 1)::INTEGER AS city_1, ((code >> 3) & 1)::INTEGER AS city_2, ((code >> 2) & 1)::INTEGER AS city_3,
       ((code >> 1) & 1)::INTEGER AS city_4, (code & 1)::INTEGER AS city_5 FROM orders JOIN c ON c.k = o_custkey % 55""")
def binary_encoded(t):
    table = t("orders").select("o_orderkey", (F.col("o_custkey") % 55).alias("city"))
    return encode.BinaryEncoder(["city"]).fit(table).transform(table)


@register("sparse_one_hot", "L9", f"""
WITH o AS (SELECT o_orderkey, CASE WHEN o_orderkey % 13 <> 0 THEN o_custkey END AS customer, o_orderkey % 4 <> 0 AS known FROM orders),
c AS (SELECT customer, row_number() OVER (ORDER BY {sql_hash('customer', 'code')}, customer) - 1 AS place FROM (SELECT DISTINCT customer FROM o WHERE known AND customer IS NOT NULL))
SELECT o_orderkey, (SELECT count(*) FROM c) AS places, place, CASE WHEN place IS NOT NULL THEN 1.0::DOUBLE END AS value FROM o LEFT JOIN c USING (customer)""")
def sparse_one_hot(t):
    """A place for every customer of three quarters of the orders; all others, and missing ones, are zeros."""
    table = t("orders").select("o_orderkey", F.when(F.col("o_orderkey") % 13 != 0, F.col("o_custkey")).alias("customer"))
    model = encode.SparseOneHotEncoder(["customer"]).fit(table.where("o_orderkey % 4 <> 0"))
    parts = F.from_json(F.to_json(F.struct("one_hot")), "one_hot struct<type:int, size:bigint, indices:array<bigint>, values:array<double>>")["one_hot"]
    done = model.transform(table).select("o_orderkey", parts.alias("v"))
    return done.select("o_orderkey", F.col("v.size").alias("places"), F.get("v.indices", F.lit(0)).alias("place"), F.get("v.values", F.lit(0)).alias("value"))


@register("hash_encoded", "L14", "SELECT o_orderkey, " + ", ".join(
    f"({sql_hash('o_custkey', 'hash')} % 8 = {i})::INTEGER AS o_custkey_{i}" for i in range(8)) + " FROM orders")
def hash_encoded(t):
    table = t("orders").select("o_orderkey", "o_custkey")
    return encode.HashingEncoder(["o_custkey"], 8).fit(table).transform(table)


@register("scaled_three_ways", "L15 L16 L17 I7 I8", ORDERS_SQL + """
, s AS (SELECT avg(price) AS m, stddev_pop(price) AS sd, min(city) AS lo, max(city) AS hi, quantile_cont(cust, 0.25) AS q1, quantile_cont(cust, 0.5) AS q2, quantile_cont(cust, 0.75) AS q3 FROM tr)
SELECT o_orderkey, round((price - m) / sd, 6) AS price, round((city - lo)::DOUBLE / (hi - lo), 6) AS city, round((cust - q2) / (q3 - q1), 6) AS cust, status FROM o, s""")
def scaled(t):
    table = orders(t)
    router = ColumnRouter([scale.StandardScaler(["price"]), scale.MinMaxScaler(["city"]), scale.RobustScaler(["cust"])])
    done = fit_on_train(router, table).transform(table)
    return done.select("o_orderkey", rounded("price"), rounded("city"), rounded("cust"), "status")


@register("mixed_encoding_pipeline", "I7 I8 L9 L10 L11 L14", ORDERS_SQL + """
, p AS (SELECT avg(target) AS prior FROM tr),
g AS (SELECT city, sum(target)::DOUBLE AS s, count(*) AS n, 1.0::DOUBLE / (1.0::DOUBLE + exp(-(count(*) - 20) / 10.0::DOUBLE)) AS w FROM tr GROUP BY city)
SELECT o_orderkey, (status = 'F')::INTEGER AS status_F, (status = 'O')::INTEGER AS status_O, (status = 'P')::INTEGER AS status_P,
  CASE priority WHEN '5-LOW' THEN 0 WHEN '3-MEDIUM' THEN 1 WHEN '1-URGENT' THEN 2 ELSE -1 END AS priority, round(coalesce(prior * (1 - w) + s / n * w, prior), 8) AS city
FROM o LEFT JOIN g USING (city), p""")
def mixed_encoding(t):
    table = orders(t)
    router = ColumnRouter([encode.OneHotEncoder(["status"]), encode.OrdinalEncoder({"priority": ["5-LOW", "3-MEDIUM", "1-URGENT"]}),
                           encode.TargetEncoder(["city"], target="target")])
    done = fit_on_train(router, table).transform(table)
    return done.select("o_orderkey", "status_F", "status_O", "status_P", "priority", rounded("city", 8))


@register("ordered_target_statistics", "P5", f"""
WITH o AS (SELECT o_orderkey, o_orderpriority, (o_totalprice > 250000)::INTEGER AS y, {sql_hash('o_orderkey')} AS h FROM orders)
SELECT o_orderkey, (coalesce(sum(y) OVER w, 0)::DOUBLE + (SELECT avg(y) FROM o)) / (count(*) OVER w + 1.0::DOUBLE) AS stat FROM o
WINDOW w AS (PARTITION BY o_orderpriority ORDER BY h, o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)""")
def ordered_statistics(t):
    table = t("orders").select("o_orderkey", "o_orderpriority", (F.col("o_totalprice") > 250000).cast("int").alias("y"))
    return encode.ordered_target_statistics(table, "o_orderkey", "o_orderpriority", "y", "stat").select("o_orderkey", "stat")


@register("ordered_target_statistics_missing_category", "P5", f"""
WITH o AS (SELECT o_orderkey, CASE WHEN o_orderpriority NOT LIKE '3%' THEN o_orderpriority END AS p, (o_totalprice > 250000)::INTEGER AS y, {sql_hash('o_orderkey')} AS h FROM orders)
SELECT o_orderkey, (coalesce(sum(y) OVER w, 0)::DOUBLE + (SELECT avg(y) FROM o)) / (count(*) OVER w + 1.0::DOUBLE) AS stat FROM o
WINDOW w AS (PARTITION BY p ORDER BY h, o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)""")
def ordered_statistics_missing_category(t):
    category = F.when(~F.col("o_orderpriority").startswith("3"), F.col("o_orderpriority")).alias("p")
    table = t("orders").select("o_orderkey", category, (F.col("o_totalprice") > 250000).cast("int").alias("y"))
    return encode.ordered_target_statistics(table, "o_orderkey", "p", "y", "stat").select("o_orderkey", "stat")


@register("imputers_routed_together", "I7 L6 L7 L8", """
WITH o AS (SELECT o_orderkey, o_orderdate, CASE WHEN o_orderkey % 5 <> 0 THEN o_totalprice END AS med, CASE WHEN o_orderkey % 6 <> 0 THEN o_orderstatus END AS mo,
  CASE WHEN o_orderkey % 4 <> 0 THEN o_custkey::DOUBLE END AS ff, CASE WHEN o_orderkey % 7 <> 0 THEN o_totalprice::DOUBLE * 2 END AS chained FROM orders)
SELECT o_orderkey, round(coalesce(med, (SELECT median(med) FROM o)), 4) AS med, coalesce(mo, (SELECT m FROM (SELECT mo AS m, count(*) AS n FROM o WHERE mo IS NOT NULL GROUP BY mo ORDER BY n DESC, mo LIMIT 1))) AS mo,
  last_value(ff IGNORE NULLS) OVER (ORDER BY o_orderdate, o_orderkey) AS ff, chained IS NULL AS gap, true AS close FROM o""")
def imputers_routed(t):
    """Median, mode, forward fill and chained regression fitted and applied in one router; a regression's gap lies on a line."""
    k, price = F.col("o_orderkey"), F.col("o_totalprice").cast("double")
    table = materialise(t("orders").select(
        "o_orderkey", "o_orderdate", F.when(k % 5 != 0, price).alias("med"), F.when(k % 6 != 0, F.col("o_orderstatus")).alias("mo"),
        F.when(k % 4 != 0, F.col("o_custkey").cast("double")).alias("ff"), F.when(k % 7 != 0, price * 2).alias("chained"),
        price.alias("whole"), (k % 7 == 0).alias("gap")), "routed")
    router = ColumnRouter([
        impute.MedianImputer(["med"]), impute.ModeImputer(["mo"]), impute.MICEImputer(["whole", "chained"], max_iter=3),
        impute.forward_fill_step(["ff"], "o_orderdate", "o_orderkey")])
    done = router.fit(table).transform(table)
    return done.select("o_orderkey", rounded("med", 4), "mo", "ff", "gap", (F.abs(F.col("chained") - 2 * F.col("whole")) < 1e-3).alias("close"))
