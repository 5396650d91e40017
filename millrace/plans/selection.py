"""Feature scores and selections over lineitem."""

from pyspark.sql import functions as F

from millrace.ml import select
from millrace.plans.catalog import register, rounded

FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def lines(t):
    """Line items with a 0/1 target that depends on price and discount."""
    return t("lineitem").select(
        *FEATURES, "l_linenumber", "l_returnflag", "l_orderkey", "l_partkey",
        (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("revenue"),
        (F.col("l_extendedprice") * F.lit(1.1) + F.col("l_quantity")).alias("price_copy"))


_LINES = "WITH l AS (SELECT *, l_extendedprice * (1 - l_discount) AS revenue, l_extendedprice * 1.1::DOUBLE + l_quantity AS price_copy FROM lineitem)\n"


def _union(template: str, names) -> str:
    return " UNION ALL ".join(template.replace("{c}", c) for c in names)


def _kept_table(t, model, columns):
    kept = set(model.kept)
    return t.spark.createDataFrame([(c, c in kept) for c in columns], "feature string, kept boolean")


@register("variance_scores", "M1", _union(
    "SELECT '{c}' AS feature, round(var_pop({c}), 4) AS score, var_pop({c}) > 0.01 AS kept FROM lineitem", FEATURES))
def variance_scores(t):
    table = lines(t)
    kept = set(select.VarianceThreshold(FEATURES, 0.01).fit(table).kept)
    scores = select.variances(table, FEATURES).select("feature", rounded("score", 4))
    return scores.withColumn("kept", F.col("feature").isin(sorted(kept)))


@register("anova_scores", "M2 F7", _union("""
SELECT '{c}' AS feature, round((sum(n * (m - g) ^ 2) / (count(*) - 1)) / (sum(n * v) / (sum(n) - count(*))), 6) AS score
FROM (SELECT count(*) AS n, avg({c}) AS m, var_pop({c}) AS v, (SELECT avg({c}) FROM lineitem) AS g FROM lineitem GROUP BY l_returnflag)""", FEATURES))
def anova_scores(t):
    return select.anova_f(lines(t), FEATURES, "l_returnflag").select("feature", rounded("score"))


@register("regression_f_scores", "M3", _LINES + _union("""
SELECT '{c}' AS feature, round(corr({c}, revenue) ^ 2 / (1 - corr({c}, revenue) ^ 2) * (count(*) - 2), 2) AS score FROM l""", FEATURES))
def regression_scores(t):
    return select.regression_f(lines(t), FEATURES, "revenue").select("feature", rounded("score", 2))


@register("chi2_scores", "M4", _union("""
SELECT '{c}' AS feature, round(sum((o - e) ^ 2 / e), 6) AS score FROM (SELECT sum({c})::DOUBLE AS o, count(*)::DOUBLE / (SELECT count(*) FROM lineitem) * (SELECT sum({c}) FROM lineitem) AS e
FROM lineitem GROUP BY l_returnflag)""", ["l_quantity", "l_linenumber"]))
def chi2_scores(t):
    return select.chi2(lines(t), ["l_quantity", "l_linenumber"], "l_returnflag").select("feature", rounded("score"))


def _bins(c: str, table: str) -> str:
    cuts = ", ".join(f"{i / 10}::DOUBLE" for i in range(1, 10))
    return (f"len(list_filter(list_distinct((SELECT quantile_cont({c}::DOUBLE, [{cuts}]) FROM {table})), lambda q: {c} > q))")


_MI = """
SELECT '{c}' AS feature, round(sum(n / t * ln(n * t / (nx * ny))), 6) AS score FROM (SELECT n::DOUBLE AS n, sum(n) OVER ()::DOUBLE AS t,
  sum(n) OVER (PARTITION BY x)::DOUBLE AS nx, sum(n) OVER (PARTITION BY y)::DOUBLE AS ny FROM (SELECT {x} AS x, {y} AS y, count(*) AS n FROM {table} GROUP BY ALL))"""


@register("mutual_information_with_class", "M5", " UNION ALL ".join(
    _MI.replace("{c}", c).replace("{x}", _bins(c, "lineitem")).replace("{y}", "l_returnflag").replace("{table}", "lineitem") for c in FEATURES))
def mutual_with_class(t):
    return select.mutual_information(lines(t), FEATURES, "l_returnflag").select("feature", rounded("score"))


@register("mutual_information_with_number", "M6", _LINES + " UNION ALL ".join(
    _MI.replace("{c}", c).replace("{x}", _bins(c, "l")).replace("{y}", _bins("revenue", "l")).replace("{table}", "l") for c in FEATURES))
def mutual_with_number(t):
    return select.mutual_information(lines(t), FEATURES, "revenue", continuous_target=True).select("feature", rounded("score"))


@register("correlated_columns_dropped", "M7 D8", _LINES + """
SELECT 'l_quantity' AS feature, true AS kept UNION ALL SELECT 'l_extendedprice', abs(corr(l_extendedprice, l_quantity)) <= 0.95 FROM l
UNION ALL SELECT 'revenue', greatest(abs(corr(revenue, l_quantity)), abs(corr(revenue, l_extendedprice))) <= 0.95 FROM l
UNION ALL SELECT 'price_copy', greatest(abs(corr(price_copy, l_quantity)), abs(corr(price_copy, l_extendedprice)), abs(corr(price_copy, revenue))) <= 0.95 FROM l""")
def correlated_dropped(t):
    columns = ["l_quantity", "l_extendedprice", "revenue", "price_copy"]
    return _kept_table(t, select.CorrelationDropper(columns, 0.95).fit(lines(t)), columns)


@register("best_features_kept", "F7 M2", """
WITH s AS (""" + _union("""
SELECT '{c}' AS feature, (sum(n * (m - g) ^ 2) / (count(*) - 1)) / (sum(n * v) / (sum(n) - count(*))) AS score
FROM (SELECT count(*) AS n, avg({c}) AS m, var_pop({c}) AS v, (SELECT avg({c}) FROM lineitem) AS g FROM lineitem GROUP BY l_returnflag)""", FEATURES) + """)
SELECT feature, row_number() OVER (ORDER BY score DESC, feature) <= 2 AS kept FROM s""")
def best_features(t):
    return _kept_table(t, select.SelectKBest(FEATURES, "l_returnflag", "f_classif", k=2).fit(lines(t)), FEATURES)
