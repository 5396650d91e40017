"""Evaluation metrics over whole score tables made from lineitem."""

from pyspark.sql import functions as F

from millrace.ml import crossval, ensemble, metrics
from millrace.plans.catalog import register, rounded

# Enough slices at the benchmark scale to exercise the sliced curve.
SLICE_ROWS = 50_000


def binary(t):
    return t("lineitem").select(
        (F.col("l_returnflag") == "R").cast("int").alias("y"), F.col("l_extendedprice").alias("score"),
        (F.col("l_extendedprice") > 60000).cast("int").alias("pred"),
        (F.col("l_extendedprice") / F.lit(120000.0)).alias("p"))


_BINARY = """
WITH b AS (SELECT (l_returnflag = 'R')::INTEGER AS y, l_extendedprice AS score, (l_extendedprice > 60000)::INTEGER AS pred, l_extendedprice / 120000 AS p FROM lineitem),
g AS (SELECT score, sum(y)::DOUBLE AS pos, sum(1 - y)::DOUBLE AS neg FROM b GROUP BY score),
c AS (SELECT score, pos, neg, sum(pos) OVER (ORDER BY score DESC) AS tp, sum(neg) OVER (ORDER BY score DESC) AS fp, sum(pos) OVER () AS npos, sum(neg) OVER () AS nneg FROM g)
"""


@register("roc_auc", "Q1 E6", _BINARY + "SELECT round(sum(pos * (nneg - fp + neg / 2)) / (any_value(npos) * any_value(nneg)), 9) AS roc_auc FROM c")
def roc_auc(t):
    return metrics.roc_auc(binary(t), "y", "score", rows_per_slice=SLICE_ROWS).select(rounded("roc_auc", 9))


@register("pr_auc_trapezoid", "Q2", _BINARY + """
, l AS (SELECT score, tp / npos AS r, tp / (tp + fp) AS p, lag(tp / npos, 1, 0.0::DOUBLE) OVER (ORDER BY score DESC) AS r0, lag(tp / (tp + fp), 1, 1.0::DOUBLE) OVER (ORDER BY score DESC) AS p0 FROM c)
SELECT round(sum((r - r0) * (p + p0) / 2), 9) AS pr_auc FROM l""")
def pr_auc(t):
    return metrics.pr_auc(binary(t), "y", "score", rows_per_slice=SLICE_ROWS).select(rounded("pr_auc", 9))


@register("average_precision", "Q3", _BINARY + "SELECT round(sum(pos / npos * tp / (tp + fp)), 9) AS average_precision FROM c")
def average_precision(t):
    return metrics.average_precision(binary(t), "y", "score", rows_per_slice=SLICE_ROWS).select(rounded("average_precision", 9))


@register("pr_curve_points", "Q4", _BINARY + "SELECT score AS threshold, round(tp / (tp + fp), 9) AS precision, round(tp / npos, 9) AS recall FROM c")
def pr_curve(t):
    return metrics.pr_curve(binary(t), "y", "score", SLICE_ROWS).select("threshold", rounded("precision", 9), rounded("recall", 9))


@register("rmse", "Q5", "SELECT round(sqrt(avg((l_extendedprice - l_quantity * 1000) ^ 2)), 4) AS rmse FROM lineitem")
def rmse(t):
    scored = t("lineitem").select("l_extendedprice", (F.col("l_quantity") * 1000).alias("guess"))
    return metrics.rmse(scored, "l_extendedprice", "guess").select(rounded("rmse", 4))


@register("log_loss", "Q8", _BINARY + """
SELECT round(avg(-ln(least(greatest(CASE WHEN y = 1 THEN p ELSE 1 - p END, 2.220446049250313e-16), 1 - 2.220446049250313e-16))), 8) AS log_loss FROM b""")
def log_loss(t):
    scored = binary(t).withColumn("true_p", F.when(F.col("y") == 1, F.col("p")).otherwise(F.lit(1.0) - F.col("p")))
    return metrics.log_loss(scored, "true_p").select(rounded("log_loss", 8))


@register("binary_confusion", "Q9", _BINARY + """
SELECT count(*) FILTER (WHERE y = 0 AND pred = 0) AS tn, count(*) FILTER (WHERE y = 0 AND pred = 1) AS fp, count(*) FILTER (WHERE y = 1 AND pred = 0) AS fn,
       count(*) FILTER (WHERE y = 1 AND pred = 1) AS tp FROM b""")
def confusion(t):
    return metrics.binary_confusion(binary(t), "y", "pred")


@register("binary_rates", "Q11", _BINARY + """
SELECT round(sum(y * pred)::DOUBLE / sum(pred), 9) AS precision, round(sum(y * pred)::DOUBLE / sum(y), 9) AS recall, round(avg((y = pred)::INTEGER), 9) AS accuracy FROM b""")
def rates(t):
    done = metrics.binary_rates(binary(t), "y", "pred")
    return done.select(rounded("precision", 9), rounded("recall", 9), rounded("accuracy", 9))


@register("binary_f1", "Q6", _BINARY + "SELECT round(2.0::DOUBLE * sum(y * pred) / (sum(y) + sum(pred)), 9) AS f1 FROM b")
def binary_f1(t):
    return metrics.f1(binary(t), "y", "pred", average="binary").select(rounded("f1", 9))


def multiclass(t):
    q = F.col("l_quantity")
    return t("lineitem").select(
        F.col("l_returnflag").alias("label"), F.when(q <= 15, "A").when(q <= 35, "N").otherwise("R").alias("pred"),
        (q / 50).alias("p_a"), F.col("l_discount").alias("p_n"), F.col("l_tax").alias("p_r"))


_MULTI = """
WITH b AS (SELECT l_returnflag AS label, CASE WHEN l_quantity <= 15 THEN 'A' WHEN l_quantity <= 35 THEN 'N' ELSE 'R' END AS pred, l_quantity / 50 AS p_a, l_discount AS p_n, l_tax AS p_r FROM lineitem),
k AS (SELECT c, (SELECT count(*) FROM b WHERE label = c AND pred = c)::DOUBLE AS tp, (SELECT count(*) FROM b WHERE label = c) AS support, (SELECT count(*) FROM b WHERE pred = c) AS predicted FROM (SELECT unnest(['A', 'N', 'R']) AS c)),
m AS (SELECT c, CASE WHEN predicted > 0 THEN tp / predicted ELSE 0 END AS precision, CASE WHEN support > 0 THEN tp / support ELSE 0 END AS recall,
  CASE WHEN predicted + support > 0 THEN 2 * tp / (predicted + support) ELSE 0 END AS f1, support FROM k)
"""


@register("confusion_counts", "Q9", _MULTI + "SELECT label, pred AS prediction, count(*) AS n FROM b GROUP BY ALL")
def confusion_counts(t):
    return metrics.confusion(multiclass(t), "label", "pred")


@register("weighted_f1", "Q6", _MULTI + "SELECT round(sum(f1 * support) / sum(support), 9) AS f1 FROM m")
def weighted_f1(t):
    return metrics.f1(multiclass(t), "label", "pred").select(rounded("f1", 9))


@register("classification_report", "Q10", _MULTI + """
SELECT c AS class, round(precision, 9) AS precision, round(recall, 9) AS recall, round(f1, 9) AS f1, support FROM m
UNION ALL SELECT 'macro avg', round(avg(precision), 9), round(avg(recall), 9), round(avg(f1), 9), sum(support)::BIGINT FROM m
UNION ALL SELECT 'weighted avg', round(sum(precision * support) / sum(support), 9), round(sum(recall * support) / sum(support), 9), round(sum(f1 * support) / sum(support), 9), sum(support)::BIGINT FROM m
UNION ALL SELECT 'accuracy', round(sum(recall * support) / sum(support), 9), round(sum(recall * support) / sum(support), 9), round(sum(recall * support) / sum(support), 9), sum(support)::BIGINT FROM m""")
def report(t):
    done = metrics.classification_report(multiclass(t), "label", "pred")
    return done.select("class", rounded("precision", 9), rounded("recall", 9), rounded("f1", 9), "support")


def _ovr(c, p):
    return f"""SELECT '{c}' AS c, sum(pos * (n - fp + neg / 2)) / (any_value(np) * any_value(n)) AS auc, any_value(np) AS np FROM
 (SELECT pos, neg, sum(neg) OVER (ORDER BY s DESC) AS fp, sum(pos) OVER () AS np, sum(neg) OVER () AS n FROM
  (SELECT {p} AS s, count(*) FILTER (WHERE label = '{c}')::DOUBLE AS pos, count(*) FILTER (WHERE label <> '{c}')::DOUBLE AS neg FROM b GROUP BY 1))"""


@register("one_vs_rest_roc_auc", "Q7", _MULTI + ", a AS (" + " UNION ALL ".join(
    [_ovr("A", "p_a"), _ovr("N", "p_n"), _ovr("R", "p_r")]) + ") SELECT round(sum(auc * np) / sum(np), 9) AS roc_auc FROM a")
def one_vs_rest(t):
    columns = {"A": "p_a", "N": "p_n", "R": "p_r"}
    return metrics.ovr_roc_auc(multiclass(t), "label", columns, SLICE_ROWS).select(rounded("roc_auc", 9))


@register("votes", "P10", """
SELECT l_returnflag, round(avg((l_discount + l_tax + l_quantity / 50) / 3.0::DOUBLE), 8) AS soft, sum(CASE WHEN (l_discount > 0.05)::INTEGER + (l_tax > 0.04)::INTEGER + (l_quantity > 25)::INTEGER >= 2 THEN 1 ELSE 0 END)::BIGINT AS hard
FROM lineitem GROUP BY l_returnflag""")
def votes(t):
    scored = t("lineitem").select(
        "l_returnflag", F.col("l_discount").alias("a"), F.col("l_tax").alias("b"), (F.col("l_quantity") / 50).alias("c"),
        (F.col("l_discount") > 0.05).cast("int").alias("va"), (F.col("l_tax") > 0.04).cast("int").alias("vb"), (F.col("l_quantity") > 25).cast("int").alias("vc"))
    voted = scored.select("l_returnflag", ensemble.soft_vote(["a", "b", "c"]).alias("soft"), ensemble.hard_vote(["va", "vb", "vc"]).alias("hard"))
    return voted.groupBy("l_returnflag").agg(rounded(F.avg("soft"), 8, "soft"), F.sum("hard").alias("hard"))


@register("fold_score_summary", "D16 F6 O7", """
SELECT l_returnflag AS model_family, l_linestatus AS hyperparams, round(avg(s), 8) AS mean_score, round(stddev_pop(s), 8) AS std_score FROM
  (SELECT l_returnflag, l_linestatus, l_linenumber, avg(l_discount) AS s FROM lineitem GROUP BY ALL) GROUP BY ALL""")
def fold_summary(t):
    scores = t("lineitem").groupBy(F.col("l_returnflag").alias("model_family"), F.col("l_linestatus").alias("hyperparams"), "l_linenumber").agg(
        F.avg("l_discount").alias("score"))
    return crossval.summarise(scores).select("model_family", "hyperparams", rounded("mean_score", 8), rounded("std_score", 8))
