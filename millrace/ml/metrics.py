"""Exact evaluation metrics as aggregations. Each function returns a small DataFrame.

Curves are built over distinct scores: rows are first counted per score, then running counts are taken in score order
by the sliced scan of `operators.ordered`, so no task holds the whole curve.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from millrace.operators.ordered import ROWS_PER_SLICE, SLICE, running_sums, sliced

# Fixed value: probabilities are kept this far away from 0 and 1 in the log loss.
LOG_LOSS_EPS = 2.220446049250313e-16


def _descending(df: DataFrame, label: str, score: str, by: Sequence[str], rows_per_slice: int) -> DataFrame:
    """Per distinct score: rows at the score (pos, neg) and running counts at or above it (tp, fp); `label` is 0/1.

    Slices are cut on the rows, so the counts of whole slices need no shuffle of scores.
    """
    y = F.col(label).cast("bigint")
    rows = df.select(*by, (-F.col(score).cast("double")).alias("_neg_score"), y.alias("pos"), (1 - y).alias("neg"))
    base = sliced(rows, "_neg_score", rows_per_slice=rows_per_slice)
    counts = base.groupBy(*by, SLICE, "_neg_score").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    curve = running_sums(counts, base, ["_neg_score"], {"tp": F.col("pos"), "fp": F.col("neg")}, by)
    return curve.withColumn("score", -F.col("_neg_score")).drop("_neg_score")


def roc_auc(df: DataFrame, label: str, score: str, by: Sequence[str] = (), rows_per_slice: int = ROWS_PER_SLICE) -> DataFrame:
    """(by..., roc_auc): share of (positive, negative) pairs ranked right, ties count half; NULL with one class only."""
    curve = _descending(df, label, score, by, rows_per_slice)
    # Negatives below a score = all negatives - those at or above it, so one pass suffices:
    # sum(pos * (N - fp + neg / 2)) = P * N - sum(pos * (fp - neg / 2)).
    lost = F.sum(F.col("pos").cast("double") * (F.col("fp").cast("double") - F.col("neg").cast("double") / F.lit(2.0)))
    pairs = F.sum("pos").cast("double") * F.sum("neg").cast("double")
    return curve.groupBy(*by).agg(F.try_divide(pairs - lost, pairs).alias("roc_auc"))


def pr_curve(df: DataFrame, label: str, score: str, rows_per_slice: int = ROWS_PER_SLICE) -> DataFrame:
    """(threshold, precision, recall) for every distinct score; the end point (precision 1, recall 0) is left out."""
    curve = _descending(df, label, score, (), rows_per_slice)
    positives = df.agg(F.sum(F.col(label).cast("bigint")).alias("p")).scalar()
    return curve.select(
        F.col("score").alias("threshold"),
        (F.col("tp").cast("double") / (F.col("tp") + F.col("fp")).cast("double")).alias("precision"),
        F.try_divide(F.col("tp").cast("double"), positives.cast("double")).alias("recall"))


def average_precision(df: DataFrame, label: str, score: str, rows_per_slice: int = ROWS_PER_SLICE) -> DataFrame:
    """(average_precision): sum over scores of the recall step times the precision."""
    curve = _descending(df, label, score, (), rows_per_slice)
    precision = F.col("tp").cast("double") / (F.col("tp") + F.col("fp")).cast("double")
    area = F.sum(F.col("pos").cast("double") * precision)
    return curve.agg(F.try_divide(area, F.sum("pos").cast("double")).alias("average_precision"))


def pr_auc(df: DataFrame, label: str, score: str, rows_per_slice: int = ROWS_PER_SLICE) -> DataFrame:
    """(pr_auc): trapezoid area under the precision-recall curve, which starts at recall 0 with precision 1."""
    curve = _descending(df, label, score, (), rows_per_slice)
    tp, fp = F.col("tp").cast("double"), F.col("fp").cast("double")
    before_tp, before_fp = tp - F.col("pos"), fp - F.col("neg")
    before = F.when(before_tp + before_fp == 0, F.lit(1.0)).otherwise(
        before_tp / F.when(before_tp + before_fp > 0, before_tp + before_fp))
    area = F.sum(F.col("pos").cast("double") * (before + tp / (tp + fp)) / F.lit(2.0))
    return curve.agg(F.try_divide(area, F.sum("pos").cast("double")).alias("pr_auc"))


def rmse(df: DataFrame, label: str, prediction: str) -> DataFrame:
    error = F.col(label).cast("double") - F.col(prediction).cast("double")
    return df.agg(F.sqrt(F.avg(error * error)).alias("rmse"))


def confusion(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """(label, prediction, n)."""
    return df.groupBy(F.col(label).alias("label"), F.col(prediction).alias("prediction")).agg(
        F.count(F.lit(1)).alias("n"))


def binary_confusion(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """(tn, fp, fn, tp) as one row."""
    y, p = F.col(label) == 1, F.col(prediction) == 1
    return df.agg(F.count_if(~y & ~p).alias("tn"), F.count_if(~y & p).alias("fp"),
                  F.count_if(y & ~p).alias("fn"), F.count_if(y & p).alias("tp"))


def per_class(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """(label, precision, recall, f1, support) for every class seen as label or prediction; 0 where undefined."""
    pairs = confusion(df, label, prediction)
    # Each pair counts once for its label and once for its prediction: one small shuffle, no join.
    sides = pairs.select("n", F.explode(F.array(
        F.struct(F.col("label").alias("c"), F.lit(1).alias("is_label"), F.lit(0).alias("is_pred")),
        F.struct(F.col("prediction").alias("c"), F.lit(0).alias("is_label"), F.lit(1).alias("is_pred")))).alias("s"),
        (F.col("label") == F.col("prediction")).alias("hit")).select("n", "hit", "s.*")
    counts = sides.groupBy(F.col("c").alias("label")).agg(
        F.sum(F.col("n") * F.col("is_label")).alias("support"), F.sum(F.col("n") * F.col("is_pred")).alias("predicted"),
        F.sum(F.when(F.col("hit"), F.col("n") * F.col("is_label")).otherwise(0)).alias("tp"))
    zero = F.lit(0.0)
    tp = F.col("tp").cast("double")
    return counts.select(
        "label", F.coalesce(F.try_divide(tp, F.col("predicted").cast("double")), zero).alias("precision"),
        F.coalesce(F.try_divide(tp, F.col("support").cast("double")), zero).alias("recall"),
        F.coalesce(F.try_divide(2 * tp, (F.col("predicted") + F.col("support")).cast("double")), zero).alias("f1"),
        "support")


def classification_report(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Per-class rows plus accuracy, macro and weighted averages: (class, precision, recall, f1, support)."""
    classes = per_class(df, label, prediction)
    measures = ["precision", "recall", "f1"]
    rows = classes.select(F.col("label").cast("string").alias("class"), *measures, "support")
    macro = classes.agg(F.lit("macro avg").alias("class"), *[F.avg(m).alias(m) for m in measures],
                        F.sum("support").alias("support"))
    weighted = classes.agg(F.lit("weighted avg").alias("class"), *[
        F.try_divide(F.sum(F.col(m) * F.col("support")), F.sum("support")).alias(m) for m in measures],
        F.sum("support").alias("support"))
    right = F.try_divide(F.sum(F.col("recall") * F.col("support")), F.sum("support"))
    accuracy = classes.agg(F.lit("accuracy").alias("class"), *[right.alias(m) for m in measures],
                           F.sum("support").alias("support"))
    return rows.unionByName(accuracy).unionByName(macro).unionByName(weighted)


def f1(df: DataFrame, label: str, prediction: str, average: str = "weighted") -> DataFrame:
    """(f1): support-weighted mean over classes, or the F1 of class 1 with average='binary'."""
    if average == "binary":
        c = binary_confusion(df, label, prediction)
        return c.select(F.coalesce(F.try_divide(2.0 * F.col("tp"), 2.0 * F.col("tp") + F.col("fp") + F.col("fn")),
                                   F.lit(0.0)).alias("f1"))
    classes = per_class(df, label, prediction)
    return classes.agg(F.try_divide(F.sum(F.col("f1") * F.col("support")), F.sum("support")).alias("f1"))


def binary_rates(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """(precision, recall, accuracy) of class 1."""
    c = binary_confusion(df, label, prediction)
    tp = F.col("tp").cast("double")
    return c.select(
        F.try_divide(tp, (F.col("tp") + F.col("fp")).cast("double")).alias("precision"),
        F.try_divide(tp, (F.col("tp") + F.col("fn")).cast("double")).alias("recall"),
        F.try_divide((F.col("tp") + F.col("tn")).cast("double"),
                     (F.col("tp") + F.col("tn") + F.col("fp") + F.col("fn")).cast("double")).alias("accuracy"))


def log_loss(df: DataFrame, true_probability: str) -> DataFrame:
    """(log_loss) from the probability given to the true class."""
    p = F.col(true_probability)
    return df.agg(F.avg(-F.ln(F.least(F.greatest(p, F.lit(LOG_LOSS_EPS)), F.lit(1.0 - LOG_LOSS_EPS)))).alias("log_loss"))


def ovr_roc_auc(df: DataFrame, label: str, probabilities: dict[object, str], rows_per_slice: int = ROWS_PER_SLICE) -> DataFrame:
    """(roc_auc): one-vs-rest AUC per class, averaged with the classes' share of rows; maps class -> score column."""
    entries = F.array(*[F.struct(F.lit(c).cast("string").alias("class"), F.col(p).cast("double").alias("score"),
                                 (F.col(label) == F.lit(c)).cast("int").alias("y")) for c, p in probabilities.items()])
    long = df.select(F.explode(entries).alias("e")).select("e.*")
    per = roc_auc(long, "y", "score", by=["class"], rows_per_slice=rows_per_slice)
    share = df.groupBy(F.col(label).cast("string").alias("class")).agg(F.count(F.lit(1)).alias("n"))
    return per.join(share, "class").agg(
        (F.sum(F.col("roc_auc") * F.col("n")) / F.sum("n")).alias("roc_auc"))


def accuracy_value(df: DataFrame, label: str, prediction: str) -> float:
    return df.agg(F.avg((F.col(label) == F.col(prediction)).cast("double"))).first()[0]
