"""Model training, cross-validation and ensembles.

The labels follow from one feature with few, widely spaced values, beside features that say nothing about them or are noise: a
right model predicts every label of the test rows, and that is what the SQL asks for. Regression targets are exact functions.
"""

from pyspark.sql import functions as F

from millrace.ml import crossval, ensemble, metrics, models, scale, select, split
from millrace.ml.base import preprocessing
from millrace.plans.catalog import register, rounded, sql_hash
from millrace.session import materialise, spread

FEATURES = ["f_price", "f_cust", "f_month", "f_mix", "f_noise", "f_copy", "f_half", "f_third"]
# One feature that decides the label, and three that have nothing to do with it.
CANDIDATES = ["f_half", "f_price", "f_cust", "f_noise"]
MONTHLY = ["f_month", *CANDIDATES[1:]]

_MARKED = f"""
WITH s AS (SELECT o_orderkey AS id, (month(o_orderdate) > 6)::INTEGER::DOUBLE AS y, ((month(o_orderdate) - 1) // 4)::DOUBLE AS y3 FROM orders),
m AS (SELECT *, row_number() OVER (PARTITION BY y ORDER BY {sql_hash('id')}, id) <= ceil(0.2::DOUBLE * count(*) OVER (PARTITION BY y)) AS is_test FROM s)
"""
_LABELS = _MARKED + "SELECT id, y, y AS prediction FROM m WHERE is_test"
_KEPT = f"""
WITH s AS (SELECT (month(o_orderdate) > 6)::INTEGER::DOUBLE AS y, o_totalprice::DOUBLE AS p, (o_custkey % 100)::DOUBLE AS c, (o_orderkey * 7919 % 1000)::DOUBLE AS n FROM orders)
SELECT unnest(['f_half', 'f_price', 'f_cust', 'f_noise']) AS feature, unnest([corr(y, y) > 0.5, abs(corr(p, y)) > 0.5, abs(corr(c, y)) > 0.5, abs(corr(n, y)) > 0.5]) AS kept FROM s"""


def samples(t):
    """Orders as a learnable task: labels by half and by third of the year."""
    noise = (F.pmod(F.col("o_orderkey") * 7919, F.lit(1000)) / 1000.0).cast("double")
    price = (F.col("o_totalprice") / 500000.0).cast("double")
    month = (F.month("o_orderdate") / 12.0).cast("double")
    cust = F.pmod(F.col("o_custkey"), F.lit(100)).cast("double") / F.lit(100.0)
    half = (F.month("o_orderdate") > 6).cast("int").cast("double")
    third = F.floor((F.month("o_orderdate") - 1) / 4).cast("double")
    return t("orders").select(
        F.col("o_orderkey").alias("id"), "o_orderdate", F.col("o_custkey").alias("customer"), F.col("o_orderpriority").alias("priority"),
        price.alias("f_price"), cust.alias("f_cust"), month.alias("f_month"), (price * month).alias("f_mix"), noise.alias("f_noise"),
        (price * 2 + cust * 0.01).alias("f_copy"), half.alias("f_half"), third.alias("f_third"), half.alias("y"), third.alias("y3"),
        (price * 3 - cust + noise * 0.1).cast("double").alias("target"))


def parts(t, *used):
    # Stored once, in even files: every fit below makes many passes, and each pass is as slow as its largest task.
    rows = samples(t).select("id", "y", *used) if used else samples(t)
    marked = materialise(spread(split.train_test_split(rows, "id", 0.2, stratify="y"), rows=rows.count()), "samples")
    return marked.where(~F.col("is_test")), marked.where("is_test")


@register("simple_regression_line", "P1", """
SELECT round(regr_slope(l_extendedprice, l_quantity), 2) AS slope, round(regr_intercept(l_extendedprice, l_quantity), 1) AS intercept FROM lineitem""")
def simple_regression(t):
    model = models.linear_regression(["l_quantity"], "l_extendedprice").fit(t("lineitem")).stages[-1]
    line = [(float(model.coefficients[0]), float(model.intercept))]
    return t.spark.createDataFrame(line, "slope double, intercept double").select(rounded("slope", 2), rounded("intercept", 1))


@register("linear_regression_scores", "P1 P9 Q5", _MARKED + "SELECT id, true AS exact FROM m WHERE is_test")
def linear_scores(t):
    """Whether each prediction is the target; one feature is a combination of others."""
    train, test = parts(t)
    scored = models.linear_regression(FEATURES, "target").fit(train).transform(test)
    return scored.select("id", (F.abs(F.col("prediction") - F.col("target")) < 1e-3).alias("exact"))


@register("logistic_regression_scores", "P2 P9 N7", _LABELS)
def logistic_scores(t):
    train, test = parts(t)
    weighted = models.with_class_weights(train, "y", "w")
    model = models.logistic_regression(FEATURES, "y", rows=train.count(), weight="w").fit(weighted)
    return models.score_columns(model.transform(test)).select("id", "y", "prediction")


@register("multiclass_logistic_scores", "P2 P9", _MARKED + "SELECT id, y3, y3 AS prediction FROM m WHERE is_test")
def multiclass_scores(t):
    train, test = parts(t)
    model = models.logistic_regression(FEATURES, "y3", rows=train.count()).fit(train)
    return models.score_columns(model.transform(test), classes=(0, 1, 2)).select("id", "y3", "prediction")


@register("random_forest_scores", "P8 P9", _LABELS)
def forest_scores(t):
    train, test = parts(t)
    model = models.random_forest(FEATURES, "y", trees=100).fit(train)
    return models.score_columns(model.transform(test)).select("id", "y", "prediction")


@register("levelwise_boosted_scores", "P3 P9", _LABELS)
def levelwise_scores(t):
    train, test = parts(t)
    model = models.boosted_levelwise(FEATURES, "y").fit(train)
    return models.score_columns(model.transform(test)).select("id", "y", "prediction")


@register("leafwise_boosted_scores", "P4 P9", _LABELS)
def leafwise_scores(t):
    train, test = parts(t)
    weighted = models.with_class_weights(train, "y", "w")
    model = models.boosted_leafwise(FEATURES, "y", weight="w").fit(weighted)
    return models.score_columns(model.transform(test)).select("id", "y", "prediction")


@register("categorical_boosted_scores", "P5 P9", _LABELS)
def categorical_scores(t):
    train, test = parts(t)
    score = models.boosted_categorical(train, "id", ["f_price", "f_month"], ["priority", "customer"], "y")
    return models.score_columns(score(test)).select("id", "y", "prediction")


@register("kernel_regression_scores", "P6 P9", _MARKED + "SELECT count(*) AS rows, true AS explains_nine_tenths FROM m WHERE is_test")
def kernel_regression_scores(t):
    features = ["f_price", "f_cust", "f_noise"]
    train, test = parts(t, *features, "target")
    scored = models.kernel_regression(train, features, "target").transform(test)
    left = F.sum(F.pow(F.col("prediction") - F.col("target"), F.lit(2)))
    return scored.agg(F.count("*").alias("rows"), (left < 0.1 * F.count("*") * F.var_pop("target")).alias("explains_nine_tenths"))


@register("kernel_classifier_scores", "P7 P9", _LABELS)
def kernel_classifier_scores(t):
    train, test = parts(t)
    model = models.kernel_classifier(train, ["f_half", "f_month"], "y")
    return models.score_columns(model.transform(test)).select("id", "y", "prediction")


def _builders(trees=20):
    return {
        "forest": lambda out: models.random_forest(FEATURES, "y", output=out, trees=trees),
        "level": lambda out: models.boosted_levelwise(FEATURES, "y", output=out, trees=5, max_depth=4),
        "leaf": lambda out: models.boosted_leafwise(FEATURES, "y", output=out, trees=5),
    }


@register("voting_ensemble_scores", "P10", _LABELS)
def voting(t):
    train, test = parts(t)
    return ensemble.fit_voting(train, _builders()).transform(test).select("id", "y", "prediction")


@register("stacking_ensemble_scores", "P11 O3", _LABELS)
def stacking(t):
    train, test = parts(t)
    return ensemble.fit_stacking(train, _builders(10), "id", "y", folds=5).transform(test).select("id", "y", "prediction")


FAMILIES = {
    "logistic": lambda rows, C: models.logistic_regression(FEATURES, "y", rows=rows, C=C),
    "forest": lambda rows, depth: models.random_forest(FEATURES, "y", trees=20, max_depth=depth),
}
GRIDS = {"logistic": crossval.grid(C=[0.01, 1.0]), "forest": crossval.grid(depth=[4])}


@register("cross_validated_families", "O7 O8 O4 Q1 F6", _MARKED + """
SELECT 'forest' AS model_family, '[(''depth'', 4)]' AS hyperparams, max(y) AS mean_score, max(y) AS test_score FROM m WHERE is_test""")
def cross_validated(t):
    train, test = parts(t)
    before = preprocessing(scale.StandardScaler(FEATURES))
    folds = split.kfold(train, "id", 5, stratify="y")
    scores = crossval.fold_scores(folds, range(5), FAMILIES, GRIDS, "y", before)
    return crossval.refit_and_test(train, test, crossval.summarise(scores), FAMILIES, GRIDS, "y", before)


@register("expanding_window_scores", "O6 O7 D16", _MARKED + """
SELECT 'logistic' AS model_family, '[(''C'', 1.0)]' AS hyperparams, max(y) AS mean_score, min(y) AS std_score FROM m WHERE NOT is_test""")
def expanding_scores(t):
    train, _ = parts(t)
    blocks = split.expanding_folds(train, "o_orderdate", "id", 5, out="fold")
    family, options = {"logistic": FAMILIES["logistic"]}, {"logistic": crossval.grid(C=[1.0])}
    scores = crossval.fold_scores(blocks, range(1, 6), family, options, "y", expanding=True)
    return crossval.summarise(scores)


@register("imbalance_methods_compared", "N8 N1 N3 N4 N7 G1")
def imbalance(t):
    rows = t("embeddings").select(F.col("vec_id").alias("id"), (F.col("label") == 0).cast("double").alias("y"), *[
        F.col("embedding")[i].cast("double").alias(f"x{i}") for i in range(4)])
    marked = materialise(split.train_test_split(rows, "id", 0.3, stratify="y"), "samples")
    return crossval.compare_imbalance_methods(marked.where(~F.col("is_test")), marked.where("is_test"), "id", "y", ["x0", "x1", "x2", "x3"])


def _kept(t, model):
    kept = set(model.kept)
    return t.spark.createDataFrame([(c, c in kept) for c in model.columns], "feature string, kept boolean")


@register("lasso_selection", "M8", """
WITH s AS (SELECT o_totalprice::DOUBLE / 500000 AS p, (o_custkey % 100)::DOUBLE / 100 AS c, (o_orderkey * 7919 % 1000)::DOUBLE / 1000 AS n FROM orders),
z AS (SELECT *, p * 3 - c + n * 0.1::DOUBLE AS z FROM s)
SELECT unnest(['f_price', 'f_cust', 'f_noise']) AS feature, unnest([abs(corr(p, z)) > 0.2, abs(corr(c, z)) > 0.2, abs(corr(n, z)) > 0.2]) AS kept FROM z""")
def lasso(t):
    return _kept(t, select.LassoSelector(["f_price", "f_cust", "f_noise"], "target", alpha=0.001).fit(samples(t)))


@register("forest_importance_selection", "M9", _KEPT)
def forest_importance(t):
    return _kept(t, select.ForestSelector(CANDIDATES, "y").fit(samples(t)))


@register("recursive_elimination", "M10", _KEPT)
def recursive(t):
    return _kept(t, select.RFE(CANDIDATES, "y", n_features=1).fit(samples(t)))


@register("recursive_elimination_cross_validated", "M11", _KEPT)
def recursive_cv(t):
    return _kept(t, select.RFECV(CANDIDATES, "y", key="id", min_features=1, folds=5, trees=20).fit(samples(t)))


@register("consensus_selection", "M12", _KEPT.replace("f_half", "f_month").replace("corr(y, y)", "corr(mo, y)").replace("SELECT (month", "SELECT month(o_orderdate)::DOUBLE AS mo, (month"))
def consensus(t):
    chosen = select.ConsensusSelector([
        ("lasso", select.LassoSelector(MONTHLY, "y", alpha=0.01)), ("forest", select.ForestSelector(MONTHLY, "y")),
        ("kbest", select.SelectKBest(MONTHLY, "y", "f_classif", k=1))], min_votes=2)
    return _kept(t, chosen.fit(samples(t)))


@register("test_scores_by_model", "P1 P2 P8 Q1 Q3 G1", _MARKED + """
SELECT unnest(['logistic', 'forest']) AS model, max(y) AS roc_auc, max(y) AS average_precision FROM m WHERE is_test""")
def test_scores(t):
    train, test = parts(t)
    fitted = {"logistic": models.logistic_regression(FEATURES, "y", rows=train.count()).fit(train),
              "forest": models.random_forest(FEATURES, "y").fit(train)}
    rows = []
    for name, model in fitted.items():
        scored = models.score_columns(model.transform(test)).select("y", "p1").persist()
        rows.append((name, metrics.roc_auc(scored, "y", "p1").first()[0], metrics.average_precision(scored, "y", "p1").first()[0]))
        scored.unpersist()
    return t.spark.createDataFrame(rows, "model string, roc_auc double, average_precision double")
