"""Fitted stages against hand-computed values, and invariants of training, splitting and resampling."""

import numpy as np
import pandas as pd
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from millrace.ml import clip, crossval, encode, ensemble, impute, metrics, models, resample, scale, select, split
from millrace.ml.base import ColumnRouter, preprocessing


def values(df, c, key="id"):
    return [r[c] for r in df.orderBy(key).collect()]


@pytest.fixture(scope="module")
def four(spark):
    return spark.createDataFrame([(0, 1.0), (1, 2.0), (2, 3.0), (3, 10.0), (4, None)], "id int, x double")


def test_clippers(four):
    assert values(clip.IQRClipper(["x"]).fit(four).transform(four), "x") == [1.0, 2.0, 3.0, 9.25, None]
    std = 3.5355339059327378
    got = values(clip.ZScoreClipper(["x"], threshold=1.0).fit(four).transform(four), "x")
    assert np.allclose(got[:4], [1.0, 2.0, 3.0, 4 + std]) and got[4] is None


def test_scalers_and_constant_columns(spark, four):
    assert np.allclose(values(scale.StandardScaler(["x"]).fit(four).transform(four), "x")[:4], (np.array([1, 2, 3, 10]) - 4) / 3.5355339059327378)
    assert np.allclose(values(scale.MinMaxScaler(["x"]).fit(four).transform(four), "x")[:4], [0, 1 / 9, 2 / 9, 1])
    assert np.allclose(values(scale.RobustScaler(["x"]).fit(four).transform(four), "x")[:4], [-0.5, -1 / 6, 1 / 6, 2.5])
    flat = spark.createDataFrame([(0, 5.0), (1, 5.0)], "id int, x double")
    for scaler in (scale.StandardScaler, scale.MinMaxScaler, scale.RobustScaler):
        assert values(scaler(["x"]).fit(flat).transform(flat), "x") == [0.0, 0.0]


def test_fitted_state_comes_from_training_rows_and_survives_saving(spark, four, tmp_path):
    pipeline = preprocessing(impute.MedianImputer(["x"], indicators=True), scale.StandardScaler(["x"]), clip.ZScoreClipper(["x"], threshold=1.0))
    model = pipeline.fit(four.where("id < 3 or id = 4"))
    model.write().overwrite().save(str(tmp_path / "m"))
    again = PipelineModel.load(str(tmp_path / "m"))
    assert values(again.transform(four), "x") == values(model.transform(four), "x")
    assert values(model.transform(four), "missing_x") == [0, 0, 0, 0, 1]
    assert model.stages[0].values["fill"] == {"x": 2.0}


def test_router_shares_scans_and_passes_other_columns(spark):
    df = spark.createDataFrame([(i, float(i), float(i * i), "ab"[i % 2], i) for i in range(6)], "id int, a double, b double, c string, other int")
    router = ColumnRouter([scale.MinMaxScaler(["a"]), scale.RobustScaler(["b"]), impute.ModeImputer(["c"])])
    done = router.fit(df).transform(df)
    assert done.columns == df.columns and values(done, "a") == [0.0, 0.2, 0.4, 0.6, 0.8, 1.0] and values(done, "other") == list(range(6))


def test_one_hot_ordinal_hash(spark):
    train = spark.createDataFrame([(0, "red", "small"), (1, "blue", "large"), (2, "green", "medium"), (3, "yellow", "small")], "id int, color string, size string")
    test = spark.createDataFrame([(0, "red", "large"), (1, "pink", "giant"), (2, None, None)], "id int, color string, size string")
    hot = encode.OneHotEncoder(["color"]).fit(train).transform(test)
    assert hot.columns == ["id", "size", "color_blue", "color_green", "color_red", "color_yellow"]
    assert [tuple(r)[2:] for r in hot.orderBy("id").collect()] == [(0, 0, 1, 0), (0, 0, 0, 0), (0, 0, 0, 0)]
    assert values(encode.OrdinalEncoder({"size": ["small", "medium", "large"]}).fit(train).transform(test), "size") == [2, -1, -1]
    hashed = encode.HashingEncoder(["color"], 8).fit(train).transform(test).drop("id", "size")
    assert [sum(r) for r in hashed.collect()] == [1, 1, 1]  # a missing value has a bucket too
    with pytest.raises(ValueError, match="more than 2"):
        encode.OneHotEncoder(["color"], max_categories=2).fit(train)


def test_target_and_leave_one_out(spark, tmp_path):
    rows = [(i, "big", float(i % 2)) for i in range(40)] + [(40, "one", 1.0)]
    train = spark.createDataFrame(rows, "id int, city string, y double")
    prior = 21 / 41
    target = encode.TargetEncoder(["city"], "y").fit(train)
    target.write().save(str(tmp_path / "t"))
    apply = spark.createDataFrame([(0, "big", 0.0), (1, "one", 0.0), (2, "new", 0.0)], "id int, city string, y double")
    weight = lambda n: 1 / (1 + np.exp(-(n - 20) / 10))
    expected = [prior * (1 - weight(40)) + 0.5 * weight(40), prior * (1 - weight(1)) + weight(1), prior]
    for model in (target, encode.TargetModel.load(str(tmp_path / "t"))):
        assert np.allclose(values(model.transform(apply), "city"), expected)
    loo = encode.LeaveOneOutEncoder(["city"], "y").fit(train)
    encoded = values(loo.encode_training(train), "city")
    assert np.allclose(encoded[:2], [20 / 39, 19 / 39]) and np.isclose(encoded[40], prior)
    assert np.allclose(values(loo.transform(apply), "city"), [0.5, 1.0, prior])


def test_binary_codes_are_distinct(spark):
    table = spark.createDataFrame([(i, f"c{i % 55}") for i in range(110)], "id int, city string")
    bits = encode.BinaryEncoder(["city"]).fit(table).transform(table)
    assert len(bits.columns) == 7
    assert bits.select(bits.columns[1:]).distinct().count() == 55
    unknown = encode.BinaryEncoder(["city"]).fit(table).transform(spark.createDataFrame([(1, "zz")], "id int, city string"))
    assert sum(unknown.first()[1:]) == 0


def test_sparse_one_hot_of_many_categories(spark, tmp_path):
    table = spark.range(3000).select("id", F.col("id").cast("string").alias("a"), F.when(F.col("id") % 3 > 0, F.col("id") % 3).alias("b"))
    model = encode.SparseOneHotEncoder(["a", "b"]).fit(table)
    rows = model.transform(table).collect()
    assert {r["one_hot"].size for r in rows} == {3002}
    assert len({tuple(r["one_hot"].indices[:1]) for r in rows}) == 3000
    assert all(r["one_hot"].values.sum() == (2 if r["id"] % 3 else 1) for r in rows)
    unknown = model.transform(spark.createDataFrame([(1, "zz", None)], "id bigint, a string, b bigint")).first()
    assert unknown["one_hot"].size == 3002 and not len(unknown["one_hot"].values)
    model.write().overwrite().save(str(tmp_path / "model"))
    again = encode.SparseOneHotModel.load(str(tmp_path / "model")).transform(table)
    assert again.orderBy("id").first()["one_hot"] == min(rows, key=lambda r: r["id"])["one_hot"]


def test_knn_imputation_by_hand(spark):
    table = spark.createDataFrame([(0, 0.0, 0.0), (1, 1.0, 10.0), (2, 3.0, 30.0), (3, 1.0, None), (4, 2.0, None), (5, None, None)],
                                  "id int, a double, b double")
    done = impute.KNNImputer(["a", "b"], key="id", k=2).fit(table).transform(table)
    got = values(done, "b")
    assert got[3] == 10.0  # a donor at distance 0 decides alone
    assert np.isclose(got[4], 20.0)  # two donors at equal distance
    assert np.isclose(got[5], 40 / 3) and np.isclose(values(done, "a")[5], 7 / 5)  # nothing to measure by: training means


@pytest.mark.parametrize("options", [{}, {"shipped_numbers": 0, "block_rows": 60}])
def test_gaps_in_seventy_columns(spark, options):
    """Neighbours of rows with any missing pattern, against brute force; donors are stored once, or once for a block of queries."""
    from millrace.operators.neighbours import knn_with_gaps

    rng = np.random.default_rng(4)
    data = rng.normal(size=(200, 70)).round(1)
    data[rng.random(data.shape) < 0.1] = np.nan
    data[:20] = data[20:40]  # equal rows
    data[199], data[198, 1:] = np.nan, np.nan
    pdf = pd.DataFrame({"id": np.arange(200), "vec": data.tolist()})
    table = spark.createDataFrame(pdf, "id bigint, vec array<double>")
    expected = set()
    for i in range(199):
        both = ~np.isnan(data) & ~np.isnan(data[i])
        n = both.sum(1)
        distance = np.sqrt((np.where(both, data - data[i], 0) ** 2).sum(1) * (70 / np.maximum(n, 1)))
        for t in np.flatnonzero(np.isnan(data[i])):
            able = np.flatnonzero(~np.isnan(data[:, t]) & (n > 0))
            best = able[np.lexsort((able, distance[able].round(9)))][:4]
            expected |= {(i, t, j, round(distance[j], 6), data[j, t]) for j in best}
    found = knn_with_gaps(table, table, 4, **options).collect()
    assert {(r.query_id, r.target, r.donor_id, round(r.distance, 6), r.value) for r in found} == expected


def test_gaps_of_few_patterns_go_through_one_narrow_product(spark, monkeypatch):
    """Where rows lack the same columns no mask enters the matrices, and the answers of a block travel in rows of bounded size."""
    from millrace.operators import neighbours

    rng = np.random.default_rng(14)
    n, dims, k = 1800, 12, 3
    data = rng.normal(size=(n, dims)).round(2)
    data[(np.arange(n)[:, None] + np.arange(dims)) % 5 == 0] = np.nan
    data[::11, :7] = np.nan
    data[5::11, 6:] = np.nan  # some rows have no column in common
    data[40:60] = data[95:115]
    ids = rng.permutation(n) * 8
    expected = set()
    for i in range(100):
        both = ~np.isnan(data) & ~np.isnan(data[i])
        shared = both.sum(1)
        distance = np.sqrt((np.where(both, data - data[i], 0) ** 2).sum(1) * (dims / np.maximum(shared, 1)))
        for t in np.flatnonzero(np.isnan(data[i])):
            able = np.flatnonzero(~np.isnan(data[:, t]) & (shared > 0))
            expected |= {(i, t, j) for j in able[np.lexsort((ids[able], distance[able]))][:k]}
    i, t, j, _ = neighbours.nearest_with_gaps(data, data, ids, k)
    assert {(a, b, c) for a, b, c in zip(i.tolist(), t.tolist(), j.tolist()) if a < 100} == expected

    few = data[::11]
    assert (np.isnan(few).sum(1) >= 7).all()
    narrow = neighbours._alike(np.tile(~np.isnan(data[:40]), (100, 1)), True)
    assert all(has is not None and (has == ~np.isnan(np.tile(data[:40], (100, 1))[rows])).all() for rows, has in narrow)

    monkeypatch.setattr(neighbours, "ANSWER_QUERIES", 50)
    sizes = [len(rows) for _, rows in neighbours._dealt(ids, n // 50)]
    assert sum(sizes) == n and max(sizes) < 150
    table = spark.createDataFrame(pd.DataFrame({"id": ids, "vec": data.tolist()}), "id bigint, vec array<double>")
    found = neighbours.knn_with_gaps(table, table, k, shipped_numbers=0, block_rows=500).collect()
    assert {(r.query_id, r.target, r.donor_id) for r in found} == {(ids[a], b, ids[c]) for a, b, c in zip(i, t, j)}


def test_hashed_neighbours(spark):
    """Recall on clusters and on an even cloud, with buckets that must be hashed again; distances are exact."""
    from millrace.operators.approximate import approximate_knn_join, recall
    from millrace.operators.neighbours import knn_join

    rng = np.random.default_rng(3)
    centres = rng.normal(size=(15, 32)) * 3
    points = np.concatenate([centres[rng.integers(0, 15, 1500)] + rng.normal(size=(1500, 32)) * 0.2, np.tile(centres[0], (300, 1))])
    pdf = pd.DataFrame({"id": np.arange(1800), "vec": points.tolist(), "grp": np.where(np.arange(1800) % 5 == 0, "a", "b")})
    table = spark.createDataFrame(pdf, "id bigint, vec array<double>, grp string").persist()
    report = []
    found = approximate_knn_join(table, table, 5, exclude_self=True, bucket_rows=150, report=report).persist()
    exact = knn_join(table, table, 5, exclude_self=True)
    hits, wanted = recall(found, exact).agg(F.sum("hits"), F.sum("wanted")).first()
    assert wanted == 9000 and hits / wanted >= 0.9
    assert report[0] > 0 and report[-1] <= 600
    wrong = found.join(exact, ["grp", "query_id", "donor_id"]).where(found["distance"] != exact["distance"]).count()
    assert wrong == 0
    empty = approximate_knn_join(table.limit(0), table.limit(0), 5)
    assert empty.count() == 0


def test_chained_regressions_match_numpy(spark):
    rng = np.random.default_rng(2)
    n = 500
    a = rng.normal(size=n)
    full = np.column_stack([a, 2 * a + rng.normal(size=n) * 0.3, 5 - a + rng.normal(size=n) * 0.3])
    holes = rng.random(full.shape) < 0.15
    data = np.where(holes, np.nan, full)
    expected = np.where(holes, np.nanmean(data, axis=0), data)
    for _ in range(10):
        for c in range(3):
            others = np.delete(expected, c, axis=1)
            design = np.column_stack([np.ones(n), others])
            known = ~holes[:, c]
            weights = np.linalg.lstsq(design[known], data[known, c], rcond=None)[0]
            expected[holes[:, c], c] = design[holes[:, c]] @ weights
    pdf = pd.DataFrame(data, columns=["a", "b", "c"]).assign(id=range(n))
    df = spark.createDataFrame(pdf).repartition(5)
    model = impute.MICEImputer(["a", "b", "c"], max_iter=10, tol=0.0).fit(df)
    got = model.transform(df).orderBy("id").select("a", "b", "c").toPandas().to_numpy()
    assert np.allclose(got, expected)
    early = impute.MICEImputer(["a", "b", "c"], max_iter=10, tol=0.5).fit(df)
    assert len(early.values["steps"]) < len(model.values["steps"]) == 30


def test_metrics_by_hand(spark):
    scored = spark.createDataFrame([(1, .9), (0, .8), (1, .7), (1, .7), (0, .4), (0, .2)], "y int, p double")
    for size in (1000, 2):
        assert np.isclose(metrics.roc_auc(scored, "y", "p", rows_per_slice=size).first()[0], 7 / 9)
        assert np.isclose(metrics.average_precision(scored, "y", "p", rows_per_slice=size).first()[0], 5 / 6)
        assert np.isclose(metrics.pr_auc(scored, "y", "p", rows_per_slice=size).first()[0], 3 / 4)
    assert metrics.roc_auc(scored.where("y = 1"), "y", "p").first()[0] is None
    weights = models.with_class_weights(spark.range(100).select((F.col("id") < 10).cast("int").alias("y")), "y").groupBy("y").agg(F.first("weight").alias("w"))
    assert np.allclose([r["w"] for r in weights.orderBy("y").collect()], [100 / 180, 5.0])


@pytest.fixture(scope="module")
def classes(spark):
    """Three groups of points, sizes 120, 30 and 6, with copies in the smallest."""
    rng = np.random.default_rng(11)
    parts = []
    for label, (size, centre) in enumerate([(120, 0.0), (30, 3.0), (6, 6.0)]):
        parts.append(pd.DataFrame(rng.normal(centre, 1.0, size=(size, 2)), columns=["a", "b"]).assign(y=label))
    pdf = pd.concat(parts, ignore_index=True)
    pdf.loc[pdf.y == 2, "a"] = [6.0, 6.0, 6.0, 7.0, 5.0, 5.5]
    pdf = pdf.assign(id=range(len(pdf)), kind=np.where(pdf.index % 3 == 0, "u", "v"))
    return spark.createDataFrame(pdf).cache()


def test_smote_balances_and_stays_on_segments(spark, classes):
    grown = resample.smote(classes, "id", "y", ["a", "b"], categorical=["kind"], k=5).cache()
    assert sorted(r["count"] for r in grown.groupBy("y").count().collect()) == [120, 120, 120]
    assert grown.select("id").distinct().count() == 360
    assert grown.where("not is_synthetic").count() == 156
    originals = classes.toPandas().set_index("id")
    for r in grown.where("is_synthetic").collect():
        base, point = originals.loc[r["base"]], np.array([r["a"], r["b"]])
        assert base.y == r["y"] and r["kind"] in ("u", "v")
        start = np.array([base.a, base.b], dtype=float)
        mates = originals[(originals.y == r["y"]) & (originals.index != r["base"])]
        ends = mates[["a", "b"]].to_numpy(dtype=float)
        # On a segment: |start - point| + |point - end| = |start - end| for some row of the class.
        gaps = np.linalg.norm(start - point) + np.linalg.norm(ends - point, axis=1) - np.linalg.norm(ends - start, axis=1)
        assert gaps.min() < 1e-9
    mode = resample.smote(classes, "id", "y", ["a", "b"], categorical=["kind"], categorical_value="mode")
    assert mode.where("is_synthetic").where("kind is null").count() == 0


def test_smote_of_a_single_row_class(spark):
    table = spark.createDataFrame([(i, 0, float(i)) for i in range(5)] + [(9, 1, 2.5)], "id int, y int, a double")
    grown = resample.smote(table, "id", "y", ["a"])
    assert grown.where("y = 1").count() == 5 and grown.where("y = 1").select("a").distinct().count() == 1


def test_over_and_under_sampling(classes):
    over = resample.random_over_sample(classes, "id", "y")
    assert sorted(r["count"] for r in over.groupBy("y").count().collect()) == [120, 120, 120]
    assert over.select("id").distinct().count() == 156
    under = resample.random_under_sample(classes, "id", "y")
    assert sorted(r["count"] for r in under.groupBy("y").count().collect()) == [6, 6, 6]


def test_many_copies_are_cut_into_chunks(spark, monkeypatch):
    monkeypatch.setattr(resample, "COPIES_PER_CHUNK", 7)
    table = spark.createDataFrame([(1, 23), (2, 0), (3, 7)], "id int, n bigint")
    got = resample.repeat_rows(table, "id", "n", "copy")
    assert sorted((r["id"], r["copy"]) for r in got.collect()) == [(1, i) for i in range(23)] + [(3, i) for i in range(7)]


def test_tomek_rule(spark):
    table = spark.createDataFrame([(0, 0, 0.0), (1, 1, 0.1), (2, 0, 5.0), (3, 0, 5.1), (4, 1, 9.0)], "id int, y int, a double")
    assert sorted(r["id"] for r in resample.drop_tomek_links(table, "id", "y", ["a"]).collect()) == [1, 2, 3, 4]
    assert sorted(r["id"] for r in resample.drop_tomek_links(table, "id", "y", ["a"], drop="both").collect()) == [2, 3, 4]
    assert 4 not in [r["id"] for r in resample.edited_neighbours(table, "id", "y", ["a"], rule="any").collect()]


def test_split_and_folds(spark):
    table = spark.range(1000).select("id", (F.col("id") % 10 == 0).cast("int").alias("y"), (F.when(F.col("id") < 333, 0).otherwise(F.col("id") % 50)).alias("g"),
                                     F.timestamp_seconds("id").cast("timestamp_ntz").alias("t"))
    marked = split.train_test_split(table, "id", 0.2, stratify="y")
    assert {r["y"]: r["n"] for r in marked.where("is_test").groupBy("y").agg(F.count("*").alias("n")).collect()} == {0: 180, 1: 20}
    again = split.train_test_split(table.repartition(7), "id", 0.2, stratify="y")
    assert marked.exceptAll(again).count() == 0
    folds = split.kfold(table, "id", 5, stratify="y").groupBy("fold", "y").count().collect()
    assert {(r["fold"], r["y"]): r["count"] for r in folds} == {(f, y): n for f in range(5) for y, n in ((0, 180), (1, 20))}
    grouped = split.group_kfold(table, "g", 3)
    assert grouped.groupBy("g").agg(F.countDistinct("fold").alias("n")).agg(F.max("n")).first()[0] == 1
    assert grouped.count() == 1000
    sizes = sorted(r["count"] for r in split.group_kfold(table, "g", 3).groupBy("fold").count().collect())
    assert sizes[2] - sizes[0] <= 30
    blocks = split.expanding_folds(table, "t", "id", 5, rows_per_slice=100)
    assert [r["count"] for r in blocks.groupBy("block").count().orderBy("block").collect()] == [170, 166, 166, 166, 166, 166]
    for f in range(1, 6):
        train, held = split.fold_pair(blocks, f, "block", expanding=True)
        assert train.agg(F.max("t")).first()[0] < held.agg(F.min("t")).first()[0]


def test_sizes_are_dealt_to_the_lightest_fold():
    rng = np.random.default_rng(6)
    for _ in range(200):
        k = int(rng.integers(1, 7))
        counted = sorted(((int(s), int(rng.integers(1, 12))) for s in rng.choice(30, 5, replace=False) + 1), reverse=True)
        loads, want = [0] * k, []
        for size, many in counted:
            got = [0] * k
            for _ in range(many):
                f = loads.index(min(loads))
                loads[f], got[f] = loads[f] + size, got[f] + 1
            want.append(got)
        assert [got for *_, got in split._dealt(counted, k)] == want


def test_missing_classes_lose_no_rows(spark):
    table = spark.range(400).select("id", F.when(F.col("id") % 4 > 0, F.col("id") % 3).alias("y"), F.col("id").cast("double").alias("x"))
    marked = split.train_test_split(table, "id", 0.2, stratify="y")
    assert marked.count() == 400 and marked.where("y IS NULL AND is_test").count() == 20
    assert split.kfold(table, "id", 5, stratify="y").where("fold IS NULL").count() == 0
    assert set(resample.random_over_sample(table, "id", "y").groupBy("y").count().toPandas()["count"]) == {100}
    assert split.group_kfold(table, "y", 2).where("fold IS NULL").count() == 0


def test_small_tables_do_not_move_the_big_side(spark):
    from millrace.operators import profile, relational

    table = spark.range(1000).select("id", F.when(F.col("id") % 5 > 0, F.col("id") % 3).alias("y"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for wide in (profile.with_class_weights(table, "y"), relational.with_group_summary("y", "id", "id", "id")(table)):
            assert wide.count() == 1000
            plan = wide._jdf.queryExecution().executedPlan().toString()
            assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "hashpartitioning" not in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_incomplete_vectors_have_no_neighbours(spark):
    from millrace.operators.neighbours import knn_join

    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=3).tolist(), "g") for i in range(60)]
    rows += [(60, [float("nan"), 0.0, 0.0], "g"), (61, [None, 0.0, 0.0], "g"), (62, None, "g")]
    table = spark.createDataFrame(rows, "id bigint, vec array<double>, grp string")
    shipped = knn_join(table, table, 3, exclude_self=True).select("query_id", "donor_id", "rank")
    blocked = knn_join(table, table, 3, exclude_self=True, shipped_numbers=0, block_rows=16, cell_rows=10).select("query_id", "donor_id", "rank")
    assert sorted(map(tuple, shipped.collect())) == sorted(map(tuple, blocked.collect()))
    assert {r["query_id"] for r in shipped.collect()} == set(range(60))


@pytest.fixture(scope="module")
def task(spark):
    """Learnable binary task; c repeats a, d is noise."""
    rng = np.random.default_rng(4)
    n = 600
    pdf = pd.DataFrame(rng.normal(size=(n, 3)), columns=["a", "b", "d"])
    pdf["c"] = pdf.a * 2 + rng.normal(size=n) * 0.01
    pdf["y"] = ((pdf.a + 0.5 * pdf.b + rng.normal(size=n) * 0.3) > 0.4).astype(float)
    pdf["y3"] = pdf.y + (pdf.a > 1.2)
    pdf["cat"] = np.where(pdf.a > 0, "high", "low")
    pdf["id"] = range(n)
    df = split.train_test_split(spark.createDataFrame(pdf), "id", 0.3, stratify="y").cache()
    return df.where("not is_test"), df.where("is_test")


def auc(scored, label="y"):
    return metrics.roc_auc(scored, label, "p1").first()[0]


def test_model_families_learn(task):
    train, test = task
    f = ["a", "b", "d"]
    builders = {
        "logistic": models.logistic_regression(f, "y", rows=train.count()),
        "forest": models.random_forest(f, "y", trees=10),
        "level": models.boosted_levelwise(f, "y", trees=5, max_depth=3),
        "leaf": models.boosted_leafwise(f, "y", trees=5, leaves=8),
    }
    for name, pipeline in builders.items():
        assert auc(models.score_columns(pipeline.fit(train).transform(test))) > 0.85, name
    score = models.boosted_categorical(train, "id", ["b"], ["cat"], "y", trees=5, depth=3)
    assert auc(models.score_columns(score(test))) > 0.7
    kernel = models.kernel_classifier(train, f, "y", count=40, max_iter=20)
    assert auc(models.score_columns(kernel.transform(test))) > 0.8
    line = models.linear_regression(f, "c").fit(train)
    assert metrics.rmse(line.transform(test), "c", "prediction").first()[0] < 0.05
    curve = models.kernel_regression(train, f, "c", count=60, max_iter=40).transform(test)
    assert metrics.rmse(curve, "c", "prediction").first()[0] < 1.2
    three = models.boosted_levelwise(f, "y3", classes=3, trees=3, max_depth=3).fit(train).transform(test)
    assert metrics.binary_rates(three, "y", "prediction").count() == 1 and metrics.accuracy_value(three, "y3", "prediction") > 0.7
    number = models.boosted_leafwise(f, "c", regression=True, trees=5).fit(train).transform(test)
    assert metrics.rmse(number, "c", "prediction").first()[0] < 1.5


def test_ensembles(task):
    train, test = task
    builders = {"forest": lambda out: models.random_forest(["a", "b"], "y", output=out, trees=5),
                "logistic": lambda out: models.logistic_regression(["a", "b"], "y", rows=420, output=out),
                "stump": lambda out: models.boosted_levelwise(["a"], "y", output=out, trees=2, max_depth=2)}
    voted = ensemble.fit_voting(train, builders).transform(test)
    r = voted.first()
    assert np.isclose(r["p1"], np.mean([r["forest_p1"], r["logistic_p1"], r["stump_p1"]]))
    assert r["prediction"] == float(np.median([r["forest_prediction"], r["logistic_prediction"], r["stump_prediction"]]))
    stacked = ensemble.fit_stacking(train, {k: builders[k] for k in ("logistic", "stump")}, "id", "y", folds=2).transform(test)
    assert auc(voted) > 0.85 and auc(stacked) > 0.85


def test_cross_validation_refits_the_best(task):
    train, test = task
    families = {"logistic": lambda rows, C, features: models.logistic_regression(list(features), "y", rows=rows, C=C)}
    grids = {"logistic": crossval.grid(C=[1.0], features=[("a", "b"), ("d",)])}
    folds = split.kfold(train, "id", 3, stratify="y")
    scores = crossval.fold_scores(folds, range(3), families, grids, "y", preprocessing(scale.StandardScaler(["a", "b", "d"])))
    summary = crossval.summarise(scores)
    assert scores.count() == 6 and "('a', 'b')" in crossval.best_model(summary).first()["hyperparams"]
    result = crossval.refit_and_test(train, test, summary, families, grids, "y").first()
    assert result["test_score"] > 0.85
    blocks = split.expanding_folds(train, "id", "id", 2, out="fold")
    rising = crossval.fold_scores(blocks, [1, 2], families, {"logistic": grids["logistic"][:1]}, "y", expanding=True)
    assert rising.count() == 2 and rising.where("score between 0 and 1").count() == 2


def test_imbalance_comparison(task):
    train, test = task
    table = crossval.compare_imbalance_methods(train, test, "id", "y", ["a", "b"]).collect()
    assert [r["method"] for r in table] == ["as_is", "smote", "over_sampled", "under_sampled", "class_weights"]
    assert all(0.8 < r["roc_auc"] <= 1 and 0.5 < r["average_precision"] <= 1 for r in table)


def test_selectors(task):
    train, _ = task
    f = ["a", "b", "c", "d"]
    assert select.CorrelationDropper(f, 0.95).fit(train).kept == ["a", "b", "d"]
    flat = train.withColumn("k", F.lit(1.0))
    assert select.VarianceThreshold(["a", "k"]).fit(flat).transform(flat.select("a", "k")).columns == ["a"]
    assert set(select.SelectKBest(f, "y", "f_classif", 2).fit(train).kept) == {"a", "c"}
    assert set(select.SelectKBest(f, "y", "mutual_info_classif", 2).fit(train).kept) == {"a", "c"}
    assert "a" in select.SelectKBest(["a", "b", "d"], "c", "f_regression", 1).fit(train).kept
    assert "a" in select.SelectKBest(["a", "b", "d"], "c", "mutual_info_regression", 1).fit(train).kept
    assert "c" in select.LassoSelector(f, "y").fit(train).kept
    assert "d" not in select.ForestSelector(f, "y", trees=10).fit(train).kept
    assert "d" not in select.RFE(f, "y", n_features=2, trees=5).fit(train).kept
    chosen = select.RFECV(f, "y", key="id", min_features=2, folds=2, trees=3).fit(train)
    assert 2 <= len(chosen.kept) <= 4 and {len(v) for v in chosen.values["fold_scores"].values()} == {2}
    votes = select.ConsensusSelector([("lasso", select.LassoSelector(f, "y")), ("forest", select.ForestSelector(f, "y", trees=5)),
                                      ("kbest", select.SelectKBest(f, "y", "f_classif", 2))], min_votes=2).fit(train)
    assert votes.kept == [c for c in f if votes.scores[c] >= 2] and "d" not in votes.kept


def test_correlation_rule_counts_dropped_columns_too():
    pairs = {("a", "b"): 0.99, ("b", "c"): -0.97, ("a", "c"): 0.5}
    assert select.correlated_columns(pairs, ["a", "b", "c"], 0.95) == ["b", "c"]


def test_rows_of_few_files_are_spread_over_tasks(spark, tmp_path):
    """One file, as a small input gives: fits pass over even tasks of bounded size."""
    from millrace.session import materialise, spread as dealt

    one = materialise(spark.range(60_000).coalesce(1), "one-file")
    cores = spark.sparkContext.defaultParallelism
    counts = [len(list(part)) for part in materialise(dealt(one), "even").rdd.glom().collect()]
    assert sum(counts) == 60_000 and max(counts) <= 60_000 / cores * 1.2
    assert dealt(one, 1_000).rdd.getNumPartitions() % cores == 0
    assert max(len(part) for part in dealt(one, 1_000).rdd.glom().collect()) <= 1_200


def test_forest_rows_are_dealt_by_what_a_forest_stores(spark, monkeypatch):
    from millrace.ml import models

    monkeypatch.setattr(models, "FOREST_BYTES", 1_000 * (4 * 5 + 200))
    seen = []
    fit = models.ModelPipeline._fit
    monkeypatch.setattr(models.ModelPipeline, "_fit", lambda self, df: seen.append(df.rdd.getNumPartitions()) or fit(self, df))
    table = spark.range(10_000).coalesce(1).selectExpr("id", "double(id % 2) AS y", "double(id % 2) + id / 1e6 AS a")
    model = models.random_forest(["a"], "y", trees=5, max_depth=2).fit(table)
    assert seen[0] >= 10 and model.transform(table).where("prediction <> y").count() == 0


def test_elimination_fits_each_feature_set_once(spark, monkeypatch):
    from millrace.ml import select

    calls = []
    plain = select._assembled
    monkeypatch.setattr(select, "_assembled", lambda df, features, label: calls.append(tuple(features)) or plain(df, features, label))
    table = spark.range(400).selectExpr("id", "double(id % 2) AS y", "double(id % 2) AS a", "double(id * 7919 % 100) AS b")
    model = select.RFECV(["a", "b"], "y", key="id", min_features=1, folds=2, trees=3).fit(table)
    assert model.kept == ["a"]
    # Two folds of two sets, each assembled to fit and to score, and one fit of the final elimination.
    assert len(calls) == 2 * 2 * 2 + 1


def test_mutual_information_lists_counts_not_rows(spark):
    """Rows meet the first aggregation as they are; six features (two groups of bins) score as each alone."""
    from millrace.ml import select

    names = [f"f{i}" for i in range(6)]
    table = spark.range(3_000).selectExpr("id % 3 AS y", *[f"double(id * {7919 + i} % {50 + 40 * i}) AS {n}" for i, n in enumerate(names)])
    table = table.persist()
    scores = select.mutual_information(table, names, "y")
    plan = scores._jdf.queryExecution().optimizedPlan().toString()
    # Read from the rows up: an aggregation comes before the rows of several features are made of one.
    assert plan.rindex("Aggregate") > plan.rindex("Generate")
    got = {r["feature"]: r["score"] for r in scores.collect()}
    for n in names:
        assert abs(got[n] - select.mutual_information(table, [n], "y").first()["score"]) < 1e-9


@pytest.fixture(scope="module")
def curve(spark):
    rng = np.random.default_rng(5)
    x = rng.random((4000, 3))
    y = 3 * x[:, 0] - x[:, 1] + 0.1 * x[:, 2] + np.where(rng.random(4000) < 0.05, 20.0, rng.normal(0, 0.05, 4000))  # outliers on one side
    rows = [(i, *map(float, r), float(v), 1.5) for i, (r, v) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "id int, a double, b double, d double, c double, flat double").repartition(8).cache()


def test_cosine_blocks_are_the_random_features(curve):
    wide = models.random_features(curve, ["a", "b", "d"], 40.0, 30, 3).orderBy("id").select("a", "b", "d", models.FEATURES).collect()
    blocks = models.cosine_blocks(3, 40.0, 30, 3)(np.array([r[:3] for r in wide]))
    assert np.allclose(np.concatenate([b for _, b in blocks]), [r[3].toArray() for r in wide], rtol=0, atol=1e-12)


def test_kernel_regression_reaches_the_minimum_in_few_passes(spark, curve):
    f, context = ["a", "b", "d"], spark.sparkContext
    context.setJobGroup("kernel-regression", "kernel regression")
    model = models.kernel_regression(curve, f, "c")
    context.setJobGroup("", "")
    # Each pass over the rows is a job or two; an iterative fit by gradients takes more than a hundred passes.
    assert len(context.statusTracker().getJobIdsForGroup("kernel-regression")) < 60
    scored = model.transform(curve).orderBy("id").toPandas()
    truth = 3 * scored.a - scored.b + 0.1 * scored.d
    assert list(scored.columns) == [*curve.columns, "prediction"]
    assert np.sqrt(((scored.prediction - truth) ** 2).mean()) < 0.05  # outliers move it by less than a row's noise
    features = np.concatenate([b.copy() for _, b in models.cosine_blocks(3, model.gamma)(scored[f].to_numpy())])
    spread, n = features.std(0, ddof=1), len(scored)

    def loss(weights, intercept, scale):
        r = np.abs(features @ weights + intercept - scored.c.to_numpy())
        near = (scale + r * r / scale) / 2
        return np.where(r <= 1.35 * scale, near, 1.35 * r + scale * (1 - 1.35**2) / 2).mean() + ((weights * spread) ** 2).sum() / (2 * n)

    least, rng = loss(model.weights, model.intercept, model.scale), np.random.default_rng(1)
    for _ in range(20):
        moved = model.weights + rng.normal(0, 0.01, len(spread)) * np.abs(model.weights)
        assert least < loss(moved, model.intercept, model.scale)
    for by in (0.99, 1.01):
        assert least < loss(model.weights, model.intercept * by, model.scale) and least < loss(model.weights, model.intercept, model.scale * by)


def test_kernel_regression_of_constant_and_missing_values(spark, curve):
    constant = models.kernel_regression(curve, ["a", "b"], "flat", count=10).transform(curve)
    assert {r[0] for r in constant.select("prediction").distinct().collect()} == {1.5}
    beside = models.kernel_regression(curve, ["flat"], "c", count=10).transform(curve)  # nothing to learn from: one level for all
    assert len({round(r[0], 6) for r in beside.select("prediction").collect()}) == 1
    for column in ("a", "c"):
        gappy = curve.withColumn(column, F.when(F.col("id") != 7, F.col(column)))
        with pytest.raises(Exception, match="missing"):
            models.kernel_regression(gappy, ["a", "b"], "c", gamma=1.0, count=10)
    model = models.kernel_regression(curve, ["a", "b"], "c", count=10)
    with pytest.raises(Exception, match="missing"):
        model.transform(curve.withColumn("a", F.when(F.col("id") != 7, F.col("a")))).collect()
    assert model.transform(curve.where("id < 0")).count() == 0
    with pytest.raises(ValueError, match="no training rows"):
        models.kernel_regression(curve.where("id < 0"), ["a", "b"], "c", count=10)
