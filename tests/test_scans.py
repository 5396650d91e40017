"""Global scans, quantiles and neighbour joins: any layout must give the brute-force answer, hot values included."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from millrace.operators import neighbours, ordered, quantiles


@pytest.fixture(scope="module")
def series(spark):
    """A third of the rows share one order value."""
    rng = np.random.default_rng(7)
    n = 3000
    order = np.where(np.arange(n) % 3 == 0, 50, rng.integers(0, 100, n))
    value = np.where(rng.random(n) < 0.2, np.nan, rng.random(n) * 2)
    pdf = pd.DataFrame({"id": np.arange(n), "t": order, "g": np.where(rng.random(n) < 0.4, "hot", "cold"), "v": value}).sort_values(["t", "id"])
    df = spark.createDataFrame(pdf.sample(frac=1, random_state=1)).withColumn("v", F.when(~F.isnan("v"), F.col("v"))).cache()
    return pdf, df


def by_order(df):
    return df.toPandas().sort_values(["t", "id"]).reset_index(drop=True)


@pytest.mark.parametrize("size", [10_000, 170, 20])
def test_missing_keys_are_one_group(series, size):
    pdf, df = series
    keyed = df.withColumn("g", F.when(F.col("g") == "hot", F.col("g")))
    filled = by_order(ordered.forward_fill(keyed, ["v"], "t", "id", by=["g"], rows_per_slice=size))
    assert np.allclose(filled.v, pdf.groupby("g").v.ffill(), equal_nan=True)
    assert by_order(ordered.resetting_sum(keyed.fillna(0.5, ["v"]), "v", "t", "id", by=["g"], rows_per_slice=size)).running.notna().all()


@pytest.mark.parametrize("size", [10_000, 170, 20])
def test_scans_match_pandas(series, size):
    pdf, df = series
    assert (by_order(ordered.row_index(df, "t", "id", rows_per_slice=size)).row_index == np.arange(len(pdf))).all()
    filled = by_order(ordered.forward_fill(df, ["v"], "t", "id", fill_start=True, rows_per_slice=size))
    assert np.allclose(filled.v, pdf.v.ffill().bfill())
    mean = by_order(ordered.centered_mean(df, {"m": "v"}, "t", "id", rows_per_slice=size))
    assert np.allclose(mean.m, pdf.v.rolling(7, center=True, min_periods=1).mean())
    grouped = by_order(ordered.forward_fill(df, ["v"], "t", "id", by=["g"], rows_per_slice=size))
    assert np.allclose(grouped.v, pdf.groupby("g").v.ffill(), equal_nan=True)

    total, expected = 0.0, []
    for x in pdf.v.fillna(0.5):
        total = 0.0 if x < 0.3 else total + x
        expected.append(total)
    complete = df.withColumn("v", F.coalesce("v", F.lit(0.5)))
    assert np.allclose(by_order(ordered.resetting_sum(complete, "v", "t", "id", rows_per_slice=size)).running, expected)


def test_hot_order_value_is_split(series):
    _, df = series
    sizes = [r["count"] for r in ordered.sliced(df, "t", "id", 100).groupBy(ordered.SLICE).count().collect()]
    assert max(sizes) < 250 and sum(sizes) == 3000


@pytest.mark.parametrize("final", [20_000, 100, 1])
def test_exact_quantiles(spark, final):
    rng = np.random.default_rng(3)
    a = np.where(np.arange(30_000) % 3 == 0, 5.0, rng.normal(size=30_000))
    b = rng.integers(0, 40, 30_000).astype(float)
    b[::11] = np.nan
    df = spark.createDataFrame(pd.DataFrame({"a": a, "b": b})).cache()
    probs = [0.0, 0.1, 0.25, 0.5, 2 / 3, 0.9, 1.0]
    found = quantiles.exact_quantiles(df, ["a", "b"], probs, final_distinct=final)
    assert np.allclose(found["a"], np.percentile(a, [100 * p for p in probs]))
    assert np.allclose(found["b"], np.nanpercentile(b, [100 * p for p in probs]))


def test_quantiles_of_nothing_and_of_four(spark):
    df = spark.createDataFrame([(1.0, None), (2.0, None), (3.0, None), (10.0, None)], "x double, y double")
    assert quantiles.exact_quantiles(df, ["x", "y"], [0.25, 0.5, 0.75]) == {"x": [1.75, 2.5, 4.75], "y": [None, None, None]}


def brute(pdf, k):
    out, points, ids, groups = set(), np.array(pdf.vec.tolist()), pdf.id.to_numpy(), pdf.grp.to_numpy()
    for i in range(len(ids)):
        others = (groups == groups[i]) & (ids != ids[i])
        distance = np.sqrt(((points[others] - points[i]) ** 2).sum(1))
        order = np.lexsort((ids[others], distance))[:k]
        out |= {(ids[i], ids[others][j], r + 1) for r, j in enumerate(order)}
    return out


@pytest.mark.parametrize("options", [{}, {"shipped_numbers": 0, "block_rows": 64, "cell_rows": 20}])
def test_neighbours_with_copies_and_ties(spark, options):
    rng = np.random.default_rng(5)
    n = 400
    points = rng.integers(0, 6, size=(n, 2)).astype(float)
    points[::3] = [1.0, 2.0]  # a third of the rows are copies
    pdf = pd.DataFrame({"id": np.arange(n), "vec": points.tolist(), "grp": np.where(rng.random(n) < 0.3, "a", "b")})
    df = spark.createDataFrame(pdf, "id bigint, vec array<double>, grp string").cache()
    found = neighbours.knn_join(df, df, 4, exclude_self=True, **options).collect()
    assert {(r["query_id"], r["donor_id"], r["rank"]) for r in found} == brute(pdf, 4)


def test_far_cells_are_not_sent_to(spark):
    """Clusters in 64 dimensions: exact, and donors go to under a fifth of the cells."""
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(30, 64)) * 4
    points = centres[rng.integers(0, 30, size=3000)] + rng.normal(size=(3000, 64)) * 0.1
    pdf = pd.DataFrame({"id": np.arange(3000), "vec": points.tolist(), "grp": "all"})
    df = spark.createDataFrame(pdf, "id bigint, vec array<double>, grp string").cache()
    report = []
    found = neighbours.knn_join(df, df, 5, exclude_self=True, shipped_numbers=0, block_rows=200, cell_rows=60, report=report)
    assert {(r["query_id"], r["donor_id"], r["rank"]) for r in found.collect()} == brute(pdf, 5)
    assert report[0]["cells"] > 30
    assert sum(r["copies"] for r in report) < 0.2 * report[0]["cells"] * 3000


def test_neighbours_from_another_table_in_cells(spark):
    """Queries with few donors near by, groups without donors, and fewer donors than asked for."""
    rng = np.random.default_rng(9)
    donors = pd.DataFrame({"id": np.arange(300), "vec": rng.normal(size=(300, 5)).tolist(), "grp": ["a"] * 297 + ["b"] * 3})
    queries = pd.DataFrame({"id": np.arange(100), "vec": (rng.normal(size=(100, 5)) * 3).tolist(), "grp": ["a"] * 80 + ["b"] * 10 + ["c"] * 10})
    schema = "id bigint, vec array<double>, grp string"
    tables = [spark.createDataFrame(t, schema) for t in (queries, donors)]
    plain = {tuple(r) for r in neighbours.knn_join(*tables, 4).select("query_id", "donor_id", "rank").collect()}
    celled = neighbours.knn_join(*tables, 4, shipped_numbers=0, block_rows=50, cell_rows=10)
    assert {tuple(r) for r in celled.select("query_id", "donor_id", "rank").collect()} == plain
    assert len(plain) == 80 * 4 + 10 * 3


def test_neighbours_of_too_small_groups(spark):
    df = spark.createDataFrame([(1, [0.0], "a"), (2, [1.0], "a"), (3, [5.0], "b")], "id bigint, vec array<double>, grp string")
    found = {(r["query_id"], r["donor_id"]) for r in neighbours.knn_join(df, df, 5, exclude_self=True).collect()}
    assert found == {(1, 2), (2, 1)}


def test_three_hundred_columns_correlate_like_pairs(spark):
    from millrace.operators import profile

    rng = np.random.default_rng(6)
    data = rng.normal(size=(400, 300)) + 1000 * rng.normal(size=300)
    data[:, 1] = 3 - data[:, 0]
    data[:, 2] = 5.0
    data[rng.random(data.shape) < 0.05] = np.nan
    data[:, 3] = np.nan
    names = [f"c{i}" for i in range(300)]
    table = spark.createDataFrame(pd.DataFrame({"v": data.tolist()}), "v array<double>").repartition(3)
    found = {(r["left"], r["right"]): r["corr"] for r in profile.wide_correlations(table, names, F.col("v")).collect()}
    assert len(found) == 300 * 299 // 2
    expected = pd.DataFrame(data, columns=names).corr(min_periods=2)
    for a, b in [(0, 1), (0, 4), (17, 203), (5, 299), (150, 151)]:
        assert np.isclose(found[names[a], names[b]], expected.iloc[a, b], atol=1e-9)
    assert found["c0", "c2"] is None and found["c0", "c3"] is None
    narrow = table.select(*[F.col("v")[i].alias(names[i]) for i in (0, 4, 5)])
    pairs = profile.wide_correlations(narrow, narrow.columns).collect()
    assert {(r["left"], r["right"]): round(r["corr"], 9) for r in pairs} == {
        k: round(found[k], 9) for k in (("c0", "c4"), ("c0", "c5"), ("c4", "c5"))}


def test_user_scan_carries_state_over_slices_of_a_hot_key(spark):
    import struct

    rng = np.random.default_rng(7)
    pdf = pd.DataFrame({"id": np.arange(600), "k": np.where(rng.random(600) < 0.4, 0, rng.integers(1, 9, 600)), "v": rng.random(600)})
    pdf.loc[5:9, "k"] = -1
    table = spark.createDataFrame(pdf).withColumn("k", F.expr("nullif(k, -1)"))

    def total(rows):
        return struct.pack("<dq", rows["v"].sum(), len(rows))

    def combine(state, does):
        a, b = struct.unpack("<dq", state or bytes(16)), struct.unpack("<dq", does)
        return struct.pack("<dq", a[0] + b[0], a[1] + b[1])

    def running(rows, state):
        before, n = struct.unpack("<dq", state or bytes(16))
        return rows.assign(upto=rows["v"].cumsum() + before, nth=n + np.arange(len(rows)), seen=len(rows))[["id", "upto", "nth", "seen"]]

    found = ordered.scan_in_slices(table, ["k"], "id", None, total, combine, running, "id bigint, upto double, nth bigint, seen bigint",
                                   rows_per_slice=50).toPandas().sort_values("id")
    assert (found["upto"].to_numpy() - pdf.groupby("k")["v"].cumsum().to_numpy()).__abs__().max() < 1e-9
    assert (found["nth"].to_numpy() == pdf.groupby("k").cumcount().to_numpy()).all()
    assert found["seen"].max() <= 60


def test_user_scan_calls_once_for_a_small_key(spark):
    """Keys of fewer rows than a slice are handed over whole, however their rows lie in the order; the large one is cut evenly."""
    n = 4000
    pdf = pd.DataFrame({"id": np.arange(n), "k": np.where(np.arange(n) % 2 == 0, 0, np.arange(n) % 100), "v": 1.0})

    def rows_seen(rows, state):
        return rows.assign(seen=len(rows), nth=int(state or b"0") + np.arange(len(rows)))[["id", "k", "seen", "nth"]]

    found = ordered.scan_in_slices(
        spark.createDataFrame(pdf), ["k"], "id", None, lambda rows: b"%d" % len(rows), lambda state, does: b"%d" % (int(state or b"0") + int(does)),
        rows_seen, "id bigint, k bigint, seen bigint, nth bigint", rows_per_slice=100).toPandas().sort_values("id")
    assert (found["seen"].to_numpy() == np.where(pdf["k"] == 0, 100, 40)).all()
    assert (found["nth"].to_numpy() == pdf.groupby("k").cumcount().to_numpy()).all()


@pytest.mark.parametrize("groups", [["all"], ["a", "a", "a", "b"]])
def test_neighbours_in_an_even_cloud_are_compared_in_packed_blocks(spark, monkeypatch, groups):
    """Where cells rule nothing out, rows go to a number of blocks that does not grow with the cells; exact as before."""
    monkeypatch.setattr(neighbours, "FEW_COPIES", 0)
    monkeypatch.setattr(neighbours, "ALL_PAIRS_ROWS", 100)
    rng = np.random.default_rng(10)
    points = rng.normal(size=(700, 48)).round(2)
    points[:30] = points[30:60]
    pdf = pd.DataFrame({"id": np.arange(700), "vec": points.tolist(), "grp": [groups[i % len(groups)] for i in range(700)]})
    df = spark.createDataFrame(pdf, "id bigint, vec array<double>, grp string").cache()
    report = []
    found = neighbours.knn_join(df, df, 5, exclude_self=True, shipped_numbers=0, block_rows=50, cell_rows=10, report=report)
    assert {(r["query_id"], r["donor_id"], r["rank"]) for r in found.collect()} == brute(pdf, 5)
    assert report[-1]["round"] == "all" and report[-1]["copies"] <= 2 * 7 * 700


def test_nearest_rows_of_a_block_under_rounding():
    """Far offsets, ties, copies of one distance and huge numbers: the shortlist in single precision loses no neighbour."""
    rng = np.random.default_rng(11)
    centres = np.repeat(rng.normal(size=(4, 8)) * 1000, 400, 0)
    for points in (rng.normal(size=(1500, 6)) + 1e6, centres + rng.normal(size=centres.shape) * 0.01, np.eye(300),
                   rng.integers(0, 4, size=(1300, 2)).astype(float), rng.normal(size=(1200, 3)) * 1e20):
        rank = rng.permutation(len(points))
        i, j, far = neighbours.nearest_in_block(points[:40], points, rank, 4)
        for q in range(40):
            distance = np.sqrt(((points - points[q]) ** 2).sum(1))
            best = np.lexsort((rank, distance))[:4]
            assert j[i == q].tolist() == best.tolist() and (far[i == q] == distance[best]).all()
