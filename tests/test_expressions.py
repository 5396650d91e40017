"""Small hand-made tables with known answers."""

import datetime
import uuid

import pytest
from pyspark.sql import functions as F

from millrace.functions import clean, temporal
from millrace.operators import calendar, ordered, profile, relational as rel, rows


def column(spark, values, expression, dtype="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {dtype}")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("v"))).collect()]


def test_missing_tokens(spark):
    assert column(spark, [" NA ", "", "na", "UNKNOWN", " x ", None], clean.missing_tokens_to_null) == [None, None, "na", None, "x", None]


def test_labels(spark):
    assert column(spark, [" usa", "United States", "fr "], clean.canonical_label) == ["US", "US", "FR"]


def test_flags_are_strict(spark):
    assert column(spark, ["True", "False", None, "FALSE", "yes", "1"], clean.parse_flag) == [True, False, None, False, None, None]


def test_word_score_keeps_punctuation_and_reads_all_spaces(spark):
    texts = ["Great movie", "bad, terrible", "  great BAD  ", "", "great\u00a0amazing\n\tbad"]
    assert column(spark, texts, clean.word_score) == [1, -1, 0, 0, 1]


def test_buckets_are_right_closed(spark):
    assert column(spark, [0, 16, 65, 120, 121, None], clean.right_closed_bucket, "int") == [None, "(0, 16]", "(16, 65]", "(65, 120]", None, None]


def test_clip_keeps_missing(spark):
    assert column(spark, [1.0, 10.0, None], lambda c: clean.clip(c, 2.0, 9.25), "double") == [2.0, 9.25, None]


def test_whole_number_rejects_fractions_and_overflow(spark):
    assert column(spark, [1.0, None, 3.0], clean.whole_number, "double") == [1, None, 3]
    with pytest.raises(Exception, match="not a whole number"):
        column(spark, [1.5], clean.whole_number, "double")
    with pytest.raises(Exception, match="CAST_OVERFLOW"):
        column(spark, [300], lambda c: clean.whole_number(c, "tinyint"), "int")


def test_category_codes(spark):
    assert column(spark, ["b", "a", None, "z"], lambda c: clean.category_codes(["b", "a"], c)) == [1, 0, -1, -1]


def test_mixed_dates(spark):
    spelled = ["2024-01-15", "01/20/2024", "2024.02.01", "15-Mar-2024"]
    expected = [datetime.datetime(2024, 1, 15), datetime.datetime(2024, 1, 20), datetime.datetime(2024, 2, 1), datetime.datetime(2024, 3, 15)]
    assert column(spark, spelled, temporal.parse_date) == expected
    assert column(spark, ["x"], temporal.parse_date_or_null) == [None]
    with pytest.raises(Exception, match="unknown date format"):
        column(spark, ["x"], temporal.parse_date)


def test_month_end_and_zone(spark):
    stamp = [datetime.datetime(2024, 1, 31, 6), datetime.datetime(2024, 7, 1)]
    assert column(spark, stamp, lambda c: temporal.plus_months(c, 1), "timestamp_ntz")[0] == datetime.datetime(2024, 2, 29, 6)
    assert column(spark, stamp, lambda c: temporal.wall_clock(c, "America/New_York"), "timestamp_ntz")[1] == datetime.datetime(2024, 6, 30, 20)


def test_elapsed_days_floor(spark):
    first = F.lit("2024-01-01 12:00:00").cast("timestamp_ntz")
    assert column(spark, [datetime.datetime(2024, 1, 3, 0), datetime.datetime(2024, 1, 1, 0)],
                  lambda c: temporal.whole_days_between(first, c), "timestamp_ntz") == [1, -1]


def test_day_month_of_leap_day_is_dropped(spark):
    assert column(spark, ["29-02", "31-12", "01-03"], temporal.on_common_year) == [None, datetime.date(1900, 12, 31), datetime.date(1900, 3, 1)]


def test_schema_enforcement(spark):
    people = spark.createDataFrame(
        [(1.0, 25.0, "True", "US", 98.2), (3.0, 120.0, None, "FR", 91.0), (None, 30.0, "FALSE", "CA", 92.3)],
        "user_id double, age double, is_active string, country string, score double")
    done = people.transform(rows.chain(
        rows.assign(is_active=clean.parse_flag("is_active")),
        rows.enforce_schema({"user_id": "bigint", "age": "tinyint", "is_active": "boolean", "country": "string", "score": "float"},
                            {"country": clean.COUNTRY_DOMAIN})))
    assert [f.dataType.simpleString() for f in done.schema] == ["bigint", "tinyint", "boolean", "string", "float"]
    assert [r["country"] for r in done.orderBy("age").collect()] == ["US", "CA", None]
    with pytest.raises(Exception):
        people.transform(rows.enforce_schema({"absent": "int"})).collect()


def test_null_rules_of_grouping_and_joins(spark):
    table = spark.createDataFrame([("a", 1.0, 1, "x"), ("a", None, 2, "x"), (None, 5.0, 3, "y"), ("b", None, None, None)],
                                  "g string, v double, i int, c string")
    out = {r["g"]: tuple(r)[1:] for r in rel.group_summary("g", "v", "i", "c")(table).collect()}
    assert out == {"a": (1.0, 1.0, 2, 1), "b": (0.0, None, 0, 0)}
    kept = rel.with_group_summary("g", "v", "i", "c")(table)
    assert kept.count() == 4 and kept.where("g is null").first()["count_per_group"] is None
    right = spark.createDataFrame([(None, "n"), ("a", "m")], "g string, r string")
    assert table.transform(rel.left_join(right, "g")).where("r = 'n'").count() == 0
    assert table.transform(rel.left_join(right, "g", null_safe=True)).where("r = 'n'").count() == 1
    assert profile.duplicate_counts(table.select(F.lit(None).cast("int").alias("k")), "k").first().asDict() == {
        "total": 4, "distinct_values": 1, "duplicates": 3}
    assert rel.column_changes(["a", "b"], ["b", "c"]) == (["a", "c"], ["b"])
    features, target = rows.split_target(table, "i")
    assert features == ["g", "v", "c"] and target == "i"


def test_nan_counts_as_missing(spark):
    table = spark.createDataFrame([(1, float("nan")), (2, 4.0), (3, None), (4, 8.0)], "i int, v double")
    filled = table.transform(rows.fill_median(["v"])).orderBy("i")
    assert [r["v"] for r in filled.collect()] == [6.0, 4.0, 6.0, 8.0]
    assert table.transform(rows.nan_as_null).where("v > 0").count() == 2


def test_resample_has_empty_days(spark):
    table = spark.createDataFrame([(datetime.datetime(2024, 1, 1, 6), 1.0), (datetime.datetime(2024, 1, 3), 2.0)], "ts timestamp_ntz, value double")
    got = [tuple(r) for r in calendar.resample(table, "ts", "value").orderBy("ts").collect()]
    assert got == [(datetime.datetime(2024, 1, 1), 1.0, 1.0, 1.0, 1.0, 1), (datetime.datetime(2024, 1, 2), None, 0.0, None, None, 0),
                   (datetime.datetime(2024, 1, 3), 2.0, 2.0, 2.0, 2.0, 1)]
    quarter = calendar.resample(table, "ts", "value", "Q").first()["ts"]
    assert quarter == datetime.datetime(2024, 3, 31)


def test_nan_is_missing(spark):
    from millrace.operators import profile
    from millrace.operators.validation import Suite

    table = spark.createDataFrame([(1.0,), (float("nan"),), (None,), (9.0,)], "x double")
    assert profile.missing_profile(table).first()["null_count"] == 2
    assert Suite().no_nulls("x").counts(table).first()["invalid_count"] == 2
    clipped = [r[0] for r in table.select(clean.clip("x", 0.0, 5.0)).collect()]
    assert clipped[0] == 1.0 and clipped[1] != clipped[1] and clipped[2:] == [None, 5.0]


def test_long_ranges_and_listings(spark):
    from millrace.operators import profile

    span = calendar.date_range(spark, "1900-01-01 00:00:00", end="2024-01-01 00:00:00", freq="1 minute")
    assert span.agg(F.max("timestamp")).first()[0] == datetime.datetime(2024, 1, 1) and span.count() == 65_217_601
    months = [r[0].month for r in calendar.date_range(spark, "2024-01-01 00:00:00", end="2024-12-31 00:00:00", freq="1 month").collect()]
    assert sorted(months) == list(range(1, 13))
    repeats = profile.repeated_values(spark.range(25_001).select(F.lit(1).alias("v")), "v")
    assert repeats.agg(F.count("*"), F.sum("repeat")).first()[:] == (25_000, 25_000 * 25_001 // 2)


def test_date_ranges(spark):
    assert calendar.date_range(spark, "2024-01-01 00:00:00", periods=100, freq="6 hours").agg(F.max("timestamp")).first()[0] == datetime.datetime(2024, 1, 25, 18)
    assert calendar.date_range(spark, "2024-01-01 00:00:00", end="2024-01-31 00:00:00", freq="1 day").count() == 31


def test_continuity_verdict(spark):
    days = [datetime.date(2024, 1, 1), datetime.date(2024, 1, 2), datetime.date(2024, 1, 2), datetime.date(2024, 1, 4)]
    table = spark.createDataFrame([(d,) for d in days], "date date")
    assert tuple(calendar.continuity_report(table, "date").first()) == (4, 4, 1, 1, False)
    assert calendar.missing_days(table, "date").collect()[0]["day"] == datetime.date(2024, 1, 3)
    assert calendar.duplicate_days(table, "date").count() == 1
    assert calendar.continuity_report(table.distinct().where("date < '2024-01-03'"), "date").first()["is_continuous"]


def test_resetting_sum_example(spark):
    table = spark.createDataFrame([(i, v) for i, v in enumerate([0.5, 0.6, 0.2, 0.4, 0.5])], "i bigint, v double")
    got = [round(r["running"], 9) for r in ordered.resetting_sum(table, "v", "i").orderBy("i").collect()]
    assert got == [0.5, 1.1, 0.0, 0.4, 0.9]


def test_resetting_sum_missing_value_until_next_reset(spark):
    table = spark.createDataFrame([(0, 1.0), (1, None), (2, 1.0), (3, 0.1), (4, 2.0)], "i bigint, v double")
    for size in (1000, 1):
        got = [r["running"] for r in ordered.resetting_sum(table, "v", "i", rows_per_slice=size).orderBy("i").collect()]
        assert got == [1.0, None, None, 0.0, 2.0]


def test_row_wise_steps_run_on_a_stream(spark, tmp_path):
    from millrace.streaming.chunks import process_new_files

    source, sink, name = str(tmp_path / "in"), str(tmp_path / "out"), f"stream-{uuid.uuid4().hex}"  # its progress outlives a run
    step = rows.chain(rows.assign(label=clean.missing_tokens_to_null("label")), rows.drop_missing(["label"]))
    batches = [[(1, " NA "), (2, " x ")], [(3, "y")]]
    for batch in batches:
        spark.createDataFrame(batch, "id bigint, label string").write.mode("append").parquet(source)
        process_new_files(spark, source, "id bigint, label string", step, sink, name)
    assert sorted(tuple(r) for r in spark.read.parquet(sink).collect()) == [(2, "x"), (3, "y")]
