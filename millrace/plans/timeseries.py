"""Ordered scans, calendar jobs and time-based folds over events and orders."""

from pyspark.sql import functions as F

from millrace.functions import temporal
from millrace.ml.split import expanding_folds
from millrace.operators import calendar, ordered, rows
from millrace.plans.catalog import register, rounded

# Small enough that the test tables already take several slices; results do not depend on it.
SLICE_ROWS = 20_000


def hourly_gaps(t):
    """Events with the value missing for some keys."""
    return t("events").select("event_id", "ts", "user_id", F.when(F.col("event_id") % 5 != 0, F.col("value")).alias("value"))


@register("resetting_running_sum", "E3 I4", """
WITH s AS (SELECT event_id, ts, value, sum(CASE WHEN value < 5 THEN 1 ELSE 0 END) OVER (ORDER BY ts, event_id) AS seg FROM events)
SELECT event_id, round(sum(CASE WHEN value < 5 THEN 0 ELSE value END) OVER (PARTITION BY seg ORDER BY ts, event_id), 4) AS running FROM s""")
def resetting(t):
    events = t("events").select("event_id", "ts", "value")
    done = ordered.resetting_sum(events, "value", "ts", "event_id", threshold=5.0, rows_per_slice=SLICE_ROWS)
    return done.select("event_id", rounded("running", 4))


@register("resetting_running_sum_per_user", "E3 I4", """
WITH s AS (SELECT event_id, user_id, ts, value, sum(CASE WHEN value < 5 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS seg FROM events)
SELECT event_id, round(sum(CASE WHEN value < 5 THEN 0 ELSE value END) OVER (PARTITION BY user_id, seg ORDER BY ts, event_id), 4) AS running FROM s""")
def resetting_per_user(t):
    events = t("events").select("event_id", "user_id", "ts", "value")
    done = ordered.resetting_sum(events, "value", "ts", "event_id", threshold=5.0, by=["user_id"], rows_per_slice=SLICE_ROWS)
    return done.select("event_id", rounded("running", 4))


@register("forward_filled_values", "E4 L8", """
WITH g AS (SELECT event_id, ts, user_id, CASE WHEN event_id % 5 <> 0 THEN value END AS value FROM events)
SELECT event_id, last_value(value IGNORE NULLS) OVER (ORDER BY ts, event_id) AS value FROM g""")
def forward_filled(t):
    return ordered.forward_fill(hourly_gaps(t), ["value"], "ts", "event_id", rows_per_slice=SLICE_ROWS).select("event_id", "value")


@register("forward_filled_values_per_user", "E4 L8", """
WITH g AS (SELECT event_id, ts, user_id, CASE WHEN event_id % 5 <> 0 THEN value END AS value FROM events),
f AS (SELECT event_id, user_id, ts, last_value(value IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS v,
             first_value(value IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS nxt FROM g)
SELECT event_id, coalesce(v, nxt) AS value FROM f""")
def forward_filled_per_user(t):
    done = ordered.forward_fill(hourly_gaps(t), ["value"], "ts", "event_id", by=["user_id"], fill_start=True, rows_per_slice=SLICE_ROWS)
    return done.select("event_id", "value")


@register("forward_filled_values_missing_user", "E4 L8", """
WITH g AS (SELECT event_id, ts, CASE WHEN user_id % 4 <> 1 THEN user_id END AS u, CASE WHEN event_id % 5 <> 0 THEN value END AS value FROM events)
SELECT event_id, last_value(value IGNORE NULLS) OVER (PARTITION BY u ORDER BY ts, event_id) AS value FROM g""")
def forward_filled_missing_user(t):
    rows = hourly_gaps(t).withColumn("u", F.when(F.col("user_id") % 4 != 1, F.col("user_id")))
    return ordered.forward_fill(rows, ["value"], "ts", "event_id", by=["u"], rows_per_slice=SLICE_ROWS).select("event_id", "value")


@register("centered_rolling_mean", "E2", """
SELECT event_id, round(avg(CASE WHEN event_id % 5 <> 0 THEN value END) OVER (ORDER BY ts, event_id ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING), 6) AS rolling FROM events""")
def centered(t):
    done = ordered.centered_mean(hourly_gaps(t), {"rolling": "value"}, "ts", "event_id", rows_per_slice=SLICE_ROWS)
    return done.select("event_id", rounded("rolling"))


_DAILY = """
SELECT s.ts, round(value_mean, 6) AS value_mean, round(coalesce(value_sum, 0), 4) AS value_sum, value_min, value_max, coalesce(value_count, 0) AS value_count FROM s LEFT JOIN b USING (ts)"""


@register("daily_resample", "D14 A13", """
WITH e AS (SELECT * FROM events WHERE day(ts) NOT IN (5, 6, 17)),
b AS (SELECT date_trunc('day', ts)::TIMESTAMP AS ts, avg(value) AS value_mean, sum(value) AS value_sum, min(value) AS value_min, max(value) AS value_max, count(value) AS value_count FROM e GROUP BY 1),
s AS (SELECT unnest(generate_series((SELECT min(ts) FROM b), (SELECT max(ts) FROM b), INTERVAL 1 DAY)) AS ts)""" + _DAILY)
def daily_resample(t):
    gappy = t("events").where(~F.dayofmonth("ts").isin(5, 6, 17))
    return calendar.resample(gappy, "ts", "value", "D").select(
        "ts", rounded("value_mean"), rounded("value_sum", 4), "value_min", "value_max", "value_count")


@register("monthly_resample", "D14", """
WITH b AS (SELECT (date_trunc('month', o_orderdate) + INTERVAL 1 MONTH - INTERVAL 1 DAY)::TIMESTAMP AS o_orderdate, round(avg(o_totalprice), 4) AS price_mean, min(o_totalprice) AS price_min,
  max(o_totalprice) AS price_max, count(o_totalprice) AS price_count FROM orders GROUP BY date_trunc('month', o_orderdate))
SELECT * FROM b""")
def monthly_resample(t):
    orders = t("orders").select("o_orderdate", F.col("o_totalprice").alias("price"))
    return calendar.resample(orders, "o_orderdate", "price", "M").select(
        "o_orderdate", rounded("price_mean", 4), "price_min", "price_max", "price_count")


@register("weekly_resample", "D14", """
SELECT (date_trunc('week', ts) + INTERVAL 6 DAY)::TIMESTAMP AS ts, round(avg(value), 6) AS value_mean, count(value) AS value_count FROM events GROUP BY date_trunc('week', ts)""")
def weekly_resample(t):
    return calendar.resample(t("events"), "ts", "value", "W").select("ts", rounded("value_mean"), "value_count")


@register("six_hour_spine", "A13", """
SELECT unnest(generate_series((SELECT date_trunc('day', min(ts))::TIMESTAMP FROM events), (SELECT date_trunc('day', max(ts))::TIMESTAMP FROM events), INTERVAL 6 HOUR)) AS slot""")
def six_hour_spine(t):
    span = t("events").agg(F.min("ts").alias("a"), F.max("ts").alias("b"))
    day = lambda c: F.date_trunc("day", c).cast("timestamp_ntz")
    return span.select(F.explode(F.sequence(day("a"), day("b"), F.expr("interval 6 hours"))).alias("slot"))


@register("time_label_slice", "B4", """
SELECT event_id, ts FROM events WHERE ts >= TIMESTAMP '2024-01-03' AND ts < TIMESTAMP '2024-01-08'""")
def time_slice(t):
    return t("events").select("event_id", "ts").transform(rows.time_slice("ts", "2024-01-03", "2024-01-07"))


@register("day_of_year_climatology", "R1 B5 D2 E2 H22 H23", """
WITH d AS (SELECT strftime(o_orderdate, '%d-%m') AS DayMonth, avg(o_totalprice) AS price, avg(o_custkey) AS cust FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM') GROUP BY 1),
p AS (SELECT *, make_date(1900, substr(DayMonth, 4, 2)::INTEGER, substr(DayMonth, 1, 2)::INTEGER) AS plot_date FROM d WHERE DayMonth <> '29-02')
SELECT DayMonth, plot_date, round(price, 4) AS price, round(avg(price) OVER w, 4) AS price_7d_rolling_mean, round(avg(cust) OVER w, 4) AS cust_7d_rolling_mean
FROM p WINDOW w AS (ORDER BY plot_date ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING)""")
def climatology(t):
    orders = t("orders").select("o_orderdate", "o_orderpriority", F.col("o_totalprice").alias("price"), F.col("o_custkey").alias("cust"))
    kept = F.col("o_orderpriority").isin("1-URGENT", "2-HIGH", "3-MEDIUM")
    done = calendar.climatology(orders, "o_orderdate", ["price", "cust"], kept)
    return done.select("DayMonth", "plot_date", *[rounded(c, 4) for c in ("price", "price_7d_rolling_mean", "cust_7d_rolling_mean")])


_DAYS = "WITH d AS (SELECT user_id, ts::DATE AS day, count(*) AS n FROM events GROUP BY ALL)"


@register("date_continuity_report", "R2 C4 D10 A13", _DAYS + """
SELECT user_id, sum(n)::BIGINT AS total_rows, (max(day) - min(day) + 1)::BIGINT AS expected_rows, (max(day) - min(day) + 1 - count(*))::BIGINT AS missing_days,
       (sum(n) - count(*))::BIGINT AS duplicate_rows, (max(day) - min(day) + 1 = count(*)) AND sum(n) = count(*) AS is_continuous FROM d GROUP BY user_id""")
def continuity(t):
    return calendar.continuity_report(t("events"), "ts", ["user_id"])


@register("missing_dates", "R2 C4 G2 A13", _DAYS + """,
s AS (SELECT user_id, unnest(generate_series(min(day)::TIMESTAMP, max(day)::TIMESTAMP, INTERVAL 1 DAY))::DATE AS day FROM d GROUP BY user_id)
SELECT user_id, day FROM s ANTI JOIN d USING (user_id, day)""")
def missing_dates(t):
    return calendar.missing_days(t("events"), "ts", ["user_id"])


@register("duplicate_dates", "R2 D10", _DAYS + """
SELECT user_id, day, unnest(generate_series(1, n - 1))::INTEGER AS repeat FROM d WHERE n > 1""")
def duplicate_dates(t):
    return calendar.duplicate_days(t("events"), "ts", ["user_id"]).withColumn("repeat", F.col("repeat").cast("int"))


@register("datetime_pipeline", "R3 H17 H18 H20 H21 B3 D14 B4 F3", """
WITH e AS (SELECT * FROM events WHERE hour(ts) BETWEEN 6 AND 18),
b AS (SELECT date_trunc('day', ts)::TIMESTAMP AS ts, avg(value) AS value_mean, sum(value) AS value_sum, min(value) AS value_min, max(value) AS value_max, count(value) AS value_count FROM e GROUP BY 1),
s AS (SELECT unnest(generate_series((SELECT min(ts) FROM b), (SELECT max(ts) FROM b), INTERVAL 1 DAY)) AS ts)
SELECT s.ts, round(value_mean, 6) AS value_mean, round(coalesce(value_sum, 0), 4) AS value_sum, value_min, value_max, coalesce(value_count, 0) AS value_count,
       timezone('America/New_York', timezone('UTC', s.ts)) AS ts_ny
FROM s LEFT JOIN b USING (ts) WHERE s.ts >= TIMESTAMP '2024-01-01' AND s.ts < TIMESTAMP '2024-01-08'""")
def datetime_pipeline(t):
    def add_parts(df):
        return df.select("*", *temporal.date_parts("ts"))

    events = t("events")
    start = events.agg(F.min("ts").alias("first")).scalar()
    return events.transform(rows.chain(
        add_parts,
        rows.assign(one_week_later=temporal.plus_days("ts", 7), one_month_later=temporal.plus_months("ts", 1),
                    days_since_start=temporal.whole_days_between(start, "ts")),
        rows.between("hour", 6, 18),
        lambda df: calendar.resample(df, "ts", "value", "D"),
        rows.assign(ts_ny=temporal.wall_clock("ts", "America/New_York")),
        rows.time_slice("ts", "2024-01-01", "2024-01-07"),
        lambda df: df.orderBy("ts"),
    )).select("ts", rounded("value_mean"), rounded("value_sum", 4), "value_min", "value_max", "value_count", "ts_ny")


@register("expanding_time_folds", "O6", """
WITH p AS (SELECT event_id, row_number() OVER (ORDER BY ts, event_id) - 1 AS pos, count(*) OVER () AS n FROM events)
SELECT event_id, greatest(0, 5 - ((n - 1 - pos) // (n // 6)))::INTEGER AS block FROM p""")
def time_folds(t):
    return expanding_folds(t("events").select("event_id", "ts"), "ts", "event_id", 5, rows_per_slice=SLICE_ROWS).select("event_id", "block")
