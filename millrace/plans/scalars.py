"""Column expressions over whole tables."""

from pyspark.sql import functions as F

from millrace.functions import clean, temporal
from millrace.operators import ordered
from millrace.plans.catalog import register, rounded


@register("missing_tokens", "H1", """
WITH e AS (SELECT event_id, CASE event_id % 6 WHEN 0 THEN ' NA ' WHEN 1 THEN '' WHEN 2 THEN 'na' WHEN 3 THEN 'UNKNOWN' ELSE ' ' || event_type || ' ' END AS raw FROM events)
SELECT event_id, CASE WHEN trim(raw) NOT IN ('', 'NA', 'NaN', 'null', 'UNKNOWN') THEN trim(raw) END AS label FROM e""")
def missing_tokens(t):
    k = F.col("event_id") % 6
    raw = F.when(k == 0, " NA ").when(k == 1, "").when(k == 2, "na").when(k == 3, "UNKNOWN").otherwise(F.concat(F.lit(" "), "event_type", F.lit(" ")))
    return t("events").select("event_id", clean.missing_tokens_to_null(raw).alias("label"))


@register("canonical_labels", "H2", """
WITH d AS (SELECT doc_id, CASE lang WHEN 'en' THEN ' usa' WHEN 'fr' THEN 'United States' ELSE lang || ' ' END AS raw FROM documents)
SELECT doc_id, CASE upper(trim(raw)) WHEN 'USA' THEN 'US' WHEN 'UNITED STATES' THEN 'US' ELSE upper(trim(raw)) END AS country FROM d""")
def canonical_labels(t):
    raw = F.when(F.col("lang") == "en", " usa").when(F.col("lang") == "fr", "United States").otherwise(F.concat("lang", F.lit(" ")))
    return t("documents").select("doc_id", clean.canonical_label(raw).alias("country"))


@register("strict_flags", "H3", """
WITH e AS (SELECT event_id, CASE event_id % 5 WHEN 0 THEN 'True' WHEN 1 THEN 'FALSE' WHEN 2 THEN 'yes' WHEN 3 THEN NULL ELSE 'false' END AS raw FROM events)
SELECT event_id, CASE upper(raw) WHEN 'TRUE' THEN true WHEN 'FALSE' THEN false END AS is_active FROM e""")
def strict_flags(t):
    k = F.col("event_id") % 5
    raw = F.when(k == 0, "True").when(k == 1, "FALSE").when(k == 2, "yes").when(k == 4, "false")
    return t("events").select("event_id", clean.parse_flag(raw).alias("is_active"))


@register("word_scores", "H4", """
WITH w AS (SELECT doc_id, unnest(regexp_split_to_array(lower(text), '[\\s\\pZ\\x{85}\\x1c-\\x1f]+')) AS word FROM documents)
SELECT doc_id, count(*) FILTER (WHERE word IN ('the', 'of', 'great', 'amazing')) - count(*) FILTER (WHERE word IN ('and', 'bad', 'terrible')) AS score
FROM w GROUP BY doc_id""")
def word_scores(t):
    score = clean.word_score("text", [*clean.POSITIVE_WORDS, "the", "of"], [*clean.NEGATIVE_WORDS, "and"])
    return t("documents").select("doc_id", score.cast("bigint").alias("score"))


@register("regex_from_start", "H5 J11", """
SELECT event_id, coalesce(regexp_matches(kind, '^(?:c[a-z]+|p)'), false) AS matches FROM
  (SELECT event_id, CASE WHEN event_id % 10 <> 0 THEN event_type END AS kind FROM events)""")
def regex_from_start(t):
    kind = F.when(F.col("event_id") % 10 != 0, F.col("event_type"))
    return t("events").select("event_id", clean.matches_from_start(kind, "c[a-z]+|p").alias("matches"))


@register("indexed_category_key", "H6 H7", """
SELECT event_id, event_type || '_' || user_id || '_' || (row_number() OVER (ORDER BY ts, event_id) - 1) AS category_key FROM events""")
def indexed_key(t):
    numbered = ordered.row_index(t("events").select("event_id", "ts", "user_id", "event_type"), "ts", "event_id", rows_per_slice=20_000)
    parts = [F.col("event_type"), F.col("user_id").cast("string"), F.col("row_index").cast("string")]
    return numbered.select("event_id", F.concat_ws("_", *parts).alias("category_key"))


@register("typed_columns", "H7 H8 H9", """
SELECT l_orderkey, l_linenumber, CAST(l_orderkey AS VARCHAR) AS key_text, l_quantity::BIGINT AS quantity, l_linenumber::TINYINT AS line, l_tax::FLOAT AS tax FROM lineitem""")
def typed_columns(t):
    return t("lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_orderkey").cast("string").alias("key_text"), clean.whole_number("l_quantity").alias("quantity"),
        clean.whole_number("l_linenumber", "tinyint").alias("line"), F.col("l_tax").cast("float").alias("tax"))


@register("category_codes_and_domain", "H10 H11", """
SELECT o_orderkey, CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN o_orderpriority END AS priority,
       CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 WHEN 'P' THEN 2 ELSE -1 END AS code FROM orders""")
def codes_and_domain(t):
    return t("orders").select("o_orderkey", clean.keep_domain("o_orderpriority", ["1-URGENT", "2-HIGH"]).alias("priority"),
                              clean.category_codes(["P", "O", "F"], "o_orderstatus").alias("code"))


@register("right_closed_buckets", "H13", """
WITH a AS (SELECT event_id, (event_id % 125)::BIGINT AS age FROM events)
SELECT event_id, CASE WHEN age > 0 AND age <= 16 THEN '(0, 16]' WHEN age > 16 AND age <= 65 THEN '(16, 65]' WHEN age > 65 AND age <= 120 THEN '(65, 120]' END AS age_bucket,
       coalesce(age >= 65, false) AS is_senior FROM a""")
def buckets(t):
    age = F.col("event_id") % 125
    return t("events").select("event_id", clean.right_closed_bucket(age).alias("age_bucket"), clean.holds(age >= 65).alias("is_senior"))


@register("clipped_values", "H14", """
SELECT event_id, CASE WHEN event_id % 9 <> 0 THEN least(greatest(value, 5.0::DOUBLE), 50.0::DOUBLE) END AS value FROM events""")
def clipped(t):
    return t("events").select("event_id", clean.clip(F.when(F.col("event_id") % 9 != 0, F.col("value")), 5.0, 50.0).alias("value"))


_SPELLED = """
WITH d AS (SELECT o_orderkey, o_orderdate, CASE o_orderkey % 4 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 1 THEN strftime(o_orderdate, '%m/%d/%Y')
  WHEN 2 THEN strftime(o_orderdate, '%Y.%m.%d') ELSE strftime(o_orderdate, '%d-%b-%Y') END AS spelled FROM orders)
"""


def _spelled(t):
    k = F.col("o_orderkey") % 4
    patterns = temporal.DATE_FORMATS
    text = F.when(k == 0, F.date_format("o_orderdate", patterns[0])).when(k == 1, F.date_format("o_orderdate", patterns[1])).when(
        k == 2, F.date_format("o_orderdate", patterns[2])).otherwise(F.date_format("o_orderdate", patterns[3]))
    return t("orders").select("o_orderkey", text.alias("spelled"))


@register("mixed_date_spellings", "H15", _SPELLED + "SELECT o_orderkey, spelled, o_orderdate::TIMESTAMP AS parsed FROM d")
def mixed_dates(t):
    return _spelled(t).select("o_orderkey", "spelled", temporal.parse_date("spelled").alias("parsed"))


@register("lenient_dates", "H16", _SPELLED + """
SELECT o_orderkey, CASE WHEN o_orderkey % 7 <> 0 THEN o_orderdate::TIMESTAMP END AS parsed FROM d""")
def lenient_dates(t):
    broken = F.when(F.col("o_orderkey") % 7 == 0, F.concat(F.lit("x"), "spelled")).otherwise(F.col("spelled"))
    return _spelled(t).select("o_orderkey", temporal.parse_date_or_null(broken).alias("parsed"))


@register("date_parts_and_arithmetic", "H17 H18 H19 E5", """
SELECT event_id, year(ts)::INTEGER AS year, month(ts)::INTEGER AS month, day(ts)::INTEGER AS day, hour(ts)::INTEGER AS hour, ts + INTERVAL 7 DAY AS one_week_later,
       ts + INTERVAL 1 MONTH AS one_month_later,
       (epoch_us(ts) - (SELECT epoch_us(min(ts)) FROM events)) // 86400000000 AS days_since_start
FROM events""")
def date_parts(t):
    events = t("events")
    start = events.agg(F.min("ts").alias("first")).scalar()
    return events.select("event_id", *temporal.date_parts("ts"), temporal.plus_days("ts", 7).alias("one_week_later"),
                         temporal.plus_months("ts", 1).alias("one_month_later"),
                         temporal.whole_days_between(start, "ts").alias("days_since_start"))


@register("time_zones", "H20 H21", """
SELECT event_id, epoch_us(ts) AS utc_micros, timezone('America/New_York', timezone('UTC', ts)) AS new_york FROM events""")
def time_zones(t):
    return t("events").select("event_id", F.unix_micros(temporal.as_utc("ts")).alias("utc_micros"),
                              temporal.wall_clock("ts", "America/New_York").alias("new_york"))


@register("day_month_texts", "H22 H23", """
SELECT o_orderkey, strftime(o_orderdate, '%d-%m') AS day_month,
       CASE WHEN strftime(o_orderdate, '%d-%m') <> '29-02' THEN make_date(1900, month(o_orderdate)::INTEGER, day(o_orderdate)::INTEGER) END AS plot_date FROM orders""")
def day_months(t):
    text = temporal.day_month("o_orderdate")
    return t("orders").select("o_orderkey", text.alias("day_month"), temporal.on_common_year(text).alias("plot_date"))


@register("strings_lists_and_maps", "H24 H25 H26 H27 H28 H29", """
WITH e AS (SELECT event_id, event_type, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, string_split(event_type, '') AS letters FROM events)
SELECT event_id, length(event_type) AS length, 'this is ' || event_type AS sentence, letters[1] AS first_letter,
       coalesce(list_position(letters, 'c'), 0) - 1 AS position_of_c, list_contains(letters, 'e') AS has_e, k AS looked_up, false AS has_other,
       (SELECT coalesce(sum((x * x)::BIGINT), 0) FROM (SELECT unnest([k, k + 1, k + 2]) AS x) WHERE x % 2 = 0)::BIGINT AS squares_of_even,
       (SELECT sum(i * x) FROM (SELECT unnest([0, 1, 2]) AS i, unnest([k, k + 1, k + 2]) AS x))::BIGINT AS weighted_by_index
FROM e""")
def strings_lists_maps(t):
    e = t("events").select("event_id", "event_type", F.from_json("props", "map<string,bigint>").alias("m"), F.split("event_type", "").alias("letters"))
    k = F.try_element_at("m", F.lit("k"))
    numbers = F.array(k, k + 1, k + 2)
    squares = F.transform(F.filter(numbers, lambda x: x % 2 == 0), lambda x: x * x)
    indexed = e.withColumn("pair", F.struct(k.alias("first"), F.size(F.map_keys("m")).alias("second"))).select(
        "*", F.transform(numbers, lambda x, i: i * x).alias("products"))
    zero = F.lit(0).cast("bigint")
    return indexed.select(
        "event_id", F.length("event_type").alias("length"), F.format_string("this is %s", "event_type").alias("sentence"),
        F.element_at("letters", 1).alias("first_letter"), (F.array_position("letters", F.lit("c")) - 1).alias("position_of_c"),
        F.array_contains("letters", "e").alias("has_e"), F.col("pair.first").alias("looked_up"),
        F.map_contains_key("m", F.lit("other")).alias("has_other"),
        F.aggregate(squares, zero, lambda a, x: a + x).alias("squares_of_even"),
        F.aggregate("products", zero, lambda a, x: a + x).alias("weighted_by_index"))


@register("list_positions", "H25 H29", """
SELECT vec_id, pos - 1 AS pos, round(embedding[pos]::DOUBLE, 6) AS x FROM embeddings, (SELECT unnest(generate_series(1, 64)) AS pos)""")
def list_positions(t):
    return t("embeddings").select("vec_id", F.posexplode("embedding").alias("pos", "x")).select(
        "vec_id", F.col("pos").cast("bigint").alias("pos"), rounded(F.col("x").cast("double"), name="x"))
