"""Validation and observability."""

from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from millrace.operators import relational as rel, rows
from millrace.operators.observation import DRIFT_LIMIT, ObservedPipeline
from millrace.operators.validation import Suite, ValidationError
from millrace.plans.catalog import REGISTRY, register, rounded
from millrace.plans.storage import folder


def _dirty_orders(t):
    k = F.col("o_orderkey")
    return t("orders").select(
        "o_orderkey", F.when(k % 13 != 0, F.col("o_custkey")).alias("o_custkey"),
        F.when(k % 17 == 0, -F.col("o_totalprice")).when(k % 19 != 0, F.col("o_totalprice")).alias("price"),
        F.when(k % 23 == 0, "INVALID").when(k % 29 != 0, F.col("o_orderstatus")).alias("status"),
        F.when(k % 31 == 0, "n/a").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("day"),
        F.when(k % 37 != 0, F.col("o_orderpriority")).alias("priority"))


_DIRTY = """
WITH o AS (SELECT o_orderkey, CASE WHEN o_orderkey % 13 <> 0 THEN o_custkey END AS o_custkey,
  CASE WHEN o_orderkey % 17 = 0 THEN -o_totalprice WHEN o_orderkey % 19 <> 0 THEN o_totalprice END AS price,
  CASE WHEN o_orderkey % 23 = 0 THEN 'INVALID' WHEN o_orderkey % 29 <> 0 THEN o_orderstatus END AS status,
  CASE WHEN o_orderkey % 31 = 0 THEN 'n/a' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS day,
  CASE WHEN o_orderkey % 37 <> 0 THEN o_orderpriority END AS priority FROM orders),
f AS (SELECT *, NOT coalesce(price BETWEEN 0 AND 400000, false) AS bad_range, coalesce(price <= 0, false) AS bad_positive, o_custkey IS NULL AS bad_null,
  NOT coalesce(status IN ('O', 'F', 'P'), false) AS bad_allowed,
  NOT coalesce(day <> 'n/a' AND day BETWEEN '1996-01-01' AND '2000-12-31', false) AS bad_date,
  NOT coalesce(regexp_matches(priority, '^(?:[1-4]-)'), false) AS bad_regex,
  (o_custkey IS NULL OR o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)) AS bad_fk FROM o)
"""


def suite(t) -> Suite:
    return (Suite().not_empty().columns_exist(["o_orderkey", "price"]).dtype("o_orderkey", "bigint")
            .in_range("price", 0, 400000).positive("price").no_nulls("o_custkey").allowed("status", ["O", "F", "P"])
            .date_range("day", "1996-01-01", "2000-12-31").regex("priority", r"[1-4]-", "urgency digit")
            .null_percentage("price", 10.0).unique("o_custkey")
            .foreign_key("o_custkey", t("customer").where("c_acctbal > 0"), "c_custkey"))


@register("validation_counts", "J1 J4 J5 J6 J7 J8 J9 J10 J11 J12 J14", _DIRTY + """
, c AS (SELECT 'not_empty' AS "check", '' AS "column", CASE WHEN count(*) = 0 THEN 1 ELSE 0 END::BIGINT AS invalid_count, count(*) > 0 AS passed FROM f
UNION ALL SELECT 'range', 'price', count(*) FILTER (WHERE bad_range), count(*) FILTER (WHERE bad_range) = 0 FROM f
UNION ALL SELECT 'positive', 'price', count(*) FILTER (WHERE bad_positive), count(*) FILTER (WHERE bad_positive) = 0 FROM f
UNION ALL SELECT 'no_nulls', 'o_custkey', count(*) FILTER (WHERE bad_null), count(*) FILTER (WHERE bad_null) = 0 FROM f
UNION ALL SELECT 'allowed', 'status', count(*) FILTER (WHERE bad_allowed), count(*) FILTER (WHERE bad_allowed) = 0 FROM f
UNION ALL SELECT 'date_range', 'day', count(*) FILTER (WHERE bad_date), count(*) FILTER (WHERE bad_date) = 0 FROM f
UNION ALL SELECT 'regex', 'priority', count(*) FILTER (WHERE bad_regex), count(*) FILTER (WHERE bad_regex) = 0 FROM f
UNION ALL SELECT 'null_percentage', 'price', count(*) FILTER (WHERE price IS NULL), count(*) FILTER (WHERE price IS NULL) * 100.0 / count(*) <= 10 FROM f
UNION ALL SELECT 'unique', 'o_custkey', count(*) - count(DISTINCT coalesce(o_custkey, -1)), count(*) = count(DISTINCT coalesce(o_custkey, -1)) FROM f
UNION ALL SELECT 'foreign_key', 'o_custkey', count(*) FILTER (WHERE bad_fk), count(*) FILTER (WHERE bad_fk) = 0 FROM f)
SELECT * FROM c""")
def validation_counts(t):
    return suite(t).counts(_dirty_orders(t))


def _sql_top(check, column, flag, value):
    return f"""SELECT '{check}' AS "check", '{column}' AS "column", string_agg(v, '; ' ORDER BY o_orderkey) AS examples
FROM (SELECT o_orderkey, coalesce(CAST({value} AS VARCHAR), 'NULL') AS v FROM f WHERE {flag} ORDER BY o_orderkey LIMIT 3)"""


@register("validation_examples", "F4 F5 J4 J5 J9 J11 J12", _DIRTY + " UNION ALL ".join([
    _sql_top("no_nulls", "o_custkey", "bad_null", "o_custkey"),
    _sql_top("date_range", "day", "bad_date", "day"),
    _sql_top("regex", "priority", "bad_regex", "priority"),
    """SELECT 'allowed', 'status', string_agg(v, '; ' ORDER BY k) FROM (SELECT coalesce(status, 'NULL') AS v, min(o_orderkey) AS k FROM f WHERE bad_allowed GROUP BY 1 ORDER BY 2 LIMIT 3)""",
    """SELECT 'foreign_key', 'o_custkey', string_agg(v, '; ' ORDER BY v) FROM (SELECT DISTINCT coalesce(CAST(o_custkey AS VARCHAR), 'NULL') AS v FROM f WHERE bad_fk ORDER BY 1 LIMIT 3)""",
]))
def validation_examples(t):
    shown = suite(t).examples(_dirty_orders(t), "o_orderkey").where(~F.col("check").isin("range", "positive"))
    return shown.select("check", "column", F.concat_ws("; ", "examples").alias("examples"))


@register("validation_failure", "J2 J3 J13 J14", REGISTRY["validation_counts"].sql.replace(
    "SELECT * FROM c", "SELECT false AS is_valid, 2 + count(*) FILTER (WHERE NOT passed) AS error_count FROM c"))
def validation_failure(t):
    """All failed checks in one exception: a column that is absent, one of another type, and the data checks."""
    rules = suite(t).columns_exist(["o_orderkey", "o_absent"]).dtype("o_orderkey", "string")
    try:
        _dirty_orders(t).transform(rules.step("o_orderkey"))
    except ValidationError as failed:
        report = failed.report()
        return t.spark.createDataFrame([(report["is_valid"], report["error_count"])], "is_valid boolean, error_count bigint")
    raise AssertionError("the checks should have failed")


@register("validated_pipeline", "J2 J3 J13 J15", """
SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 1000""")
def validated_pipeline(t):
    rules = (Suite().not_empty().columns_exist(["o_orderkey", "o_totalprice"]).dtype("o_totalprice", "double")
             .no_nulls("o_orderkey").unique("o_orderkey").positive("o_totalprice"))
    return (t("orders").select("o_orderkey", "o_totalprice").transform(rules.step())
            .transform(rows.where("o_totalprice > 1000")).transform(rules.step()))


def observed_steps(t):
    """The steps of the observed pipeline over orders: join, type change, category explosion, drop, de-duplicate."""
    customers = t("customer").select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment", "c_acctbal")

    def merge_customers(df):
        return df.transform(rel.left_join(customers, "o_custkey"))

    def key_to_text(df):
        return df.withColumn("o_custkey", F.col("o_custkey").cast("string"))

    def explode_categories(df):
        return df.withColumn("priority", F.concat_ws("_", F.col("priority").cast("string"), "c_mktsegment", F.col("o_orderkey").cast("string")))

    def drop_missing_rows(df):
        return df.transform(rows.drop_missing(["o_orderstatus", "c_mktsegment"]))

    def remove_duplicates(df):
        return df.transform(rel.keep_first(["o_custkey"], ["o_orderkey"]))

    return [merge_customers, key_to_text, explode_categories, drop_missing_rows, remove_duplicates]


def observed_run(t):
    source = t("orders").select(
        "o_orderkey", "o_custkey", "o_totalprice", F.substring("o_orderpriority", 1, 1).cast("int").alias("priority"),
        F.when(F.col("o_orderkey") % 5 != 0, F.col("o_orderstatus")).alias("o_orderstatus"))
    pipeline = ObservedPipeline(observed_steps(t))
    pipeline.run(source)
    return pipeline


@register("observed_step_summary", "K1 K2 K7 K8 I6", """
WITH o AS (SELECT * FROM orders LEFT JOIN customer ON c_custkey = o_custkey)
SELECT 'merge_customers' AS step, (SELECT count(*) FROM o) - (SELECT count(*) FROM orders) AS delta_rows, 2 AS cols_added_removed
UNION ALL SELECT 'key_to_text', 0, 0 UNION ALL SELECT 'explode_categories', 0, 0
UNION ALL SELECT 'drop_missing_rows', -(SELECT count(*) FROM o WHERE o_orderkey % 5 = 0 OR c_mktsegment IS NULL), 0
UNION ALL SELECT 'remove_duplicates', -(SELECT count(*) - count(DISTINCT o_custkey) FROM o WHERE o_orderkey % 5 <> 0 AND c_mktsegment IS NOT NULL), 0""")
def observed_summary(t):
    return observed_run(t).summary(t.spark).drop("plan_seconds")


@register("observed_step_warnings", "K3 K4 K5 H6 H7", """
SELECT 'key_to_text' AS step, 'dtype_change' AS kind, 'o_custkey' AS "column", 'bigint' AS "before", 'string' AS "after"
UNION ALL SELECT 'explode_categories', 'dtype_change', 'priority', 'int', 'string'""")
def observed_warnings(t):
    return observed_run(t).warning_table(t.spark).where("kind = 'dtype_change'").drop("relative_change")


def _lines(t):
    """Steps that move a column's smallest value and mean, and that multiply the kinds of another."""
    def keep_large(df):
        return df.where("quantity > 30")

    def name_kinds(df):
        return df.withColumn("kind", F.concat_ws("-", "kind", "number"))

    lines = t("lineitem").select(F.col("l_quantity").cast("double").alias("quantity"), F.col("l_returnflag").alias("kind"),
                                 F.col("l_linenumber").cast("string").alias("number"))
    return lines, keep_large, name_kinds


@register("observed_drift_read_back", "K4 K5 K8", f"""
WITH b AS (SELECT min(l_quantity)::DOUBLE AS lo, avg(l_quantity)::DOUBLE AS m FROM lineitem),
a AS (SELECT min(l_quantity)::DOUBLE AS lo, avg(l_quantity)::DOUBLE AS m FROM lineitem WHERE l_quantity > 30),
k AS (SELECT count(DISTINCT l_returnflag) AS flags, count(DISTINCT l_returnflag || '-' || l_linenumber) AS kinds FROM lineitem WHERE l_quantity > 30)
SELECT * FROM (
  SELECT 'keep_large' AS step, 'numeric_drift' AS kind, 'quantity_min' AS "column", round((a.lo - b.lo) / b.lo, 3) AS change FROM a, b
  UNION ALL SELECT 'keep_large', 'numeric_drift', 'quantity_mean', round((a.m - b.m) / b.m, 3) FROM a, b
  UNION ALL SELECT 'name_kinds', 'cardinality_change', 'kind', round((kinds - flags)::DOUBLE / flags, 3) FROM k)
WHERE change > CASE WHEN kind = 'numeric_drift' THEN {DRIFT_LIMIT} ELSE 1 END""")
def observed_drift(t):
    lines, *steps = _lines(t)
    pipeline = ObservedPipeline(steps)
    pipeline.run(lines)
    path = folder(t, "observed")
    pipeline.save(t.spark, path)
    saved = t.spark.read.parquet(f"{path}/warnings")
    return saved.select("step", "kind", "column", rounded("relative_change", 3, "change"))


@register("observed_failure", "K6", "SELECT 'name_kinds' AS step, count(*) > 0 AS stopped FROM lineitem")
def observed_failure(t):
    """The second of two steps fails: the error is kept with the name of its step, and raised."""
    lines, _, name_kinds = _lines(t)

    def drop_kind(df):
        return df.drop("kind")

    pipeline = ObservedPipeline([drop_kind, name_kinds])
    try:
        pipeline.run(lines)
    except AnalysisException:
        pass
    found = [(e.split()[1], e.startswith("step name_kinds stopped")) for e in pipeline.errors]
    return t.spark.createDataFrame(found, "step string, stopped boolean")
