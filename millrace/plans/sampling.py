"""Neighbour joins, resampling and splits."""

from pyspark.sql import functions as F

from millrace.ml import resample, split
from millrace.operators.neighbours import knn_join
from millrace.plans.catalog import register, rounded, sql_hash

DIMS = [f"x{i}" for i in range(64)]


def points(t):
    """The embedding's dimensions as columns."""
    return t("embeddings").select(F.col("vec_id").alias("id"), "label", *[
        F.col("embedding")[i].cast("double").alias(c) for i, c in enumerate(DIMS)], (F.col("vec_id") % 4).cast("string").alias("kind"))


# All dimensions, as a list; `_columns` turns a list into the columns of `points`.
_POINTS = """
WITH e AS (SELECT vec_id AS id, label, embedding::DOUBLE[] AS v, (vec_id % 4)::VARCHAR AS kind FROM embeddings),
pairs AS (SELECT a.id AS a, b.id AS b, a.label AS la, b.label AS lb, list_distance(a.v, b.v) AS dist FROM e a JOIN e b ON a.id <> b.id)
"""


def _columns(of: str) -> str:
    return ", ".join(f"round({of}[{i + 1}], 8) AS {c}" for i, c in enumerate(DIMS))


@register("five_nearest_embeddings", "C6", """
WITH e AS (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings),
d AS (SELECT a.vec_id AS query_id, b.vec_id AS donor_id, list_distance(a.v, b.v) AS dist FROM e a JOIN e b ON a.vec_id <> b.vec_id)
SELECT query_id, donor_id, round(dist, 8) AS distance, row_number() OVER (PARTITION BY query_id ORDER BY dist, donor_id)::INTEGER AS rank FROM d QUALIFY rank <= 5""")
def five_nearest(t):
    rows = t("embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("vec"), F.lit("all").alias("grp"))
    return knn_join(rows, rows, 5, exclude_self=True).select("query_id", "donor_id", rounded("distance", 8), "rank")


@register("five_nearest_embeddings_in_cells", "C6", """
WITH e AS (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings),
d AS (SELECT a.vec_id AS query_id, b.vec_id AS donor_id, list_distance(a.v, b.v) AS dist FROM e a JOIN e b ON a.vec_id <> b.vec_id)
SELECT query_id, donor_id, round(dist, 8) AS distance, row_number() OVER (PARTITION BY query_id ORDER BY dist, donor_id)::INTEGER AS rank FROM d QUALIFY rank <= 5""")
def five_nearest_in_cells(t):
    """The join of tables too large to ship, on the same rows."""
    rows = t("embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("vec"), F.lit("all").alias("grp"))
    found = knn_join(rows, rows, 5, exclude_self=True, shipped_numbers=0, block_rows=500, cell_rows=100)
    return found.select("query_id", "donor_id", rounded("distance", 8), "rank")


@register("approximate_neighbour_recall", "C6")
def approximate_recall(t):
    """How many of its five nearest rows the hashed join finds for each row; SQL has no such hashing."""
    from millrace.operators.approximate import approximate_knn_join, recall

    rows = t("embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("vec"), F.lit("all").alias("grp"))
    return recall(approximate_knn_join(rows, rows, 5, exclude_self=True), knn_join(rows, rows, 5, exclude_self=True))


@register("five_nearest_with_missing", "C6", """
WITH e AS (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings WHERE vec_id % 7 <> 3),
d AS (SELECT a.vec_id AS query_id, b.vec_id AS donor_id, list_distance(a.v, b.v) AS dist FROM e a JOIN e b ON a.vec_id <> b.vec_id)
SELECT query_id, donor_id, round(dist, 8) AS distance, row_number() OVER (PARTITION BY query_id ORDER BY dist, donor_id)::INTEGER AS rank FROM d QUALIFY rank <= 5""")
def five_nearest_with_missing(t):
    """One vector in seven has a missing part: NaN, NULL, or no vector at all."""
    whole = F.col("embedding").cast("array<double>")
    part = F.element_at(F.array(F.lit(float("nan")), F.lit(None).cast("double")), (F.col("vec_id") % 2 + 1).cast("int"))
    broken = F.when(F.col("vec_id") % 3 > 0, F.concat(F.slice(whole, 1, 9), F.array(part), F.slice(whole, 11, 1000)))
    vec = F.when(F.col("vec_id") % 7 == 3, broken).otherwise(whole)
    rows = t("embeddings").select(F.col("vec_id").alias("id"), vec.alias("vec"), F.lit("all").alias("grp"))
    return knn_join(rows, rows, 5, exclude_self=True).select("query_id", "donor_id", rounded("distance", 8), "rank")


@register("nearest_of_same_label_blocked", "C6", _POINTS + """
SELECT a AS query_id, b AS donor_id, row_number() OVER (PARTITION BY a ORDER BY dist, b)::INTEGER AS rank FROM pairs WHERE la = lb QUALIFY rank <= 3""")
def nearest_blocked(t):
    from millrace.operators.neighbours import vectors

    rows = vectors(points(t), "id", DIMS, "label")
    found = knn_join(rows, rows, 3, exclude_self=True, shipped_numbers=0, block_rows=200, cell_rows=100)
    return found.select("query_id", "donor_id", "rank")


_SIZES = f"""
sizes AS (SELECT label, count(*) AS n FROM e GROUP BY label),
r AS (SELECT e.*, n, (SELECT max(n) FROM sizes) - n AS want, {sql_hash('id')} AS h, row_number() OVER (PARTITION BY e.label ORDER BY {sql_hash('id')}, id) AS rk FROM e JOIN sizes USING (label)),
q AS (SELECT *, want // n + CASE WHEN rk <= want % n THEN 1 ELSE 0 END AS extra FROM r),
p AS (SELECT *, sum(extra) OVER (ORDER BY h, id) AS upto FROM q),
nn AS (SELECT a, b, row_number() OVER (PARTITION BY a ORDER BY dist, b) AS rank FROM pairs WHERE la = lb QUALIFY rank <= 5),
cnt AS (SELECT a, count(*) AS k FROM nn GROUP BY a),
g AS (SELECT p.*, k, unnest(generate_series(0, extra - 1)) AS copy FROM p JOIN cnt ON cnt.a = p.id WHERE extra > 0),
g2 AS (SELECT *, {sql_hash("id, '_', copy", '42:neighbour')} % k + 1 AS pick, {sql_hash("id, '_', copy", '42:category:kind')} % k + 1 AS kpick,
  {sql_hash("id, '_', copy", '42:step')} / 4503599627370496.0::DOUBLE AS u FROM g),
made AS (SELECT (copy - upto)::BIGINT AS id, g2.label, [{", ".join(f"g2.v[{i + 1}] + u * (d.v[{i + 1}] - g2.v[{i + 1}])" for i in range(len(DIMS)))}] AS v,
  g2.id AS base, c.kind FROM g2 JOIN nn ON nn.a = g2.id AND nn.rank = pick JOIN e d ON d.id = nn.b
  JOIN nn n2 ON n2.a = g2.id AND n2.rank = kpick JOIN e c ON c.id = n2.b)
"""
_SMOTE = _POINTS + "," + _SIZES


@register("smote_rows", "N1 C6", _SMOTE + f"""
SELECT id, label, {_columns('v')}, base, true AS is_synthetic FROM made UNION ALL SELECT id, label, {_columns('v')}, id, false FROM e""")
def smote_rows(t):
    done = resample.smote(points(t), "id", "label", DIMS, 5)
    return done.select("id", "label", *[rounded(c, 8) for c in DIMS], "base", "is_synthetic")


@register("smote_rows_with_category", "N2", _SMOTE + f"""
SELECT id, label, {_columns('v')}, kind, true AS is_synthetic FROM made UNION ALL SELECT id, label, {_columns('v')}, kind, false FROM e""")
def smote_nc(t):
    done = resample.smote(points(t), "id", "label", DIMS, 5, categorical=["kind"])
    return done.select("id", "label", *[rounded(c, 8) for c in DIMS], "kind", "is_synthetic")


@register("random_over_sampled", "N3", f"""
WITH s AS (SELECT quality, count(*) AS n FROM labels GROUP BY quality),
r AS (SELECT doc_id, quality, n, (SELECT max(n) FROM s) - n AS want, row_number() OVER (PARTITION BY quality ORDER BY {sql_hash('doc_id')}, doc_id) AS rk FROM labels JOIN s USING (quality))
SELECT doc_id, quality, unnest(generate_series(0, want // n + CASE WHEN rk <= want % n THEN 1 ELSE 0 END)) AS copy FROM r""")
def over_sampled(t):
    return resample.random_over_sample(t("labels").select("doc_id", "quality"), "doc_id", "quality")


@register("random_under_sampled", "N4", f"""
SELECT doc_id, quality, toxic FROM labels
QUALIFY row_number() OVER (PARTITION BY quality ORDER BY {sql_hash('doc_id')}, doc_id) <= (SELECT min(n) FROM (SELECT count(*) AS n FROM labels GROUP BY quality))""")
def under_sampled(t):
    return resample.random_under_sample(t("labels"), "doc_id", "quality")


_LINKS = """, near AS (SELECT a, b, la, lb FROM pairs QUALIFY row_number() OVER (PARTITION BY a ORDER BY dist, b) = 1),
links AS (SELECT x.a, x.la, x.lb FROM near x JOIN near y ON x.a = y.b AND x.b = y.a WHERE x.la <> x.lb),
size AS (SELECT label, count(*) AS n FROM e GROUP BY label)
"""


@register("tomek_links_cleaned", "N5", _POINTS + _LINKS + """
SELECT id, label FROM e WHERE id NOT IN (SELECT a FROM links JOIN size s ON s.label = la JOIN size o ON o.label = lb WHERE s.n > o.n OR (s.n = o.n AND la > lb))""")
def tomek_cleaned(t):
    return resample.drop_tomek_links(points(t), "id", "label", DIMS).select("id", "label")


@register("edited_neighbours", "N6", _POINTS + """
, near AS (SELECT a, la, lb FROM pairs QUALIFY row_number() OVER (PARTITION BY a ORDER BY dist, b) <= 3)
SELECT id, label FROM e WHERE id NOT IN (SELECT a FROM near GROUP BY a HAVING count(*) FILTER (WHERE la <> lb) * 2 > count(*))""")
def edited(t):
    return resample.edited_neighbours(points(t), "id", "label", DIMS).select("id", "label")


_GROWN = _SMOTE + """, allrows AS (SELECT id, label, v FROM e UNION ALL SELECT id, label, v FROM made),
ap AS (SELECT a.id AS a, b.id AS b, a.label AS la, b.label AS lb, list_distance(a.v, b.v) AS dist FROM allrows a JOIN allrows b ON a.id <> b.id)
"""


@register("smote_then_tomek", "N5", _GROWN + """
, near AS (SELECT a, b, la, lb FROM ap QUALIFY row_number() OVER (PARTITION BY a ORDER BY dist, b) = 1),
links AS (SELECT x.a, x.la, x.lb FROM near x JOIN near y ON x.a = y.b AND x.b = y.a WHERE x.la <> x.lb)
SELECT id, label FROM allrows WHERE id NOT IN (SELECT a FROM links JOIN sizes s ON s.label = la JOIN sizes o ON o.label = lb WHERE s.n > o.n OR (s.n = o.n AND la > lb))""")
def smote_tomek(t):
    return resample.smote_tomek(points(t), "id", "label", DIMS).select("id", "label")


@register("smote_then_edited", "N6", _GROWN + """
, near AS (SELECT a, la, lb FROM ap QUALIFY row_number() OVER (PARTITION BY a ORDER BY dist, b) <= 3)
SELECT id, label FROM allrows WHERE id NOT IN (SELECT a FROM near GROUP BY a HAVING count(*) FILTER (WHERE la <> lb) * 2 > count(*))""")
def smote_enn(t):
    return resample.smote_enn(points(t), "id", "label", DIMS).select("id", "label")


@register("random_split", "O1", f"""
SELECT o_orderkey, row_number() OVER (ORDER BY {sql_hash('o_orderkey')}, o_orderkey) <= ceil(0.3::DOUBLE * (SELECT count(*) FROM orders)) AS is_test FROM orders""")
def random_split(t):
    return split.train_test_split(t("orders").select("o_orderkey"), "o_orderkey", 0.3)


@register("stratified_split", "O2", f"""
SELECT o_orderkey, o_orderstatus, row_number() OVER (PARTITION BY o_orderstatus ORDER BY {sql_hash('o_orderkey')}, o_orderkey)
  <= ceil(0.2::DOUBLE * count(*) OVER (PARTITION BY o_orderstatus)) AS is_test FROM orders""")
def stratified_split(t):
    return split.train_test_split(t("orders").select("o_orderkey", "o_orderstatus"), "o_orderkey", 0.2, stratify="o_orderstatus")


_CLASS = "nullif(o_orderstatus, 'P')"


@register("stratified_split_with_missing_class", "O2 O4", f"""
WITH o AS (SELECT o_orderkey, {_CLASS} AS class, {sql_hash('o_orderkey')} AS h FROM orders)
SELECT o_orderkey, class, row_number() OVER w <= ceil(0.2::DOUBLE * count(*) OVER (PARTITION BY class)) AS is_test,
  ((row_number() OVER w - 1) % 5)::INTEGER AS fold FROM o WINDOW w AS (PARTITION BY class ORDER BY h, o_orderkey)""")
def stratified_split_with_missing_class(t):
    rows = t("orders").select("o_orderkey", F.expr(_CLASS).alias("class"))
    marked = split.train_test_split(rows, "o_orderkey", 0.2, stratify="class")
    return split.kfold(marked, "o_orderkey", 5, stratify="class")


@register("over_sampled_with_missing_class", "N3", f"""
WITH o AS (SELECT o_orderkey, {_CLASS} AS class, {sql_hash('o_orderkey')} AS h FROM orders),
s AS (SELECT *, count(*) OVER (PARTITION BY class) AS n, row_number() OVER (PARTITION BY class ORDER BY h, o_orderkey) AS rk FROM o),
w AS (SELECT *, (SELECT max(n) FROM s) - n AS want FROM s)
SELECT o_orderkey, class, unnest(generate_series(0, want // n + CASE WHEN rk <= want % n THEN 1 ELSE 0 END))::BIGINT AS copy FROM w""")
def over_sampled_with_missing_class(t):
    return resample.random_over_sample(t("orders").select("o_orderkey", F.expr(_CLASS).alias("class")), "o_orderkey", "class")


@register("shuffled_folds", "O3", f"""
SELECT o_orderkey, ((row_number() OVER (ORDER BY {sql_hash('o_orderkey')}, o_orderkey) - 1) % 5)::INTEGER AS fold FROM orders""")
def shuffled_folds(t):
    return split.kfold(t("orders").select("o_orderkey"), "o_orderkey", 5)


@register("stratified_folds", "O4", f"""
SELECT o_orderkey, o_orderstatus, ((row_number() OVER (PARTITION BY o_orderstatus ORDER BY {sql_hash('o_orderkey')}, o_orderkey) - 1) % 5)::INTEGER AS fold FROM orders""")
def stratified_folds(t):
    return split.kfold(t("orders").select("o_orderkey", "o_orderstatus"), "o_orderkey", 5, stratify="o_orderstatus")


@register("group_folds_by_hash", "O5", f"SELECT o_orderkey, o_custkey, ({sql_hash('o_custkey')} % 5)::INTEGER AS fold FROM orders")
def group_folds_by_hash(t):
    return split.group_kfold_by_hash(t("orders").select("o_orderkey", "o_custkey"), "o_custkey", 5)


@register("group_folds_by_size", "O5", f"""
WITH RECURSIVE sizes AS (SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey),
turn AS (SELECT *, row_number() OVER (ORDER BY n DESC, {sql_hash('o_custkey')}, o_custkey) AS i FROM sizes),
dealt(i, o_custkey, fold, loads) AS (
  SELECT 0::BIGINT, NULL::BIGINT, NULL::INTEGER, [0, 0, 0, 0, 0]::BIGINT[]
  UNION ALL
  SELECT t.i, t.o_custkey, (list_position(d.loads, list_min(d.loads)) - 1)::INTEGER,
    list_transform(d.loads, lambda x, k: x + CASE WHEN k = list_position(d.loads, list_min(d.loads)) THEN t.n ELSE 0 END)
  FROM dealt d JOIN turn t ON t.i = d.i + 1)
SELECT o_orderkey, o_custkey, fold FROM orders JOIN dealt USING (o_custkey)""")
def group_folds_by_size(t):
    return split.group_kfold(t("orders").select("o_orderkey", "o_custkey"), "o_custkey", 5)
