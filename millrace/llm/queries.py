"""The registered query of each operator over whole tables, and its SQL where SQL can say the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.llm import (
    bpe, common, exact_dedup, mix, near_dedup, packing, prefix_trie, quality, runs, secrets, sketch, substring_dedup, token_count, toxicity)
from millrace.operators.joins import join_small
from millrace.session import materialise


def _documents(spark: SparkSession, folder: str) -> DataFrame:
    return common.table(spark, folder, "documents")


def _labels(spark: SparkSession, folder: str) -> DataFrame:
    return common.table(spark, folder, "labels")


def op1_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    found = toxicity.tagged(_documents(spark, folder), _labels(spark, folder))
    return found.select(
        "doc_id", common.held_out().alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"),
        F.transform("spans", lambda s: F.array(s["start"], s["end"])).alias("offsets"))


def op2_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return substring_dedup.deduplicated(_documents(spark, folder)).select(
        "doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


def op3_bpe(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return bpe.encoded(_documents(spark, folder), ranks, public_tokenizers.PATTERN, with_ids=False)


def op9_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    pieces = token_count.read_pieces(public_tokenizers.path("piece_bpe_32k.model"))
    return token_count.counted(_documents(spark, folder), pieces)


def op4_secrets(spark: SparkSession, folder: str) -> DataFrame:
    found = secrets.scanned(_documents(spark, folder))

    def of(kind: int):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{secrets.KINDS[kind]}")

    counts = [of(kind) for kind in range(3)]
    return found.select("doc_id", *counts, F.sha2(secrets.written(F.col("base")).cast("binary"), 256).alias("base_sha256"),
                        secrets.written(F.concat("base", "added")).alias("spans"))


def op5_quality(spark: SparkSession, folder: str) -> DataFrame:
    found = quality.scored(_documents(spark, folder), _labels(spark, folder))
    return found.select("doc_id", common.held_out().alias("held_out"), "score",
                        (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op8_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return sketch.fingerprints(_documents(spark, folder))


def op6_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_dedup.classes(_documents(spark, folder), near_dedup.Shape(width=4, percent=80))


def op7_mix(spark: SparkSession, folder: str) -> DataFrame:
    docs = _documents(spark, folder).select("doc_id", "source", "text")
    size = mix.words_in("row.text")
    return mix.mixed(docs).select(
        "row.doc_id", size.alias("size"), "source_size", "target", (F.col("copies") * size).cast("bigint").alias("taken"))


OP7_SQL = f"""
WITH sized AS (
    SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size FROM documents),
sources AS (
    SELECT source, sum(size)::BIGINT AS source_size, [5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS w
    FROM sized GROUP BY source),
filled AS (
    SELECT *, coalesce(sum(source_size) OVER o, 0) AS before, coalesce(sum(w) OVER o, 0) AS w_before, sum(source_size) OVER () AS total,
           sum(w) OVER () AS w_total
    FROM sources WINDOW o AS (ORDER BY source_size::DOUBLE / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
level AS (
    SELECT spare, open FROM (
        SELECT (3 * total - 4 * before)::BIGINT AS spare, (w_total - w_before)::BIGINT AS open, source_size, w, before FROM filled)
    WHERE spare * w < 4 * source_size * open ORDER BY before LIMIT 1),
targets AS (
    SELECT s.source, source_size,
           round(least(coalesce((spare * w)::DOUBLE / (2.0 * open)::DOUBLE, 2.0 * source_size), 2.0 * source_size)::DOUBLE, 6) AS target
    FROM sources s LEFT JOIN level ON true)
SELECT doc_id, size, source_size, target,
       (size * CASE WHEN source_size = 0 THEN 1 ELSE floor(target / source_size)
           + ({common.key_fraction_sql('doc_id', mix.SALT)} < target / source_size - floor(target / source_size))::INT END)::BIGINT AS taken
FROM sized JOIN targets ON sized.source IS NOT DISTINCT FROM targets.source
"""


def op10_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.decisions(_documents(spark, folder))


OP10_SQL = """
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id IS NOT DISTINCT FROM max(doc_id) OVER g AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))
"""


def op11_packing(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    found = packing.packed(_documents(spark, folder), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)
    return found.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def _rebuilt(turns: DataFrame, ids: DataFrame) -> DataFrame:
    """Conversations as the contract of op12 rebuilds them: the first turns of their hundred's first one, then their own later ones."""
    turn = F.struct("place", "t1", "t2", "chars")
    bases = turns.where("conv_id % 100 = 0 AND place < 5").groupBy(F.col("conv_id").alias("base")).agg(
        F.array_sort(F.collect_list(turn)).alias("opening"))
    cut = ids.withColumn("base", F.expr("conv_id - conv_id % 100")).withColumn("h", _taken()).join(bases, "base", "left").select(
        "conv_id", F.expr("slice(coalesce(opening, array()), 1, h)").alias("opening"), "h")
    cut = materialise(cut, "op12-cut")
    # Only conversations whose base has fewer turns than they take move theirs forward.
    moved = cut.where("size(opening) < h").select("conv_id", (F.col("h") - F.size("opening")).alias("by"))
    own = join_small(turns.where(F.col("place") >= _taken()), moved, ["conv_id"]).withColumn(
        "place", F.col("place") - F.coalesce("by", F.lit(0)))
    return cut.select("conv_id", F.explode("opening").alias("t")).select("conv_id", "t.*").unionByName(own.drop("by"))


def _taken():
    return (F.crc32(F.col("conv_id").cast("string").cast("binary")) % 6).cast("int")


def op12_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    turns = materialise(prefix_trie.numbered(common.table(spark, folder, "conversations")), "op12-turns")
    ids = turns.select("conv_id").distinct()
    return prefix_trie.trie(_rebuilt(turns, ids), ids)


# crc32 of a decimal number, byte by byte over a table of 256 values that eight steps a byte give.
OP12_SQL = """
WITH RECURSIVE steps(b, k, c) AS (
    SELECT range, 0, range FROM range(256)
    UNION ALL SELECT b, k + 1, CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM steps WHERE k < 8),
crc_table AS (SELECT list(c ORDER BY b) AS t FROM steps WHERE k = 8),
original AS (
    SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) - 1 AS place
    FROM conversations WHERE conv_id IS NOT NULL),
convs AS (
    SELECT conv_id, conv_id - conv_id % 100 AS base,
           xor(list_reduce(list_prepend(4294967295::BIGINT, [ascii(x)::BIGINT for x in string_split(conv_id::VARCHAR, '')]),
                           lambda c, x: xor(c >> 8, t[xor(c, x) % 256 + 1])), 4294967295) % 6 AS h
    FROM (SELECT DISTINCT conv_id FROM original), crc_table),
lengths AS (SELECT conv_id AS base, count(*) AS n FROM original GROUP BY conv_id),
turns AS (
    SELECT c.conv_id, o.place, o.role, o.text FROM convs c JOIN original o ON o.conv_id = c.base AND o.place < c.h
    UNION ALL
    SELECT c.conv_id, o.place - c.h + least(c.h, coalesce(l.n, 0)), o.role, o.text
    FROM convs c JOIN original o ON o.conv_id = c.conv_id AND o.place >= c.h LEFT JOIN lengths l ON l.base = c.base),
paths AS (
    SELECT conv_id, place + 1 AS depth, length(text) AS chars,
           md5(string_agg(md5(role) || md5(text), '' ORDER BY place) OVER (PARTITION BY conv_id ORDER BY place)) AS node
    FROM turns
    UNION ALL SELECT conv_id, 0, 0, '' FROM convs),
stepped AS (SELECT *, lag(node) OVER c AS above, lead(node) OVER c IS NULL AS ends FROM paths WINDOW c AS (PARTITION BY conv_id ORDER BY depth)),
nodes AS (
    SELECT node, above, depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(chars) AS chars,
           sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE ends), '')) AS ends_sha256
    FROM stepped GROUP BY ALL),
children AS (SELECT above AS node, count(*) AS n_children FROM nodes GROUP BY above),
-- The ancestors of a node are on the path of any of its members.
below AS (
    SELECT p.node, count(*) FILTER (WHERE c.n_children IS NULL) AS n_leaves, sum((n.n_convs - 1) * n.chars) AS saved_tokens
    FROM nodes n JOIN paths p ON p.conv_id = n.conv_id AND p.depth <= n.depth LEFT JOIN children c ON c.node = n.node GROUP BY p.node)
SELECT n.conv_id, n.depth::BIGINT AS depth, a.conv_id AS parent_conv_id, n.n_convs, coalesce(c.n_children, 0)::BIGINT AS n_children,
       b.n_leaves::BIGINT AS n_leaves, b.saved_tokens::BIGINT AS saved_tokens, n.ends_sha256
FROM nodes n JOIN below b ON b.node = n.node LEFT JOIN children c ON c.node = n.node LEFT JOIN nodes a ON a.node = n.above
"""


def planted(doc_id: int | None, words: list) -> list:
    """The words with the repetition that the contract of op13 plants in a tenth of the documents; rows without an id have none."""
    import zlib

    h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    first = g % n
    period = 1 + (n - first) // (3 + g % 8)
    unit = words[first:first + period]
    return words[:first] + (unit * ((n - first) // period + 1))[:n - first]


def op13_runs(spark: SparkSession, folder: str) -> DataFrame:
    found = runs.collapsed(_documents(spark, folder), planted)
    # The longest run; of equal ones the first, then that of the least period: the array is in that order.
    longest = F.filter("runs", lambda r: r["length"] == F.array_max(F.col("runs")["length"]))[0]
    listed = F.concat_ws("", F.transform("runs", lambda r: F.format_string("%d,%d,%d\n", r["start"], r["length"], r["period"])))
    return found.withColumn("best", F.when(F.size("runs") > 0, longest)).select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), "best.start", "best.length", "best.period",
        F.floor(1000 * F.col("best.length") / F.col("best.period")).cast("bigint").alias("exponent_milli"),
        F.sha2(listed.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("kept_text").cast("binary"), 256).alias("collapsed_sha256"))


QUERIES = {
    f.__name__: f for f in (
        op1_toxicity, op2_substring_dedup, op3_bpe, op4_secrets, op5_quality, op6_near_dedup, op7_mix, op8_fingerprints,
        op9_token_counts, op10_exact_dedup, op11_packing, op12_prefix_trie, op13_runs)}
SQL = {"op7_mix": OP7_SQL, "op10_exact_dedup": OP10_SQL, "op12_prefix_trie": OP12_SQL}
