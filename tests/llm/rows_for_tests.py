"""Rows that every operator must stand, and small tables made of texts."""

# Columns named like those the operators use inside, besides the columns of documents.
CLASHING = ["id", "tie", "row", "shard", "blob", "target", "copies", "digest", "nth", "of", "ties", "rate", "score", "spans", "band",
            "component", "rep", "sha", "text_sha256", "_order", "_slice", "_digest"]
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, " + ", ".join(f"`{c}` string" for c in CLASHING)
PROSE = ("the quick brown fox jumps over the lazy dog while seven wizards quietly box with jars of liquor and some "
         "more words follow here so that windows of twenty words exist in this text for sure ").strip()


def rows_of(texts):
    """Documents with these (doc_id, text, source)."""
    return [(i, t, "en", s, None if t is None else len(t), *["x"] * len(CLASHING)) for i, t, s in texts]


ODD = [
    (None, None, None), (None, "text without id " * 8, "a"), (1, "", "a"), (2, None, "b"), (3, "word", None), (4, " \t\n ", "b"),
    (5, PROSE, "a"), (6, PROSE, "c"), (6, PROSE, "c"), (7, PROSE + " ending", "a"), (7, "another text of the same id", "a"),
    (8, "In. " * 120, "a"), (9, "long " * 3 + " ".join(f"w{i * 7919 % 4001}" for i in range(30_000)), "c"), (10, "a" * 50_000, None),
    (11, "x y " + PROSE + " z", "b"), (12, "ünï😀 ▁   <s> \x00 token = \"abcdef1234567890\" AKIA" + "Q" * 20, "b"),
    (13, PROSE.upper(), "a"), (14, "0123456789abcdef" * 3 + " password:short secret: 'longenough1'", "a"), (15, "", "b"),
]


def table(spark, texts):
    """A table of documents from a list of texts, numbered from 0."""
    return spark.createDataFrame(rows_of([(i, t, "a") for i, t in enumerate(texts)]), SCHEMA).repartition(3)
