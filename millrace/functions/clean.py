"""Cleaning and typing expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, functions as F

# Text that stands for a missing value (case-sensitive).
MISSING_TOKENS = ["", "NA", "NaN", "null", "UNKNOWN"]
# Country synonyms.
COUNTRY_SYNONYMS = {"USA": "US", "UNITED STATES": "US"}
# Frozen country domain.
COUNTRY_DOMAIN = ["US", "CA", "MX"]
# Score words.
POSITIVE_WORDS = ["great", "amazing"]
NEGATIVE_WORDS = ["bad", "terrible"]
# What separates words, every Unicode space and line break.
WHITESPACE = r"[\s\p{Z}\x85\x1c-\x1f]+"
# Age bucket edges, right-closed.
AGE_EDGES = [0, 16, 65, 120]


def as_column(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nan_to_null(c: str | Column) -> Column:
    """NaN plays the part of a missing number in frames; Spark sorts it above everything, so turn it into NULL."""
    c = as_column(c)
    return F.when(~F.isnan(c), c)


def holds(condition: Column) -> Column:
    """A condition as a flag: a missing operand counts as false."""
    return F.coalesce(condition, F.lit(False))


def missing_tokens_to_null(c: str | Column, tokens: Sequence[str] = MISSING_TOKENS) -> Column:
    trimmed = F.trim(as_column(c))
    return F.when(~trimmed.isin(list(tokens)), trimmed)


def canonical_label(c: str | Column, synonyms: Mapping[str, str] = COUNTRY_SYNONYMS) -> Column:
    """Trim, upper-case, then replace whole values by their synonym; other values stay."""
    label = F.upper(F.trim(as_column(c)))
    if not synonyms:
        return label
    pairs = F.create_map(*[F.lit(x) for pair in synonyms.items() for x in pair])
    return F.coalesce(F.try_element_at(pairs, label), label)


def parse_flag(c: str | Column) -> Column:
    """TRUE/FALSE in any case; every other text is missing (a plain cast would accept 'yes' or '1')."""
    text = F.upper(as_column(c))
    return F.when(text == "TRUE", F.lit(True)).when(text == "FALSE", F.lit(False))


def word_score(
    c: str | Column, positive: Sequence[str] = POSITIVE_WORDS, negative: Sequence[str] = NEGATIVE_WORDS
) -> Column:
    """+1 for each positive and -1 for each negative whitespace-separated word of the whole text."""
    words = F.split(F.lower(as_column(c)), WHITESPACE)
    return F.size(F.filter(words, lambda w: w.isin(list(positive)))) - F.size(
        F.filter(words, lambda w: w.isin(list(negative)))
    )


def matches_from_start(c: str | Column, pattern: str) -> Column:
    """Regex match anchored at the start; a missing value does not match."""
    return holds(as_column(c).cast("string").rlike(f"^(?:{pattern})"))


def clip(c: str | Column, low: float | Column, high: float | Column) -> Column:
    """Clip to [low, high]; a missing value, NULL or NaN, stays what it is."""
    c = as_column(c)
    low = low if isinstance(low, Column) else F.lit(low)
    high = high if isinstance(high, Column) else F.lit(high)
    return F.when(c.isNull() | F.isnan(c), c).otherwise(F.least(F.greatest(c, low), high))


def right_closed_bucket(c: str | Column, edges: Sequence[float] = AGE_EDGES) -> Column:
    """Label of the bucket (a, b] that holds the value; values outside all buckets are NULL."""
    c = as_column(c)
    label = None
    for a, b in zip(edges, edges[1:]):
        inside = (c > a) & (c <= b)
        text = F.lit(f"({a}, {b}]")
        label = F.when(inside, text) if label is None else label.when(inside, text)
    return label


def keep_domain(c: str | Column, domain: Sequence[str] = COUNTRY_DOMAIN) -> Column:
    """Values outside the frozen domain become NULL."""
    c = as_column(c)
    return F.when(c.isin(list(domain)), c)


def whole_number(c: str | Column, dtype: str = "bigint") -> Column:
    """Nullable integer cast that fails on a fraction instead of cutting it off; ANSI cast fails on overflow."""
    c = as_column(c)
    wrong = F.raise_error(F.concat(F.lit("not a whole number: "), c.cast("string"))).cast(dtype)
    return F.when(c != F.floor(c), wrong).otherwise(c.cast(dtype))


def category_codes(values: Sequence[str], c: str | Column) -> Column:
    """Position of a value in a sorted category list, -1 when missing or unknown."""
    c = as_column(c)
    found = F.array_position(F.array(*[F.lit(v) for v in sorted(values)]), c).cast("int") - 1
    return F.coalesce(found, F.lit(-1))


def linear(x: str | Column, y: str | Column, weight: float = 2) -> Column:
    """x + weight * y."""
    return as_column(x) + F.lit(weight) * as_column(y)
