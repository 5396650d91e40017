"""Quality classifier: histogram gradient-boosted trees over document statistics.

Statistics are computed once for every whole text. The trees are grown on a bounded, hash-chosen sample of labelled rows from
gradient histograms over binned statistics; the finished trees lie in three arrays (statistic, border and leaf values of
complete binary trees) that ship with the task and are walked for a whole batch and all trees at once.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

from pyspark.sql import DataFrame, functions as F

from millrace.llm.common import held_out, key_fraction, map_texts
from millrace.session import materialise

SAMPLE = 20_000  # labelled rows the trees are fitted on, about
SYMBOLS = b"#$%&*|!@^~<>{}[]\\=+_/"
MARKS = b".,;:?'\"-()"
STATISTICS = (
    "log_bytes", "log_words", "word_length", "longest_word", "distinct_words", "distinct_pairs", "top_word", "line_words",
    "distinct_lines", "upper", "lower", "digits", "symbols", "marks", "spaces", "breaks", "beyond_ascii", "control",
    "top_byte", "symbol_words",
)
SCHEMA = "doc_id bigint, statistics array<float>"


class Trees(NamedTuple):
    """`statistic` and `border`: trees x inner nodes, level by level; `leaf`: trees x leaves; `start`: score before all trees."""

    statistic: object
    border: object
    leaf: object
    start: float


def describe() -> Callable[[list, list], dict]:
    """Statistics of texts, in the order of STATISTICS; an empty text has zeros."""
    from collections import Counter

    import numpy as np

    kind = np.zeros((256, 8))
    for value in range(256):
        c = bytes([value])
        kind[value] = (c.isupper(), c.islower(), c.isdigit(), c in SYMBOLS, c in MARKS, value == 32, value in (10, 13), value >= 128)

    def one(text: str) -> list[float]:
        raw = text.encode()
        words = raw.split()
        if not raw:
            return [0.0] * len(STATISTICS)
        seen = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
        size, n = len(raw), max(1, len(words))
        lines = [line for line in raw.split(b"\n") if line]
        counts = Counter(words)
        upper, lower, digit, symbol, mark, space, line, beyond = (seen @ kind / size).tolist()
        marked = sum(n for word, n in counts.items() if word[-1] in SYMBOLS)
        return [
            np.log1p(size), np.log1p(len(words)), sum(map(len, words)) / n, np.log1p(max(map(len, words), default=0)), len(counts) / n,
            len(set(zip(words, words[1:]))) / n, max(counts.values(), default=0) / n, len(words) / max(1, len(lines)),
            len(set(lines)) / max(1, len(lines)), upper, lower, digit, symbol, mark, space, line, beyond,
            float(seen[:9].sum() + seen[14:32].sum()) / size, float(seen.max()) / size, marked / n]

    return lambda ids, texts: {"doc_id": ids, "statistics": [one(t) for t in texts]}


def grow(x, y, trees: int = 80, depth: int = 4, bins: int = 64, rate: float = 0.15, ridge: float = 2.0) -> Trees:
    """Boost `trees` complete trees on the logistic loss. Nodes that no border improves send every row to the left."""
    import numpy as np

    rows, width = x.shape
    inner, leaves = 2**depth - 1, 2**depth
    share = (y.sum() + 0.5) / (len(y) + 1)
    start = float(np.log(share / (1 - share)))
    statistic, border, leaf = np.zeros((trees, inner), np.int32), np.full((trees, inner), np.inf), np.zeros((trees, leaves))
    if rows == 0 or y.min() == y.max():
        return Trees(statistic, border, leaf, start)
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(width)]
    binned = np.stack([np.searchsorted(cuts[f], x[:, f], side="left") for f in range(width)], axis=1)
    place, score = binned + np.arange(width) * bins, np.full(rows, start)
    for t in range(trees):
        p = 1 / (1 + np.exp(-score))
        slope, bend = y - p, p * (1 - p)
        node = np.zeros(rows, np.int64)  # within its level
        for level in range(depth):
            many = 2**level
            at = (node[:, None] * (width * bins) + place).ravel()
            g = np.bincount(at, np.repeat(slope, width), many * width * bins).reshape(many, width, bins)
            h = np.bincount(at, np.repeat(bend, width), many * width * bins).reshape(many, width, bins)
            gl, hl = g.cumsum(2), h.cumsum(2)
            gt, ht = gl[:, :1, -1:], hl[:, :1, -1:]
            gain = gl**2 / (hl + ridge) + (gt - gl)**2 / (ht - hl + ridge) - gt**2 / (ht + ridge)
            gain[(hl < 1) | (ht - hl < 1)] = 0
            best = gain.reshape(many, -1).argmax(1)
            split = gain.reshape(many, -1).max(1) > 1e-6
            which, cut = best // bins, best % bins
            first = many - 1
            for k in np.flatnonzero(split):
                if cut[k] < len(cuts[which[k]]):
                    statistic[t, first + k], border[t, first + k] = which[k], cuts[which[k]][cut[k]]
            node = 2 * node + (x[np.arange(rows), statistic[t, first + node]] > border[t, first + node])
        g, h = np.bincount(node, slope, leaves), np.bincount(node, bend, leaves)
        leaf[t] = rate * g / (h + ridge)
        score += leaf[t, node]
    return Trees(statistic, border, leaf, start)


def walk(model: Trees, x):
    """Scores of all rows: every tree is walked level by level, for all rows at once."""
    import numpy as np

    trees, inner = model.statistic.shape
    node, each, row = np.zeros((len(x), trees), np.int64), np.arange(trees), np.arange(len(x))[:, None]
    while trees and len(x) and node[0, 0] < inner:
        node = 2 * node + 1 + (x[row, model.statistic[each, node]] > model.border[each, node])
    total = model.leaf[each, node - inner].sum(1) + model.start
    return 1 / (1 + np.exp(-total))


def labelled_sample(labels: DataFrame, label: str, rows: int = SAMPLE, salt: str = "sample") -> DataFrame:
    """About `rows` labelled ids at most, `doc_id, label`, chosen by hash; never held-out ones. Repeated ids: the largest label."""
    usable = labels.where(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1) & ~held_out()).groupBy("doc_id").agg(
        F.max(label).alias("label"))
    there = usable.count()
    return usable if there <= rows else usable.where(key_fraction("doc_id", salt) < rows / there)


def fit(described: DataFrame, labels: DataFrame, label: str = "quality", rows: int = SAMPLE, **options) -> Trees:
    """Trees from the statistics of the sampled rows; the one thing that comes to the driver. Without labels: score 0.5."""
    import numpy as np

    sample = described.join(F.broadcast(labelled_sample(labels, label, rows)), "doc_id").groupBy("doc_id").agg(
        F.min("statistics").alias("statistics"), F.max("label").alias("label"))
    got = sample.toPandas().sort_values("doc_id")
    x = np.array(got["statistics"].tolist(), float).reshape(len(got), len(STATISTICS))
    return grow(x, got["label"].to_numpy(float), **options)


def scored(docs: DataFrame, labels: DataFrame, label: str = "quality", rows: int = SAMPLE, **options) -> DataFrame:
    """`doc_id, score` of every whole text, one row per row of `docs`.

    NULL and empty texts have all statistics zero and get the score of that. Rows whose id is NULL are scored but never learnt
    from. Only `doc_id` and `text` of `docs` are looked at.
    """
    described = materialise(map_texts(docs, describe, SCHEMA), "statistics")
    model = fit(described, labels, label, rows, **options)

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            flat = batch.column(1).flatten().to_numpy(zero_copy_only=False).astype(float)
            score = walk(model, flat.reshape(batch.num_rows, len(STATISTICS)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score)], names=["doc_id", "score"])

    return described.mapInArrow(run, "doc_id bigint, score double")


def accepted(docs: DataFrame, labels: DataFrame, least: float = 0.7, **options) -> DataFrame:
    """The rows of `docs`, all columns, whose text scores `least` or more; decided batch by batch where they are read."""
    ids = F.broadcast(labelled_sample(labels, options.get("label", "quality"), options.get("rows", SAMPLE)).select("doc_id"))
    model = fit(map_texts(docs.join(ids, "doc_id", "left_semi"), describe, SCHEMA), labels, **options)
    position = docs.columns.index("text")

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        rows = describe()
        for batch in batches:
            if batch.num_rows:
                texts = [t or "" for t in batch.column(position).to_pylist()]
                score = walk(model, np.array(rows(texts, texts)["statistics"], np.float32).astype(float))
                yield batch.filter(pa.array(score >= least))

    return docs.mapInArrow(run, docs.schema)
