"""Toxic spans by a linear-chain conditional random field, and document scores from its marginals.

Token labels come from document labels: on a bounded sample, evidence (whole words and word beginnings) is chosen greedily so
that it covers as many toxic and as few clean documents as possible; tokens with evidence are toxic in toxic documents, all
others are not. The field has two tags, a weight for each piece of evidence and one for each tag transition, and is fitted by
gradient ascent on all sentences of the sample, equal ones once with their number. Forward-backward marginals give offending
spans, and a logistic curve over what they add up to in a document gives its score.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, functions as F

from millrace.llm.common import body, key_fraction, map_texts
from millrace.llm.quality import labelled_sample

SAMPLE = 3_000  # documents of each label that the model is fitted on, about
EVIDENCE = 400  # pieces of evidence at most
BEGINNINGS = range(3, 9)
TOKEN = re.compile(r"\w+")
BREAK = re.compile(r"[.!?\n]")
SURE = 0.5  # a token is offending from this marginal on


class Field(NamedTuple):
    """`evidence` maps a word or beginning ("word", "begin*") to its number; `curve` weighs the sums of `sums`."""

    evidence: dict
    weight: object
    bias: float
    first: object
    move: object
    curve: object


def _kinds(word: str) -> list[str]:
    return [word, *(f"{word[:n]}*" for n in BEGINNINGS if len(word) >= n)]


def choose_evidence(texts: list[str], toxic: list[bool], most: int = EVIDENCE, least: int = 4) -> dict[str, int]:
    """Greedy cover: each choice adds the most toxic documents not yet covered, less three times the clean ones it touches."""
    import heapq
    from collections import defaultdict

    texts_seen: dict = {}
    for text, label in zip(texts, toxic):  # copies count once
        texts_seen.setdefault(text, label)
    found: tuple = (defaultdict(set), defaultdict(set))
    for i, (text, label) in enumerate(texts_seen.items()):
        if label:
            for word in set(TOKEN.findall(text.lower())):
                for kind in _kinds(word):
                    found[1][kind].add(i)
    found = ({}, {kind: docs for kind, docs in found[1].items() if len(docs) >= least})
    clean: dict = defaultdict(int)
    for text, label in texts_seen.items():
        if not label:
            for kind in {k for word in set(TOKEN.findall(text.lower())) for k in _kinds(word)}:
                if kind in found[1]:
                    clean[kind] += 1
    covered: set = set()
    chosen: list = []

    def worth(kind: str) -> float:
        return len(found[1][kind] - covered) - 3 * clean[kind]

    heap = [(-worth(k), -len(k.rstrip("*")), k) for k in found[1] if worth(k) >= least]
    heapq.heapify(heap)
    while heap and len(chosen) < most:
        _, length, kind = heapq.heappop(heap)  # of equals the longest
        now = worth(kind)
        if now < least:
            continue
        if heap and -now > heap[0][0]:  # others may be better by now
            heapq.heappush(heap, (-now, length, kind))
            continue
        chosen.append(kind)
        covered |= found[1][kind]
    # Evidence that the first cover hides but that is as one-sided, for documents with several kinds.
    total = len(texts_seen)
    extra = [k for k in found[1] if k not in chosen and not any(k.startswith(c.rstrip("*")) for c in chosen if c.endswith("*"))
             and not k.endswith("*") and len(found[1][k]) >= max(least, total // 500) and 20 * clean[k] <= len(found[1][k])]
    return {kind: i for i, kind in enumerate(chosen + sorted(extra, key=lambda k: (-len(found[1][k]), k))[: most - len(chosen)])}


def sentences(text: str):
    """Tokens of each sentence: lists of (start, end, lower-case word), offsets in code points."""
    sentence, last = [], 0
    for m in TOKEN.finditer(text):
        if sentence and BREAK.search(text, last, m.start()):
            yield sentence
            sentence = []
        sentence.append((m.start(), m.end(), m.group().lower()))
        last = m.end()
    if sentence:
        yield sentence


class Evidence(dict):
    """Word to the numbers of its evidence."""

    def __init__(self, numbers: dict):
        super().__init__()
        self.numbers = numbers

    def __missing__(self, word: str) -> tuple:
        found = tuple(self.numbers[k] for k in _kinds(word) if k in self.numbers)
        if len(self) < 400_000:
            self[word] = found
        return found


def forward_backward(emission: list, first, move, times=None):
    """Probability of the toxic tag for every token, and the expected count of each tag transition, all sentences at once.

    `emission`: an array per sentence, the score of the toxic tag against the other for each token. `times`: how often each
    sentence counts in the transitions, once if not given.
    """
    import numpy as np

    if not emission:
        return [], np.zeros((2, 2))
    order = sorted(range(len(emission)), key=lambda i: -len(emission[i]))
    lengths = np.array([len(emission[i]) for i in order])
    longest = int(lengths[0])
    active = np.searchsorted(-lengths, -np.arange(longest), side="left")  # sentences with a token at each place
    starts = np.concatenate([[0], lengths.cumsum()])[:-1]
    flat = np.concatenate([emission[i] for i in order])
    gain = np.exp(np.clip(np.stack([np.zeros(len(flat)), flat], axis=1), -30, 30))
    ahead, back, trans = np.empty((len(flat), 2)), np.ones((len(flat), 2)), np.exp(move)
    state = np.exp(first) * gain[starts]
    for t in range(longest):
        at = starts[:active[t]] + t
        if t:
            state = (state[:active[t]] @ trans) * gain[at]
        state = state / state.sum(1, keepdims=True)
        ahead[at] = state
    for t in range(longest - 2, -1, -1):
        at = starts[:active[t + 1]] + t
        message = (gain[at + 1] * back[at + 1]) @ trans.T
        back[at] = message / message.sum(1, keepdims=True)
    both = ahead * back
    toxic = both[:, 1] / both.sum(1)
    out = [None] * len(emission)
    for i, s, n in zip(order, starts, lengths):
        out[i] = toxic[s:s + n]
    inside = np.ones(len(flat), bool)
    inside[starts] = False
    at = np.flatnonzero(inside)
    pairs = ahead[at - 1][:, :, None] * trans * (gain[at] * back[at])[:, None, :]
    share = pairs / pairs.sum((1, 2), keepdims=True)
    return out, share.sum(0) if times is None else np.tensordot(np.repeat(times[order], lengths)[at], share, 1)


def marginals(emission: list, first, move) -> list:
    return forward_backward(emission, first, move)[0]


def fit_field(sequences: list, tags: list, many: int, times=None, rounds: int = 60, pull: float = 0.02):
    """Weights by ascent on the log-likelihood: counts observed in the tags less those the field expects.

    `sequences`: per sentence a list of evidence tuples; `tags`: per sentence an array of 0 and 1; `times`: how often each counts.
    """
    import numpy as np

    weight, bias, first, move = np.zeros(many), -3.0, np.zeros(2), np.zeros((2, 2))
    if not sequences:
        return weight, bias, first, move
    row = np.concatenate([np.repeat(np.arange(len(s)), [len(t) for t in s]) + b for s, b in zip(
        sequences, np.concatenate([[0], np.cumsum([len(s) for s in sequences])])[:-1])]).astype(np.int64)
    number = np.array([n for s in sequences for t in s for n in t], np.int64)
    lengths = np.array([len(s) for s in sequences])
    times = np.ones(len(sequences)) if times is None else np.asarray(times, float)
    count = np.repeat(times, lengths)
    tag = np.concatenate(tags).astype(float)
    ends = lengths.cumsum()
    heads = ends - lengths
    inside = np.ones(len(tag), bool)
    inside[heads] = False
    pairs = np.flatnonzero(inside)
    both = np.stack([1 - tag, tag], 1)
    seen = both[pairs - 1].T @ (both[pairs] * count[pairs, None])
    values = [weight, np.array(bias), first, move]
    speed = [np.zeros_like(v) for v in values]
    for _ in range(rounds):
        weight, bias, first, move = values
        flat = np.full(len(tag), float(bias))
        np.add.at(flat, row, weight[number])
        split, steps = forward_backward(np.split(flat, ends[:-1]), first, move, times)
        gap = (tag - np.concatenate(split)) * count
        at_head = gap[heads].sum()
        slopes = (np.bincount(number, gap[row], many), gap.sum(), np.array([-at_head, at_head]), seen - steps)
        for k, (value, slope) in enumerate(zip(values, slopes)):
            slope = slope - pull * value
            speed[k] = speed[k] + np.square(slope)
            values[k] = value + slope / np.sqrt(speed[k] + 1e-9)
    weight, bias, first, move = values
    return weight, float(bias), first, move


def sums(p, words: int):
    """What a document's marginals over sentences with evidence add up to, against its length."""
    import numpy as np

    total, most = (float(p.sum()), float(p.max())) if len(p) else (0.0, 0.0)
    return [1.0, most, np.log1p(total), np.log(total / (words + 1) + 1e-4), np.log1p(words)]


def _document(text: str, lookup: Evidence, model: Field, plain: tuple):
    """Tokens and emissions of the sentences with evidence; nothing if no evidence can be in the text."""
    import numpy as np

    low = text.lower()
    if not any(k in low for k in plain):
        return [], []
    tokens, scores = [], []
    for sentence in sentences(text):
        found = [lookup[word] for _, _, word in sentence]
        if any(found):
            tokens.append(sentence)
            scores.append(np.array([model.bias + sum(model.weight[n] for n in numbers) for numbers in found]))
    return tokens, scores


def tag(texts: list[str], model: Field, lookup: Evidence):
    """For each text: (score, spans), a span being (start, end, marginal) of adjoining offending tokens of a sentence."""
    import numpy as np

    plain = tuple({k.rstrip("*") for k in model.evidence})
    prepared = [_document(t, lookup, model, plain) for t in texts]
    flat = iter(marginals([s for _, scores in prepared for s in scores], model.first, model.move))
    out = []
    for text, (tokens, scores) in zip(texts, prepared):
        per = [next(flat) for _ in scores]
        z = float(np.dot(model.curve, sums(np.concatenate(per) if per else np.zeros(0), len(text.split()))))
        spans: list = []
        for sentence, p in zip(tokens, per):
            before = False
            for (start, end, _), value in zip(sentence, p.tolist()):
                if value >= SURE:
                    if before:
                        spans[-1] = (spans[-1][0], end, max(value, spans[-1][2]))
                    else:
                        spans.append((start, end, value))
                before = value >= SURE
        out.append((1 / (1 + np.exp(-np.clip(z, -30, 30))), spans))
    return out


def fit(texts: list[str], toxic: list[bool], weights: tuple[float, float] = (1.0, 1.0)) -> Field:
    """Evidence, field and curve from labelled texts; `weights` undo unequal sampling of clean and toxic texts."""
    from collections import Counter

    import numpy as np

    evidence = choose_evidence(texts, toxic)
    lookup = Evidence(evidence)
    # Of a sentence without evidence only the length matters, whatever the label, so they come down to few.
    seen: Counter = Counter()
    for text, label in zip(texts, toxic):
        for sentence in sentences(text):
            found = tuple(lookup[word] for _, _, word in sentence)
            seen[found, bool(label) and any(found)] += 1
    tags = [np.array([float(label and bool(f)) for f in found]) for found, label in seen]
    weight, bias, first, move = fit_field([found for found, _ in seen], tags, len(evidence), list(seen.values()))
    model = Field(evidence, weight, bias, first, move, np.zeros(5))
    plain = tuple({k.rstrip("*") for k in evidence})
    rows = []
    for text in texts:
        per = marginals(_document(text, lookup, model, plain)[1], first, move)
        rows.append(sums(np.concatenate(per) if per else np.zeros(0), len(text.split())))
    x, y = np.array(rows).reshape(len(texts), 5), np.array(toxic, float)
    w, curve = np.where(y > 0, weights[1], weights[0]), np.zeros(5)
    for _ in range(25):  # Newton steps of a logistic regression with a slight pull to zero
        p = 1 / (1 + np.exp(-np.clip(x @ curve, -30, 30)))
        bend = (x * (w * p * (1 - p))[:, None]).T @ x + 0.05 * np.eye(5)
        curve = curve + np.linalg.solve(bend, x.T @ (w * (y - p)) - 0.05 * curve)
    return model._replace(curve=curve)


def learn(docs: DataFrame, labels: DataFrame, label: str = "toxic", rows: int = SAMPLE) -> Field:
    """A model from about `rows` labelled documents of each label, chosen by hash and never held out; they come to the driver."""
    ids = labelled_sample(labels, label, 1 << 62)
    there = {r["label"]: r["count"] for r in ids.groupBy("label").count().collect()}
    share = {k: min(1.0, rows / n) for k, n in there.items()}
    wanted = F.create_map(*[F.lit(v) for k in (0, 1) for v in (k, share.get(k, 0.0))])
    ids = ids.where(key_fraction("doc_id", "toxic") < wanted[F.col("label").cast("int")])
    got = docs.select("doc_id", body().alias("text")).join(F.broadcast(ids), "doc_id").groupBy("doc_id").agg(
        F.min("text").alias("text"), F.max("label").alias("label")).toPandas().sort_values("doc_id")
    return fit(got["text"].tolist(), (got["label"] == 1).tolist(), (1 / share.get(0, 1.0), 1 / share.get(1, 1.0)))


def start(model: Field) -> Callable[[list, list], dict]:
    lookup = Evidence(model.evidence)

    def rows(ids: list, texts: list) -> dict:
        found = tag(texts, model, lookup)
        return {"doc_id": ids, "score": [float(s) for s, _ in found],
                "spans": [[{"start": a, "end": b, "marginal": p} for a, b, p in spans] for _, spans in found]}

    return rows


def tagged(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """`doc_id, score, spans` of every whole text, one row per row of `docs`.

    Spans are offsets in code points of tokens whose marginal is SURE or more, adjoining ones joined. Sentences without any
    evidence have the same low marginals whatever their words and are left out of the sums. NULL and empty texts have no spans
    and the score of an empty document. Without labels every score is 0.5. Only `doc_id` and `text` are looked at.
    """
    model = learn(docs, labels, **options)
    schema = "doc_id bigint, score double, spans array<struct<start:int,end:int,marginal:double>>"
    return map_texts(docs, lambda: start(model), schema)
