"""Secret scans: known patterns, and character Markov models for strings that look random.

Two first-order models of characters, one of random strings and one of ordinary identifiers, are counted over the whole
corpus: values that the known patterns find, with seeded random strings of usual alphabets, against other tokens and
identifiers joined from them. A token whose log-likelihood ratio per character is high enough is reported as well. Counting is
a Spark aggregation over pairs of characters, so the models are two small tables whatever the corpus holds.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F

from millrace.llm.common import map_texts

# The kinds and patterns of the contract. Where it asks for a length, the pattern may ask for it as well: a
# longest run that is too short holds no run that is long enough.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ASSIGN_NAMES = ("password", "passwd", "secret", "token", "apikey", "api_key")
ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
HEX = re.compile(r"[0-9a-f]{32,}")
KINDS = ("assign", "access", "hex", "markov")

CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
TOKEN = re.compile(r"[A-Za-z0-9+/_=-]{6,}")
DIGIT, LETTER = re.compile("[0-9]"), re.compile("[A-Za-z]")
ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-."
DRAWN = 4_000  # random strings added to what the patterns find
BACK = 20.0  # counts that the frequency of single characters stands for
LEAST = 2.4  # log-likelihood ratio per character from which a token is reported


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, end, kind number) of what the known patterns find, leftmost and non-overlapping for each kind, unordered."""
    low = text.lower()
    spans = [(m.start(), m.end(), 0) for m in ASSIGN.finditer(text) if m.end() - m.start(2) >= 8] if any(
        name in low for name in ASSIGN_NAMES) else []
    spans += [(m.start(), m.end(), 1) for m in ACCESS.finditer(text)] if "AKIA" in text else []
    return spans + [(m.start(), m.end(), 2) for m in HEX.finditer(text)]


def _drawn() -> list[str]:
    """Seeded random strings over hexadecimal, base 36, 62 and 64 alphabets."""
    import random

    rng = random.Random(7)
    alphabets = ("0123456789abcdef", ALPHABET[:26] + "0123456789", ALPHABET[:62], ALPHABET[:62] + "+/", ALPHABET[26:62])
    return ["".join(rng.choices(rng.choice(alphabets), k=rng.randint(16, 48))) for _ in range(DRAWN)]


def count_pairs() -> Callable[[list, list], dict]:
    """Character pairs of each batch: label 1 inside values of known secrets, 0 in ordinary tokens."""
    from collections import Counter

    def rows(ids: list, texts: list) -> dict:
        pairs: Counter = Counter()
        for text in texts:
            spans = sorted(base_spans(text))
            for start, end, kind in spans:
                value = ASSIGN.match(text, start).group(2) if kind == 0 else text[start:end]
                pairs.update((1, a, b) for a, b in zip(value, value[1:]))
            last, end, before, seen = 0, -1, "", 0
            for m in TOKEN.finditer(text):
                while last < len(spans) and spans[last][0] < m.end():
                    end, last = max(end, spans[last][1]), last + 1
                word = m.group()
                # Long mixtures of letters and digits bear no label: they may be secrets no pattern knows.
                if end <= m.start() and (len(word) < 16 or DIGIT.search(word) is None or LETTER.search(word) is None):
                    seen += 1
                    if seen % 4 == 0:  # identifiers made of the corpus' own words
                        word = (f"{before}_{word}", f"{before}{word.capitalize()}", f"{before}-{word}", f"{word}{seen % 100}")[seen // 4 % 4]
                    else:
                        before = word
                    pairs.update((0, a, b) for a, b in zip(word, word[1:]))
        return {"label": [k[0] for k in pairs], "pair": [k[1] + k[2] for k in pairs], "n": list(pairs.values())}

    return rows


def learn(docs: DataFrame):
    """Log-likelihood ratio of each character pair as an array over ALPHABET x ALPHABET.

    Counted over all documents, in each batch before the shuffle. Pairs are smoothed by how frequent their second character is.
    """
    import numpy as np

    counted = map_texts(docs, count_pairs, "label int, pair string, n bigint").groupBy("label", "pair").agg(F.sum("n").alias("n"))
    place = {c: i for i, c in enumerate(ALPHABET)}
    counts = np.zeros((2, len(ALPHABET), len(ALPHABET)))
    for r in counted.collect():  # two labels and the pairs of a fixed alphabet
        counts[r["label"], place[r["pair"][0]], place[r["pair"][1]]] += r["n"]
    for word in _drawn():
        for a, b in zip(word, word[1:]):
            counts[1, place[a], place[b]] += 1
    single = counts.sum(1, keepdims=True) + 0.5
    single = single / single.sum(2, keepdims=True)
    chance = (counts + BACK * single) / (counts.sum(2, keepdims=True) + BACK)
    return np.log(chance[1] / chance[0])


def start(ratio) -> Callable[[list, list], dict]:
    import numpy as np

    place = np.zeros(128, np.int64)
    for i, c in enumerate(ALPHABET):
        place[ord(c)] = i

    def rows(ids: list, texts: list) -> dict:
        out: dict = {"doc_id": ids, "base": [], "added": [], "ratio": []}
        for text in texts:
            base = sorted(base_spans(text), key=lambda s: (s[0], s[2]))
            added, ratios = [], []
            for m in CANDIDATE.finditer(text):
                code = place[np.frombuffer(m.group().encode(), np.uint8)]
                value = float(ratio[code[:-1], code[1:]].mean())
                if value >= LEAST and not any(s < m.end() and m.start() < e for s, e, _ in base):
                    added.append((m.start(), m.end(), 3))
                    ratios.append(value)
            out["base"].append([{"start": s, "end": e, "kind": k} for s, e, k in base])
            out["added"].append([{"start": s, "end": e, "kind": k} for s, e, k in added])
            out["ratio"].append(ratios)
        return out

    return rows


SPANS = "array<struct<start:int,end:int,kind:int>>"


def scanned(docs: DataFrame) -> DataFrame:
    """`doc_id, base, added, ratio` of every whole text, one row per row of `docs`.

    `base` lists what the known patterns find, by start and kind (a number into KINDS), `added` what the models add; offsets are
    code points, ends exclusive. A token that touches a span of `base` is not added. NULL and empty texts have none. A very long text
    is scanned in one task, in time that grows with its length.
    """
    ratio = learn(docs)
    return map_texts(docs, lambda: start(ratio), f"doc_id bigint, base {SPANS}, added {SPANS}, ratio array<double>")


def written(spans):
    """Spans as text: kind:start:end, by start and then kind, joined by commas."""
    kinds = F.array(*map(F.lit, KINDS))
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"], s["kind"], s["end"])))
    return F.array_join(F.transform(ordered, lambda s: F.concat_ws(":", kinds[s["kind"]], s["start"], s["end"])), ",")
