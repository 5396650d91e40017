"""De-duplication of whole texts, near-duplicates and passages against plain versions."""

import hashlib
import random
from collections import Counter, defaultdict

import pyarrow as pa

from millrace.llm import exact_dedup, near_dedup, substring_dedup

from rows_for_tests import ODD, table


def sha(text):
    return hashlib.sha256((text or "").encode()).hexdigest()


def plain_decisions(rows):
    groups = defaultdict(list)
    for i, text in rows:
        groups[text or ""].append(i)
    out = []
    for i, text in rows:
        ids = groups[text or ""]
        keep = max((x for x in ids if x is not None), default=None)
        out.append((i, keep, len(ids), i == keep, sha(text)))
    return sorted(map(str, out))


def test_exact_decisions(odd, none):
    rows = [(i, t) for i, t, _ in ODD]
    assert plain_decisions(rows) == sorted(str(tuple(r)) for r in exact_dedup.decisions(odd).collect())
    assert exact_dedup.decisions(none).count() == 0


def test_frequent_texts_leave_the_shuffle(spark):
    texts = ["hot"] * 200 + ["warm"] * 60 + [f"text {i % 90}" for i in range(300)]
    random.Random(5).shuffle(texts)
    docs = table(spark, texts)
    for counters in (2, 8, 64):
        got = sorted(str(tuple(r)) for r in exact_dedup.decisions(docs, counters).collect())
        assert got == plain_decisions(list(enumerate(texts)))
    digests = docs.selectExpr("doc_id", "sha2(text, 256) AS _digest")
    found = {r["_digest"]: r["_size"] for r in exact_dedup.winners(digests, 8).collect()}
    assert found[sha("hot")] == 200 and len(found) <= 8


def test_exact_rows_that_stay(odd, none):
    got = exact_dedup.deduplicated(odd).collect()
    assert Counter(r["text"] or "" for r in got) == Counter({t or "" for _, t, _ in ODD})
    assert exact_dedup.deduplicated(odd).columns == odd.columns
    assert exact_dedup.deduplicated(none).count() == 0


def plain_classes(rows, width, percent):
    """Component of each id by comparing all pairs; rows of one id are one node."""
    sets, parent = defaultdict(set), {}
    for i, text in rows:
        words = (text or "").encode().lower().split()
        n = min(width, len(words))
        sets[i].add(frozenset(tuple(words[k:k + n]) for k in range(len(words) - n + 1)) if words else frozenset())

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a in sets:
        for b in sets:
            if a is not None and b is not None and a < b and any(
                    x and y and 100 * len(x & y) >= percent * len(x | y) for x in sets[a] for y in sets[b]):
                low, high = sorted((root(a), root(b)))
                parent[high] = low
    return {i: root(i) for i in sets if i is not None}


def edited(rng, words, changes):
    words = list(words)
    for _ in range(changes):
        words[rng.randrange(len(words))] = f"new{rng.randrange(10 ** 6)}"
    return " ".join(words)


def test_near_classes_are_those_of_all_pairs(spark):
    rng, texts = random.Random(11), []
    for size in (3, 5, 9, 30, 60, 150, 400):
        base = [f"w{rng.randrange(5000)}" for _ in range(size)]
        texts += [edited(rng, base, rng.randrange(0, max(1, size // 12) + 1)) for _ in range(14)]
    chain = [f"c{i}" for i in range(300)]
    texts += [" ".join(chain[k:k + 100]) for k in range(0, 200, 5)]
    rows = list(enumerate(texts))
    for width, percent in ((4, 80), (5, 80), (4, 60)):
        got = near_dedup.classes(table(spark, texts), near_dedup.Shape(width, percent)).collect()
        want = plain_classes(rows, width, percent)
        if percent == 80:  # what the bands are made for
            assert {r["doc_id"]: r["component_id"] for r in got} == want
            assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)
        else:
            assert sum(r["component_id"] != want[r["doc_id"]] for r in got) <= len(got) // 5


def test_near_copies_in_a_common_template(spark, monkeypatch):
    """Texts that share 60 % of their words, each with a near copy of its own, are not paired with all others."""
    rng, texts, counted, hopeful = random.Random(23), [], [], near_dedup._hopeful
    template = [f"t{i}" for i in range(180)]
    for i in range(120):
        own = [f"w{rng.randrange(10**9)}" for _ in range(120)]
        texts += [" ".join([*template, *own]), " ".join([*template, *own[:-1], "changed"])]

    def counting(pairs, *rest):
        counted.append(pairs.count())
        return hopeful(pairs, *rest)

    monkeypatch.setattr(near_dedup, "_hopeful", counting)
    got = {r["doc_id"]: r["component_id"] for r in near_dedup.classes(table(spark, texts)).collect()}
    assert got == {i: i - i % 2 for i in range(240)}
    assert counted and counted[0] < 1_000


def test_crowded_bands_find_the_same_classes(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "CROWD", 0)
    test_near_classes_are_those_of_all_pairs(spark)


def test_near_odd_rows(odd, none):
    got = near_dedup.classes(odd, near_dedup.Shape(4, 80)).collect()
    want = plain_classes([(i, t) for i, t, _ in ODD], 4, 80)
    assert Counter(r["doc_id"] for r in got) == Counter(i for i, _, _ in ODD)
    assert {r["doc_id"]: r["component_id"] for r in got} == want | {None: None}
    assert near_dedup.classes(none).count() == 0
    left = near_dedup.deduplicated(odd, near_dedup.Shape(4, 80))
    assert left.columns == odd.columns
    assert Counter(r["doc_id"] for r in left.collect()) == Counter(i for i, _, _ in ODD if i is None or want[i] == i)


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(5, k) for k in range(200, 260)] + [(260, 259), (1, 1)]
    got = near_dedup.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()
    assert {r["node"]: r["component"] for r in got} == {**{i: 100 for i in range(100, 161)}, 5: 5, **{k: 5 for k in range(200, 261)}}


def test_estimate_is_near_the_truth():
    import numpy as np

    rng = np.random.default_rng(4)
    for share in (0.2, 0.5, 0.8, 0.95):
        values = []
        for _ in range(40):
            pool = rng.integers(0, 2**63, 4000, dtype=np.uint64) * np.uint64(2)
            common = int(2000 * share * 2 / (1 + share))
            a, b = np.unique(pool[:2000]), np.unique(pool[2000 - common:4000 - common])
            x, y = (near_dedup.registers(s)[None] for s in (a, b))
            values.append(near_dedup.estimate(x, y, np.array([len(a)]), np.array([len(b)]))[0][0])
        assert abs(np.mean(values) - share) < 0.03


def plain_passages(rows):
    """What stays of each (id, text), documents in order of id and then of the order given."""
    window, seen, out = substring_dedup.WINDOW, set(), {}
    for i, text in rows:
        words = (text or "").encode().split()
        gone = [False] * len(words)
        for s in range(len(words) - window + 1):
            key = tuple(words[s:s + window])
            if key in seen:
                gone[s:s + window] = [True] * window
            seen.add(key)
        out[i, text] = (len(words), sum(gone), b" ".join(w for w, g in zip(words, gone) if not g).decode())
    return out


def test_passages(spark, monkeypatch):
    rng = random.Random(21)
    passages = [[f"p{k}x{rng.randrange(99)}" for _ in range(rng.randrange(15, 60))] for k in range(8)]
    texts = []
    for i in range(150):
        words = [f"u{rng.randrange(4000)}" for _ in range(rng.randrange(0, 80))]
        for _ in range(rng.randrange(3)):
            at = rng.randrange(len(words) + 1)
            words[at:at] = rng.choice(passages)
        texts.append(" ".join(words))
    texts += ["same " * 25, "a b " * 30, "a b c " * 30, "same " * 90, texts[7], texts[7], "a b " * 31, None, ""]
    want = plain_passages(enumerate(texts))
    for portion in (60, 10**6):
        monkeypatch.setattr(substring_dedup, "PORTION", portion)
        got = substring_dedup.deduplicated(table(spark, texts)).collect()
        assert {r["doc_id"]: tuple(r)[1:] for r in got} == {i: v for (i, _), v in want.items()}


def test_passages_of_odd_rows(odd, none):
    rows = list(dict.fromkeys((i, t) for i, t, _ in ODD if i is not None and i != 7))
    got = substring_dedup.deduplicated(odd.where("doc_id <> 7 AND doc_id IS NOT NULL")).collect()
    want = plain_passages(rows)
    assert sorted((r["doc_id"], *tuple(r)[1:]) for r in got) == sorted((i, *want[i, t]) for i, t, _ in ODD if i not in (None, 7))
    assert Counter(r["doc_id"] for r in substring_dedup.deduplicated(odd).collect()) == Counter(i for i, _, _ in ODD)
    assert substring_dedup.deduplicated(none).count() == 0


def phrase_texts(many):
    """A phrase of 8 words in nine of ten texts with other words around it; some texts share more than the phrase."""
    rng, phrase = random.Random(17), [f"hot{i}" for i in range(8)]
    out = []
    for i in range(many):
        before, after = ([f"w{rng.randrange(10**9)}" for _ in range(15)] for _ in range(2))
        if i % 10:
            before, after = (([*before[:3], *(f"same{k}" for k in range(12))], after) if i % 7 == 0 else (before, after))
            out.append(" ".join([*before, *phrase, *after]))
        else:
            out.append(" ".join([*before, *after]))
    return out


def test_passages_around_a_hot_phrase(spark, monkeypatch):
    texts = phrase_texts(400)
    want = plain_passages(enumerate(texts))
    assert sum(removed > 0 for _, removed, _ in want.values()) > 30
    for hot, here, portion in ((2_000, 100, 1_000_000), (30, 10**9, 2_000), (30, 8, 2_000), (10**9, 10**9, 2_000)):
        monkeypatch.setattr(substring_dedup, "HOT", hot)
        monkeypatch.setattr(substring_dedup, "HOT_HERE", here)
        monkeypatch.setattr(substring_dedup, "PORTION", portion)
        got = substring_dedup.deduplicated(table(spark, texts)).collect()
        assert {r["doc_id"]: tuple(r)[1:] for r in got} == {i: v for (i, _), v in want.items()}


def test_no_shard_holds_all_of_a_hot_phrase(monkeypatch):
    monkeypatch.setattr(substring_dedup, "PORTION", 5_000)
    monkeypatch.setattr(substring_dedup, "HOT", 300, raising=False)
    texts, tasks = phrase_texts(4_000), 32
    batches = [pa.record_batch({"id": pa.array(range(k, k + 50), pa.int64()), "tie": pa.array([0] * 50, pa.int32()),
                                "text": texts[k:k + 50]}) for k in range(0, len(texts), 50)]

    def dealt(sent):
        rows = sorted((r for b in sent for r in b.to_pylist()), key=lambda r: r["shard"])
        return [pa.RecordBatch.from_pylist(rows, pa.schema([("shard", pa.int32()), ("blob", pa.binary())]))]

    def largest_share(batches):
        sizes = Counter()
        for row in batches[0].to_pylist():
            sizes[row["shard"]] += len(row["blob"])
        return max(sizes.values()) / sum(sizes.values())

    anchors = dealt(substring_dedup._send_anchors(tasks)(iter(batches)))
    starts = defaultdict(list)
    for batch in substring_dedup._find_candidates(iter(anchors)):
        for row in batch.to_pylist():
            starts[row["id"]].append(row["found"])
    assert len(starts) > 1_500
    wanted = [pa.record_batch({"id": [i], "tie": pa.array([0], pa.int32()), "text": [texts[i]], "starts": [s]}) for i, s in starts.items()]
    segments = dealt(substring_dedup._send_segments(tasks)(iter(wanted)))
    share = largest_share(segments)
    assert share < 3 / tasks


def test_index_counts_occurrences():
    import numpy as np

    rng = np.random.default_rng(8)
    text = rng.integers(1, 4, 500).astype(np.int32)
    text[rng.integers(0, 500, 20)] = 0
    text[-1] = 0
    index = substring_dedup.FmIndex(text)
    ends = np.arange(20, 499)
    length, low, high = index.statistics(text, ends)
    symbols = text.tolist()
    for end, n, lo, hi in zip(ends.tolist(), length, low, high):
        pattern = symbols[end - n:end]
        if n and 0 not in pattern:
            places = [p for p in range(500) if symbols[p:p + n] == pattern]
            assert sorted(index.order[lo:hi].tolist()) == places and len(places) >= 2
            longer = symbols[end - n - 1:end]
            assert n == 20 or 0 in longer or sum(symbols[p:p + n + 1] == longer for p in range(500)) == 1
