"""Near-duplicates by HyperMinHash: links of Jaccard similarity at or above a threshold, and their components.

Each text's shingle hashes fall into buckets; a bucket keeps, in sixteen bits, how many leading zeros its smallest hash has
and the mantissa bits after them. Bands of these compressed registers propose pairs, the collision-corrected Jaccard estimate
from all registers discards hopeless ones, and every other pair is confirmed on the full shingle sets.

Texts with equal sets are one representative from the start. Empty buckets borrow the register of another bucket, so bands of
short texts are as selective as those of long ones. A band's members are not expanded into pairs:

1. All are compared with the band's hub, the member that shares the most bands with others. In a group of near copies that is a
   text close to their common origin, so one comparison each connects nearly all that can be connected.
2. What is left outside the hub's component is paired with members of other components only where an exact bound allows a
   link: two texts cannot share more than what both share with the hub and what else of theirs occurs in any other text.
3. Where that could be very many pairs, texts meet by their rarest shingles instead of by the band: two linked texts share one
   of the rarest fifth (at 80 %) of either's, so a template that all of them contain brings no two together. A pair is given once,
   where the places of that shingle allow a link, and what both share with their hub, counted by bits.

No link between components is lost that way, and links inside a component cannot change it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

from pyspark.sql import DataFrame, functions as F

from millrace.llm.common import map_texts
from millrace.session import materialise

BUCKETS = 128
ROWS = 4  # registers in a band: at Jaccard 0.8 all 32 bands miss with a chance of 5e-8
MANTISSA = 10  # bits; the leading zeros take the other six
SHIPPED_IDS = 200_000  # ids of the texts whose sets are needed that are shipped to the tasks reading the texts
CROWD = 400  # possible pairs from which on a band's texts meet by their rarest shingles
CELLS = 1 << 18  # counters of the order by frequency
SLACK = 5.0  # standard errors that an estimate may be under the threshold without being discarded


class Shape(NamedTuple):
    """What is compared: words in a shingle, and the similarity that links, as a whole percentage."""

    width: int = 5
    percent: int = 80


def shingles(text: str, width: int):
    """Sorted distinct 64-bit hashes of the word shingles of a text, A-Z lower-cased; fewer words are one shingle."""
    import numpy as np

    words = text.encode().lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    import xxhash

    digest = xxhash.xxh3_64_intdigest
    known: dict = {}
    for word in words:
        if word not in known:
            known[word] = digest(word)
    codes = np.array([known[w] for w in words], np.uint64)
    n = min(width, len(codes))
    with np.errstate(over="ignore"):
        h = np.full(len(codes) - n + 1, np.uint64(n))
        for i in range(n):
            h = (h ^ (h >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + codes[i:len(codes) - n + 1 + i]
        h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return np.unique(h ^ (h >> np.uint64(31)))


def registers(hashes):
    """Compressed registers of a set of hashes; 0 marks an empty bucket, larger registers stand for smaller hashes."""
    import numpy as np

    out = np.zeros(BUCKETS, np.uint16)
    if not len(hashes):
        return out
    bits = BUCKETS.bit_length() - 1
    bucket = (hashes >> np.uint64(64 - bits)).astype(np.int64)
    first = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])  # hashes are sorted: the smallest of each bucket
    rest = (hashes[first] << np.uint64(bits)) | np.uint64((1 << bits) - 1)
    zeros = np.minimum(63 - np.floor(np.log2(rest.astype(np.float64))).astype(np.int64), 62).clip(0)
    mantissa = (rest << (zeros + 1).astype(np.uint64)) >> np.uint64(64 - MANTISSA)
    out[bucket[first]] = ((zeros + 1) << MANTISSA) | ((1 << MANTISSA) - 1 - mantissa.astype(np.int64))
    return out


def borrowing():
    """For each bucket the order in which it looks for a register to borrow, itself first."""
    import numpy as np

    place = np.arange(BUCKETS * BUCKETS, dtype=np.uint64)
    with np.errstate(over="ignore"):
        mixed = (place + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        mixed = (mixed ^ (mixed >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)
    mixed = (mixed ^ (mixed >> np.uint64(29))).reshape(BUCKETS, BUCKETS)
    mixed[np.arange(BUCKETS), np.arange(BUCKETS)] = 0
    return mixed.argsort(1)


def filled(regs, order):
    """Registers without empty buckets, of a set that is not empty."""
    import numpy as np

    there = regs > 0
    return regs if there.all() else regs[order[np.arange(BUCKETS), there[order].argmax(1)]]


def estimate(a, b, n_a, n_b):
    """Jaccard similarity from registers (rows of pairs) less expected chance agreements, and how many buckets it rests on."""
    import numpy as np

    used = (a > 0) | (b > 0)
    same = ((a == b) & used).sum(1)
    used = used.sum(1)
    # Two different minima share a register about once in 2^MANTISSA, more seldom if their sizes differ.
    ratio = np.minimum(n_a, n_b) / np.maximum(np.maximum(n_a, n_b), 1)
    chance = used * ratio / (1.5 * 2**MANTISSA)
    return np.clip((same - chance) / np.maximum(used - chance, 1), 0, 1), used


def signatures(docs: DataFrame, width: int) -> DataFrame:
    """`doc_id, n_shingles, set_id, registers, bands` of every whole text; set_id is a digest of the full set.

    `bands` has a hash for each band, none for the empty set.
    """

    def start() -> Callable[[list, list], dict]:
        import hashlib

        import xxhash

        order = borrowing()

        def rows(ids: list, texts: list) -> dict:
            out: dict = {"doc_id": ids, "n_shingles": [], "set_id": [], "registers": [], "bands": []}
            for text in texts:
                found = shingles(text, width)
                regs = registers(found)
                raw = filled(regs, order).reshape(-1, ROWS) if len(found) else regs[:0].reshape(-1, ROWS)
                out["n_shingles"].append(len(found))
                out["set_id"].append(hashlib.blake2b(found.tobytes(), digest_size=16).digest())
                out["registers"].append(regs.tobytes())
                out["bands"].append([xxhash.xxh3_64_intdigest(band.tobytes(), seed=i) - (1 << 63) for i, band in enumerate(raw)])
            return out

        return rows

    schema = "doc_id bigint, n_shingles bigint, set_id binary, registers binary, bands array<bigint>"
    return map_texts(docs, start, schema)


def _hopeful(pairs: DataFrame, own: DataFrame, percent: int) -> DataFrame:
    """Pairs `a, b` of representatives whose estimate may reach the threshold."""
    def side(name):
        return own.select(F.col("rep").alias(name), F.col("n_shingles").alias(f"n_{name}"), F.col("registers").alias(f"r_{name}"))

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            if not batch.num_rows:
                continue
            a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint16).reshape(-1, BUCKETS) for c in ("r_a", "r_b"))
            n_a, n_b = (batch.column(c).to_numpy().astype(float) for c in ("n_a", "n_b"))
            value, used = estimate(a, b, n_a, n_b)
            least = percent / 100 - SLACK * np.sqrt(percent / 100 * (1 - percent / 100) / np.maximum(used, 1))
            kept = batch.filter(pa.array((value >= least) | (used < BUCKETS // 2)))
            yield pa.RecordBatch.from_arrays([kept.column("a"), kept.column("b")], names=["a", "b"])

    return pairs.join(side("a"), "a").join(side("b"), "b").mapInArrow(run, "a bigint, b bigint")


def _sets(docs: DataFrame, ids: DataFrame, width: int) -> DataFrame:
    """`doc_id, shingles`: full sets of the texts with these ids (NULL for texts without words)."""
    def start() -> Callable[[list, list], dict]:
        import numpy as np

        return lambda doc, texts: {"doc_id": doc, "shingles": [shingles(t, width).view(np.int64) for t in texts]}

    wanted = F.broadcast(ids) if ids.count() <= SHIPPED_IDS else ids
    return map_texts(docs.join(wanted, "doc_id", "left_semi"), start, "doc_id bigint, shingles array<bigint>")


def _mask(part, whole):
    """Which elements of a sorted array another one holds, as bits of whole numbers."""
    import numpy as np

    bits = np.packbits(np.isin(whole, part, assume_unique=True), bitorder="little")
    return np.concatenate([bits, np.zeros(-len(bits) % 8, np.uint8)]).view(np.int64)


def _shared(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs `a, b` with the number of shingles the full sets have in common and have each, and b's shingles that a has, as bits."""
    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            common, left, right, masks = [], [], [], []
            s_a, s_b = batch.column("s_a"), batch.column("s_b")
            for i in range(batch.num_rows):
                x, y = (s[i].values.to_numpy() for s in (s_a, s_b))
                common.append(len(np.intersect1d(x, y, assume_unique=True)))
                left.append(len(x))
                right.append(len(y))
                masks.append(_mask(x, y))
            yield pa.RecordBatch.from_arrays(
                [batch.column("a"), batch.column("b"), *(pa.array(v, pa.int64()) for v in (common, left, right)),
                 pa.array(masks, pa.list_(pa.int64()))], names=["a", "b", "common", "n_a", "n_b", "mask"])

    def side(name):
        return sets.select(F.col("doc_id").alias(name), F.col("shingles").alias(f"s_{name}"))

    both = pairs.join(side("a"), "a").join(side("b"), "b")
    return both.select("a", "b", "s_a", "s_b").mapInArrow(
        run, "a bigint, b bigint, common bigint, n_a bigint, n_b bigint, mask array<bigint>")


def _rarest(sets: DataFrame, percent: int) -> DataFrame:
    """`rep, n, rare`: the shingles of each set that come first by frequency, as many as a link needs one of.

    Frequencies are counts of CELLS cells of the hash range, so the order is the same everywhere and its table has a fixed size;
    where cells fill up it still puts a template's shingles last.
    """
    import numpy as np

    def count(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            cells, n = np.unique(batch.column("shingles").flatten().to_numpy().view(np.uint64) % np.uint64(CELLS), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(cells.astype(np.int64)), pa.array(n)], names=["cell", "n"])

    counted = sets.select("shingles").mapInArrow(count, "cell bigint, n bigint").groupBy("cell").agg(F.sum("n").alias("n"))
    found = counted.toPandas()  # at most CELLS rows
    often = np.zeros(CELLS, np.int64)
    often[found["cell"].to_numpy(np.int64)] = found["n"].to_numpy(np.int64)
    shared = sets.sparkSession.sparkContext.broadcast(often)

    def order(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            sizes, rare = [], []
            for i in range(batch.num_rows):
                all_of = batch.column("shingles")[i].values.to_numpy()
                n = len(all_of)
                frequency = shared.value[(all_of.view(np.uint64) % np.uint64(CELLS)).astype(np.int64)]
                sizes.append(n)
                rare.append(all_of[np.lexsort((all_of, frequency))[:n - (n * percent + 99) // 100 + 1]])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(rare, pa.list_(pa.int64()))], names=["rep", "n", "rare"])

    return sets.select("doc_id", "shingles").mapInArrow(order, "rep bigint, n bigint, rare array<bigint>")


def _by_rarest(texts: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs `a, b` of the texts that may be linked, of different components, one of them outside; each pair once.

    `texts` has `rep, comp, outside`, the hub the text shares most with, a mask of the hub's shingles it has, and how many of its
    other shingles occur in any other text (`extra`). Shingles are ordered by how often they occur (`_rarest`; any fixed
    order is right). If two sets of n and m shingles are linked, they share one of the first n - ceil(percent * n / 100) + 1 of the
    one and of the first as many of the other. A pair is given at the first they share, if what follows there in both can be enough; and if they have
    the same hub, what both share with it, counted exactly, and the smaller `extra` must be enough.
    """
    held = sets.join(texts.select(F.col("rep").alias("doc_id")), "doc_id", "left_semi").withColumn(
        "row", F.xxhash64("shingles")).dropDuplicates(["doc_id", "row"]).select("doc_id", "shingles")
    first = _rarest(materialise(held, "near-held"), percent).select(
        "rep", "n", "rare", F.posexplode("rare").alias("place", "shingle"))
    first = materialise(first, "near-places")
    met = first.groupBy("shingle").agg(F.count("*").alias("often")).where("often > 1").select("shingle")
    first = first.join(met, "shingle", "left_semi")
    first = materialise(first.join(texts, "rep"), "near-rarest")
    kept = ("rep", "n", "rare", "place", "comp", "hub", "mask", "extra")
    x = first.where("outside").select("shingle", *[F.col(c).alias(f"x_{c}") for c in kept])

    def enough(most: str) -> str:
        return f"100 * ({most}) >= {percent} * (n + x_n - ({most}))"

    both = "aggregate(zip_with(mask, x_mask, (p, q) -> bit_count(p & q)), 0, (t, c) -> t + c)"
    met = first.join(x, "shingle").where(f"""comp <> x_comp AND (NOT outside OR x_rep < rep)
        AND {enough("least(n - place, x_n - x_place)")}
        AND (NOT hub <=> x_hub OR hub IS NULL OR {enough(f"{both} + least(extra, x_extra)")})
        AND array_intersect(rare, x_rare)[0] = shingle""")
    return met.select(F.least("rep", "x_rep").alias("a"), F.greatest("rep", "x_rep").alias("b")).distinct()


def components(links: DataFrame) -> DataFrame:
    """`node, component` (smallest node reachable) for every node of the links, by alternating large and small stars.

    Every round is an aggregation and a join by node; a node with very many links is summed before the shuffle, and the
    rounds grow with the logarithm of the longest path.
    """
    edges = materialise(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "cc")
    before = None
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        # Large star: larger neighbours are linked to the smallest node around.
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        large = materialise(large, "cc-large")
        # Small star: a node and its smaller neighbours are linked to the smallest of them.
        smallest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(smallest, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(
            smallest.select("u", F.col("m").alias("v"))).distinct()
        edges = materialise(small, "cc-small")
        state = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())
        if state == before:
            break
        before = state
    roots = edges.select(F.col("v").alias("node")).distinct().join(edges.select(F.col("u").alias("node")), "node", "left_anti")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots.select("node", F.col("node").alias("component")))


def classes(docs: DataFrame, shape: Shape = Shape()) -> DataFrame:
    """`doc_id, n_shingles, component_id, kept`, one row for each row of `docs`; kept are the smallest ids of components.

    Two texts are linked if 100 * common shingles >= percent * shingles of either; component_id is the smallest doc_id that
    links reach. Texts without words (NULL, empty, only white space) have no shingles and stay alone. Rows without an id stay
    alone as well, get no component and are not marked kept. Rows that repeat an id are one node: linked through any of their texts.
    """
    docs = docs.select("doc_id", "text")
    sigs = materialise(signatures(docs, shape.width), "near-sigs")
    filled = sigs.where("n_shingles > 0 AND doc_id IS NOT NULL")
    # Equal sets: the smallest id stands for all. Summed before the shuffle, so thousands of copies are a few rows.
    by_set = filled.groupBy("set_id").agg(F.min("doc_id").alias("rep"))
    reps = materialise(by_set, "near-reps")
    # Joined by set and id: the rows of a set with very many copies are not brought together.
    first = filled.join(reps.select("set_id", F.col("rep").alias("doc_id")), ["set_id", "doc_id"])
    own = materialise(first.dropDuplicates(["set_id", "doc_id"]).select(
        F.col("doc_id").alias("rep"), "n_shingles", "registers", "bands"), "near-own")
    nodes = _linked(own, docs, shape).withColumnRenamed("node", "rep")
    placed = materialise(reps.join(nodes, "rep", "left").select("set_id", F.coalesce("component", "rep").alias("component")), "near-sets")
    members = sigs.select("doc_id", "n_shingles", "set_id").join(placed, "set_id", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id")
    return members.select("doc_id", "n_shingles", component, F.coalesce(F.col("doc_id") == component, F.lit(False)).alias("kept"))


def _linked(own: DataFrame, docs: DataFrame, shape: Shape) -> DataFrame:
    """Components of the representatives that have a link: `node, component`."""
    percent = shape.percent
    every = own.select("rep", F.explode("bands").alias("band"))
    several = every.groupBy("band").agg(F.count("*").alias("n")).where("n > 1")
    members = materialise(every.join(several, "band"), "near-bands")
    known = materialise(members.groupBy("rep").agg(F.sum("n").alias("met")), "near-met")
    hubs = members.select("band", "rep").join(known, "rep").groupBy("band").agg(F.max(F.struct("met", "rep"))["rep"].alias("hub"))
    placed = materialise(members.select("band", "rep").join(hubs, "band"), "near-hubs")
    sets = materialise(_sets(docs, known.select(F.col("rep").alias("doc_id")), shape.width), "near-shingles")

    tried = placed.where("rep <> hub").select(F.col("rep").alias("a"), F.col("hub").alias("b")).distinct()
    shared = materialise(_shared(tried, sets), "near-shared")
    alike = f"100 * common >= {percent} * (n_a + n_b - common)"
    links = shared.where(alike).select("a", "b")
    found = materialise(components(links), "near-first")

    # How many shingles of a set occur in no other of these sets: counted, as all counts here, before they are shuffled.
    alone = sets.select("doc_id", F.explode("shingles").alias("shingle")).groupBy("shingle").agg(
        F.count("*").alias("n"), F.min("doc_id").alias("doc_id")).where("n = 1").groupBy("doc_id").agg(F.count("*").alias("alone"))
    # Rows that repeat an id: the bound is not used.
    sizes = sets.groupBy("doc_id").agg(F.max(F.size("shingles")).cast("bigint").alias("n"), F.count("*").alias("rows"))
    info = sizes.join(alone, "doc_id", "left").select(
        F.col("doc_id").alias("rep"), "n", F.when(F.col("rows") > 1, F.col("n")).otherwise(
            F.col("n") - F.coalesce("alone", F.lit(0))).alias("elsewhere"))
    nodes = known.select("rep").join(info, "rep").join(found.withColumnRenamed("node", "rep"), "rep", "left").select(
        "rep", "n", "elsewhere", F.coalesce("component", "rep").alias("comp"))
    nodes = materialise(nodes, "near-nodes")

    # Outsiders of a band: not in the component of its hub. Any pair across components has at least one.
    with_hub = shared.groupBy(F.col("a").alias("rep"), F.col("b").alias("hub")).agg(F.max("common").alias("common"))
    # The hub a text shares most with; of rows that repeat an id nothing is known.
    best = shared.groupBy(F.col("a").alias("rep"), F.col("b").alias("hub")).agg(
        F.max("common").alias("common"), F.any_value("mask").alias("mask"), F.count("*").alias("rows")).where("rows = 1").groupBy(
        "rep").agg(F.max(F.struct("common", "hub", "mask")).alias("best"))
    at = placed.join(nodes, "rep").join(nodes.select(F.col("rep").alias("hub"), F.col("comp").alias("hub_comp")), "hub").join(
        with_hub, ["rep", "hub"], "left").select(
        "band", "rep", "n", "elsewhere", "comp", F.coalesce("common", "n").alias("common"),
        ((F.col("comp") != F.col("hub_comp")) & (100 * F.col("elsewhere") >= percent * F.col("n"))).alias("outside"))
    at = materialise(at.join(own.select("rep", "bands").dropDuplicates(["rep"]), "rep"), "near-at")
    crowded = materialise(at.groupBy("band").agg(F.count("*").alias("n"), F.count_if("outside").alias("out")).where(
        F.col("n") * F.col("out") > CROWD).select("band"), "near-crowded")
    crowd = None
    if not crowded.isEmpty():
        texts = at.join(crowded, "band", "left_semi").groupBy("rep", "comp", "elsewhere").agg(F.max("outside").alias("outside"))
        texts = texts.join(best, "rep", "left").select(
            "rep", "comp", "outside", "best.hub", "best.mask", (F.col("elsewhere") - F.col("best.common")).alias("extra"))
        crowd = _by_rarest(materialise(texts, "near-crowd"), sets, percent)
        at = at.join(crowded, "band", "left_anti")
    x = at.where("outside").select("band", *[F.col(c).alias(f"x_{c}") for c in ("rep", "n", "elsewhere", "comp", "common", "bands")])
    most = "(least(common, x_common) + greatest(0, least(elsewhere - common, x_elsewhere - x_common)))"
    across = at.join(x, "band").where(f"""comp <> x_comp AND (NOT outside OR x_rep < rep)
        AND 100 * least(n, x_n) >= {percent} * greatest(n, x_n) AND 100 * {most} >= {percent} * (n + x_n - {most})
        AND array_position(zip_with(bands, x_bands, (p, q) -> p = q), true) = array_position(bands, band)""")
    pairs = across.select(F.least("rep", "x_rep").alias("a"), F.greatest("rep", "x_rep").alias("b")).distinct()
    pairs = pairs if crowd is None else pairs.union(crowd).distinct()
    hopeful = materialise(_hopeful(pairs, own, percent), "near-pairs")
    more = materialise(_shared(hopeful, sets).where(alike).select("a", "b"), "near-more")
    if more.isEmpty():
        return found
    return components(found.select(F.col("node").alias("a"), F.col("component").alias("b")).union(more))


def deduplicated(docs: DataFrame, shape: Shape = Shape()) -> DataFrame:
    """The rows of `docs`, all columns, that stay: of each component the row with the smallest id, and rows without an id."""
    dropped = classes(docs, shape).where("NOT kept AND doc_id IS NOT NULL").select("doc_id").distinct()
    return docs.join(dropped, "doc_id", "left_anti").select(*docs.columns)
