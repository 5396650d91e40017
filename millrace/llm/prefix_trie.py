"""Prefix trie of conversations, built as a burst trie.

A letter of the trie is a turn at its place, known by a 128-bit digest; a node is known by the exclusive or of the digests on its
path, so any stretch of a path can be added to any head. Conversations are cut into stretches of at most STRETCH turns at fixed
places; a scan over the stretches gives the head, the node under which each one hangs. Equal stretches under one head are one row
with the number and the smallest id of their conversations, however many they are.

The rows under one head are its container. A container of more than BURST rows bursts: what all its rows share becomes a chain of
nodes, and the next turn id deals the rows to new heads below. That is an aggregation by head and a step on each row, so no
container is ever in one task while it is large, and each round splits it at a turn where its rows differ. The containers that
remain are dealt to shards by their head, sorted, and swept into nodes by a stack as deep as a stretch.

Sums over subtrees need no walk up the tree. Let a conversation own the nodes it is the smallest member of; they are the end of
its path. With U(m) for the characters on the part of m's path that it does not own, and P for those above a node with n members
and the owner o, the tokens saved in its subtree are the sum of U over its members - U(o) - (n - 1) * P. The leaves in a subtree
are those that its members own. So the trie is built once to see who owns what, and once more with these values in its rows.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Window, functions as F

from millrace.llm.common import ready
from millrace.operators import ordered
from millrace.operators.joins import join_small
from millrace.session import materialise

STRETCH = 64  # turns
SCAN = 4_096  # stretches of a conversation whose heads are computed together
BURST = 2_000  # rows of a container that bursts
IDS_TOGETHER = 200_000  # ids of conversations put in order by one task
KEY = ["k1", "k2"]
HEAD = ["head1", "head2"]


def numbered(conversations: DataFrame) -> DataFrame:
    """`conv_id, place, t1, t2, chars` of every turn: its place in its conversation, digest and code points.

    Order is by turn, NULL first; turns of one number are ordered by their digests. NULL roles and texts are empty. Rows without
    a conv_id belong to no conversation and are left out. A conversation of any length is numbered in slices.
    """
    ready(conversations.sparkSession)
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.coalesce(F.col("turn").cast("bigint"), F.lit(-(2**63))).alias("turn"),
        F.xxhash64(role, text).alias("t1"), F.xxhash64(text, F.lit(1), role).alias("t2"), F.length(text).cast("bigint").alias("chars"))
    sliced = ordered.sliced(rows, "turn")
    counted = ordered.running_sums(sliced, sliced, ["turn", "t1", "t2"], {"place": F.lit(1).cast("bigint")}, ["conv_id"])
    return counted.select("conv_id", (F.col("place") - 1).alias("place"), "t1", "t2", "chars")


def stretches(turns: DataFrame) -> DataFrame:
    """Each conversation in stretches: `conv_id, head1, head2, depth, pre, letters, end1, end2, total`.

    `letters` are the digests and code points of its turns, `head` and `end` the nodes before and after them, `depth` the turns and
    `pre` the code points before them, `total` the code points in them.
    """
    letters = turns.select(
        "conv_id", "place", F.xxhash64("place", "t1", "t2").alias("g1"), F.xxhash64("t2", "place", "t1").alias("g2"), "chars")
    cut = letters.groupBy("conv_id", F.expr(f"place DIV {STRETCH}").alias("nth")).agg(
        F.array_sort(F.collect_list(F.struct("place", "g1", "g2", "chars"))).alias("placed"), F.bit_xor("g1").alias("x1"),
        F.bit_xor("g2").alias("x2"), F.sum("chars").alias("total")).withColumn("part", F.expr(f"nth DIV {SCAN}"))
    cut = materialise(cut, "trie-stretches")
    before = Window.partitionBy("conv_id", "part").orderBy("nth").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("bigint")
    near = cut.select("*", *(F.coalesce(f.over(before), zero).alias(n) for f, n in (
        (F.bit_xor("x1"), "head1"), (F.bit_xor("x2"), "head2"), (F.sum("total"), "pre"))))
    # Only conversations of more than STRETCH * SCAN turns have later parts.
    parts = cut.where("part IS NOT NULL").groupBy("conv_id", "part").agg(
        F.bit_xor("x1").alias("x1"), F.bit_xor("x2").alias("x2"), F.sum("total").alias("total"))
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carry = parts.select("conv_id", "part", F.bit_xor("x1").over(earlier).alias("c1"), F.bit_xor("x2").over(earlier).alias("c2"),
                         F.sum("total").over(earlier).alias("c")).where("part > 0")
    far = near.where("part > 0").join(carry, ["conv_id", "part"]).select(
        *cut.columns, F.col("head1").bitwiseXOR(F.col("c1")).alias("head1"), F.col("head2").bitwiseXOR(F.col("c2")).alias("head2"),
        (F.col("pre") + F.col("c")).alias("pre"))
    return near.where("part = 0").unionByName(far).select(
        "conv_id", *HEAD, (F.col("nth") * STRETCH).alias("depth"), "pre",
        F.transform("placed", lambda p: F.struct(p["g1"].alias("g1"), p["g2"].alias("g2"), p["chars"].alias("chars"))).alias("letters"),
        F.col("head1").bitwiseXOR(F.col("x1")).alias("end1"), F.col("head2").bitwiseXOR(F.col("x2")).alias("end2"), "total")


def containers(pieces: DataFrame) -> DataFrame:
    """Equal stretches under one head as one row, with the sums of what its conversations bear (`u`, `leaves`)."""
    return pieces.groupBy(*HEAD, "depth", "pre", "letters").agg(
        F.count("*").alias("n"), F.min("conv_id").alias("first"), F.sum("u").alias("u"), F.sum("leaves").alias("leaves"))


NODES = ("k1 bigint, k2 bigint, p1 bigint, p2 bigint, depth bigint, pre bigint, chars bigint, n_convs bigint, conv_id bigint, "
         "u bigint, leaves bigint")


def swept(rows: DataFrame) -> DataFrame:
    """Nodes under the heads of small containers: each shard sorts its containers, and a stack follows their rows."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        stack: list = []  # open nodes: letter, then the columns of NODES
        head, out = None, []

        def close(depth: int) -> None:
            while len(stack) > depth:
                _, node = stack.pop()
                out.append(node)
                if stack:
                    above = stack[-1][1]
                    for i in (7, 9, 10):
                        above[i] += node[i]
                    above[8] = min(above[8], node[8])

        def batch_of() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*out), arrow)], schema=arrow)

        for batch in batches:
            out = []
            names = ("head1", "head2", "depth", "pre", "letters", "n", "first", "u", "leaves")
            for h1, h2, depth, pre, letters, n, first, u, leaves in zip(*(batch.column(c).to_pylist() for c in names)):
                same = 0
                if head == (h1, h2):
                    while same < len(stack) and same < len(letters) and stack[same][0] == (letters[same]["g1"], letters[same]["g2"]):
                        same += 1
                close(same)
                head = (h1, h2)
                k1, k2, above = (h1, h2, pre) if not same else (*stack[-1][1][:2], stack[-1][1][5] + stack[-1][1][6])
                for i in range(same, len(letters)):
                    g1, g2, chars = letters[i]["g1"], letters[i]["g2"], letters[i]["chars"]
                    stack.append(((g1, g2), [k1 ^ g1, k2 ^ g2, k1, k2, depth + i + 1, above, chars, 0, first, 0, 0]))
                    k1, k2, above = k1 ^ g1, k2 ^ g2, above + chars
                last = stack[-1][1]
                last[7] += n
                last[8] = min(last[8], first)
                last[9] += u
                last[10] += leaves
            if out:
                yield batch_of()
        out = []
        close(0)
        if out:
            yield batch_of()

    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    arrow = to_arrow_schema(_parse_datatype_string(NODES))
    shards = rows.select(*HEAD, "depth", "pre", "letters", "n", "first", "u", "leaves").repartition(*HEAD)
    return shards.sortWithinPartitions(*HEAD, "letters").mapInArrow(run, NODES)


def built(rows: DataFrame, burst: int) -> DataFrame:
    """Nodes, except the root, of all containers (`containers`): bursts until all are small, then sweeps."""
    level, small, nodes = materialise(rows, "trie-rows"), [], []
    while True:
        # Of a container: the number of its rows, and its first and last in order, which share what all of them share.
        large = level.groupBy(*HEAD).agg(
            F.count("*").alias("rows"), F.min("letters").alias("lo"), F.max("letters").alias("hi"), F.min("depth").alias("at"),
            F.min("pre").alias("above"), F.sum("n").alias("all_n"), F.min("first").alias("all_first"), F.sum("u").alias("all_u"),
            F.sum("leaves").alias("all_leaves")).where(F.col("rows") > burst)
        shared = F.array_position(F.zip_with("lo", "hi", lambda p, q: p.eqNullSafe(q)), False) - 1
        large = materialise(large.withColumn("shared", shared.cast("int")), "trie-large")
        if large.isEmpty():
            small.append(level)
            break

        def along(letters: str, i, part: str, start: str):
            """The key after the first i letters."""
            return F.aggregate(F.slice(letters, 1, i), F.col(start), lambda x, p: x.bitwiseXOR(p[part]))

        def chars(letters: str, i):
            return F.aggregate(F.slice(letters, 1, i), F.lit(0).cast("bigint"), lambda x, p: x + p["chars"])

        one, i = F.lit(1), F.col("i")
        chain = large.select("*", F.explode(F.sequence(F.lit(0), F.col("shared"))).alias("i")).where("i < shared").select(
            along("lo", i + one, "g1", "head1").alias("k1"), along("lo", i + one, "g2", "head2").alias("k2"),
            along("lo", i, "g1", "head1").alias("p1"), along("lo", i, "g2", "head2").alias("p2"),
            (F.col("at") + i + 1).cast("bigint").alias("depth"), (F.col("above") + chars("lo", i)).alias("pre"),
            F.col("lo")[i]["chars"].alias("chars"), F.col("all_n").alias("n_convs"), F.col("all_first").alias("conv_id"),
            F.col("all_u").alias("u"), F.col("all_leaves").alias("leaves"))
        heads = large.select(
            *HEAD, "shared", along("lo", F.col("shared"), "g1", "head1").alias("p1"),
            along("lo", F.col("shared"), "g2", "head2").alias("p2"), chars("lo", F.col("shared")).alias("on_chain"))
        dealt = join_small(level, heads, HEAD)
        small.append(dealt.where("shared IS NULL").select(*level.columns))
        letter = F.col("letters")[F.col("shared")]
        below = dealt.where("size(letters) > shared").select(
            "p1", "p2", F.col("p1").bitwiseXOR(letter["g1"]).alias("head1"), F.col("p2").bitwiseXOR(letter["g2"]).alias("head2"),
            (F.col("depth") + F.col("shared") + 1).alias("depth"), (F.col("pre") + F.col("on_chain")).alias("above"),
            letter["chars"].alias("chars"), (F.col("pre") + F.col("on_chain") + letter["chars"]).alias("pre"),
            F.expr("slice(letters, shared + 2, size(letters))").alias("letters"), "n", "first", "u", "leaves")
        below = materialise(below, "trie-below")
        split = below.groupBy("head1", "head2", "p1", "p2", "depth", "above", "chars").agg(
            F.sum("n").alias("n_convs"), F.min("first").alias("conv_id"), F.sum("u").alias("u"), F.sum("leaves").alias("leaves"))
        nodes += [chain, split.select(F.col("head1").alias("k1"), F.col("head2").alias("k2"), "p1", "p2", "depth",
                                      F.col("above").alias("pre"), "chars", "n_convs", "conv_id", "u", "leaves")]
        level = below.where("size(letters) > 0").select(*level.columns)
    rest = small[0]
    for more in small[1:]:
        rest = rest.unionByName(more)
    out = swept(rest)
    for more in nodes:
        out = out.unionByName(more)
    return out


def _ends(paths: DataFrame) -> DataFrame:
    """For each node at which conversations end, their ids in order as text and its digest: `k1, k2, ends_sha256`.

    The ids of a node are put in order in slices and hashed as a stream, so their number is not bounded by memory.
    """

    def run(batches: Iterator) -> Iterator:
        import hashlib

        import pyarrow as pa

        key, digest = None, None
        schema = pa.schema([("k1", pa.int64()), ("k2", pa.int64()), ("ends_sha256", pa.string())])
        for batch in batches:
            done: list = []
            for k1, k2, text in zip(*(batch.column(c).to_pylist() for c in ("k1", "k2", "text"))):
                if key == (k1, k2):
                    digest.update(b",")
                else:
                    if key is not None:
                        done.append((*key, digest.hexdigest()))
                    key, digest = (k1, k2), hashlib.sha256()
                digest.update(text.encode())
            yield pa.RecordBatch.from_arrays([pa.array([d[i] for d in done], schema.field(i).type) for i in range(3)], schema=schema)
        if key is not None:
            yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip((*key, digest.hexdigest()), schema)], schema=schema)

    sliced = ordered.sliced(paths, "conv_id", rows_per_slice=IDS_TOGETHER)
    texts = sliced.groupBy(*KEY, ordered.SLICE).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda c: c.cast("string")), ",").alias("text"))
    placed = texts.repartition(*KEY).sortWithinPartitions(*KEY, ordered.SLICE)
    return placed.select(*KEY, "text").mapInArrow(run, "k1 bigint, k2 bigint, ends_sha256 string")


def trie(turns: DataFrame, conv_ids: DataFrame, burst: int = BURST) -> DataFrame:
    """One row per node of the trie of conversations, root included.

    `turns` has one row per turn: `conv_id, place` (0, 1, ... without gaps) and the digests and code points of `numbered`;
    `conv_ids` the distinct ids, those of conversations without turns included. Returns `conv_id` (the smallest member), `depth,
    parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256`: saved are, over the subtree, the code points of each
    node's last text for each member but one; ends are the ids of the conversations that end at the node, in order, joined by
    commas. No conversations: no rows. Digests are of 128 bits; two different prefixes of one digest would be one node.
    """
    pieces = materialise(stretches(turns), "trie-pieces")
    zero = F.lit(0).cast("bigint")
    # A path ends where its last stretch does.
    paths = pieces.groupBy("conv_id").agg(F.max(F.struct("depth", "end1", "end2"))["end1"].alias("k1"), F.max(
        F.struct("depth", "end1", "end2"))["end2"].alias("k2"), F.sum("total").alias("total"))
    paths = materialise(conv_ids.join(paths, "conv_id", "left").select(
        "conv_id", *(F.coalesce(c, zero).alias(c) for c in ("k1", "k2", "total"))), "trie-paths")

    owned = materialise(built(containers(pieces.select("*", zero.alias("u"), zero.alias("leaves"))), burst).select(
        *KEY, "p1", "p2", "chars", "conv_id"), "trie-owned")
    children = materialise(owned.groupBy(F.col("p1").alias("k1"), F.col("p2").alias("k2")).agg(F.count("*").alias("n_children")), "trie-children")
    own = owned.join(children, KEY, "left").groupBy("conv_id").agg(
        F.sum("chars").alias("own"), F.count_if(F.col("n_children").isNull()).alias("leaves"))
    borne = materialise(paths.join(own, "conv_id", "left").select(
        "conv_id", (F.col("total") - F.coalesce("own", zero)).alias("u"), F.coalesce("leaves", zero).alias("leaves")), "trie-borne")

    nodes = built(containers(pieces.join(borne, "conv_id")), burst)
    root = borne.groupBy().agg(F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id"), F.sum("u").alias("u"),
                               F.sum("leaves").alias("leaves")).where("n_convs > 0")
    root = root.select(*(zero.alias(c) for c in ("k1", "k2")), *(F.lit(None).cast("bigint").alias(c) for c in ("p1", "p2")),
                       *(zero.alias(c) for c in ("depth", "pre", "chars")), "n_convs", "conv_id", "u", "leaves")
    nodes = materialise(nodes.unionByName(root), "trie-nodes")
    parents = nodes.select(F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv_id").alias("parent_conv_id"))
    owners = borne.select("conv_id", F.col("u").alias("owner_u"))
    childless = F.col("n_children").isNull()
    return nodes.join(children, KEY, "left").join(_ends(paths), KEY, "left").join(parents, ["p1", "p2"], "left").join(
        owners, "conv_id").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", zero).alias("n_children"),
        # A root without children is a leaf that nobody owns.
        F.when(childless, F.lit(1).cast("bigint")).otherwise(F.col("leaves")).alias("n_leaves"),
        (F.col("u") - F.col("owner_u") - (F.col("n_convs") - 1) * F.col("pre")).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"))
