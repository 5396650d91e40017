"""Exact k-nearest-neighbour join (Euclidean distance, ties by lower id), optionally inside groups.

No pair of rows is ever written out: tasks compare blocks of vectors with numpy and emit at most k rows per query.

* Copies are compared once. Equal vectors are collapsed to one vector with its few lowest ids first, so a group of
  copies, however large, costs as much as a single row; the answer is then given to every copy.
* Few donors (size checked): the donor table is shipped to the tasks and each query batch is answered in one pass.
* Otherwise donors are put into cells of about CELL_ROWS by a tree of two levels of pivots, as many as the rows ask for; the
  tree is a table, and queries go down it too. A cell is known by its centre and its radius, so two cells have a least distance.
  Queries first meet the donors of their own cell, then the nearest other cells, and then every cell that is not
  farther than the largest k-th distance their cell has found by then. Donors farther than that from the cell are not sent
  either. Cells of any size are cut into blocks of bounded size by key hash; block results are merged per query.
* Where cells rule out little, as for vectors spread evenly in many dimensions, all rows are compared instead, in a grid of large
  packed blocks: each row is copied to a bounded number of blocks, so only the arithmetic grows with queries x donors.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from millrace.operators.joins import join_small
from millrace.session import materialise

BLOCK_ROWS = 4_096
CHUNK_QUERIES, CHUNK_DONORS = 1_024, 8_192  # rows of one matrix of quick distances
CACHED = 262_144  # quick distances made and looked at together: 1 MB, so that they stay in a core's cache
ALIKE_ROWS = 64  # queries of one missing pattern, at least, that are compared by themselves
HITS = 65_536  # pairs measured exactly at once
TASK_PAIRS = 250_000_000  # pairs for which donors sent whole get one more task
BLOCK_PAIRS = 144  # pairs of blocks, about, into which all pairs of rows are cut
BLOCK_NUMBERS = 3_200_000  # numbers in such a block at most: 26 MB
PIECE_NUMBERS = 262_144  # numbers in one packed value, about
ANSWER_QUERIES = 2_048  # queries, about, whose answers from one block of donors travel as one row
ALL_PAIRS_ROWS = 1_000  # rows in such a block at least, where all rows are compared
FEW_COPIES = 200_000  # donor rows sent to cells that are not worth another plan
CELL_ROWS = 2_000  # distinct donors in a cell, about
TASK_ROWS = 50_000  # rows that one task brings to their pivots
NEAR_CELLS = 4  # other cells a cell is compared with before its reach is taken
SLACK = 1e-9  # far above the rounding error of distances, so no neighbour is lost to it
# Donor tables up to this many numbers (rows x dimensions) are shipped to the tasks: 64 MB of doubles.
SHIPPED_NUMBERS = 8_000_000


def _matrix(vectors) -> np.ndarray:
    return np.array([np.asarray(v, dtype=np.float64) for v in vectors]) if len(vectors) else np.empty((0, 0))


def _squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """All squared distances between the rows of two blocks, quick but with rounding error."""
    return np.maximum((a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2.0 * (a @ b.T), 0.0)


def _chunks(rows: int) -> Iterator[tuple[int, int]]:
    """Cuts of a block of donors: small ones first, so that the k-th distances are small when the long ones come."""
    start = 0
    while start < rows:
        stop = min(rows, start + min(CHUNK_DONORS, max(CHUNK_QUERIES, start)))
        yield start, stop
        start = stop


def _best(key: np.ndarray, rank: np.ndarray, distance: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the k entries of least distance (ties: least rank) of each key, by key; and their place in it."""
    order = np.lexsort((rank, distance, key))
    ordered = key[order]
    first = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]]) if len(ordered) else np.empty(0, np.int64)
    place = np.arange(len(ordered)) - np.repeat(first, np.diff(np.r_[first, len(ordered)]))
    return order[place < k], place[place < k]


def _kth(key: np.ndarray, place: np.ndarray, distance: np.ndarray, k: int, keys: int) -> np.ndarray:
    """The k-th distance of each key, infinite for keys of fewer entries."""
    out = np.full(keys, np.inf)
    out[key[place == k - 1]] = distance[place == k - 1]
    return out


def _set_places(mask: np.ndarray) -> np.ndarray:
    """`flatnonzero` of a mask with few set entries, eight looked at together."""
    flat = mask.ravel()
    whole = len(flat) // 8 * 8
    places = (np.flatnonzero(flat[:whole].view(np.uint64))[:, None] * 8 + np.arange(8)).ravel()
    return np.concatenate([places[flat[places]], whole + np.flatnonzero(flat[whole:])])


def _under(left: np.ndarray, right: np.ndarray, bound: np.ndarray) -> np.ndarray:
    """Where the products of two blocks' rows are no larger than the bound of the left row: left position * len(right) + right position."""
    step = max(1, CACHED // max(1, len(left)))
    parts = [np.empty(0, np.int64)]
    for s in range(0, len(right), step):
        i, j = np.divmod(_set_places(left @ right[s:s + step].T <= bound[:, None]), min(step, len(right) - s))
        parts.append(i * len(right) + s + j)
    return np.concatenate(parts)


def nearest_in_block(queries: np.ndarray, donors: np.ndarray, donor_rank: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Query positions, donor positions and distances of the k nearest donors of each query, as three arrays.

    Donors pass by in chunks, compared with the k-th distance each query has so far; memory is bounded by the chunk. The quick
    distances, in single precision about the donors' mean, only shortlist: everything within their rounding error of the k-th is
    measured exactly. Where that error leaves too much, the chunk is shortlisted again in double precision.
    """
    parts = [(np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))]
    if not len(queries) or not len(donors):
        return parts[0]
    dims, centre = queries.shape[1], donors.mean(0)
    d = donors - centre
    d_square = (d * d).sum(1)
    top_d, top_raw = d_square.max(), (donors * donors).sum(1).max()
    wide_d = np.column_stack([d, d_square])
    thin_d = wide_d.astype(np.float32) if top_d < 1e30 else None
    for s in range(0, len(queries), CHUNK_QUERIES):
        raw = queries[s:s + CHUNK_QUERIES]
        q = raw - centre
        square = (q * q).sum(1)
        wide_q = np.column_stack([-2.0 * q, np.ones(len(q))])
        # Rounding errors of the quick distances in double and in single precision.
        fine = 1e-12 * max(1, dims) * ((raw * raw).sum(1) + top_raw + 1.0)
        rough = fine + 2.0**-22 * (dims + 4) * (square + top_d)
        single = rough.max() < 1e30
        thin_q = wide_q.astype(np.float32) if single else None
        limit = np.full(len(q), np.inf)  # above the k-th squared distance so far, less the query's own square
        at, of, far = parts[0]
        for start, stop in _chunks(len(donors)):
            for thin in ([True, False] if single else [False]):
                error = rough if thin else fine
                left, right = (thin_q, thin_d[start:stop]) if thin else (wide_q, wide_d[start:stop])
                open_ = np.isinf(limit)
                bound = limit + error
                if open_.any() and stop - start > k:
                    bound[open_] = np.partition(left[open_] @ right.T, k - 1, axis=1)[:, k - 1] + 2 * error[open_]
                bound = np.nextafter(bound.astype(np.float32), np.float32(np.inf)) if thin else bound
                hits = _under(left, right, bound)
                if len(hits) <= 16 * k * len(q) + 4096:
                    break
            for h in range(0, len(hits), HITS):
                i, j = np.divmod(hits[h:h + HITS], stop - start)
                j += start
                exact = np.sqrt(((donors[j] - raw[i]) ** 2).sum(1))
                at, of, far = np.r_[at, i], np.r_[of, j], np.r_[far, exact]
                kept, place = _best(at, donor_rank[of], far, k)
                at, of, far = at[kept], of[kept], far[kept]
            if len(hits):
                limit = _kth(at, place, far, k, len(q)) ** 2 - square + fine
        parts.append((at + s, of, far))
    return tuple(np.concatenate(x) for x in zip(*parts))


def _kinds(has: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The patterns of presence, each once, and the number of each row's."""
    bits = np.packbits(has, axis=1)
    _, first, kind = np.unique(bits.view(np.dtype((np.void, bits.shape[1]))).ravel(), return_index=True, return_inverse=True)
    return has[first], kind


def _alike(has: np.ndarray, apart: bool) -> Iterator[tuple[np.ndarray, np.ndarray | None]]:
    """Positions of queries in chunks: those of a frequent pattern by themselves, with it, if `apart`; the others together."""
    kinds, kind = _kinds(has)
    sizes, order, rest = np.bincount(kind), np.argsort(kind, kind="stable"), np.ones(len(has), bool)
    ends = sizes.cumsum()
    for n in np.flatnonzero(sizes >= ALIKE_ROWS) if apart else ():
        rows = order[ends[n] - sizes[n]:ends[n]]
        rest[rows] = False
        for s in range(0, len(rows), CHUNK_QUERIES):
            yield rows[s:s + CHUNK_QUERIES], kinds[n]
    rows = np.flatnonzero(rest)
    for s in range(0, len(rows), CHUNK_QUERIES):
        yield rows[s:s + CHUNK_QUERIES], None


def _masked(wide_q: np.ndarray, wide_d: np.ndarray, shared: np.ndarray, dims: int) -> np.ndarray:
    """Quick squared distances over common columns, scaled, of rows of any patterns; infinite without a common column."""
    quick = wide_q @ wide_d.T
    quick *= quick.dtype.type(dims) / np.maximum(shared, np.float32(1)).astype(quick.dtype)
    if not shared.min():
        quick[shared == 0] = np.inf
    return quick


def nearest_with_gaps(
    queries: np.ndarray, donors: np.ndarray, donor_rank: np.ndarray, k: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Query positions, columns, donor positions and distances, as arrays: for each missing (NaN) entry the k nearest donors that
    have the column.

    Distance is Euclidean over the columns both rows have, scaled up to all columns; rows without a common column are not near.
    All masked distances of two chunks come from one matrix product, and the numbers of common columns from another. Where
    donors have few patterns of gaps, the queries of one pattern are compared by themselves: what a distance lacks is then one
    number for each donor, and one for each query and pattern, so the product is little wider than that of rows without gaps and
    comes out scaled. A donor is looked at only if it is no farther than the k-th so far of one of the query's missing columns,
    and then measured exactly.
    Single and double precision as in `nearest_in_block`.
    """
    parts = [(np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))]
    if not len(queries) or not len(donors):
        return parts[0]
    dims, has_d = queries.shape[1], ~np.isnan(donors)
    centre = np.nan_to_num(donors).sum(0) / np.maximum(has_d.sum(0), 1)
    d = np.where(has_d, donors - centre, 0.0)
    d_square = d * d
    top_d, top_raw = d_square.sum(1).max(), np.nansum(donors * donors, 1).max()
    (kinds, kind), has_f, single_d = _kinds(has_d), has_d.astype(np.float32), top_d < 1e30
    numbers = (np.float64, np.float32) if single_d else (np.float64,)
    plain = {n: (d.astype(n), np.eye(len(kinds), dtype=n)) for n in numbers} if len(kinds) <= dims else {}
    wide_d = {}
    for at_q, has in _alike(~np.isnan(queries), bool(plain)):
        raw = queries[at_q]
        has_q = ~np.isnan(raw)
        q = np.where(has_q, raw - centre, 0.0)
        square = q * q
        if has is None:
            wide_d = wide_d or {n: np.hstack([has_d, d_square, d]).astype(n) for n in numbers}
            wide_q = np.hstack([square, has_q, -2.0 * q])
        else:  # what the columns without either lack: by query and pattern of the donor, and by donor
            common = (kinds & has).sum(1)
            scales = (dims / np.maximum(common, 1))[kind]
            own = np.where((common > 0)[kind], d_square @ has, np.inf) * scales
            wide_q = np.hstack([-2.0 * q, square @ kinds.T, np.ones((len(q), 1))])
        fine = 1e-12 * dims * dims * (np.nansum(raw * raw, 1) + top_raw + 1.0)
        rough = 2.0**-22 * (3 * dims + 4) * (square.sum(1) + top_d)  # before scaling
        single = single_d and rough.max() < 1e28
        thin_q, thin_has_q, gaps = wide_q.astype(np.float32) if single else None, has_q.astype(np.float32), (~has_q).sum(1).max()
        lacking = np.flatnonzero(~has_q.all(0))
        limit = np.where(has_q, -np.inf, np.inf)  # of each query and missing column: above its k-th squared distance so far
        key, of, far = parts[0][0], parts[0][1], parts[0][3]  # key: query position * dims + column
        for start, stop in _chunks(len(donors)):
            here, opened = has_d[start:stop], np.flatnonzero((limit == np.inf).any(0))  # columns for which k donors are not found yet
            if has is None:
                shared = thin_has_q @ has_f[start:stop].T
                top_scale = dims / max(1.0, float(shared.min()))
            else:
                top_scale = scales[start:stop].max()
            for thin in ([True, False] if single else [False]):
                number = np.float32 if thin else np.float64
                left = thin_q if thin else wide_q
                error = fine + rough * top_scale if thin else fine
                bound = np.where(np.isinf(limit), -np.inf, limit).max(1) + error
                bound = np.nextafter(bound.astype(np.float32), np.float32(np.inf)) if thin else bound
                if has is None:
                    quick = _masked(left, wide_d[number][start:stop], shared, dims)
                    found = [_set_places(quick <= bound[:, None])]
                else:
                    points, table = plain[number]
                    stretch = scales[start:stop, None].astype(number)
                    right = np.hstack([points[start:stop] * stretch, table[kind[start:stop]] * stretch, own[start:stop, None].astype(number)])
                    quick = left @ right.T if len(opened) else None
                    found = [_under(left, right, bound)]
                for t in opened:
                    able, rows = np.flatnonzero(here[:, t]), np.flatnonzero(limit[:, t] == np.inf)
                    if len(able):
                        some = quick[np.ix_(rows, able)]
                        kth = min(k, len(able)) - 1
                        upto = np.minimum(np.partition(some, kth, axis=1)[:, kth] + 2 * error[rows], np.finfo(number).max)
                        i, j = np.nonzero(some <= upto[:, None])
                        found.append(rows[i] * (stop - start) + able[j])
                hits = np.unique(np.concatenate(found)) if len(found) > 1 else found[0]
                if len(hits) <= 16 * k * gaps * len(q) + 4096:
                    break
            for h in range(0, len(hits), HITS):
                i, j = np.divmod(hits[h:h + HITS], stop - start)
                j += start
                both = has_q[i] & has_d[j]
                n = both.sum(1)
                exact = np.sqrt((np.where(both, donors[j] - raw[i], 0.0) ** 2).sum(1) * (dims / np.maximum(n, 1)))
                near = np.flatnonzero((n > 0) & (exact**2 <= limit.max(1)[i] + fine[i]))
                i, j, exact = i[near], j[near], exact[near]
                at = (i[:, None], lacking)
                wanted = ~has_q[at] & has_d[j[:, None], lacking] & (exact[:, None] ** 2 <= limit[at] + fine[i][:, None])
                pair, t = np.nonzero(wanted)
                t = lacking[t]
                key, of, far = np.r_[key, i[pair] * dims + t], np.r_[of, j[pair]], np.r_[far, exact[pair]]
                kept, place = _best(key, donor_rank[of], far, k)
                key, of, far = key[kept], of[kept], far[kept]
            if len(hits):
                kths = _kth(key, place, far, k, len(q) * dims).reshape(len(q), dims) ** 2 + fine[:, None]
                limit = np.where(has_q, -np.inf, kths)
        parts.append((at_q[key // dims], key % dims, of, far))
    return tuple(np.concatenate(x) for x in zip(*parts))


def _tasks(spark: SparkSession, pairs: int) -> int:
    """As many tasks as the pairs ask for: a small table of vectors can mean much work."""
    return max(math.ceil(pairs / TASK_PAIRS), min(spark.sparkContext.defaultParallelism, math.ceil(pairs / 1_000_000)), 1)


def _packed(rows: DataFrame, blocks: DataFrame, dims: int) -> DataFrame:
    """Rows (`grp, rep, vec`, NULL parts as NaN) as few large values: `grp, block, reps, points`, bytes of up to about PIECE_NUMBERS numbers.

    `blocks` has `grp, blocks, pieces`: into how many blocks a group is dealt by key hash, and a block into pieces.
    """
    piece = F.pmod(F.xxhash64("rep"), (F.col("blocks") * F.col("pieces")).cast("bigint"))
    dealt = join_small(rows, blocks, ["grp"]).select("grp", "rep", "vec", "pieces", piece.alias("piece"))

    def pack(part: pd.DataFrame) -> pd.DataFrame:
        points = _matrix(part["vec"].tolist())
        return pd.DataFrame({"grp": [part["grp"].iloc[0]], "block": [int(part["piece"].iloc[0] // part["pieces"].iloc[0])],
                             "reps": [part["rep"].to_numpy(np.int64).tobytes()], "points": [points.tobytes()]})

    done = dealt.groupBy("grp", "piece").applyInPandas(pack, "grp string, block int, reps binary, points binary")
    return materialise(done, "knn-packed")


def _unpacked(part: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    reps = np.frombuffer(b"".join(part["reps"]), np.int64)
    return reps, np.frombuffer(b"".join(part["points"])).reshape(len(reps), -1) if len(reps) else np.empty((0, 0))


def _block_size(pairs: float, dims: int, block_rows: int) -> int:
    return max(1, min(BLOCK_NUMBERS // max(dims, 1), max(block_rows, math.isqrt(math.ceil(pairs / BLOCK_PAIRS)))))


def _plan(sizes: DataFrame, pairs: float, dims: int, block_rows: int) -> tuple[DataFrame, DataFrame]:
    """Blocks of the queries and of the donors of each group (`grp, n_q, n_d`), for all pairs of blocks of a group to be compared.

    Blocks have `block_rows` rows, and grow with the tables, so that a row is copied to about sqrt(BLOCK_PAIRS) blocks however many rows there are, until they
    hold BLOCK_NUMBERS numbers: from there on the copies grow with the rows, as the work does.
    """
    rows = _block_size(pairs, dims, block_rows)

    def side(n: str) -> DataFrame:
        blocks = F.ceil(F.col(n) / rows)
        return sizes.where(F.col(n) > 0).select("grp", blocks.cast("int").alias("blocks"),
                                                F.ceil(F.col(n) * dims / blocks / PIECE_NUMBERS).cast("int").alias("pieces"))

    return side("n_q"), side("n_d")


def _dealt(ids: np.ndarray, parts: int) -> list[tuple[int, np.ndarray]]:
    """Positions of the ids, dealt by key into `parts` parts; a part without any is left out, except that there is always one."""
    part = (ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(40)) % np.uint64(parts)
    order = np.argsort(part, kind="stable")
    cuts = np.searchsorted(part[order], np.arange(parts + 1, dtype=np.uint64))
    return [(n, order[cuts[n]:cuts[n + 1]]) for n in range(parts) if cuts[n] < cuts[n + 1] or parts == 1] or [(0, order)]


def _met(q: DataFrame, d: DataFrame, plan: tuple[DataFrame, DataFrame], dims: int, compare, merged, schema: str) -> DataFrame:
    """Each block of queries with each block of donors of its group, once: `compare(reps, points, donor reps, donor points)` gives
    columns of numbers, `merged(columns)` the final ones of all answers to one block of queries.

    Answers travel as a few large values, those of about ANSWER_QUERIES queries to a row, dealt by key: the answers to a whole block
    would be rows of tens of MB, of which readers and shuffles hold many at once. Only the merged answers are stored.
    """
    plan = tuple(materialise(side, "knn-plan") for side in plan)
    left = _packed(q, plan[0], dims)
    right = left if q is d else _packed(d, plan[1], dims)
    across = [side.select("grp", F.col("blocks").alias("_other")) for side in plan]
    key = ["grp", "qb", "db"]

    def spread(packed: DataFrame, own: str, other: str, sizes: DataFrame) -> DataFrame:
        return join_small(packed, sizes, ["grp"], "inner").select(
            "grp", F.col("block").alias(own), F.explode(F.sequence(F.lit(0), F.col("_other") - 1)).alias(other), "reps", "points")

    names = [c.split()[0] for c in schema.split(", ")]

    def meet(k: tuple, a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        if not len(a) or not len(b):
            return pd.DataFrame({"grp": [], "qb": [], "part": [], **{n: [] for n in names}}).astype({"qb": np.int32, "part": np.int32})
        ids, points = _unpacked(a)
        found = compare(ids, points, *_unpacked(b))
        return pd.DataFrame([{"grp": k[0], "qb": k[1], "part": part, **{n: found[n][rows].tobytes() for n in names}}
                             for part, rows in _dealt(found[names[0]], math.ceil(len(ids) / ANSWER_QUERIES))])

    met = spread(left, "qb", "db", across[1]).groupBy(*key).cogroup(_again(spread(right, "db", "qb", across[0])).groupBy(*key)).applyInPandas(
        meet, "grp string, qb int, part int, " + ", ".join(f"{n} binary" for n in names))
    kinds = {c.split()[0]: {"bigint": np.int64, "int": np.int32, "double": np.float64}[c.split()[1]] for c in schema.split(", ")}

    def merge(k: tuple, part: pd.DataFrame) -> pd.DataFrame:
        done = merged({n: np.frombuffer(b"".join(part[n]), kind) for n, kind in kinds.items()})
        return pd.DataFrame({"grp": k[0], **done})

    return materialise(met.groupBy("grp", "qb", "part").applyInPandas(merge, "grp string, " + schema), "knn-merged")


def _all_pairs(q: DataFrame, d: DataFrame, sizes: DataFrame, pairs: float, dims: int, k: int, block_rows: int) -> DataFrame:
    """The k nearest donors of each query by comparing all rows of a group."""

    def compare(ids, points, reps, donors):
        i, j, far = nearest_in_block(points, donors, reps, k)
        return {"rep": ids[i], "donor": reps[j], "distance": far}

    def merged(found):
        kept, _ = _best(found["rep"], found["donor"], found["distance"], k)
        return {n: v[kept] for n, v in found.items()}

    return _met(q, d, _plan(sizes, pairs, dims, block_rows), dims, compare, merged, "rep bigint, donor bigint, distance double")


def _gaps_packed(queries: DataFrame, donors: DataFrame, n: int, size, k: int, block_rows: int) -> DataFrame:
    """`knn_with_gaps` of tables too large to ship."""

    def rows(df: DataFrame) -> DataFrame:
        return df.select(F.lit("all").alias("grp"), F.col("id").alias("rep"), "vec")

    def compare(ids, points, reps, others):
        i, t, j, far = nearest_with_gaps(points, others, reps, k)
        return {"query_id": ids[i], "target": t.astype(np.int32), "donor_id": reps[j], "distance": far, "value": others[j, t]}

    def merged(found):
        key = np.unique(found["query_id"], return_inverse=True)[1] * (int(found["target"].max(initial=0)) + 1) + found["target"]
        kept, _ = _best(key, found["donor_id"], found["distance"], k)
        return {c: v[kept] for c, v in found.items()}

    sizes = queries.sparkSession.range(1).select(F.lit("all").alias("grp"), F.lit(n).alias("n_q"), F.lit(size["n"]).alias("n_d"))
    schema = "query_id bigint, target int, donor_id bigint, distance double, value double"
    plan = _plan(sizes, n * size["n"], size["dims"], block_rows)
    return _met(rows(queries), rows(donors), plan, size["dims"], compare, merged, schema).drop("grp")


def knn_with_gaps(
    queries: DataFrame, donors: DataFrame, k: int, shipped_numbers: int = SHIPPED_NUMBERS, block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """(query_id, target, donor_id, distance, value) for every missing entry of the queries: the k nearest rows that have it.

    Both tables have `id bigint` and `vec array<double>` of one length, with NULL or NaN for what is missing; `target` is the
    position in the vector, `value` the donor's. Few donors (size checked) are shipped once; otherwise both tables are cut into
    blocks of `block_rows` rows or more (see `_plan`), each block of queries meets one copy of every block of donors, and block
    results are merged. A masked distance obeys no triangle inequality, so no block can be left out: the work is queries x donors.
    """
    spark = queries.sparkSession
    donors = materialise(donors.select("id", "vec").where(F.exists("vec", lambda x: x.isNotNull() & ~F.isnan(x))), "gap-donors")
    gappy = F.exists("vec", lambda x: x.isNull() | F.isnan(x)) & F.exists("vec", lambda x: x.isNotNull() & ~F.isnan(x))
    queries = queries.select("id", "vec").where(gappy)
    schema = "query_id bigint, target int, donor_id bigint, distance double, value double"
    size = donors.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("vec")).alias("dims")).first()

    def answered(a: pd.DataFrame, ids: np.ndarray, points: np.ndarray) -> pd.DataFrame:
        i, t, j, far = nearest_with_gaps(_matrix(a["vec"].tolist()), points, ids, k)
        return pd.DataFrame({"query_id": a["id"].to_numpy(np.int64)[i], "target": t, "donor_id": ids[j], "distance": far, "value": points[j, t]})

    if not size["n"]:
        return spark.createDataFrame([], schema)
    if size["n"] * size["dims"] <= shipped_numbers:
        pdf = donors.toPandas()
        shared = spark.sparkContext.broadcast((pdf["id"].to_numpy(np.int64), _matrix(pdf["vec"].tolist())))

        def answer(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                yield answered(batch, *shared.value)

        return queries.repartition(_tasks(spark, queries.count() * size["n"]), "id").mapInPandas(answer, schema)
    queries = materialise(queries, "gap-queries")
    n = queries.count()
    return _gaps_packed(queries, donors, n, size, k, block_rows) if n else spark.createDataFrame([], schema)


def _complete(df: DataFrame) -> DataFrame:
    """Rows that can be compared: those with a vector that has no missing part."""
    return df.where(F.col("vec").isNotNull() & F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x)))


def _collapse(df: DataFrame, keep: int) -> DataFrame:
    """One row per distinct (group, vector): its lowest id and its `keep` lowest ids."""
    w = Window.partitionBy("grp", "vec").orderBy("id")
    lowest = df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= keep)
    return lowest.groupBy("grp", "vec").agg(F.array_sort(F.collect_list("id")).alias("ids")).withColumn(
        "rep", F.col("ids")[0])


def knn_join(
    queries: DataFrame, donors: DataFrame, k: int, exclude_self: bool = False,
    shipped_numbers: int = SHIPPED_NUMBERS, block_rows: int = BLOCK_ROWS, cell_rows: int = CELL_ROWS, report: list | None = None,
) -> DataFrame:
    """(grp, query_id, donor_id, distance, rank) for the k nearest donors of every query row.

    Both tables have `id bigint`, `vec array<double>` and `grp string` (queries only meet donors of their group).
    With `exclude_self` a row is not its own neighbour (same id). A row whose vector is missing or has a missing part, NULL or
    NaN, has no neighbours and is nobody's neighbour. `report`, if given, gets for each round of the large path the number
    of cells, of pairs of cells and of donor rows sent.
    """
    spark = queries.sparkSession
    alone = queries is donors
    donors = _complete(donors)
    queries = donors if alone else _complete(queries)
    wanted = k + 1 if exclude_self else k
    d = materialise(_collapse(donors.select("id", "vec", "grp"), wanted), "donors")
    q = d if queries is donors else _collapse(queries.select("id", "vec", "grp"), 1)
    q = q.select("grp", "vec", "rep")
    size = d.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("vec")).alias("dims")).first()
    if not size["n"]:
        return spark.createDataFrame([], "grp string, query_id bigint, donor_id bigint, distance double, rank int")
    if size["n"] * size["dims"] <= shipped_numbers:
        found = _shipped(spark, q, d, wanted)
    else:
        d_rows = d.select("grp", "rep", "vec")
        q_rows = d_rows if queries is donors else materialise(q.select("grp", "rep", "vec"), "queries")
        found = _blocked(q_rows, d_rows, wanted, block_rows, cell_rows, size["dims"], report)
    return _listed(found, q, d, queries, k, exclude_self)


def _listed(found: DataFrame, q: DataFrame, d: DataFrame, queries: DataFrame, k: int, exclude_self: bool) -> DataFrame:
    """Give each query row its vector's answer (rep, donor rep, distance for distinct vectors), and list the copies of donors."""
    near = found.join(d.select(F.col("rep").alias("donor"), "grp", "ids"), ["grp", "donor"])
    reps = queries.select("id", "vec", "grp").join(q, ["grp", "vec"]).select(F.col("id").alias("query_id"), "grp", "rep")
    rows = reps.join(near, ["grp", "rep"]).select("grp", "query_id", F.explode("ids").alias("donor_id"), "distance")
    if exclude_self:
        rows = rows.where("query_id <> donor_id")
    w = Window.partitionBy("grp", "query_id").orderBy("distance", "donor_id")
    return rows.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


FOUND = "grp string, rep bigint, donor bigint, distance double"


def _shipped(spark: SparkSession, q: DataFrame, d: DataFrame, k: int) -> DataFrame:
    """Donors of a checked size go to every task as one broadcast value."""
    pdf = d.select("grp", "rep", "vec").toPandas()
    table = {g: (_matrix(part["vec"].tolist()), part["rep"].to_numpy(np.int64)) for g, part in pdf.groupby("grp")}
    shared = spark.sparkContext.broadcast(table)

    def answer(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for g, part in batch.groupby("grp"):
                if g not in shared.value:
                    continue
                vectors, reps = shared.value[g]
                i, j, far = nearest_in_block(_matrix(part["vec"].tolist()), vectors, reps, k)
                out.append(pd.DataFrame({"grp": g, "rep": part["rep"].to_numpy(np.int64)[i], "donor": reps[j], "distance": far}))
            if out:
                yield pd.concat(out)

    return q.repartition(_tasks(spark, q.count() * len(pdf)), "grp", "rep").mapInPandas(answer, FOUND)


def _sizes(df: DataFrame, key: Sequence[str], rows_per: int, out: str) -> DataFrame:
    """Rows of each key, and into how many parts of `rows_per` they are cut."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).withColumn(out, F.ceil(F.col("n") / rows_per).cast("int"))


def _pivots(rows: DataFrame, key: Sequence[str], wanted: Column, salt: int) -> DataFrame:
    """About `wanted` rows of each key (an expression of its size n), at least one, chosen by key hash: `key, pivot, centre`."""
    draw = F.xxhash64(F.lit(salt), "rep")
    sizes = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("n"), F.min(F.struct(draw, "rep"))["rep"].alias("_least"))
    share = F.pmod(draw, F.lit(1 << 52)) / F.lit(2.0**52)
    chosen = join_small(rows, sizes.withColumn("_share", wanted / F.col("n")), key).where(
        (share < F.col("_share")) | (F.col("rep") == F.col("_least")))
    return chosen.select(*key, F.col("rep").alias("pivot"), F.col("vec").alias("centre"))


def _to_nearest(rows: DataFrame, pivots: DataFrame, key: Sequence[str], out: str, far: str) -> DataFrame:
    """Adds the nearest pivot of the row's key and the distance to it. Keys of any size are cut into parts of bounded size."""
    parts = materialise(_sizes(rows, key, TASK_ROWS, "_parts").drop("n"), "knn-parts")
    left = join_small(rows, parts, key).withColumn("_part", F.pmod(F.xxhash64("rep"), F.col("_parts")).cast("int")).drop("_parts")
    right = pivots.join(parts, list(key)).withColumn("_part", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1))).drop("_parts")
    schema = rows.select("*", F.lit(0).cast("bigint").alias(out), F.lit(0.0).alias(far)).schema
    names = rows.columns

    def nearest(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        if not len(a) or not len(b):
            return a[names].iloc[:0].assign(**{out: np.empty(0, np.int64), far: np.empty(0)})
        points, centres, ids = _matrix(a["vec"].tolist()), _matrix(b["centre"].tolist()), b["pivot"].to_numpy(np.int64)
        best = np.concatenate([_squared(points[s:s + 2048], centres).argmin(1) for s in range(0, len(points), 2048)])
        return a[names].assign(**{out: ids[best], far: np.sqrt(((points - centres[best]) ** 2).sum(1))})

    by = [*key, "_part"]
    return left.groupBy(*by).cogroup(right.groupBy(*by)).applyInPandas(nearest, schema)


def _celled(rows: DataFrame, tops: DataFrame, cells: DataFrame) -> DataFrame:
    first = materialise(_to_nearest(rows, tops, ["grp"], "top", "far_top"), "knn-top")
    return materialise(_to_nearest(first, cells, ["grp", "top"], "cell", "far"), "knn-cell")


def _again(df: DataFrame) -> DataFrame:
    """The same columns as new ones, so both sides of a cogroup may come from one table."""
    return df.select(*[F.col(c).alias(c) for c in df.columns])


def _close(a: pd.DataFrame, b: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Distances between the centres of two tables of cells, and below which no two of their rows can be."""
    gap = np.sqrt(((_matrix(a["centre"].tolist())[:, None, :] - _matrix(b["centre"].tolist())[None, :, :]) ** 2).sum(2))
    return gap, gap * (1 - SLACK) - SLACK - (a["radius"].to_numpy()[:, None] + b["radius"].to_numpy()[None, :]) * (1 + SLACK)


def _cell_pairs(tops_q: DataFrame, tops_d: DataFrame, cells_q: DataFrame, cells_d: DataFrame, k: int, counted: bool = False) -> DataFrame:
    """`grp, cell, donor_cell, gap, bound`: donor cells that may hold one of the k nearest donors of a query of the cell; with
    `counted` only `copies`, how many donor rows these pairs of cells would send, in parts.

    `reach` of the query tables is the largest k-th distance found so far. Cells under two upper pivots are looked at only where
    those may be close enough. `bound` is the reach, or what upper cells near by promise if that is less.
    """
    salted = tops_q.withColumn("_part", F.pmod(F.xxhash64("top"), F.ceil(F.count(F.lit(1)).over(Window.partitionBy("grp")) / 256)))
    parts = _again(salted.select("grp", "_part").distinct())

    def tops(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        if not len(a) or not len(b):
            return pd.DataFrame({"grp": [], "top": [], "donor_top": [], "limit": []}).astype({"top": np.int64, "donor_top": np.int64})
        gap, least = _close(a, b)
        # All donors under a pivot are within gap + its radius of the query pivot: the first of them that hold k rows bound the k-th.
        most = gap + b["radius"].to_numpy()[None, :]
        order = most.argsort(1)
        held = b["n"].to_numpy()[order].cumsum(1)
        enough = held >= k
        at = np.take_along_axis(most, order, 1)[np.arange(len(a)), enough.argmax(1)]
        promised = np.where(enough.any(1), (at + a["radius"].to_numpy()) * (1 + SLACK) + SLACK, np.inf)
        limit = np.minimum(a["reach"].to_numpy(), promised)
        i, j = np.nonzero(least <= limit[:, None])
        return pd.DataFrame({"grp": a["grp"].iloc[0], "top": a["top"].to_numpy()[i], "donor_top": b["top"].to_numpy()[j], "limit": limit[i]})

    upper = salted.groupBy("grp", "_part").cogroup(tops_d.join(parts, "grp").groupBy("grp", "_part")).applyInPandas(
        tops, "grp string, top bigint, donor_top bigint, limit double")
    upper = materialise(upper, "knn-upper")

    def cells(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        names = ["grp", "cell", "donor_cell", "gap", "bound"]
        if not len(a) or not len(b):
            return pd.DataFrame({n: [] for n in names}).astype({"cell": np.int64, "donor_cell": np.int64})
        out, limit = [], np.minimum(a["reach"].to_numpy(), a["limit"].to_numpy())
        for s in range(0, len(a), 256):
            gap, least = _close(a.iloc[s:s + 256], b)
            i, j = np.nonzero(least <= limit[s:s + 256, None])
            out.append(pd.DataFrame({"grp": a["grp"].iloc[0], "cell": a["cell"].to_numpy()[s + i], "donor_cell": b["cell"].to_numpy()[j],
                                     "gap": gap[i, j], "bound": limit[s + i]}))
        return pd.concat(out)[names]

    def copies(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        if not len(a) or not len(b):
            return pd.DataFrame({"copies": np.empty(0, np.int64)})
        found = cells(a, b)
        return pd.DataFrame({"copies": [int(b.set_index("cell")["n"].reindex(found["donor_cell"]).sum())]})

    key = ["grp", "top", "donor_top"]
    left = cells_q.join(upper, ["grp", "top"])
    right = cells_d.withColumnRenamed("top", "donor_top").join(_again(upper.select(*key)), ["grp", "donor_top"])
    both = left.groupBy(*key).cogroup(right.groupBy(*key))
    return both.applyInPandas(copies, "copies bigint") if counted else both.applyInPandas(
        cells, "grp string, cell bigint, donor_cell bigint, gap double, bound double")


def _compared(queries: DataFrame, donors: DataFrame, pairs: DataFrame, cells_q: DataFrame, cells_d: DataFrame, k: int, block_rows: int):
    """The k nearest donors of each query within the listed pairs of cells, a few for each block; and how many donor rows are sent."""
    sized = pairs.join(cells_d.select("grp", F.col("cell").alias("donor_cell"), F.col("n").alias("n_d")), ["grp", "donor_cell"])
    blocks = sized.groupBy("grp", "cell").agg(F.sum("n_d").alias("sent")).join(
        cells_q.select("grp", "cell", "n", "centre", "radius"), ["grp", "cell"]).select(
        "grp", "cell", "centre", "radius", F.ceil(F.col("n") / block_rows).cast("int").alias("qblocks"),
        F.ceil(F.col("sent") / block_rows).cast("int").alias("dblocks"))
    blocks = materialise(blocks, "knn-blocks")
    own = queries.join(blocks.drop("centre", "radius"), ["grp", "cell"]).select(
        "grp", "cell", "vec", "rep", F.pmod(F.xxhash64("rep"), F.col("qblocks")).cast("int").alias("qb"),
        F.explode(F.sequence(F.lit(0), F.col("dblocks") - 1)).alias("db"))
    away = F.sqrt(F.aggregate(F.zip_with("vec", "centre", lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, v: s + v))
    sent = donors.select("grp", F.col("cell").alias("donor_cell"), "vec", "rep").join(pairs, ["grp", "donor_cell"]).join(
        blocks, ["grp", "cell"]).where(away <= (F.col("radius") + F.col("bound")) * (1 + SLACK) + SLACK).select(
        "grp", "cell", "vec", "rep", F.pmod(F.xxhash64("rep"), F.col("dblocks")).cast("int").alias("db"), "qblocks")
    sent = materialise(sent, "knn-sent")
    copied = sent.withColumn("qb", F.explode(F.sequence(F.lit(0), F.col("qblocks") - 1)))
    key = ["grp", "cell", "qb", "db"]

    def compare(group_key, a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        ids, reps = a["rep"].to_numpy(np.int64), b["rep"].to_numpy(np.int64)
        i, j, far = nearest_in_block(_matrix(a["vec"].tolist()), _matrix(b["vec"].tolist()), reps, k)
        return pd.DataFrame({"grp": group_key[0], "rep": ids[i], "donor": reps[j], "distance": far})

    return own.groupBy(*key).cogroup(copied.groupBy(*key)).applyInPandas(compare, FOUND), sent


def _whole(cells_q: DataFrame, cells_d: DataFrame, dims: int) -> tuple[DataFrame, dict]:
    """Rows of each group on both sides; and the pairs of rows, and the copies of rows that comparing all of them takes."""
    side = lambda cells, n: cells.groupBy("grp").agg(F.sum("n").alias(n))
    sizes = materialise(side(cells_q, "n_q").join(side(cells_d, "n_d"), "grp"), "knn-sizes")
    pairs = sizes.agg(F.sum(F.col("n_q").cast("double") * F.col("n_d"))).first()[0] or 0.0
    rows = _block_size(pairs, dims, ALL_PAIRS_ROWS)
    copies = sizes.agg(F.sum(F.col("n_q") * F.ceil(F.col("n_d") / rows) + F.col("n_d") * F.ceil(F.col("n_q") / rows))).first()[0] or 0
    return sizes, {"pairs": pairs, "copies": copies}


def _plain(queries: DataFrame, donors: DataFrame) -> tuple[DataFrame, DataFrame]:
    rows = donors.select("grp", "rep", "vec")
    return (rows if queries is donors else queries.select("grp", "rep", "vec")), rows


def _blocked(q: DataFrame, d: DataFrame, k: int, block_rows: int, cell_rows: int, dims: int, report: list | None) -> DataFrame:
    """Round by round: own cells, then the nearest other cells, then all that the k-th distances found by then leave.

    Where they leave so much that cells would be sent more donor rows than a comparison of everything takes, all rows are compared.
    """
    tops = materialise(_pivots(d, ["grp"], F.sqrt(F.col("n") / cell_rows), 1), "knn-tops")
    first = materialise(_to_nearest(d, tops, ["grp"], "top", "far_top"), "knn-first")
    cells = materialise(_pivots(first, ["grp", "top"], F.col("n") / cell_rows, 2), "knn-cells")
    donors = materialise(_to_nearest(first, cells, ["grp", "top"], "cell", "far"), "knn-donors")
    # An upper pivot that is itself under another one, by rounding, would lead queries nowhere.
    tops = tops.join(cells.select("grp", F.col("top").alias("pivot")).distinct(), ["grp", "pivot"], "left_semi")
    queries = donors if q is d else _celled(q, tops, cells)

    def stats(rows: DataFrame, key: list[str], far: str, pivots: DataFrame, *more: Column) -> DataFrame:
        found = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("n"), F.max(far).alias("radius"), *more)
        return found.join(pivots.select("grp", F.col("pivot").alias(key[-1]), "centre"), ["grp", key[-1]])

    cells_d = materialise(stats(donors, ["grp", "top", "cell"], "far", cells), "knn-cells-d")
    tops_d = materialise(stats(donors, ["grp", "top"], "far_top", tops), "knn-tops-d")
    by_query = Window.partitionBy("grp", "rep").orderBy("distance", "donor")
    sizes, whole = _whole(cells_q=stats(queries, ["grp", "top", "cell"], "far", cells), cells_d=cells_d, dims=dims)
    found, done = None, None
    for step in ("own", "near", "rest"):
        reach = F.lit(math.inf)
        rows = queries
        if found is not None:
            kth = found.groupBy("grp", "rep").agg(F.when(F.count(F.lit(1)) >= k, F.max("distance")).alias("kth"))
            rows, reach = queries.join(kth, ["grp", "rep"], "left"), F.coalesce("kth", F.lit(math.inf))
        reach = F.max(reach).alias("reach")
        cells_q = materialise(stats(rows, ["grp", "top", "cell"], "far", cells, reach), "knn-cells-q")
        if step == "own":
            pairs = cells_q.select("grp", "cell", "reach").join(cells_d.select("grp", "cell"), ["grp", "cell"]).select(
                "grp", "cell", F.col("cell").alias("donor_cell"), F.lit(0.0).alias("gap"), F.col("reach").alias("bound"))
        else:
            tops_q = materialise(stats(rows, ["grp", "top"], "far_top", tops, reach), "knn-tops-q")
            if step == "near":
                copies = _cell_pairs(tops_q, tops_d, cells_q, cells_d, k, counted=True).agg(F.sum("copies")).first()[0] or 0
                if copies > max(FEW_COPIES, 2 * whole["copies"]):
                    if report is not None:
                        report.append({"round": "all", "cells": cells_q.count(), "copies": whole["copies"]})
                    return _all_pairs(*_plain(queries, donors), sizes, whole["pairs"], dims, k, ALL_PAIRS_ROWS)
            pairs = _cell_pairs(tops_q, tops_d, cells_q, cells_d, k)
            pairs = pairs.join(done, ["grp", "cell", "donor_cell"], "left_anti")
            if step == "near":
                w = Window.partitionBy("grp", "cell").orderBy("gap", "donor_cell")
                pairs = pairs.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= NEAR_CELLS).drop("_rn")
        pairs = materialise(pairs, f"knn-pairs-{step}")
        if pairs.isEmpty():
            continue
        partial, sent = _compared(queries, donors, pairs, cells_q, cells_d, k, block_rows)
        if report is not None:
            report.append({"round": step, "cells": cells_q.count(), "pairs": pairs.count(), "copies": sent.count()})
        every = partial if found is None else found.unionByName(partial)
        found = materialise(every.withColumn("_rn", F.row_number().over(by_query)).where(F.col("_rn") <= k).drop("_rn"), "knn-found")
        links = pairs.select("grp", "cell", "donor_cell")
        done = links if done is None else done.unionByName(links)
    return found


def vectors(df: DataFrame, key: str, columns: Sequence[str], group: str | None = None) -> DataFrame:
    """Rows in the shape `knn_join` takes, from plain numeric columns; stored, as they are read several times.

    Storing also keeps filters on the vector from being pushed through a projection of very many columns, where the optimizer would
    try every mixture of the columns and what they are made from.
    """
    vec = F.array(*[F.col(c).cast("double") for c in columns])
    grp = F.coalesce(F.col(group).cast("string"), F.lit("\x00missing")) if group else F.lit("all")
    return materialise(df.select(F.col(key).cast("bigint").alias("id"), vec.alias("vec"), grp.alias("grp")), "vectors")
