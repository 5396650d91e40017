"""The prefix trie against a plain trie and against SQL."""

import hashlib
import random
import zlib
from collections import defaultdict

import duckdb
import pytest

from millrace.llm import prefix_trie, queries

SCHEMA = "conv_id bigint, turn bigint, role string, text string, place string, letters string, depth string"


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", "z") for r in rows], SCHEMA).repartition(3)


def plain(paths):
    """Rows of the contract for conversations given as {conv_id: [(role, text), ...]}."""
    members, ends = defaultdict(list), defaultdict(list)
    for c, path in paths.items():
        for d in range(len(path) + 1):
            members[tuple(path[:d])].append(c)
        ends[tuple(path)].append(c)
    children, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for node in members:
        if node:
            children[node[:-1]] += 1
    for node, own in members.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] += not children.get(node, 0)
            saved[node[:d]] += (len(own) - 1) * len(node[-1][1]) if node else 0
    return sorted((min(own), len(node), min(members[node[:-1]]) if node else -1, len(own), children.get(node, 0), leaves[node], saved[node],
                   hashlib.sha256(",".join(map(str, sorted(ends[node]))).encode()).hexdigest()) for node, own in members.items())


def rebuilt(rows):
    turns = defaultdict(list)
    for conv, turn, role, text in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[1] is not None, r[1] or 0)):
        turns[conv].append((role or "", text or ""))
    out = {}
    for c in turns:
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = turns.get(c - c % 100, [])[:h] + turns[c][h:]
    return out


def found(df):
    return sorted((r.conv_id, r.depth, -1 if r.parent_conv_id is None else r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves,
                   r.saved_tokens, r.ends_sha256) for r in df.collect())


@pytest.fixture(scope="module")
def talks():
    """Conversations with common openings, copies, turnless rebuilt ones, long ones, null turns, roles, texts and ids."""
    rng, rows = random.Random(6), []
    for c in rng.sample(range(0, 900), 160) + [100, 200]:
        n = rng.choice([1, 1, 2, 3, 5, 9])
        rows += [(c, t or (None if c % 3 else 0), rng.choice(["user", None]), rng.choice(["hi", "hé😀", "", None])) for t in range(n)]
    for c in (901, 902, 903, 950):
        rows += [(c, t, "user", f"turn {t % 7}" if t < 140 or c != 903 else "else") for t in range(150)]
    rows += [(c, t, "bot", "copy") for c in range(1001, 1060) for t in range(7)]
    return list(dict(((r[0], r[1]), r) for r in rows).values()) + [(None, 0, "user", "nobody"), (None, None, None, None)]


def test_registered_query_is_a_plain_trie(spark, talks, monkeypatch):
    monkeypatch.setattr(queries.common, "table", lambda *_: table(spark, talks))
    assert found(queries.op12_prefix_trie(spark, "")) == plain(rebuilt(talks))


def test_sql_is_a_plain_trie(talks):
    connection = duckdb.connect()
    connection.execute("CREATE TABLE conversations(conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    connection.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", talks)
    got = connection.execute(queries.OP12_SQL).fetchall()
    assert sorted((r[0], r[1], -1 if r[2] is None else r[2], *r[3:]) for r in got) == plain(rebuilt(talks))


@pytest.mark.parametrize("burst", [2, 20])
def test_bursts_stretches_and_scans(spark, talks, burst, monkeypatch):
    monkeypatch.setattr(prefix_trie, "STRETCH", 4)
    monkeypatch.setattr(prefix_trie, "SCAN", 3)
    monkeypatch.setattr(prefix_trie, "IDS_TOGETHER", 30)
    some = [r for r in talks if r[0] is not None and (r[0] % 2 or r[0] > 900)]
    turns = prefix_trie.numbered(table(spark, some)).persist()
    ids = turns.select("conv_id").distinct()
    paths = defaultdict(list)
    for conv, turn, role, text in sorted(some, key=lambda r: (r[0], r[1] is not None, r[1] or 0)):
        paths[conv].append((role or "", text or ""))
    assert found(prefix_trie.trie(turns, ids, burst)) == plain(paths)


def test_no_conversations_and_conversations_without_turns(spark):
    turns = prefix_trie.numbered(table(spark, []))
    assert prefix_trie.trie(turns, turns.select("conv_id").distinct()).count() == 0
    turnless = spark.createDataFrame([(7,), (12,), (3,)], "conv_id bigint")
    assert found(prefix_trie.trie(turns, turnless)) == [(3, 0, -1, 3, 0, 1, 0, hashlib.sha256(b"3,7,12").hexdigest())]


def test_rows_that_repeat_a_turn_number_have_a_fixed_order(spark):
    rows = [(1, 0, "user", t) for t in "abcab"] + [(2, 0, "user", t) for t in "bcaba"]
    turns = prefix_trie.numbered(table(spark, rows)).collect()
    order = {c: [(r.t1, r.t2) for r in sorted(turns, key=lambda r: r.place) if r.conv_id == c] for c in (1, 2)}
    assert order[1] == order[2] and [r.place for r in sorted(turns, key=lambda r: (r.conv_id, r.place))] == [*range(5)] * 2
