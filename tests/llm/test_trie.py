"""The conversation trie against a dictionary of prefixes."""

import hashlib
import random
import zlib

import pytest

from medalforge.llm import trie
from tests.conftest import SF001

ROWS = "conv_id long, turn long, role string, text string"


def plain_rebuilt(rows):
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            own.setdefault(conv, []).append((turn is not None, turn or 0, (role or "").encode(), (text or "").encode()))
    own = {c: [r[2:] for r in sorted(v)] for c, v in own.items()}
    out = {}
    for conv, turns in own.items():
        h = zlib.crc32(str(conv).encode()) % 9
        out[conv] = own.get(conv - conv % 5, [])[:h] + turns[h:]
    return out


def brute(rows):
    """Sorted result rows; nodes are tuples of turns."""
    members = {}
    for conv, turns in plain_rebuilt(rows).items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append((conv, d == len(turns)))
    children, leaves, saved = {}, {}, {}
    for node in members:
        if node:
            children[node[:-1]] = children.get(node[:-1], 0) + 1
    for node, m in members.items():
        own = (len(m) - 1) * len(node[-1][1]) if node else 0
        for d in range(len(node) + 1):
            above = node[:d]
            saved[above] = saved.get(above, 0) + own
            leaves[above] = leaves.get(above, 0) + (node not in children)
    least = {node: min(c for c, _ in m) for node, m in members.items()}
    out = []
    for node, m in members.items():
        ends = ",".join(str(c) for c, done in sorted(m) if done)
        out.append((least[node], len(node), least[node[:-1]] if node else None, len(m), children.get(node, 0), leaves[node],
                    saved[node], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def conversations(seed, n=80, longest=12):
    rng = random.Random(seed)
    scripts = [[(rng.choice(["user", "assistant", None]), rng.choice(["Hi", "ü", "", None, "long text"])) for _ in range(longest)] for _ in range(3)]
    rows = []
    for conv in range(-3, n):
        script = rng.choice(scripts)[:rng.choice([1, 2, 5, longest])]
        if rng.random() < 0.4:
            script = script + [("user", f"own {rng.randrange(20)}")]
        if rng.random() < 0.1:
            continue
        rows += [(conv, None if rng.random() < 0.02 and not i else i, r, t) for i, (r, t) in enumerate(script)]
    rows += [(None, 0, "user", "no id"), (None, None, None, None)]
    rng.shuffle(rows)
    return rows


def test_medians_first_reaches_every_place_in_balance():
    for n in (0, 1, 2, 7, 100):
        assert sorted(trie.medians_first(n)) == list(range(n))
    tree = trie.TernaryTree()
    for i in trie.medians_first(127):
        tree.insert([i])
    deepest, stack = 0, [(tree.down[0], 1)]
    while stack:
        node, depth = stack.pop()
        if node:
            deepest = max(deepest, depth)
            stack += [(tree.low[node], depth + 1), (tree.high[node], depth + 1)]
    assert deepest == 7


@pytest.mark.parametrize("seed, shard, block", [(1, 4096, 64), (2, 3, 64), (3, 1, 64), (4, 4096, 4), (5, 3, 4), (6, 2, 1)])
def test_equals_brute_force(spark, monkeypatch, seed, shard, block):
    """Small shards make most nodes boundary nodes; small blocks chain the tries of one conversation."""
    monkeypatch.setattr(trie, "SHARD", shard)
    monkeypatch.setattr(trie, "BLOCK", block)
    rows = conversations(seed)
    df = spark.createDataFrame(rows, ROWS).repartition(4)
    assert got(trie.prefix_nodes(trie.rebuilt(df))) == brute(rows)


def test_one_long_conversation_and_its_copies(spark, monkeypatch):
    monkeypatch.setattr(trie, "SHARD", 8)
    rng = random.Random(3)
    script = [(rng.choice(["user", "assistant"]), rng.choice(["a", "bb", "ccc"])) for _ in range(300)]
    rows = [(c, i, r, t) for c, n in ((10, 300), (15, 300), (20, 299), (25, 128), (30, 64), (31, 140)) for i, (r, t) in enumerate(script[:n])]
    rows += [(35, i, r, t) for i, (r, t) in enumerate(script[:100] + [("user", "another")] * 100)] + conversations(7, 20)
    df = spark.createDataFrame(rows, ROWS)
    assert got(trie.prefix_nodes(trie.rebuilt(df))) == brute(rows)


def test_many_copies_of_one_conversation(spark, monkeypatch):
    monkeypatch.setattr(trie, "SHARD", 16)
    rows = [(5 * c, i, "user", f"t{i}") for c in range(200) for i in range(6)]
    assert got(trie.prefix_nodes(trie.rebuilt(spark.createDataFrame(rows, ROWS)))) == brute(rows)


def test_without_broadcasts(spark):
    rows = conversations(8)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "0")
    try:
        assert got(trie.prefix_nodes(trie.rebuilt(spark.createDataFrame(rows, ROWS)))) == brute(rows)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_clashing_columns_and_empty_table(spark):
    from pyspark.sql import functions as F
    rows = conversations(9, 10)
    df = spark.createDataFrame(rows, ROWS)
    for name in ("digest", "position", "length", "size", "key", "_row", "base", "h"):
        df = df.withColumn(name, F.lit("own"))
    assert got(trie.prefix_nodes(trie.rebuilt(df))) == brute(rows)
    assert got(trie.prefix_nodes(trie.rebuilt(df.limit(0)))) == []


def test_query_on_the_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF001}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert got(trie.op13_conversation_trie(spark, SF001)) == brute(rows)
