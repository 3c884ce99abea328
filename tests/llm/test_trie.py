import hashlib
import zlib
from collections import defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from conftest_llm import SF, rows_of
from tillwise.llm import trie

SCHEMA = "conv_id long, turn long, role string, text string, depth int, a string, n int, shard int"
OUT = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
       "ends_sha256"]


def built_from():
    conv = F.col("conv_id")
    return conv - conv % 100, F.crc32(conv.cast("string").cast("binary")) % 6, 5


def tie(role, text):
    h = xxhash.xxh64_intdigest(text.encode(), xxhash.xxh64_intdigest(role.encode(), 42))
    return h - (h >> 63 << 64)


def plain(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, tie(role or "", text or ""), role or "", text or ""))
    own = {c: [x[3:] for x in sorted(turns)] for c, turns in own.items()}
    nodes, ended = defaultdict(list), defaultdict(list)
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        path = tuple(own.get(c - c % 100, [])[:h] + turns[h:])
        for d in range(len(path) + 1):
            nodes[path[:d]].append(c)
        ended[path].append(c)
    children, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for path in nodes:
        if path:
            children[path[:-1]] += 1
    for path, members in nodes.items():
        for d in range(len(path) + 1):
            leaves[path[:d]] += not children[path]
            saved[path[:d]] += (len(members) - 1) * len(path[-1][1]) if path else 0
    return sorted(((min(m), len(p), min(nodes[p[:-1]]) if p else None, len(m), children[p], leaves[p], saved[p],
                    hashlib.sha256(",".join(map(str, sorted(ended[p]))).encode()).hexdigest())
                   for p, m in nodes.items()), key=repr)


def setting():
    rng = np.random.default_rng(12)
    rows = []
    for c in range(0, 430):
        if c in (200, 300):
            continue  # heads that are absent
        for t in range(int(rng.integers(1, 8))):
            shared = t < 2 or c % 3 == 0  # a third of the conversations are alike
            rows.append((c, t, "user" if t % 2 else "system", "same é" * t if shared else f"turn {rng.integers(0, 3)}"))
    rows += [(100, None, None, "first of all"), (100, None, "user", None), (5, 3, None, None), (5, 3, None, None),
             (None, 1, "user", "nobody"), (100_000, 0, "user", ""), (100_001, 0, "user", "x" * 100_000)]
    rows += [(431, t, "user", f"{t % 3}") for t in range(600)] + [(432, t, "user", f"{t % 3}") for t in range(560)]
    return rows


@pytest.mark.parametrize("shard_turns, limit", [(8192, 100_000), (60, 3)])
def test_equal_to_brute_force_with_odd_rows(spark, shard_turns, limit):
    rows = setting()
    table = spark.createDataFrame([(*r, 1, "a", 2, 3) for r in rows], SCHEMA).repartition(5)
    found = trie.prefix_trie(table, *built_from(), shard_turns, limit)
    assert rows_of(found, *OUT) == plain(rows)


def test_many_shards_meet_level_by_level(spark):
    rows = [(c, t, "user", str(c >> (9 - 3 * t))) for c in range(1000, 1500) for t in range(4)]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    placed, convs = trie.rebuilt(trie.numbered(table), *built_from())
    found = trie.paths(placed)
    by_conv = convs.select("conv_id", (F.col("conv_id") * 37).alias("shard"))  # far apart
    nodes = trie.nodes(found, by_conv)
    assert nodes.agg(F.max("level")).first()[0] >= 2
    got = trie.totals(nodes, 4).join(nodes, ["depth", "a", "b"])
    want = {(r[0], r[1]): r[4:7] for r in plain(rows)}
    assert {(r["conv_id"], r["depth"]): (r["n_children"], r["n_leaves"], r["saved_tokens"])
            for r in got.collect()} == want


def test_empty_table(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert trie.prefix_trie(none, *built_from()).count() == 0
    nobody = spark.createDataFrame([(None, 1, "user", "x", 1, "a", 2, 3)], SCHEMA)
    assert trie.prefix_trie(nobody, *built_from()).count() == 0


def test_queue_spills_and_keeps_order():
    rng = np.random.default_rng(0)
    queue, kept, out = trie.SpillingQueue(10), [], []
    for k in range(2000):
        item = (int(rng.integers(0, 50)), k)
        queue.push(item)
        kept.append(item)
        assert len(queue.heap) <= 10
        if k % 3 == 0:
            least = min(kept)
            assert queue.first() == least and queue.pop() == least
            kept.remove(least)
    assert queue.spilled > 0
    while queue.first() is not None:
        out.append(queue.pop())
    assert out == sorted(kept)


def test_query_equals_sql(spark, sql):
    assert rows_of(trie.op12_prefix_trie(spark, SF), *OUT) == sorted(sql(trie.OP12_SQL), key=repr)
