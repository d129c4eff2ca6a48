import hashlib
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tapline.llm import turn_trie

SCHEMA = "conv_id long, turn long, role string, text string, depth string, n long, key int"


def ordered(rows):
    convs = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            convs[conv].append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [(r, t) for _, _, r, t in sorted(turns)] for c, turns in convs.items()}


def rebuilt(convs):
    out = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = convs.get(c - c % 5, [])[:h] + own[h:]
    return out


def plain(paths):
    """Nodes by definition, every prefix spelt out."""
    members, ends, kids = defaultdict(list), defaultdict(list), defaultdict(set)
    for c, path in paths.items():
        for d in range(len(path) + 1):
            members[tuple(path[:d])].append(c)
            if d:
                kids[tuple(path[:d - 1])].add(tuple(path[:d]))
        ends[tuple(path)].append(c)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        own = (len(members[node]) - 1) * len(node[-1][1].encode()) if node else 0
        leaves[node] = sum(leaves[k] for k in kids[node]) or 1
        saved[node] = own + sum(saved[k] for k in kids[node])
    return sorted((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(kids[p]), leaves[p], saved[p],
                   hashlib.sha256(",".join(map(str, sorted(ends[p]))).encode()).hexdigest()) for p, m in members.items())


def rows(df):
    assert df.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                          "ends_sha256"]
    return sorted(map(tuple, df.collect()))


def table(spark, given):
    return spark.createDataFrame([(*r, "x", 1, 2) for r in given], SCHEMA).repartition(3)


def families(copies, length):
    """Many conversations along one path, repeated, cut short, and going on differently."""
    out = []
    for c in range(copies):
        for t in range(length if c % 3 else c % length):
            out.append((c, t, "user" if t % 2 else None, f"turn {t} é" + ("" if t < length - 2 else f" {c % 4}")))
    return out


@pytest.mark.parametrize("bounds", [{}, {"SHARD_ROWS": 1}, {"SHARD_ROWS": 3, "SAMPLES": 50, "STRETCH": 4},
                                    {"SHARD_ROWS": 2, "SKELETON_BYTES": 200}])
def test_query_and_families_against_definition(spark, monkeypatch, bounds):
    for name, value in bounds.items():
        monkeypatch.setattr(turn_trie, name, value)
    given = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/conversations.parquet").select(
        "conv_id", "turn", "role", "text").collect()]
    assert rows(turn_trie.op12_turn_trie(spark, "/root/testdata/sf0.001")) == plain(rebuilt(ordered(given)))
    given = families(60, 7)
    assert rows(turn_trie.prefix_trie(table(spark, given))) == plain(ordered(given))


def test_odd_rows(spark):
    given = [
        (None, 1, "user", "no conversation"), (5, None, "user", "null first"), (5, 0, None, None), (5, 0, "", ""),
        (5, 1, "a", "b"), (5, 1, "a", "b"), (6, 3, "a", "b"), (7, 2, "", ""), (7, 2, "", "z"), (7, 2, "", "y"),
        (-3, 0, "user", "negative"), (10**15, 0, "user", "é" * 100_000), (10**15 + 1, 0, "user", "é" * 100_000),
        (11, 1, "c", None), (13, 0, "user", "null first")]
    given += [(20, t, "user", "long conversation") for t in range(3000)] + [(21, t, "user", "long conversation") for t in range(2500)]
    convs, turns = ordered(given), table(spark, given)
    assert rows(turn_trie.prefix_trie(turns)) == plain(convs)
    assert rows(turn_trie.trie(*turn_trie.rebuilt(turns))) == plain(rebuilt(convs))


def test_empty_and_turnless(spark):
    assert turn_trie.prefix_trie(table(spark, []).where("conv_id > 0")).collect() == []
    turns = turn_trie.ordered_turns(table(spark, [(4, 1, "a", "b")])).select(
        F.col("conv_id").alias("c"), F.lit(1).alias("depth"), "a", "b", "bytes")
    convs = spark.createDataFrame([(4,), (9,), (2,)], "c long")
    assert rows(turn_trie.trie(turns, convs)) == plain({4: [("a", "b")], 9: [], 2: []})
    assert rows(turn_trie.trie(turns.limit(0), convs)) == plain({4: [], 9: [], 2: []})
