"""The prefix trie against a plain one, and its centroid rounds on deep and odd tables."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from lift.llm import trie
from lift.llm.queries import QUERIES
from tests.llm.helpers import CLASHING

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def plain(rows, head=lambda c: zlib.crc32(str(c).encode()) % 9, base=lambda c: c - (abs(c) % 5) * (1 if c >= 0 else -1)):
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            turns[conv].append(((turn is not None, turn or 0), role, hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()[:16], text))
    kept = {conv: [(role, text) for _, role, _, text in sorted(found)] for conv, found in turns.items()}
    made = {conv: kept.get(base(conv), [])[:head(conv)] + found[head(conv):] for conv, found in kept.items()}
    members, ends, children = defaultdict(list), defaultdict(list), defaultdict(list)
    for conv, found in made.items():
        for depth in range(len(found) + 1):
            members[tuple(found[:depth])].append(conv)
        ends[tuple(found)].append(conv)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        leaves[node] = sum(leaves[child] for child in children[node]) or 1
        own = (len(members[node]) - 1) * len(node[-1][1].encode()) if node else 0
        saved[node] = own + sum(saved[child] for child in children[node])
    digest = lambda ids: hashlib.sha256(",".join(map(str, sorted(ids))).encode()).hexdigest()
    return sorted((min(found), len(node), min(members[node[:-1]]) if node else None, len(found), len(children[node]), leaves[node], saved[node],
                   digest(ends[node])) for node, found in members.items())


def nodes(df, most_nodes=trie.NODES, **how):
    conv = F.col("conv")
    how = how or {"head": F.crc32(conv.cast("string")) % 9, "base": conv - conv % 5}
    return sorted(tuple(row) for row in trie.prefix_trie(df, most_nodes=most_nodes, **how).select(*COLUMNS).collect())


def conversations(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)


@pytest.mark.parametrize("most_nodes", [trie.NODES, 40])
def test_query_equals_the_plain_trie(spark, most_nodes):
    df = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    rows = [tuple(row) for row in df.select("conv_id", "turn", "role", "text").collect()]
    assert nodes(df, most_nodes) == plain(rows)
    if most_nodes == trie.NODES:
        got = QUERIES["op11_prefix_trie"](spark, "/root/testdata/sf0.01")
        assert sorted(tuple(row) for row in got.select(*COLUMNS).collect()) == plain(rows)
        assert {f.dataType.simpleString() for f in got.schema if f.name not in ("ends_sha256",)} == {"bigint"}


def test_a_long_chain_and_its_branches(spark):
    """Prefixes over many runs of turns, cut at centroids in several rounds."""
    rng = random.Random(5)
    long_one = [("user", str(rng.randint(0, 2))) for _ in range(300)]
    rows = [(0, i, *turn) for i, turn in enumerate(long_one)]
    for conv in range(1, 25):
        shared = rng.choice([0, 63, 64, 65, 128, 200, 299])
        rows += [(conv, i, *turn) for i, turn in enumerate(long_one[:shared] + [("user", f"{conv} {k}") for k in range(rng.randint(0, 70))])]
    want = plain(rows, head=lambda c: 0, base=lambda c: c)
    df = conversations(spark, rows)
    same = {"head": F.lit(0), "base": F.col("conv")}
    assert nodes(df, 50, **same) == want
    assert nodes(df, **same) == want


def test_odd_rows(spark):
    rows = [(None, 0, "user", "x"), (5, None, None, None), (5, 0, "user", ""), (5, 0, "user", ""), (5, 0, "assistant", "tie"), (6, 3, "user", "é漢😀"),
            (-7, 0, "a", "bc"), (-8, 0, "ab", "c"), (10, 0, "user", "y" * 100000)]
    rows += [(c, 0, "system", "the same") for c in range(20, 60)]
    assert nodes(conversations(spark, rows)) == plain(rows)
    wide = conversations(spark, rows).select("*", *[F.lit("x").alias(name) for name in CLASHING])
    assert nodes(wide) == plain(rows)


def test_no_conversations(spark):
    empty = conversations(spark, [(None, 0, "user", "x")]).where("conv_id is not null")
    result = trie.shared_conversations(empty)
    assert result.columns == COLUMNS and not result.count()


def test_turnless_conversation_is_a_member_of_the_root(spark):
    # 3 takes its first turns from conversation 0, which is not there; its own lie within the first h
    assert zlib.crc32(b"3") % 9 >= 1
    rows = [(3, 0, "user", "gone"), (11, 0, "user", "a"), (11, 1, "user", "b")]
    assert nodes(conversations(spark, rows)) == plain(rows)
    assert nodes(conversations(spark, rows))[0][:4] == (3, 0, None, 2)


def test_ids_of_a_node_are_digested_over_many_pieces(spark, monkeypatch):
    monkeypatch.setattr(trie, "PIECE", 40)
    rows = [(c, 0, "user", "same") for c in range(0, 3000, 5)]
    assert nodes(conversations(spark, rows)) == plain(rows)


def test_forests_are_taken_apart_to_the_plain_totals():
    rng = np.random.default_rng(1)
    for shape in ("chain", "star", "random", "several"):
        n = 400
        up = np.arange(n)
        for i in range(1, n):
            up[i] = {"chain": i - 1, "star": 0, "random": rng.integers(0, i), "several": i if i % 50 == 0 else rng.integers(i - i % 50, i)}[shape]
        own, values = rng.integers(1, 9, n), rng.integers(-5, 9, (n, 2))
        weight, totals = own.copy(), values.copy()
        for i in range(n - 1, 0, -1):
            if up[i] != i:
                weight[up[i]] += weight[i]
                totals[up[i]] += totals[i]
        assert np.array_equal(trie.take_apart(up, weight, values), totals)
