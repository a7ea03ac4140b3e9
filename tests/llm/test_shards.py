"""The law of the shards, and that splitters decide nothing but the balance of the work."""

from __future__ import annotations

import zlib

import pytest
from pyspark.sql import functions as F

from lift.llm import shards
from lift.llm.queries import QUERIES
from tests.llm.helpers import no_documents, odd_documents


def checked(result, rows, n_shards):
    """Every row once with its size and checksum, slots without gaps, shards as even as their rows allow."""
    made = [row.asDict() for row in result.collect()]
    want = [(i, len((text or "").encode()) + 16, zlib.crc32((text or "").encode())) for i, text in rows]
    assert sorted(((r["id"], r["size"], r["text_crc32"]) for r in made), key=str) == sorted(want, key=str)
    by_shard = {}
    for row in made:
        by_shard.setdefault(row["shard"], []).append(row)
    assert all(0 <= s < n_shards for s in by_shard)
    for found in by_shard.values():
        assert sorted(row["slot"] for row in found) == list(range(len(found)))
    loads = [sum(row["size"] for row in by_shard.get(s, [])) for s in range(n_shards)]
    mean = sum(loads) / n_shards
    assert max(loads) <= max(mean * (1 + 1 / shards.LARGE_SHARE) + 1, max(size for _, size, _ in want))
    return sorted((str(r["id"]), r["size"], r["text_crc32"], r["shard"], r["slot"]) for r in made)


def test_query_keeps_its_law(spark):
    result = QUERIES["op12_sharding"](spark, "/root/testdata/sf0.01")
    assert [(f.name, f.dataType.simpleString()) for f in result.schema] == [
        ("doc_id", "bigint"), ("size", "bigint"), ("text_crc32", "bigint"), ("law", "string"), ("shard", "int"), ("slot", "bigint"), ("grown_shard", "int")]
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()]
    made = checked(result.withColumnRenamed("doc_id", "id"), rows, 40)
    assert len(made) == len(rows)
    assert {tuple(r) for r in result.select("law", "grown_shard").distinct().collect()} == {("bytes", None)}


@pytest.mark.parametrize("n_shards", [1, 7])
def test_a_hot_text_is_divided(spark, n_shards, monkeypatch):
    """A text that half of the rows hold fills ranges that are divided by id, and repeated rows by their number."""
    monkeypatch.setattr(shards, "RANGE_ROWS", 100)
    rows = [(i, "hot" * 20) for i in range(3000)] + [(1, "hot" * 20)] * 1500 + [(i, f"text {i}" * (i % 13)) for i in range(2500)] + [(9, "x" * 30000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    once = checked(shards.shard_rows(df, n_shards), rows, n_shards)
    assert checked(shards.shard_rows(df.repartition(2), n_shards), rows, n_shards) == once
    texts = {zlib.crc32(b"hot" * 20)}
    if n_shards > 1:  # neighbours in the order: at most the shards it needs
        holding = {r[3] for r in once if r[2] in texts}
        assert len(holding) <= n_shards


def test_splitters_decide_nothing(spark, pieces, monkeypatch):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [tuple(r) for r in df.select("doc_id", "text").collect()]
    first = checked(shards.shard_rows(df, 5), rows, 5)
    pieces(3)
    monkeypatch.setattr(shards, "RANGE_ROWS", 10)
    monkeypatch.setattr(shards, "DRAWS", 4)
    assert checked(shards.shard_rows(df, 5), rows, 5) == first


def test_equal_texts_are_neighbours(spark):
    rows = [(i, f"text {i % 50}") for i in range(5000)]
    result = shards.shard_rows(spark.createDataFrame(rows, "doc_id long, text string"), 4)
    # 50 groups on 4 shards: only the groups at the 3 ends can be cut
    spread = result.groupBy("text_crc32").agg(F.countDistinct("shard").alias("n"))
    assert spread.where("n > 1").count() <= 3


def test_odd_and_no_rows(spark):
    odd = odd_documents(spark)
    rows = [tuple(r) for r in odd.select("doc_id", "text").collect()]
    checked(shards.shard_rows(odd, 4), rows, 4)
    checked(shards.shard_rows(odd, 40), rows, 40)
    assert not shards.sharded_documents(no_documents(spark)).count()
    one = spark.createDataFrame([(1, None)], "doc_id long, text string")
    assert [tuple(r) for r in shards.sharded_documents(one).collect()] == [(1, 16, 0, "bytes", 0, 0, None)]


def test_main_path_is_native(spark):
    plan = shards.sharded_documents(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
