from __future__ import annotations

import hashlib
import math

import pytest
from pyspark.sql import functions as F

from lift.operators import split as S

from conftest import as_tuples


def place(seed, id_):
    return hashlib.md5(f"{seed}|{id_}".encode()).hexdigest()


@pytest.fixture
def rows(spark):
    return spark.range(3000).select("id", F.when(F.col("id") % 7 == 0, 1).otherwise(0).alias("y"))


@pytest.mark.parametrize("parts", [1, 5, 16])
def test_holdout_takes_the_first_of_each_class_in_hash_order(rows, parts):
    got = {row["id"] for row in S.holdout(rows.repartition(parts), "id", "y", 0.2, 9).where("split = 'holdout'").collect()}
    expected = set()
    for label in (0, 1):
        ids = sorted((i for i in range(3000) if (i % 7 == 0) == (label == 1)), key=lambda i: place(9, i))
        expected |= set(ids[: round(len(ids) * 0.2)])
    assert got == expected


@pytest.mark.parametrize("counts, share, held", [
    ({0: 885, 1: 615}, 0.2, {0: 177, 1: 123}),
    ({0: 5, 1: 4}, 0.25, {0: 2, 1: 1}),      # ceil(2.25) = 3 rows; the larger remainder keeps its row in train
    ({0: 10, 1: 1}, 0.1, {0: 2, 1: 0}),
    ({0: 3}, 1 / 3, {0: 1}),
    ({0: 7, 1: 7}, 0.0, {0: 0, 1: 0}),
])
def test_holdout_sizes(spark, counts, share, held):
    df = spark.createDataFrame([(i * 1000 + j, y) for i, (y, n) in enumerate(counts.items()) for j in range(n)], "id long, y int")
    parts = S.holdout(df, "id", "y", share, 1)
    got = {row["y"]: row["n"] for row in parts.groupBy("y").agg(F.count_if(F.col("split") == "holdout").alias("n")).collect()}
    assert got == held


def test_holdout_total_is_the_rounded_up_share(rows):
    for share in (0.1, 0.25, 0.33):
        assert S.holdout(rows, "id", "y", share, 2).where("split = 'holdout'").count() == math.ceil(3000 * share)


@pytest.mark.parametrize("k", [2, 3, 4])
def test_folds_are_even_in_every_class(rows, k):
    folded = S.folds(rows, "id", "y", k, 3)
    sizes = {(row["y"], row["fold"]): row["count"] for row in folded.groupBy("y", "fold").count().collect()}
    assert len(sizes) == 2 * k and folded.count() == 3000
    for y in (0, 1):
        ns = [n for (label, _), n in sizes.items() if label == y]
        assert max(ns) - min(ns) <= 1


def test_folds_of_a_class_smaller_than_k(spark):
    df = spark.createDataFrame([(i, int(i < 2)) for i in range(10)], "id int, y int")
    folds = as_tuples(S.folds(df, "id", "y", 4, 1).where("y = 1"), "fold")
    assert len(folds) == 2 and folds[0] != folds[1]


def test_folds_do_not_depend_on_partitions(rows, pieces):
    first = as_tuples(S.folds(rows.repartition(1), "id", "y", 4, 3))
    pieces(3)
    assert as_tuples(S.folds(rows.repartition(16), "id", "y", 4, 3)) == first


@pytest.mark.parametrize("label", ["y", "y = 1", "cast(y as double)"])
def test_text_ids_and_label_types(spark, label):
    df = spark.range(100).select(F.concat(F.lit("k"), "id").alias("id"), (F.col("id") % 2).alias("y")).select("id", F.expr(label).alias("y"))
    parts = S.holdout(df, "id", "y", 0.2, 1)
    assert sorted((int(row["y"]), row["count"]) for row in parts.where("split = 'holdout'").groupBy("y").count().collect()) == [(0, 10), (1, 10)]


@pytest.mark.parametrize("value", [None, 2])
def test_other_labels_are_an_error(spark, value):
    df = spark.createDataFrame([(1, 0), (2, 1), (3, value)], "id int, y int")
    with pytest.raises(Exception, match="label must be 0 or 1"):
        S.folds(df, "id", "y", 2, 1).collect()


def test_sample_has_the_exact_size(rows):
    for share, size in ((0.5, 1500), (0.1234, 370), (1.0, 3000), (0.0, 0)):
        assert S.sample_rows(rows, "id", share, 4).count() == size


def test_splitting_shuffles_no_rows(rows):
    wide = rows.withColumn("payload", F.lit("x"))
    plan = S.holdout(wide, "id", "y")._jdf.queryExecution().executedPlan().toString()
    shuffled = [line for line in plan.splitlines() if "Exchange" in line and "payload" in line]
    assert not shuffled


def test_copies_of_an_id_stay_together(spark):
    df = spark.range(300).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("id"), F.lit(1).alias("y"))
    parts = S.holdout(df, "id", "y", 0.2, 1)
    assert parts.count() == 300 and parts.where("id = -1").select("split").distinct().count() == 1


def test_shares_and_names(spark):
    df = spark.range(100).select("id", (F.col("id") % 2).cast("int").alias("y"), F.lit(1).alias("cuts"), F.lit(2).alias("a.b"))
    for share in (-1, 1.5):
        with pytest.raises(ValueError, match="between 0 and 1"):
            S.sample_rows(df, "id", share)
    assert S.sample_rows(df, "id", 0.2).columns == df.columns
    assert S.holdout(df, "id", "y").columns == [*df.columns, "split"] and S.folds(df, "id", "y").columns == [*df.columns, "fold"]
    with pytest.raises(ValueError, match="split"):
        S.holdout(df.withColumn("split", F.lit(1)), "id", "y")
