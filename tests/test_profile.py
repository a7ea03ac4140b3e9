from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from lift.operators import profile as P

from conftest import as_tuples


def test_missing_share_is_strict(spark):
    df = spark.createDataFrame([(None, 1)] * 9 + [(1, 1)], "a int, b int")
    assert as_tuples(P.missing_share(df, ["a", "b"])) == [("a", 0.9), ("b", 0.0)]
    assert P.elimination_record(df.withColumn("b", F.monotonically_increasing_id()), ["a", "b"], missing=0.9, dominant=0.95, collinear_above=0.9).count() == 0
    assert as_tuples(P.elimination_record(df, ["a"], missing=0.89, dominant=0.95, collinear_above=0.9)) == [("missing", "a", 0.9)]


def test_nulls_stay_in_the_denominator_of_the_dominant_share(spark):
    df = spark.createDataFrame([(1,), (1,), (1,), (None,), (None,)], "a int")
    assert as_tuples(P.dominant_share(df, ["a"])) == [("a", 0.6)]
    assert P.dominant_above(df, ["a"], 0.7).count() == 0
    assert as_tuples(P.dominant_above(df, ["a"], 0.5)) == [("a", 0.6)]


def test_dominant_share_of_every_type(spark):
    df = spark.createDataFrame([(2**53, 0.0, "x", True, None), (2**53 + 1, -0.0, "x", True, None), (2**53, 1.5, "y", False, None)],
                               "i long, d double, s string, b boolean, n double")
    expected = [("b", 2 / 3), ("d", 2 / 3), ("i", 2 / 3), ("n", 0.0), ("s", 2 / 3)]
    assert as_tuples(P.dominant_share(df, df.columns)) == expected
    assert as_tuples(P.dominant_above(df, df.columns, 0.1)) == [row for row in expected if row[1] > 0]


def test_dominant_above_equals_the_full_count(spark):
    df = spark.range(20_000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("third"), F.col("id").alias("distinct"),
        (F.col("id") % 4).alias("even"), F.when(F.col("id") % 2 == 0, F.lit(None)).otherwise(F.col("id") % 7).alias("gaps"),
        F.concat(F.lit("v"), F.sqrt("id").cast("int")).alias("text"))
    for threshold in (0.001, 0.05, 0.25, 0.3, 1 / 3):
        full = P.dominant_share(df, df.columns).where(F.col("dominant_share") > threshold)
        assert as_tuples(P.dominant_above(df, df.columns, threshold)) == as_tuples(full)


def test_tiny_thresholds_take_several_passes(spark, monkeypatch):
    """Down to a ten-thousandth, with as many candidates as there are values; shuffled rows are counts of candidates."""
    df = spark.range(60_000).select(
        F.when(F.col("id") % 7000 < 9, F.lit(-1)).otherwise(F.col("id")).alias("rare"), F.col("id").alias("distinct"), (F.col("id") % 5000).alias("even"),
        F.when(F.col("id") % 10 < 4, F.lit(1.5)).otherwise(F.col("id") / 7).alias("heavy"), F.concat(F.lit("v"), (F.col("id") % 9001).cast("string")).alias("text"))
    assert [P._passes(t) for t in (0.5, 0.001, 0.0001, 0.00001, 0.0)] == [1, 1, 10, 100, 0]
    monkeypatch.setattr(P, "dominant_share", None)
    for threshold, wanted in ((0.0001, {"rare", "heavy", "even", "text"}), (0.0011, {"rare", "heavy"})):
        found = {r["feature"]: r["dominant_share"] for r in P.dominant_above(df, df.columns, threshold).collect()}
        assert set(found) == wanted
        assert found["heavy"] == 0.4 and found["rare"] == 81 / 60_000 and found.get("even", 0.0002) == 0.0002 and found.get("text", 7 / 60_000) == 7 / 60_000
    assert P.dominant_above(df, ["distinct"], 0.0001).count() == 0


def test_features_already_missing_are_not_counted_again(spark):
    df = spark.createDataFrame([(None,)] * 8 + [(1,)] * 2, "a int")
    assert as_tuples(P.elimination_record(df, ["a"], missing=0.7, dominant=0.1, collinear_above=0.9), "reason") == [("missing",)]


@pytest.fixture
def numbers():
    rng = np.random.default_rng(3)
    data = pd.DataFrame(rng.normal(size=(2000, 5)), columns=list("abcde"))
    data["f"] = data["a"] * 3 + 1e6
    data["g"] = -data["b"]
    data["k"] = 0.1
    for column in "cdf":
        data.loc[rng.random(2000) < 0.4, column] = None
    return data


def spark_frame(spark, data, parts=4):
    df = spark.createDataFrame(data.astype(object).where(data.notna(), None).values.tolist(), ", ".join(f"{c} double" for c in data.columns))
    return df.repartition(parts)


@pytest.mark.parametrize("parts", [1, 4, 16])
def test_correlation_equals_pairwise_complete_pearson(spark, numbers, parts):
    expected = numbers.corr()
    got = {(row["feature_i"], row["feature_j"]): row["corr"] for row in P.correlation(spark_frame(spark, numbers, parts), list(numbers.columns)).collect()}
    assert len(got) == 28
    for (i, j), value in got.items():
        if "k" in (i, j):
            assert value is None
        else:
            assert value == pytest.approx(expected.loc[i, j], abs=1e-9)


def test_constant_only_where_the_other_is_present(spark):
    df = spark.createDataFrame([(0.3, 1.0), (0.3, 2.0), (0.3, 5.0), (7.7, None), (-2.0, None)], "a double, b double")
    assert P.correlation(df, ["a", "b"]).first()["corr"] is None


def test_infinite_and_absent_values_do_not_raise(spark):
    df = spark.createDataFrame([(1.0, float("inf"), None), (2.0, 1.0, None), (3.0, 0.0, None)], "a double, b double, n double")
    assert [row["corr"] for row in P.correlation(df, ["a", "b", "n"]).collect()] == [None] * 3


def test_text_has_no_correlation(spark):
    df = spark.createDataFrame([(1, "x", 2.0), (2, "y", 3.0)], "a int, t string, b double")
    assert as_tuples(P.correlation(df, ["a", "t", "b"]), "feature_i", "feature_j") == [("a", "b")]


def test_negative_correlation_flags_nothing_and_a_flagged_feature_still_flags(spark):
    rows = list(zip([1, 2, 3, 4, 5, 6], [2, 5, 5, 10, 10, 10], [1, 3, 2, 6, 5, 4], [-1, -2, -3, -4, -5, -6], [1] * 6))
    df = spark.createDataFrame(rows, "a int, b int, c int, n int, k int")
    assert as_tuples(P.collinear(df, df.columns, 0.9), "feature") == [("b",), ("c",)]
    assert P.correlation(df, ["a", "c"]).first()["corr"] == pytest.approx(0.7142857)


def test_drop_useless_ignores_names_already_gone(spark):
    df = spark.createDataFrame([(1, 2, 3)], "id int, a int, b int")
    record = spark.createDataFrame([("missing", "a", 1.0), ("collinear", "a", 1.0), ("collinear", "gone", 1.0)], P.RECORD)
    assert P.drop_useless(df, record).columns == ["id", "b"]
    assert P.dropped_count(record).first()["dropped"] == 2


def test_rows_are_counted_by_the_next_action(spark):
    df, seen = P.observed(spark.range(42), "load")
    df.write.format("noop").mode("overwrite").save()
    assert seen.get["rows"] == 42


def test_decimals_and_booleans(spark):
    df = spark.createDataFrame([(1, True), (2, False), (3, False)], "i int, b boolean").selectExpr("cast(i as decimal(30,2)) + 1e6BD as d", "b")
    assert as_tuples(P.dominant_share(df, ["d", "b"])) == [("b", 2 / 3), ("d", 1 / 3)]
    assert P.correlation(df, ["d", "b"]).first()["corr"] == pytest.approx(-0.8660254)


def test_correlation_in_blocks(spark, numbers):
    df = spark_frame(spark, numbers, 3)
    whole = as_tuples(P.correlation(df, list(numbers.columns)), "feature_i", "feature_j", "corr")
    assert len(whole) == 28
    for block in (1, 3, 5):
        blocks = as_tuples(P.correlation(df, list(numbers.columns), block=block), "feature_i", "feature_j", "corr")
        assert [row[:2] for row in blocks] == [row[:2] for row in whole]
        assert [row[2] for row in blocks] == pytest.approx([row[2] for row in whole], abs=1e-12)


def test_wide_correlation_has_a_task_for_each_partition(spark):
    df = spark.range(12).repartition(6).select(*[(F.col("id") * i % 7).alias(f"c{i}") for i in range(2000)])
    found = P.correlation(df, df.columns, block=1000)
    folds = found._jdf.queryExecution().executedPlan().toString().count("MapInArrow")
    assert folds >= 3 and "Coalesce" not in found._jdf.queryExecution().executedPlan().toString()


def test_long_texts_are_compared_by_digest(spark):
    df = spark.createDataFrame([("a" * 5000,), ("a" * 5000,), ("b" * 9000,), (None,)], "t string")
    assert as_tuples(P.dominant_above(df, ["t"], 0.3)) == as_tuples(P.dominant_share(df, ["t"])) == [("t", 0.5)]
    assert all(len(item) == 32 for item in P.survey(df, ["t"], 0.3).frequent["t"])
