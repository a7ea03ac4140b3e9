from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from lift.operators import encode as E
from lift.operators.order import ranked

from conftest import as_tuples


def test_unseen_and_missing_are_minus_one(spark):
    fitted = E.fit_categories(spark.createDataFrame([("b",), ("a",), (None,)], "t string"), ["t"])
    assert as_tuples(fitted) == [("t", "a", 0), ("t", "b", 1)]
    new = spark.createDataFrame([(1, "a"), (2, "z"), (3, None), (4, "b")], "id int, t string")
    assert as_tuples(E.apply_categories(new, ["t"], fitted)) == [(1, 0), (2, -1), (3, -1), (4, 1)]


def test_codes_follow_value_order_per_column(spark):
    df = spark.createDataFrame([("x", "B"), ("y", "a"), ("x", ""), ("é", "a")], "s string, t string")
    assert as_tuples(E.fit_categories(df, ["s", "t"])) == [("s", "x", 0), ("s", "y", 1), ("s", "é", 2), ("t", "", 0), ("t", "B", 1), ("t", "a", 2)]


@pytest.mark.parametrize("n", [1, 4, 16])
def test_many_values_are_numbered_across_partitions(spark, pieces, n):
    pieces(n)
    df = spark.range(5000).select(F.format_string("v%05d", F.col("id") % 2500).alias("t"))
    fitted = E.fit_categories(df, ["t"])
    assert fitted.count() == 2500
    assert fitted.where(F.col("value") != F.format_string("v%05d", "code")).count() == 0


@pytest.mark.parametrize("threshold", ["10485760", "-1"])
def test_hot_category_with_and_without_broadcast(spark, threshold):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        df = spark.range(9000).select("id", F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.concat(F.lit("c"), "id")).alias("t"))
        coded, dictionary = E.encode_categories(df, ["t"])
        assert coded.count() == 9000 and dictionary.count() == 3001
        assert coded.where("t = 3000").count() == 3000 and coded.where("t = -1").count() == 3000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_fill_leaves_id_and_target_alone(spark):
    df = spark.createDataFrame([(None, None, None, 1.5), (1, 1, 2, None)], "id int, target int, a int, b double")
    assert as_tuples(E.fill_constant(df, ["a", "b"])) == [(1, 1, 2, -1.0), (None, None, -1, 1.5)]


def test_no_text_features(spark):
    df = spark.createDataFrame([(1, 2)], "id int, a int")
    coded, dictionary = E.encode_categories(df, ["a"])
    assert as_tuples(coded) == [(1, 2)] and dictionary.count() == 0


def test_dictionary_is_stored(spark, tmp_path):
    df = spark.createDataFrame([("a",), ("b",)], "t string")
    _, dictionary = E.encode_categories(df, ["t"], str(tmp_path / "dictionary"))
    assert as_tuples(E.load_categories(df, str(tmp_path / "dictionary"))) == as_tuples(dictionary)


def test_ranked_is_one_to_n(spark, pieces):
    pieces(7)
    df = spark.range(1000).select((F.col("id") * 37 % 1000).alias("v"))
    assert ranked(df, ["v"], "r").where("r <> v + 1").count() == 0


def test_fill_of_booleans_fractions_and_any_name(spark):
    df = spark.createDataFrame([(1, True, 2, 1.5, "x", 7), (2, None, None, float("nan"), None, None)], "id int, flag boolean, n int, d double, t string, `a.b` long")
    filled = E.fill_constant(df, ["flag", "n", "d", "t", "a.b"])
    assert sorted(tuple(row) for row in filled.collect()) == [(1, 1, 2, 1.5, "x", 7), (2, -1, -1, -1.0, None, -1)]
    half = E.fill_constant(df, ["flag", "n", "a.b"], -0.5)
    assert as_tuples(half, "id", "flag", "n") == [(1, 1.0, 2.0), (2, -0.5, -0.5)]
    assert dict(E.fill_constant(df, ["n"]).dtypes)["n"] == "int"
