from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from lift.operators import assemble as A
from lift.operators.registry import FeatureSet, registry_from
from lift.sources.tables import CatalogTables, upsert

from conftest import as_tuples

SETS = [FeatureSet("s1", "t1", ("a", "b")), FeatureSet("s2", "t2", ("c",))]


@pytest.fixture
def tables(spark):
    return {
        "t1": spark.createDataFrame([(1, 1.0, "x"), (2, float("nan"), "y"), (9, 5.0, "z")], "id long, a double, b string"),
        "t2": spark.createDataFrame([(2, 7)], "id long, c int"),
    }


@pytest.fixture
def population(spark):
    return spark.createDataFrame([(1, 0), (2, 1), (3, 1)], "id long, target int")


def test_population_decides_rows_and_registry_decides_columns(population, tables):
    wide = A.assemble(population, SETS, tables, "id", "target")
    assert wide.columns == ["id", "target", "a", "b", "c"]
    assert as_tuples(wide) == [(1, 0, 1.0, "x", None), (2, 1, None, "y", 7), (3, 1, None, None, None)]


def test_scoring_has_no_target_and_empty_sets_are_skipped(spark, population, tables):
    registry = registry_from(spark, [
        {"name": "s1", "class": "main", "type": "t", "source": "t1", "features": ["a", "b"]},
        {"name": "s2", "class": "main", "type": "t", "source": "t2", "features": ["c"]}])
    wide, features = A.load_features(population, registry, tables, "id", except_features="c")
    assert wide.columns == ["id", "a", "b"] and features == ["a", "b"]


def test_fetch_set_is_inner(population, tables):
    assert as_tuples(A.fetch_set(population, tables["t1"], "id", ["b"])) == [(1, "x"), (2, "y")]


@pytest.mark.parametrize("side", ["population", "t1"])
def test_repeated_id_is_an_error(population, tables, side):
    if side == "population":
        population = population.unionByName(population.limit(1))
    else:
        tables["t1"] = tables["t1"].unionByName(tables["t1"])
    with pytest.raises(Exception, match=f"{side}: id occurs more than once"):
        A.assemble(population, SETS, tables, "id", "target").collect()


def test_repeated_feature_name_is_an_error(population, tables):
    with pytest.raises(ValueError, match="column a occurs twice"):
        A.assemble(population, [*SETS, FeatureSet("s3", "t1", ("a",))], tables, "id", "target")


def test_null_ids_match_nothing(spark, tables):
    population = spark.createDataFrame([(1, 0), (None, 1)], "id long, target int")
    tables["t1"] = tables["t1"].unionByName(spark.createDataFrame([(None, 8.0, "n"), (None, 9.0, "n")], "id long, a double, b string"))
    assert as_tuples(A.assemble(population, SETS, tables, "id", "target")) == [(1, 0, 1.0, "x", None), (None, 1, None, None, None)]


def test_text_ids(spark):
    population = spark.createDataFrame([("k1", 0), ("k2", 1)], "id string, target int")
    tables = {"t": spark.createDataFrame([("k2", 4)], "id string, c int")}
    assert as_tuples(A.assemble(population, [FeatureSet("s", "t", ("c",))], tables, "id", "target")) == [("k1", 0, None), ("k2", 1, 4)]


def test_one_shuffle_per_table_id_check_included(spark):
    ids = spark.range(1000)
    tables = {name: ids.withColumn(name, F.col("id") * 2) for name in ("x", "y", "z")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        wide = A.assemble(ids.withColumn("target", F.lit(1)), [FeatureSet(n, n, (n,)) for n in tables], tables, "id", "target")
        plan = wide._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning") <= 4


def test_tables_that_upsert_wrote_are_not_checked(spark):
    """No window, and no exchange beyond those of the joins: none at all for small or bucketed tables."""
    rows = spark.range(50).select("id", (F.col("id") * 2).alias("a"), F.lit("x").alias("b"), F.lit(3).alias("c"))
    for name, columns in (("known_t1", ["id", "a", "b"]), ("known_t2", ["id", "c"]), ("known_all", ["id"])):
        upsert(rows.select(*columns), name, "id", parts=2 if name == "known_t2" else None)
    known = CatalogTables(spark)
    sets = [FeatureSet("s1", "known_t1", ("a", "b")), FeatureSet("s2", "known_t2", ("c",))]

    def plan(population, tables):
        return A.assemble(population, sets, tables, "id")._jdf.queryExecution().executedPlan().toString()

    vouched = plan("known_all", known)
    assert "Window" not in vouched and vouched.count("Exchange hashpartitioning") == 0 and vouched.count("BroadcastHashJoin") == 2
    assert plan(spark.table("known_all"), known).count("Window [") == 1  # a population given as rows is checked
    assert plan("known_all", spark.table).count("Window [") == 3
    assert as_tuples(A.assemble("known_all", sets, known, "id")) == [(i, 2 * i, "x", 3) for i in range(50)]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert plan("known_all", known).count("Exchange hashpartitioning") == 3
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_narrowing_bounds_are_strict(spark):
    df = spark.createDataFrame([(0, 0, -128, 2, 2**40, None, 1.5), (127, 126, 5, 32767, 1, None, 2049.0)],
                               "a long, b long, c long, d long, e long, f long, g double")
    types = dict(A.narrow(df, df.columns).dtypes)
    assert types == {"a": "smallint", "b": "tinyint", "c": "smallint", "d": "int", "e": "bigint", "f": "bigint", "g": "double"}
    assert as_tuples(A.narrow(df, df.columns)) == as_tuples(df)
    assert dict(A.narrow(df, ["g"], to_float=True).dtypes)["g"] == "float"
