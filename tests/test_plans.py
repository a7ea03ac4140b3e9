from __future__ import annotations

from pathlib import Path
from urllib.parse import urlparse

import pytest
from pyspark.sql import functions as F

from lift.operators.registry import chosen_sets, load_registry, registry_from
from lift.plans.build import BuildSettings, build_model
from lift.plans.load import load_tables
from lift.plans.score import ScoreSettings, score_population
from lift.plans.select import SelectSettings, select_features
from lift.sources.shared import shared_folder

from conftest import as_tuples

SETS = [
    {"name": "num", "class": "main", "type": "numerical", "source": "plan_num", "features": ["good", "copy", "rare", "flat"]},
    {"name": "cat", "class": "extra", "type": "mixed", "source": "plan_cat", "features": ["kind", "junk"]},
]
RANGES = {"num_iterations": (3, 6), "max_depth": (2, 4), "learning_rate": (0.1, 0.5)}


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Keyed tables loaded from CSV: an id, a target that follows ``good`` and ``kind``, and useless columns."""
    home = tmp_path_factory.mktemp("csv")
    ids = spark.range(800).withColumnRenamed("id", "client_id")
    good = (F.pmod(F.xxhash64("client_id"), F.lit(100)) / 100.0).alias("good")
    kind = F.element_at(F.array(F.lit("a"), F.lit("b"), F.lit("c")), (F.pmod(F.xxhash64("client_id", F.lit("k")), F.lit(3)) + 1).cast("int")).alias("kind")
    num = ids.select("client_id", good).select(
        "client_id", "good", (F.col("good") * 2 + 1).alias("copy"), F.when(F.col("client_id") % 50 == 0, 1.0).alias("rare"), F.lit(7).alias("flat"))
    cat = ids.where("client_id % 4 <> 0").select("client_id", kind, F.pmod(F.xxhash64("client_id", F.lit("j")), F.lit(9)).alias("junk"))
    train = ids.join(num, "client_id").join(cat, "client_id", "left").select(
        "client_id", ((F.col("good") > 0.5) | (F.coalesce("kind", F.lit("-")) == "b")).cast("int").alias("target")).where("client_id < 600")
    files = {}
    for name, df in (("plan_num", num), ("plan_cat", cat), ("plan_train", train), ("plan_test", ids.where("client_id >= 600"))):
        df.write.csv(str(home / name), header=True)
        files[name] = str(home / name)
    load_tables(spark, files, "client_id")
    return spark.table


def test_select_build_score(spark, tables, tmp_path):
    registry, top = registry_from(spark, SETS), str(tmp_path / "top")
    selection = select_features(
        tables("plan_train"), registry, tables,
        SelectSettings(target="target", missing_threshold=0.9, disbalance_threshold=0.9, collinear_threshold=0.9, seed=5, forest={"trees": 20, "max_depth": 5, "max_features": 0.5}), top)
    assert as_tuples(selection.record, "reason", "feature") == [("collinear", "copy"), ("disbalance", "flat"), ("missing", "rare")]
    kept = load_registry(spark, top)
    assert {"good", "kind"} <= {f for one in chosen_sets(kept) for f in one.features}
    assert selection.sizes == {"load": (600, 8), "drop": (600, 5), "train": (480, 5), "holdout": (120, 5)}
    assert selection.auc.first()["auc"] > 0.9
    assert [row["feature"] for row in selection.top.collect()][0] == "good"

    model_path, dictionary_path = str(tmp_path / "model"), str(tmp_path / "dictionary")
    built = build_model(
        tables("plan_train"), kept, tables,
        BuildSettings(target="target", ranges=RANGES, cv_splits=2, init_points=1, n_iter=1, seed=5, cm_threshold=0.45),
        model_path=model_path, dictionary_path=dictionary_path)
    auc = {row["set"]: row["auc"] for row in built.metrics["roc_auc"].collect()}
    assert auc["train"] > 0.9 and auc["holdout"] > 0.9
    assert built.metrics["conf_matrix"].agg(F.sum("n")).first()[0] == 120
    assert built.search.trials.count() == 2
    assert built.metrics["histogram"].agg(F.sum("n")).first()[0] == 120

    scored, histogram = score_population(
        tables("plan_test"), kept, tables, model_path, ScoreSettings(), dictionary=dictionary_path,
        path=str(tmp_path / "scoring"), table="plan_scoring")
    assert scored.count() == 200 and scored.columns == ["client_id", "pred"]
    assert as_tuples(spark.table("plan_scoring")) == as_tuples(scored)
    assert as_tuples(spark.read.csv(str(tmp_path / "scoring"), header=True, schema="client_id bigint, pred double")) == as_tuples(scored)
    assert histogram.agg(F.sum("n")).first()[0] == 200
    truth = tables("plan_num").select("client_id", (F.col("good") > 0.5).alias("high"))
    means = {row["high"]: row["p"] for row in scored.join(truth, "client_id").groupBy("high").agg(F.avg("pred").alias("p")).collect()}
    assert means[True] > means[False]


def test_selection_without_permutation(spark, tables):
    selection = select_features(
        tables("plan_train"), registry_from(spark, SETS), tables,
        SelectSettings(target="target", except_sets="cat", permutation=False, top=1, forest={"trees": 5, "max_depth": 3, "max_features": 1.0}))
    assert [one.features for one in chosen_sets(selection.registry)] == [("good",)]


def test_text_features_need_their_dictionary(spark, tables):
    with pytest.raises(ValueError, match="kind"):
        score_population(tables("plan_test"), registry_from(spark, SETS), tables, None, ScoreSettings())


def folders(spark):
    home = Path(urlparse(shared_folder(spark)).path) / "lift"
    return {path.name.rsplit("-", 1)[0] for path in home.iterdir()} if home.exists() else set()


def test_names_of_all_kinds_end_to_end_and_nothing_left_but_results(spark, tmp_path):
    names = ["weight", "cuts", "fold", "features", "prediction", "a.b", "flag"]
    ids = spark.range(400).withColumnRenamed("id", "client_id")
    table = ids.where("client_id % 5 <> 0").select("client_id", *[F.pmod(F.xxhash64("client_id", F.lit(i)), F.lit(50)).alias(name) for i, name in enumerate(names[:-1])],
                                                   (F.col("client_id") % 3 == 0).alias("flag"))
    train = ids.join(table, "client_id", "left").select("client_id", (F.coalesce(F.col("`a.b`"), F.lit(0)) > 25).cast("int").alias("target"))
    registry = registry_from(spark, [{"name": "all", "class": "main", "type": "numerical", "source": "t", "features": names}])
    tables = {"t": table}
    before = folders(spark)
    path = str(tmp_path / "top")
    selection = select_features(train, registry, tables, SelectSettings(target="target", narrow=True, forest={"trees": 10, "max_depth": 4, "max_features": 1.0}), path)
    assert selection.top.first()["feature"] == "a.b"
    assert folders(spark) - before <= {"importances", "auc", "saved"}
    with pytest.raises(ValueError, match="fold"):
        build_model(train, registry, tables, BuildSettings(target="target", ranges=RANGES, cv_splits=2, init_points=1, n_iter=0))
    built = build_model(train, load_registry(spark, path), tables, BuildSettings(target="target", ranges=RANGES, cv_splits=2, init_points=1, n_iter=0, narrow=True),
                        model_path=str(tmp_path / "model"))
    assert built.sizes["load"][0] == 400 and built.metrics["roc_auc"].where("auc > 0.9").count() == 2
    scored, histogram = score_population(ids, load_registry(spark, path), tables, str(tmp_path / "model"), ScoreSettings())
    assert scored.count() == 400 and histogram.count() > 0
    assert not {"wide", "ready", "order", "scores", "curves", "dictionary", "categories", "select", "build"} & (folders(spark) - before)
