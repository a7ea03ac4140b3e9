from __future__ import annotations

import hashlib
import math

import pytest
from pyspark.sql import functions as F

from catalogue.fixtures import SETS_A
from lift.operators import boosting as B
from lift.operators import forest as RF
from lift.operators import registry as R
from lift.operators import split as S
from lift.sources.shared import materialise

from conftest import as_tuples

FEATURES = ["signal", "noise", "flat"]
PARAMS = {"num_iterations": 5, "max_depth": 3, "num_leaves": 8, "learning_rate": 0.3, "max_bin": 32, "min_data_in_leaf": 5}


@pytest.fixture(scope="module")
def rows(spark):
    """The target is 1 when ``signal`` is above 0.6, with a tenth of the labels flipped."""
    df = spark.range(1500).select(
        "id", (F.pmod(F.xxhash64("id"), F.lit(1000)) / 1000.0).alias("signal"),
        (F.pmod(F.xxhash64("id", F.lit("n")), F.lit(1000)) / 1000.0).alias("noise"), F.lit(1).alias("flat"))
    flip = F.pmod(F.xxhash64("id", F.lit("f")), F.lit(10)) == 0
    return materialise(df.withColumn("y", ((F.col("signal") > 0.6) != flip).cast("int")), "rows")


@pytest.fixture(scope="module")
def parts(rows):
    parted = materialise(S.holdout(rows, "id", "y", 0.3, 1), "parts")
    return parted.where("split = 'train'"), parted.where("split = 'holdout'")


def test_impurity_importances_sum_to_one_and_find_the_signal(rows):
    model = RF.fit_forest(rows, FEATURES, "y", trees=10, max_depth=4, seed=3)
    found = {row["feature"]: row["importance"] for row in RF.impurity_importance(model, FEATURES, rows).collect()}
    assert sum(found.values()) == pytest.approx(1.0)
    assert max(found, key=found.get) == "signal" and found["flat"] == 0.0


def test_permutation_importance_with_a_forest(parts):
    train, test = parts
    importances, auc = RF.feature_importances(train, test, FEATURES, "y", "id", trees=10, max_depth=4, seed=3)
    found = {row["feature"]: row["importance"] for row in importances.collect()}
    assert found["signal"] > 0.2 and abs(found["noise"]) < 0.1 and found["flat"] == 0.0
    assert auc.first()["auc"] > 0.8


def by_hand(rows, features, seed, group_rows, rule):
    """The permutation as the docstring tells it, row by row."""
    groups = max(1, math.ceil(len(rows) / group_rows))
    keyed = sorted((hashlib.md5(f"{seed}|{r['id']}".encode()).hexdigest(), r) for r in rows)
    by_group: dict[int, list] = {}
    for h, r in keyed:
        by_group.setdefault(int(h[:8], 16) % groups, []).append(r)
    base = sum(rule([r[f] for f in features]) == r["y"] for r in rows)
    out = {}
    for k, name in enumerate(features):
        hits, moved = 0, []
        for members in by_group.values():
            c = len(members)
            shift = 1 + (k * 7919) % (c - 1) if c > 1 else 0
            for i, r in enumerate(members):
                x = [r[f] for f in features]
                x[k] = members[(i + shift) % c][name]
                moved.append(x[k])
                hits += rule(x) == r["y"]
        assert sorted(moved) == sorted(r[name] for r in rows)
        out[name] = (base - hits) / len(rows)
    return out


@pytest.mark.parametrize("n, group_rows", [(1, 1024), (4, 100), (16, 7), (4, 1)])
def test_permutation_importance_against_brute_force(rows, pieces, n, group_rows):
    pieces(n)
    found = RF.permutation_importance(
        rows.repartition(n), FEATURES, "y", "id", lambda df: df.withColumn("prediction", F.expr("cast(x[0] + x[1] / 10 > 0.65 as double)")),
        seed=4, group_rows=group_rows)
    expected = by_hand([row.asDict() for row in rows.collect()], FEATURES, 4, group_rows, lambda x: int(x[0] + x[1] / 10 > 0.65))
    got = {row["feature"]: row["importance"] for row in found.collect()}
    assert got == pytest.approx(expected, abs=1e-12) and got["flat"] == 0.0


@pytest.mark.parametrize("n_features, trees", [(3, 30), (70, 12)])
def test_forest_permutation_equals_moved_rows_scored_whole(spark, parts, n_features, trees, monkeypatch):
    """Beside 64 features, over several slices of trees, with missing-like and equal values."""
    monkeypatch.setattr("lift.operators.trees.PAIRS", 4000)
    train, test = ((df.select("id", "y", "signal", "noise", "flat", *[
        (F.pmod(F.xxhash64("id", F.lit(i)), F.lit(5)) + F.col("signal") * (i % 3)).alias(f"x{i}") for i in range(n_features - 3)]) for df in parts))
    names = [name for name in train.columns if name not in ("id", "y")]
    model = RF.fit_forest(train, names, "y", trees=trees, max_depth=6, seed=3, max_features=0.4)
    importances, counts = RF.forest_permutation(test, names, "y", "id", model, seed=4, group_rows=100)
    whole = RF.permutation_importance(test, names, "y", "id", RF.forest_predictor(model), seed=4, group_rows=100)
    assert as_tuples(importances) == as_tuples(whole)
    scored = model.transform(test).select("y", RF.probability_of_one(F.col(RF.PROBABILITY)).alias("pred"))
    assert as_tuples(counts) == as_tuples(RF.score_counts(scored, "y", "pred"))


def test_only_rows_that_a_test_sends_another_way_are_walked_again(monkeypatch):
    import numpy as np
    from lift.operators.trees import FlatForest

    # x0 <= 1 ? (x1 <= 5 ? a : b) : (x0 <= 3 ? c : d)
    forest = FlatForest(np.array([0]), np.array([0, 1, 0, -1, -1, -1, -1]), np.array([1.0, 5, 3, 0, 0, 0, 0]), np.array([1, 3, 5, -1, -1, -1, -1]),
                        np.array([2, 4, 6, -1, -1, -1, -1]), np.array([[0.5, 0.5, 0.5, 0.9, 0.8, 0.7, 0.6], [0.5, 0.5, 0.5, 0.1, 0.2, 0.3, 0.4]]))
    x, z = np.array([[0.0, 4.0], [2.0, 4.0], [4.0, 6.0]]), np.array([[1.0, 6.0], [3.0, 0.0], [0.0, 0.0]])
    walk, walked = FlatForest.walk, []
    monkeypatch.setattr(FlatForest, "walk", lambda self, x, node, row, *more: walked.append(len(row)) or walk(self, x, node, row, *more))
    votes = {f: v[0].tolist() for f, v in forest.moved(x, z, [0, 1])}
    assert votes == {-1: [0.9, 0.7, 0.6], 0: [0.9, 0.7, 0.8], 1: [0.8, 0.7, 0.6]}
    assert walked == [2]


def test_a_fit_has_few_partitions_for_few_rows(rows, pieces, monkeypatch):
    """Each partition counts every node, so the session's number is a limit only."""
    ordered, found = RF.in_training_order, []
    monkeypatch.setattr(RF, "in_training_order", lambda *a, **k: found.append(ordered(*a, **k)) or found[-1])
    pieces(200)
    RF.fit_forest(rows, FEATURES, "y", trees=2, max_depth=2)
    assert found[0].rdd.getNumPartitions() == RF.FEW_PIECES


def test_trees_fitted_some_at_a_time_are_one_forest(rows, monkeypatch):
    import numpy as np

    monkeypatch.setattr(RF, "TREES_AT_ONCE", 4)
    model = RF.fit_forest(rows, FEATURES, "y", trees=10, max_depth=4, seed=3)
    parts = [RF.fit_forest(rows, FEATURES, "y", trees=n, max_depth=4, seed=3 + i).stages[-1] for i, n in enumerate((4, 4, 2))]
    trees = [tree for part in parts for tree in part.trees]
    assert model.stages[-1].getNumTrees == 10 and [t.numNodes for t in model.stages[-1].trees] == [t.numNodes for t in trees]
    each = sum(tree.featureImportances.toArray() for tree in trees)
    assert np.allclose(model.stages[-1].featureImportances.toArray(), each / each.sum())
    votes = {row["id"]: row[RF.RAW].toArray() for row in model.transform(rows).collect()}
    for part in parts:
        for row in part.transform(model.transform(rows).select("id", RF.VECTOR)).collect():
            votes[row["id"]] = votes[row["id"]] - row[RF.RAW].toArray()
    assert all(abs(v).max() < 1e-9 for v in votes.values())


def test_forest_permutation_of_one_row_and_of_no_used_feature(parts):
    train, test = parts
    model = RF.fit_forest(train, FEATURES, "y", trees=5, max_depth=3, seed=3)
    importances, counts = RF.forest_permutation(test.limit(1), FEATURES, "y", "id", model, only=[])
    assert as_tuples(importances) == [("flat", 0.0), ("noise", 0.0), ("signal", 0.0)] and counts.count() == 1
    importances, counts = RF.forest_permutation(test.where("id < 0"), FEATURES, "y", "id", model)
    assert as_tuples(importances) == [("flat", 0.0), ("noise", 0.0), ("signal", 0.0)] and not counts.count()


def test_permutation_threshold_is_strict_and_top_does_not_apply(spark):
    registry = R.registry_from(spark, SETS_A)
    importances = spark.createDataFrame(
        [("set1_order_sum", 0.02), ("set4_qty", 0.01), ("set2_urgent", 0.0005), ("set5_nation", -0.001)], "feature string, importance double")
    assert as_tuples(RF.export_top(registry, importances, top=1), "feature") == [("set1_order_sum",), ("set4_qty",)]
    assert as_tuples(RF.export_top(registry, importances, permutation=False, top=3), "feature") == [("set1_order_sum",), ("set2_urgent",), ("set4_qty",)]


def test_parameter_names():
    full = {name: high for name, (low, high) in B.DEFAULT_RANGES.items()}
    assert B.spark_params(full) == {
        "maxDepth": 5, "maxIter": 600, "minInstancesPerNode": 400, "maxBins": 1200, "stepSize": 0.5, "minInfoGain": 0.03,
        "subsamplingRate": 0.9, "featureSubsetStrategy": "all"}
    assert B.spark_params({"num_iterations": 99.9, "max_depth": 3.7, "num_leaves": 20.0, "subsample": 0.7, "colsample_bytree": 0.8}) == {
        "maxDepth": 3, "maxIter": 99, "subsamplingRate": 0.7, "featureSubsetStrategy": "0.8"}


def test_class_weights(spark):
    df = spark.createDataFrame([(0,), (1,)], "y int").select("y", B.class_weight("y", 10, 40).alias("w"))
    assert as_tuples(df) == [(0, 1.0), (1, 4.0)]


def test_boosted_model_learns_repeats_and_survives_saving(parts, tmp_path):
    train, test = parts
    model = B.fit_boosted(train, FEATURES, "y", PARAMS, seed=2)
    scored = B.score(model, test)
    assert scored.columns == [*test.columns, "pred"] and scored.count() == test.count()
    preds = as_tuples(scored, "id", "pred")
    assert all(0 <= p <= 1 for _, p in preds)
    B.save_model(model, str(tmp_path / "model"))
    assert as_tuples(B.score(B.load_model(str(tmp_path / "model")), test), "id", "pred") == preds
    assert as_tuples(B.score(B.fit_boosted(train, FEATURES, "y", PARAMS, seed=2), test), "id", "pred") == preds


def test_search_is_repeatable_and_reports_its_trials(rows):
    folded = materialise(S.folds(rows, "id", "y", 2, 1), "folded")
    ranges = {"num_iterations": (2, 4), "max_depth": (1, 3), "learning_rate": (0.1, 0.5)}
    one = B.search(folded, FEATURES, "y", ranges, init_points=2, n_iter=1, seed=8, parallelism=1)
    two = B.search(folded, FEATURES, "y", ranges, init_points=2, n_iter=1, seed=8, parallelism=3)
    trials = as_tuples(one.trials)
    assert trials == as_tuples(two.trials) and len(trials) == 3
    assert one.auc == max(row["auc"] for row in one.trials.collect()) > 0.75
    assert all(low <= one.best[name] <= high for name, (low, high) in ranges.items())


def test_halving_finds_the_best_of_a_full_run(rows):
    folded = materialise(S.folds(rows, "id", "y", 3, 1), "folded")
    ranges = {"num_iterations": (6, 9), "max_depth": (1, 3), "learning_rate": (0.001, 0.6)}
    full = B.search(folded, FEATURES, "y", ranges, init_points=6, n_iter=0, seed=4)
    short = B.search(folded, FEATURES, "y", ranges, init_points=6, n_iter=0, seed=4, halving=B.Halving(rungs=((1 / 3, 1 / 3), (1.0, 1.0))))
    assert short.best == full.best and short.auc == full.auc
    rungs = {row["trial"]: row["rung"] for row in short.trials.collect()}
    assert sorted(rungs.values()) == [1, 1, 1, 1, 2, 2] and "rung" not in full.trials.columns
    stopped = B.search(folded, FEATURES, "y", ranges, init_points=2, n_iter=2, seed=4, halving=B.Halving(tolerance=0.5))
    assert sorted(row["rung"] for row in stopped.trials.collect()) == [1, 1, 3, 3] and stopped.auc > 0.6
    with pytest.raises(ValueError, match="shares"):
        B.search(folded, FEATURES, "y", ranges, halving=B.Halving(rungs=((0.0, 1.0),)))


@pytest.mark.parametrize("id_column", [None, "id"])
def test_models_do_not_depend_on_the_input_partitions(rows, id_column):
    layouts = [rows.coalesce(1), rows.repartition(3), rows.repartition(8, "noise")]
    forests = [RF.fit_forest(df, FEATURES, "y", trees=5, max_depth=4, max_features=1.0, id_column=id_column) for df in layouts]
    assert len({model.stages[-1].toDebugString.split("\n", 1)[1] for model in forests}) == 1
    boosted = [as_tuples(B.score(B.fit_boosted(df, FEATURES, "y", PARAMS, seed=2, id_column=id_column), rows), "id", "pred") for df in layouts]
    assert boosted[0] == boosted[1] == boosted[2]


def test_features_of_any_name(rows):
    names = ["weight", "split", "cuts", "features", "prediction", "probability", "a.b", "__lift", "label"]
    odd = rows.select("id", "y", *[(F.col("signal") if i == 6 else F.col("noise") * i).alias(name) for i, name in enumerate(names)])
    model = B.fit_boosted(odd, names, "y", PARAMS, seed=2)
    scored = B.score(model, odd)
    assert scored.columns == [*odd.columns, "pred"]
    assert scored.select(F.corr("pred", "y")).first()[0] > 0.6
    forest = RF.fit_forest(odd, names, "y", trees=5, max_depth=3, max_features=1.0)
    assert max(RF.impurity_importance(forest, names, odd).collect(), key=lambda row: row["importance"])["feature"] == "a.b"
    named_folds = S.folds(odd, "id", "y", 2, 1)
    trials = B.search(named_folds, names, "y", {"num_iterations": (2, 3)}, init_points=1, n_iter=0, seed=1).trials
    assert trials.first()["auc"] > 0.7
    for taken in ("pred", "fold"):
        with pytest.raises(ValueError, match=taken):
            B.score(model, odd.withColumn("pred", F.lit(1))) if taken == "pred" else S.folds(odd.withColumn("fold", F.lit(1)), "id", "y")
