from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from lift.operators import evaluate as V

from conftest import as_tuples


def frame(spark, y, p):
    return spark.createDataFrame([(int(a), float(b)) for a, b in zip(y, p)], "y int, p double")


def counts(spark, y, p):
    return V.score_counts(frame(spark, y, p), "y", "p")


@pytest.fixture(scope="module")
def sample():
    rng = np.random.default_rng(11)
    y = (rng.random(1200) < 0.3).astype(int)
    return y, np.round(np.clip(0.4 * y + rng.random(1200) * 0.7, 0, 1), 2)


def brute_auc(y, p):
    pos, neg = p[y == 1], p[y == 0]
    return ((pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()) / (len(pos) * len(neg))


def test_small_example(spark):
    c = counts(spark, [0, 0, 1, 1], [0.1, 0.6, 0.4, 0.9])
    assert V.roc_auc(c).first()["auc"] == 0.75
    assert tuple(V.threshold_metrics(c, 0.5).first()) == ("all", 50.0, 50.0, 50.0)
    assert as_tuples(V.roc_points(c), "threshold", "fpr", "tpr") == [(0.1, 1.0, 1.0), (0.4, 0.5, 1.0), (0.6, 0.5, 0.5), (0.9, 0.0, 0.5), (None, 0.0, 0.0)]
    assert as_tuples(V.pr_points(c), "threshold", "recall", "precision") == [
        (0.1, 1.0, 0.5), (0.4, 1.0, 2 / 3), (0.6, 0.5, 0.5), (0.9, 0.5, 1.0), (None, 0.0, 1.0)]
    assert V.average_precision(c).first()["average_precision"] == pytest.approx(0.5 * 1 + 0.5 * 2 / 3)


@pytest.mark.parametrize("n", [1, 3, 16])
def test_auc_and_ap_against_brute_force(spark, sample, pieces, n):
    pieces(n)
    y, p = sample
    c = counts(spark, y, p)
    assert V.roc_auc(c).first()["auc"] == pytest.approx(brute_auc(y, p), abs=1e-12)
    ap = last = 0.0
    for t in sorted(set(p), reverse=True):
        tp, fp = ((p >= t) & (y == 1)).sum(), ((p >= t) & (y == 0)).sum()
        ap += (tp / y.sum() - last) * tp / (tp + fp)
        last = tp / y.sum()
    assert V.average_precision(c).first()["average_precision"] == pytest.approx(ap, abs=1e-12)


def test_auc_equals_the_evaluator_used_for_folds(spark, sample):
    y, p = sample
    df = frame(spark, y, p).withColumn("label", F.col("y").cast("double"))
    judged = BinaryClassificationEvaluator(rawPredictionCol="p", labelCol="label", numBins=0).evaluate(df)
    assert V.roc_auc(counts(spark, y, p)).first()["auc"] == pytest.approx(judged, abs=1e-9)


def test_hot_score(spark, pieces):
    pieces(8)
    rng = np.random.default_rng(1)
    y = rng.integers(0, 2, 3000)
    p = np.where(rng.random(3000) < 0.4, 0.5, rng.random(3000))
    assert V.roc_auc(counts(spark, y, p)).first()["auc"] == pytest.approx(brute_auc(y, p), abs=1e-12)


def test_one_class_only(spark):
    c = counts(spark, [1, 1], [0.2, 0.9])
    assert V.roc_auc(c).first()["auc"] is None
    assert as_tuples(V.roc_points(c), "threshold", "fpr", "tpr")[0] == (0.2, None, 1.0)
    assert tuple(V.threshold_metrics(c, 0.5).first()) == ("all", 100.0, 50.0, None)


def test_labels_and_scores_are_checked(spark):
    for rows in ([(2, 0.5)], [(None, 0.5)], [(1, None)], [(1, float("nan"))], [(1, float("inf"))]):
        with pytest.raises(Exception, match="must"):
            V.score_counts(spark.createDataFrame(rows, "y int, p double"), "y", "p")


def test_threshold_is_strict_and_empty_cells_are_kept(spark):
    c = counts(spark, [1, 0], [0.5, 0.5])
    assert as_tuples(V.confusion(c, 0.5), "actual", "predicted", "n") == [(0, 0, 1), (0, 1, 0), (1, 0, 1), (1, 1, 0)]
    assert tuple(V.threshold_metrics(c, 0.5).first())[1:3] == (0.0, 0.0)


def test_confusion_of_given_labels(spark):
    c = counts(spark, [1, 0, 1, 1], [1, 1, 0, 1])
    assert as_tuples(V.confusion(c, None), "actual", "predicted", "n") == [(0, 0, 0), (0, 1, 1), (1, 0, 1), (1, 1, 2)]


def test_last_bin_is_closed_and_edges_go_up(spark):
    edges = [i * 0.02 for i in range(50)] + [1.0]
    c = counts(spark, [1] * 51, edges)
    got = {row["bin"]: row["n"] for row in V.probability_histogram(c).collect()}
    assert got == {i: 1 for i in range(1, 50)} | {50: 2}


def test_probability_histogram_equals_numpy(spark, sample):
    y, p = sample
    rows = V.probability_histogram(counts(spark, y, p)).collect()
    for label in (0, 1):
        n, _ = np.histogram(p[y == label], bins=np.linspace(0, 1, 51))
        density, _ = np.histogram(p[y == label], bins=np.linspace(0, 1, 51), density=True)
        mine = sorted((r["bin"], r["n"], r["density"]) for r in rows if r["label"] == label)
        assert [m[1] for m in mine] == n.tolist()
        assert [m[2] for m in mine] == pytest.approx(density.tolist())


@pytest.mark.parametrize("n", [1, 8])
def test_score_histogram_chooses_bins_by_the_data(spark, sample, pieces, n):
    pieces(n)
    y, p = sample
    q1, q3 = np.percentile(p, [25, 75])
    bins = min(50, math.ceil((p.max() - p.min()) / (2 * (q3 - q1) / len(p) ** (1 / 3))))
    expected, edges = np.histogram(p, bins=bins)
    rows = sorted(V.score_histogram(counts(spark, y, p)).collect(), key=lambda r: r["bin"])
    assert [r["n"] for r in rows] == expected.tolist()
    assert [r["lower"] for r in rows] + [rows[-1]["upper"]] == pytest.approx(edges.tolist())


def test_score_histogram_of_equal_scores(spark):
    rows = V.score_histogram(counts(spark, [0, 1, 1, 0], [0.5] * 4)).collect()
    assert sum(r["n"] for r in rows) == 4 and len(rows) == 2


def test_density_is_the_kernel_estimate(spark, sample):
    y, p = sample
    rows = V.density_curve(counts(spark, y, p), points=20).collect()
    for label in (0, 1):
        x = p[y == label]
        h = x.std(ddof=1) * len(x) ** -0.2
        grid = np.linspace(x.min() - 3 * h, x.max() + 3 * h, 20)
        expected = np.exp(-0.5 * ((grid[:, None] - x[None, :]) / h) ** 2).sum(axis=1) / (len(x) * h * math.sqrt(2 * math.pi))
        mine = sorted((r["point"], r["x"], r["density"]) for r in rows if r["label"] == label)
        assert [m[1] for m in mine] == pytest.approx(grid.tolist())
        assert [m[2] for m in mine] == pytest.approx(expected.tolist(), abs=1e-12)


@pytest.mark.parametrize("fineness", [8, 256])
def test_density_over_nodes_is_within_its_bound(spark, fineness):
    rng = np.random.default_rng(4)
    p = np.concatenate([rng.beta(2, 5, 3000), [0.0, 1.0, 0.999]])
    y = np.arange(len(p)) % 2
    rows = V.density_curve(counts(spark, y, p), points=40, exact=100, fineness=fineness).collect()
    for label in (0, 1):
        x = p[y == label]
        h = x.std(ddof=1) * len(x) ** -0.2
        grid = np.linspace(x.min() - 3 * h, x.max() + 3 * h, 40)
        expected = np.exp(-0.5 * ((grid[:, None] - x[None, :]) / h) ** 2).sum(axis=1) / (len(x) * h * math.sqrt(2 * math.pi))
        mine = np.array([d for _, d in sorted((r["point"], r["density"]) for r in rows if r["label"] == label)])
        assert 0 < np.abs(mine - expected).max() <= 0.05 / (h * fineness**2)


def test_density_far_from_all_scores_is_zero(spark):
    """Two narrow crowds a million bandwidths apart: most points see no score."""
    p = [i * 1e-9 for i in range(2000)] + [1 - i * 1e-9 for i in range(2)]
    rows = V.density_curve(counts(spark, [1] * len(p), p), points=50).collect()
    assert len(rows) == 50 and all(r["density"] is not None for r in rows)
    same = V.density_curve(counts(spark, [0] * 3, [0.5] * 3), points=7).collect()
    assert len(same) == 7 and all(r["density"] is None for r in same)


def test_metric_set_keeps_the_parts_apart(spark, sample):
    y, p = sample
    df = frame(spark, y, p).withColumn("part", F.when(F.monotonically_increasing_id() % 3 == 0, "holdout").otherwise("train"))
    made = V.metric_set(V.score_counts(df, "y", "p", "part"), threshold=0.45)
    assert {r["set"] for r in made["roc_auc"].collect()} == {"train", "holdout"}
    assert {r["set"] for r in made["average_precision"].collect()} == {"holdout"}
    held = df.where("part = 'holdout'").toPandas()
    auc = {r["set"]: r["auc"] for r in made["roc_auc"].collect()}
    assert auc["holdout"] == pytest.approx(brute_auc(held["y"].to_numpy(), held["p"].to_numpy()))
    assert made["conf_matrix"].agg(F.sum("n")).first()[0] == len(held)
    assert set(V.metric_set(V.score_counts(df, "y", "p", "part"), ["conf_matrix"])) == {"conf_matrix", "threshold_metrics"}
    with pytest.raises(ValueError, match="unknown"):
        V.metric_set(V.score_counts(df, "y", "p", "part"), ["roc"])


def test_top_importances_break_ties_by_name(spark):
    df = spark.createDataFrame([("b", 0.5), ("a", 0.5), ("c", 0.9)], "feature string, importance double")
    assert [r["feature"] for r in V.top_importances(df, 2).collect()] == ["c", "a"]


def test_any_number_of_sets(spark):
    df = spark.range(3000).select((F.col("id") % 150).alias("part"), (F.floor(F.col("id") / 150) % 3 == 0).cast("int").alias("y"), (F.col("id") % 97 / 97.0).alias("p"))
    found = V.score_counts(df, "y", "p", "part")
    assert V.roc_auc(found).count() == 150
    assert V.density_curve(found).groupBy("set", "label").count().where("count = 100").count() == 300
    assert V.score_histogram(found).select("set").distinct().count() == 150
