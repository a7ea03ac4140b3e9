"""Boosted-tree classifier, its search, persistence and batch scoring (ML6-ML10)."""

from __future__ import annotations

import math
import random
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lift.functions.columns import free_of, in_training_order, label_of, named, probability_of_one
from lift.operators.forest import KEY, LABEL, PREDICTION, PROBABILITY, RAW, VECTOR, WEIGHT, vector_stages

# The search ranges of a project that does not set its own.
DEFAULT_RANGES: dict[str, tuple[float, float]] = {
    "num_leaves": (10, 20),
    "num_iterations": (80, 600),
    "min_data_in_leaf": (100, 400),
    "max_depth": (8, 15),
    "bagging_fraction": (0.6, 0.9),
    "feature_fraction": (0.6, 1.0),
    "max_bin": (500, 1200),
    "colsample_bytree": (0.7, 0.9),
    "learning_rate": (0.01, 0.5),
    "subsample": (0.6, 0.9),
    "min_gain_to_split": (0.01, 0.03),
}


def spark_params(params: Mapping[str, float]) -> dict:
    """Boosting parameters by their usual names, as those of ``GBTClassifier``.

    Counts are cut to whole numbers. Trees grow by level here, so a number of
    leaves limits the depth. ``bagging_fraction`` and ``subsample`` name one
    setting, as do ``feature_fraction`` and ``colsample_bytree``; the first wins.
    """
    out: dict = {}
    depth = [int(params["max_depth"])] if "max_depth" in params else []
    if "num_leaves" in params:
        depth.append(math.ceil(math.log2(int(params["num_leaves"]))))
    if depth:
        out["maxDepth"] = max(1, min(depth))
    for name, spark_name in (("num_iterations", "maxIter"), ("min_data_in_leaf", "minInstancesPerNode"), ("max_bin", "maxBins")):
        if name in params:
            out[spark_name] = int(params[name])
    for name, spark_name in (("learning_rate", "stepSize"), ("min_gain_to_split", "minInfoGain")):
        if name in params:
            out[spark_name] = float(params[name])
    rows = params.get("bagging_fraction", params.get("subsample"))
    if rows is not None:
        out["subsamplingRate"] = float(rows)
    columns = params.get("feature_fraction", params.get("colsample_bytree"))
    if columns is not None:
        out["featureSubsetStrategy"] = "all" if columns >= 1.0 else str(float(columns))
    return out


def class_weight(target: str, positives: int, negatives: int) -> Column:
    """Weight of a row such that both classes count the same; the larger class has weight 1."""
    larger = max(positives, negatives)
    return F.when(label_of(target) == 1, F.lit(larger / max(positives, 1))).otherwise(F.lit(larger / max(negatives, 1)))


def _counts(df: DataFrame, target: str, *by: str) -> dict:
    rows = df.groupBy(*by).agg(F.count_if(label_of(target) == 1).alias("pos"), F.count_if(label_of(target) == 0).alias("neg")).collect()
    return {tuple(row[name] for name in by): (row["pos"], row["neg"]) for row in rows}


def _classifier(params: Mapping[str, float], seed: int) -> GBTClassifier:
    trees = GBTClassifier(featuresCol=VECTOR, labelCol=LABEL, weightCol=WEIGHT, predictionCol=PREDICTION, seed=seed, cacheNodeIds=True, **spark_params(params))
    return trees.setProbabilityCol(PROBABILITY).setRawPredictionCol(RAW)


@dataclass(frozen=True)
class Halving:
    """A schedule that gives whole fits to the best trials of a generation only.

    Every trial of a generation takes the first rung, with a share of its
    iterations on a share of the folds; of the trials of a rung the best ``keep``
    (at least one) go on to the next. The last rung should be whole, as its AUC is what
    trials are compared by in the end. With ``tolerance`` a fit also ends once its loss on one more fold, which
    it doesn't learn from, improves by less; that needs three folds, and learns from one fold less.

    With the default rungs a generation of five trials of four folds costs about five whole fits in place of twenty.
    """

    rungs: Sequence[tuple[float, float]] = ((1 / 9, 1 / 4), (1 / 3, 1 / 2), (1.0, 1.0))
    keep: float = 1 / 3
    tolerance: float | None = None


def fit_boosted(train: DataFrame, features: Sequence[str], target: str, params: Mapping[str, float], *, seed: int = 1,
                id_column: str | None = None) -> PipelineModel:
    """ML6: a boosted-tree classifier for a 0/1 target, classes balanced by weight."""
    [(pos, neg)] = _counts(train, target).values()
    ids = [] if id_column is None else [named(id_column).alias(KEY)]
    rows = train.select(label_of(target).alias(LABEL), *ids, *[named(name) for name in features], class_weight(target, pos, neg).alias(WEIGHT))
    keys = [] if id_column is None else [F.col(KEY)]
    return Pipeline(stages=[*vector_stages(features), _classifier(params, seed)]).fit(in_training_order(rows, *keys))


def fold_auc(vectors: DataFrame, params: Mapping[str, float], counts: Mapping[tuple, tuple[int, int]], *, seed: int = 1,
             judged: int | None = None, tolerance: float | None = None) -> float:
    """ML7: fit on all folds but one, take the AUC on that one, and average over the folds.

    ``vectors`` has the vector, the label and the column ``fold``; ``counts``
    the class counts per fold. ``judged`` takes only so many of the folds in turn;
    ``tolerance`` ends a fit early (see ``Halving``).
    """
    judge = BinaryClassificationEvaluator(labelCol=LABEL, rawPredictionCol=RAW, metricName="areaUnderROC", numBins=0)
    every, total = sorted(fold for (fold,) in counts), 0.0
    chosen = every[:judged]
    for fold in chosen:
        watched = every[(every.index(fold) + 1) % len(every)] if tolerance is not None and len(every) > 2 else None
        learnt = [counts[(f,)] for f in every if f not in (fold, watched)]
        weight = class_weight(LABEL, sum(p for p, _ in learnt), sum(n for _, n in learnt))
        rest, trees = vectors.where(F.col("fold") != fold).withColumn(WEIGHT, weight), _classifier(params, seed)
        if watched is not None:
            rest = rest.withColumn(WATCHED, F.col("fold") == watched)
            trees = trees.setValidationIndicatorCol(WATCHED).setParams(validationTol=tolerance)
        total += judge.evaluate(trees.fit(rest).transform(vectors.where(F.col("fold") == fold)))
    return total / len(chosen)


@dataclass(frozen=True)
class Search:
    """The outcome of a search: the trial table ``(trial, <params>, auc)`` and the best parameters.

    After a search by halving the table has a column ``rung`` too, the last one
    that a trial took (from 1); its AUC is that rung's.
    """

    trials: DataFrame
    best: dict[str, float]
    auc: float


GENERATION = 5
#: Iterations of a trial whose box has no range for them: what the classifier does by itself.
DEFAULT_ITERATIONS = 20
WATCHED = "__lift_watched"


def search(train: DataFrame, features: Sequence[str], target: str, ranges: Mapping[str, Sequence[float]] = DEFAULT_RANGES, *,
           init_points: int = 5, n_iter: int = 100, seed: int = 1, parallelism: int = 4, id_column: str | None = None,
           halving: Halving | None = None) -> Search:
    """ML8: maximise the mean fold AUC over a box of parameters.

    ``train`` has a ``fold`` column. The first ``init_points`` trials are spread
    over the box. The others come in generations, drawn near the best trial so
    far from a box that shrinks, every fifth one from the whole box again. The
    draws depend on the seed and the results alone, not on ``parallelism``, the
    number of trials fitted side by side. With ``halving`` only the best of a generation are fitted whole, and only
    those are compared in the end.
    """
    if halving and any(not 0 < share <= 1 for rung in halving.rungs for share in rung):
        raise ValueError("rungs are shares of the iterations and of the folds, above 0 and up to 1")
    if "fold" in features:
        raise ValueError("fold is the column of the folds and cannot be a feature")
    counts = _counts(train, target, "fold")
    ids = [] if id_column is None else [named(id_column).alias(KEY)]
    rows = train.select("fold", label_of(target).alias(LABEL), *ids, *[named(name) for name in features])
    ordered = in_training_order(rows, *([] if id_column is None else [F.col(KEY)]))
    vectors = PipelineModel(vector_stages(features)).transform(ordered).select(VECTOR, "fold", LABEL).persist(StorageLevel.MEMORY_AND_DISK)
    draw = random.Random(seed)
    names = sorted(ranges)
    done: list[tuple[dict[str, float], float, int]] = []
    rungs = halving.rungs if halving else ((1.0, 1.0),)
    try:
        def evaluate(params: dict[str, float], rung: int) -> float:
            iterations, judged = rungs[rung]
            some = dict(params)
            if iterations < 1:
                some["num_iterations"] = max(1.0, int(params.get("num_iterations", DEFAULT_ITERATIONS)) * iterations)
            return fold_auc(vectors, some, counts, seed=seed, judged=max(1, round(judged * len(counts))), tolerance=halving.tolerance if halving else None)

        def run(batch: list[dict[str, float]]) -> None:
            going, took = list(range(len(batch))), {}
            with ThreadPoolExecutor(max(1, parallelism)) as pool:
                for rung in range(len(rungs)):
                    tasks = [pool.submit(inheritable_thread_target(train.sparkSession)(evaluate), batch[i], rung) for i in going]
                    took |= {i: (task.result(), rung + 1) for i, task in zip(going, tasks)}
                    best_first = sorted(going, key=lambda i: (-took[i][0], i))
                    going = sorted(best_first[:max(1, int(len(going) * halving.keep + 1e-9))]) if halving else going
            done.extend((params, *took[i]) for i, params in enumerate(batch))

        def leading() -> tuple[dict[str, float], float, int]:
            return max(done, key=lambda trial: (trial[2], trial[1]))

        def anywhere() -> dict[str, float]:
            return {name: draw.uniform(*ranges[name]) for name in names}

        def near(best: Mapping[str, float], reach: float) -> dict[str, float]:
            out = {}
            for name in names:
                low, high = ranges[name]
                half = reach * (high - low) / 2
                out[name] = draw.uniform(max(low, best[name] - half), min(high, best[name] + half))
            return out

        run([anywhere() for _ in range(max(1, init_points))])
        left, reach = n_iter, 0.5
        while left > 0:
            best = leading()[0]
            batch = [anywhere() if i % 5 == 4 else near(best, reach) for i in range(min(GENERATION, left))]
            run(batch)
            left, reach = left - len(batch), max(0.1, reach * 0.9)
    finally:
        vectors.unpersist()
    rows = [(i, *[float(params[name]) for name in names], float(auc), *([rung] if halving else [])) for i, (params, auc, rung) in enumerate(done)]
    schema = ", ".join(["trial int", *[f"{name} double" for name in names], "auc double", *(["rung int"] if halving else [])])
    best, auc, _ = leading()
    return Search(train.sparkSession.createDataFrame(rows, schema), dict(best), auc)


def save_model(model: PipelineModel, path: str) -> None:
    """ML9."""
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    """ML9."""
    return PipelineModel.load(path)


def score(model: PipelineModel, df: DataFrame, pred_col: str = "pred") -> DataFrame:
    """ML10: ``df`` plus the probability of class 1; one map-side pass."""
    free_of(df, pred_col)
    return model.transform(df).select(*[named(name) for name in df.columns], probability_of_one(F.col(PROBABILITY)).alias(pred_col))
