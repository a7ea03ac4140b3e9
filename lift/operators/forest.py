"""Feature importance from a random forest (ML1-ML5)."""

from __future__ import annotations

import json
import math
from collections.abc import Callable, Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lift.functions.columns import hash_order, in_training_order, label_of, named, probability_of_one
from lift.operators.evaluate import roc_auc, score_counts, top_importances
from lift.operators.registry import convert_features
from lift.operators.trees import flat_forest, moved_outcomes
from lift.sources.shared import fresh_path, materialise

GROUP_ROWS = 1024
#: Every partition counts every node of a level, so a fit has no more than it takes to give each this many rows, or this few.
PIECE_ROWS, FEW_PIECES = 1 << 16, 8
#: Trees of one fit, which holds two numbers for each of its trees beside every row.
TREES_AT_ONCE = 50
#: Feature ``f`` is taken from this many times ``f`` places on, within the size of the group.
_SHIFT = 7919
# Columns that the models add; no feature has such a name.
VECTOR, LABEL, WEIGHT, KEY = "__lift_vector", "__lift_label", "__lift_weight", "__lift_key"
PREDICTION, PROBABILITY, RAW = "__lift_prediction", "__lift_probability", "__lift_raw"


def vector_stages(features: Sequence[str]) -> list:
    """Features of any name as one vector: they are renamed to their positions first."""
    quoted = ["`" + name.replace("`", "``") + "`" for name in features]
    renamed = ", ".join(f"cast({name} as double) as __lift_x{i}" for i, name in enumerate(quoted))
    return [SQLTransformer(statement=f"select *, {renamed} from __THIS__"),
            VectorAssembler(inputCols=[f"__lift_x{i}" for i in range(len(quoted))], outputCol=VECTOR)]


def fit_forest(train: DataFrame, features: Sequence[str], target: str, *, trees: int = 500, min_leaf: int = 5,
               max_features: float | str = 0.2, max_depth: int = 12, seed: int = 1, memory_mb: int = 1024,
               id_column: str | None = None) -> PipelineModel:
    """ML1: a random forest on encoded and filled features.

    Depth is bounded because every level is a pass over the data; ``memory_mb``
    sets how many nodes one pass may grow. ``max_features`` is the share of the
    features tried at each split, rounded down, or one of Spark's strategies.
    With ``id_column`` equal rows are dealt out evenly as well. Many trees are
    fitted some at a time, each time with another seed, so that what a fit holds
    beside the rows doesn't grow with them.
    """
    tried = max_features if isinstance(max_features, str) else max(1, int(max_features * len(features)))
    keys = [] if id_column is None else [F.col(KEY)]
    ids = [] if id_column is None else [named(id_column).alias(KEY)]
    pieces = max(FEW_PIECES, math.ceil(train.count() / PIECE_ROWS))
    rows = in_training_order(train.select(label_of(target).alias(LABEL), *ids, *[named(name) for name in features]), *keys, most=pieces)

    def fitted(trees: int, seed: int) -> PipelineModel:
        forest = RandomForestClassifier(
            featuresCol=VECTOR, labelCol=LABEL, predictionCol=PREDICTION, probabilityCol=PROBABILITY, rawPredictionCol=RAW, numTrees=trees, minInstancesPerNode=min_leaf, maxDepth=max_depth,
            featureSubsetStrategy=str(tried), seed=seed, maxMemoryInMB=memory_mb, cacheNodeIds=True,
        )
        return Pipeline(stages=[*vector_stages(features), forest]).fit(rows)

    sizes = [min(TREES_AT_ONCE, trees - a) for a in range(0, trees, TREES_AT_ONCE)] or [trees]
    models = [fitted(size, seed + i) for i, size in enumerate(sizes)]
    model = models[0] if len(models) == 1 else PipelineModel([*models[0].stages[:-1], _one_forest(train.sparkSession, [m.stages[-1] for m in models])])
    return model.copy()  # a copy has no training summary, which would travel to every task that scores


def _one_forest(spark: SparkSession, forests: Sequence[RandomForestClassificationModel]) -> RandomForestClassificationModel:
    """The trees of all ``forests`` as one forest, joined as saved models."""
    whole, trees = fresh_path(spark, "forest"), 0
    for forest in forests:
        path = fresh_path(spark, "forest-part")
        forest.write().save(path)
        for part in ("data", "treesMetadata"):
            rows = spark.read.parquet(f"{path}/{part}")
            tree = rows.schema[0]
            rows.withColumn(tree.name, (F.col(tree.name) + F.lit(trees)).cast(tree.dataType)).write.mode("append").parquet(f"{whole}/{part}")
        trees += forest.getNumTrees
    about = json.loads(spark.read.text(f"{path}/metadata").first()[0])
    about["numTrees"] = about["paramMap"]["numTrees"] = trees
    spark.createDataFrame([(json.dumps(about),)], "value string").coalesce(1).write.text(f"{whole}/metadata")
    return RandomForestClassificationModel.load(whole)


def impurity_importance(model: PipelineModel, features: Sequence[str], df: DataFrame) -> DataFrame:
    """ML2: ``(feature, importance)`` from the forest itself; the importances sum to 1."""
    values = model.stages[-1].featureImportances.toArray()
    return df.sparkSession.createDataFrame([(name, float(v)) for name, v in zip(features, values)], "feature string, importance double")


def permutation_importance(df: DataFrame, features: Sequence[str], target: str, id_column: str,
                           predict: Callable[[DataFrame], DataFrame], *, seed: int = 1,
                           only: Sequence[str] | None = None, group_rows: int = GROUP_ROWS) -> DataFrame:
    """ML3: ``(feature, importance)``, the loss of accuracy when one feature is shuffled among the rows.

    ``predict`` adds ``prediction`` to rows that hold their features as the array
    ``x``. Features not in ``only`` are known to be without effect and get 0.

    The rows are shuffled once, into groups of about ``group_rows`` by a hash of
    the id. Inside a group they stand in hash order, and feature ``f`` of a row
    comes from the row a fixed number of places on, wrapping around, a different
    number for each feature: a permutation of the whole column. All features are
    scored in one job, and no row is joined with another.
    """
    features = list(features)
    places = [i for i, name in enumerate(features) if only is None or name in set(only)]
    dealt = _in_groups(df, features, target, id_column, seed, group_rows)
    grouped = dealt.groupBy("g").agg(F.sort_array(F.collect_list(F.struct("h", "y", "x"))).alias("rows"))

    size = F.size("rows")

    def shift(f):
        return F.when(size > 1, F.lit(1) + F.pmod(f * F.lit(_SHIFT), F.greatest(size - 1, F.lit(1)))).otherwise(F.lit(0))

    def with_shuffled(r, i):
        moved = F.transform(F.sequence(F.lit(0), F.lit(len(features) - 1)), lambda f: F.get(F.get(F.col("rows"), F.pmod(i + shift(f), size))["x"], f))
        return F.struct(r["y"].alias("y"), r["x"].alias("x"), moved.alias("z"))

    rows = grouped.select(F.inline(F.transform("rows", with_shuffled)))
    variants = rows.select("*", F.explode(F.array(*[F.lit(i) for i in [-1, *places]])).alias("f"))
    changed = F.transform("x", lambda v, k: F.when(k == F.col("f"), F.get(F.col("z"), k)).otherwise(v))
    scored = predict(variants.select("y", "f", F.when(F.col("f") >= 0, changed).otherwise(F.col("x")).alias("x")))
    return _losses(scored.groupBy("f").agg(F.count("*").alias("n"), F.count_if(F.col("prediction") == F.col("y")).alias("hits")), features)


def _in_groups(df: DataFrame, features: Sequence[str], target: str, id_column: str, seed: int, group_rows: int) -> DataFrame:
    """``(g, h, y, x)``: rows dealt into groups of about ``group_rows`` by a hash of the id, with the label and the features as an array."""
    hashed = hash_order(seed, named(id_column))
    groups = max(1, math.ceil(df.count() / group_rows))
    group = F.pmod(F.conv(F.substring(hashed, 1, 8), 16, 10).cast("bigint"), F.lit(groups))
    return df.select(group.alias("g"), hashed.alias("h"), label_of(target).alias("y"), F.array(*[named(name).cast("double") for name in features]).alias("x"))


def _losses(hits: DataFrame, features: Sequence[str]) -> DataFrame:
    """``(feature, importance)`` from ``(f, n, hits)``, one row per feature and one, with ``f`` -1, for the rows as they are."""
    base = F.max(F.when(F.col("f") < 0, F.col("hits"))).over(Window.partitionBy(F.lit(0)))
    loss = hits.select("f", ((base - F.col("hits")).cast("double") / F.col("n").cast("double")).alias("importance"))
    names = hits.sparkSession.createDataFrame(list(enumerate(features)), "f int, feature string")
    return names.join(loss, "f", "left").select("feature", F.coalesce("importance", F.lit(0.0)).alias("importance"))


def forest_permutation(df: DataFrame, features: Sequence[str], target: str, id_column: str, model: PipelineModel, *, seed: int = 1,
                       only: Sequence[str] | None = None, group_rows: int = GROUP_ROWS) -> tuple[DataFrame, DataFrame]:
    """ML3 and ML4 of a forest in one pass: ``permutation_importance`` with the forest's predictions, and its ``score_counts``.

    Rows are moved as there, and the results are equal. But no row is multiplied:
    a group is scored where it lies, from the forest's nodes as arrays, and only the ways through
    its trees that a moved feature can change are walked again. What is shuffled beside the rows
    is a count per group and feature, and the counts of the unmoved scores.
    """
    features = list(features)
    places = [i for i, name in enumerate(features) if only is None or name in set(only)]
    dealt = _in_groups(df, features, target, id_column, seed, group_rows)
    forest = flat_forest(df.sparkSession, model.stages[-1])
    outcomes = materialise(moved_outcomes(dealt, forest, places, [f * _SHIFT for f in range(len(features))]), "outcomes")
    importances = _losses(outcomes.groupBy("f").agg(F.sum("n").alias("n"), F.sum("hits").alias("hits")), features)
    unmoved = outcomes.where("f = -1").groupBy("score").agg(
        F.sum(F.when(F.col("y") == 1, F.col("n")).otherwise(0)).alias("pos"), F.sum(F.when(F.col("y") == 0, F.col("n")).otherwise(0)).alias("neg"))
    return importances, unmoved.select(F.lit("all").alias("set"), "score", "pos", "neg")


def forest_predictor(model: PipelineModel) -> Callable[[DataFrame], DataFrame]:
    forest = model.stages[-1]
    return lambda rows: forest.transform(rows.withColumn(VECTOR, array_to_vector("x"))).withColumn("prediction", F.col(PREDICTION))


def feature_importances(train: DataFrame, test: DataFrame, features: Sequence[str], target: str, id_column: str, *,
                        permutation: bool = True, seed: int = 1, **forest) -> tuple[DataFrame, DataFrame]:
    """ML1-ML4: the importance table, and the forest's AUC on the test rows.

    A feature that no tree splits on cannot change a prediction, so only the
    others are shuffled.
    """
    model = fit_forest(train, features, target, seed=seed, id_column=id_column, **forest)
    importances = impurity_importance(model, features, train)
    if permutation:
        used = [row["feature"] for row in importances.where("importance > 0").collect()]
        importances, counts = forest_permutation(test, features, target, id_column, model, seed=seed, only=used)
        return importances, roc_auc(counts)
    scored = model.transform(test).select(named(target).alias("y"), probability_of_one(F.col(PROBABILITY)).alias("pred"))
    return importances, roc_auc(score_counts(scored, "y", "pred"))


def export_top(registry: DataFrame, importances: DataFrame, *, permutation: bool = True, threshold: float = 0.0005, top: int = 30) -> DataFrame:
    """ML5: the best features in registry form and order.

    Permutation importances must be strictly above ``threshold``, and ``top``
    does not apply; of impurity importances the first ``top`` are taken.
    """
    best = importances.where(F.col("importance") > F.lit(float(threshold))) if permutation else top_importances(importances, top)
    return convert_features(registry, best)
