"""The feature registry (RG1-RG7): which features exist, in which set and table.

A registry is a DataFrame with one row per feature::

    set_pos  name  class  type  source  feat_pos  feature

It is metadata: its size is the number of columns a plan may use. The choosing
operators are joins and filters on it; ``chosen_sets`` hands the result to the
assembly, which turns it into column names of one plan.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lift.functions.columns import as_list

REGISTRY = "set_pos int, name string, class string, type string, source string, feat_pos int, feature string"
SET = "struct<name:string,class:string,type:string,source:string,features:array<string>>"

# Class, type and number of features of the five default sets.
DEFAULT_SETS = (
    ("main", "numerical", 5),
    ("extra", "binary", 5),
    ("extra", "numerical", 9),
    ("main", "numerical", 10),
    ("main", "numerical", 10),
)


@dataclass(frozen=True)
class FeatureSet:
    name: str
    source: str
    features: tuple[str, ...]


def registry_from(spark: SparkSession, sets: Iterable[Mapping]) -> DataFrame:
    """A registry from set descriptions with name, class, type, source and features."""
    rows = [
        (i, one["name"], one["class"], one["type"], one["source"], j, feature)
        for i, one in enumerate(sets)
        for j, feature in enumerate(one["features"])
    ]
    return spark.createDataFrame(rows, REGISTRY)


def default_registry(spark: SparkSession) -> DataFrame:
    """RG1: five sets ``set1`` to ``set5`` read from ``features_set1`` to ``features_set5``."""
    return registry_from(spark, [
        {"name": f"set{i}", "class": kind, "type": type_, "source": f"features_set{i}",
         "features": [f"set{i}_feature_{j}" for j in range(count)]}
        for i, (kind, type_, count) in enumerate(DEFAULT_SETS, start=1)
    ])


def _sets(registry: DataFrame) -> DataFrame:
    """One row per set, sets and features numbered anew in their order."""
    ordered = F.sort_array(F.collect_list(F.struct("feat_pos", "feature")))
    return registry.groupBy("set_pos", "name", "class", "type", "source").agg(ordered.getField("feature").alias("features"))


def save_registry(registry: DataFrame, path: str) -> None:
    """RG2: write the registry as one JSON array of sets, in registry order."""
    one = F.struct("set_pos", F.struct("name", "class", "type", "source", "features").alias("set"))
    array = F.sort_array(F.collect_list(one)).getField("set")
    _sets(registry).agg(F.to_json(array).alias("value")).coalesce(1).write.mode("overwrite").text(path)


def load_registry(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """RG3: read a registry from a file, or a folder with one file, holding a JSON array of sets."""
    text = spark.read.text(path, wholetext=True).where(F.trim("value") != "")
    sets = text.select(F.posexplode(F.from_json("value", f"array<{SET}>")).alias("set_pos", "set"))
    return sets.select(
        "set_pos", "set.name", "set.class", "set.type", "set.source",
        F.posexplode("set.features").alias("feat_pos", "feature"),
    )


def keep_features(registry: DataFrame, features: DataFrame) -> DataFrame:
    """The registry's rows whose feature occurs in ``features``, in registry order.

    Sets without a kept feature vanish, as do features the registry lacks.
    """
    return registry.join(features.select("feature").distinct(), "feature", "left_semi").select(*registry.columns)


def merge_selections(registry: DataFrame, *selections: DataFrame) -> DataFrame:
    """RG4: the union of several selections, filtered and ordered by the registry."""
    if not selections:
        return registry.limit(0)
    union = selections[0].select("feature")
    for selection in selections[1:]:
        union = union.unionByName(selection.select("feature"))
    return keep_features(registry, union)


def convert_features(registry: DataFrame, features: DataFrame | str | Sequence[str]) -> DataFrame:
    """RG5: a flat list of features in registry form."""
    if not isinstance(features, DataFrame):
        features = registry.sparkSession.createDataFrame([(name,) for name in as_list(features)], "feature string")
    return keep_features(registry, features)


def choose_sets(registry: DataFrame, feature_sets: str | Sequence[str] = "all") -> DataFrame:
    """RG6: every set, the sets of class ``main``, or the named ones."""
    if feature_sets == "all":
        return registry
    if feature_sets == "main":
        return registry.where(F.col("class") == "main")
    return registry.where(F.col("name").isin(as_list(feature_sets)))


def leave_out(registry: DataFrame, except_sets: str | Sequence[str] | None = None,
              except_features: str | Sequence[str] | None = None) -> DataFrame:
    """RG7: the registry without some sets and some features."""
    if sets := as_list(except_sets):
        registry = registry.where(~F.col("name").isin(sets))
    if features := as_list(except_features):
        registry = registry.where(~F.col("feature").isin(features))
    return registry


def chosen_sets(registry: DataFrame) -> list[FeatureSet]:
    """The registry as plan input: its sets in order, each with its features in order."""
    rows = sorted(registry.select("set_pos", "name", "source", "feat_pos", "feature").collect())
    sets: dict[tuple, list[str]] = {}
    for row in rows:
        sets.setdefault((row["set_pos"], row["name"], row["source"]), []).append(row["feature"])
    return [FeatureSet(name, source, tuple(features)) for (_, name, source), features in sets.items()]
