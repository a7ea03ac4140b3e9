"""PL3: model building."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lift.functions.columns import named
from lift.operators.assemble import Tables, load_features, narrow
from lift.operators.boosting import DEFAULT_RANGES, Halving, Search, fit_boosted, save_model, score, search
from lift.operators.encode import encode_categories, fill_constant
from lift.operators.evaluate import METRICS, metric_set, score_counts, score_histogram
from lift.operators.profile import observed
from lift.operators.split import HOLDOUT, TRAIN, folds, holdout
from lift.sources.shared import lasting, materialise, scratch


SCORED = "__lift_pred"


@dataclass(frozen=True)
class BuildSettings:
    target: str
    id_column: str = "client_id"
    ranges: Mapping[str, Sequence[float]] = field(default_factory=lambda: dict(DEFAULT_RANGES))
    na_value: float = -1
    holdout_size: float = 0.2
    cv_splits: int = 4
    init_points: int = 5
    n_iter: int = 100
    seed: int = 1
    parallelism: int = 4
    halving: Halving | None = None
    metrics: Sequence[str] = METRICS
    prob_kde: bool = True
    cm_threshold: float = 0.5
    histogram: bool = True
    check_ids: bool = True
    narrow: bool = False


@dataclass(frozen=True)
class Built:
    """The fitted model, its search, the scored rows ``(id, target, split, pred)`` and the metric tables.

    ``sizes`` has the rows and columns after loading and of the parts of the split.
    """

    model: PipelineModel
    search: Search
    scored: DataFrame
    metrics: dict[str, DataFrame]
    sizes: dict[str, tuple[int, int]]


def build_model(population: DataFrame | str, registry: DataFrame, tables: Tables, settings: BuildSettings, *,
                model_path: str | None = None, dictionary_path: str | None = None) -> Built:
    """Assemble, encode, fill, split, search, fit, save and evaluate."""
    target, id_column = settings.target, settings.id_column
    with scratch(registry.sparkSession, "build"):
        wide, features = load_features(population, registry, tables, id_column, target, check_ids=settings.check_ids)
        counted, loaded = observed(wide, "load")
        wide = materialise(counted, "wide")
        sizes = {"load": (loaded.get["rows"], len(wide.columns))}
        parted = holdout(narrow(wide, features) if settings.narrow else wide, id_column, target, settings.holdout_size, settings.seed)
        encoded, _ = encode_categories(parted, features, dictionary_path)
        ready = materialise(fill_constant(encoded, features, settings.na_value), "ready")
        train = ready.where(F.col("split") == TRAIN)
        found = search(folds(train, id_column, target, settings.cv_splits, settings.seed), features, target, settings.ranges, init_points=settings.init_points,
                       n_iter=settings.n_iter, seed=settings.seed, parallelism=settings.parallelism, id_column=id_column, halving=settings.halving)
        model = fit_boosted(train, features, target, found.best, seed=settings.seed, id_column=id_column)
        if model_path is not None:
            save_model(model, model_path)
        scored = lasting(score(model, ready, SCORED).select(named(id_column), named(target), "split", F.col(SCORED).alias("pred")), "scored")
        counts = score_counts(scored, target, "pred", "split")
        sizes |= {row["set"]: (row["rows"], len(wide.columns)) for row in counts.groupBy("set").agg(F.sum(F.col("pos") + F.col("neg")).alias("rows")).collect()}
        tables_out = metric_set(counts, settings.metrics, train=TRAIN, holdout=HOLDOUT, threshold=settings.cm_threshold, kde=settings.prob_kde)
        if settings.histogram:
            tables_out["histogram"] = score_histogram(counts.where(F.col("set") == HOLDOUT))
        tables_out = {name: lasting(table, f"metric-{name}") for name, table in tables_out.items()}
    return Built(model, found, scored, tables_out, sizes)
