"""PL2: feature selection."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lift.operators.assemble import Tables, load_features, narrow
from lift.operators.encode import encode_categories, fill_constant
from lift.operators.evaluate import top_importances
from lift.operators.forest import export_top, feature_importances
from lift.operators.profile import drop_useless, elimination_record, observed
from lift.operators.registry import save_registry
from lift.operators.split import HOLDOUT, TRAIN, holdout
from lift.sources.shared import lasting, materialise, scratch


@dataclass(frozen=True)
class SelectSettings:
    target: str
    id_column: str = "client_id"
    feature_sets: str | Sequence[str] = "all"
    except_sets: str | Sequence[str] | None = None
    except_features: str | Sequence[str] | None = None
    missing_threshold: float = 0.7
    disbalance_threshold: float = 0.7
    collinear_threshold: float = 0.9
    na_value: float = -1
    top: int = 30
    permutation: bool = True
    permutation_threshold: float = 0.0005
    test_size: float = 0.2
    seed: int = 1
    forest: Mapping[str, object] = field(default_factory=dict)
    check_ids: bool = True
    narrow: bool = False


@dataclass(frozen=True)
class Selection:
    """What was dropped and why, how the rest ranks, and the registry that is left.

    ``sizes`` has the rows and columns after each step: ``load``, ``drop``, and
    the parts of the split. The tables are written ones; nothing else of the run is left.
    """

    record: DataFrame
    importances: DataFrame
    auc: DataFrame
    registry: DataFrame
    top: DataFrame
    sizes: dict[str, tuple[int, int]]


def select_features(population: DataFrame | str, registry: DataFrame, tables: Tables, settings: SelectSettings, path: str | None = None) -> Selection:
    """Assemble, prune, rank and export; the chosen registry is saved at ``path``."""
    spark = registry.sparkSession
    with scratch(spark, "select"):
        wide, features = load_features(
            population, registry, tables, settings.id_column, settings.target, feature_sets=settings.feature_sets,
            except_sets=settings.except_sets, except_features=settings.except_features, check_ids=settings.check_ids,
        )
        counted, loaded = observed(wide, "load")
        wide = materialise(counted, "wide")
        sizes = {"load": (loaded.get["rows"], len(wide.columns))}
        if settings.narrow:
            wide = narrow(wide, features)
        record = elimination_record(wide, features, missing=settings.missing_threshold, dominant=settings.disbalance_threshold,
                                    collinear_above=settings.collinear_threshold)
        pruned = drop_useless(wide, record)
        sizes["drop"] = (sizes["load"][0], len(pruned.columns))
        features = [name for name in features if name in pruned.columns]
        parted = holdout(pruned, settings.id_column, settings.target, settings.test_size, settings.seed)
        encoded, _ = encode_categories(parted, features)
        ready = materialise(fill_constant(encoded, features, settings.na_value), "ready")
        sizes |= {row["split"]: (row["count"], len(pruned.columns)) for row in ready.groupBy("split").count().collect()}
        importances, auc = feature_importances(
            ready.where(F.col("split") == TRAIN), ready.where(F.col("split") == HOLDOUT), features, settings.target, settings.id_column,
            permutation=settings.permutation, seed=settings.seed, **settings.forest,
        )
        importances, auc = lasting(importances, "importances"), lasting(auc, "auc")
        best = export_top(registry, importances, permutation=settings.permutation, threshold=settings.permutation_threshold, top=settings.top)
        if path is not None:
            save_registry(best, path)
    return Selection(record, importances, auc, best, top_importances(importances, settings.top), sizes)
