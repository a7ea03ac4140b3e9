"""PL4: batch scoring."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lift.functions.columns import named, text_columns
from lift.operators.assemble import Tables, load_features
from lift.operators.boosting import load_model, score
from lift.operators.encode import apply_categories, fill_constant, load_categories
from lift.operators.evaluate import score_counts, score_histogram
from lift.operators.split import sample_rows
from lift.sources.shared import lasting, scratch
from lift.sources.tables import save_scores


@dataclass(frozen=True)
class ScoreSettings:
    id_column: str = "client_id"
    na_value: float = -1
    pred_col: str = "pred"
    histogram: bool = True
    histogram_share: float = 1.0
    seed: int = 1
    check_ids: bool = True


def histogram_of(scored: DataFrame, id_column: str, pred_col: str, share: float = 1.0, seed: int = 1) -> DataFrame:
    """EV9 with PF6: the histogram of an exact share of the scores."""
    sampled = sample_rows(scored, id_column, share, seed).select(F.lit(0).alias("label"), named(pred_col).alias("pred"))
    return score_histogram(score_counts(sampled, "label", "pred"))


def score_population(population: DataFrame | str, registry: DataFrame, tables: Tables, model: PipelineModel | str, settings: ScoreSettings, *,
                     dictionary: DataFrame | str | None = None, path: str | None = None, table: str | None = None) -> tuple[DataFrame, DataFrame | None]:
    """``(id, pred)`` for every entity, written as CSV and upserted on request, and its histogram.

    One plan from the scans to the scores: joins, dictionary lookups, fill and
    the model. Only ids and probabilities are written to the shared folder, for
    the sinks and the histogram to read.
    """
    wide, features = load_features(population, registry, tables, settings.id_column, check_ids=settings.check_ids)
    if isinstance(dictionary, str):
        dictionary = load_categories(wide, dictionary)
    if dictionary is not None:
        wide = apply_categories(wide, features, dictionary)
    elif texts := text_columns(wide, features):
        raise ValueError(f"text features need the dictionary they were encoded with: {', '.join(texts)}")
    ready = fill_constant(wide, features, settings.na_value)
    fitted = load_model(model) if isinstance(model, str) else model
    scored = score(fitted, ready, settings.pred_col).select(named(settings.id_column), named(settings.pred_col))
    if path is None:
        scored = lasting(scored, "scored")
    else:
        scored = save_scores(scored, path, id_column=settings.id_column, pred_column=settings.pred_col, table=table)
    histogram = None
    if settings.histogram:
        with scratch(registry.sparkSession, "histogram"):
            histogram = lasting(histogram_of(scored, settings.id_column, settings.pred_col, settings.histogram_share, settings.seed), "histogram")
    return scored, histogram
