"""Evaluation tables (EV1-EV12, PF4, PF5).

Every table derives from ``score_counts``: the numbers of rows with label 1 and
label 0 per distinct score. One pre-aggregated shuffle builds it; ties and hot
scores are gone by then, and whatever follows runs on the compressed table.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lift.functions.columns import above, checked_label, checked_score, named
from lift.operators.order import running_sums
from lift.sources.shared import materialise

METRICS = ("roc_curve", "pr_curve", "prob_hist", "conf_matrix")


def score_counts(df: DataFrame, label: str, score: str, set_column: str | None = None, *, keep: bool = True) -> DataFrame:
    """PF5: ``(set, score, pos, neg)``, one row per set and distinct score.

    ``keep`` writes the table to the shared folder, as most users read it more
    than once and the scores behind it may come from a model. Sets are named by
    a column and may be any number.
    """
    y = checked_label(named(label))
    counts = df.select(
        (F.lit("all") if set_column is None else F.coalesce(named(set_column).cast("string"), F.lit("NULL"))).alias("set"),
        checked_score(named(score)).alias("score"), y.alias("y"),
    ).groupBy("set", "score").agg(F.sum("y").alias("pos"), F.sum(F.lit(1) - F.col("y")).alias("neg"))
    if not keep:
        return counts
    return materialise(counts, "scores")


def _ratio(top: Column, bottom: Column) -> Column:
    return F.try_divide(top.cast("double"), bottom.cast("double"))


def cumulative(counts: DataFrame) -> DataFrame:
    """``counts`` plus the labels at or above each score: ``upto_pos``, ``upto_neg`` and their totals."""
    return running_sums(counts, "set", "score", ["pos", "neg"], descending=True)


def roc_points(counts: DataFrame, run: DataFrame | None = None) -> DataFrame:
    """EV1: ``(set, threshold, fpr, tpr)`` per distinct score, and the origin with a NULL threshold."""
    points = (cumulative(counts) if run is None else run).select(
        "set", F.col("score").alias("threshold"),
        _ratio(F.col("upto_neg"), F.col("total_neg")).alias("fpr"), _ratio(F.col("upto_pos"), F.col("total_pos")).alias("tpr"),
    )
    origin = counts.select("set").distinct().select(
        "set", F.lit(None).cast("double").alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"))
    return points.unionByName(origin)


def pr_points(counts: DataFrame, run: DataFrame | None = None) -> DataFrame:
    """EV3: ``(set, threshold, recall, precision)``, closed by recall 0 at precision 1."""
    points = (cumulative(counts) if run is None else run).select(
        "set", F.col("score").alias("threshold"),
        _ratio(F.col("upto_pos"), F.col("total_pos")).alias("recall"),
        _ratio(F.col("upto_pos"), F.col("upto_pos") + F.col("upto_neg")).alias("precision"),
    )
    last = counts.select("set").distinct().select(
        "set", F.lit(None).cast("double").alias("threshold"), F.lit(0.0).alias("recall"), F.lit(1.0).alias("precision"))
    return points.unionByName(last)


def roc_auc(counts: DataFrame, run: DataFrame | None = None) -> DataFrame:
    """EV2: ``(set, auc)``, ties counted half.

    Twice the number of correctly ordered pairs is summed as a whole number, so
    the result is the same whatever the partitions.
    """
    exact = "decimal(19,0)"
    twice = F.col("neg").cast(exact) * (F.lit(2) * F.col("upto_pos") - F.col("pos")).cast(exact)
    return (cumulative(counts) if run is None else run).groupBy("set").agg(
        F.sum(twice).cast("double").alias("pairs"), F.first("total_pos").alias("p"), F.first("total_neg").alias("n"),
    ).select("set", _ratio(F.col("pairs") / F.lit(2.0), F.col("p").cast("double") * F.col("n").cast("double")).alias("auc"))


def average_precision(counts: DataFrame, run: DataFrame | None = None) -> DataFrame:
    """EV4: ``(set, average_precision)``, the sum of recall steps times precision."""
    step = _ratio(F.col("pos"), F.col("total_pos")) * _ratio(F.col("upto_pos"), F.col("upto_pos") + F.col("upto_neg"))
    return (cumulative(counts) if run is None else run).groupBy("set").agg(F.sum(step).alias("average_precision"))


def _cells(counts: DataFrame, threshold: float | None) -> DataFrame:
    """One row per set with tp, fp, fn, tn; without a threshold the score is the label itself."""
    one = F.col("score") == F.lit(1.0) if threshold is None else above(F.col("score"), threshold) == 1
    return counts.groupBy("set").agg(
        F.sum(F.when(one, F.col("pos")).otherwise(0)).alias("tp"), F.sum(F.when(one, F.col("neg")).otherwise(0)).alias("fp"),
        F.sum(F.when(one, 0).otherwise(F.col("pos"))).alias("fn"), F.sum(F.when(one, 0).otherwise(F.col("neg"))).alias("tn"),
    )


def confusion(counts: DataFrame, threshold: float | None = 0.5) -> DataFrame:
    """EV5: ``(set, actual, predicted, n)``, all four cells, zeros included."""
    cell = [F.struct(F.lit(a).alias("actual"), F.lit(p).alias("predicted"), F.col(name).alias("n"))
            for a, p, name in ((0, 0, "tn"), (0, 1, "fp"), (1, 0, "fn"), (1, 1, "tp"))]
    return _cells(counts, threshold).select("set", F.inline(F.array(*cell)))


def threshold_metrics(counts: DataFrame, threshold: float | None = 0.5) -> DataFrame:
    """EV6, EV7: ``(set, precision, recall, auc_at_threshold)`` in percent with one decimal.

    The last is the area under the curve of the 0/1 predictions, the mean of
    the two classes' hit rates, and not that of the scores. A precision or
    recall without rows to count is 0.
    """
    tp, fp, fn, tn = (F.col(name) for name in ("tp", "fp", "fn", "tn"))
    recall, specificity = _ratio(tp, tp + fn), _ratio(tn, tn + fp)

    def percent(share: Column) -> Column:
        return F.bround(share * F.lit(100.0), 1)

    return _cells(counts, threshold).select(
        "set", percent(F.coalesce(_ratio(tp, tp + fp), F.lit(0.0))).alias("precision"),
        percent(F.coalesce(recall, F.lit(0.0))).alias("recall"),
        percent((recall + specificity) / F.lit(2.0)).alias("auc_at_threshold"),
    )


def _by_label(counts: DataFrame) -> DataFrame:
    """``(set, label, score, n)`` with n above 0."""
    pairs = F.array(F.struct(F.lit(0).alias("label"), F.col("neg").alias("n")), F.struct(F.lit(1).alias("label"), F.col("pos").alias("n")))
    return counts.select("set", "score", F.inline(pairs)).where("n > 0")


def _binned(rows: DataFrame, keys: Sequence[str], bins: int | Column, low: Column, step: Column) -> DataFrame:
    """``rows`` with the bin (from 1) of each score in [low, low + bins * step], the last bin closed.

    The floor of a quotient can be off by one at an edge; comparing with the
    edges themselves settles it. Scores outside the range belong to no bin.
    """
    last = (F.lit(bins) if isinstance(bins, int) else bins) - 1
    guess = F.floor((F.col("score") - low) / step).cast("int")
    guess = F.when(F.col("score") < guess * step + low, guess - 1).when(F.col("score") >= (guess + 1) * step + low, guess + 1).otherwise(guess)
    return rows.select(*keys, "n", "score", F.least(last, F.greatest(F.lit(0), guess)).alias("__bin")).select(
        *keys, "n", (F.col("__bin") + 1).alias("bin"))


def probability_histogram(counts: DataFrame, bins: int = 50) -> DataFrame:
    """EV8: ``(set, label, bin, lower, upper, n, density)``, equal bins on [0, 1], empty ones included."""
    step = F.lit(1.0 / bins)
    rows = _by_label(counts).where(F.col("score").between(0.0, 1.0))
    filled = _binned(rows, ["set", "label"], bins, F.lit(0.0), step).groupBy("set", "label", "bin").agg(F.sum("n").alias("n"))
    totals = rows.groupBy("set", "label").agg(F.sum("n").alias("rows"))
    grid = totals.select("*", F.explode(F.sequence(F.lit(1), F.lit(bins))).alias("bin"))
    return grid.join(filled, ["set", "label", "bin"], "left").select(
        "set", "label", "bin", ((F.col("bin") - 1) * step).alias("lower"),
        F.when(F.col("bin") == bins, F.lit(1.0)).otherwise(F.col("bin") * step).alias("upper"),
        F.coalesce("n", F.lit(0)).alias("n"),
        (F.coalesce("n", F.lit(0)).cast("double") / (F.col("rows").cast("double") * step)).alias("density"),
    )


def _quantiles(rows: DataFrame, shares: Sequence[float]) -> DataFrame:
    """``(set, q0, q1, ...)``: exact quantiles of ``(set, score, n)``, linear between neighbours."""
    run = running_sums(rows.select("set", "score", "n"), "set", "score", ["n"])
    out = []
    for i, share in enumerate(shares):
        place = F.lit(float(share)) * (F.col("total_n") - 1).cast("double")
        for at, rank in (("lo", F.floor(place) + 1), ("hi", F.ceil(place) + 1)):
            inside = (rank > F.col("upto_n") - F.col("n")) & (rank <= F.col("upto_n"))
            out.append(F.max(F.when(inside, F.col("score"))).alias(f"{at}{i}"))
    found = run.groupBy("set").agg(F.first("total_n").alias("rows"), *out)
    value = [
        (F.col(f"lo{i}") + (F.col(f"hi{i}") - F.col(f"lo{i}")) * (F.lit(float(s)) * (F.col("rows") - 1) - F.floor(F.lit(float(s)) * (F.col("rows") - 1)))).alias(f"q{i}")
        for i, s in enumerate(shares)
    ]
    return found.select("set", "rows", *value)


def score_histogram(counts: DataFrame, bins: int | None = None) -> DataFrame:
    """EV9: ``(set, bin, lower, upper, n, density)`` from the lowest to the highest score, labels ignored.

    Without ``bins`` the data choose: the Freedman-Diaconis width
    ``2 * IQR / rows ** (1/3)``, at most 50 bins; the square root of the number
    of rows when the quartiles coincide.
    """
    rows = counts.select("set", "score", (F.col("pos") + F.col("neg")).alias("n"))
    ends = rows.groupBy("set").agg(F.min("score").alias("low"), F.max("score").alias("high"), F.sum("n").alias("rows"))
    if bins is None:
        spread = _quantiles(rows, [0.25, 0.75]).select("set", (F.col("q1") - F.col("q0")).alias("iqr"))
        width = F.lit(2.0) * F.col("iqr") / F.pow(F.col("rows").cast("double"), F.lit(1.0 / 3.0))
        chosen = F.when(width > 0, F.ceil((F.col("high") - F.col("low")) / width)).otherwise(F.floor(F.sqrt(F.col("rows").cast("double"))))
        ends = ends.join(spread, "set").withColumn("bins", F.greatest(F.lit(1), F.least(F.lit(50), chosen)).cast("int")).drop("iqr")
    else:
        ends = ends.withColumn("bins", F.lit(bins))
    # scores that are all equal get a range of width one around them
    flat = F.col("low") == F.col("high")
    ends = ends.withColumns({"low": F.when(flat, F.col("low") - 0.5).otherwise(F.col("low")),
                             "high": F.when(flat, F.col("high") + 0.5).otherwise(F.col("high"))})
    ends = ends.withColumn("step", (F.col("high") - F.col("low")) / F.col("bins").cast("double"))
    placed = rows.join(ends.drop("rows", "high"), "set")
    filled = _binned(placed, ["set"], F.col("bins"), F.col("low"), F.col("step")).groupBy("set", "bin").agg(F.sum("n").alias("n"))
    grid = ends.select("*", F.explode(F.sequence(F.lit(1), F.col("bins"))).alias("bin"))
    return grid.join(filled, ["set", "bin"], "left").select(
        "set", "bin", ((F.col("bin") - 1) * F.col("step") + F.col("low")).alias("lower"),
        F.when(F.col("bin") == F.col("bins"), F.col("high")).otherwise(F.col("bin") * F.col("step") + F.col("low")).alias("upper"),
        F.coalesce("n", F.lit(0)).alias("n"),
        (F.coalesce("n", F.lit(0)).cast("double") / (F.col("rows").cast("double") * F.col("step"))).alias("density"),
    )


def density_curve(counts: DataFrame, points: int = 100, reach: float = 3.0, *, exact: int = 1 << 14, fineness: int = 256) -> DataFrame:
    """EV10: ``(set, label, point, x, density)``, the Gaussian kernel estimate per label.

    The bandwidth ``h`` follows Scott's rule; the grid spans the scores and ``reach``
    bandwidths on both sides. NULL where a label's scores have no spread.

    A label with at most ``exact`` distinct scores has each of them summed. With more, every score is first
    divided between the two nearest of a row of nodes ``h / fineness`` apart, in proportion to its nearness, and the
    kernel runs over the nodes. That is off by at most ``0.05 / (h * fineness ** 2)``, a millionth of the kernel's
    height, as the kernel's second derivative is at most 0.4 over ``h`` cubed. A score or
    node counts at the points within 39 bandwidths; beyond, the kernel is 0 as a double.
    """
    rows, key = _by_label(counts), ["set", "label"]
    n = F.col("n").cast("double")
    means = rows.groupBy(*key).agg(
        F.sum("n").cast("double").alias("rows"), F.count(F.lit(1)).alias("scores"), (F.sum(n * F.col("score")) / F.sum(n)).alias("mean"),
        F.min("score").alias("low"), F.max("score").alias("high"))
    off = F.col("score") - F.col("mean")
    spread = rows.join(means, key).groupBy(*key, "rows", "scores", "low", "high").agg(F.sum(n * off * off).alias("squares"))
    width = F.sqrt(F.try_divide(F.col("squares"), F.col("rows") - 1)) * F.pow(F.col("rows"), F.lit(-0.2))
    bands = spread.select(*key, "rows", "scores", "low", "high", F.when(F.col("low") < F.col("high"), width).alias("h"))
    start, stop = F.col("low") - F.lit(reach) * F.col("h"), F.col("high") + F.lit(reach) * F.col("h")
    # a row per set and label, read three times
    bands = materialise(bands.select(*key, "rows", "scores", "low", "h", start.alias("start"), ((stop - start) / F.lit(float(points - 1))).alias("step")), "bands")

    cell = F.col("h") / F.lit(float(fineness))
    place = (F.col("score") - F.col("low")) / cell
    before, share = F.floor(place), place - F.floor(place)
    whole = F.array(F.struct(F.col("score").alias("at"), n.alias("weight")))
    divided = F.array(F.struct((F.col("low") + before * cell).alias("at"), (n * (F.lit(1.0) - share)).alias("weight")),
                      F.struct((F.col("low") + (before + 1) * cell).alias("at"), (n * share).alias("weight")))
    nodes = rows.join(bands.where("h is not null"), key).select(*key, F.inline(F.when(F.col("scores") <= exact, whole).otherwise(divided)))
    nodes = nodes.groupBy(*key, "at").agg(F.sum("weight").alias("weight")).join(bands, key)

    far = F.lit(39.0) * F.col("h")
    first = F.greatest(F.ceil((F.col("at") - far - F.col("start")) / F.col("step")), F.lit(0))
    last = F.least(F.floor((F.col("at") + far - F.col("start")) / F.col("step")), F.lit(points - 1))
    near = nodes.withColumns({"first": first, "last": last}).where("first <= last").withColumn("point", F.explode(F.sequence("first", "last")))
    x = F.col("start") + F.col("point").cast("double") * F.col("step")
    distance = (x - F.col("at")) / F.col("h")
    height = F.col("weight") * F.exp(F.lit(-0.5) * distance * distance) / (F.col("rows") * F.col("h") * F.lit(math.sqrt(2 * math.pi)))
    summed = near.groupBy(*key, "point").agg(F.sum(height).alias("density"))
    grid = bands.withColumn("point", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(points - 1).cast("long"))))
    known = F.when(F.col("h").isNotNull(), F.coalesce("density", F.lit(0.0)))
    return grid.join(summed, [*key, "point"], "left").select(*key, F.col("point").cast("int").alias("point"), x.alias("x"), known.alias("density"))


def metric_set(counts: DataFrame, metrics: Sequence[str] = METRICS, *, train: str = "train", holdout: str = "holdout",
               threshold: float = 0.5, kde: bool = True) -> dict[str, DataFrame]:
    """EV11: the tables of the chosen metrics from counts whose sets are the train and the holdout part.

    ROC for both parts, the rest for the holdout.
    """
    unknown = set(metrics) - set(METRICS)
    if unknown:
        raise ValueError(f"unknown metrics: {sorted(unknown)}")
    both = counts.where(F.col("set").isin(train, holdout))
    held = counts.where(F.col("set") == holdout)
    tables: dict[str, DataFrame] = {}
    if {"roc_curve", "pr_curve"} & set(metrics):
        run = materialise(cumulative(both), "curves")
        held_run = run.where(F.col("set") == holdout)
    if "roc_curve" in metrics:
        tables |= {"roc_curve": roc_points(both, run), "roc_auc": roc_auc(both, run)}
    if "pr_curve" in metrics:
        tables |= {"pr_curve": pr_points(held, held_run), "average_precision": average_precision(held, held_run)}
    if "prob_hist" in metrics:
        tables["prob_hist"] = probability_histogram(held)
        if kde:
            tables["density"] = density_curve(held)
    if "conf_matrix" in metrics:
        tables |= {"conf_matrix": confusion(held, threshold), "threshold_metrics": threshold_metrics(held, threshold)}
    return tables


def top_importances(importances: DataFrame, top: int = 30) -> DataFrame:
    """EV12, SO1, SO2: the ``top`` features by importance, names breaking ties."""
    return importances.orderBy(F.col("importance").desc(), F.col("feature")).limit(top)
