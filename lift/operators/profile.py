"""Profiles of a wide table and the features they rule out (AG1-AG5, PF3)."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from lift.functions.columns import BINARY_FLOAT, INTEGRAL, columns_of, named, numeric_columns

RECORD = "reason string, feature string, value double"


def _per_feature(row: DataFrame, features: Sequence[str], value: str) -> DataFrame:
    """One aggregate row with columns v0, v1, ... as rows ``(feature, value)``."""
    pairs = [F.struct(F.lit(name).alias("feature"), F.col(f"v{i}").alias(value)) for i, name in enumerate(features)]
    return row.select(F.inline(F.array(*pairs)))


def missing_share(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """AG1: ``(feature, missing_share)``, all features in one pass without a row shuffle."""
    n = F.count(F.lit(1))
    shares = [F.try_divide((n - F.count(named(name))).cast("double"), n.cast("double")) for name in features]
    return _per_feature(df.agg(*[share.alias(f"v{i}") for i, share in enumerate(shares)]), features, "missing_share")


def observed(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """AG8: ``df``, and an observation whose ``rows`` is counted by whatever action reads it next."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def _by_kind(df: DataFrame, features: Sequence[str]) -> list[tuple[str, list[str]]]:
    """Features grouped by a type that keeps their values distinct."""
    whole = columns_of(df, INTEGRAL, features)
    real = columns_of(df, BINARY_FLOAT, features)
    rest = [name for name in features if name not in whole and name not in real]
    return [(kind, names) for kind, names in (("bigint", whole), ("double", real), ("string", rest)) if names]


def _compared(name: str, kind: str) -> Column:
    """A feature as what its values are told apart by: numbers themselves, texts by their digest, whatever their length."""
    value = named(name).cast(kind)
    return F.md5(value) if kind == "string" else value


def dominant_share(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """AG2: ``(feature, dominant_share)``, the most frequent value's share of all rows.

    Every value of every feature is counted. Counts combine before the shuffle,
    so frequent values are cheap and the shuffle holds distinct values, texts as
    digests of one length. A
    feature without values has share 0.
    """
    counts = []
    for kind, names in _by_kind(df, features):
        cells = F.explode(F.array(*[
            F.struct(F.lit(name).alias("feature"), _compared(name, kind).alias("value")) for name in names
        ])).alias("cell")
        counted = df.select(cells).groupBy("cell.feature", "cell.value").agg(F.count("*").alias("n"))
        counts.append(counted.groupBy("feature").agg(
            F.max(F.when(F.col("value").isNotNull(), F.col("n"))).alias("top"), F.sum("n").alias("rows")
        ))
    share = F.coalesce(F.col("top"), F.lit(0)).cast("double") / F.col("rows").cast("double")
    return reduce(DataFrame.unionByName, counts).select("feature", share.alias("dominant_share"))


@dataclass(frozen=True)
class Survey:
    """What one pass over a wide table tells about its features.

    ``frequent`` holds, for each feature, every value whose share may be above
    the threshold asked for; ``means`` the means of the numeric features.
    """

    rows: int
    present: dict[str, int]
    frequent: dict[str, list]
    means: dict[str, float | None]


#: Items that a sketch tracks, and the most passes over the table, each with sketches of a share of the values.
_TRACKED, _MOST_PASSES = 80_000, 128
#: Values of a feature that are counted by an expression each; more are counted as rows of a join.
_FEW = 16


def _passes(threshold: float) -> int:
    """Passes whose sketches, together, tell shares of a tenth of the threshold; 0 if that takes too many."""
    needed = math.ceil(80 / threshold / _TRACKED - 1e-9) if threshold > 80 / _TRACKED / (_MOST_PASSES + 1) else 0
    return needed if needed <= _MOST_PASSES else 0


def _comparable(df: DataFrame, features: Sequence[str]) -> dict[str, Column]:
    """Features cast to the types of ``_by_kind``; adding 0.0 folds the two zeros of a double into one."""
    return {name: _compared(name, kind) + F.lit(0.0) if kind == "double" else _compared(name, kind) for kind, names in _by_kind(df, features) for name in names}


def _sketches(features: Sequence[str], threshold: float, part: int, passes: int) -> list[Column]:
    """The frequent values among those whose hash falls to this pass."""
    slack = threshold / 10
    few = math.ceil(1 / (threshold - slack)) + 1  # NULL may take one place
    tracked = min(_TRACKED, math.ceil(8 / slack))
    own = lambda name: f"if(pmod(xxhash64({name}), {passes}) = {part}, {name}, null)" if passes > 1 else name
    return [F.expr(f"approx_top_k({own(f'f{i}')}, {min(few, tracked)}, {tracked})").alias(f"t{i}") for i in range(len(features))]


def survey(df: DataFrame, features: Sequence[str], threshold: float | None = None) -> Survey:
    """Counts, means and frequent values of all features, nothing shuffled but one row per task.

    A sketch of frequent items whose error stays within a thirtieth of the
    threshold misses no value above it; the few it names beside those are
    weeded out by an exact count. One pass serves thresholds down to a thousandth. Below, the values are divided by
    hash, and each pass has sketches for one share of them; a value that makes its share too large for the
    sketch is far above the threshold itself, and is what is asked for.
    """
    features = list(features)
    place = {name: i for i, name in enumerate(features)}
    numbers = numeric_columns(df, features)
    typed = df.select(
        *[column.alias(f"f{place[name]}") for name, column in _comparable(df, features).items()],
        *[named(name).cast("double").alias(f"d{place[name]}") for name in numbers],
    )
    aggregates = [F.count(F.lit(1)).alias("rows"), *[F.count(f"f{i}").alias(f"c{i}") for i in range(len(features))]]
    aggregates += [F.avg(f"d{place[name]}").alias(f"m{place[name]}") for name in numbers]
    passes = 0 if threshold is None else _passes(threshold)
    if threshold is not None and not passes:
        raise ValueError(f"a threshold of {threshold} takes more than {_MOST_PASSES} passes")
    row: dict = {}
    frequent: dict[str, list[tuple]] = {name: [] for name in features}
    for part in range(max(passes, 1)):
        found = typed.agg(*([] if part else aggregates), *(_sketches(features, threshold, part, passes) if passes else [])).first().asDict()
        row |= {name: value for name, value in found.items() if not name.startswith("t")}
        for i, name in enumerate(features):
            entries = [(entry["item"], entry["count"]) for entry in found.get(f"t{i}") or [] if entry["item"] is not None]
            frequent[name] += [(item, n) for item, n in entries if n > 0.9 * threshold * row["rows"]]
    return Survey(row["rows"], {name: row[f"c{i}"] for i, name in enumerate(features)}, {name: _leading(some, threshold, row["rows"]) for name, some in frequent.items()},
                  {name: row.get(f"m{i}") for i, name in enumerate(features)})


def _leading(entries: list[tuple], threshold: float | None, rows: int) -> list:
    """The values that can be the most frequent one, as far as the sketches tell; the best of them comes first."""
    most = max((n for _, n in entries), default=0)
    return [item for item, n in sorted(entries, key=lambda entry: -entry[1]) if n >= most - 0.2 * threshold * rows]


def dominant_above(df: DataFrame, features: Sequence[str], threshold: float, seen: Survey | None = None) -> DataFrame:
    """AG2 as a filter: features whose dominant share is above ``threshold``, with the exact share.

    A value above the threshold is among the frequent ones that a survey names; one more pass
    counts those exactly. No row is shuffled but for counts of named values. Only thresholds below some
    hundred-thousandths, where nearly all values count, go through the full count.
    """
    spark = df.sparkSession
    features = list(features)
    empty = spark.createDataFrame([], "feature string, dominant_share double")
    if not features:
        return empty
    over = F.col("dominant_share") > F.lit(float(threshold))
    if not _passes(threshold):
        return dominant_share(df, features).where(over)
    seen = survey(df, features, threshold) if seen is None else seen
    values = _comparable(df, features)
    found = [name for name in features if 0 < len(seen.frequent[name]) <= _FEW]
    many = [name for name in features if len(seen.frequent[name]) > _FEW]
    results = []
    if found:
        shares = []
        for name in found:
            each = [F.count(F.when(values[name] == F.lit(item), 1)) for item in seen.frequent[name]]
            shares.append((F.greatest(*each) if len(each) > 1 else each[0]).cast("double") / F.count(F.lit(1)).cast("double"))
        row = df.agg(*[share.alias(f"v{i}") for i, share in enumerate(shares)])
        results.append(_per_feature(row, found, "dominant_share").where(over))
    for kind, names in _by_kind(df, many):
        # at most a value for each threshold's share of the rows, by feature
        asked = spark.createDataFrame([(name, item) for name in names for item in seen.frequent[name]], f"feature string, value {kind}")
        cells = df.select(F.inline(F.array(*[F.struct(F.lit(name).alias("feature"), values[name].alias("value")) for name in names])))
        counted = cells.join(F.broadcast(asked), ["feature", "value"]).groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n"))
        results.append(counted.groupBy("feature").agg((F.max("n").cast("double") / F.lit(float(max(seen.rows, 1)))).alias("dominant_share")).where(over))
    return reduce(DataFrame.unionByName, results) if results else empty


def correlation(df: DataFrame, features: Sequence[str], seen: Survey | None = None, block: int = 256) -> DataFrame:
    """AG3: ``(pos_i, pos_j, feature_i, feature_j, corr)`` for numeric features, i before j.

    Pearson correlation over the rows where both features are present; NULL
    when one of them is constant there. Each task folds its Arrow batches into
    matrices of sums of products of the centred columns and ships them as one row, so the
    rows that are shuffled are as many as the tasks, however many pairs there are.
    Matrices are added in two levels, first among some of the tasks. A wide table is taken in pairs of
    blocks of ``block`` columns; a task's memory is set by the block and not by the table's width, and each
    pair of blocks reads its own columns only.
    """
    names = numeric_columns(df, features)
    size = len(names)
    schema = "pos_i int, pos_j int, feature_i string, feature_j string, corr double"
    if size < 2:
        return df.sparkSession.createDataFrame([], schema)
    numbers = df.select(*[named(name).cast("double").alias(f"f{i}") for i, name in enumerate(names)])
    means = (survey(df, names) if seen is None else seen).means
    # a centre is there to keep digits, so a missing or infinite mean counts as 0
    centre = np.array([m if m is not None and math.isfinite(m) else 0.0 for m in (means[name] for name in names)])

    def folded(first: range, second: range) -> DataFrame:
        """Sums for the pairs of one column of each block."""
        chosen = sorted({*first, *second})
        left, right = [chosen.index(i) for i in first], [chosen.index(i) for i in second]
        middle = centre[chosen]

        def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums = np.zeros((6, len(left), len(right)))
            for batch in batches:
                raw = np.column_stack([column.to_numpy(zero_copy_only=False) for column in batch.columns]).astype(float)
                there = (~np.isnan(raw)).astype(float)
                x = np.where(there > 0, raw - middle, 0.0)
                square = x * x
                with np.errstate(invalid="ignore"):
                    for k, (a, b) in enumerate(((there, there), (x, there), (there, x), (square, there), (there, square), (x, x))):
                        sums[k] += a[:, left].T @ b[:, right]
            yield pa.RecordBatch.from_arrays([pa.array([sums.ravel()], pa.list_(pa.float64()))], names=["sums"])

        made = numbers.select(*[f"f{i}" for i in chosen]).mapInArrow(fold, "sums array<double>")
        return made.select(*[F.lit(x).alias(name) for name, x in zip(where, (first.start, second.start, len(left), len(right)))],
                           array_to_vector("sums").alias("sums"), F.pmod(F.spark_partition_id(), F.lit(pieces)).alias("some"))

    where, pieces = ("a", "b", "height", "width"), max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    blocks = [range(a, min(a + block, size)) for a in range(0, size, block)]
    parts = reduce(DataFrame.unionByName, [folded(p, q) for k, p in enumerate(blocks) for q in blocks[k:]])
    parts = parts.groupBy(*where, "some").agg(Summarizer.sum(F.col("sums")).alias("sums"))
    total = parts.groupBy(*where).agg(vector_to_array(Summarizer.sum(F.col("sums"))).alias("sums"))
    cells = F.col("height") * F.col("width")
    pair = F.transform(F.sequence(F.lit(0), cells - 1), lambda t: F.struct(
        (F.col("a") + F.floor(t / F.col("width"))).cast("int").alias("i"), (F.col("b") + F.pmod(t, F.col("width"))).cast("int").alias("j"),
        *[F.get("sums", F.lit(k) * cells + t).alias(name) for k, name in enumerate(("n", "x", "y", "xx", "yy", "xy"))]))
    total = total.select(F.inline(pair)).where("i < j")
    spread_x = F.col("n") * F.col("xx") - F.col("x") * F.col("x")
    spread_y = F.col("n") * F.col("yy") - F.col("y") * F.col("y")
    together = F.col("n") * F.col("xy") - F.col("x") * F.col("y")
    # what rounding leaves of a constant's variance is no variance, nor is one that is not finite
    finite = (spread_x < F.lit(math.inf)) & (spread_y < F.lit(math.inf))
    varies = finite & (spread_x > F.lit(1e-12) * F.col("n") * F.col("xx")) & (spread_y > F.lit(1e-12) * F.col("n") * F.col("yy"))
    corr = F.when(varies, F.greatest(F.lit(-1.0), F.least(F.lit(1.0), together / (F.sqrt(spread_x) * F.sqrt(spread_y)))))
    labels = F.array(*[F.lit(name) for name in names])
    return total.select(
        F.col("i").alias("pos_i"), F.col("j").alias("pos_j"),
        F.get(labels, F.col("i")).alias("feature_i"), F.get(labels, F.col("j")).alias("feature_j"), corr.alias("corr"),
    )


def collinear(df: DataFrame, features: Sequence[str], threshold: float, seen: Survey | None = None) -> DataFrame:
    """AG4: ``(feature, corr)`` for features that follow one they correlate with above ``threshold``.

    The sign counts: a strong negative correlation flags nothing. The earlier
    feature may be flagged itself. ``corr`` is the largest one found.
    """
    over = correlation(df, features, seen).where(F.col("corr") > F.lit(float(threshold)))
    return over.groupBy(F.col("feature_j").alias("feature")).agg(F.max("corr").alias("corr"))


def elimination_record(df: DataFrame, features: Sequence[str], *, missing: float, dominant: float, collinear_above: float) -> DataFrame:
    """AG1, AG2, AG4 together: ``(reason, feature, value)``, at most one row per feature and reason.

    Features flagged as missing are not counted again; the correlations cover
    all features, flagged or not. The table is read three times: for a survey,
    for exact counts of frequent values, and for the correlations.
    """
    features = list(features)
    seen = survey(df, features, dominant if _passes(dominant) else None)
    shares = {name: (seen.rows - seen.present[name]) / seen.rows if seen.rows else 0.0 for name in features}
    rows = [("missing", name, share) for name, share in shares.items() if share > missing]
    left = [name for name in features if shares[name] <= missing]
    rows += [("disbalance", row["feature"], row["dominant_share"]) for row in dominant_above(df, left, dominant, seen).collect()]
    rows += [("collinear", row["feature"], row["corr"]) for row in collinear(df, features, collinear_above, seen).collect()]
    place = {name: i for i, name in enumerate(features)}
    reasons = ("missing", "disbalance", "collinear")
    rows.sort(key=lambda row: (reasons.index(row[0]), place[row[1]]))
    return df.sparkSession.createDataFrame(rows, RECORD)


def drop_useless(df: DataFrame, record: DataFrame) -> DataFrame:
    """AG5, PF3: ``df`` without the features of the record; names already gone are ignored."""
    return df.drop(*[row["feature"] for row in record.select("feature").distinct().collect()])


def dropped_count(record: DataFrame) -> DataFrame:
    """SE4: how many distinct features the record drops."""
    return record.agg(F.countDistinct("feature").alias("dropped"))
