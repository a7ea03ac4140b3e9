"""Global order without a global window.

A window without partitioning, or partitioned by a two-valued target, runs in
one or two tasks. The three primitives here find ranks, cut points and running
sums with windows over pieces of bounded size only:

* ``hash_cuts``     the key at given ranks of a pseudo-random order
* ``running_sums``  prefix sums along a numeric column
* ``ranked``        1, 2, 3, ... along any order
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lift.functions.columns import hash_order, named
from lift.sources.shared import materialise

_PREFIX = 4  # hex digits: 65,536 buckets of equal expected size


def order_key(id_column: str, seed: int) -> Column:
    """What ``hash_cuts`` orders by: the hash first, the id to break ties."""
    return F.struct(hash_order(seed, named(id_column)).alias("h"), named(id_column).alias("id"))


def hash_cuts(df: DataFrame, id_column: str, seed: int, wanted: Callable[[DataFrame], DataFrame], by: Column | None = None) -> DataFrame:
    """The order keys at wanted ranks, without ranking the rows.

    ``wanted`` turns the groups' sizes ``(g, n)`` into ``(g, ranks)``, for each
    group an array of ranks from 1 to its size. The result has one row per
    group, ``(g, cuts)``, with the sorted array of the keys at those ranks.
    ``by`` is a 0/1 label, so there are two groups at most, and one without it.

    Counts per hash prefix give the sizes and tell which bucket holds a wanted
    rank; only the rows of those buckets, one in 65,536 per rank, are ever
    sorted. Comparing a row with the cuts then needs no shuffle of the rows.
    """
    # written once, so that the wide input is not read again for the counts and for the buckets
    keyed = materialise(df.select((F.lit(0) if by is None else by).alias("g"), order_key(id_column, seed).alias("k")), "order")
    keyed = keyed.select("g", "k", F.substring("k.h", 1, _PREFIX).alias("b"))

    along = Window.partitionBy("g").orderBy("b").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sizes = keyed.groupBy("g", "b").agg(F.count("*").alias("n"))
    targets = wanted(sizes.groupBy("g").agg(F.sum("n").alias("n"))).select(F.col("g").alias("tg"), "ranks")
    sizes = sizes.withColumn("upto", F.sum("n").over(along))
    if by is None:
        sizes = sizes.withColumn("ranks", targets.select("ranks").scalar())
    else:
        sizes = sizes.join(F.broadcast(targets), F.col("g") == F.col("tg"))
    hits = sizes.select(
        F.col("g").alias("hg"), F.col("b").alias("hb"),
        F.expr("transform(filter(ranks, r -> r > upto - n and r <= upto), r -> r - upto + n)").alias("places"),
    ).where(F.size("places") > 0)

    # as many rows as wanted ranks
    near = keyed.join(F.broadcast(hits), (F.col("g") == F.col("hg")) & (F.col("b") == F.col("hb")))
    near = near.groupBy("g", "b", "k", "places").agg(F.count("*").alias("n"))
    inside = Window.partitionBy("g", "b").orderBy("k").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    near = near.withColumn("upto", F.sum("n").over(inside))
    found = near.select("g", "k", F.explode(F.expr("filter(places, r -> r > upto - n and r <= upto)")).alias("place"))
    return found.groupBy("g").agg(F.sort_array(F.collect_list("k")).alias("cuts"))


def with_cuts(df: DataFrame, cuts: DataFrame, by: Column | None = None) -> DataFrame:
    """``df`` plus the column ``__cuts`` of its group; at most two rows are broadcast."""
    if by is None:
        return df.withColumn("__cuts", cuts.select("cuts").scalar())
    groups = F.broadcast(cuts.select(F.col("g").alias("__g"), F.col("cuts").alias("__cuts")))
    return df.join(groups, by == F.col("__g"), "left").drop("__g")


def _pieces(df: DataFrame) -> int:
    return max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def running_sums(df: DataFrame, by: str, along: str, sums: Sequence[str], *, descending: bool = False) -> DataFrame:
    """Per group, the sum of each column up to and with the current row.

    ``df`` has one row per ``(by, along)``, with ``by`` never NULL and ``along``
    a number. For each column ``c`` of ``sums`` the result holds ``upto_c`` and ``total_c``.

    Quantiles of ``along`` split it into ranges of near equal row counts; the
    sums run within a range, and the few totals of the earlier ranges are added.
    The ranges decide the balance only, never the result.
    """
    pieces = _pieces(df)
    edges: list[float] = []
    if pieces > 1:
        shares = [i / pieces for i in range(1, pieces)]
        edges = df.agg(F.percentile_approx(named(along), shares, 20 * pieces).alias("edges")).first()["edges"] or []
    edges = sorted(set(edges))
    if edges:
        cutter = Bucketizer(splits=[-math.inf, *edges, math.inf], inputCol=along, outputCol="__piece")
        split = cutter.transform(df).withColumn("__piece", F.col("__piece").cast("int"))
    else:
        split = df.withColumn("__piece", F.lit(0))

    totals = split.groupBy(by, "__piece").agg(*[F.sum(c).alias(f"__{c}") for c in sums])
    order = F.col("__piece").desc() if descending else F.col("__piece").asc()
    earlier = Window.partitionBy(by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    group = Window.partitionBy(by)
    offsets = totals.select(
        F.col(by).alias("__by"), F.col("__piece").alias("__at"),
        *[F.coalesce(F.sum(f"__{c}").over(earlier), F.lit(0)).alias(f"__before_{c}") for c in sums],
        *[F.sum(f"__{c}").over(group).alias(f"total_{c}") for c in sums],
    )
    inside = (Window.partitionBy(by, "__piece").orderBy(named(along).desc() if descending else named(along).asc())
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    run = split.select("*", *[F.sum(c).over(inside).alias(f"__run_{c}") for c in sums])
    # the window leaves the rows partitioned and sorted by group and range, so this join moves only the offsets
    run = run.join(offsets, (F.col(by) == F.col("__by")) & (F.col("__piece") == F.col("__at")))
    return run.select(
        *[named(name) for name in df.columns],
        *[(F.col(f"__run_{c}") + F.col(f"__before_{c}")).alias(f"upto_{c}") for c in sums],
        *[F.col(f"total_{c}") for c in sums],
    )


def ranked(df: DataFrame, order: Sequence[str], rank: str, label: str = "ranked") -> DataFrame:
    """``df`` plus its position, from 1, in the order of the named columns.

    Rows are range-partitioned and sorted once. ``monotonically_increasing_id``
    then holds the partition and the place within it; written out, those ids
    stay fixed, and one offset per partition turns them into ranks.
    """
    columns = [named(name) for name in order]
    ranged = df.repartitionByRange(_pieces(df), *columns).sortWithinPartitions(*columns)
    placed = materialise(ranged.withColumn("__id", F.monotonically_increasing_id()), label)
    placed = placed.withColumn("__part", F.shiftright("__id", 33))
    sizes = placed.groupBy("__part").agg(F.count("*").alias("__n"))
    earlier = Window.partitionBy(F.lit(0)).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(F.col("__part"), F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__before"))
    within = F.col("__id").bitwiseAND(F.lit((1 << 33) - 1))
    return placed.join(F.broadcast(offsets), "__part").select(*[named(name) for name in df.columns], (within + F.col("__before") + 1).alias(rank))
