"""Stratified holdout and folds, and exact row samples (SP1, SP2, PF6).

All three order the rows by a seeded hash of the id and cut that order at a few
ranks. The cuts are found from counts; the rows are then compared with them in a
projection. No row is shuffled, and the outcome does not depend on partitions.
The target is a 0/1 label, so there are two classes.
Ids are unique in an assembled table; copies of an id would go to one side.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lift.functions.columns import checked_label, free_of, named
from lift.operators.order import hash_cuts, order_key, with_cuts

TRAIN, HOLDOUT = "train", "holdout"


def _exact(share: float) -> Column:
    """A share such as 0.2 as the decimal it is written as."""
    return F.lit(Decimal(repr(float(share)))).cast("decimal(18,12)")


def holdout_sizes(classes: DataFrame, share: float) -> DataFrame:
    """``(g, n, held)`` from the class sizes ``(g, n)``: how many rows of each class are held out.

    The holdout has ``ceil(share * rows)`` rows. The train part is divided
    among the classes in proportion; rows left over by rounding down go to the
    classes with the largest remainders.
    """
    everything = Window.partitionBy(F.lit(0))  # one row per class
    sized = classes.withColumn("total", F.sum("n").over(everything))
    sized = sized.withColumn("train", F.col("total") - F.ceil(_exact(share) * F.col("total")).cast("bigint"))
    product = F.col("train").cast("decimal(19,0)") * F.col("n").cast("decimal(19,0)")
    sized = sized.withColumn("rest", product % F.col("total"))
    sized = sized.withColumn("kept", ((product - F.col("rest")) / F.col("total")).cast("bigint"))
    largest = everything.orderBy(F.col("rest").desc(), F.col("g").asc())
    extra = (F.row_number().over(largest) <= F.col("train") - F.sum("kept").over(everything)).cast("int")
    return sized.select("g", "n", (F.col("n") - F.col("kept") - extra).alias("held"))


def holdout(df: DataFrame, id_column: str, target: str, share: float = 0.2, seed: int = 1) -> DataFrame:
    """SP1: ``df`` plus ``split``, either ``train`` or ``holdout``, class shares kept."""

    def last_held(classes: DataFrame) -> DataFrame:
        return holdout_sizes(classes, share).select("g", F.filter(F.array("held"), lambda r: r > 0).alias("ranks"))

    free_of(df, "split")
    label = checked_label(named(target))
    cuts = hash_cuts(df, id_column, seed, last_held, by=label)
    held = F.coalesce(order_key(id_column, seed) <= F.get("__cuts", F.lit(0)), F.lit(False))
    return with_cuts(df, cuts, by=label).select(*[named(name) for name in df.columns], F.when(held, HOLDOUT).otherwise(TRAIN).alias("split"))


def folds(df: DataFrame, id_column: str, target: str, k: int = 4, seed: int = 1) -> DataFrame:
    """SP2: ``df`` plus ``fold`` from 0 to k-1; a class's fold sizes differ by one at most."""
    free_of(df, "fold")
    if k < 2:
        raise ValueError("at least two folds are needed")

    def last_of_each(classes: DataFrame) -> DataFrame:
        n = F.col("n").cast("decimal(19,0)")
        return classes.select("g", F.array(*[F.ceil(n * F.lit(j) / F.lit(k)).cast("bigint") for j in range(1, k)]).alias("ranks"))

    label = checked_label(named(target))
    cuts = hash_cuts(df, id_column, seed, last_of_each, by=label)
    key = order_key(id_column, seed)
    fold = sum((F.coalesce(key > F.get("__cuts", F.lit(j)), F.lit(False)).cast("int") for j in range(k - 1)), F.lit(0))
    return with_cuts(df, cuts, by=label).select(*[named(name) for name in df.columns], fold.alias("fold"))


def sample_rows(df: DataFrame, id_column: str, share: float = 1.0, seed: int = 1) -> DataFrame:
    """PF6: exactly ``round(share * rows)`` rows, halves rounded to even; 1.0 keeps every row."""
    if not 0.0 <= share <= 1.0:
        raise ValueError(f"a share lies between 0 and 1, not at {share}")
    if share == 1.0:
        return df

    def last_taken(groups: DataFrame) -> DataFrame:
        size = F.bround(_exact(share) * F.col("n")).cast("bigint")
        return groups.select("g", F.filter(F.array(size), lambda r: r > 0).alias("ranks"))

    cuts = hash_cuts(df, id_column, seed, last_taken)
    return with_cuts(df, cuts).where(order_key(id_column, seed) <= F.get("__cuts", F.lit(0))).select(*[named(name) for name in df.columns])
