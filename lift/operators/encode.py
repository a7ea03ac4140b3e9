"""Constant fill and category codes (EN1-EN4).

Text features are encoded first and gaps filled after, in every plan, so a
missing category gets the code for "missing" and not one of its own.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lift.functions.columns import BINARY_FLOAT, FRACTIONAL, INTEGRAL, named, text_columns
from lift.operators.order import ranked
from lift.sources.shared import materialise

UNSEEN = -1


def fill_constant(df: DataFrame, features: Sequence[str], value: float = -1) -> DataFrame:
    """EN1: replace NULL in the features; the id and the target are left alone.

    A projection, so no pass over the data looks for gaps beforehand. Booleans
    become 0 and 1, an integer column is widened for a value with a fraction,
    NaN counts as a gap, and text is left as it is.
    """
    wanted = set(features)
    whole = float(value).is_integer()

    def filled(field: T.StructField) -> Column:
        cell, kind = named(field.name), field.dataType
        if field.name not in wanted or not isinstance(kind, (*INTEGRAL, *FRACTIONAL, T.BooleanType)):
            return cell
        if isinstance(kind, T.BooleanType):
            cell, kind = cell.cast("int"), T.IntegerType()
        if isinstance(kind, BINARY_FLOAT):
            cell = F.nullif(cell, F.lit(float("nan")).cast(kind))
        fits = isinstance(kind, FRACTIONAL) or whole
        number = F.lit(int(value) if whole else float(value))
        return F.coalesce(cell, number.cast(kind)) if fits else F.coalesce(cell.cast("double"), number)

    return df.select(*[filled(field).alias(field.name) for field in df.schema.fields])


def fit_categories(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """EN2: ``(column, value, code)`` for the text features, codes from 0 in value order.

    All features are read in one pass and distinct values combine before the
    shuffle. The codes come from one distributed sort, so a feature with more
    values than one task can hold is numbered like any other.
    """
    texts = text_columns(df, features)
    if not texts:
        return df.sparkSession.createDataFrame([], "column string, value string, code bigint")
    cells = F.explode(F.array(*[F.struct(F.lit(name).alias("column"), named(name).alias("value")) for name in texts])).alias("cell")
    values = df.select(cells).select("cell.*").where(F.col("value").isNotNull()).distinct()
    placed = ranked(values, ["column", "value"], "rank", label="categories")
    first = placed.groupBy("column").agg(F.min("rank").alias("first"))  # one row per text feature
    return placed.join(F.broadcast(first), "column").select("column", "value", (F.col("rank") - F.col("first")).cast("bigint").alias("code"))


def apply_categories(df: DataFrame, features: Sequence[str], dictionary: DataFrame) -> DataFrame:
    """EN3, EN4: text features as codes; a missing or unseen value becomes -1.

    One left join per text feature. Spark broadcasts a dictionary that fits its
    size limit; a larger one is shuffled, and adaptive execution splits the
    partition of a category that holds a large part of the rows.
    """

    def encode(left: DataFrame, name: str) -> DataFrame:
        codes = dictionary.where(F.col("column") == name).select(F.col("value").alias("__value"), F.col("code").alias("__code"))
        joined = left.join(codes, named(name) == F.col("__value"), "left")
        return joined.select(*[
            F.coalesce(F.col("__code"), F.lit(UNSEEN).cast("bigint")).alias(name) if column == name else named(column) for column in left.columns
        ])

    return reduce(encode, text_columns(df, features), df)


def encode_categories(df: DataFrame, features: Sequence[str], path: str | None = None) -> tuple[DataFrame, DataFrame]:
    """EN2, EN3: fit and apply; the dictionary is stored at ``path``, or in the shared folder."""
    dictionary = fit_categories(df, features)
    if path is None:
        dictionary = materialise(dictionary, "dictionary")
    else:
        save_categories(dictionary, path)
        dictionary = load_categories(df, path)
    return apply_categories(df, features, dictionary), dictionary


def save_categories(dictionary: DataFrame, path: str) -> None:
    dictionary.write.mode("overwrite").parquet(path)


def load_categories(df: DataFrame, path: str) -> DataFrame:
    return df.sparkSession.read.schema("column string, value string, code bigint").parquet(path)
