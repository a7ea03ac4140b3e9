"""Column expressions shared by the operators; all of them stay in the JVM."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
FRACTIONAL = (T.FloatType, T.DoubleType, T.DecimalType)
BINARY_FLOAT = (T.FloatType, T.DoubleType)


def as_list(names: str | Iterable[str] | None) -> list[str]:
    """A comma separated string or any iterable of names, as a list of names."""
    if names is None:
        return []
    if isinstance(names, str):
        return [part.strip() for part in names.split(",") if part.strip()]
    return list(names)


def named(name: str) -> Column:
    """The column called ``name``, also when the name holds dots or blanks."""
    return F.col("`" + name.replace("`", "``") + "`")


def columns_of(df: DataFrame, kinds: tuple, among: Sequence[str] | None = None) -> list[str]:
    """Names of the columns whose type is one of ``kinds``, in the order of ``among``."""
    types = {field.name: field.dataType for field in df.schema.fields}
    return [name for name in (df.columns if among is None else among) if isinstance(types[name], kinds)]


def text_columns(df: DataFrame, among: Sequence[str] | None = None) -> list[str]:
    return columns_of(df, (T.StringType, T.CharType, T.VarcharType), among)


def numeric_columns(df: DataFrame, among: Sequence[str] | None = None) -> list[str]:
    return columns_of(df, INTEGRAL + FRACTIONAL + (T.BooleanType,), among)


def nan_to_null(df: DataFrame, among: Sequence[str]) -> DataFrame:
    """Spark tells NaN from NULL; the operators know NULL only."""
    floats = columns_of(df, BINARY_FLOAT, among)
    return df.withColumns({name: F.nullif(named(name), F.lit(float("nan"))) for name in floats})


def above(score: Column, threshold: float) -> Column:
    """PF4: 1 where the score is strictly above the threshold, else 0."""
    return (score > F.lit(float(threshold))).cast("int")


def probability_of_one(probability: Column) -> Column:
    return vector_to_array(probability)[1]


def hash_order(seed: int, *keys: Column) -> Column:
    """A pseudo-random sort key that depends on the seed and the keys alone.

    The md5 text is the same in every SQL engine, and its prefixes are spread
    evenly whatever the keys look like, so they make buckets of equal size.
    """
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[key.cast("string") for key in keys]))


def label_of(target: str) -> Column:
    """The target as the 0.0 or 1.0 that Spark ML expects, be it an integer, a double or a boolean."""
    return named(target).cast("double")


def checked_label(label: Column) -> Column:
    """The label as an int; anything but 0 and 1 is an error, not a lost row."""
    value = label.cast("double")
    return F.when(value.isin(0.0, 1.0), value.cast("int")).otherwise(
        F.raise_error(F.concat(F.lit("label must be 0 or 1, found "), F.coalesce(label.cast("string"), F.lit("NULL"))))
    )


def checked_score(score: Column) -> Column:
    value = score.cast("double")
    # NaN sorts above infinity, so the comparison leaves it out as well
    return F.when(F.abs(value) < F.lit(float("inf")), value).otherwise(F.raise_error(F.lit("score must be a finite number")))


def free_of(df: DataFrame, *names: str) -> None:
    """An error if ``df`` has a column that an operator is about to add."""
    taken = {name.lower() for name in df.columns} & {name.lower() for name in names}
    if taken:
        raise ValueError(f"columns {', '.join(sorted(taken))} are added here and exist already")


def in_training_order(df: DataFrame, *keys: Column, most: int | None = None) -> DataFrame:
    """``df`` on a fixed number of partitions in a fixed order, as a tree fit depends on both.

    Rows are dealt out by a hash of ``keys``, or of all columns without any, and
    sorted. The number of partitions is the session's
    ``spark.sql.shuffle.partitions``: a setting made for the data, and not the
    cores that happen to be there. So the same rows give the same model however
    they were stored. With ``most`` there are no more partitions than that.
    """
    columns = [named(name) for name in df.columns]
    mixed = F.xxhash64(*(keys or columns))
    pieces = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(pieces if most is None else min(pieces, most), mixed).sortWithinPartitions(mixed, *columns)
