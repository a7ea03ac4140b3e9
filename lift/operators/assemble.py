"""Wide tables from a population and its feature tables (PF1, PF2, JN1, JN2, AS1-AS6)."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lift.functions.columns import INTEGRAL, columns_of, nan_to_null, named
from lift.operators.registry import FeatureSet, choose_sets, chosen_sets, leave_out

Tables = Mapping[str, DataFrame] | Callable[[str], DataFrame]


def _table(tables: Tables, name: str) -> DataFrame:
    return tables(name) if callable(tables) else tables[name]


def base_rows(population: DataFrame, id_column: str, target: str | None = None) -> DataFrame:
    """PF1, AS1: the id, and the target when there is one."""
    return population.select(*[named(name) for name in (id_column, target) if name is not None])


def set_columns(table: DataFrame, id_column: str, features: Sequence[str]) -> DataFrame:
    """PF2: the id and the features of one set."""
    return table.select(named(id_column), *[named(name) for name in features])


def fetch_set(population: DataFrame, table: DataFrame, id_column: str, features: Sequence[str]) -> DataFrame:
    """JN1, AS2: the features of the population's entities that the table covers."""
    return base_rows(population, id_column).join(set_columns(table, id_column, features), id_column, "inner")


def add_set(wide: DataFrame, table: DataFrame, id_column: str, features: Sequence[str]) -> DataFrame:
    """JN2: left join of one feature set; entities it lacks get NULL."""
    return wide.join(set_columns(table, id_column, features), id_column, "left")


def unique_ids(df: DataFrame, id_column: str, name: str) -> DataFrame:
    """``df``, or an error when it is read if an id occurs twice.

    The window needs the partitioning and order that the join on the id needs,
    so the join reuses both and the check costs no shuffle or job of its own.
    """
    place = F.row_number().over(Window.partitionBy(named(id_column)).orderBy(named(id_column)))
    message = F.concat(F.lit(f"{name}: {id_column} occurs more than once: "), F.coalesce(named(id_column).cast("string"), F.lit("NULL")))
    checked = df.withColumn("__place", place)
    return checked.where(F.when(F.col("__place") == 1, F.lit(True)).otherwise(F.raise_error(message).cast("boolean"))).drop("__place")


def _known_unique(tables: Tables, name: str, id_column: str) -> bool:
    """Whether the tables' owner vouches for the id, as ``CatalogTables`` does for tables that were written by upserts."""
    vouched = getattr(tables, "unique_by", None)
    return vouched is not None and vouched(name, id_column)


def assemble(population: DataFrame | str, sets: Sequence[FeatureSet], tables: Tables, id_column: str,
             target: str | None = None, *, check_ids: bool = True) -> DataFrame:
    """AS3: the population left-joined with every feature set.

    Columns are id, target, then the features in registry order; rows are those
    of the population. Every join is on the id, so the first one's partitioning
    serves them all, and tables bucketed by id join without a shuffle. Small
    tables are broadcast when Spark's size check allows it.

    A repeated id is an error that shows when the result is read. The check needs
    a table in the order of its ids, which a broadcast or bucketed one is not, so
    it is left out where the key is known to be unique: for tables that
    ``tables`` vouches for (``CatalogTables``), the population among them if it is
    given by name, and for all with ``check_ids=False``.
    """
    sets = [one for one in sets if one.features]
    names = [name for one in sets for name in one.features]
    taken = {id_column, target}
    for name in names:
        if name in taken:
            raise ValueError(f"column {name} occurs twice")
        taken.add(name)

    def feature_table(one: FeatureSet) -> DataFrame:
        table = set_columns(_table(tables, one.source), id_column, one.features)
        # a NULL id matches no entity
        table = table.where(named(id_column).isNotNull())
        return unique_ids(table, id_column, one.source) if check_ids and not _known_unique(tables, one.source, id_column) else table

    by_name = isinstance(population, str)
    base = base_rows(_table(tables, population) if by_name else population, id_column, target)
    if check_ids and not (by_name and _known_unique(tables, population, id_column)):
        base = unique_ids(base, id_column, "population")
    wide = reduce(lambda left, one: add_set(left, feature_table(one), id_column, one.features), sets, base)
    return nan_to_null(wide, names)


def load_features(population: DataFrame | str, registry: DataFrame, tables: Tables, id_column: str, target: str | None = None, *,
                  feature_sets: str | Sequence[str] = "all", except_sets: str | Sequence[str] | None = None,
                  except_features: str | Sequence[str] | None = None, check_ids: bool = True) -> tuple[DataFrame, list[str]]:
    """AS4, AS5: choose sets, assemble them, and name the features loaded.

    Selection passes choices and a target, model building a target, scoring
    neither.
    """
    chosen = leave_out(choose_sets(registry, feature_sets), except_sets, except_features)
    sets = chosen_sets(chosen)
    wide = assemble(population, sets, tables, id_column, target, check_ids=check_ids)
    return wide, [name for one in sets for name in one.features]


def narrow(df: DataFrame, columns: Sequence[str], *, to_float: bool = False) -> DataFrame:
    """AS6, AG7: cast each integer column to the smallest type that holds it.

    A type fits when the column's minimum and maximum lie strictly inside its
    range. Doubles stay as they are unless ``to_float`` allows the loss of
    digits. The id is not among ``columns``: narrowing must not touch keys.
    """
    integers = columns_of(df, INTEGRAL, columns)
    doubles = columns_of(df, (T.DoubleType,), columns) if to_float else []
    wanted = integers + doubles
    if not wanted:
        return df
    bounds = df.agg(*[f(named(name)).alias(f"{f.__name__}{i}") for i, name in enumerate(wanted) for f in (F.min, F.max)]).first()
    casts = {}
    for i, name in enumerate(wanted):
        low, high = bounds[f"min{i}"], bounds[f"max{i}"]
        if low is None:
            continue
        if name in integers:
            size = next((bits for bits in (8, 16, 32) if -(1 << bits - 1) < low and high < (1 << bits - 1) - 1), 64)
            casts[name] = named(name).cast({8: "tinyint", 16: "smallint", 32: "int", 64: "bigint"}[size])
        elif -_FLOAT_MAX < low and high < _FLOAT_MAX:
            casts[name] = named(name).cast("float")
    return df.withColumns(casts) if casts else df


_FLOAT_MAX = (2 - 2.0**-23) * 2.0**127
