"""Keyed tables, SQL access, replace-load and the score sink (IO1-IO9)."""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lift.functions.columns import as_list, named
from lift.sources.shared import materialise

_ORDER = "__arrival"
#: The column that a partitioned table has behind its own: which part a row's key falls into.
PART = "__part"
#: Table properties: the key that its rows are unique by, and the number of parts.
_KEY, _PARTS = "lift.key", "lift.parts"


#: What a text can be read as, the narrowest type first.
_NUMBER = r"[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?|[+-]?Infinity|-?Inf|NaN"
_KINDS = ("bigint", "double", "boolean")


def _fits(value: Column, kind: str) -> Column:
    """Whether the CSV reader takes a text as a value of this type."""
    if kind == "bigint":
        return value.rlike(r"^[+-]?[0-9]+$") & value.try_cast("bigint").isNotNull()
    # a whole number too large for a long is not a plain number: as a double it would lose digits
    return value.rlike(f"^({_NUMBER})$") & ~(value.rlike(r"^[+-]?[0-9]+$") & value.try_cast("bigint").isNull()) if kind == "double" else F.lower(value).isin("true", "false")


def _type_counts(names: Sequence[str]) -> list[Column]:
    """For each column how many texts it has and how many of them fit each type: sums, so that parts of a file combine."""
    counts = []
    for i, name in enumerate(names):
        counts.append(F.count(named(name)).alias(f"n{i}"))
        counts += [F.count_if(_fits(named(name), kind)).alias(f"{kind}{i}") for kind in _KINDS]
    return counts


def _schema_of(names: Sequence[str], counts: Mapping[str, int]) -> T.StructType:
    """The narrowest type that takes all texts of a column; text where none does or there is no text."""
    kinds = {"bigint": T.LongType(), "double": T.DoubleType(), "boolean": T.BooleanType()}
    chosen = [next((kinds[kind] for kind in _KINDS if 0 < counts[f"n{i}"] == counts[f"{kind}{i}"]), T.StringType()) for i in range(len(names))]
    return T.StructType([T.StructField(name, kind) for name, kind in zip(names, chosen)])


def _as_texts(spark: SparkSession, path: str | Sequence[str], *, multi_line: bool) -> T.StructType:
    """The columns that the header names, all text; no row is read for it but the header."""
    names = spark.read.csv(path, header=True, multiLine=multi_line, escape='"').columns
    return T.StructType([T.StructField(name, T.StringType()) for name in names])


def infer_csv_schema(spark: SparkSession, path: str | Sequence[str], *, multi_line: bool = False) -> T.StructType:
    """IO2: long, double, boolean or text per column, seen over the whole file in one read.

    Dates and anything else that is not a plain number stay text, and so does a
    column with a whole number beyond 64 bits.
    """
    texts = _as_texts(spark, path, multi_line=multi_line)
    rows = spark.read.csv(path, header=True, schema=texts, multiLine=multi_line, escape='"')
    return _schema_of(texts.names, rows.agg(*_type_counts(texts.names)).first().asDict())


def read_csv_in_order(spark: SparkSession, path: str | Sequence[str], schema: T.StructType, *, multi_line: bool = False) -> DataFrame:
    """CSV rows plus ``__arrival``, which orders them as they stand in the files.

    Columns are taken by position; a row of the wrong arity stops the read.
    An empty field becomes NULL. Files count in the order of their paths; the
    block start orders the splits of one file, and the increasing id orders
    the rows of one split.
    """
    rows = spark.read.csv(path, header=True, schema=schema, mode="FAILFAST", multiLine=multi_line, escape='"')
    arrival = F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("line"),
    )
    return rows.select("*", arrival.alias(_ORDER))


def last_per_key(rows: DataFrame, keys: Sequence[str], order: str | None) -> DataFrame:
    """One row per key: the one with the greatest ``order``, or any one without an order.

    ``max_by`` combines on the map side, so a key that holds a third of all
    rows sends one row per task through the shuffle.
    """
    names = [name for name in rows.columns if name != order]
    whole = F.struct(*[named(name) for name in names])
    place = F.lit(0) if order is None else named(order)
    kept = rows.groupBy(*[named(key).alias(f"__key{i}") for i, key in enumerate(keys)]).agg(F.max_by(whole, place).alias("__row"))
    return kept.select("__row.*")


def part_of(keys: Sequence[str], parts: int) -> Column:
    """The part of a key: as Spark buckets it, so that the buckets of a table fall into parts whole."""
    return F.pmod(F.hash(*[named(key) for key in keys]), F.lit(parts)).alias(PART)


def _laid_out(df: DataFrame, keys: Sequence[str], buckets: int | None) -> DataFrame:
    """Rows dealt out as they are written: a task per bucket, or partitions of even size that hold few parts each."""
    if buckets:
        return df.repartition(buckets, *[named(key) for key in keys])
    return df.hint("rebalance", F.col(PART)) if PART in df.columns else df


def _swap_in(df: DataFrame, table: str, keys: Sequence[str], buckets: int | None, parts: int | None = None, *, unique: bool = False) -> None:
    """Write a complete new version beside ``table``, then take its name.

    The old version is renamed aside and dropped last, so a failure on the way
    leaves it there under one name or the other.
    """
    spark = df.sparkSession
    if parts and buckets and buckets % parts:
        raise ValueError(f"{buckets} buckets do not divide into {parts} parts")
    staged, aside = f"{table}__{uuid.uuid4().hex[:12]}", f"{table}__{uuid.uuid4().hex[:12]}_old"
    if parts:
        df = df.select("*", part_of(keys, parts))
    writer = _laid_out(df, keys, buckets).write.format("parquet")
    writer = writer.bucketBy(buckets, *keys).sortBy(*keys) if buckets else writer  # one file per bucket
    writer = writer.partitionBy(PART) if parts else writer
    writer.saveAsTable(staged)
    known = ({_KEY: json.dumps(list(keys))} if unique else {}) | ({_PARTS: str(parts)} if parts else {})
    if known:
        spark.sql(f"ALTER TABLE {staged} SET TBLPROPERTIES ({', '.join(f'{_text(name)} = {_text(value)}' for name, value in known.items())})")
    if spark.catalog.tableExists(table):
        spark.sql(f"ALTER TABLE {table} RENAME TO {aside}")
        spark.sql(f"ALTER TABLE {staged} RENAME TO {table}")
        spark.sql(f"DROP TABLE {aside}")
    else:
        spark.sql(f"ALTER TABLE {staged} RENAME TO {table}")
    if parts:  # a catalog may leave the parts of a renamed table where they were
        folder = _about(spark, table)["Location"]
        for row in spark.sql(f"SHOW PARTITIONS {table}").collect():
            part = row["partition"].rpartition("=")[2]
            spark.sql(f"ALTER TABLE {table} PARTITION ({PART} = {part}) SET LOCATION {_text(f'{folder}/{PART}={part}')}")
        _measure(spark, table)


def _measure(spark: SparkSession, table: str) -> None:
    """Record the size of a table's files; without it a partitioned table counts as too large to broadcast."""
    spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS NOSCAN")


def _text(value: str) -> str:
    """A text as a literal of SQL."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _property(spark: SparkSession, table: str, name: str) -> str | None:
    found = {row["key"]: row["value"] for row in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}
    return found.get(name)


def _about(spark: SparkSession, table: str) -> dict[str, str]:
    return {row["col_name"]: row["data_type"] for row in spark.sql(f"DESCRIBE EXTENDED {table}").collect()}


def bucket_count(spark: SparkSession, table: str) -> int | None:
    """How many buckets a table has, or None."""
    about = _about(spark, table)
    return int(about["Num Buckets"]) if "Num Buckets" in about else None


def part_count(spark: SparkSession, table: str) -> int | None:
    """How many parts a partitioned table has, or None."""
    found = _property(spark, table, _PARTS)
    return int(found) if found else None


def unique_key(spark: SparkSession, table: str) -> list[str]:
    """The columns that the table's rows are unique by, as far as ``upsert`` wrote them all; none if that isn't known."""
    return json.loads(_property(spark, table, _KEY) or "[]")


def keyed_table(spark: SparkSession, table: str) -> DataFrame:
    """The rows of a table, without the column of its parts."""
    return spark.table(table).drop(PART)


@dataclass(frozen=True)
class CatalogTables:
    """The tables of a session's catalog by name, and what is known of their keys."""

    spark: SparkSession

    def __call__(self, name: str) -> DataFrame:
        return keyed_table(self.spark, name)

    def unique_by(self, name: str, column: str) -> bool:
        """Whether no two rows share a value of the column, because ``upsert`` wrote them."""
        return self.spark.catalog.tableExists(name) and unique_key(self.spark, name) == [column]


def _replaced(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``new``, and the rows of ``old`` whose key it does not bring. Both have unique keys.

    Old rows are not sorted or grouped again: a small load is broadcast to them,
    a large one joined by key. Rows with a NULL in their key, which no join
    matches, are few or none and combined by themselves.
    """
    gap = reduce(Column.__or__, [named(key).isNull() for key in keys])

    def arrived(df: DataFrame, load: int) -> DataFrame:
        return df.where(gap).withColumn(_ORDER, F.lit(load))

    kept = old.where(~gap).join(new.where(~gap).select(*[named(key) for key in keys]), list(keys), "left_anti")
    odd = last_per_key(arrived(old, 0).unionByName(arrived(new, 1)), keys, _ORDER)
    return kept.select(*old.columns).unionByName(new.where(~gap)).unionByName(odd)


def upsert(rows: DataFrame, table: str, primary_key: str | Sequence[str], *, order: str | None = None, buckets: int | None = None,
           parts: int | None = None) -> None:
    """Insert or replace ``rows`` into ``table`` by key; the latest row of a key wins.

    ``order`` names a column that orders the rows of this load and is not
    stored; without it the keys of one load should be unique. Columns go by
    position, as the table's schema is frozen by its first load. With
    ``buckets`` the table is bucketed by its key, and joins on the key need
    no shuffle; a table that is bucketed stays so.

    Without ``parts`` the whole table is written anew. With it the table is
    partitioned by a hash of the key, in a last column ``__part`` that
    ``keyed_table`` leaves out, and a load reads and rewrites only the parts that
    its keys fall into. Choose as many parts as the table has gigabytes, and as a
    divisor of the buckets. A table keeps its parts; another number of them
    writes it anew once.
    """
    spark = rows.sparkSession
    keys = as_list(primary_key)
    new = last_per_key(rows, keys, order)
    if not spark.catalog.tableExists(table):
        _swap_in(new, table, keys, buckets, parts, unique=True)
        return
    old, known = keyed_table(spark, table), part_count(spark, table)
    if len(old.columns) != len(new.columns):
        raise ValueError(f"{table} has {len(old.columns)} columns, the load has {len(new.columns)}")
    typed = [named(name).cast(field.dataType).alias(field.name) for name, field in zip(new.columns, old.schema.fields)]
    keys = [old.columns[new.columns.index(key)] for key in keys]
    new = materialise(new.select(*typed), "load")
    kept_buckets = bucket_count(spark, table)
    same = known and parts in (None, known) and buckets in (None, kept_buckets) and unique_key(spark, table) == keys
    if same:
        _replace_parts(new, table, keys, known, kept_buckets)
    else:
        _swap_in(_replaced(old, new, keys), table, keys, buckets or kept_buckets, parts or known, unique=True)


def _replace_parts(new: DataFrame, table: str, keys: Sequence[str], parts: int, buckets: int | None) -> None:
    """Rewrite the parts that the keys of ``new`` fall into; the files of all others stay as they are.

    The parts are complete in the shared folder before any is replaced, so a
    failure on the way is mended by running the load again.
    """
    spark = new.sparkSession
    touched = [row[PART] for row in new.select(part_of(keys, parts)).distinct().collect()]  # at most as many as the table has
    if not touched:
        return
    old = spark.table(table).where(F.col(PART).isin(touched)).drop(PART)
    merged = materialise(_replaced(old, new, keys), "parts").select("*", part_of(keys, parts))
    setting = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "dynamic")
    try:
        _laid_out(merged, keys, buckets).write.insertInto(table, overwrite=True)
    finally:
        spark.conf.set(setting, before)
    _measure(spark, table)


def load_csv(spark: SparkSession, path: str | Sequence[str], table: str, primary_key: str | Sequence[str], *,
             schema: T.StructType | None = None, multi_line: bool = False, buckets: int | None = None, parts: int | None = None) -> None:
    """IO1: upsert CSV files into a keyed table, creating it at the first load.

    Files whose types are not known are read once: they are kept as texts while
    the texts are counted by type.
    """
    if schema is None and spark.catalog.tableExists(table):
        schema = keyed_table(spark, table).schema
    if schema is not None:
        rows = read_csv_in_order(spark, path, schema, multi_line=multi_line)
    else:
        texts = _as_texts(spark, path, multi_line=multi_line)
        seen = Observation("csv")
        rows = materialise(read_csv_in_order(spark, path, texts, multi_line=multi_line).observe(seen, *_type_counts(texts.names)), "csv")
        rows = rows.select(*[named(field.name).cast(field.dataType) for field in _schema_of(texts.names, seen.get)], _ORDER)
    upsert(rows, table, primary_key, order=_ORDER, buckets=buckets, parts=parts)


def read_sql(spark: SparkSession, query: str) -> DataFrame:
    """IO3: any query over catalog tables and views."""
    return spark.sql(query)


def execute(spark: SparkSession, statement: str) -> None:
    """IO6: a statement run for its effect, such as ``DROP TABLE``."""
    spark.sql(statement)


def lower_names(df: DataFrame) -> DataFrame:
    """IO4: column names in lower case."""
    return df.toDF(*[name.lower() for name in df.columns])


def strip_prefixes(df: DataFrame) -> DataFrame:
    """IO5: ``table.column`` becomes ``column``, the text after the last dot."""
    return df.toDF(*[name.rsplit(".", 1)[-1] for name in df.columns])


def bounds_query(query: str, column: str) -> str:
    """The least and the greatest value of a column of a query, in the query's own database."""
    return f"SELECT MIN({column}) AS low, MAX({column}) AS high FROM ({query}) lift_bounds"


def remainder_predicates(expression: str, tasks: int) -> list[str]:
    """Conditions that divide rows among tasks by a whole number, which may be negative; each row meets exactly one."""
    if tasks < 2:
        return ["1 = 1"]
    first = f"(MOD({expression}, {tasks}) = 0 OR ({expression}) IS NULL)"
    return [first, *[f"MOD({expression}, {tasks}) IN ({i}, {i - tasks})" for i in range(1, tasks)]]


def read_jdbc(spark: SparkSession, url: str, query: str, *, properties: Mapping[str, str] | None = None,
              partition_column: str | None = None, lower: int | None = None, upper: int | None = None,
              partitions: int | None = None, spread_by: str | None = None) -> DataFrame:
    """IO4: a query run by an external database, names in lower case.

    With a partition column the result is fetched by ``partitions`` tasks, each
    taking an equal part of the column's range; the range is asked for first
    unless ``lower`` and ``upper`` tell it. ``spread_by`` is for queries without
    such a column: an expression of the database that gives a whole number, such
    as a hash of the key, by whose remainder the rows are divided.
    """
    options = {"url": url} | dict(properties or {})
    reader = spark.read.format("jdbc").options(**options)
    if (partition_column or spread_by) and partitions is None:
        raise ValueError("a partition column or an expression to spread by needs partitions")
    if spread_by is not None:
        return lower_names(spark.read.jdbc(url, f"({query}) lift_query", predicates=remainder_predicates(spread_by, partitions),
                                           properties=dict(properties or {})))
    if partition_column is None:
        return lower_names(reader.option("query", query).load())
    if None in (lower, upper):
        ends = reader.option("query", bounds_query(query, partition_column)).load().first()
        lower, upper = (ends[0] if lower is None else lower), (ends[1] if upper is None else upper)
    reader = spark.read.format("jdbc").options(**options).option("dbtable", f"({query}) lift_query")
    if lower is not None and upper is not None:  # else no row has a value
        reader = reader.options(partitionColumn=partition_column, lowerBound=str(lower), upperBound=str(upper), numPartitions=str(partitions))
    return lower_names(reader.load())


def read_warehouse(spark: SparkSession, query: str) -> DataFrame:
    """IO5: a query on the session's (Hive) catalog, table prefixes removed."""
    return strip_prefixes(spark.sql(query))


def replace_load(df: DataFrame, table: str, *, keys: str | Sequence[str] = (), buckets: int | None = None) -> None:
    """IO7: drop and reload a table with all rows of ``df``, duplicates kept."""
    _swap_in(df, table, as_list(keys), buckets)


def replace_load_jdbc(df: DataFrame, url: str, table: str, *, properties: Mapping[str, str] | None = None,
                      batch_size: int = 10_000, connections: int | None = None) -> None:
    """IO7 into an external database, with the types of ``external_types``.

    Every partition of ``df`` writes over a connection of its own, unless
    ``connections`` says how many the database can take.
    """
    typed, types = external_types(df)
    options = dict(properties or {}) | {"createTableColumnTypes": types, "url": url, "dbtable": table, "batchsize": str(batch_size)}
    if connections is not None:
        options["numPartitions"] = str(connections)
    typed.write.format("jdbc").mode("overwrite").options(**options).save()


def external_types(df: DataFrame) -> tuple[DataFrame, str]:
    """``df`` as an external table takes it, and the types of its columns.

    Integers keep their size, floats and doubles theirs, booleans become the
    smallest integer, and text is as wide as IO8's profile says.
    """
    kinds = {T.ByteType: "TINYINT", T.ShortType: "SMALLINT", T.IntegerType: "INT", T.LongType: "BIGINT", T.FloatType: "FLOAT", T.DoubleType: "DOUBLE",
             T.BooleanType: "TINYINT"}
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    widths = {row["column"]: max(row["width"] or 1, 1) for row in column_widths(df, texts).collect()}
    types = [f"`{f.name.replace('`', '``')}` " + (f"VARCHAR({widths[f.name]})" if f.name in widths else kinds.get(type(f.dataType), f.dataType.simpleString().upper()))
             for f in df.schema.fields]
    whole = {f.name: named(f.name).cast("tinyint") for f in df.schema.fields if isinstance(f.dataType, T.BooleanType)}
    return df.select(*[whole.get(name, named(name)).alias(name) for name in df.columns]), ", ".join(types)


def column_widths(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """IO8: ``(column, width)``, the greatest text length per column, in one pass."""
    names = list(df.columns if columns is None else columns)
    if not names:
        return df.sparkSession.createDataFrame([], "column string, width int")
    widths = df.agg(*[F.max(F.length(named(name).cast("string"))).alias(f"w{i}") for i, name in enumerate(names)])
    pairs = F.array(*[F.struct(F.lit(name).alias("column"), F.col(f"w{i}").alias("width")) for i, name in enumerate(names)])
    return widths.select(F.inline(pairs))


def save_scores(scored: DataFrame, path: str, *, id_column: str, pred_column: str = "pred", table: str | None = None,
                buckets: int | None = None, parts: int | None = None) -> DataFrame:
    """IO9: id and probability as CSV, and upserted into ``table`` when one is named.

    The scores are kept in the shared folder first and returned from there, so
    the model runs once however many sinks and readers there are.
    """
    kept = materialise(scored.select(named(id_column), named(pred_column)), "scored")
    kept.write.mode("overwrite").csv(path, header=True)
    if table is not None:
        upsert(kept, table, [id_column], buckets=buckets, parts=parts)
    return kept
