"""IO1-IO9: loading, SQL access and sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalogue.fixtures import Fixture, query, with_views
from lift.sources import tables
from lift.sources.shared import fresh_path


def _orders_csv(fx: Fixture, part: str, condition: str) -> str:
    """Orders as CSV, one line each, the file order being date and key."""
    path = fresh_path(fx.spark, f"orders-{part}")
    orders = fx["orders"].where(condition).select(
        "o_custkey", "o_orderkey", "o_totalprice", "o_orderstatus", F.col("o_orderdate").cast("date").cast("string").alias("o_day"))
    orders.orderBy("o_day", "o_orderkey").write.csv(path, header=True)
    return path


@query("""
    select o_custkey, o_orderkey, o_totalprice, o_orderstatus, o_day from (
        select o_custkey, o_orderkey, o_totalprice, o_orderstatus, cast(cast(o_orderdate as date) as varchar) as o_day,
               row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey desc) as place
        from orders) where place = 1""")
def csv_upsert_last_wins(fx: Fixture) -> DataFrame:
    table = fx.scratch_table("orders")
    for part, condition in (("early", "o_orderdate < timestamp_ntz '1998-01-01 00:00:00'"), ("late", "o_orderdate >= timestamp_ntz '1998-01-01 00:00:00'")):
        tables.load_csv(fx.spark, _orders_csv(fx, part, condition), table, "o_custkey")
    return fx.spark.table(table)


@query("""
    with loads as (
        select o_custkey, o_orderkey, o_totalprice, o_orderstatus, cast(cast(o_orderdate as date) as varchar) as o_day, o_orderdate,
               case when o_custkey % 5 <> 0 and o_orderdate < timestamp '1998-01-01 00:00:00' then 1
                    when o_orderdate < timestamp '1998-01-01 00:00:00' then 2 else 3 end as load
        from orders)
    select o_custkey, o_orderkey, o_totalprice, o_orderstatus, o_day from (
        select *, row_number() over (partition by o_custkey order by load desc, o_orderdate desc, o_orderkey desc) as place from loads) where place = 1""")
def csv_upsert_parts(fx: Fixture) -> DataFrame:
    """Three loads into a table of eight parts, of which each load rewrites the ones it meets."""
    table, early = fx.scratch_table("orders"), "o_orderdate < timestamp_ntz '1998-01-01 00:00:00'"
    for part, condition in (("most", f"o_custkey % 5 <> 0 and {early}"), ("fifth", f"o_custkey % 5 = 0 and {early}"), ("late", f"not ({early})")):
        tables.load_csv(fx.spark, _orders_csv(fx, part, condition), table, "o_custkey", parts=8)
    return tables.keyed_table(fx.spark, table)


@query("""
    select * from (values (0, 'o_custkey', 'bigint'), (1, 'o_orderkey', 'bigint'), (2, 'o_totalprice', 'double'),
                          (3, 'o_orderstatus', 'string'), (4, 'o_day', 'string')) as t(pos, name, type)
    cross join (select count(*) as n_rows from orders)""")
def csv_inferred_types(fx: Fixture) -> DataFrame:
    path = _orders_csv(fx, "all", "true")
    schema = tables.infer_csv_schema(fx.spark, path)
    rows = tables.read_csv_in_order(fx.spark, path, schema)
    pairs = F.array(*[F.struct(F.lit(i).alias("pos"), F.lit(f.name).alias("name"), F.lit(f.dataType.simpleString()).alias("type"))
                      for i, f in enumerate(schema.fields)])
    return rows.agg(F.count("*").alias("n_rows")).select("n_rows", F.inline(pairs))


_SEGMENTS = """
    select c_mktsegment, count(*) as n_orders, cast(sum(cast(o_totalprice as decimal(18,2))) as double) as total
    from {customer} join {orders} on o_custkey = c_custkey group by c_mktsegment"""


def _views(fx: Fixture) -> dict[str, str]:
    return {name: fx.scratch_view(name) for name in ("customer", "orders")}


@query(_SEGMENTS.format(customer="customer", orders="orders"))
def sql_read(fx: Fixture) -> DataFrame:
    return tables.read_sql(fx.spark, _SEGMENTS.format(**_views(fx)))


@query(_SEGMENTS.format(customer="customer", orders="orders"))
def sql_ctas_readback(fx: Fixture) -> DataFrame:
    table = fx.scratch_table("segments")
    tables.execute(fx.spark, f"create table {table} using parquet as {_SEGMENTS.format(**_views(fx))}")
    return tables.read_sql(fx.spark, f"select * from {table}")


@query("select o_orderkey, o_custkey, o_orderstatus, o_totalprice from orders")
def rename_lower(fx: Fixture) -> DataFrame:
    shouted = fx["orders"].select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    return tables.lower_names(shouted.toDF(*[name.upper() for name in shouted.columns]))


@query("select o_orderkey, o_custkey, o_orderstatus, o_totalprice from orders")
def rename_strip_prefix(fx: Fixture) -> DataFrame:
    view = fx.scratch_view("orders")
    columns = ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    return tables.read_warehouse(fx.spark, f"select {', '.join(f'{c} as `t.{c}`' for c in columns)} from {view}")


@query("select l_returnflag, l_linestatus, l_quantity, count(*) as n from lineitem group by all")
def replace_load_multiset(fx: Fixture) -> DataFrame:
    table = fx.scratch_table("lines")
    lines = fx["lineitem"].select("l_returnflag", "l_linestatus", "l_quantity")
    for _ in range(2):
        tables.replace_load(lines, table)
    return fx.spark.table(table).groupBy("l_returnflag", "l_linestatus", "l_quantity").agg(F.count("*").alias("n"))


@query("""
    select 'doc_id' as "column", cast(max(length(cast(doc_id as varchar))) as int) as width from documents
    union all select 'text', cast(max(length(text)) as int) from documents
    union all select 'lang', cast(max(length(lang)) as int) from documents
    union all select 'source', cast(max(length(source)) as int) from documents
    union all select 'n_chars', cast(max(length(cast(n_chars as varchar))) as int) from documents""")
def column_width_profile(fx: Fixture) -> DataFrame:
    return tables.column_widths(fx["documents"])


@query(with_views("""
    select 'csv' as sink, doc_id, pred from b_score union all select 'table', doc_id, pred from b_score""", "b_score"))
def score_sink_roundtrip(fx: Fixture) -> DataFrame:
    path, table = fresh_path(fx.spark, "scores-csv"), fx.scratch_table("scores")
    scored = fx["b_score"]
    for _ in range(2):  # the second run replaces the first
        tables.save_scores(scored, path, id_column="doc_id", table=table)
    back = fx.spark.read.csv(path, header=True, schema="doc_id bigint, pred double")
    return back.select(F.lit("csv").alias("sink"), "*").unionByName(fx.spark.table(table).select(F.lit("table").alias("sink"), "*"))
