"""Feature tables made from the given tables: A, customer churn, and B, document quality.

The SQL runs unchanged in Spark and DuckDB, so each query and its oracle start
from the same text.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession

from lift.operators.registry import registry_from
from lift.sources.shared import shared_folder

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages",
          "benchmark", "labels", "conversations")

CUT = "timestamp '2001-01-01 00:00:00'"

VIEWS: dict[str, str] = {
    "a_train": f"""
        select c.c_custkey as client_id, cast(case when l.k is null then 1 else 0 end as int) as target
        from customer c
        left join (select distinct o_custkey as k from orders where o_orderdate >= {CUT}) l on l.k = c.c_custkey""",
    "a_spender": f"""
        select o_custkey as client_id, cast(case when sum(cast(o_totalprice as decimal(18,2))) > 2000000 then 1 else 0 end as int) as target
        from orders where o_orderdate < {CUT} group by o_custkey""",
    "a_set1": f"""
        select o_custkey as client_id, count(*) as set1_order_cnt,
               cast(sum(cast(o_totalprice as decimal(18,2))) as double) as set1_order_sum,
               min(o_totalprice) as set1_order_min, max(o_totalprice) as set1_order_max,
               cast(year(max(o_orderdate)) as int) as set1_last_year
        from orders where o_orderdate < {CUT} group by o_custkey""",
    "a_set2": f"""
        select o_custkey as client_id,
               max(case when o_orderpriority = '1-URGENT' then 1 else 0 end) as set2_urgent,
               max(case when o_orderstatus = 'F' then 1 else 0 end) as set2_has_f,
               max(case when o_orderstatus = 'P' then 1 else 0 end) as set2_has_p
        from orders where o_orderdate < {CUT} group by o_custkey""",
    "a_set3": """
        select user_id as client_id, count(*) as set3_event_cnt, min(value) as set3_value_min, max(value) as set3_value_max,
               count(case when event_type = 'click' then 1 end) as set3_clicks
        from events group by user_id""",
    "a_set4": f"""
        select o.o_custkey as client_id, count(*) as set4_line_cnt, cast(sum(cast(l.l_quantity as bigint)) as bigint) as set4_qty,
               max(l.l_discount) as set4_max_discount, count(case when l.l_returnflag = 'R' then 1 end) as set4_returns
        from orders o join lineitem l on l.l_orderkey = o.o_orderkey
        where o.o_orderdate < {CUT} group by o.o_custkey""",
    "a_set5": """
        select c_custkey as client_id, c_mktsegment as set5_segment, c_nationkey as set5_nation, c_acctbal as set5_balance,
               c_acctbal * 2 + 1 as set5_balance_copy, -c_acctbal as set5_balance_neg, 1 as set5_const
        from customer""",
    "b_train": "select doc_id, quality as target from labels",
    "b_text": """
        select doc_id, lang, source, n_chars, cast(length(text) - length(replace(text, ' ', '')) + 1 as bigint) as n_words
        from documents""",
    "b_lang": "select doc_id, case when lang <= 'en' then 1 else 0 end as target from documents",
    "b_emb": "select vec_id as doc_id, label as emb_label from embeddings",
    "b_score": """
        select l.doc_id, l.quality as y, (d.n_chars * 37 % 1000) / 1e3 as pred
        from labels l join documents d on d.doc_id = l.doc_id""",
}

SETS_A = (
    {"name": "set1", "class": "main", "type": "numerical", "source": "a_set1",
     "features": ["set1_order_cnt", "set1_order_sum", "set1_order_min", "set1_order_max", "set1_last_year"]},
    {"name": "set2", "class": "extra", "type": "binary", "source": "a_set2", "features": ["set2_urgent", "set2_has_f", "set2_has_p"]},
    {"name": "set3", "class": "extra", "type": "numerical", "source": "a_set3",
     "features": ["set3_event_cnt", "set3_value_min", "set3_value_max", "set3_clicks"]},
    {"name": "set4", "class": "main", "type": "numerical", "source": "a_set4",
     "features": ["set4_line_cnt", "set4_qty", "set4_max_discount", "set4_returns"]},
    {"name": "set5", "class": "main", "type": "mixed", "source": "a_set5",
     "features": ["set5_segment", "set5_nation", "set5_balance", "set5_balance_copy", "set5_balance_neg", "set5_const"]},
)
SETS_B = (
    {"name": "text", "class": "main", "type": "mixed", "source": "b_text", "features": ["lang", "source", "n_chars", "n_words"]},
    {"name": "emb", "class": "extra", "type": "numerical", "source": "b_emb", "features": ["emb_label"]},
)
FEATURES_A = [name for one in SETS_A for name in one["features"]]
FEATURES_B = [name for one in SETS_B for name in one["features"]]
TEXT_A = ["set5_segment"]
NUMERIC_A = [name for name in FEATURES_A if name not in TEXT_A]


class Fixture(Mapping[str, DataFrame]):
    """The given tables of one folder and the views above, by name."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder
        self._read: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name in TABLES:
            if name not in self._read:
                self._read[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
            return self._read[name]
        sql = re.sub(r"\b(from|join) (\w+)\b", r"\1 {\2}", VIEWS[name])
        used = {table: self[table] for table in re.findall(r"\{(\w+)\}", sql)}
        return self.spark.sql(sql, **used)

    def __iter__(self):
        return iter((*TABLES, *VIEWS))

    def __len__(self) -> int:
        return len(TABLES) + len(VIEWS)

    def scratch_table(self, stem: str) -> str:
        """A new table name, in a database kept in the shared folder."""
        self.spark.sql(f"create database if not exists lift_scratch location '{shared_folder(self.spark)}/lift/scratch.db'")
        return f"lift_scratch.{stem}_{uuid.uuid4().hex[:12]}"

    def scratch_view(self, name: str) -> str:
        """One of the tables or views under a name that SQL can use."""
        view = f"lift_{name}_{uuid.uuid4().hex[:12]}"
        self[name].createOrReplaceTempView(view)
        return view

    def registry_a(self) -> DataFrame:
        return registry_from(self.spark, SETS_A)

    def registry_b(self) -> DataFrame:
        return registry_from(self.spark, SETS_B)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function of a fixture as a query, with its SQL when SQL can express it."""

    def add(run: Callable[[Fixture], DataFrame]) -> Callable[[Fixture], DataFrame]:
        QUERIES[run.__name__] = lambda spark, folder: run(Fixture(spark, folder))
        if sql is not None:
            ORACLES[run.__name__] = sql
        return run

    return add


def with_views(body: str, *names: str, extra: Mapping[str, str] | None = None) -> str:
    """``body`` behind common table expressions for the named views and any extra ones."""
    parts = {name: VIEWS[name] for name in names} | dict(extra or {})
    return "with " + ",\n".join(f"{name} as ({sql})" for name, sql in parts.items()) + "\n" + body


A_VIEWS = ("a_train", "a_set1", "a_set2", "a_set3", "a_set4", "a_set5")
B_VIEWS = ("b_train", "b_text", "b_emb")
SPENDERS = "select p.client_id, p.target, " + ", ".join(FEATURES_A) + " from a_spender p join wide on wide.client_id = p.client_id"
WIDE_A = "select t.client_id, t.target, " + ", ".join(FEATURES_A) + " from a_train t " + " ".join(
    f"left join {one['source']} on {one['source']}.client_id = t.client_id" for one in SETS_A)
WIDE_B = "select t.doc_id, t.target, " + ", ".join(FEATURES_B) + " from b_train t " + " ".join(
    f"left join {one['source']} on {one['source']}.doc_id = t.doc_id" for one in SETS_B)


def over_a(body: str, **extra: str) -> str:
    return with_views(body, *A_VIEWS, extra={"wide": WIDE_A} | extra)


def over_b(body: str, **extra: str) -> str:
    return with_views(body, *B_VIEWS, extra={"wide": WIDE_B} | extra)
