"""The registered queries of these operators, with production parameters over whole tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lift.llm.decontaminate import contaminated
from lift.llm.langid import predicted_languages
from lift.llm.licenses import license_notices
from lift.llm.negatives import hard_negatives
from lift.llm.pieces import token_digests
from lift.llm.pii import pii_digests
from lift.llm.secret_scan import secret_digests
from lift.llm.shards import sharded_documents
from lift.llm.simhash import near_copies
from lift.llm.topk import top_k
from lift.llm.toxicity import toxicity_scores
from lift.llm.trie import shared_conversations
from lift.llm.warc import archived_pages

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def vocabulary() -> str:
    """The piece vocabulary's file, which is installed on every machine."""
    return public_tokenizers.path("piece_bpe_32k.model")


def query(run: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[run.__name__] = run
    return run


@query
def op4_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    return token_digests(table(spark, folder, "documents"), vocabulary())


@query
def op8_simhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_copies(table(spark, folder, "documents"), words=3, max_bits=2).select(
        "doc_id", "fingerprint", F.col("component_id"))


@query
def op10_secret_scans(spark: SparkSession, folder: str) -> DataFrame:
    return secret_digests(table(spark, folder, "documents"))


@query
def op9_pii(spark: SparkSession, folder: str) -> DataFrame:
    return pii_digests(table(spark, folder, "documents"))


@query
def op1_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity_scores(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query
def op7_language_id(spark: SparkSession, folder: str) -> DataFrame:
    return predicted_languages(table(spark, folder, "documents"))


@query
def op5_exact_top_k(spark: SparkSession, folder: str) -> DataFrame:
    return top_k(table(spark, folder, "embeddings"), F.col("id") % 20 == 0)


ORACLES["op5_exact_top_k"] = """
with v as (
    select vec_id, list_transform(embedding, lambda x: cast(floor(64 * cast(x as double)) as bigint)) as q
    from embeddings
    where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), p as (
    select a.vec_id as query_id, b.vec_id, cast(list_dot_product(cast(a.q as double[]), cast(b.q as double[])) as bigint) as score
    from v a join v b on a.vec_id <> b.vec_id
    where a.vec_id % 20 = 0 and len(a.q) = len(b.q)
), r as (
    select query_id, row_number() over (partition by query_id order by score desc, vec_id) as rank, vec_id, score from p
)
select query_id, cast(rank as integer) as rank, vec_id, score from r where rank <= 20"""


@query
def op3_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select(F.col("id").alias("doc_id"), F.col("item").alias("item_id"), "edits", "item_words", "start_word", "end_word")


@query
def op6_warc(spark: SparkSession, folder: str) -> DataFrame:
    return archived_pages(table(spark, folder, "pages"))


#: Four letters of base 32 for every five hexadecimal digits.
BASE32 = " || ".join(
    f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', cast((cast('0x' || substr(sha, {5 * k + 1}, 5) as bigint) // {32 ** (3 - j)}) % 32 as integer) + 1, 1)"
    for k in range(8) for j in range(4))
ORACLES["op6_warc"] = f"""
with p as (
    select page_id, coalesce(html, '') as html, sha1(coalesce(html, '')) as sha from pages
), f as (
    select *, min(page_id) over (partition by sha) as first from p
)
select page_id, cast(strlen(html) as bigint) as payload_bytes, {BASE32} as payload_digest,
       case when page_id = first then 'response' else 'revisit' end as record_type,
       case when page_id <> first then first end as refers_to
from f"""


@query
def op2_license_scans(spark: SparkSession, folder: str) -> DataFrame:
    return license_notices(table(spark, folder, "documents"))


@query
def op11_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return shared_conversations(table(spark, folder, "conversations"))


ORACLES["op11_prefix_trie"] = """
with turns as (
    select conv_id as c, row_number() over (partition by conv_id order by turn nulls first, coalesce(role, ''), coalesce(text, '')) as pos,
           coalesce(role, '') as role, coalesce(text, '') as text
    from conversations where conv_id is not null
), sizes as (
    select c, max(pos) as n,
           xor(list_reduce([4294967295] || list_transform(string_split(cast(c as varchar), ''), lambda x: cast(ascii(x) as bigint)),
               lambda crc, byte: list_reduce([xor(crc, byte)] || [0, 0, 0, 0, 0, 0, 0, 0], lambda r, i: xor(r >> 1, (r & 1) * 3988292384))), 4294967295) % 9 as h
    from turns group by c
), made as (
    select s.c, pos - h + least(h, coalesce((select n from sizes b where b.c = s.c - s.c % 5), 0)) as depth, role, text
    from turns join sizes s using (c) where pos > h
    union all
    select s.c, pos, role, text from sizes s join turns t on t.c = s.c - s.c % 5 where pos <= h
), whole as (
    select sizes.c, coalesce(list({'role': role, 'text': text} order by depth) filter (where depth is not null), []) as turns from sizes left join made using (c) group by sizes.c
), prefixes as (
    select c, d, turns[1:d] as prefix, len(turns) as n from whole, lateral (select unnest(range(0, len(turns) + 1)) as d)
), nodes as (
    select prefix, d, min(c) as conv_id, count(*) as n_convs, coalesce(strlen(prefix[d].text), 0) as bytes,
           sha256(coalesce(string_agg(cast(c as varchar), ',' order by c) filter (where n = d), '')) as ends_sha256
    from prefixes group by prefix, d
), ways as (
    select c, d, nodes.conv_id as node from prefixes join nodes using (prefix, d)
), tree as (
    select nodes.*, up.node as parent from nodes left join ways up on up.c = nodes.conv_id and up.d = nodes.d - 1
), children as (
    select parent, d - 1 as d, count(*) as n from tree where parent is not null group by all
), known as (
    select tree.*, coalesce(children.n, 0) as n_children from tree left join children on children.parent = tree.conv_id and children.d = tree.d
), totals as (
    select ways.node, ways.d, count(case when n_children = 0 then 1 end) as n_leaves, cast(sum((n_convs - 1) * bytes) as bigint) as saved_tokens
    from known join ways on ways.c = known.conv_id and ways.d <= known.d group by all
)
select conv_id, cast(known.d as bigint) as depth, parent as parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256
from known join totals on totals.node = known.conv_id and totals.d = known.d"""


@query
def op12_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return sharded_documents(table(spark, folder, "documents"))


@query
def op13_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(rows.withColumn("label", label), F.col("id") % 50 == 0)


ORACLES["op13_hard_negatives"] = """
with r as (
    select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
           list_transform(embedding, lambda x: floor(256 * cast(x as double))) as q
    from embeddings
    where vec_id is not null and label is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), p as (
    select a.vec_id as anchor_id, b.vec_id, a.label = b.label as same, cast(list_dot_product(a.q, b.q) as bigint) as score
    from r a join r b on a.vec_id <> b.vec_id
    where a.vec_id % 50 = 0 and len(a.q) = len(b.q)
), pos as (
    select anchor_id, vec_id as positive_id, score as positive_score from p where same
    qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5
), neg as (
    select anchor_id, positive_id, row_number() over (partition by anchor_id, positive_id order by score desc, vec_id) as rank,
           vec_id as negative_id, positive_score, score as negative_score
    from pos join p using (anchor_id)
    where not same and 50 * positive_score <= 100 * score and 100 * score <= 95 * positive_score
)
select anchor_id, positive_id, cast(rank as integer) as rank, negative_id, positive_score, negative_score from neg where rank <= 3"""
