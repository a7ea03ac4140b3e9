"""Secrets in texts, and what their ownership across the corpus says about them.

Patterns find candidates; the value of every candidate is hashed, and the hashes
are counted by distinct repositories and distinct owners over the whole corpus. A
value that many owners have, or that lies in very many repositories, is a copied
example; one that few owners have in few places and that looks random is live. Beside the named patterns, long mixed tokens are
candidates too, and are reported only if the counts say that they are live.

Everything is DataFrame and SQL functions. Spark has no function for the places
of all matches, so they are sums of the lengths of matches and of what
``split`` leaves between them.

Defined results: a null or empty text has no spans; repeated rows get one
result row each and count once as an owner; a null repository or owner is one
of its own; an empty table gives an empty result; other columns are not looked
at. Places count code points.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lift.functions.columns import named
from lift.sources.shared import materialise

#: Patterns that the results are defined by (fixed values).
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{32,}"
KINDS = ("assign", "access", "hex")
#: Further candidates: a long token of letters and digits.
TOKEN = r"[A-Za-z0-9+/_-]{20,}"
#: Words of placeholders.
PLACEHOLDER = r"(?i)example|changeme|placeholder|dummy|sample|your_|xxxx|0000|1234567"
STEP = 256


def matches(text: Column, pattern: str) -> Column:
    """All leftmost matches in order: ``array<struct<start, end, value>>``.

    The places are running sums; they are taken in blocks, so that a text with
    very many matches does not copy a growing array for each of them.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    parts = F.transform(F.arrays_zip(F.split(text, pattern, -1).alias("gap"), found.alias("value")),
                        lambda x: F.struct(F.char_length(x["gap"]).alias("gap"), F.char_length(x["value"]).alias("size"), x["value"].alias("value")))
    none = F.array().cast("array<struct<start:int,end:int,value:string>>")
    whole = lambda p: F.filter(p, lambda x: x["value"].isNotNull())  # noqa: E731  the last gap has no match behind it

    def placed(offset: Column, block: Column) -> Column:
        return F.aggregate(
            block, F.struct(offset.alias("at"), none.alias("items")),
            lambda acc, x: F.struct(
                (acc["at"] + x["gap"] + x["size"]).alias("at"),
                F.concat(acc["items"], F.array(F.struct((acc["at"] + x["gap"]).alias("start"), (acc["at"] + x["gap"] + x["size"]).alias("end"),
                                                        x["value"].alias("value")))).alias("items")),
            lambda acc: acc["items"])

    def in_blocks(p: Column) -> Column:
        blocks = F.transform(F.sequence(F.lit(1), F.size(p), F.lit(STEP)), lambda at: F.slice(p, at, STEP))
        sizes = F.transform(blocks, lambda b: F.aggregate(b, F.lit(0), lambda s, x: s + x["gap"] + x["size"]))
        offsets = F.aggregate(sizes, F.array(F.lit(0)), lambda acc, n: F.concat(acc, F.array(F.element_at(acc, -1) + n)))
        return F.flatten(F.zip_with(F.slice(offsets, 1, F.size(blocks)), blocks, placed))

    return F.when(F.size(found) == 0, none).when(F.size(found) <= STEP, placed(F.lit(0), whole(parts))).otherwise(in_blocks(whole(parts)))


def as_spans(found: Column, kind: str, order: int, secret: str | None = None) -> Column:
    """Matches as ``array<struct<start, place, kind, end, value>>``, which sort by start and then kind."""
    value = (lambda x: F.regexp_extract(x["value"], secret, 1)) if secret else (lambda x: x["value"])
    return F.transform(found, lambda x: F.struct(
        x["start"].alias("start"), F.lit(order).alias("place"), F.lit(kind).alias("kind"), x["end"].alias("end"), value(x).alias("value")))


def hashed(spans: Column) -> Column:
    """Spans with the hash of their value, and whether the value looks random, in place of the value."""
    varied = lambda v: F.size(F.array_distinct(F.split(v, ""))) >= F.least(F.lit(8), F.char_length(v) / 2)
    return F.transform(spans, lambda x: F.struct(
        x["start"].alias("start"), x["place"].alias("place"), x["kind"].alias("kind"), x["end"].alias("end"), F.sha2(x["value"], 256).alias("hash"),
        (varied(x["value"]) & ~x["value"].rlike(PLACEHOLDER)).alias("random")))


def candidates(df: DataFrame, id_col: str, text_col: str, repo_col: str, owner_col: str) -> DataFrame:
    """``(id, digest, repo, owner, base, more)``: base spans and further candidates of every row."""
    text = F.coalesce(named(text_col), F.lit(""))
    lists = df.select(
        named(id_col).alias("id"), F.xxhash64(text).alias("digest"), named(repo_col).cast("string").alias("repo"), named(owner_col).cast("string").alias("owner"),
        F.filter(as_spans(matches(text, ASSIGN), "assign", 0, ASSIGN), lambda x: F.char_length(x["value"]) >= 8).alias("assign"),
        F.filter(as_spans(F.when(text.contains("AKIA"), matches(text, ACCESS)).otherwise(F.array()), "access", 1),
                 lambda x: F.char_length(x["value"]) >= 16).alias("access"),
        as_spans(matches(text, HEX), "hex", 2).alias("hex"),
        F.filter(as_spans(matches(text, TOKEN), "token", 3), lambda x: x["value"].rlike("[0-9]") & x["value"].rlike("[A-Za-z]")).alias("token"))
    base = F.array_sort(F.concat("assign", "access", "hex"))
    return lists.select("id", "digest", "repo", "owner", hashed(base).alias("base"), F.size("assign").cast("long").alias("n_assign"),
                        F.size("access").cast("long").alias("n_access"), F.size("hex").cast("long").alias("n_hex"), hashed(F.col("token")).alias("token")).withColumn(
        "more", F.filter("token", lambda t: ~F.exists("base", lambda b: (b["start"] < t["end"]) & (t["start"] < b["end"])))).drop("token")


def ownership(spans: DataFrame, max_owners: int, max_repos: int) -> DataFrame:
    """``(hash, n_repos, n_owners, live)`` for every candidate value of the corpus."""
    seen = spans.groupBy("hash", F.coalesce("owner", F.lit("")).alias("owner"), F.coalesce("repo", F.lit("")).alias("repo")).agg(
        F.max("random").alias("random"))
    by_owner = seen.groupBy("hash", "owner").agg(F.count(F.lit(1)).alias("repos"), F.max("random").alias("random"))
    # a repository has one owner; the same name under two owners is two repositories
    per_value = by_owner.groupBy("hash").agg(F.sum("repos").alias("n_repos"), F.count(F.lit(1)).alias("n_owners"), F.max("random").alias("random"))
    few = (F.col("n_owners") <= max_owners) & (F.col("n_repos") <= max_repos)
    return per_value.select("hash", "n_repos", "n_owners", (few & F.col("random")).alias("live"))


def joined(spans: Column) -> Column:
    """``kind:start:end`` of all spans, joined by commas."""
    return F.concat_ws(",", F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])))


def scan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", repo_col: str = "doc_id", owner_col: str = "source",
         max_owners: int = 2, max_repos: int = 500) -> DataFrame:
    """One row per row of ``df``: ``(id, digest, n_assign, n_access, n_hex, base, found)``.

    ``base`` holds the spans of the patterns, ``found`` all spans with what the
    corpus says: ``n_repos``, ``n_owners``, ``live``. Tokens are in it only if live:
    in at most ``max_repos`` repositories of at most ``max_owners`` owners.
    ``digest`` is a hash of the text, which tells rows of one id apart.
    """
    rows = materialise(candidates(df, id_col, text_col, repo_col, owner_col), "secret-candidates")
    some = rows.where((F.size("base") > 0) | (F.size("more") > 0))
    spans = some.select("id", "digest", "repo", "owner", F.explode(F.concat("base", "more")).alias("span")).select(
        "id", "digest", "repo", "owner", "span", "span.hash", "span.random")
    verdicts = ownership(spans, max_owners, max_repos)
    judged = spans.select("id", "digest", "span", "hash").distinct().join(verdicts, "hash").where((F.col("span.kind") != "token") | F.col("live"))
    entry = F.struct("span.start", "span.place", "span.kind", "span.end", "n_repos", "n_owners", "live")
    per_row = judged.groupBy("id", "digest").agg(F.array_sort(F.collect_list(entry)).alias("found"))
    right = per_row.select(F.col("id").alias("r_id"), F.col("digest").alias("r_digest"), "found")
    result = some.join(right, F.col("id").eqNullSafe(F.col("r_id")) & (F.col("digest") == F.col("r_digest")), "left")
    columns = ["id", "digest", "n_assign", "n_access", "n_hex", "base"]
    none = F.array().cast(right.schema["found"].dataType)
    without = rows.where((F.size("base") == 0) & (F.size("more") == 0)).select(*columns, none.alias("found"))
    return result.select(*columns, F.coalesce("found", none).alias("found")).unionByName(without)


def secret_digests(df: DataFrame) -> DataFrame:
    """The digest columns of every document."""
    live = F.size(F.filter("found", lambda x: x["live"])).cast("long")
    return scan(df).select(
        F.col("id").alias("doc_id"), "n_assign", "n_access", "n_hex", F.sha2(joined(F.col("base")), 256).alias("base_sha256"),
        joined(F.col("found")).alias("spans"), live.alias("n_live"), (F.size("found") - live).cast("long").alias("n_example"))


def redact(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", repo_col: str = "doc_id", owner_col: str = "source",
           size_col: str | None = "n_chars", mask: str = "[secret]") -> DataFrame:
    """``df`` with every live span of its text replaced by ``mask``; copied examples stay.

    Rows without a live secret come through as they are. ``size_col``, if there,
    is set to the length of a text that was changed.
    """
    live = scan(df, id_col, text_col, repo_col, owner_col).select(
        F.col("id").alias("__lift_id"), F.col("digest").alias("__lift_digest"), F.filter("found", lambda x: x["live"]).alias("__lift_spans"))
    live = live.where(F.size("__lift_spans") > 0).dropDuplicates(["__lift_id", "__lift_digest"])
    text = F.coalesce(named(text_col), F.lit(""))
    rows = df.join(live, named(id_col).eqNullSafe(F.col("__lift_id")) & (F.xxhash64(text) == F.col("__lift_digest")), "left")
    # whole text left of each span that starts behind all before it, then the mask
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("parts"))
    built = F.aggregate(
        F.col("__lift_spans"), start,
        lambda acc, x: F.struct(
            F.greatest(acc["at"], x["end"]).alias("at"),
            F.when(x["start"] < acc["at"], acc["parts"]).otherwise(
                F.concat(acc["parts"], F.array(F.substr(text, acc["at"] + 1, x["start"] - acc["at"]), F.lit(mask)))).alias("parts")),
        lambda acc: F.concat(F.array_join(acc["parts"], ""), F.substr(text, acc["at"] + 1)))
    rows = rows.withColumn("__lift_text", F.when(F.col("__lift_spans").isNull(), named(text_col)).otherwise(built))
    changed = {text_col: F.col("__lift_text")}
    if size_col in df.columns:
        changed[size_col] = F.when(F.col("__lift_spans").isNull(), named(size_col)).otherwise(
            F.char_length("__lift_text")).cast(df.schema[size_col].dataType)
    return rows.select(*[changed.get(name, named(name)).alias(name) for name in df.columns])
