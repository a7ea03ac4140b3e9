"""AG1-AG8, PF3, SE4, EN1-EN4: profiles, eliminations, fills and codes."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalogue.fixtures import FEATURES_A, FEATURES_B, NUMERIC_A, Fixture, over_a, over_b, query
from lift.operators import assemble, encode, profile
from lift.sources.shared import materialise

MISSING, DOMINANT, COLLINEAR = 0.85, 0.9, 0.9


def wide_a(fx: Fixture) -> DataFrame:
    return assemble.load_features(fx["a_train"], fx.registry_a(), fx, "client_id", "target")[0]


def kept_a(fx: Fixture) -> DataFrame:
    """The wide table as the plans keep it, for operators that read it more than once."""
    return materialise(wide_a(fx), "wide")


def wide_b(fx: Fixture) -> DataFrame:
    return assemble.load_features(fx["b_train"], fx.registry_b(), fx, "doc_id", "target")[0]


def _missing_sql(features: list[str]) -> str:
    return " union all ".join(f"select '{f}' as feature, round((count(*) - count({f})) * 1e0 / count(*), 8) as missing_share from wide" for f in features)


def _dominant_sql(features: list[str]) -> str:
    return " union all ".join(
        f"select '{f}' as feature, round(coalesce(max(n), 0) * 1e0 / (select count(*) from wide), 8) as dominant_share "
        f"from (select count(*) as n from wide where {f} is not null group by {f})" for f in features)


def _corr_sql(features: list[str]) -> str:
    place = {f: i for i, f in enumerate(features)}
    return " union all ".join(
        f"select {place[a]} as pos_i, {place[b]} as pos_j, '{a}' as feature_i, '{b}' as feature_j, "
        f"(select case when isnan(c) or isinf(c) then null else c end from (select corr({a}, {b}) as c from "
        f"(select {a}, {b} from wide where {a} is not null and {b} is not null))) as corr" for a, b in combinations(features, 2))


@query(over_a(_missing_sql(FEATURES_A)))
def missing_share(fx: Fixture) -> DataFrame:
    return profile.missing_share(wide_a(fx), FEATURES_A).select("feature", F.round("missing_share", 8).alias("missing_share"))


@query(over_b(_missing_sql(FEATURES_B)))
def missing_share_documents(fx: Fixture) -> DataFrame:
    return profile.missing_share(wide_b(fx), FEATURES_B).select("feature", F.round("missing_share", 8).alias("missing_share"))


@query(over_a(_dominant_sql(FEATURES_A)))
def dominant_share(fx: Fixture) -> DataFrame:
    return profile.dominant_share(wide_a(fx), FEATURES_A).select("feature", F.round("dominant_share", 8).alias("dominant_share"))


@query(over_b(_dominant_sql(FEATURES_B)))
def dominant_share_documents(fx: Fixture) -> DataFrame:
    return profile.dominant_share(wide_b(fx), FEATURES_B).select("feature", F.round("dominant_share", 8).alias("dominant_share"))


@query(over_a("select * from shares where dominant_share > 0.3e0", shares=_dominant_sql(FEATURES_A)))
def dominant_flags(fx: Fixture) -> DataFrame:
    return profile.dominant_above(kept_a(fx), FEATURES_A, 0.3).select("feature", F.round("dominant_share", 8).alias("dominant_share"))


@query(over_a("select pos_i, pos_j, feature_i, feature_j, round(corr, 8) as corr from pairs", pairs=_corr_sql(NUMERIC_A)))
def correlation_pairs(fx: Fixture) -> DataFrame:
    return profile.correlation(kept_a(fx), NUMERIC_A).withColumn("corr", F.round("corr", 8))


@query(over_a("select feature_j as feature, round(max(corr), 8) as corr from pairs where corr > 0.9e0 group by feature_j", pairs=_corr_sql(NUMERIC_A)))
def collinear_flags(fx: Fixture) -> DataFrame:
    return profile.collinear(kept_a(fx), FEATURES_A, COLLINEAR).select("feature", F.round("corr", 8).alias("corr"))


def record_sql(missing: float, dominant: float, above: float) -> dict[str, str]:
    """The elimination record over ``wide``, and the expressions it rests on."""
    return dict(
        missing=_missing_sql(FEATURES_A), shares=_dominant_sql(FEATURES_A), pairs=_corr_sql(NUMERIC_A),
        record=f"""
            select 'missing' as reason, feature, missing_share as value from missing where missing_share > {missing}e0
            union all select 'disbalance', feature, dominant_share from shares where dominant_share > {dominant}e0
                  and feature not in (select feature from missing where missing_share > {missing}e0)
            union all select 'collinear', feature_j, round(max(corr), 8) from pairs where corr > {above}e0 group by feature_j""",
    )


_RECORD = record_sql(MISSING, DOMINANT, COLLINEAR)


def _record(wide: DataFrame) -> DataFrame:
    return profile.elimination_record(wide, FEATURES_A, missing=MISSING, dominant=DOMINANT, collinear_above=COLLINEAR)


@query(over_a("select * from record", **_RECORD))
def elimination_record(fx: Fixture) -> DataFrame:
    return _record(kept_a(fx)).withColumn("value", F.round("value", 8))


@query(over_a("select count(distinct feature) as dropped from record", **_RECORD))
def dropped_count(fx: Fixture) -> DataFrame:
    return profile.dropped_count(_record(kept_a(fx)))


def _long_sql(source: str, features: list[str]) -> str:
    return " union all ".join(f"select client_id, '{f}' as feature, cast({f} as varchar) as v from {source}" for f in features)


@query(over_a(
    "select feature, count(*) as n_rows, count(v) as n_values from cells where feature not in (select feature from record) group by feature",
    cells=_long_sql("wide", FEATURES_A), **_RECORD))
def drop_useless(fx: Fixture) -> DataFrame:
    """The columns that survive, each with its rows and values."""
    wide = kept_a(fx)
    left = profile.drop_useless(wide, _record(wide))
    names = [name for name in left.columns if name not in ("client_id", "target")]
    counts = left.agg(F.count(F.lit(1)).alias("n_rows"), *[F.count(name).alias(name) for name in names])
    return counts.select("n_rows", F.inline(F.array(*[F.struct(F.lit(n).alias("feature"), F.col(n).alias("n_values")) for n in names])))


@query(over_a("select client_id, target, " + ", ".join(f"coalesce({f}, -1) as {f}" for f in NUMERIC_A) + " from wide"))
def fill_constant(fx: Fixture) -> DataFrame:
    return encode.fill_constant(wide_a(fx).drop("set5_segment"), NUMERIC_A, -1)


_CODES = " union all ".join(
    f"select '{c}' as \"column\", {c} as value, cast(row_number() over (order by {c}) - 1 as int) as code "
    f"from (select distinct {c} from {{source}} where {c} is not null)" for c in ("lang", "source"))


@query(over_b(_CODES.format(source="b_text")))
def category_fit(fx: Fixture) -> DataFrame:
    return encode.fit_categories(fx["b_text"], ["lang", "source", "n_chars"])


@query(over_b("""
    select doc_id, coalesce((select code from codes where "column" = 'lang' and value = lang), -1) as lang,
           coalesce((select code from codes where "column" = 'source' and value = source), -1) as source, n_chars, n_words
    from b_text""", codes=_CODES.format(source="(select * from b_text where lang <> 'es')")))
def category_apply_unseen(fx: Fixture) -> DataFrame:
    dictionary = encode.fit_categories(fx["b_text"].where("lang <> 'es'"), ["lang", "source"])
    return encode.apply_categories(fx["b_text"], ["lang", "source", "n_chars", "n_words"], dictionary)


@query(over_b("""
    select doc_id, target, coalesce((select code from codes where "column" = 'lang' and value = lang), -1) as lang,
           coalesce((select code from codes where "column" = 'source' and value = source), -1) as source,
           coalesce(n_chars, -1) as n_chars, coalesce(n_words, -1) as n_words, coalesce(emb_label, -1) as emb_label
    from wide""", codes=_CODES.format(source="wide")))
def encode_then_fill(fx: Fixture) -> DataFrame:
    encoded, _ = encode.encode_categories(materialise(wide_b(fx), "wide"), FEATURES_B)
    return encode.fill_constant(encoded, FEATURES_B)


_MIXED = "select c_custkey as client_id, c_acctbal > 5000 as rich, cast(c_nationkey as int) as nation, c_acctbal as balance from customer where c_custkey % 3 <> 0"


@query(f"""
    select c.c_custkey as client_id, coalesce(cast(rich as int), -0.5e0) as rich, coalesce(cast(nation as double), -0.5e0) as nation, coalesce(balance, -0.5e0) as balance
    from customer c left join ({_MIXED}) m on m.client_id = c.c_custkey""")
def fill_mixed(fx: Fixture) -> DataFrame:
    """Gaps that a left join makes in a boolean, an integer and a double, filled with a fraction."""
    customers = fx["customer"]
    some = fx.spark.sql(_MIXED.replace("from customer", "from {customer}"), customer=customers)
    wide = customers.select(F.col("c_custkey").alias("client_id")).join(some, "client_id", "left")
    filled = encode.fill_constant(wide, ["rich", "nation", "balance"], -0.5)
    return filled.select("client_id", F.col("rich").cast("double").alias("rich"), "nation", "balance")


@query("""select 'text' as feature, max(n) * 1e0 / (select count(*) from documents) as dominant_share
    from (select count(*) as n from documents group by text) having max(n) * 1e0 / (select count(*) from documents) > 0.002""")
def dominant_texts(fx: Fixture) -> DataFrame:
    """Whole texts are compared by digest, in the sketch and in the count."""
    return profile.dominant_above(fx["documents"], ["text"], 0.002)
