"""RG1-RG7, PF1, PF2, JN1, JN2, AS1-AS6: registries and the wide tables they describe."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalogue.fixtures import FEATURES_A, SETS_A, Fixture, over_a, query, with_views
from lift.operators import assemble, profile, registry
from lift.sources.shared import fresh_path

ID, TARGET = "client_id", "target"

_REGISTRY = "select * from (values " + ", ".join(
    f"({i}, '{one['name']}', '{one['class']}', '{one['type']}', '{one['source']}', {j}, '{feature}')"
    for i, one in enumerate(SETS_A) for j, feature in enumerate(one["features"])
) + ") as r(set_pos, name, class, type, source, feat_pos, feature)"
_MISSING = " union all ".join(
    f"select '{name}' as feature, round((count(*) - count({name})) * 1e0 / count(*), 8) as missing_share from wide" for name in FEATURES_A)


def _described(condition: str) -> str:
    return over_a(f"select r.*, m.missing_share from registry r join missing m on m.feature = r.feature where {condition}",
                  registry=_REGISTRY, missing=_MISSING)


def _shares(fx: Fixture, chosen: DataFrame) -> DataFrame:
    wide, features = assemble.load_features(fx["a_train"], chosen, fx, ID, TARGET)
    return profile.missing_share(wide, features).select("feature", F.round("missing_share", 8).alias("missing_share"))


def _describe(fx: Fixture, chosen: DataFrame) -> DataFrame:
    """A registry with the missing share of each feature in the table it assembles."""
    return chosen.join(_shares(fx, chosen), "feature").select(*chosen.columns, "missing_share")


@query(_described("r.class = 'main'"))
def registry_select_main(fx: Fixture) -> DataFrame:
    return _describe(fx, registry.choose_sets(fx.registry_a(), "main"))


@query(_described("r.name in ('set3', 'set5')"))
def registry_select_named(fx: Fixture) -> DataFrame:
    return _describe(fx, registry.choose_sets(fx.registry_a(), ["set5", "set3"]))


@query(_described("r.name <> 'set2' and r.feature not in ('set1_order_sum', 'set5_const')"))
def registry_except(fx: Fixture) -> DataFrame:
    return _describe(fx, registry.leave_out(fx.registry_a(), "set2", ["set1_order_sum", "set5_const"]))


@query(_described("r.feature in ('set1_order_cnt', 'set4_qty', 'set2_urgent')"))
def registry_merge(fx: Fixture) -> DataFrame:
    everything = fx.registry_a()
    paths = []
    for names in (["set4_qty", "not_in_registry", "set1_order_cnt"], ["set4_qty", "set2_urgent"]):
        paths.append(fresh_path(fx.spark, "selection"))
        registry.save_registry(registry.convert_features(everything, names), paths[-1])
    return _describe(fx, registry.merge_selections(everything, *[registry.load_registry(fx.spark, path) for path in paths]))


@query(_described("m.missing_share < 0.5e0"))
def registry_convert(fx: Fixture) -> DataFrame:
    everything = fx.registry_a()
    shares = _shares(fx, everything)
    kept = registry.convert_features(everything, shares.where(F.col("missing_share") < 0.5))
    return kept.join(shares, "feature").select(*kept.columns, "missing_share")


@query(_described("true"))
def registry_json_roundtrip(fx: Fixture) -> DataFrame:
    path = fresh_path(fx.spark, "registry")
    registry.save_registry(fx.registry_a(), path)
    return _describe(fx, registry.load_registry(fx.spark, path))


@query(with_views("select t.client_id, set3_event_cnt, set3_value_max from a_train t join a_set3 s on s.client_id = t.client_id", "a_train", "a_set3"))
def feature_inner_fetch(fx: Fixture) -> DataFrame:
    return assemble.fetch_set(fx["a_train"], fx["a_set3"], ID, ["set3_event_cnt", "set3_value_max"])


@query(over_a("select * from wide"))
def assemble_wide(fx: Fixture) -> DataFrame:
    return assemble.load_features(fx["a_train"], fx.registry_a(), fx, ID, TARGET)[0]


@query(over_a("select client_id, target, " + ", ".join(f for one in SETS_A if one["class"] == "main" for f in one["features"]) + " from wide"))
def assemble_main_only(fx: Fixture) -> DataFrame:
    return assemble.load_features(fx["a_train"], fx.registry_a(), fx, ID, TARGET, feature_sets="main")[0]


@query(over_a("select client_id, " + ", ".join(f for one in SETS_A if one["name"] != "set3" for f in one["features"] if f != "set5_const") + " from wide"))
def assemble_scoring(fx: Fixture) -> DataFrame:
    return assemble.load_features(fx["a_train"], fx.registry_a(), fx, ID, except_sets=["set3"], except_features=["set5_const"])[0]


_INTEGERS = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")
_TYPE = "case when lo > -128 and hi < 127 then 'tinyint' when lo > -32768 and hi < 32767 then 'smallint' " \
        "when lo > -2147483648 and hi < 2147483647 then 'int' else 'bigint' end"


@query(" union all ".join(
    f"select '{c}' as \"column\", {_TYPE} as type, total from (select min({c}) as lo, max({c}) as hi, cast(sum({c}) as bigint) as total from lineitem)"
    for c in _INTEGERS))
def narrow_numeric(fx: Fixture) -> DataFrame:
    small = assemble.narrow(fx["lineitem"], _INTEGERS)
    types = dict(small.dtypes)
    totals = small.agg(*[F.sum(F.col(c).cast("bigint")).alias(c) for c in _INTEGERS])
    return totals.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.lit(types[c]).alias("type"), F.col(c).alias("total")) for c in _INTEGERS])))
