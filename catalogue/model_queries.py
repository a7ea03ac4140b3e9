"""ML1-ML10, EV12, PL1-PL4: importances, models and the end-to-end plans."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalogue.evaluate_queries import held_sql
from catalogue.fixtures import FEATURES_B, SETS_A, SPENDERS, VIEWS, Fixture, over_a, query, with_views
from catalogue.profile_queries import record_sql, wide_b
from lift.operators import assemble, boosting, encode, evaluate, forest, registry, split
from lift.plans.build import BuildSettings, build_model as build
from lift.plans.load import load_tables as load
from lift.plans.score import ScoreSettings, histogram_of, score_population as score
from lift.plans.select import SelectSettings, select_features as select
from lift.sources.shared import fresh_path, materialise

SEED = 5
TREES = 500
RANGES = {"num_iterations": (5, 15), "num_leaves": (4, 16), "learning_rate": (0.05, 0.5), "min_data_in_leaf": (5, 20),
          "bagging_fraction": (0.6, 0.9), "feature_fraction": (0.6, 1.0), "max_bin": (32, 64), "min_gain_to_split": (0.0, 0.01)}
PARAMS = {"num_iterations": 10, "num_leaves": 16, "learning_rate": 0.1, "min_data_in_leaf": 5, "max_bin": 64}

# A rule in place of a model, so that the importances have an exact SQL counterpart.
RULED = ["set1_order_cnt", "set4_returns", "set5_nation", "set5_const"]
_RULE = "case when {0} * 10 + {1} + ({2} % 3) > 100 then 1 else 0 end"


def _swapped(place: int) -> str:
    return _RULE.format(*[f"{'s' if i == place else 'p'}.x{i}" for i in range(len(RULED))])


_PERMUTED = {
    "a_spender": VIEWS["a_spender"],
    "spenders": SPENDERS,
    "filled": "select client_id, target as y, md5(concat('5|', cast(client_id as varchar))) as h, " +
              ", ".join(f"coalesce({name}, -1) as x{i}" for i, name in enumerate(RULED)) + " from spenders",
    "grouped": "select *, cast(concat('0x', substr(h, 1, 8)) as bigint) % greatest(1, cast(ceil((select count(*) from filled) / 1024e0) as bigint)) as g from filled",
    "placed": "select *, row_number() over (partition by g order by h) - 1 as i, count(*) over (partition by g) as c from grouped",
    "base": f"select count(case when {_RULE.format(*['x0', 'x1', 'x2', 'x3'])} = y then 1 end) as hits, count(*) as n from placed",
    "ruled": " union all ".join(
        f"select '{name}' as feature, round(((select hits from base) - count(case when {_swapped(i)} = p.y then 1 end)) * 1e0 / (select n from base), 8) as importance "
        f"from placed p join placed s on s.g = p.g and s.i = (p.i + case when p.c > 1 then 1 + ({i} * 7919) % (p.c - 1) else 0 end) % p.c"
        for i, name in enumerate(RULED)),
}


def _ruled(fx: Fixture) -> DataFrame:
    wide, _ = assemble.load_features(fx["a_spender"], fx.registry_a(), fx, "client_id", "target")
    ready = encode.fill_constant(materialise(wide, "wide"), RULED)
    rule = _RULE.format("x[0]", "x[1]", "x[2]", "x[3]")
    found = forest.permutation_importance(
        ready, RULED, "target", "client_id", lambda rows: rows.withColumn("prediction", F.expr(rule).cast("double")), seed=SEED)
    return found.withColumn("importance", F.round("importance", 8))


@query(over_a("select feature, importance from ruled", **_PERMUTED))
def permutation_importance_rule(fx: Fixture) -> DataFrame:
    return _ruled(fx)


@query(over_a("select feature, importance from ruled order by importance desc, feature limit 2", **_PERMUTED))
def top_importance(fx: Fixture) -> DataFrame:
    return evaluate.top_importances(_ruled(fx), 2)


_PLACES = "select * from (values " + ", ".join(
    f"('{one['name']}', {i}, '{feature}', {j})" for i, one in enumerate(SETS_A) for j, feature in enumerate(one["features"])
) + ") as r(name, set_pos, feature, feat_pos)"


@query(over_a("select r.* from places r join ruled using (feature) where importance > 0.0005e0", **_PERMUTED, places=_PLACES))
def export_top(fx: Fixture) -> DataFrame:
    path = fresh_path(fx.spark, "top")
    registry.save_registry(forest.export_top(fx.registry_a(), _ruled(fx)), path)
    positions = fx.registry_a().select("set_pos", "feat_pos", "feature")
    return registry.load_registry(fx.spark, path).select("name", "feature").join(positions, "feature")


@query(over_a("select r.* from places r join (select * from ruled order by importance desc, feature limit 3) using (feature)", **_PERMUTED, places=_PLACES))
def export_top_counted(fx: Fixture) -> DataFrame:
    best = forest.export_top(fx.registry_a(), _ruled(fx), permutation=False, top=3)
    return best.select("name", "set_pos", "feature", "feat_pos")


def _ready_b(fx: Fixture) -> DataFrame:
    """Documents encoded, filled and split."""
    parted = split.holdout(materialise(wide_b(fx), "wide"), "doc_id", "target", 0.2, SEED)
    encoded, _ = encode.encode_categories(parted, FEATURES_B)
    return materialise(encode.fill_constant(encoded, FEATURES_B), "ready")


def _part(ready: DataFrame, name: str) -> DataFrame:
    return ready.where(F.col("split") == name)


def _ready_lang(fx: Fixture) -> tuple[DataFrame, DataFrame]:
    """All documents, labelled by a threshold on one feature that a tree can find exactly; and the dictionary they are encoded with."""
    wide, _ = assemble.load_features(fx["b_lang"], fx.registry_b(), fx, "doc_id", "target")
    parted = split.holdout(materialise(wide, "wide"), "doc_id", "target", 0.2, SEED)
    encoded, dictionary = encode.encode_categories(parted, FEATURES_B)
    return materialise(encode.fill_constant(encoded, FEATURES_B), "ready"), dictionary


def _lang_importances(fx: Fixture, permutation: bool) -> tuple[DataFrame, DataFrame]:
    ready, _ = _ready_lang(fx)
    return forest.feature_importances(_part(ready, "train"), _part(ready, "holdout"), FEATURES_B, "target", "doc_id",
                                      permutation=permutation, seed=SEED, trees=TREES)


@query(f"select 'lang' as best, 1e0 as total, {len(FEATURES_B)} as n")
def rf_importance(fx: Fixture) -> DataFrame:
    """The feature that makes the label is the best one, and importances sum to 1."""
    found, _ = _lang_importances(fx, False)
    return found.agg(F.max_by("feature", "importance").alias("best"), F.round(F.sum("importance"), 6).alias("total"), F.count("*").cast("int").alias("n"))


@query(f"select 'lang' as best, {len(FEATURES_B)} as n, 0 as n_above_one")
def rf_permutation(fx: Fixture) -> DataFrame:
    found, _ = _lang_importances(fx, True)
    return found.agg(F.max_by("feature", "importance").alias("best"), F.count("*").cast("int").alias("n"),
                     F.count_if(F.col("importance") > 1).cast("int").alias("n_above_one"))


@query("select 'all' as set, 1e0 as auc")
def rf_auc(fx: Fixture) -> DataFrame:
    """A label that one feature decides is ranked without a fault."""
    return _lang_importances(fx, False)[1].select("set", F.round("auc", 3).alias("auc"))


# Forests that may try every feature at every split find the label's rule in each tree. So every importance is known: no
# other feature has any, and moving the deciding one gives a row the label of the row that its value comes from.
_RANKED = held_sql("b_lang", "doc_id", "target") | {
    "held_out": "select target, md5(concat('5|', cast(doc_id as varchar))) as h from parted where split = 'holdout'",
    "dealt": "select *, cast(concat('0x', substr(h, 1, 8)) as bigint) % greatest(1, cast(ceil((select count(*) from held_out) / 1024e0) as bigint)) as g from held_out",
    "stood": "select *, row_number() over (partition by g order by h) - 1 as i, count(*) over (partition by g) as c from dealt",
    "moved": "select count(case when s.target <> p.target then 1 end) * 1e0 / count(*) as loss from stood p join stood s on s.g = p.g and s.i = "
             f"(p.i + case when p.c > 1 then 1 + ({FEATURES_B.index('lang')} * 7919) % (p.c - 1) else 0 end) % p.c",
    "ranked": "select feature, case when feature = 'lang' then (select loss from moved) else 0e0 end as importance from (values " +
              ", ".join(f"('{name}')" for name in FEATURES_B) + ") as f(feature)",
}


def _whole_forest(fx: Fixture, permutation: bool) -> tuple[DataFrame, DataFrame]:
    ready, _ = _ready_lang(fx)
    return forest.feature_importances(_part(ready, "train"), _part(ready, "holdout"), FEATURES_B, "target", "doc_id",
                                      permutation=permutation, seed=SEED, trees=TREES, max_features=1.0)


@query("select feature, case when feature = 'lang' then 1e0 else 0e0 end as importance from (values " + ", ".join(f"('{name}')" for name in FEATURES_B) + ") as f(feature)")
def rf_importance_rows(fx: Fixture) -> DataFrame:
    """The impurity importance of every feature."""
    return _whole_forest(fx, False)[0].select("feature", F.round("importance", 8).alias("importance"))


@query(with_views("select feature, round(importance, 8) as importance from ranked", "b_lang", extra=_RANKED))
def rf_permutation_rows(fx: Fixture) -> DataFrame:
    """The permutation importance of every feature, from a forest's own arrays."""
    return _whole_forest(fx, True)[0].select("feature", F.round("importance", 8).alias("importance"))


@query(with_views("select feature, round(importance, 8) as importance, cast(importance > 0.0005e0 as int) as chosen from ranked", "b_lang", extra=_RANKED))
def select_ranking(fx: Fixture) -> DataFrame:
    """The ranking of a selection that drops nothing before it, and the registry it saved, read back."""
    settings = SelectSettings(target="target", id_column="doc_id", missing_threshold=1.0, disbalance_threshold=1.0, collinear_threshold=1.0, seed=SEED,
                              forest={"trees": TREES, "max_features": 1.0})
    path = fresh_path(fx.spark, "top")
    found = select(fx["b_lang"], fx.registry_b(), fx, settings, path).importances
    chosen = registry.load_registry(fx.spark, path).select("feature", F.lit(1).alias("chosen"))
    return found.join(chosen, "feature", "left").select("feature", F.round("importance", 8).alias("importance"), F.coalesce("chosen", F.lit(0)).alias("chosen"))


@query("select cast(trial as integer) as trial, 1 as in_ranges, 1 as is_area from (select unnest(range(0, 4)) as trial)")
def gbt_search(fx: Fixture) -> DataFrame:
    """As many trials as asked for, each with parameters inside their ranges and an area."""
    train = split.folds(_part(_ready_b(fx), "train"), "doc_id", "target", 2, SEED)
    trials = boosting.search(train, FEATURES_B, "target", RANGES, init_points=2, n_iter=2, seed=SEED, id_column="doc_id").trials
    inside = F.lit(True)
    for name, (low, high) in RANGES.items():
        inside = inside & F.col(name).between(float(low), float(high))
    return trials.select("trial", inside.cast("int").alias("in_ranges"), F.col("auc").between(0, 1).cast("int").alias("is_area"))


@query(with_views("select doc_id, 0e0 as difference from b_train", "b_train"))
def model_roundtrip(fx: Fixture) -> DataFrame:
    """A saved and reloaded model gives every document the same probability."""
    ready = _ready_b(fx)
    model = boosting.fit_boosted(_part(ready, "train"), FEATURES_B, "target", PARAMS, seed=SEED)
    path = fresh_path(fx.spark, "model")
    boosting.save_model(model, path)
    both = boosting.score(boosting.load_model(path), boosting.score(model, ready, "first"), "second")
    return both.select("doc_id", F.abs(F.col("first") - F.col("second")).alias("difference"))


@query(with_views("select doc_id, target as predicted from b_lang", "b_lang"))
def score_batch(fx: Fixture) -> DataFrame:
    """A model of a label that one feature decides gives every document its label, also those it was not fitted on."""
    ready, dictionary = _ready_lang(fx)
    model = boosting.fit_boosted(_part(ready, "train"), FEATURES_B, "target", PARAMS, seed=SEED, id_column="doc_id")
    everything, features = assemble.load_features(fx["b_text"], fx.registry_b(), fx, "doc_id")
    encoded = encode.fill_constant(encode.apply_categories(everything, features, dictionary), features)
    return boosting.score(model, encoded).select("doc_id", (F.col("pred") > 0.5).cast("int").alias("predicted"))


_LIMIT = 0.9


@query(over_a("""
    select feature, coalesce((select string_agg(reason, '+' order by reason) from record where record.feature = missing.feature), 'ranked') as outcome
    from missing""", **record_sql(_LIMIT, _LIMIT, _LIMIT)))
def select_features(fx: Fixture) -> DataFrame:
    """Every registered feature is dropped, for one reason or more, or has an importance."""
    settings = SelectSettings(target="target", missing_threshold=_LIMIT, disbalance_threshold=_LIMIT, collinear_threshold=_LIMIT, seed=SEED,
                              forest={"trees": TREES})
    selection = select(fx["a_train"], fx.registry_a(), fx, settings, fresh_path(fx.spark, "top"))
    dropped = selection.record.groupBy("feature").agg(F.concat_ws("+", F.array_sort(F.collect_list("reason"))).alias("outcome"))
    return dropped.unionByName(selection.importances.select("feature", F.lit("ranked").alias("outcome")))


@query(with_views("""select split, target, count(*) as n, count(*) as n_right, (select count(*) from b_lang) as n_loaded
    from parted group by split, target""", "b_lang", extra=held_sql("b_lang", "doc_id", "target")))
def build_model(fx: Fixture) -> DataFrame:
    """The parts of the split, every row of which the model gives its label, and the rows that were loaded."""
    settings = BuildSettings(target="target", id_column="doc_id", ranges=RANGES, cv_splits=2, init_points=1, n_iter=1, seed=SEED, cm_threshold=0.45)
    built = build(fx["b_lang"], fx.registry_b(), fx, settings, model_path=fresh_path(fx.spark, "model"),
                  dictionary_path=fresh_path(fx.spark, "dictionary"))
    return built.scored.groupBy("split", "target").agg(
        F.count("*").alias("n"), F.count_if((F.col("pred") > 0.5).cast("int") == F.col("target")).alias("n_right")).withColumn(
        "n_loaded", F.lit(built.sizes["load"][0]).cast("bigint"))


@query(with_views("select doc_id, target as predicted from b_lang", "b_lang"))
def score_population(fx: Fixture) -> DataFrame:
    """Every document arrives in the scoring table with its label."""
    settings = BuildSettings(target="target", id_column="doc_id", ranges=RANGES, cv_splits=2, init_points=1, n_iter=0, seed=SEED, metrics=(), histogram=False)
    model_path, dictionary_path = fresh_path(fx.spark, "model"), fresh_path(fx.spark, "dictionary")
    build(fx["b_lang"], fx.registry_b(), fx, settings, model_path=model_path, dictionary_path=dictionary_path)
    table = fx.scratch_table("scoring")
    score(fx["b_text"], fx.registry_b(), fx, model_path, ScoreSettings(id_column="doc_id"), dictionary=dictionary_path,
          path=fresh_path(fx.spark, "scoring"), table=table)
    return fx.spark.table(table).select("doc_id", (F.col("pred") > 0.5).cast("int").alias("predicted"))


@query(with_views("""
    select cast(bin as int) as bin, (select count(*) from b_score where pred >= (bin - 1) * step + lo and (pred < bin * step + lo or bin = bins)) as n
    from (select *, (hi - lo) / bins as step from chosen), lateral (select unnest(range(1, bins + 1)) as bin)""", "b_score", extra={
    "ends": "select min(pred) as lo, max(pred) as hi, count(*) as n, quantile_cont(pred, 0.75) - quantile_cont(pred, 0.25) as iqr from b_score",
    "chosen": "select lo, hi, cast(least(50, ceil((hi - lo) / (2 * iqr / power(n, 1e0 / 3)))) as bigint) as bins from ends"}))
def scoring_histogram(fx: Fixture) -> DataFrame:
    return histogram_of(fx["b_score"], "doc_id", "pred").select("bin", "n")


@query("""
    select 'customer' as source, c_custkey as id, c_acctbal as amount from customer
    union all select 'supplier', s_suppkey, s_acctbal from supplier""")
def load_tables(fx: Fixture) -> DataFrame:
    """CSV files into bucketed tables keyed by id, then read back."""
    spark, files = fx.spark, {}
    for name, id_, amount in (("customer", "c_custkey", "c_acctbal"), ("supplier", "s_suppkey", "s_acctbal")):
        path = fresh_path(spark, f"{name}-csv")
        fx[name].select(F.col(id_).alias("id"), F.col(amount).alias("amount")).write.csv(path, header=True)
        files[fx.scratch_table(name)] = path
    load(spark, files, "id", buckets=4)
    customers, suppliers = files
    return (spark.table(customers).select(F.lit("customer").alias("source"), "*")
            .unionByName(spark.table(suppliers).select(F.lit("supplier").alias("source"), "*")))
