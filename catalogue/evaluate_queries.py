"""SP1, SP2, PF4-PF6, EV1-EV11: splits and evaluation tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalogue.fixtures import Fixture, query, with_views
from lift.functions.columns import above
from lift.operators import evaluate, split

SEED = 5
_HASH = "md5(concat('5', '|', cast({id} as varchar)))"


def held_sql(source: str, id_: str, target: str) -> dict[str, str]:
    """The holdout sizes by class, and the rows with their place in the class."""
    return {
        "totals": f"select count(*) as n, count(*) - cast(ceil(0.2 * count(*)) as bigint) as train from {source}",
        "parts": f"select {target} as cls, count(*) as c, (select train from totals) * count(*) as prod from {source} group by 1",
        "floors": "select cls, c, prod // (select n from totals) as kept, prod % (select n from totals) as rest from parts",
        "sizes": """select cls, c - kept - case when row_number() over (order by rest desc, cls)
                           <= (select train from totals) - (select sum(kept) from floors) then 1 else 0 end as held from floors""",
        "placed": f"select *, row_number() over (partition by {target} order by {_HASH.format(id=id_)}, {id_}) as place, "
                  f"count(*) over (partition by {target}) as size from {source}",
        "parted": f"select placed.*, case when place <= held then 'holdout' else 'train' end as split from placed join sizes on cls = {target}",
    }


@query(with_views("select client_id, target, split from parted", "a_train", extra=held_sql("a_train", "client_id", "target")))
def stratified_holdout(fx: Fixture) -> DataFrame:
    return split.holdout(fx["a_train"], "client_id", "target", 0.2, SEED)


@query(with_views("select target, split, count(*) as n from parted group by target, split", "a_train", extra=held_sql("a_train", "client_id", "target")))
def holdout_sizes(fx: Fixture) -> DataFrame:
    return split.holdout(fx["a_train"], "client_id", "target", 0.2, SEED).groupBy("target", "split").agg(F.count("*").alias("n"))


@query(with_views("select client_id, target, cast((place - 1) * 4 // size as int) as fold from placed", "a_train",
                  extra={"placed": held_sql("a_train", "client_id", "target")["placed"]}))
def stratified_folds(fx: Fixture) -> DataFrame:
    return split.folds(fx["a_train"], "client_id", "target", 4, SEED)


@query(with_views("select doc_id, y, pred from b_score", "b_score"))
def sample_all(fx: Fixture) -> DataFrame:
    return split.sample_rows(fx["b_score"], "doc_id", 1.0, SEED)


@query("select o_orderkey, o_totalprice from (select *, row_number() over (order by " + _HASH.format(id="o_orderkey") +
       ", o_orderkey) as place, count(*) over () as n from orders) where place <= round_even(0.3e0 * n, 0)")
def sample_exact(fx: Fixture) -> DataFrame:
    return split.sample_rows(fx["orders"].select("o_orderkey", "o_totalprice"), "o_orderkey", 0.3, SEED)


@query(with_views("select doc_id, cast(pred > 0.45e0 as int) as yhat from b_score", "b_score"))
def threshold_predicate(fx: Fixture) -> DataFrame:
    return fx["b_score"].select("doc_id", above(F.col("pred"), 0.45).alias("yhat"))


_COUNTS = "select 'all' as set, pred as score, cast(sum(y) as bigint) as pos, cast(sum(1 - y) as bigint) as neg from b_score group by pred"
_RUN = """select set, score, pos, neg, sum(pos) over (partition by set order by score desc) as tp, sum(neg) over (partition by set order by score desc) as fp,
          sum(pos) over (partition by set) as p, sum(neg) over (partition by set) as n from counts"""


def _over_scores(body: str, **extra: str) -> str:
    return with_views(body, "b_score", extra={"counts": _COUNTS, "run": _RUN} | extra)


def counts_b(fx: Fixture) -> DataFrame:
    return evaluate.score_counts(fx["b_score"], "y", "pred")


@query(_over_scores("select * from counts"))
def label_distribution(fx: Fixture) -> DataFrame:
    return evaluate.score_counts(fx["b_score"], "y", "pred", keep=False)


@query(_over_scores("""
    select score as threshold, round(fp * 1e0 / n, 8) as fpr, round(tp * 1e0 / p, 8) as tpr from run
    union all select null, 0e0, 0e0"""))
def roc_points(fx: Fixture) -> DataFrame:
    return evaluate.roc_points(counts_b(fx)).select("threshold", F.round("fpr", 8).alias("fpr"), F.round("tpr", 8).alias("tpr"))


_AUC = "sum(neg * (tp - pos / 2e0)) / (max(p) * 1e0 * max(n))"


@query(_over_scores(f"select round({_AUC}, 8) as auc from run"))
def roc_auc(fx: Fixture) -> DataFrame:
    return evaluate.roc_auc(counts_b(fx)).select(F.round("auc", 8).alias("auc"))


@query(_over_scores("""
    select score as threshold, round(tp * 1e0 / p, 8) as recall, round(tp * 1e0 / (tp + fp), 8) as precision from run
    union all select null, 0e0, 1e0"""))
def pr_points(fx: Fixture) -> DataFrame:
    return evaluate.pr_points(counts_b(fx)).select("threshold", F.round("recall", 8).alias("recall"), F.round("precision", 8).alias("precision"))


_AP = "sum((pos * 1e0 / p) * (tp * 1e0 / (tp + fp)))"


@query(_over_scores(f"select round({_AP}, 8) as average_precision from run"))
def average_precision(fx: Fixture) -> DataFrame:
    return evaluate.average_precision(counts_b(fx)).select(F.round("average_precision", 8).alias("average_precision"))


_CELLS = "select a.actual, b.predicted, (select count(*) from b_score where y = a.actual and cast(pred > 0.45e0 as int) = b.predicted) as n " \
         "from (values (0), (1)) a(actual), (values (0), (1)) b(predicted)"


@query(with_views(_CELLS, "b_score"))
def confusion(fx: Fixture) -> DataFrame:
    return evaluate.confusion(counts_b(fx), 0.45).drop("set")


@query(with_views("""
    select a.actual, b.predicted, (select count(*) from labels where quality = a.actual and toxic = b.predicted) as n
    from (values (0), (1)) a(actual), (values (0), (1)) b(predicted)""", "b_score"))
def confusion_of_labels(fx: Fixture) -> DataFrame:
    return evaluate.confusion(evaluate.score_counts(fx["labels"], "quality", "toxic"), None).drop("set")


_HITS = """select sum(y * yhat) * 1e0 as tp, sum((1 - y) * yhat) * 1e0 as fp, sum(y * (1 - yhat)) * 1e0 as fn, sum((1 - y) * (1 - yhat)) * 1e0 as tn
           from (select y, cast(pred > 0.45e0 as int) as yhat from b_score)"""


@query(with_views("select round_even(100e0 * tp / (tp + fp), 1) as precision, round_even(100e0 * tp / (tp + fn), 1) as recall from hits", "b_score", extra={"hits": _HITS}))
def precision_recall_at(fx: Fixture) -> DataFrame:
    return evaluate.threshold_metrics(counts_b(fx), 0.45).select("precision", "recall")


@query(with_views("select round_even(100e0 * (tp / (tp + fn) + tn / (tn + fp)) / 2e0, 1) as auc_at_threshold from hits", "b_score", extra={"hits": _HITS}))
def auc_at_threshold(fx: Fixture) -> DataFrame:
    return evaluate.threshold_metrics(counts_b(fx), 0.45).select("auc_at_threshold")


_BINS = """
    select label, bin, (select count(*) from b_score where y = label
                        and pred >= (bin - 1) * 0.02e0 and (pred < bin * 0.02e0 or bin = 50)) as n
    from (select distinct y as label from b_score), (select unnest(range(1, 51)) as bin)"""


@query(with_views("select label, cast(bin as int) as bin, n, round(n * 1e0 / (sum(n) over (partition by label) * 0.02e0), 8) as density from bins",
                  "b_score", extra={"bins": _BINS}))
def prob_histogram(fx: Fixture) -> DataFrame:
    return evaluate.probability_histogram(counts_b(fx)).select("label", "bin", "n", F.round("density", 8).alias("density"))


@query(with_views("""
    select cast(bin as int) as bin, round((bin - 1) * step + lo, 8) as lower,
           (select count(*) from b_score where pred >= (bin - 1) * step + lo and (pred < bin * step + lo or bin = bins)) as n
    from (select *, (hi - lo) / bins as step from chosen), lateral (select unnest(range(1, bins + 1)) as bin)""", "b_score", extra={
    "ends": "select min(pred) as lo, max(pred) as hi, count(*) as n, quantile_cont(pred, 0.75) - quantile_cont(pred, 0.25) as iqr from b_score",
    "chosen": "select lo, hi, cast(least(50, ceil((hi - lo) / (2 * iqr / power(n, 1e0 / 3)))) as bigint) as bins from ends"}))
def score_histogram(fx: Fixture) -> DataFrame:
    return evaluate.score_histogram(counts_b(fx)).select("bin", F.round("lower", 8).alias("lower"), "n")


@query(with_views("""
    select cast(bin as int) as bin, (select count(*) from b_score where pred >= (bin - 1) * step + lo and (pred < bin * step + lo or bin = 50)) as n
    from (select min(pred) as lo, (max(pred) - min(pred)) / 50 as step from b_score), (select unnest(range(1, 51)) as bin)""", "b_score"))
def score_histogram_fixed(fx: Fixture) -> DataFrame:
    return evaluate.score_histogram(counts_b(fx), 50).select("bin", "n")


@query(with_views("""
    select label, cast(point as int) as point, round(lo - 3 * h + point * step, 6) as x,
           round(sum(exp(-0.5e0 * power((lo - 3 * h + point * step - pred) / h, 2))) / (max(n) * max(h) * sqrt(2 * pi())), 6) as density
    from (select *, (hi - lo + 6 * h) / 99 as step from bands) join b_score on y = label, (select unnest(range(0, 100)) as point)
    group by label, point, lo, h, step""", "b_score", extra={
    "bands": "select y as label, count(*) as n, min(pred) as lo, max(pred) as hi, stddev_samp(pred) * power(count(*), -0.2e0) as h from b_score group by y"}))
def density_curve(fx: Fixture) -> DataFrame:
    return evaluate.density_curve(counts_b(fx)).select("label", "point", F.round("x", 6).alias("x"), F.round("density", 6).alias("density"))


_PARTED = held_sql("b_score", "doc_id", "y")
_PART_COUNTS = "select split as set, pred as score, cast(sum(y) as bigint) as pos, cast(sum(1 - y) as bigint) as neg from parted group by 1, 2"


@query(with_views(f"""
    select 'auc' as metric, set as item, round({_AUC}, 8) as value from run group by set
    union all select 'average_precision', set, round({_AP}, 8) from run where set = 'holdout' group by set
    union all select 'roc_points', set, count(*) + 1e0 from run group by set
    union all select 'pr_points', set, count(*) + 1e0 from run where set = 'holdout' group by set
    union all select 'conf_matrix', concat(cast(a as varchar), cast(b as varchar)), (select count(*) from parted
        where split = 'holdout' and y = a and cast(pred > 0.45e0 as int) = b) * 1e0 from (values (0), (1)) x(a), (values (0), (1)) z(b)
    union all select 'prob_hist', cast(y as varchar), count(*) * 1e0 from parted where split = 'holdout' group by y""",
    "b_score", extra=_PARTED | {"counts": _PART_COUNTS, "run": _RUN}))
def metric_set(fx: Fixture) -> DataFrame:
    parted = split.holdout(fx["b_score"], "doc_id", "y", 0.2, SEED)
    made = evaluate.metric_set(evaluate.score_counts(parted, "y", "pred", "split"), threshold=0.45)

    def rows(metric: str, df: DataFrame, item, value) -> DataFrame:
        return df.select(F.lit(metric).alias("metric"), item.cast("string").alias("item"), value.cast("double").alias("value"))

    def size(name: str) -> DataFrame:
        return made[name].groupBy("set").agg(F.count("*").alias("n"))

    hist = made["prob_hist"].groupBy("label").agg(F.sum("n").alias("n"))
    return reduce(DataFrame.unionByName, [
        rows("auc", made["roc_auc"], F.col("set"), F.round("auc", 8)),
        rows("average_precision", made["average_precision"], F.col("set"), F.round("average_precision", 8)),
        rows("roc_points", size("roc_curve"), F.col("set"), F.col("n")),
        rows("pr_points", size("pr_curve"), F.col("set"), F.col("n")),
        rows("conf_matrix", made["conf_matrix"], F.concat(F.col("actual").cast("string"), F.col("predicted").cast("string")), F.col("n")),
        rows("prob_hist", hist, F.col("label"), F.col("n")),
    ])
