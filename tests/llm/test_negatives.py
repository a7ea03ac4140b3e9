"""Hard negatives against plain sorting, components of any size, odd rows."""

from __future__ import annotations

import math
import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from lift.llm import negatives as module
from lift.llm.negatives import hard_negatives
from lift.llm.wide import LEAST, MOST, column_pair, whole
from tests.llm.helpers import CLASHING

COLUMNS = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def plain(rows, is_anchor, scale=256):
    kept = {}
    for i, vector, label in rows:
        if i is None or label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        kept[i] = min(kept.get(i, (label, vector)), (label, vector))
    ints = {i: (label, [math.floor(scale * Fraction(x)) for x in vector]) for i, (label, vector) in kept.items()}
    near = lambda x: max(LEAST, min(MOST, x))
    out = []
    for a, (label, vector) in ints.items():
        if not is_anchor(a):
            continue
        scored = sorted((-sum(x * y for x, y in zip(vector, other)), i, other_label) for i, (other_label, other) in ints.items()
                        if i != a and len(other) == len(vector))
        for score, positive, _ in [x for x in scored if x[2] == label][:5]:
            fit = [(n, -s) for s, n, other in scored if other != label and 50 * -score <= 100 * -s <= 95 * -score][:3]
            out += [(a, positive, rank, n, near(-score), near(s)) for rank, (n, s) in enumerate(fit, 1)]
    return sorted(out)


def mined(spark, rows, kind="double", **how):
    df = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>, label int").repartition(3)
    return sorted(tuple(r) for r in hard_negatives(df, F.col("id") % 5 == 0, **how).select(*COLUMNS).collect())


@pytest.mark.parametrize("dims", [1, 3, 20])
def test_equals_plain_sorting(spark, dims, monkeypatch):
    monkeypatch.setattr(module, "LEAST_ROWS", 60)
    monkeypatch.setattr(module, "GROUP_ANCHORS", 7)
    monkeypatch.setattr(module, "RUN", 2)
    rng = random.Random(dims)
    rows = [(i, [rng.choice([-1.0, 0.0, 0.25, 1.0, rng.gauss(0, 1)]) for _ in range(dims)], rng.randint(0, 2)) for i in range(300)]
    rows += [(1000 + i, [0.5] * dims, i % 2) for i in range(80)]  # one very common vector
    assert mined(spark, rows) == plain(rows, lambda i: i % 5 == 0)


def test_reading_stops_before_the_end():
    import numpy as np

    rng = np.random.default_rng(2)
    values = rng.integers(-256, 256, (4000, 3))
    lists = module.SortedLists(np.arange(4000), np.zeros(4000, np.int64), values)
    read = []

    def met(anchor):
        for run in module.SortedLists.met(lists, anchor):
            read.append(len(run[0]))
            yield run

    lists.met = met
    (scores, ids), = lists.best(np.array([7, -3, 2]), np.ones(4000, bool), [(None, None)], 5)
    want = sorted((-int(v @ [7, -3, 2]), i) for i, v in enumerate(values))[:5]
    assert [(-s, i) for s, i in zip(scores.tolist(), ids.tolist())] == want
    assert sum(read) < 2000


def test_windows_are_filled_once_all_rows_are_met():
    """Scores that stay below the threshold until then are not sorted run by run."""
    import numpy as np

    rng = np.random.default_rng(3)
    values = rng.integers(-256, 256, (9000, 64))
    lists, first, calls = module.SortedLists(np.arange(9000), np.zeros(9000, np.int64), values), module.SortedLists.first, []
    lists.first = lambda *of: calls.append(1) or first(lists, *of)
    scores = values @ values[0]
    windows = [(50 * top, 95 * top) for top in (200_000, 300_000, 400_000)]
    found = lists.best(values[0], np.ones(9000, bool), windows, 3)
    want = [sorted((-int(s), i) for i, s in enumerate(scores) if low <= 100 * s <= high)[:3] for low, high in windows]
    assert [[(-s, i) for s, i in zip(a.tolist(), b.tolist())] for a, b in found] == want
    assert len(calls) == len(windows)


def test_huge_components_are_exact(spark):
    rng = random.Random(4)
    size = [1.0, 2e7, 3e9, 1e300]
    rows = [(i, [rng.choice([-1, 1]) * rng.random() * rng.choice(size) for _ in range(4)], rng.randint(0, 1)) for i in range(120)]
    assert mined(spark, rows) == plain(rows, lambda i: i % 5 == 0)


def test_odd_rows(spark):
    rows = [(0, [1.0, 2.0], 1), (None, [1.0, 2.0], 1), (1, None, 1), (2, [1.0, None], 1), (3, [float("nan"), 1.0], 1), (4, [float("inf"), 1.0], 1),
            (5, [], 1), (10, [], 1), (6, [1.0], 2), (7, [1.0, 2.0], None), (8, [1.0, 2.0], 1), (8, [1.0, 2.0], 1), (8, [0.5, 2.0], 1), (9, [0.5, 1.5], 2),
            (11, [0.5, 1.5], 2), (12, [0.9, 1.4], 3), (15, [0.0, 0.0], 1), (20, [-1.0, -2.0], 1)]
    assert mined(spark, rows) == plain(rows, lambda i: i % 5 == 0)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").select("*", *[F.lit("x").alias(n) for n in CLASHING if n not in ("label",)])
    assert sorted(tuple(r) for r in hard_negatives(df, F.col("id") % 5 == 0).select(*COLUMNS).collect()) == plain(rows, lambda i: i % 5 == 0)
    assert not mined(spark, rows[1:2])


def test_wide_scores_keep_their_order():
    scores = [-(10 ** 600), LEAST - 1, LEAST, LEAST + 1, -1, 0, MOST - 1, MOST, MOST + 1, 10 ** 600]
    pairs = [column_pair(s) for s in scores]
    assert [whole(*p) for p in pairs] == scores
    assert pairs == sorted(pairs, key=lambda p: (p[0], p[1] or b""))
