"""Hard negatives by Fagin's threshold algorithm.

For each anchor, its positives are its best rows of the same label; for each
positive, the negatives are the best rows of other labels whose score lies in a
window below the positive's. Scores are integer inner products of quantised
vectors.

Rows are dealt into blocks. A block keeps for every dimension its rows sorted by
that component. An anchor reads all lists from the end that its own sign favours,
a run of entries at a time (sorted access), and scores the rows it meets in full
(random access). What the next entries could add up to is the threshold: no row
that has not been met scores more. Reading ends once the threshold is strictly
below the k-th score of every window, or, where a window has fewer rows, below
its lower end. The best rows of the blocks are then merged. A task holds one block
and a stream of anchors; the anchors travel, the lists are built once per task.

Defined results: rows with a null id or label, and vectors that are null or hold
a null or a number that is not finite, take no part; of rows that repeat an id the one
with the least label and vector counts; vectors of different lengths are not compared;
ties go to the smaller id; anchors without positives, and positives without
negatives, have no rows; components of any size are exact (scores beyond 64 bits
rank by their true value and are returned as the nearest long); an empty table
gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lift.functions.columns import named
from lift.llm.wide import column_pair, quantised, whole
from lift.sources.shared import materialise

#: Values of a block; rows of the smallest block that is made only to keep cores busy; anchors that one task reads.
BLOCK_VALUES, LEAST_ROWS, GROUP_ANCHORS = 1 << 20, 2048, 1 << 16
#: Sizes and dimensions whose inner products fit in 64 bits; the rest is reckoned in whole Python numbers.
NARROW, NARROW_DIMS = float(1 << 24), 1 << 14
RUN = 32
#: Rows of one product with an anchor; larger ones wake the threads of the linear algebra, which costs more than it saves.
PRODUCT_ROWS = 4096
FOUND = "anchor_id long, positive_id long, id long, score long, wide binary"
FOUND_ARROW = pa.schema([("anchor_id", pa.int64()), ("positive_id", pa.int64()), ("id", pa.int64()), ("score", pa.int64()), ("wide", pa.binary())])


def labelled_vectors(df: DataFrame, id_col: str, vector_col: str, label_col: str, scale: int) -> DataFrame:
    """``(id, label, v, x, dims)``: integer vectors ``v``, or for huge ones the components ``x`` as they are."""
    vector = F.transform(named(vector_col), lambda x: x.cast("double"))
    finite = F.forall(vector, lambda x: x.isNotNull() & (F.abs(x) < float("inf")))
    rows = df.where(named(id_col).isNotNull() & named(label_col).isNotNull() & named(vector_col).isNotNull() & finite).select(
        named(id_col).cast("long").alias("id"), named(label_col).cast("long").alias("label"), vector.alias("x"))
    rows = rows.groupBy("id").agg(F.min(F.struct("label", "x")).alias("row")).select("id", "row.*").withColumn("dims", F.size("x"))
    narrow = F.forall("x", lambda x: F.abs(x) <= NARROW / scale) & (F.col("dims") <= NARROW_DIMS)
    return rows.select("id", "label", "dims", F.when(narrow, F.transform("x", lambda x: F.floor(x * scale).cast("long"))).alias("v"),
                       F.when(~narrow, F.col("x")).alias("x"))


def matrix(batch: pa.RecordBatch | pa.Table, dims: int, scale: int) -> np.ndarray:
    """The rows' integer vectors: 64-bit if all are narrow, else whole Python numbers."""
    table = pa.table(batch) if isinstance(batch, pa.RecordBatch) else batch
    wide = table["x"].is_valid().to_numpy()
    if not wide.any():
        return table["v"].combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(table), dims)
    made = quantised([x if x is not None else [0.0] * dims for x in table["x"].to_pylist()], dims, scale)
    for i, v in enumerate(table["v"].to_pylist()):
        if v is not None:
            made[i] = v
    return made


class SortedLists:
    """A block: for every dimension its rows in the order of that component."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, values: np.ndarray) -> None:
        order = np.argsort(ids, kind="stable")
        self.ids, self.labels, self.values = ids[order], labels[order], values[order]
        self.by_size = np.argsort(self.values, axis=0, kind="stable").T.copy()
        self.sizes = np.take_along_axis(self.values.T, self.by_size, axis=1)
        self.largest = 0 if values.dtype == object or not values.size else int(np.abs(values).max())
        self.floats = self.values.astype(np.float64) if self.largest <= NARROW and values.dtype != object else None

    def score(self, rows: np.ndarray | slice, anchor: np.ndarray) -> np.ndarray:
        if self.floats is None or anchor.dtype == object:
            return (self.values[rows].astype(object) * anchor.astype(object)).sum(axis=1) if anchor.size else np.zeros(len(rows), object)
        if self.largest * int(np.abs(anchor).sum()) < 1 << 53:  # the products are whole numbers that doubles hold
            return (self.floats[rows] @ anchor.astype(np.float64)).astype(np.int64)
        return self.values[rows] @ anchor

    def met(self, anchor: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, int | None]]:
        """Runs of rows not met before, their scores, and the threshold after each (none at the end).

        Once a run meets much of the block, one product scores all rows, which costs less than copying those met.
        """
        n, seen, whole = len(self.ids), np.zeros(len(self.ids), bool), None
        wide = self.values.dtype == object or anchor.dtype == object
        up, down = np.flatnonzero(anchor > 0), np.flatnonzero(anchor < 0)
        if not len(up) and not len(down):  # every score is 0
            yield np.arange(n), np.zeros(n, np.int64), None
            return
        at, run = 0, RUN
        while at < n:
            to = min(n, at + run)
            entries = np.concatenate((self.by_size[up, n - to:n - at].ravel(), self.by_size[down, at:to].ravel()))
            new = np.zeros(n, bool)
            new[entries] = True
            rows = np.flatnonzero(new & ~seen)
            seen |= new
            ends = np.concatenate((self.sizes[up, n - to], self.sizes[down, to - 1]))
            weights = np.concatenate((anchor[up], anchor[down]))
            threshold = sum(int(a) * int(b) for a, b in zip(ends, weights)) if wide else int(ends @ weights)
            done = to == n or seen.all()
            if whole is None and not wide and 4 * len(rows) > n:
                whole = np.concatenate([self.score(slice(a, a + PRODUCT_ROWS), anchor) for a in range(0, n, PRODUCT_ROWS)])
            yield rows, self.score(rows, anchor) if whole is None else whole[rows], None if done else threshold
            if done:
                return
            at, run = to, 2 * run

    def first(self, scores: np.ndarray, rows: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The ``k`` highest scores, ties to the smaller id (rows are in the order of ids)."""
        if scores.dtype == object:
            order = np.array(sorted(range(len(rows)), key=lambda i: (-scores[i], rows[i]))[:k], np.int64)
        else:
            if len(scores) > 4 * k:
                near = scores >= np.partition(scores, len(scores) - k)[len(scores) - k]
                scores, rows = scores[near], rows[near]
            order = np.lexsort((rows, -scores))[:k]
        return scores[order], rows[order]

    def best(self, anchor: np.ndarray, fit: np.ndarray, windows: list[tuple[int | None, int | None]], k: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each window ``(low, high)`` of a hundredfold score, the best ``k`` rows among ``fit``, as scores and ids."""
        none = np.zeros(0, np.int64)
        kept, open_windows, met = [(none, none) for _ in windows], set(range(len(windows))), []
        most, lowest = None, max((low for low, _ in windows if low is not None), default=None)
        for rows, scores, threshold in self.met(anchor):
            mine = fit[rows]
            rows, scores = rows[mine], scores[mine]
            met.append((scores, rows))
            if len(scores):
                most = scores.max() if most is None else max(most, scores.max())
            # windows close only when the threshold is below a score that was met, or below a lower end
            if threshold is not None and (most is None or threshold >= most) and (lowest is None or 100 * threshold >= lowest):
                continue
            met = [tuple(np.concatenate(some) for some in zip(*met))]
            scores, rows = met[0]
            for w in list(open_windows):
                low, high = windows[w]
                inside = np.ones(len(rows), bool)
                if low is not None:
                    inside &= (scores >= -(-low // 100)).astype(bool)
                if high is not None:
                    inside &= (scores <= high // 100).astype(bool)
                kept[w] = self.first(scores[inside], rows[inside], k)
                found = kept[w][0]
                full = len(found) == k and threshold is not None and threshold < found[-1]
                if full or (low is not None and threshold is not None and 100 * threshold < low):
                    open_windows.discard(w)
            if not open_windows:
                break
        return [(scores, self.ids[rows]) for scores, rows in kept]


def scan(asked: list[str], scale: int, search: Callable[[SortedLists, dict, np.ndarray], Iterator[tuple]]):
    """Work on partitions whose rows are sorted by unit, block rows before anchors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit, lists, held = None, None, []
        for batch in batches:
            units, anchors = batch["unit"].to_numpy(), batch["asks"].to_numpy(zero_copy_only=False).astype(bool)
            change = np.flatnonzero((np.diff(units) != 0) | (np.diff(anchors.astype(np.int8)) != 0)) + 1
            for a, b in zip([0, *change], [*change, len(units)]):
                part = batch.slice(a, b - a)
                if not len(part):
                    continue
                if unit != units[a]:
                    unit, lists, held = units[a], None, []
                if not anchors[a]:
                    held.append(part.select(["id", "label", "v", "x", "dims"]))
                    continue
                if not held and lists is None:
                    continue  # anchors of a length no row has
                if lists is None:
                    block = pa.Table.from_batches(held)
                    held, dims = [], block["dims"][0].as_py()
                    lists = SortedLists(block["id"].to_numpy(), block["label"].to_numpy(), matrix(block, dims, scale))
                out = []
                for row, vector in zip(part.select(asked).to_pylist(), matrix(part, part["dims"][0].as_py(), scale)):
                    out.extend(search(lists, row, vector))
                yield pa.RecordBatch.from_pylist([dict(zip(FOUND_ARROW.names, row)) for row in out], FOUND_ARROW)

    return run


def positives(k: int):
    def search(lists: SortedLists, row: dict, vector: np.ndarray) -> Iterator[tuple]:
        fit = (lists.labels == row["label"]) & (lists.ids != row["id"])
        (scores, ids), = lists.best(vector, fit, [(None, None)], k)
        for score, found in zip(scores.tolist(), ids.tolist()):
            yield row["id"], None, found, *column_pair(score)

    return search


def negatives(k: int, low: int, high: int):
    def search(lists: SortedLists, row: dict, vector: np.ndarray) -> Iterator[tuple]:
        of = [(p["id"], whole(p["score"], p["wide"])) for p in row["positives"]]
        of = [(positive, low * score, high * score) for positive, score in of if low * score <= high * score]
        best = lists.best(vector, lists.labels != row["label"], [(a, b) for _, a, b in of], k) if of else []
        for (positive, _, _), (scores, ids) in zip(of, best):
            for score, found in zip(scores.tolist(), ids.tolist()):
                yield row["id"], positive, found, *column_pair(score)

    return search


def ranked(found: DataFrame, by: list[str], k: int) -> DataFrame:
    order = W.partitionBy(*by).orderBy(F.desc("score"), F.desc("wide"), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def hard_negatives(df: DataFrame, anchors: Column, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                   n_positives: int = 5, n_negatives: int = 3, low: int = 50, high: int = 95, scale: int = 256) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``.

    ``anchors`` is a condition on ``id``. A negative's score is from ``low`` to ``high`` hundredths of the positive's.
    """
    rows = materialise(labelled_vectors(df, id_col, vector_col, label_col, scale), "negative-rows")
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.count(F.when(anchors, 1)).alias("asked"), F.coalesce(F.max("dims"), F.lit(1)).alias("dims")).first()
    pieces = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    blocks = max(-(-size["n"] * max(size["dims"], 1) // BLOCK_VALUES), min(pieces, -(-size["n"] // LEAST_ROWS)), 1)
    groups = max(-(-size["asked"] // GROUP_ANCHORS), 1)
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    # wide rows have blocks of their own, so that the rest stays in 64 bits
    unit = F.xxhash64("dims", "lane", "block", "group")

    def searched(asked: DataFrame, names: list[str], search) -> DataFrame:
        index = rows.withColumns({"lane": F.col("v").isNull(), "block": F.pmod(F.xxhash64("id"), F.lit(blocks))}).withColumn("group", every(groups))
        ask = asked.withColumns({"group": F.pmod(F.xxhash64("id"), F.lit(groups)), "lane": F.explode(F.array(F.lit(False), F.lit(True)))}).withColumn("block", every(blocks))
        both = index.withColumn("asks", F.lit(False)).unionByName(ask.withColumn("asks", F.lit(True)), allowMissingColumns=True)
        both = both.withColumn("unit", unit).drop("lane", "block", "group")
        return both.repartition("unit").sortWithinPartitions("unit", "asks").mapInArrow(scan(names, scale, search), FOUND)

    asked = rows.where(anchors)
    near = ranked(searched(asked, ["id", "label"], positives(n_positives)), ["anchor_id"], n_positives)
    near = materialise(near.select("anchor_id", "id", "score", "wide"), "negative-positives")
    listed = near.groupBy(F.col("anchor_id").alias("id")).agg(F.collect_list(F.struct("id", "score", "wide")).alias("positives"))
    found = searched(asked.join(listed, "id"), ["id", "label", "positives"], negatives(n_negatives, low, high))
    found = ranked(found, ["anchor_id", "positive_id"], n_negatives)
    scores = near.select("anchor_id", F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    return found.join(scores, ["anchor_id", "positive_id"]).select(
        "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
