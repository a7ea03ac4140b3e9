"""A fitted forest as flat arrays, and what moving one feature does to its predictions (ML3, ML4)."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lift.sources.shared import fresh_path

#: Pairs of a tree and a row that are walked together.
PAIRS = 1 << 19
WORD = 64


@dataclass
class FlatForest:
    """Nodes of all trees one after the other; a leaf tests feature -1."""

    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    votes: np.ndarray  # class shares of the node's training rows, by class and node

    def walk(self, x: np.ndarray, node: np.ndarray, row: np.ndarray, z: np.ndarray | None = None, moved: np.ndarray | None = None) -> np.ndarray:
        """The leaf that each pair of a node and a row of ``x`` ends in; with ``moved``, a feature for each pair, that one is taken from ``z``."""
        node, live = node.copy(), np.arange(len(node))
        while len(live):
            at = node[live]
            f = self.feature[at]
            inner = np.flatnonzero(f >= 0)
            live, at, f = live[inner], at[inner], f[inner]
            value = x[row[live], f]
            if moved is not None:
                other = np.flatnonzero(moved[live] == f)
                value[other] = z[row[live[other]], f[other]]
            node[live] = np.where(value <= self.threshold[at], self.left[at], self.right[at])
        return node

    def partings(self, x: np.ndarray, z: np.ndarray, node: np.ndarray, row: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The leaf of each pair, and where its way parts once a ``wanted`` feature is taken from ``z``: pairs, features and the nodes behind.

        Up to the first test of the feature that falls out differently both ways are one; a way without such a test ends in the same leaf.
        """
        node, live = node.copy(), np.arange(len(node))
        parted = np.zeros((-(-x.shape[1] // WORD), len(node)), np.uint64)
        found = [(np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0, self.left.dtype))]
        while len(live):
            at = node[live]
            f = self.feature[at]
            inner = np.flatnonzero(f >= 0)
            live, at, f = live[inner], at[inner], f[inner]
            bound, rows = self.threshold[at], row[live]
            down = x[rows, f] <= bound
            part = np.flatnonzero((down != (z[rows, f] <= bound)) & wanted[f])
            word, bit = f[part] // WORD, np.uint64(1) << (f[part] % WORD).astype(np.uint64)
            first = (parted[word, live[part]] & bit) == 0
            part, word, bit = part[first], word[first], bit[first]
            parted[word, live[part]] |= bit
            found.append((live[part], f[part], np.where(down[part], self.right[at[part]], self.left[at[part]])))
            node[live] = np.where(down, self.left[at], self.right[at])
        return node, *[np.concatenate(some) for some in zip(*found)]

    def moved(self, x: np.ndarray, z: np.ndarray, places: Sequence[int]) -> Iterator[tuple[int, np.ndarray]]:
        """The summed votes ``(class, row)`` of the rows ``x`` as they are (place -1), and with one feature at a time taken from ``z``.

        A tree is walked again only for the rows that a test of the feature sends another
        way, and only from that test on. Votes are added tree by tree, as the
        forest itself adds them, so that ties fall the same way.
        """
        n = len(x)
        sums = {f: np.zeros((len(self.votes), n)) for f in (-1, *places)}
        wanted = np.zeros(x.shape[1], bool)
        wanted[list(places)] = True
        step = max(1, PAIRS // max(n, 1))
        for a in range(0, len(self.roots), step):
            roots = self.roots[a:a + step]
            row = np.tile(np.arange(n), len(roots))
            leaf, pairs, features, behind = self.partings(x, z, np.repeat(roots, n), row, wanted)
            other = self.walk(x, behind, row[pairs], z, features)
            votes = self.votes[:, leaf]
            by_tree = votes.reshape(len(self.votes), len(roots), n)
            for f in sums:
                again = np.flatnonzero(features == f)
                changed = pairs[again]
                before = votes[:, changed]
                votes[:, changed] = self.votes[:, other[again]]
                for t in range(len(roots)):
                    sums[f] += by_tree[:, t]
                votes[:, changed] = before
        yield from sums.items()


def flat_forest(spark: SparkSession, model: RandomForestClassificationModel) -> FlatForest:
    """The nodes of a fitted forest, whose features must all be numbers. Their number is bounded by the trees and their depth."""
    path = fresh_path(spark, "forest")
    model.write().save(path)
    nodes = spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*").select(
        "treeID", "id", "leftChild", "rightChild", F.col("split.featureIndex").alias("feature"), F.get("split.leftCategoriesOrThreshold", F.lit(0)).alias("threshold"),
        F.col("split.numCategories").alias("categories"), "impurityStats").orderBy("treeID", "id").toArrow()
    column = lambda name: nodes[name].to_numpy()
    if (column("categories")[column("feature") >= 0] != -1).any():
        raise ValueError("the forest splits on categories")
    tree = column("treeID")
    starts = np.flatnonzero(np.diff(tree, prepend=-1))
    offset = starts[np.cumsum(np.diff(tree, prepend=-1) != 0) - 1]
    counts = nodes["impurityStats"].combine_chunks().flatten().to_numpy().reshape(len(tree), -1)
    total = counts.sum(axis=1, keepdims=True)
    shares = np.divide(counts, total, out=np.zeros_like(counts), where=total != 0)
    return FlatForest(starts, column("feature").astype(np.int32), np.nan_to_num(column("threshold").astype(float)), column("leftChild") + offset,
                      column("rightChild") + offset, np.ascontiguousarray(shares.T))


OUTCOMES = "f int, score double, y int, n long, hits long"


def moved_outcomes(grouped: DataFrame, forest: FlatForest, places: Sequence[int], shifts: Sequence[int]) -> DataFrame:
    """``(f, score, y, n, hits)``: rows and right predictions per moved feature ``f``; for ``f`` -1 also by score and label.

    ``grouped`` has ``(g, h, y, x)``. Inside a group the rows stand in the order of ``h``, and feature ``f`` is moved by
    ``1 + shifts[f] % (size - 1)`` places.
    """
    shared = grouped.sparkSession.sparkContext.broadcast(forest)
    schema = pa.schema([("f", pa.int32()), ("score", pa.float64()), ("y", pa.int32()), ("n", pa.int64()), ("hits", pa.int64())])

    def work(group: pa.Table) -> pa.Table:
        known = shared.value
        group = group.sort_by("h")
        n, y = len(group), group["y"].to_numpy()
        flat = group["x"].combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(float)
        x = flat.reshape(n, len(shifts))
        z = np.column_stack([np.roll(x[:, f], -(1 + shift % (n - 1)) if n > 1 else 0) for f, shift in enumerate(shifts)])
        out = []
        for f, votes in known.moved(x, z, places):
            right = votes.argmax(axis=0) == y
            if f >= 0:
                out.append((f, None, None, n, int(right.sum())))
                continue
            score = votes[1] / votes.sum(axis=0)
            both = np.stack((score, y, right), axis=1)
            for (s, label, hit), times in zip(*[a.tolist() for a in np.unique(both, axis=0, return_counts=True)]):
                out.append((f, s, int(label), times, times * int(hit)))
        return pa.Table.from_pylist([dict(zip(schema.names, row)) for row in out], schema)

    return grouped.groupBy("g").applyInArrow(work, OUTCOMES)
