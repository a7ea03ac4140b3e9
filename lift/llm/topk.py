"""Exact top-k search by inner product over a bit-sliced index.

Components are quantised to integers. A block of rows is kept as bitmaps: for
each component one bitmap per bit of its values (less the block's least value).
A query's scores of all rows of a block come from adding these bitmaps, shifted
by the bits of the query's components, in carry-save form; a negative component
adds the complements. The sum is bit-sliced too, and the best rows are selected
from its most significant slice downward. Rows that tie at the boundary are
resolved exactly, to smaller ids, as rows are in the order of their ids.

Every row is indexed and every score is exact, so there is no recall to measure.
Blocks have a bounded number of rows and queries are dealt out in bounded groups;
each pair of a block and a group is a task's unit of work, and the best rows of
the blocks are merged per query.

Vectors with huge components, whose scores could leave 64 bits, have blocks of
their own. Bitmaps hold integers of any size, so the same steps serve them; only
what is read off the bitmaps is then a whole Python number.

Defined results: vectors that are null, or hold a null or a number that is not
finite, take no part, nor do rows without an id; vectors of different lengths are not compared; of
rows that repeat an id the one with the least vector counts, a huge one last; ties go to the smaller id; a query
with fewer candidates than k returns all; scores beyond 64 bits rank by their true value and are
returned as the nearest long; an empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lift.functions.columns import named
from lift.llm.wide import column_pair, quantised
from lift.sources.shared import materialise

BLOCK_ROWS = 1 << 16
#: Queries that are asked of one copy of a block; and the fewest, if only few blocks are there to keep the cores busy.
GROUP_QUERIES, LEAST_QUERIES = 1 << 14, 256
#: Sizes of integers and numbers of components whose scores fit in 64 bits.
LARGEST, LARGEST_DIMS = float(1 << 24), 1 << 12
#: Rows of a block of huge vectors, which have some thousand bitmaps per component.
HUGE_ROWS = 1 << 12
PARTS = ["ids", "low", "first", "slices"]


def quantise(df: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """``(id, v, x, dims, huge)``: integer vectors ``v`` of the rows that take part, one per id, or the components ``x`` of huge ones."""
    vector = F.transform(named(vector_col), lambda x: x.cast("double"))
    finite = F.forall(vector, lambda x: x.isNotNull() & (F.abs(x) < float("inf")))
    rows = df.where(named(id_col).isNotNull() & named(vector_col).isNotNull() & finite).select(named(id_col).cast("long").alias("id"), vector.alias("x"))
    huge = F.exists("x", lambda x: F.abs(x) > LARGEST / scale) | (F.size("x") > LARGEST_DIMS)
    parts = F.struct(huge.alias("huge"), F.when(~huge, F.transform("x", lambda x: F.floor(x * scale).cast("long"))).alias("v"), F.when(huge, F.col("x")).alias("x"))
    rows = rows.select("id", parts.alias("row")).groupBy("id").agg(F.min("row").alias("row")).select("id", "row.*")
    return rows.withColumn("dims", F.size(F.coalesce("v", "x")))


def pack(bits: np.ndarray) -> np.ndarray:
    """Rows of booleans as bitmaps of 64-bit words."""
    packed = np.packbits(bits, axis=-1, bitorder="little")
    pad = -packed.shape[-1] % 8
    return np.concatenate((packed, np.zeros((*packed.shape[:-1], pad), np.uint8)), axis=-1).view(np.uint64)


class BitSlices:
    """A block's rows as bitmaps, in the order of their ids."""

    def __init__(self, ids: np.ndarray, low: np.ndarray, first: np.ndarray, slices: np.ndarray) -> None:
        self.ids, self.low, self.first = ids, low, first
        self.rows = pack(np.ones((1, len(ids)), np.uint8))[0]
        self.slices = slices.reshape(-1, len(self.rows))
        self.flipped = self.slices ^ self.rows

    @classmethod
    def of(cls, ids: np.ndarray, values: np.ndarray) -> BitSlices:
        """The bitmaps of a block of integer vectors, which may be whole Python numbers."""
        order = np.argsort(ids, kind="stable")
        ids, values = ids[order], values[order]
        low = values.min(axis=0) if values.shape[1] else values[0]
        above = values - low
        depth = [int(x).bit_length() for x in above.max(axis=0)] if values.shape[1] else []
        first = np.concatenate(([0], np.cumsum(depth))).astype(np.int64)
        slices = [pack((above[:, j] >> b & 1).astype(np.uint8)) for j in range(values.shape[1]) for b in range(depth[j])]
        return cls(ids, low, first, np.concatenate(slices) if slices else np.zeros(0, np.uint64))

    def as_bytes(self) -> list[bytes]:
        low = self.low.tobytes() if self.low.dtype == np.int64 else " ".join(str(x) for x in self.low).encode()
        return [self.ids.tobytes(), low, self.first.tobytes(), self.slices.tobytes()]

    @classmethod
    def from_bytes(cls, ids: bytes, low: bytes, first: bytes, slices: bytes, *, huge: bool = False) -> BitSlices:
        least = np.array([int(x) for x in low.split()], object) if huge else np.frombuffer(low, np.int64)
        return cls(np.frombuffer(ids, np.int64), least, np.frombuffer(first, np.int64), np.frombuffer(slices, np.uint64))

    def scores(self, query: np.ndarray) -> tuple[list[np.ndarray], int]:
        """The sum's slices, least first, and what must be added to it."""
        by_weight: list[list[np.ndarray]] = [[]]
        extra = sum(int(x) * int(y) for x, y in zip(query, self.low)) if object in (query.dtype, self.low.dtype) else int((query * self.low).sum())
        for j in np.flatnonzero(query).tolist():
            size, a, b = int(query[j]), int(self.first[j]), int(self.first[j + 1])
            source = self.slices
            if size < 0:  # -n * x = n * (most - x) - n * most
                extra += size * ((1 << (b - a)) - 1)
                size, source = -size, self.flipped
            for shift in range(size.bit_length()):
                if size >> shift & 1:
                    while len(by_weight) < shift + b - a + 1:
                        by_weight.append([])
                    for k in range(a, b):
                        by_weight[shift + k - a].append(source[k])
        total, weight = [], 0
        while weight < len(by_weight):
            bitmaps = by_weight[weight]
            carries: list[np.ndarray] = []
            while len(bitmaps) >= 3:
                x, y, z = bitmaps.pop(), bitmaps.pop(), bitmaps.pop()
                odd = x ^ y
                x = x & y
                x |= odd & z
                odd ^= z
                bitmaps.append(odd)
                carries.append(x)
            if len(bitmaps) == 2:
                x, y = bitmaps
                bitmaps = [x ^ y]
                carries.append(x & y)
            if carries:
                if weight + 1 == len(by_weight):
                    by_weight.append([])
                by_weight[weight + 1] += carries
            total.append(bitmaps[0] if bitmaps else np.zeros_like(self.rows))
            weight += 1
        return total, extra

    def best(self, query: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the ``k`` best rows, without the query's own."""
        total, extra = self.scores(query)
        open_rows = self.rows.copy()
        at = int(np.searchsorted(self.ids, own))
        if at < len(self.ids) and self.ids[at] == own:
            open_rows[at >> 6] &= ~np.uint64(1 << (at & 63))
        sure = np.zeros_like(open_rows)
        need = k  # rows still to be found among the open ones
        for bitmap in reversed(total):
            high = open_rows & bitmap
            count = int(np.bitwise_count(high).sum())
            if count > need:
                open_rows = high
            else:
                sure |= high
                need -= count
                open_rows = open_rows ^ high
                if not need:
                    break
        places = np.flatnonzero(np.unpackbits(sure.view(np.uint8), bitorder="little"))
        if need:  # all open rows have one score: the smaller ids come first
            places = np.concatenate((places, np.flatnonzero(np.unpackbits(open_rows.view(np.uint8), bitorder="little"))[:need]))
        kind = np.int64 if len(total) < 62 and abs(extra) < 1 << 62 else object
        score = np.full(len(places), extra, kind)
        for weight, bitmap in enumerate(total):
            score += (bitmap[places >> 6] >> (places & 63).astype(np.uint64) & np.uint64(1)).astype(kind) << weight
        return self.ids[places], score


def matrix(rows: pa.Table, dims: int, scale: int) -> np.ndarray:
    """The integer vectors of rows that are all huge, or all not."""
    if len(rows) and not rows["v"].null_count:
        flat = rows["v"].combine_chunks().flatten()
        return flat.to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(rows), dims)
    return quantised(rows["x"].to_pylist(), dims, scale)


def search_block(dims: int, huge: bool, index: pa.Table, queries: pa.Table, k: int, scale: int) -> pa.Table:
    rows = index.select(PARTS).to_pylist()
    out: list[tuple[np.ndarray, np.ndarray, list]] = []
    if rows:
        block = BitSlices.from_bytes(*[rows[0][part] for part in PARTS], huge=huge)
        for asked in (queries.filter(queries["huge"]), queries.filter(pa.compute.invert(queries["huge"]))):
            for query, vector in zip(asked["id"].to_pylist(), matrix(asked, dims, scale)):
                found, score = block.best(vector, query, k)
                pairs = [column_pair(x) for x in score.tolist()] if score.dtype == object else list(zip(score.tolist(), [None] * len(score)))
                out.append((np.full(len(found), query, np.int64), found, pairs))
    pairs = [pair for *_, some in out for pair in some]
    columns = [np.concatenate([x[i] for x in out]) if out else np.zeros(0, np.int64) for i in (0, 1)]
    return pa.Table.from_arrays([*map(pa.array, columns), pa.array([x for x, _ in pairs], pa.int64()), pa.array([x for _, x in pairs], pa.binary())], schema=FOUND)


FOUND = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64()), ("wide", pa.binary())])


def top_k(df: DataFrame, queries: Column, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 20, scale: int = 64) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the best rows for each row where ``queries`` holds (a condition on ``id``)."""
    rows = materialise(quantise(df, id_col, vector_col, scale), "topk-rows")
    counts = rows.agg(F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("huge"), 1)).alias("huge"), F.count(F.when(queries, 1)).alias("q")).first()
    own, numbers = F.xxhash64("id"), lambda n: F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long"))
    # blocks of huge vectors are numbered behind the others
    blocks, behind = -(-(counts["n"] - counts["huge"]) // BLOCK_ROWS) or 1, -(-counts["huge"] // HUGE_ROWS)
    wanted = min(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-counts["q"] // LEAST_QUERIES))
    groups = max(-(-counts["q"] // GROUP_QUERIES), -(-wanted // (blocks + behind)), 1)
    block = F.when(F.col("huge"), F.pmod(own, F.lit(max(behind, 1))) + blocks).otherwise(F.pmod(own, F.lit(blocks)))

    def packed(key: tuple, part: pa.Table) -> pa.Table:
        made = BitSlices.of(part["id"].to_numpy(), matrix(part, key[0].as_py(), scale)).as_bytes()
        return pa.table({"dims": [key[0].as_py()], "block": [key[1].as_py()]} | {name: [value] for name, value in zip(PARTS, made)},
                        pa.schema([("dims", pa.int32()), ("block", pa.int64()), *[(name, pa.binary()) for name in PARTS]]))

    index = rows.withColumn("block", block).groupBy("dims", "block").applyInArrow(
        packed, "dims int, block long, " + ", ".join(f"{name} binary" for name in PARTS))
    index = materialise(index, "topk-index").withColumn("group", F.explode(numbers(groups)))
    asked = rows.where(queries).withColumn("group", F.pmod(own, F.lit(groups))).withColumn("block", F.explode(numbers(blocks + behind)))
    keys = ("dims", "block", "group")

    def pair(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        return search_block(key[0].as_py(), key[1].as_py() >= blocks, left, right, k, scale)

    best = index.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInArrow(pair, "query_id long, vec_id long, score long, wide binary")
    order = W.partitionBy("query_id").orderBy(F.desc("score"), F.desc("wide"), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
