"""Even shards by sampled splitters; DataFrame and SQL functions only.

Every row has a key: the hash of its text, the hash of its id, and a number that
tells repeated rows apart. Rows are sampled in proportion to their size, the
sample's quantiles become splitters, and the rows are dealt into ranges of keys.
A range with too many rows or bytes is divided again by splitters of its own: by
the next part of the key if all its texts are one. Running sums within ranges,
and the ranges before, then give every row its exact place among all bytes, and
the place gives the shard. The splitters decide the balance of the work only,
never the result.

A row larger than a 64th of a shard would make shards uneven wherever it lies.
There are fewer than 64 of them per shard, whatever the table; they are dealt
first, the largest to the shard with the least, and the ranges fill up the rest.

Defined results: a null text has no bytes, and the checksum of no bytes; rows
with a null id or a repeated id are rows like others; rows repeated in all they
have may trade places, as no column tells them apart; equal texts are neighbours in
the order, so a group of copies is cut only where a shard ends; an empty table
gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lift.functions.columns import named
from lift.sources.shared import materialise

#: Rows of more than this part of a shard are dealt one by one.
LARGE_SHARE = 64
#: Splitters of a range that is divided again, and the sampled rows per splitter.
SPLITTERS, DRAWS = 64, 64
#: Most ranges the whole table is divided into at once, and most rows of a range.
RANGES, RANGE_ROWS = 4096, 1 << 20
KEY = ("text_hash", "id_hash", "tie")


def hashed(value: Column) -> Column:
    """52 bits, as quantiles are exact to as many."""
    return F.shiftrightunsigned(F.xxhash64(value), 12)


def place(bounds: Column, value: Column, most: int, *, equal: bool) -> Column:
    """How many of the sorted ``bounds`` (at most ``most``) are below ``value``, or equal to it too, by bisection."""
    steps = F.array(*[F.lit(1 << bit) for bit in reversed(range(most.bit_length()))])

    def step(at: Column, size: Column) -> Column:
        bound = F.get(bounds, at + size - 1)
        return F.when(bound <= value if equal else bound < value, at + size).otherwise(at)

    return F.aggregate(steps, F.lit(0), step)


def slot_of(bounds: Column, value: Column, most: int) -> Column:
    """Ranges between the splitters, and one for the rows equal to each splitter."""
    return place(bounds, value, most, equal=False) + place(bounds, value, most, equal=True)


def drawn(rows: DataFrame, bytes_per_draw: Column) -> DataFrame:
    """A sample in proportion to size: each row as often as draws fall on it."""
    chance = F.pmod(F.xxhash64(F.lit(17), *KEY), F.lit(1 << 20)) / float(1 << 20)
    times = F.floor(F.col("size") / bytes_per_draw + chance).cast("int")
    return rows.withColumn("__draws", times).where("__draws > 0").withColumn("__draw", F.explode(F.array_repeat(F.lit(0), F.col("__draws"))))


def quantiles(value: Column, parts: int) -> Column:
    shares = [i / parts for i in range(1, parts)]
    return F.sort_array(F.array_distinct(F.percentile_approx(value, shares, 20 * parts)))


def divided(rows: DataFrame, n: int, size: int) -> DataFrame:
    """``rows`` with the number of their range, ascending in the order of the keys."""
    pieces = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = min(RANGES, max(64, 4 * pieces))
    first = materialise(drawn(rows, F.lit(size / (ranges * DRAWS))).agg(quantiles(F.col(KEY[0]), ranges).alias("bounds")), "shard-splitters")
    rows = rows.withColumn("bounds", first.select("bounds").scalar())
    rows = rows.withColumn("cell", slot_of(F.col("bounds"), F.col(KEY[0]), ranges).cast("long")).drop("bounds")
    full_rows, full_bytes = min(2 * n // ranges + 1, RANGE_ROWS), 2 * size // ranges + 1
    while True:
        differ = [F.min(part) < F.max(part) for part in KEY]
        stats = rows.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("bytes"), F.when(differ[0], 0).when(differ[1], 1).otherwise(2).alias("by"))
        over = materialise(stats.where(((F.col("n") > full_rows) | (F.col("bytes") > full_bytes)) & (F.col("n") > 1)), "shard-overfull")
        if over.isEmpty():
            return rows
        value = F.when(F.col("by") == 0, F.col(KEY[0])).when(F.col("by") == 1, F.col(KEY[1])).otherwise(F.col(KEY[2]))
        sample = drawn(rows.join(over, "cell"), F.col("bytes") / (SPLITTERS * DRAWS))
        cuts = sample.groupBy("cell").agg(F.first("by").alias("by"), quantiles(value, SPLITTERS).alias("bounds"))
        # a range whose rows were all passed over by the sample is cut in two by its least key
        least = rows.join(over, "cell").groupBy("cell").agg(F.first("by").alias("by"), F.array(F.min(value)).alias("least"))
        cuts = least.join(cuts.drop("by"), "cell", "left").select("cell", "by", F.coalesce("bounds", "least").alias("bounds"))
        inner = rows.join(materialise(cuts, "shard-splitters"), "cell", "left")
        rows = materialise(inner.select(
            *[name for name in rows.columns if name != "cell"],
            (F.col("cell") * (2 * SPLITTERS) + F.coalesce(slot_of(F.col("bounds"), value, SPLITTERS), F.lit(0))).alias("cell")), "shard-cells")


def dealt(large: DataFrame, shards: int) -> DataFrame:
    """One row: the large rows, their shards, and the bytes each shard has then; the largest goes first, to the shard with the least."""
    listed = large.agg(F.sort_array(F.collect_list(F.struct((-F.col("size")).alias("less"), *KEY, "id", "text_crc32"))).alias("rows"))

    def give(state: Column, row: Column) -> Column:
        least = F.array_position(state["loads"], F.array_min(state["loads"])).cast("int") - 1
        return F.struct(F.transform(state["loads"], lambda load, i: F.when(i == least, load - row["less"]).otherwise(load)).alias("loads"),
                        F.concat(state["given"], F.array(least)).alias("given"))

    start = F.struct(F.array_repeat(F.lit(0).cast("long"), shards).alias("loads"), F.array().cast("array<int>").alias("given"))
    return listed.select("rows", F.aggregate("rows", start, give).alias("state")).select("rows", "state.loads", "state.given")


def ends(loads: Column, left: int, shards: int) -> Column:
    """Where each shard but the last ends among the bytes that are left: all are filled up to one level, as with water."""
    ordered = F.sort_array(loads)
    levels = F.transform(F.sequence(F.lit(1), F.lit(shards)), lambda k: (
        F.aggregate(F.slice(ordered, F.lit(1), k), F.lit(0).cast("long"), lambda a, x: a + x) + F.lit(left)) / k)
    room = F.transform(loads, lambda load: F.greatest(F.array_min(levels) - load, F.lit(0.0)))
    return F.transform(F.sequence(F.lit(1), F.lit(shards)), lambda k: F.aggregate(F.slice(room, F.lit(1), k), F.lit(0.0), lambda a, x: a + x))


def shard_rows(df: DataFrame, shards: int = 40, id_col: str = "doc_id", text_col: str = "text", overhead: int = 16) -> DataFrame:
    """``(id, size, text_crc32, shard, slot)`` for every row: shards of near equal bytes, slots without gaps from 0.

    A row's size is the bytes of its text plus ``overhead``, at least 1. No shard is further from the mean than a
    64th of it, unless one row alone is larger than a shard.
    """
    text = F.coalesce(named(text_col), F.lit(""))
    rows = materialise(df.select(
        named(id_col).alias("id"), (F.octet_length(text) + overhead).cast("long").alias("size"), F.crc32(text).alias("text_crc32"),
        hashed(text).alias(KEY[0]), hashed(named(id_col)).alias(KEY[1]), F.monotonically_increasing_id().alias(KEY[2])), "shard-rows")
    is_large = lambda total: F.col("size") * (shards * LARGE_SHARE) > F.lit(total)
    total = rows.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("bytes")).first()["bytes"]
    small = rows.where(~is_large(total))
    sums = small.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("size"), F.lit(0)).alias("bytes")).first()

    first = materialise(dealt(rows.where(is_large(total)), shards), "shard-large")
    ahead = first.select(F.explode(F.arrays_zip("rows", "given")).alias("x")).select(
        F.col("x.rows.id").alias("id"), (-F.col("x.rows.less")).alias("size"), F.col("x.rows.text_crc32").alias("text_crc32"),
        F.col("x.given").alias("shard"), *[F.col(f"x.rows.{part}").alias(part) for part in KEY])
    in_shard = W.partitionBy("shard").orderBy(F.desc("size"), *KEY)
    ahead = ahead.select("id", "size", "text_crc32", "shard", (F.row_number().over(in_shard) - 1).cast("long").alias("slot"))
    if not sums["n"]:
        return ahead

    cells = divided(small, sums["n"], sums["bytes"])
    totals = cells.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("bytes"))
    before = W.orderBy("cell").rowsBetween(W.unboundedPreceding, -1)  # some thousands of ranges, or one per million rows
    offsets = totals.select("cell", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("rows_before"),
                            F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("bytes_before"))
    inside = W.partitionBy("cell").orderBy(*KEY)
    ranked = cells.withColumns({"rank": F.row_number().over(inside), "upto": F.sum("size").over(inside.rowsBetween(W.unboundedPreceding, W.currentRow))})
    bounds = materialise(first.select(F.slice(ends(F.col("loads"), sums["bytes"], shards), 1, shards - 1).alias("bounds")), "shard-ends")
    middle = F.col("bytes_before") + F.col("upto") - F.col("size") / 2
    placed = materialise(ranked.join(offsets, "cell").withColumn("bounds", bounds.select("bounds").scalar()).select(
        "id", "size", "text_crc32", place(F.col("bounds"), middle, max(shards - 1, 1), equal=True).alias("shard"),
        (F.col("rows_before") + F.col("rank")).alias("rank")), "shard-placed")
    # one row per shard on either side
    starts = placed.groupBy("shard").agg(F.min("rank").alias("start")).join(ahead.groupBy("shard").agg(F.count(F.lit(1)).alias("taken")), "shard", "left")
    behind = placed.join(F.broadcast(starts), "shard").select(
        "id", "size", "text_crc32", "shard", (F.col("rank") - F.col("start") + F.coalesce("taken", F.lit(0))).alias("slot"))
    return ahead.unionByName(behind)


def sharded_documents(df: DataFrame, shards: int = 40) -> DataFrame:
    """The shards of documents under the law ``bytes``."""
    return shard_rows(df, shards).select(
        F.col("id").alias("doc_id"), "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
