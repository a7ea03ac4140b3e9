"""The prefix trie of conversations, rolled up by centroid decomposition.

Every distinct sequence of first turns is a node. A node is known by a digest of
its sequence, later by its smallest conversation and its depth. The digests of
all prefixes are chained inside runs of 64 turns, and the runs' digests again in
the same way, so that no group is larger than a run, however long a conversation.

Totals of subtrees need as many steps as the trie is deep if they are passed from
children to parents; a conversation of a million turns is a chain. So the parent
forest is taken apart at centroids. A centroid of a component is the deepest node
that still has more than half of the component's turns at or below it: without it, what is
left above and each part below has at most half of them. What the component holds at
and below its centroid is totalled and added to the nodes from the centroid up to the
component's top; then the parts are taken apart in the same way. Every node has its whole
subtree's total once all components are single nodes, after as many rounds as the number of turns has binary
digits at most.

Nothing has to be searched in a round. The turns at or below a node are known from the start, as a sum over its
conversations. The nodes from the centroid to the top are the ones with more than half. A node lies
below the centroid if its smallest conversation passes through it, and that
conversation's next node names the part it belongs to. Components of at most some
thousands of nodes are packed into tasks that take them apart in numpy.

Defined results: rows without a conversation id take no part; turns that tie come in the order
of their role, then of a digest of their text, and repeated rows are turns of their own;
null roles and texts are empty; an empty table has no conversations and gives no nodes, not even a
root; other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lift.functions.columns import named
from lift.sources.shared import materialise

#: Turns whose digests are chained in one group; nodes of a component that a task takes apart alone; bytes of a piece of an id list.
RUN, NODES, PIECE = 64, 1 << 15, 1 << 16


def pieces_of(df: DataFrame) -> int:
    return max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def numbered_turns(df: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """``(conv, pos, digest, bytes)``: each turn with its place from 1, its digest and the bytes of its text.

    One sort by ranges, which also split a conversation of any length; texts stay where they are read.
    """
    role_of, text_of = F.coalesce(named(role), F.lit("")), F.coalesce(named(text), F.lit(""))
    framed = F.concat(F.char_length(role_of).cast("string"), F.lit(":"), role_of, text_of)
    turns = df.where(named(conv).isNotNull()).select(
        named(conv).cast("long").alias("conv"), named(turn).alias("turn"), role_of.alias("role"),
        F.unhex(F.substring(F.sha2(framed, 256), 1, 32)).alias("digest"), F.octet_length(text_of).cast("long").alias("bytes"))
    order = [F.asc("conv"), F.asc_nulls_first("turn"), F.asc("role"), F.asc("digest")]
    ranged = turns.repartitionByRange(pieces_of(df), *order).sortWithinPartitions(*order)
    placed = materialise(ranged.select("conv", "digest", "bytes", F.monotonically_increasing_id().alias("at")), "trie-turns")
    # ids ascend within a partition and from one to the next; counts per conversation and partition close the gaps between them
    part = F.shiftright("at", 33)
    spans = placed.groupBy("conv", part.alias("part")).agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    before = W.partitionBy("conv").orderBy("part").rowsBetween(W.unboundedPreceding, -1)  # at most one row per partition
    spans = spans.select(F.col("conv").alias("c"), "part", "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    return placed.join(spans, (F.col("conv") == F.col("c")) & (part == F.col("part"))).select(
        "conv", (F.col("at") - F.col("first") + F.col("before") + 1).alias("pos"), "digest", "bytes")


def rebuilt(turns: DataFrame, head: Column, base: Column) -> tuple[DataFrame, DataFrame]:
    """Conversations whose first turns are those of another: ``(conv, length)``, and their turns ``(conv, depth, digest, bytes)``.

    ``head`` is how many of the first turns conversation ``conv`` takes from conversation ``base`` in place of its own.
    """
    sizes = turns.groupBy("conv").agg(F.count(F.lit(1)).alias("n"))
    convs = sizes.select("conv", "n", head.cast("long").alias("head"), base.cast("long").alias("base"))
    lengths = sizes.select(F.col("conv").alias("b"), F.col("n").alias("base_n"))
    convs = convs.join(lengths, F.col("base") == F.col("b"), "left").select(
        "conv", "head", "base", F.least("head", F.coalesce("base_n", F.lit(0))).alias("taken"), "n")
    convs = materialise(convs.withColumn("length", F.col("taken") + F.greatest(F.col("n") - F.col("head"), F.lit(0))), "trie-conversations")
    own = turns.join(convs.select("conv", "head", "taken"), "conv").where("pos > head").select(
        "conv", (F.col("pos") - F.col("head") + F.col("taken")).alias("depth"), "digest", "bytes")
    heads = turns.withColumnRenamed("conv", "base").join(convs.where("taken > 0").select("conv", "base", "taken"), "base").where("pos <= taken").select(
        "conv", F.col("pos").alias("depth"), "digest", "bytes")
    return convs.select("conv", "length"), own.unionByName(heads)


def chained(values: list[bytes]) -> list[bytes]:
    """Digests of the first 1, 2, 3, ... values."""
    out, state = [], b""
    for value in values:
        state = hashlib.blake2b(state + value, digest_size=16).digest()
        out.append(state)
    return out


def prefix_digests(turns: DataFrame) -> DataFrame:
    """``(conv, depth, bytes, node)``: a digest of all turns up to each one."""

    def chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = [chained(values) for values in batch["digests"].to_pylist()]
            yield pa.RecordBatch.from_arrays([batch["conv"], batch["run"], batch["sizes"], pa.array(lists, pa.list_(pa.binary()))],
                                             ["conv", "run", "sizes", "chain"])

    runs = turns.groupBy("conv", F.floor((F.col("depth") - 1) / RUN).alias("run")).agg(
        F.array_sort(F.collect_list(F.struct("depth", "digest", "bytes"))).alias("turns"))
    runs = runs.select("conv", "run", F.col("turns.digest").alias("digests"), F.col("turns.bytes").alias("sizes"))
    runs = materialise(runs.mapInArrow(chain, "conv long, run long, sizes array<long>, chain array<binary>"), "trie-runs")
    long_ones = runs.where("run > 0").select("conv").distinct()
    flat = runs.select("conv", "run", F.posexplode(F.arrays_zip("sizes", "chain")).alias("i", "x")).select(
        "conv", "run", (F.col("run") * RUN + F.col("i") + 1).alias("depth"), F.col("x.sizes").alias("bytes"), F.col("x.chain").alias("node"))
    if long_ones.isEmpty():
        return flat.drop("run")
    # the digests of whole runs are chained in their turn, and each run starts from what is before it
    ends = runs.join(long_ones, "conv", "left_semi").select(
        "conv", (F.col("run") + 1).alias("depth"), F.element_at("chain", -1).alias("digest"), F.lit(0).cast("long").alias("bytes"))
    before = prefix_digests(ends).select("conv", F.col("depth").alias("run"), F.col("node").alias("before"))
    continued = F.unhex(F.substring(F.sha2(F.concat("before", "node"), 256), 1, 32))
    later = flat.where("run > 0").join(before, ["conv", "run"]).withColumn("node", continued)
    return flat.where("run = 0").drop("run").unionByName(later.drop("run", "before"))


def end_digests(ends: DataFrame) -> DataFrame:
    """``(node, ends_sha256)``: the digest of all ids of a node, ascending, joined by commas.

    Ids are sorted by ranges of (node, id) and joined to pieces of bounded size, wherever a node's ids lie; then one
    pass per node reads its few pieces in order. A digest is a chain by its nature, but of a few bytes an id.
    """

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, first, ids, size = None, None, [], 0

        def piece() -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([{"node": node, "first": first, "ids": ",".join(ids).encode()}], made)

        for batch in batches:
            for key, conv in zip(batch["node"].to_pylist(), batch["conv"].to_pylist()):
                if ids and (key != node or size > PIECE):
                    yield piece()
                    ids, size = [], 0
                if not ids:
                    node, first = key, conv
                ids.append(str(conv))
                size += len(ids[-1]) + 1
        if ids:
            yield piece()

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state = None, None
        for batch in batches:
            out = []
            for key, ids in zip(batch["node"].to_pylist(), batch["ids"].to_pylist()):
                if key != node:
                    if state:
                        out.append({"node": node, "ends_sha256": state.hexdigest()})
                    node, state = key, hashlib.sha256(ids)
                else:
                    state.update(b"," + ids)
            yield pa.RecordBatch.from_pylist(out, hashed)
        if state:
            yield pa.RecordBatch.from_pylist([{"node": node, "ends_sha256": state.hexdigest()}], hashed)

    made = pa.schema([("node", pa.binary()), ("first", pa.int64()), ("ids", pa.binary())])
    hashed = pa.schema([("node", pa.binary()), ("ends_sha256", pa.string())])
    ranged = ends.repartitionByRange(pieces_of(ends), "node", "conv").sortWithinPartitions("node", "conv")
    pieces = ranged.mapInArrow(joined, "node binary, first long, ids binary")
    return pieces.repartition("node").sortWithinPartitions("node", "first").mapInArrow(digests, "node binary, ends_sha256 string")


def roots(up: np.ndarray) -> np.ndarray:
    """The top of every node, by doubling: each node points to the one its pointer points to."""
    while True:
        further = up[up]
        if np.array_equal(further, up):
            return up
        up = further


def take_apart(up: np.ndarray, weight: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Subtree totals of a forest by centroid decomposition; tops point to themselves, ``weight`` has what is at or below a node.

    All components go through a round together.
    """
    n = len(up)
    up, weight, totals, alive = up.copy(), weight.copy(), np.zeros_like(values), np.ones(n, bool)
    parent = up.copy()
    while alive.any():
        top = roots(up)
        half_up = alive & (2 * weight > weight[top])  # from the centroid to the top
        least = np.full(n, np.iinfo(np.int64).max)
        np.minimum.at(least, top[half_up], weight[half_up])
        centroid = half_up & (weight == least[top])
        of = np.zeros(n, np.int64)
        of[top[centroid]] = np.flatnonzero(centroid)
        cut = np.where(centroid, np.arange(n), up)
        below = roots(cut)
        inside = alive & centroid[below]
        sums = np.zeros_like(values)
        np.add.at(sums, below[inside], values[inside])
        totals[half_up] += sums[of[top[half_up]]]
        above = half_up & ~centroid
        weight[above] -= weight[of[top[above]]]
        alive &= ~centroid
        # the centroid's children are tops now
        up = np.where(centroid | centroid[parent], np.arange(n), up)
    return totals


def rolled_up_in_tasks(small: DataFrame, values: list[str]) -> DataFrame:
    """``(conv, depth, part_<value>)``: totals inside components that are small, many components to a task."""
    count = small.count()
    if not count:
        return small.select("conv", "depth", *[F.col(v).alias(f"part_{v}") for v in values])
    tasks = max(1, -(-count // NODES))
    schema = pa.schema([("conv", pa.int64()), ("depth", pa.int64()), *[(f"part_{v}", pa.int64()) for v in values]])

    def work(part: pa.Table) -> pa.Table:
        conv, depth, above = (part[c].to_numpy() for c in ("conv", "depth", "parent"))
        order = np.lexsort((depth, conv))
        keys = np.stack((conv[order], depth[order]), axis=1)
        places = {tuple(key): i for i, key in enumerate(keys.tolist())}
        up = np.arange(len(order))
        for i, (p, d, top) in enumerate(zip(above[order].tolist(), (depth[order] - 1).tolist(), part["is_top"].to_numpy(zero_copy_only=False)[order].tolist())):
            if not top:
                up[i] = places[(p, d)]
        totals = take_apart(up, part["weight"].to_numpy()[order], np.stack([part[v].to_numpy()[order] for v in values], axis=1))
        return pa.Table.from_arrays([pa.array(x) for x in (keys[:, 0], keys[:, 1], *totals.T)], schema=schema)

    packed = small.withColumn("task", F.pmod(F.xxhash64("top_conv", "top_depth"), F.lit(tasks)))
    packed = packed.withColumn("is_top", (F.col("conv") == F.col("top_conv")) & (F.col("depth") == F.col("top_depth")))
    return packed.groupBy("task").applyInArrow(work, "conv long, depth long, " + ", ".join(f"part_{v} long" for v in values))


def rolled_up(nodes: DataFrame, paths: DataFrame, values: list[str], most_nodes: int = NODES) -> DataFrame:
    """``(conv, depth, <value>)``: for every node the totals of ``values`` over its subtree.

    ``nodes`` has ``(conv, depth, parent, weight, top_conv, top_depth)`` and the values: a node is known by its smallest
    conversation and its depth, its parent by ``parent`` and one depth less; ``weight`` is the number of turns at or below
    it; the last two name its tree's root. ``paths`` has ``(conv, depth, node, parent)``: the smallest conversations of the node that
    ``conv`` is at after ``depth`` turns, and of that node's parent.
    """
    current = nodes
    component = ["top_conv", "top_depth"]
    shares: list[DataFrame] = []  # what each round adds to which nodes

    while True:
        sizes = current.groupBy(*component).agg(F.count(F.lit(1)).alias("size"), F.max("weight").alias("whole"))
        sized = current.join(sizes, component)
        small = sized.where(F.col("size") <= most_nodes).drop("size", "whole")
        shares.append(materialise(rolled_up_in_tasks(small, values), "trie-totals"))
        large = materialise(sized.where(F.col("size") > most_nodes).drop("size"), "trie-large")
        if large.isEmpty():
            break
        half_up = F.col("weight") * 2 > F.col("whole")
        centroids = large.where(half_up).groupBy(*component).agg(F.min(F.struct("weight", "conv", "depth")).alias("c")).select(
            *component, F.col("c.conv").alias("c_conv"), F.col("c.depth").alias("c_depth"), F.col("c.weight").alias("c_weight"))
        centroids = materialise(centroids, "trie-centroids")
        marked = large.join(centroids, component)
        # the node after the centroid's depth on the way of the node's smallest conversation, if that passes through the centroid
        at = paths.select(F.col("conv").alias("p_conv"), F.col("depth").alias("p_depth"), F.col("node").alias("p_node"), F.col("parent").alias("p_parent"))
        marked = marked.join(at, (F.col("conv") == F.col("p_conv")) & (F.col("c_depth") + 1 == F.col("p_depth")), "left")
        itself = (F.col("conv") == F.col("c_conv")) & (F.col("depth") == F.col("c_depth"))
        below = (F.col("depth") > F.col("c_depth")) & F.coalesce(F.col("p_parent") == F.col("c_conv"), F.lit(False))
        marked = marked.withColumns({"itself": itself, "below": below, "half_up": half_up}).drop("p_conv", "p_depth", "p_parent")
        marked = materialise(marked, "trie-parts")
        sums = marked.where("itself or below").groupBy(*component).agg(*[F.sum(v).alias(f"part_{v}") for v in values])
        shares.append(materialise(marked.where("half_up").select("conv", "depth", *component).join(sums, component).select(
            "conv", "depth", *[f"part_{v}" for v in values]), "trie-totals"))
        kept = marked.where("not itself")
        current = kept.select(
            "conv", "depth", "parent", F.when(F.col("half_up"), F.col("weight") - F.col("c_weight")).otherwise(F.col("weight")).alias("weight"), *values,
            F.when(F.col("below"), F.col("p_node")).otherwise(F.col("top_conv")).alias("top_conv"),
            F.when(F.col("below"), F.col("c_depth") + 1).otherwise(F.col("top_depth")).alias("top_depth"))

    added = shares[0]
    for more in shares[1:]:
        added = added.unionByName(more)
    return added.groupBy("conv", "depth").agg(*[F.sum(f"part_{v}").alias(v) for v in values])


def prefix_trie(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
                head: Column | None = None, base: Column | None = None, most_nodes: int = NODES) -> DataFrame:
    """One row per node: ``(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256)``.

    ``head`` and ``base`` are columns of ``conv`` (see ``rebuilt``); without them conversations stay as they are.
    """
    turns = materialise(numbered_turns(df, conv_col, turn_col, role_col, text_col), "trie-numbered")
    convs, turns = rebuilt(turns, F.lit(0) if head is None else head, F.col("conv") if base is None else base)
    none = F.lit(b"").cast("binary")
    at_root = convs.select("conv", F.lit(0).cast("long").alias("depth"), F.lit(0).cast("long").alias("bytes"), none.alias("node"))
    rows = materialise(prefix_digests(turns).select("conv", "depth", "bytes", "node").unionByName(at_root).join(convs, "conv"), "trie-prefixes")

    # a node's turns at or below it: each conversation has as many as it has turns from here on, this one included
    nodes = rows.groupBy("depth", "node").agg(
        F.min("conv").alias("rep"), F.count(F.lit(1)).alias("n_convs"), F.first("bytes").alias("bytes"), F.sum(F.col("length") - F.col("depth") + 1).alias("weight"))
    nodes = materialise(nodes, "trie-nodes")
    root = nodes.agg(F.min("rep").alias("rep")).first()["rep"]
    names = nodes.select(F.col("depth").alias("d"), F.col("node").alias("key"), "rep")
    paths = rows.select("conv", "depth", "node").join(names, (F.col("depth") == F.col("d")) & (F.col("node") == F.col("key")))
    paths = paths.select("conv", "depth", F.col("rep").alias("node"))
    # only the ways of conversations that are the smallest of some node are looked up, each with the parent's name
    paths = materialise(paths.join(nodes.select(F.col("rep").alias("conv")).distinct(), "conv", "left_semi"), "trie-ways")
    before = paths.select("conv", (F.col("depth") + 1).alias("depth"), F.col("node").alias("parent"))
    paths = materialise(paths.join(before, ["conv", "depth"], "left"), "trie-paths")

    tree = nodes.withColumnRenamed("rep", "conv").join(paths.select("conv", "depth", "parent"), ["conv", "depth"])
    children = paths.where("node = conv and parent is not null").groupBy(F.col("parent").alias("conv"), (F.col("depth") - 1).alias("depth")).agg(
        F.count(F.lit(1)).alias("n_children"))
    tree = tree.join(children, ["conv", "depth"], "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long")))
    tree = tree.withColumns({
        "top_conv": F.lit(root).cast("long"), "top_depth": F.lit(0).cast("long"),
        "n_leaves": (F.col("n_children") == 0).cast("long"), "saved_tokens": (F.col("n_convs") - 1) * F.col("bytes")})
    tree = materialise(tree, "trie-tree")
    if tree.isEmpty():
        return tree.select(F.col("conv").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves",
                           "saved_tokens", F.lit("").alias("ends_sha256"))
    summed = ["n_leaves", "saved_tokens"]
    totals = rolled_up(tree.select("conv", "depth", "parent", "weight", "top_conv", "top_depth", *summed), paths, summed, most_nodes)
    ends = end_digests(rows.where("depth = length").select(F.concat(F.lpad(F.hex("depth"), 16, "0").cast("binary"), "node").alias("node"), "conv"))
    ends = ends.withColumnRenamed("node", "end_node")
    key = F.concat(F.lpad(F.hex("depth"), 16, "0").cast("binary"), "node")
    result = tree.drop("n_leaves", "saved_tokens").withColumn("end_key", key).join(ends, F.col("end_key") == F.col("end_node"), "left").join(totals, ["conv", "depth"])
    return result.select(
        F.col("conv").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"))


def shared_conversations(df: DataFrame) -> DataFrame:
    """The trie of conversations that begin with up to 8 turns of the first of their five."""
    conv = F.col("conv")
    return prefix_trie(df, head=F.crc32(conv.cast("string")) % 9, base=conv - conv % 5)
