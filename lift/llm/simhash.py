"""Near copies by SimHash: fingerprints, links of few differing bits, and their groups.

Two fingerprints of eight bytes that differ in at most two bits share at least
six positional bytes. The inverted index therefore posts every fingerprint under
sets of four (position, byte) pairs, chosen so that any six shared bytes hold at
least one set whole. Candidates from a posting list get their shared positional
bytes tallied; those that reach the guaranteed six are verified bit by bit. An
index of single bytes would have lists of one 256th of all fingerprints; lists
of four bytes stay short.

A list longer than ``list_length`` is not paired. Its members are linked exactly
through their neighbourhoods instead: fingerprints at distance two or less have
a common point at distance one or less of both, and all that share such a point
are within two bits of each other, so a star of links loses nothing.

Defined results: a null or empty text, and one without words, has fingerprint
zero and is linked like any other; repeated rows get one result row each; a null
id never becomes a component's id unless no other id is in it; an empty table
gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lift.functions.columns import named
from lift.llm.batches import id_and_text, map_slices, quoted, type_of, utf8
from lift.llm.components import component_map
from lift.sources.shared import materialise

BYTES = 8
#: Any two positions lie outside at least one of these sets: two of four runs of two bytes.
POSITION_SETS = tuple(tuple(x for run in runs for x in (2 * run, 2 * run + 1)) for runs in combinations(range(4), 2))


def fingerprint(text: bytes, words: int, seed: int = 42) -> int:
    """Bit b is set if more than half of the shingles' hashes have it."""
    found = text.lower().split()  # bytes: only A-Z are lowered, only ASCII white space divides
    if not found:
        return 0
    joined = b" ".join(found)
    if len(found) <= words:
        hashes = np.array([xxhash.xxh64_intdigest(joined, seed)], np.uint64)
    else:
        ends = np.cumsum([len(word) + 1 for word in found]) - 1
        begins = np.concatenate(([0], ends[:-1] + 1))
        digest, view = xxhash.xxh64_intdigest, memoryview(joined)
        hashes = np.fromiter((digest(view[a:b], seed) for a, b in zip(begins[: len(found) - words + 1].tolist(), ends[words - 1 :].tolist())),
                             np.uint64, len(found) - words + 1)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):  # little-endian bytes, so bit 0 comes first
        bits = np.unpackbits(hashes[at : at + (1 << 16)].view(np.uint8).reshape(-1, BYTES), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(df: DataFrame, id_col: str, text_col: str, words: int) -> DataFrame:
    """``(id, fp)`` for every row; ``fp`` is the 64 bits as a signed long."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        values = np.array([fingerprint(text, words) for text in utf8(batch.column("text"))], np.uint64).view(np.int64)
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(values)], ["id", "fp"])

    narrow = id_and_text(df, id_col, text_col)
    return map_slices(narrow, work, f"id {type_of(df, id_col)}, fp long")


def byte_at(fp: Column, position: int) -> Column:
    return F.shiftrightunsigned(fp, 8 * position).bitwiseAND(F.lit(255))


def shared_bytes(left: Column, right: Column) -> Column:
    """The tally: in how many positions two fingerprints have the same byte."""
    return sum((byte_at(left, i) == byte_at(right, i)).cast("int") for i in range(BYTES))


def postings(distinct: DataFrame) -> DataFrame:
    """``(list_no, bytes, fp)``: each fingerprint under every set of four positional bytes."""

    def key(positions: tuple[int, ...]) -> Column:
        return sum((F.shiftleft(byte_at(F.col("fp"), p), 8 * i) for i, p in enumerate(positions)), F.lit(0).cast("long"))

    keys = F.array(*[F.struct(F.lit(i).alias("list_no"), key(p).alias("bytes")) for i, p in enumerate(POSITION_SETS)])
    return distinct.select("fp", F.explode(keys).alias("k")).select("k.list_no", "k.bytes", "fp")


def links(distinct: DataFrame, max_bits: int, list_length: int) -> DataFrame:
    """``(a, b)`` pairs of different fingerprints that keep exactly the components of all links.

    Every pair from a short posting list that passes the check is there; members
    of long lists are joined by stars.
    """
    if not 0 <= max_bits <= 2:
        raise ValueError("the index is laid out for at most two differing bits")
    least = BYTES - max_bits
    index = materialise(postings(distinct), "simhash-index")
    sizes = index.groupBy("list_no", "bytes").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    sizes = materialise(sizes, "simhash-lists")
    short = index.join(sizes.where(F.col("n") <= list_length).select("list_no", "bytes"), ["list_no", "bytes"])
    listed = short.groupBy("list_no", "bytes").agg(F.sort_array(F.collect_list("fp")).alias("fps"))  # list_length members at most
    pairs = listed.select("fps", F.posexplode("fps").alias("at", "a")).select("a", F.explode(F.slice("fps", F.col("at") + 2, F.lit(list_length))).alias("b"))
    a, b = F.col("a"), F.col("b")
    pairs = pairs.where((shared_bytes(a, b) >= least) & (F.bit_count(a.bitwiseXOR(b)) <= max_bits)).distinct()
    long_lists = sizes.where(F.col("n") > list_length).select("list_no", "bytes")
    crowded = index.join(long_lists, ["list_no", "bytes"], "left_semi").select("fp").distinct()
    return pairs.unionByName(stars(crowded, max_bits))


def stars(crowded: DataFrame, max_bits: int) -> DataFrame:
    """Links between fingerprints through common points near both, one per fingerprint and point."""
    if max_bits == 0:
        return crowded.select(F.col("fp").alias("a"), F.col("fp").alias("b")).where("a <> b")
    near = F.concat(F.array("fp"), *[F.array(*[F.col("fp").bitwiseXOR(F.lit(-(1 << 63) if bit == 63 else 1 << bit).cast("long")) for bit in range(64)])])
    if max_bits == 1:  # a fingerprint and the points one bit off: the pair itself is the common point
        own = crowded.select(F.col("fp").alias("a"), F.explode(near).alias("b"))
        return own.where("a < b").join(crowded.select(F.col("fp").alias("b")), "b").select("a", "b")
    around = crowded.select("fp", F.explode(near).alias("point"))
    centre = around.groupBy("point").agg(F.min("fp").alias("a"), F.count(F.lit(1)).alias("n")).where("n > 1").select("point", "a")
    return around.join(centre, "point").where("a <> fp").select("a", F.col("fp").alias("b")).distinct()


def near_copies(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3, max_bits: int = 2,
                list_length: int = 64) -> DataFrame:
    """``(id, fingerprint, component_id)`` for every row."""
    prints = materialise(fingerprints(df, id_col, text_col, words), "simhash-prints")
    distinct = materialise(prints.groupBy("fp").agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("n")), "simhash-distinct")
    joined = component_map(links(distinct.select("fp"), max_bits, list_length).select("a", "b"))
    groups = distinct.join(joined.select(F.col("v").alias("fp"), "component"), "fp", "left")
    # a fingerprint without links is a group of its own; it needs no component
    merged = groups.where("component is not null")
    least = merged.groupBy("component").agg(F.min("least").alias("first"))
    named_groups = merged.join(least, "component").select("fp", F.col("first").alias("component_id")).unionByName(
        groups.where("component is null").select("fp", F.col("least").alias("component_id")))
    return prints.join(named_groups, "fp", "left").select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def one_of_each(df: DataFrame, id_col: str, copies: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The rows of ``df`` that name their group.

    Rows that repeat an id are reduced to one of them; rows without an id have no
    name to be dropped by and stay.
    """
    found = copies(df).where(F.col(quoted(id_col)).isNotNull()).groupBy(F.col(quoted(id_col)).alias("__lift_id")).agg(
        F.count(F.lit(1)).alias("__lift_n"), F.max(F.col("component_id") == named(id_col)).alias("__lift_own"))
    kept = materialise(found.where("__lift_own").drop("__lift_own"), "simhash-kept")
    columns = [named(name) for name in df.columns]

    def rows(which: DataFrame) -> DataFrame:
        return df.join(which, named(id_col) == F.col("__lift_id")).select(*columns)

    repeated = kept.where("__lift_n > 1")
    result = rows(kept.where("__lift_n = 1")).unionByName(df.where(named(id_col).isNull()))
    return result if repeated.isEmpty() else result.unionByName(rows(repeated).dropDuplicates([id_col]))
