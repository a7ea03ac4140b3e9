"""Row-wise work on Arrow batches, with memory bounded by bytes and not by rows."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lift.functions.columns import named

#: Bytes of text a task looks at together; one longer text is one slice.
SLICE_BYTES = 4 << 20


def id_and_text(df: DataFrame, id_col: str, text_col: str, *more: str) -> DataFrame:
    """The id, the text (null: empty) as ``text``, and more columns: all that an operator reads."""
    return df.select(named(id_col), F.coalesce(named(text_col), F.lit("")).alias("text"), *[named(name) for name in more])


def held_out(id_col: Column) -> Column:
    """The rows no model learns from: a quarter of the ids by their checksum. A null id counts as not held out."""
    return F.coalesce(F.pmod(F.crc32(id_col.cast("string")), F.lit(4)) == 2, F.lit(False))


def may_learn(id_col: Column) -> Column:
    """Rows with an id that are not held out."""
    return id_col.isNotNull() & ~held_out(id_col)


def slices(batch: pa.RecordBatch, column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows with about ``limit`` bytes of text each."""
    texts = batch.column(column)
    begin = held = 0
    for row, size in enumerate(pa.compute.binary_length(texts).to_pylist()):
        if held and held + (size or 0) > limit:
            yield batch.slice(begin, row - begin)
            begin, held = row, 0
        held += (size or 0) + 1
    if begin < batch.num_rows:
        yield batch.slice(begin)


def utf8(column: pa.Array) -> list[bytes]:
    """The texts as bytes (null: empty)."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return [value or b"" for value in column.cast(kind).to_pylist()]


def strings(column: pa.Array) -> list[str]:
    """The texts (null: empty)."""
    return [value or "" for value in column.to_pylist()]


def map_slices(df: DataFrame, work: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str, text: str = "text") -> DataFrame:
    """Apply ``work`` to every slice of rows; ``work`` may return any number of rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text):
                yield work(part)

    return df.mapInArrow(run, schema)


def type_of(df: DataFrame, name: str) -> str:
    return df.schema[name].dataType.simpleString()


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"
