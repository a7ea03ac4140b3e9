"""PL1: CSV files into keyed tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import SparkSession

from lift.sources.tables import load_csv


def load_tables(spark: SparkSession, files: Mapping[str, str], primary_key: str | Sequence[str], *, buckets: int | None = None,
                parts: int | None = None) -> None:
    """Upsert one CSV path into each named table; all tables share the key.

    With ``buckets`` every table is bucketed by the key, so that assembling
    them later shuffles nothing. With ``parts`` a later load rewrites only the
    parts of a table that its keys fall into.
    """
    for table, path in files.items():
        load_csv(spark, path, table, primary_key, buckets=buckets, parts=parts)
