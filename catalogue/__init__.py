"""Queries over the given tables, one or more per operator, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from catalogue import assembly_queries, evaluate_queries, model_queries, profile_queries, table_queries  # noqa: F401
from catalogue.fixtures import ORACLES, QUERIES


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def all_oracles() -> dict[str, str]:
    return dict(ORACLES)
