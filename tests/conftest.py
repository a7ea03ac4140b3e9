from __future__ import annotations

import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    home = tmp_path_factory.mktemp("spark")
    session = (
        SparkSession.builder.master("local[8]").appName("lift-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "6g")
        .config("spark.checkpoint.dir", str(home / "shared"))
        .config("spark.sql.warehouse.dir", str(home / "warehouse"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def pieces(spark):
    """Set the number of shuffle partitions for one test."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    yield lambda n: spark.conf.set("spark.sql.shuffle.partitions", str(n))
    spark.conf.set("spark.sql.shuffle.partitions", before)


def as_tuples(df, *columns):
    return sorted((tuple(row) for row in df.select(*(columns or df.columns)).collect()), key=lambda row: tuple((v is None, v) for v in row))
