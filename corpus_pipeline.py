"""From raw documents to token ids: five stages, each one operator over all rows that its predecessor kept.

Every stage is a function of the session, the documents so far and the folder of
the given tables. It returns a DataFrame, which is written as Parquet and read
again as the next one's documents; all but the last return the columns of
documents. The operators are in ``lift.llm``.

In every stage a null text counts as an empty one (and stays null), further columns come
through as they are whatever their names, and an empty table gives an empty one.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from lift.llm.decontaminate import clean_documents
from lift.llm.pieces import token_digests
from lift.llm.queries import vocabulary
from lift.llm.secret_scan import redact
from lift.llm.simhash import near_copies, one_of_each
from lift.llm.toxicity import accepted, learn
from lift.sources.shared import remove, scratch, shared_folder


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score reaches the threshold of their language go.

    Repeated rows, and empty and null texts, are scored like others; a null language has the common threshold. Without
    labels of both kinds all documents have one score, and stay unless every label is toxic.
    """
    return accepted(docs, learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id stays.

    Texts without words are copies of each other. Of rows that repeat an id one stays. Rows without an id have
    no name to be dropped by and stay.
    """
    return one_of_each(docs, "doc_id", lambda df: near_copies(df, words=3, max_bits=2))


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a passage of a benchmark item go; empty and null texts have none, and repeated rows go or stay together."""
    return clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Live secrets are masked; all documents stay, repeated rows each with the same text."""
    return redact(docs)


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token ids of every document, and digests of them and of the text they decode to; an empty or null text has no ids."""
    return token_digests(docs, vocabulary(), with_ids=True)


STAGES = [
    ("toxicity", toxicity),
    ("simhash_near_dedup", simhash_near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("secret_scans", secret_scans),
    ("sentencepiece", sentencepiece),
]

#: SQL has no convolutional classifier and no piece encoder; the tests compare with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``. A stage's own tables go when it is written, and its input when the next one is."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    *first, (_, last) = STAGES
    for name, stage in first:
        path = f"{shared_folder(spark)}/lift/pipeline-{name}-{uuid.uuid4().hex}"
        with scratch(spark, f"pipeline-{name}"):
            made = stage(spark, docs, sf_dir)
            made.write.parquet(path)
        if before is not None:
            remove(spark, before)
        docs, before = spark.read.schema(made.schema).parquet(path), path
    return last(spark, docs, sf_dir)
