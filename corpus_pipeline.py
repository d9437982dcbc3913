"""The corpus pipeline: five of the text operators, each stage's result written and read again by the next."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm.common import documents, shared_dir
from tidemark.llm.line_dedup import drop_lines
from tidemark.llm.minhash import drop_near
from tidemark.llm.mixing import repeat_to_targets
from tidemark.llm.quality_rules import keep_good
from tidemark.llm.sentencepieces import tokenized


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the quality rules keep."""
    return keep_good(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that repeat across them."""
    return drop_lines(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return drop_near(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often as the sources' target weights take them."""
    return repeat_to_targets(docs)


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixture's documents as token ids; each text is whole."""
    return tokenized(docs)


STAGES = [
    ("quality rules", quality),
    ("line dedup", lines),
    ("near dedup", near),
    ("mixing", mixture),
    ("sentence pieces", pieces),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; what a stage keeps is a Parquet table in the shared folder.

    Nulls, empty texts, repeated rows and empty tables go through each stage as
    its function says; columns beyond those of documents are carried to the last.
    """
    docs, folder = documents(spark, sf_dir), f"{shared_dir(spark)}/pipeline-{uuid.uuid4()}"
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
    return docs


#: Near duplicates among texts that lost lines, and token ids, are beyond plain SQL; tests hold the stages against brute force.
ORACLE_SQL = None
