"""What the two classifiers share: the held-out fold and the training labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FOLDS = 5


def held_out(doc_id: Column) -> Column:
    """Whether a document is of the fold that no label is learned from: crc32 of its id as text, modulo 5, is 0."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(FOLDS)) == 0, F.lit(False))


def training_labels(labels: DataFrame, column: str) -> DataFrame:
    """(doc_id, label) of the documents that labels may be learned from; the smaller label where rows disagree, nulls left out."""
    rows = labels.filter(F.col(column).isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    return rows.groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(F.min(column).cast("int").alias("label"))
