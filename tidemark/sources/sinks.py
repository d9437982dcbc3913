"""Sinks: typed Parquet, CSV and JSON, month partitions, the append-only archive."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import exprs
from ..operators import listing


def write_table(df: DataFrame, path: str, keys: list[str] | None = None, order: list[str] | None = None, mode: str = "overwrite", file_rows: int = 5_000_000) -> None:
    """ZSTD Parquet, one folder for each value of keys, rows sorted within files; only partitions that are written are replaced.

    Rebalanced by keys, which splits what is too large for one task: a hot
    folder is several files from several tasks, none of more than file_rows.
    """
    if keys:
        df = df.hint("rebalance", *keys)
    if order:
        df = df.sortWithinPartitions(*(keys or []), *order)
    out = df.write.mode(mode).option("compression", "zstd").option("partitionOverwriteMode", "dynamic").option("maxRecordsPerFile", file_rows)
    (out.partitionBy(*keys) if keys else out).parquet(path)


def write_ordered(df: DataFrame, path: str, order: list[str], kind: str = "parquet", file_rows: int = 5_000_000) -> None:
    """Rows in one order over all files: read by name, one file after the other, they are sorted.

    A range-partitioned sort, in which files follow each other and no task holds all; equal rows are in any order among themselves.
    """
    out = df.sort(*order).write.mode("overwrite").option("maxRecordsPerFile", file_rows)
    (out.option("compression", "zstd") if kind == "parquet" else out).format(kind).save(path)


def write_csv(df: DataFrame, path: str, columns: list[str]) -> None:
    """B2: a fixed header and column order."""
    df.select(*columns).write.mode("overwrite").option("header", "true").csv(path)


def write_json(df: DataFrame, path: str) -> None:
    """JSON lines; null fields are left out."""
    df.write.mode("overwrite").json(path)


def replace_partitions(df: DataFrame, path: str, keys: list[str]) -> None:
    """df laid out by keys, in place of what these partitions held; others stay."""
    df.write.mode("overwrite").option("compression", "zstd").option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(path)


def append_archive(snapshots: DataFrame, path: str, collected: str = "collected_at", batch: int | None = None) -> DataFrame:
    """Snapshots appended by UTC day of collection, given as RFC 3339 text; other columns, such as the raw payload, go with them.

    A batch number makes the append one that can be repeated: a batch's folders
    replace those of the same number. Without one it is its own batch. Returns
    the (year, month, day) of the rows.
    """
    day = exprs.utc_date(exprs.parsed_ms(F.col(collected)))
    rows = snapshots.withColumns({"year": F.substring(day, 1, 4), "month": F.substring(day, 6, 2), "day": F.substring(day, 9, 2)})
    replace_partitions(rows.withColumn("batch", F.lit(uuid.uuid4().hex if batch is None else f"{batch:010}")), path, ["year", "month", "day", "batch"])
    return rows.select("year", "month", "day")


def write_payloads(inputs: DataFrame, path: str, collected: str = "collected_at") -> None:
    """Raw payloads (sha256, content, collected_at) beside the archive, as a table of bytes by UTC day."""
    append_archive(inputs.select("sha256", "content", collected), path, collected)


def write_latest(snapshots: DataFrame, path: str, collected: str = "collected_at", tie: str = "snapshot_id") -> None:
    """The latest snapshot's rows as a table that is replaced as a whole."""
    listing.latest(snapshots, collected, tie).write.mode("overwrite").option("compression", "zstd").parquet(path)
