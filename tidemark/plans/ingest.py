"""Ingest from landed files, end to end: candles (J1), derivatives (J2) and sentiment."""

from __future__ import annotations

import uuid

from pyspark import Accumulator
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import exprs as X
from ..functions.lineage import cut, shared_dir
from ..operators import series, storage
from ..sources import readers, sinks

MARKETS = ("futures-um", "futures-cm", "spot")
SERIES = ["market", "interval", "symbol", "year", "month", "period"]


def _objects(spark: SparkSession, out: str, market: str, interval: str) -> DataFrame:
    """(path) of the objects that a candle table holds, as keys of the plan, from its folders: no row is read."""
    try:
        there = readers.read_files(spark, out)
    except Exception as e:  # nothing written so far
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], "path string")
    part = lambda c: F.regexp_extract("path", f"/{c}=([^/]+)/", 1)
    mine = there.filter((part("market") == market) & (part("interval") == interval)).select(part("symbol").alias("symbol"), part("period").alias("period")).distinct()
    return mine.select(X.candle_key(F.lit(market), F.lit(interval), F.col("symbol"), F.col("period")).alias("path"))


def stage(archives: DataFrame, reads: Accumulator | None = None) -> DataFrame:
    """The candles of archives(path, expected) as a table of the shared folder: each archive is read and unzipped once, for judging and for publishing."""
    spark = archives.sparkSession
    n = archives.count()
    folder = f"{shared_dir(spark)}/staging-{uuid.uuid4()}"
    readers.read_archives(archives.repartition(max(1, min(n, MOST_TASKS)), "path"), report=True, reads=reads).write.option("compression", "zstd").parquet(folder)
    return spark.read.parquet(folder)


def judge(staged: DataFrame) -> DataFrame:
    """(path, row_count, error, status) of every archive staged."""
    stats = staged.groupBy("path").agg(F.count("open_time_ms").alias("row_count"), F.min("open_time_ms").alias("lo"), F.max("open_time_ms").alias("hi"), F.max("error").alias("error"))
    return series.object_status(stats, "lo", "hi").select("path", "row_count", "error", "status")


def publish(staged: DataFrame, judged: DataFrame, out: str, market: str) -> None:
    """Writes the objects that passed, a folder for each, in place of what it held; the others stay out."""
    good = staged.join(judged.filter("error is null and status = 'PASS'").select("path"), "path", "left_semi").drop("path", "error")
    made = series.month_partitions(good.withColumns({"market": F.lit(market), "source_date": F.lit(None).cast("string")}), ["symbol"], "open_time_ms")
    sinks.write_table(made, out, SERIES, ["open_time_ms"])


def ingest_candles(
    spark: SparkSession, landed: str, out: str, symbols: list[str], start: str, end: str, market: str, interval: str,
    unit: str = "month", verify: bool = True, policy: str = "skip", reads: Accumulator | None = None,
) -> DataFrame:
    """Plan, checksums, unzip, casts, validation, partitioned write; one row for each planned object with its state.

    landed holds `SYMBOL-interval-period.zip` archives and their .CHECKSUM files.
    States: WRITTEN, SKIP_EXISTING, PLANNED (policy dry-run), MISSING,
    FAILED_CHECKSUM, FAILED_ARCHIVE (no or another member, a bad cell),
    FAILED_VALIDATION (no rows or times out of range). A failed object leaves the
    others alone; policies are those of storage.apply_policy. Archives are staged,
    the staged table is judged, and what passes is published: a run that fails
    between leaves the table as it was, and its repetition ends in the same one.
    """
    if market not in MARKETS or not symbols or not interval or "/" in interval or "\\" in interval:
        raise ValueError(f"market {market}, interval {interval}, symbols {symbols}")
    names = [s.strip().upper() for s in symbols]
    if not all(names) or any(c in s for s in names for c in "/\\ \t\n\r"):
        raise ValueError(f"symbols {symbols}")
    wanted = spark.createDataFrame([(s,) for s in names], "symbol string")
    plan = storage.ingest_plan(wanted, storage.expand_periods(spark, start, end, unit), _objects(spark, out, market, interval), market, interval)
    plan = storage.apply_policy(plan, policy)
    if policy == "dry-run":
        return plan.select("key", "symbol", "period", "state", F.lit(None).cast("bigint").alias("row_count"))
    name = F.concat("symbol", F.lit("-"), F.lit(interval), F.lit("-"), "period", F.lit(".zip"))
    there = readers.read_files(spark, landed, "*.zip").select("path", X.basename(F.col("path")).alias("__name"))
    # The plan as it is now, as what is written below changes what is there.
    found = cut(plan.join(there, name == F.col("__name"), "left").drop("__name"))
    archives = found.filter("state = 'FETCH' and path is not null").select("path")
    if verify:
        said = readers.read_checksums(spark, landed).select(readers.same_file(F.col("path")).alias("__p"), "expected")
        archives = archives.join(said, readers.same_file(F.col("path")) == F.col("__p"), "left").drop("__p")
    staged = stage(archives, reads)
    judged = cut(judge(staged))
    publish(staged, judged, out, market)
    done, checksum = found.join(judged, "path", "left"), F.coalesce(F.col("error") == "checksum", F.lit(False))
    state = (
        F.when(F.col("state") != "FETCH", F.col("state")).when(F.col("path").isNull(), "MISSING").when(checksum, "FAILED_CHECKSUM")
        .when(F.col("error").isNotNull(), "FAILED_ARCHIVE").when(F.coalesce("status", F.lit("FAIL")) == "FAIL", "FAILED_VALIDATION").otherwise("WRITTEN")
    )
    return done.select("key", "symbol", "period", state.alias("state"), F.when(~checksum, F.col("row_count")).alias("row_count"))


#: Tasks that archives are dealt to, at most.
MOST_TASKS = 10_000
SENTIMENT_SERIES = ["kind", "source", "dataset", "scope", "interval"]


def ingest_sentiment(spark: SparkSession, landed: str, out: str, lo: int, hi: int, source: str = "alternative_me", dataset: str = "fear_greed") -> DataFrame:
    """Landed JSON to a table by month and one row, the series' manifest: rows, objects, range, keys, status and first broken rule.

    Items are taken in the order of the files by path and of their places in
    them, the first of each day wins (F6), and those with event times in [lo, hi]
    count. A series with a broken rule or without rows is FAIL and nothing of it is written.
    """
    items = readers.read_sentiment_json(spark, landed)
    keyed = items.withColumns({"kind": F.lit("sentiment"), "source": F.lit(source), "dataset": F.lit(dataset), "scope": F.lit("global"), "interval": F.lit("1d")})
    rows = cut(series.normalize_sentiment(keyed, SENTIMENT_SERIES, "event_time_ms", ["path", "position"], F.col("score"), F.col("label"), lo, hi))
    part = F.floor(F.col("event_time_ms") / series.PART_MS)
    bounds = series.sentiment_bounds(F.col("score"), F.col("intensity"))
    checked = cut(series.validate_rows(rows, SENTIMENT_SERIES, ["event_time_ms"], "event_time_ms", "available_at_ms", ["source", "dataset", "label"], bounds, part))
    good = rows.join(checked.filter("bad_rows = 0").select(*SENTIMENT_SERIES), SENTIMENT_SERIES, "left_semi")
    made = series.month_partitions(good, SENTIMENT_SERIES, "event_time_ms")
    sinks.write_table(made, out, [*SENTIMENT_SERIES, "year", "month"], ["event_time_ms"])
    key = X.sentiment_key(F.col("source"), F.col("dataset"), F.col("scope"), F.col("interval"), F.concat("year", F.lit("-"), "month"))
    stats = series.object_stats(made.withColumn("key", key), [*SENTIMENT_SERIES, "key"], ["event_time_ms", "available_at_ms"])
    manifest = series.object_manifest(stats, SENTIMENT_SERIES, "key", "min_event_time_ms", "max_event_time_ms")
    head = spark.range(1).select(F.lit(source).alias("source"), F.lit(dataset).alias("dataset"))
    done = head.join(checked.select("source", "bad_rows", "first_rule"), "source", "left").join(manifest.select("source", "objects", "row_count", "coverage_start_ms", "coverage_end_ms", "object_keys", F.col("status").alias("__status")), "source", "left")
    status = F.when((F.coalesce("bad_rows", F.lit(1)) > 0) | (F.coalesce("__status", F.lit("FAIL")) == "FAIL"), "FAIL").otherwise("PASS")
    return done.select(
        "source", "dataset", F.coalesce("row_count", F.lit(0)).alias("row_count"), F.coalesce("objects", F.lit(0)).alias("objects"), "coverage_start_ms", "coverage_end_ms", "object_keys",
        status.alias("status"), F.when(F.col("bad_rows").isNull(), "empty rows").otherwise(F.col("first_rule")).alias("reason"),
    )


def ingest_derivatives(spark: SparkSession, landed: str, out: str, dataset: str, symbols: list[str], lo: int, hi: int, market: str = "futures-um", interval: str = "8h") -> DataFrame:
    """Pages of JSON below landed/SYMBOL/ to a table by month, and one row a symbol: rows, objects, range, keys, status and first broken rule.

    Pages that overlap meet in one row; rows are those with event times in [lo, hi].
    A symbol with a broken rule or without rows is FAIL and is not written.
    """
    if dataset not in readers.DERIVATIVES:
        raise ValueError(f"no such dataset: {dataset}")
    rows = None
    for s in symbols:
        one = readers.read_derivatives_json(spark, f"{landed}/{s}", dataset, s).filter(F.col("event_time_ms").between(lo, hi))
        one = one.withColumns({"market": F.lit(market), "interval": F.lit(interval)})
        rows = one if rows is None else rows.unionByName(one)
    keys = ["dataset", "market", "symbol", "interval"]
    checked = series.validate_rows(rows, keys, ["event_time_ms"], "event_time_ms", "available_at_ms", ["source", *keys], part=F.floor(F.col("event_time_ms") / series.PART_MS))
    good = rows.join(checked.filter("bad_rows = 0").select(*keys), keys, "left_semi")
    made = series.month_partitions(good, keys, "event_time_ms")
    sinks.write_table(made, out, [*keys, "year", "month"], ["event_time_ms"])
    period = F.concat("year", F.lit("-"), "month")
    key = X.derivatives_key(F.col("source"), F.col("dataset"), F.col("market"), F.col("symbol"), F.col("interval"), period)
    stats = series.object_stats(made.withColumn("key", key), [*keys, "key"], ["event_time_ms", "available_at_ms"])
    manifest = series.object_manifest(stats, keys, "key", "min_event_time_ms", "max_event_time_ms")
    wanted = spark.createDataFrame([(s,) for s in symbols], "symbol string")
    done = wanted.join(checked.select("symbol", "bad_rows", "first_rule"), "symbol", "left").join(manifest.select("symbol", "objects", "row_count", "coverage_start_ms", "coverage_end_ms", "object_keys", "status"), "symbol", "left")
    status = F.when((F.coalesce("bad_rows", F.lit(1)) > 0) | (F.coalesce("status", F.lit("FAIL")) == "FAIL"), "FAIL").otherwise("PASS")
    return done.select("symbol", F.coalesce("row_count", F.lit(0)).alias("row_count"), F.coalesce("objects", F.lit(0)).alias("objects"), "coverage_start_ms", "coverage_end_ms", "object_keys", status.alias("status"), F.when(F.col("bad_rows").isNull(), "empty rows").otherwise(F.col("first_rule")).alias("reason"))
