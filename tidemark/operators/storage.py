"""Storage: usage, staging, archive reconciliation, cleanup and ingest plans. Everything is a plan; nothing is deleted."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import exprs
from ..functions.lineage import cut


def storage_usage(files: DataFrame) -> DataFrame:
    """Bytes and files by symbol, by year, by month of the year, by top-level area (the first folder of each path, none for files beside the folders), and in all."""
    rows = files.withColumn("area", F.nullif(F.regexp_extract("path", "^([^/]+)/", 1), F.lit("")))
    sets = rows.groupingSets([["symbol"], ["year"], ["month"], ["area"], []], "symbol", "year", "month", "area")
    return sets.agg(F.sum("length").alias("bytes"), F.count("*").alias("files"))


def storage_rollup(files: DataFrame) -> DataFrame:
    """Bytes and files below every directory, from each path's prefixes."""
    parts = F.split("path", "/")
    up = F.transform(F.sequence(F.lit(1), F.size(parts) - 1), lambda k: F.array_join(F.slice(parts, 1, k), "/"))
    each = files.select("length", F.explode(up).alias("dir"), F.col("path").endswith(".parquet").alias("__p"))
    return each.groupBy("dir").agg(F.sum("length").alias("bytes"), F.count("*").alias("files"), F.count_if("__p").alias("parquet_files"))


def top_files(files: DataFrame, by: str, k: int = 5) -> DataFrame:
    """The k largest files of each directory, by size and path."""
    w = Window.partitionBy(by).orderBy(F.col("length").desc(), "path")
    return files.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k).select(by, "path", "length", "rank")


def staging_estimate(files: DataFrame, core: list[str], budget: int) -> DataFrame:
    """Measured bytes of each group (core or expansion) and year against a budget."""
    group = F.when(F.col("symbol").isin(*core), "core").otherwise("expansion")
    return files.groupBy(group.alias("target"), "year").agg(F.sum("length").alias("bytes"), F.countDistinct("symbol").alias("symbols")).withColumn("fits", F.col("bytes") <= budget)


def archive_reconcile(local: DataFrame, remote: DataFrame) -> DataFrame:
    """Both sides by path: VERIFIED (same length), SIZE_MISMATCH, LOCAL_ONLY, REMOTE_ONLY; safe_to_delete only if verified."""
    j = local.select("path", F.col("length").alias("l")).join(remote.select("path", F.col("length").alias("r")), "path", "full_outer")
    status = F.when(F.col("r").isNull(), "LOCAL_ONLY").when(F.col("l").isNull(), "REMOTE_ONLY").when(F.col("l") == F.col("r"), "VERIFIED").otherwise("SIZE_MISMATCH")
    return j.select("path", F.col("l").alias("local_bytes"), F.col("r").alias("remote_bytes"), status.alias("status"), (status == "VERIFIED").alias("safe_to_delete"))


def catalogue_update(catalogue: DataFrame, seen: DataFrame) -> DataFrame:
    """catalogue(path, status, length) brought up to date by seen(path, status, length) of a reconciliation.

    What is verified now is entered as VERIFIED; an entry that was verified and
    no longer is, or is gone from both sides, falls back to UNKNOWN.
    """
    c = catalogue.select("path", F.col("status").alias("c_status"), F.col("length").alias("c_length"))
    s = seen.select("path", F.col("status").alias("s_status"), F.col("length").alias("s_length"))
    status = F.when(F.col("s_status") == "VERIFIED", "VERIFIED").when(F.col("c_status") == "VERIFIED", "UNKNOWN").otherwise(F.coalesce("c_status", F.lit("UNKNOWN")))
    return c.join(s, "path", "full_outer").select("path", status.alias("status"), F.coalesce("s_length", "c_length").alias("length"))


def targets(files: DataFrame, symbols: list[str] | None, first_year: int, last_year: int) -> DataFrame:
    """files(symbol, year, ...) of a set of symbols, all without one, and of whole years; a range's months do not matter."""
    rows = files.filter(F.col("year").cast("int").between(first_year, last_year))
    return rows.filter(F.col("symbol").isin([s.strip().upper() for s in symbols])) if symbols else rows


#: Files of one block of a budget's walk, about, and the most blocks there are.
BLOCK_FILES, MOST_BLOCKS = 500_000, 10_000


def _greedy(starts: dict[int, int]):
    """Batches (__block, length, ...) in walking order: fits says what is taken, from each block's budget at its start on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, left = None, 0
        for b in batches:
            fits = []
            for k, n in zip(b.column("__block").to_pylist(), b.column("length").to_pylist(), strict=True):
                if k != block:
                    block, left = k, starts[k]
                fits.append(n is not None and n <= left)
                if fits[-1]:
                    left -= n
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(fits, pa.bool_())], names=[*b.schema.names, "fits"])

    return run


def within_budget(files: DataFrame, budget: int, block_files: int = BLOCK_FILES) -> DataFrame:
    """F13, exact: files(path, length, ...) with fits, whether each still fits what is left of one budget when all are walked in path order.

    A file too large for what is left is passed over and later, smaller ones may
    still fit. Paths are ordered by their folders, as a walk meets them, equal
    ones by length. Files lie in range partitions, which are the blocks of the
    walk. A block whose whole sum fits takes all, one whose smallest file does
    not fit takes nothing, and only a block between these is read to learn what
    it leaves. Then every block is decided from its own start, side by side.
    The driver sees a row a block. A null length never fits.
    """
    blocks = max(1, min(MOST_BLOCKS, -(-files.count() // block_files)))
    order = F.split("path", "/")
    walk = cut(files.repartitionByRange(blocks, order, "length").sortWithinPartitions(order, "length").withColumn("__block", F.spark_partition_id()))
    kinds = ", ".join([*[f"`{c}` {t}" for c, t in walk.dtypes], "fits boolean"])
    left, starts = budget, {}
    for r in walk.groupBy("__block").agg(F.coalesce(F.sum("length"), F.lit(0)).alias("whole"), F.min("length").alias("least")).orderBy("__block").collect():
        starts[r["__block"]] = left
        if r.whole <= left:
            left -= r.whole
        elif r.least <= left:
            here = walk.filter(F.col("__block") == r["__block"]).mapInArrow(_greedy({r["__block"]: left}), kinds)
            left -= here.filter("fits").agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
    return walk.mapInArrow(_greedy(starts), kinds).drop("__block")


def cleanup_plan(files: DataFrame, retained: list[str], first_year: int, last_year: int, budget: int | None, market: str | None = None, interval: str | None = None) -> DataFrame:
    """A decision and reason for every file(path, symbol, year, length, status); the first reason that holds.

    Verified targets are deleted in path order as long as they fit into one
    budget over all of them, see within_budget; none is no bound. market and
    interval restrict the targets to `candles/market/interval/`.
    """
    part = lambda k: F.regexp_extract("path", "(?:^|/)candles/([^/]+)/([^/]+)/", k)
    target = F.col("year").cast("int").between(first_year, last_year)
    for k, wanted in ((1, market), (2, interval)):
        if wanted is not None:
            target = target & (part(k) == wanted)
    why = (
        F.when(F.col("path").rlike("(^|/)reports/"), "REPORT").when(F.col("path").rlike("(^|/)(manifests|datasets)/"), "PROTECTED").when(F.col("symbol").isin(*retained), "RETAINED_SYMBOL")
        .when(~F.coalesce(target, F.lit(False)), "NOT_TARGET").when(F.coalesce(F.col("status"), F.lit("")) != "VERIFIED", "NOT_VERIFIED")
    )
    # The walk takes its rows several times (a count, the ranges' bounds, the sort): what they come from is evaluated once.
    rows = cut(files.select("path", "symbol", "length", why.alias("reason")))
    kept = rows.filter("reason is not null")
    free = rows.filter("reason is null").select("path", "symbol", "length")
    free = free.withColumn("fits", F.lit(True)) if budget is None else within_budget(free, budget)
    free = free.select("path", "symbol", "length", F.when(F.col("fits"), "DELETE").otherwise("OVER_BUDGET").alias("reason"))
    return kept.unionByName(free).withColumn("delete", F.col("reason") == "DELETE")


def expand_periods(spark, start: str, end: str, unit: str) -> DataFrame:
    """Months (`YYYY-MM`) or days from start to end, both included."""
    step, fmt = ("interval 1 month", "yyyy-MM") if unit == "month" else ("interval 1 day", "yyyy-MM-dd")
    return spark.range(1).select(F.explode(F.expr(f"sequence(date'{start}', date'{end}', {step})")).alias("d")).select(F.date_format("d", fmt).alias("period"))


def ingest_plan(symbols: DataFrame, periods: DataFrame, existing: DataFrame, market: str, interval: str) -> DataFrame:
    """An object for every symbol and period, and whether it is there. periods is a calendar, whose size its bounds fix."""
    plan = symbols.select("symbol").distinct().crossJoin(F.broadcast(periods))
    key = exprs.candle_key(F.lit(market), F.lit(interval), F.col("symbol"), F.col("period"))
    have = existing.select(F.col("path").alias("key"), F.lit(True).alias("__have")).distinct()
    return plan.withColumn("key", key).join(have, "key", "left").select("key", "symbol", "period", F.when(F.col("__have"), "SKIP_EXISTING").otherwise("FETCH").alias("state"))


def apply_policy(plan: DataFrame, policy: str = "skip") -> DataFrame:
    """What is to be done with a plan's objects: `skip` leaves those that are there, `overwrite` makes them anew, `dry-run` does nothing."""
    if policy not in ("skip", "overwrite", "dry-run"):
        raise ValueError(f"no such policy: {policy}")
    there = F.col("state") == "SKIP_EXISTING"
    if policy == "dry-run":
        return plan.withColumn("state", F.lit("PLANNED"))
    return plan if policy == "skip" else plan.withColumn("state", F.when(there, "FETCH").otherwise(F.col("state")))


def plan_summary(plan: DataFrame) -> DataFrame:
    """Objects by state, and a label for the whole."""
    out = plan.agg(F.count("*").alias("objects"), F.count_if(F.col("state") == "FETCH").alias("to_fetch"), F.count_if(F.col("state") == "SKIP_EXISTING").alias("skipped"))
    return out.withColumn("label", F.when(F.col("to_fetch") > 0, "INCOMPLETE").otherwise("COMPLETE"))


def outcome_summary(outcomes: DataFrame, dry_run: bool = False) -> DataFrame:
    """Objects by outcome (RESTORED, SKIPPED_EXISTING, MISSING, FAILED_VALIDATION, FAILED_RESTORE, PLANNED) and the label of the gravest."""
    names = {"restored": "RESTORED", "skipped": "SKIPPED_EXISTING", "missing": "MISSING", "failed_validation": "FAILED_VALIDATION", "failed_restore": "FAILED_RESTORE", "planned": "PLANNED"}
    out = outcomes.agg(F.count("*").alias("objects"), *[F.count_if(F.col("outcome") == v).alias(k) for k, v in names.items()])
    # The labels of a restore.
    label = F.when(F.col("missing") > 0, "blocked_missing_r2_objects").when(F.col("failed_validation") > 0, "blocked_validation_failure").when(F.col("failed_restore") > 0, "partial_restore").otherwise("dry_run_complete" if dry_run else "restore_complete")
    return out.withColumn("final_label", label)
