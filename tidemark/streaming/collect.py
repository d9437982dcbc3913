"""Incremental collection of listing snapshots with Structured Streaming."""

from __future__ import annotations

import functools
import operator
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..functions import exprs
from ..operators import listing
from ..sources import sinks
from ..sources.readers import SNAPSHOT


def snapshot_stream(spark: SparkSession, path: str) -> DataFrame:
    """K1: new snapshot files under a folder, unparseable ones left out."""
    raw = spark.readStream.schema(SNAPSHOT).option("multiLine", "true").json(path)
    rows = raw.filter(F.col("schema_version").isNotNull() & (F.size("symbols") > 0))
    return rows.withColumn("collected", F.to_timestamp("collected_at"))


def deduplicated(stream: DataFrame, delay: str = "7 days") -> DataFrame:
    """K3: a snapshot hash once within the watermark's delay; state is bounded by it."""
    return stream.withWatermark("collected", delay).dropDuplicatesWithinWatermark(["snapshot_hash"])


#: The state of a snapshot hash lives on disk, in the checkpoint's state store.
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class FirstOfHash(StatefulProcessor):
    """Lets the first snapshot of each hash through, ever: by id and content within a batch, and none whose hash was seen or archived before."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getValueState("seen", "at string")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        found = ((r.snapshot_id or "", r.body) for part in rows for r in part.itertuples(index=False))
        first = min(found)
        if not self.seen.exists():
            self.seen.update((first[0],))
            yield pd.DataFrame({"body": [first[1]]})

    def handleInitialState(self, key, initialState, timerValues) -> None:
        self.seen.update((None,))

    def close(self) -> None:
        pass


def suppressed(stream: DataFrame, archived: DataFrame) -> DataFrame:
    """K3, exact: the rows of a snapshot stream whose hash is new, against all batches before and archived(snapshot_hash), which is read at the first start only.

    Rows without a hash are left out. A row travels to its hash's state as JSON; state is a hash and an id for each snapshot ever taken.
    """
    rows = stream.filter("snapshot_hash is not null").select("snapshot_hash", "snapshot_id", F.to_json(F.struct(*[c for c in stream.columns if c != "collected"])).alias("body"))
    held = archived.filter("snapshot_hash is not null").select("snapshot_hash").distinct().groupBy("snapshot_hash")
    new = rows.groupBy("snapshot_hash").transformWithStateInPandas(FirstOfHash(), "body string", "Append", "None", held)
    return new.select(F.from_json("body", SNAPSHOT).alias("s")).select("s.*")


def _archived(spark: SparkSession, archive: str) -> DataFrame | None:
    try:
        return spark.read.parquet(archive)
    except Exception as e:  # nothing archived so far
        if "PATH_NOT_FOUND" not in str(e) and "UNABLE_TO_INFER_SCHEMA" not in str(e):
            raise
        return None


def refresh(spark: SparkSession, archive: str, summary: str, days: list[tuple[str, str, str]] | None = None) -> None:
    """K5: the archive's summary and its symbols' evidence, below `summary`, from parts of which only those of the days named are made anew; all without days.

    Parts are a row for each day and trust level, and for each day and symbol;
    the archive is read in the folders of these days alone.
    """
    rows = _archived(spark, archive)
    if rows is None:
        return
    where = ["year", "month", "day"]
    rows = rows.withColumns({c: F.col(c).cast("int") for c in where})
    if days is not None:
        rows = rows.filter(functools.reduce(operator.or_, [(F.col("year") == int(y)) & (F.col("month") == int(m)) & (F.col("day") == int(d)) for y, m, d in days], F.lit(False)))
    parts = listing.summary_parts(rows.select(*where, F.col("trust_level").alias("trust"), F.col("observed_at").alias("observed"), F.size("symbols").alias("symbols")), where)
    seen = rows.select(*where, "snapshot_id", F.col("collected_at").alias("collected"), F.explode("symbols").alias("s"))
    at = lambda c: exprs.parsed_ms(F.col(f"s.{c}"))
    seen = seen.select(*where, "snapshot_id", "collected", "s.symbol", "s.status", at("onboard_at").alias("onboard_ms"), at("delivery_at").alias("delivery_ms"))
    for name, part, whole in (("archive", parts, listing.summed_up), ("symbols", listing.evidence_parts(seen, where), listing.evidence_of)):
        sinks.replace_partitions(part, f"{summary}/{name}-parts", where)
        whole(spark.read.parquet(f"{summary}/{name}-parts")).write.mode("overwrite").parquet(f"{summary}/{name}")


def collect(spark: SparkSession, landed: str, archive: str, summary: str, checkpoint: str) -> None:
    """K1, K2, K3, K5: takes all landed files once, appends the snapshots whose hash is new, and refreshes the days that changed.

    One archive row a hash, whatever lands twice: in a batch, in batches apart,
    after a restart. Files taken before are not read again, as the checkpoint
    knows them, and neither is the archive, but for its hashes at the first start.
    A batch writes folders of its own number, which a repetition of the batch replaces.
    """
    have = _archived(spark, archive)
    held = spark.createDataFrame([], "snapshot_hash string") if have is None else have.select("snapshot_hash")

    def batch(df: DataFrame, number: int) -> None:
        df = df.persist()
        try:
            days = sinks.append_archive(df, archive, batch=number).distinct().collect()
            if days:
                refresh(spark, archive, summary, [tuple(r) for r in days])
        finally:
            df.unpersist()

    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    try:
        new = suppressed(snapshot_stream(spark, landed), held)
        query = new.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        query.awaitTermination()
    finally:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", before)


def lag_histogram(stream: DataFrame, event: str, available: str, delay: str = "30 days") -> DataFrame:
    """K4: rows by day of availability and whole days of lag, under a watermark on availability."""
    lag = F.date_diff(F.to_date(available), F.to_date(event))
    return stream.withWatermark(available, delay).groupBy(F.window(available, "1 day"), lag.alias("lag_days")).agg(F.count("*").alias("rows"))
