"""Readers of landed files: candles, metrics, sentiment, listings, lifecycles, file catalogues. Schemas are stated, never inferred."""

from __future__ import annotations

import hashlib
import io
import re
import zipfile
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark import Accumulator
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import exprs as X

# Candle columns by position, a fixed format.
CANDLE = ["open_time_ms", "open", "high", "low", "close", "volume", "close_time_ms", "quote_asset_volume", "number_of_trades", "taker_buy_base_volume", "taker_buy_quote_volume"]
WHOLE = {"open_time_ms", "close_time_ms", "number_of_trades"}
# Fields of each derivatives dataset: value, extra_1, extra_2, a fixed format.
DERIVATIVES = {
    "funding_rate": ("fundingRate", "markPrice", None, "fundingTime"),
    "open_interest": ("sumOpenInterest", "sumOpenInterestValue", None, "timestamp"),
    "long_short_ratio": ("longShortRatio", "longAccount", "shortAccount", "timestamp"),
    "top_trader_ratio": ("longShortRatio", "longAccount", "shortAccount", "timestamp"),
    "taker_volume": ("buySellRatio", "buyVol", "sellVol", "timestamp"),
}
SENTIMENT = "data array<struct<value: string, value_classification: string, timestamp: string>>"
LISTING = "serverTime bigint, symbols array<struct<symbol: string, pair: string, contractType: string, deliveryDate: bigint, onboardDate: bigint, status: string, baseAsset: string, quoteAsset: string, permissions: array<string>>>"
SNAPSHOT = "schema_version string, snapshot_id string, snapshot_hash string, collected_at string, observed_at string, trust_level string, symbols array<struct<symbol: string, status: string, onboard_at: string, delivery_at: string>>"
LIFECYCLE = ["symbol", "base_asset", "quote_asset", "market_type", "exchange", "status", "listed_at", "delisted_at", "first_seen", "last_seen", "evidence_level", "source_type", "source_name", "source_uri", "source_hash", "observed_at"]


def read_candle_times(spark: SparkSession, paths: list[str] | str, interval: str | None = None, symbol: str | None = None, place: bool = False) -> DataFrame:
    """A2: (path, symbol, interval, open_time_ms) of candle Parquet files; no other column is read. Symbol and interval from the path unless given.

    place adds row_index, the row's number in its file: with path the order in which rows lie there.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    where = [F.col("_metadata.row_index").alias("row_index")] if place else []
    rows = spark.read.schema("open_time_ms bigint").option("recursiveFileLookup", "true").parquet(*paths).select(F.col("_metadata.file_path").alias("path"), *where, "open_time_ms")
    p = F.col("path")
    return rows.select("path", *["row_index"] * place, X.audit_symbol(p, F.lit(symbol)).alias("symbol"), X.audit_interval(p, F.lit(interval)).alias("interval"), "open_time_ms")


def read_series(spark: SparkSession, root: str, first: str | None = None, last: str | None = None, **keys: str) -> DataFrame:
    """A4: a table laid out by folders name=value, year=, month=, of the series that keys name and of the months first to last (YYYY-MM).

    Folders outside are pruned and not listed as input.
    """
    rows = spark.read.parquet(root)
    for k, v in keys.items():
        rows = rows.filter(F.col(k) == v)
    for bound, sign in ((first, 1), (last, -1)):
        if bound:
            year, month = (F.col(c).cast("int") for c in ("year", "month"))
            y, m = int(bound[:4]), int(bound[5:7])
            rows = rows.filter((year > y) | ((year == y) & (month >= m)) if sign > 0 else (year < y) | ((year == y) & (month <= m)))
    return rows


def read_manifest(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Manifests as JSON objects of a stated schema; fields that are absent are null, a file that is no object fails the job."""
    return spark.read.schema(schema).option("multiLine", "true").option("mode", "FAILFAST").json(path)


def read_backfill(spark: SparkSession, files: list[str] = (), folder: str | None = None, layout: str | None = None, stated: str | None = None) -> DataFrame:
    """A14 with H25: (path, input_sha256, observed, hash, symbols) of the files named and of the *.json below a folder, each path once.

    hash is that of the sorted symbols, null for payloads without any or that are
    no JSON. observed comes from the file's name by a layout, else as stated, else from the payload.
    """
    found = None
    for where, option in [(list(files), "false")] * bool(files) + [([folder], "true")] * bool(folder):
        one = spark.read.format("binaryFile").option("recursiveFileLookup", option).option("pathGlobFilter", "*.[jJ][sS][oO][nN]").load(where).select("path", "content")
        found = one if found is None else found.unionByName(one)
    if found is None:
        raise ValueError("no files and no folder")
    rows = found.withColumn("x", F.from_json(F.col("content").cast("string"), LISTING)).withColumn("symbols", F.coalesce(F.size("x.symbols"), F.lit(0)))
    digest = F.when(F.col("symbols") > 0, F.sha2(F.to_json(F.array_sort("x.symbols")), 256))
    made = rows.select("path", F.sha2("content", 256).alias("input_sha256"), X.observed_time(F.col("path"), layout, F.lit(stated), F.col("x.serverTime")).alias("observed"), digest.alias("hash"), F.greatest("symbols", F.lit(0)).alias("symbols"))
    return made.dropDuplicates(["path"])


def read_raw_payloads(spark: SparkSession, path: str) -> DataFrame:
    """(path, name_hash, sha256) of stored payloads: the hash that a file's name ends with and that of its bytes."""
    rows = read_hashes(spark, path, "*.json")
    return rows.select("path", F.nullif(F.regexp_extract("path", "_([0-9a-f]{64})[.]json$", 1), F.lit("")).alias("name_hash"), "sha256").filter("name_hash is not null")


def typed_candles(raw: DataFrame) -> DataFrame:
    """Strict casts of text columns c1.. by position; a header line goes; a bad or missing cell fails the job."""
    rows = raw.filter(F.coalesce(F.col("c1"), F.lit("")) != "open_time")
    need = lambda c, kind, name: F.when(F.col(c).isNull(), F.raise_error(F.lit(f"candle without {name}")).cast(kind)).otherwise(F.col(c).cast(kind)).alias(name)
    keep = [c for c in raw.columns if not c.startswith("c") or not c[1:].isdigit()]
    return rows.select(*keep, *[need(f"c{k}", "bigint" if n in WHOLE else "double", n) for k, n in enumerate(CANDLE, 1)])


def read_candle_csv(spark: SparkSession, path: str) -> DataFrame:
    """A1: candles from CSV files, with their market, symbol, interval and period from the path."""
    schema = T.StructType([T.StructField(f"c{k}", T.StringType()) for k in range(1, 13)])
    raw = spark.read.schema(schema).csv(path).withColumn("path", F.col("_metadata.file_path"))
    p = F.col("path")
    return typed_candles(raw).select(X.path_market(p).alias("market"), X.path_symbol(p).alias("symbol"), X.path_interval(p).alias("interval"), X.key_period(p).alias("period"), F.lit(None).cast("string").alias("source_date"), *CANDLE)


#: Bytes read of a file at a time.
CHUNK = 4 << 20
#: Stores whose files tasks open themselves, piece by piece; files elsewhere come whole from Spark's reader, up to its 2 GB.
STREAMED = re.compile(r"(?:file:)?/|s3://|gs://|hdfs://")


def opened(path: str) -> pa.NativeFile:
    """A file of a streamed store, seekable; nothing is read yet."""
    if re.match(r"(?:file:)?/", path):
        return fs.LocalFileSystem().open_input_file(re.sub("^file:/+", "/", path))
    store, inside = fs.FileSystem.from_uri(path)
    return store.open_input_file(inside)


def _digest(file: pa.NativeFile) -> str:
    digest = hashlib.sha256()
    while piece := file.read(CHUNK):
        digest.update(piece)
    return digest.hexdigest()


def _members(path: str, file, names: list[str]) -> Iterator[pd.DataFrame]:
    """The lines of an archive's one CSV member, which must be named as the archive is, 50,000 at a time."""
    with zipfile.ZipFile(file) as z:
        wanted = path.rsplit("/", 1)[-1].removesuffix(".zip") + ".csv"
        found = [n for n in z.namelist() if n.endswith(".csv")]
        if found != [wanted]:
            raise ValueError(f"{path}: {found}")
        with z.open(wanted) as member:
            yield from pd.read_csv(member, header=None, names=names, usecols=range(11), dtype=str, chunksize=50_000)


def read_archives(archives: DataFrame, report: bool = False, reads: Accumulator | None = None) -> DataFrame:
    """The candles of archives(path, and where to be verified expected, the SHA-256 that it should have).

    Each archive is opened once, by one task: it is hashed in pieces, and what is
    as expected is unzipped as it is read, so that memory is bounded whatever its
    size. Another hash, an unsafe or missing member, a broken archive or a bad
    cell fails the job; with report such an archive gives a row with its error
    (`checksum` for the hash) and without candle. reads counts the archives unzipped.
    """
    names = [f"c{k}" for k in range(1, 12)]
    verify, whole = "expected" in archives.columns, "content" in archives.columns

    def lines(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for k, path in enumerate(pdf["path"]):
                try:
                    with io.BytesIO(pdf["content"].iloc[k]) if whole else opened(path) as file:
                        expected = pdf["expected"].iloc[k] if verify else None
                        if expected is not None and _digest(file) != expected:
                            raise ValueError("checksum")
                        file.seek(0)
                        if reads is not None:
                            reads.add(1)
                        for part in _members(path, file, names):
                            yield part.assign(path=path, error=None)[["path", "error", *names]]
                except (ValueError, zipfile.BadZipFile) as e:
                    if not report:
                        raise
                    yield pd.DataFrame({"path": [path], "error": [str(e)[:200]], **{c: [None] for c in names}}, dtype=object)

    raw = archives.mapInPandas(lines, "path string, error string, " + ", ".join(f"{c} string" for c in names))
    if report:
        cells = [F.col(c).try_cast("bigint" if n in WHOLE else "double") for c, n in zip(names, CANDLE, strict=True)]
        raw = raw.filter(F.coalesce(F.col("c1"), F.lit("")) != "open_time")
        bad = F.when(F.col("error").isNull() & ~F.coalesce(*[F.when(c.isNull(), F.lit(False)) for c in cells], F.lit(True)), "bad or missing cell")
        typed = raw.withColumn("error", F.coalesce("error", bad)).select("path", "error", *[c.alias(n) for c, n in zip(cells, CANDLE, strict=True)])
    else:
        typed = typed_candles(raw).drop("error")
    p = F.regexp_replace("path", r"\.zip$", ".csv")
    return typed.select(X.path_symbol(p).alias("symbol"), X.path_interval(p).alias("interval"), X.key_period(p).alias("period"), *typed.columns)


def _contents(spark: SparkSession, path: str | list[str], pattern: str) -> DataFrame:
    """(path, length) of the files below a folder; with content where tasks can't open them."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(path)
    streamed = all(STREAMED.match(x) for x in ([path] if isinstance(path, str) else path))
    return found.select("path", "length", *[] if streamed else ["content"])


def read_candle_zip(spark: SparkSession, path: str | list[str], report: bool = False) -> DataFrame:
    """Candles from the zip archives below a folder, see read_archives."""
    return read_archives(_contents(spark, path, "*.zip").drop("length"), report)


def read_files(spark: SparkSession, path: str, pattern: str = "*.parquet") -> DataFrame:
    """A3: every file under a folder with its length and time; contents are not read."""
    df = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(path)
    return df.select("path", "length", "modificationTime")


def _below(path, root: str):
    """path relative to a root, both without a scheme."""
    plain = lambda c: F.regexp_replace(c, "^[a-z]+:/+", "/")
    start = F.length(plain(F.lit(root.rstrip("/")))) + 2
    return F.substring(plain(path), start, F.length(path))


def scan_files(spark: SparkSession, root: str, pattern: str = "*") -> DataFrame:
    """A3 for storage plans: (path, symbol, year, month, length) of all files below a root, paths relative to it; contents are not read."""
    p = F.col("path")
    files = read_files(spark, root, pattern).select(_below(p, root).alias("path"), "length")
    part = lambda n, c: F.coalesce(F.nullif(F.regexp_extract("path", f"(?:^|/){n}=([^/]+)", 1), F.lit("")), F.substring(X.key_period(p), *c))
    return files.select("path", X.lifecycle_symbol(p).alias("symbol"), part("year", (1, 4)).alias("year"), part("month", (6, 2)).alias("month"), "length")


def read_footers(spark: SparkSession, root: str, t: str = "open_time_ms") -> DataFrame:
    """(path, row_count, lo, hi) of the Parquet files below a root, from their footers alone: no column is read.

    The range of t comes from the statistics of the row groups; a file with a
    group that has none is read for that column. A file without rows has a null
    range. In stores whose files tasks can't open the column is read by Spark.
    """
    if not STREAMED.match(root):
        rows = spark.read.schema(f"{t} bigint").option("recursiveFileLookup", "true").parquet(root).select(F.col("_metadata.file_path").alias("path"), t)
        stats = rows.groupBy("path").agg(F.count("*").alias("row_count"), F.min(t).alias("lo"), F.max(t).alias("hi"))
        return read_files(spark, root).select("path").join(stats, "path", "left").withColumn("row_count", F.coalesce("row_count", F.lit(0)))

    def footers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            counts, ranges = [], []
            for path in b.column("path").to_pylist():
                with opened(path) as raw, pq.ParquetFile(raw) as file:
                    meta = file.metadata
                    groups = [meta.row_group(k) for k in range(meta.num_row_groups)]
                    at = {groups[0].column(k).path_in_schema: k for k in range(groups[0].num_columns)} if groups else {}
                    stats = [g.column(at[t]).statistics for g in groups if g.num_rows] if t in at else []
                    if all(s is not None and s.has_min_max for s in stats):
                        found = [x for s in stats for x in (s.min, s.max)]
                    else:
                        found = [x.as_py() for x in pc.min_max(file.read([t]).column(0)).values()]
                    found = [x for x in found if x is not None]
                    counts.append(meta.num_rows)
                    ranges.append((min(found), max(found)) if found else (None, None))
            yield pa.RecordBatch.from_arrays([b.column("path"), pa.array(counts, pa.int64()), *[pa.array([r[k] for r in ranges], pa.int64()) for k in (0, 1)]], names=["path", "row_count", "lo", "hi"])

    return read_files(spark, root).select("path").mapInArrow(footers, "path string, row_count bigint, lo bigint, hi bigint")


def scan_dataset(spark: SparkSession, root: str, t: str = "open_time_ms") -> DataFrame:
    """J5's scan: (path, symbol, interval, market, sha256, row_count, lo, hi) of the Parquet files below a root.

    Bytes are read for the hashes; counts and ranges come from the footers. A file without rows has no range.
    """
    hashes = read_hashes(spark, root, "*.parquet").select(_below(F.col("path"), root).alias("path"), "sha256")
    stats = read_footers(spark, root, t).withColumn("path", _below(F.col("path"), root))
    p = F.col("path")
    return hashes.join(stats, "path", "left").select("path", X.lifecycle_symbol(p).alias("symbol"), X.folder_interval(p).alias("interval"), X.path_market(p).alias("market"), "sha256", F.coalesce("row_count", F.lit(0)).alias("row_count"), "lo", "hi")


def list_objects(spark: SparkSession, prefix: str, first: str, last: str, pattern: str = "*.parquet") -> DataFrame:
    """A5: the files below a prefix whose period overlaps the days first to last (YYYY-MM-DD)."""
    return read_files(spark, prefix, pattern).filter(X.overlaps(F.col("path"), F.lit(first).cast("date"), F.lit(last).cast("date")))


def read_hashes(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """SHA-256 of every file's bytes, read piece by piece, so that a file may have any size."""
    found = _contents(spark, path, pattern)
    if "content" in found.columns:
        return found.select("path", "length", F.sha2("content", 256).alias("sha256"))

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for p in b.column("path").to_pylist():
                with opened(p) as file:
                    out.append(_digest(file))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out, pa.string())], names=["path", "length", "sha256"])

    return found.mapInArrow(hashed, "path string, length bigint, sha256 string")


def read_checksums(spark: SparkSession, path: str) -> DataFrame:
    """(name, expected) from the .CHECKSUM files below a folder: the name of the archive each stands beside, and the hash it states."""
    said = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.CHECKSUM").text(path)
    return said.select(F.regexp_replace(F.col("_metadata.file_path"), r"\.CHECKSUM$", "").alias("path"), F.lower(F.element_at(F.split(F.trim("value"), r"\s+"), 1)).alias("expected"))


def same_file(path: Column) -> Column:
    """A path as two readers of one file spell it alike."""
    return F.regexp_replace(path, "^file:/+", "/")


def verify_checksums(spark: SparkSession, path: str) -> DataFrame:
    """Archives against their .CHECKSUM files: OK, MISMATCH or NO_CHECKSUM."""
    have, said = read_hashes(spark, path, "*.zip"), read_checksums(spark, path).withColumnRenamed("path", "__p")
    j = have.join(said, same_file(F.col("path")) == same_file(F.col("__p")), "left")
    return j.select("path", "sha256", "expected", F.when(F.col("expected").isNull(), "NO_CHECKSUM").when(F.col("expected") == F.col("sha256"), "OK").otherwise("MISMATCH").alias("status"))


def normalize_derivatives(raw: DataFrame, dataset: str, symbol: str, market: str = "futures-um", interval: str = "8h") -> DataFrame:
    """Rows of one dataset from raw JSON text columns; value must parse, extras that don't are null, so that they differ from zero (H24). Overlapping pages meet in one row."""
    value, one, two, at = DERIVATIVES[dataset]
    extra = lambda n: (F.lit(None).cast("double") if n is None else F.col(n).try_cast("double"))
    t = F.trim(F.col(at), F.lit('"')).cast("bigint")
    rows = raw.select(
        F.lit("exchange").alias("source"), F.lit(dataset).alias("dataset"), F.lit(market).alias("market"), F.lit(symbol).alias("symbol"), F.lit(interval).alias("interval"),
        t.alias("event_time_ms"), t.alias("available_at_ms"), F.col(value).cast("double").alias("value"), extra(one).alias("extra_1"), extra(two).alias("extra_2"),
    )
    return rows.dropDuplicates(["dataset", "market", "symbol", "interval", "event_time_ms"])


def read_derivatives_json(spark: SparkSession, path: str | list[str], dataset: str, symbol: str) -> DataFrame:
    names = [n for n in DERIVATIVES[dataset] if n]
    raw = spark.read.schema(", ".join(f"{n} string" for n in names)).option("multiLine", "true").json(path)
    return normalize_derivatives(raw, dataset, symbol)


def read_sentiment_json(spark: SparkSession, path: str) -> DataFrame:
    """(path, position, score, label, event_time_ms) of every item; path and position are their order."""
    df = spark.read.schema(SENTIMENT).option("multiLine", "true").json(path)
    x = df.select(F.col("_metadata.file_path").alias("path"), F.posexplode("data").alias("position", "x"))
    return x.select("path", "position", F.col("x.value").cast("double").alias("score"), F.col("x.value_classification").alias("label"), (F.col("x.timestamp").cast("bigint") * 1000).alias("event_time_ms"))


def read_listing_json(spark: SparkSession, path: str) -> DataFrame:
    """Symbols of payload files, with the payload's time and hash; files without symbols are skipped."""
    df = spark.read.schema(LISTING).option("multiLine", "true").option("mode", "PERMISSIVE").json(path).withColumn("path", F.col("_metadata.file_path"))
    rows = df.filter(F.size("symbols") > 0).withColumn("hash", F.sha2(F.to_json(F.array_sort("symbols")), 256))
    s = rows.select("path", "hash", F.col("serverTime").alias("observed_ms"), F.explode("symbols").alias("s"))
    return s.select("path", "hash", "observed_ms", F.col("s.symbol").alias("symbol"), F.col("s.status").alias("status"), F.col("s.onboardDate").alias("onboard_ms"), F.nullif(F.col("s.deliveryDate"), F.lit(0)).alias("delivery_ms"), F.col("s.permissions").alias("permissions"))


def read_snapshots(spark: SparkSession, path: str) -> DataFrame:
    """Snapshots of an archive; what has no version or no symbols is skipped."""
    df = spark.read.schema(SNAPSHOT).option("multiLine", "true").option("mode", "PERMISSIVE").option("recursiveFileLookup", "true").json(path)
    return df.filter(F.col("schema_version").isNotNull() & (F.size("symbols") > 0))


def _lifecycle_rows(rows: DataFrame, defaults: dict[str, str]) -> DataFrame:
    """Trimmed symbols and levels, normalised times, malformed marking rows that have others, blanks as defaults name them."""
    times = ("listed_at", "delisted_at", "first_seen", "last_seen", "observed_at")
    malformed = F.lit(False)
    for c in times:
        malformed = malformed | F.coalesce(X.malformed_time(F.col(c)), F.lit(False))
    rows = rows.withColumn("malformed", malformed).withColumns({c: X.normalized_time(F.col(c)) for c in times})
    rows = rows.withColumns({c: X.known(F.upper(F.trim(c))) for c in ("symbol", "status", "evidence_level")})
    quote = F.coalesce(X.known(F.col("quote_asset")), F.lit(defaults.get("quote_asset")), X.quote_asset(F.col("symbol")))
    rows = rows.withColumns({c: F.coalesce(X.known(F.col(c)), F.lit(v)) for c, v in defaults.items() if c in rows.columns and c != "quote_asset"}).withColumn("quote_asset", quote)
    own = F.when(F.col("symbol").endswith(F.col("quote_asset")) & (F.length("symbol") > F.length("quote_asset")), F.substring(F.col("symbol"), F.lit(1), F.length("symbol") - F.length("quote_asset")))
    return rows.withColumns({"base_asset": F.coalesce(X.known(F.col("base_asset")), own), "source_hash": X.known(F.col("source_hash")), "source_uri": X.known(F.col("source_uri"))})


def read_lifecycle_csv(spark: SparkSession, path: str, **defaults: str) -> DataFrame:
    """A10: by header names in any case, times also as *_utc; missing columns are null or as defaults say, times are normalised.

    Times that are none stay as they are, and malformed says so. Without a level evidence is USER_PROVIDED_UNVERIFIED.
    """
    df = spark.read.option("header", "true").csv(path)
    also = {f"{n}_utc": n for n in LIFECYCLE} | {"source_uri_or_path": "source_uri"}
    have = {also.get(c.strip().lower(), c.strip().lower()): c for c in df.columns}
    rows = df.select(*[(F.col(f"`{have[n]}`") if n in have else F.lit(None).cast("string")).alias(n) for n in LIFECYCLE])
    return _lifecycle_rows(rows, {"evidence_level": "USER_PROVIDED_UNVERIFIED"} | defaults)


def read_lifecycle_json(spark: SparkSession, path: str, **defaults: str) -> DataFrame:
    """A manifest object with `symbols`, or a bare array of them; blanks as the manifest's header has them, else as defaults say.

    A bare array is its own source: symbols without a source hash take the file's.
    """
    fields = ", ".join(f"{n}: string" for n in LIFECYCLE)
    head = ("exchange", "market_type", "quote_asset")
    df = spark.read.schema(f"{', '.join(f'{n} string' for n in LIFECYCLE)}, symbols array<struct<{fields}>>").option("multiLine", "true").json(path).withColumn("__file", F.col("_metadata.file_path"))
    nested = df.filter("symbols is not null").select(*[F.col(c).alias(f"__{c}") for c in head], F.inline("symbols"))
    nested = nested.withColumns({c: F.coalesce(X.known(F.col(c)), F.col(f"__{c}")) for c in head}).select(*LIFECYCLE)
    hashes = spark.read.format("binaryFile").load(path).select(F.col("path").alias("__path"), F.sha2("content", 256).alias("__hash"))
    name = lambda c: F.regexp_replace(c, "^file:/+", "/")
    bare = df.filter("symbols is null and symbol is not null").join(hashes, name(F.col("__file")) == name(F.col("__path")), "left")
    level = F.coalesce(X.known(F.col("evidence_level")), F.lit("USER_PROVIDED_UNVERIFIED"))
    bare = bare.withColumns({"source_hash": F.coalesce(X.known(F.col("source_hash")), "__hash"), "source_uri": F.coalesce("source_uri", "__file"), "evidence_level": level}).select(*LIFECYCLE)
    return _lifecycle_rows(nested.unionByName(bare), {"evidence_level": "UNKNOWN"} | defaults)
