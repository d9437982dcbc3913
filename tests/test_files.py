"""Readers, sinks and the streaming collector on small files."""

import hashlib
import json
import zipfile

import pytest
from pyspark.sql import functions as F

from tidemark.operators import universe
from tidemark.sources import readers, sinks
from tidemark.streaming import collect

LINE = "1704067200000,7.5,8.25,7.0,8.0,3.5,1704067259999,26.25,12,1.5,11.25"


def test_candle_csv(spark, tmp_path):
    d = tmp_path / "candles/futures-um/1m/symbol=BTCUSDT"
    d.mkdir(parents=True)
    (d / "BTCUSDT-1m-2024-01.csv").write_text(LINE + "\n")
    df = readers.read_candle_csv(spark, str(d / "*.csv"))
    r = df.first()
    assert len(df.columns) == 16 and (r.symbol, r.interval, r.period, r.open_time_ms, r.number_of_trades) == ("BTCUSDT", "1m", "2024-01", 1704067200000, 12)
    (d / "BTCUSDT-1m-2024-02.csv").write_text("1,2,3\n")
    with pytest.raises(Exception, match="candle without|CAST_INVALID"):
        readers.read_candle_csv(spark, str(d / "*.csv")).collect()


def test_zip_and_checksum(spark, tmp_path):
    for name, sound in (("A-1m-2024-01", True), ("B-1m-2024-01", False)):
        with zipfile.ZipFile(tmp_path / f"{name}.zip", "w") as z:
            z.writestr(f"{name}.csv", LINE)
        digest = hashlib.sha256((tmp_path / f"{name}.zip").read_bytes()).hexdigest()
        (tmp_path / f"{name}.zip.CHECKSUM").write_text(f"{digest if sound else '0' * 64}  {name}.zip\n")
    assert sorted(r.symbol for r in readers.read_candle_zip(spark, str(tmp_path)).collect()) == ["A", "B"]
    assert {r.path[-16:-15]: r.status for r in readers.verify_checksums(spark, str(tmp_path)).collect()} == {"A": "OK", "B": "MISMATCH"}


def test_sentiment_and_derivatives_json(spark, tmp_path):
    (tmp_path / "s.json").write_text(json.dumps({"data": [{"value": "40", "value_classification": "Fear", "timestamp": "1672531200"}, {"value": "20", "value_classification": "Extreme Fear", "timestamp": "1672444800"}]}))
    got = readers.read_sentiment_json(spark, str(tmp_path / "s.json")).orderBy("event_time_ms").collect()
    assert [(r.event_time_ms, r.score, r.label) for r in got] == [(1672444800000, 20.0, "Extreme Fear"), (1672531200000, 40.0, "Fear")]
    (tmp_path / "f.json").write_text(json.dumps([{"fundingRate": "0.0001", "markPrice": "", "fundingTime": 1672560000000}] * 2))
    rows = readers.read_derivatives_json(spark, str(tmp_path / "f.json"), "funding_rate", "LINKUSDT").collect()
    assert len(rows) == 1 and rows[0].value == 0.0001 and rows[0].extra_1 is None


def test_partitioned_sink(spark, tmp_path):
    df = spark.createDataFrame([("A", "2024", "01", 2), ("A", "2024", "01", 1), ("B", "2024", "02", 3)], "symbol string, year string, month string, t long")
    sinks.write_table(df, str(tmp_path / "t"), ["symbol", "year", "month"], ["t"])
    assert spark.read.parquet(str(tmp_path / "t")).count() == 3
    assert (tmp_path / "t/symbol=A/year=2024/month=01").is_dir()


def test_counts_and_ranges_from_footers(spark, tmp_path):
    """Row groups, nulls, no rows, no statistics and no such column; equal to a scan."""
    import pyarrow as pa
    import pyarrow.parquet as pq

    put = lambda name, at, **kw: pq.write_table(pa.table({"open_time_ms": pa.array(at, pa.int64()), "x": pa.array([0.5] * len(at))}), tmp_path / f"{name}.parquet", **kw)
    put("a", list(range(5, 1005)), row_group_size=100)
    put("b", [7, None, 3], row_group_size=2)
    put("c", [])
    put("d", [9, 4], write_statistics=False)
    put("e", [None, None])
    pq.write_table(pa.table({"x": [1, 2]}), tmp_path / "f.parquet")
    got = {r.path[-9]: (r.row_count, r.lo, r.hi) for r in readers.read_footers(spark, str(tmp_path)).collect()}
    assert got == {"a": (1000, 5, 1004), "b": (3, 3, 7), "c": (0, None, None), "d": (2, 4, 9), "e": (2, None, None), "f": (2, None, None)}
    rows = spark.read.schema("open_time_ms bigint").parquet(str(tmp_path)).groupBy(F.col("_metadata.file_name").alias("f")).agg(F.count("*").alias("n"), F.min("open_time_ms").alias("lo"), F.max("open_time_ms").alias("hi"))
    assert {r.f[0]: (r.n, r.lo, r.hi) for r in rows.collect()} == {k: v for k, v in got.items() if v[0]}


@pytest.mark.parametrize("kind", ["parquet", "csv", "json"])
def test_files_by_name_are_in_order(spark, tmp_path, kind):
    rows = [(f"S{k * 7 % 50:02}", k * 13 % 97) for k in range(500)]
    sinks.write_ordered(spark.createDataFrame(rows, "symbol string, t int").repartition(7), str(tmp_path / "t"), ["symbol", "t"], kind, file_rows=60)
    names = sorted(p.name for p in (tmp_path / "t").glob("part-*"))
    read = [(r.symbol, r.t) for n in names for r in spark.read.schema("symbol string, t int").format(kind).load(str(tmp_path / "t" / n)).coalesce(1).collect()]
    assert len(names) > 3 and read == sorted(rows)


def test_flat_hash_is_that_of_the_sorted_lines(spark):
    rows = [(f"p/{k * 37 % 1000:03}.parquet", hashlib.sha256(str(k).encode()).hexdigest()) for k in range(1000)]
    df = spark.createDataFrame(rows, "path string, sha256 string").repartition(5)
    want = hashlib.sha256("".join(f"{p}:{h}\n" for p, h in sorted(rows)).encode()).hexdigest()
    assert tuple(universe.flat_hash(df).first()) == (want, 1000)
    assert tuple(universe.flat_hash(df.limit(0)).first()) == (hashlib.sha256().hexdigest(), 0)


@pytest.mark.parametrize("resumes", [True, False])
def test_flat_hash_hands_its_state_on(spark, monkeypatch, resumes):
    """No task reads all lines: each range is a job of its own that goes on from the state before; where that is hidden, one task has the same result."""
    if not resumes:
        monkeypatch.setattr(universe, "_openssl_resumes", lambda: False)
    ran, run = [], spark.sparkContext.runJob
    monkeypatch.setattr(spark.sparkContext, "runJob", lambda rdd, f, partitions=None, *more: (ran.append(partitions), run(rdd, f, partitions, *more))[1])
    monkeypatch.setattr(universe, "_digest", lambda *a, made=universe._digest: (ran.append(a[0]), made(*a))[1])
    rows = [(f"p/{k * 37 % 1000:03}:é{'x' * (k % 70)}", str(k)) for k in range(1000)] + [("p/0", "1"), ("p/0", "1")]
    df = spark.createDataFrame(rows, "path string, sha256 string").repartition(5)
    want = hashlib.sha256("".join(f"{p}:{h}\n" for p, h in sorted(rows)).encode()).hexdigest()
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert tuple(universe.flat_hash(df).first()) == (want, 1002)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    jobs, states = [x for x in ran if isinstance(x, list)], [x for x in ran if not isinstance(x, list)]
    assert jobs == [[k] for k in range(4 if resumes else 1)]
    assert len(set(states)) == len(jobs)


@pytest.fixture
def landing(spark, tmp_path):
    """land(name, hash, day) puts a snapshot file down; rows() are the archive's (id, hash)."""
    (tmp_path / "in").mkdir()

    def land(name, h, day=15, n=None):
        symbols = [{"symbol": "BTCUSDT", "status": "TRADING", "onboard_at": "2020-01-01T00:00:00Z"}, {"symbol": f"{h}USDT", "status": "BREAK"}]
        (tmp_path / f"in/{name}.json").write_text(json.dumps({"schema_version": "1", "snapshot_id": n or name, "snapshot_hash": h, "collected_at": f"2024-01-{day}T00:00:00Z", "observed_at": f"2024-01-{day}T00:00:00Z", "trust_level": "OFFICIAL", "symbols": symbols}))

    args = [str(tmp_path / x) for x in ("in", "archive", "summary", "checkpoint")]
    return land, args, lambda: sorted((r.snapshot_id, r.snapshot_hash) for r in spark.read.parquet(args[1]).collect())


def test_collector_archives_a_hash_once(spark, landing, tmp_path):
    """Twice in one batch, also as the same snapshot; in batches apart; after a restart; after a batch that wrote and was not committed."""
    land, args, rows = landing
    for name, h, n in (("a", "1", None), ("b", "1", None), ("c", "2", "same"), ("d", "2", "same"), ("e", None, None)):
        land(name, h, n=n)
    (tmp_path / "in/bad.json").write_text('{"invalid": true}')
    collect.collect(spark, *args)
    assert rows() == [("a", "1"), ("same", "2")]
    land("f", "1")
    land("g", "3", day=16)
    collect.collect(spark, *args)
    assert rows() == [("a", "1"), ("g", "3"), ("same", "2")]
    for p in (tmp_path / "checkpoint/commits").glob("*1*"):
        p.unlink()
    land("h", "3")
    collect.collect(spark, *args)
    assert rows() == [("a", "1"), ("g", "3"), ("same", "2")]
    assert spark.read.parquet(f"{args[2]}/archive").first().snapshots == 3


def test_collector_knows_what_was_archived_before(spark, landing):
    land, args, rows = landing
    sinks.append_archive(spark.createDataFrame([("old", "2024-01-02T00:00:00Z", "1", "OFFICIAL", None, [("AUSDT", "TRADING", None, None)])], "snapshot_id string, collected_at string, snapshot_hash string, trust_level string, observed_at string, symbols array<struct<symbol: string, status: string, onboard_at: string, delivery_at: string>>"), args[1])
    land("a", "1")
    land("b", "2")
    collect.collect(spark, *args)
    assert rows() == [("b", "2"), ("old", "1")]


def test_summaries_by_day_equal_those_of_all(spark, landing):
    """Days that come late, and days that grow, after which the parts say what a full computation says."""
    land, args, _ = landing
    for turn in ([("a", "1", 15), ("b", "2", 16)], [("c", "3", 14)], [("d", "4", 15), ("e", "5", 17)]):
        for x in turn:
            land(*x)
        collect.collect(spark, *args)
    got = [spark.read.parquet(f"{args[2]}/{x}").collect() for x in ("archive", "symbols")]
    collect.refresh(spark, args[1], args[2] + "-anew")
    assert [sorted(map(str, x)) for x in got] == [sorted(map(str, spark.read.parquet(f"{args[2]}-anew/{x}").collect())) for x in ("archive", "symbols")]
    a, b = got[0][0], {r.symbol: r for r in got[1]}["BTCUSDT"]
    assert (a.snapshots, a.earliest, a.latest) == (5, "2024-01-14T00:00:00Z", "2024-01-17T00:00:00Z")
    assert (b.times_seen, b.first_seen, b.last_seen, b.statuses, b.has_onboard, b.has_delivery) == (5, "2024-01-14T00:00:00Z", "2024-01-17T00:00:00Z", "TRADING", True, False)


def test_streams(spark, tmp_path):
    """The watermarked forms: a snapshot hash once, and rows by day of availability and days of lag."""
    (tmp_path / "in").mkdir()
    for n, h in (("a", "1"), ("b", "1"), ("c", "2")):
        (tmp_path / f"in/{n}.json").write_text(json.dumps({"schema_version": "1", "snapshot_id": n, "snapshot_hash": h, "collected_at": "2024-01-15T00:00:00Z", "observed_at": "2024-01-15T00:00:00Z", "trust_level": "OFFICIAL", "symbols": [{"symbol": "BTCUSDT", "status": "TRADING"}]}))

    def rows(stream, name, mode):
        query = stream.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", str(tmp_path / name)).trigger(availableNow=True).start()
        query.awaitTermination()
        return spark.table(name).collect()

    got = rows(collect.deduplicated(collect.snapshot_stream(spark, str(tmp_path / "in"))), "once", "append")
    assert sorted(r.snapshot_hash for r in got) == ["1", "2"]
    times = spark.sql("select timestamp'2024-01-01 05:00:00' as e, timestamp'2024-01-03 01:00:00' as a union all select timestamp'2024-01-01 09:00:00', timestamp'2024-01-03 02:00:00'")
    times.write.parquet(str(tmp_path / "times"))
    got = rows(collect.lag_histogram(spark.readStream.schema(times.schema).parquet(str(tmp_path / "times")), "e", "a"), "lags", "complete")
    assert [(r.lag_days, r.rows) for r in got] == [(2, 2)]
