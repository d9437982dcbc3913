"""Ingest from files end to end, and the readers and sinks that it does not reach."""

import hashlib
import json
import zipfile

import pytest
from pyspark.sql import functions as F

from tidemark.operators import lifecycle, listing, storage
from tidemark.plans import ingest
from tidemark.sources import readers, sinks

MIN = 60_000
JAN, FEB = 1704067200000, 1706745600000


def candle(t):
    return f"{t},7.5,8.25,7.0,8.0,3.5,{t + MIN - 1},26.25,12,1.5,11.25"


def land(folder, symbol, period, lines, member=None, sound=True):
    folder.mkdir(parents=True, exist_ok=True)
    path = folder / f"{symbol}-1m-{period}.zip"
    with zipfile.ZipFile(path, "w") as z:
        z.writestr(member or f"{symbol}-1m-{period}.csv", "\n".join(lines))
    digest = hashlib.sha256(path.read_bytes()).hexdigest() if sound else "0" * 64
    (folder / f"{path.name}.CHECKSUM").write_text(f"{digest}  {path.name}\n")


def test_candles_from_archives_to_a_table(spark, tmp_path):
    landed, out = tmp_path / "in", str(tmp_path / "candles")
    header = "open_time,open,high,low,close,volume,close_time,q,n,b,c"
    land(landed, "AAAUSDT", "2024-01", [header, candle(JAN), candle(JAN + MIN)])
    land(landed, "AAAUSDT", "2024-02", [candle(FEB)])
    (landed / "AAAUSDT-1m-2024-02.zip.CHECKSUM").unlink()
    land(landed, "BBBUSDT", "2024-01", [candle(JAN)], sound=False)
    land(landed, "BBBUSDT", "2024-02", [candle(FEB), candle(FEB).replace("8.25", "high")])
    land(landed, "CCCUSDT", "2024-01", [candle(JAN)], member="other.csv")
    land(landed, "CCCUSDT", "2024-02", [header])
    (landed / "DDDUSDT-1m-2024-01.zip").write_bytes(b"no archive")
    symbols = ["aaausdt ", "BBBUSDT", "CCCUSDT", "DDDUSDT"]
    run = lambda **kw: {(r.symbol[0], r.period[-1]): (r.state, r.row_count) for r in ingest.ingest_candles(spark, str(landed), out, symbols, "2024-01-01", "2024-02-01", "futures-um", "1m", **kw).collect()}
    assert set(run(policy="dry-run").values()) == {("PLANNED", None)}
    want = {("A", "1"): ("WRITTEN", 2), ("A", "2"): ("WRITTEN", 1), ("B", "1"): ("FAILED_CHECKSUM", None), ("B", "2"): ("FAILED_ARCHIVE", 2), ("C", "1"): ("FAILED_ARCHIVE", 0), ("C", "2"): ("FAILED_VALIDATION", None), ("D", "1"): ("FAILED_ARCHIVE", 0), ("D", "2"): ("MISSING", None)}
    assert run() == want
    rows = readers.read_series(spark, out, "2024-01", "2024-01", symbol="AAAUSDT", interval="1m")
    assert [r.open_time_ms for r in rows.orderBy("open_time_ms").collect()] == [JAN, JAN + MIN]
    assert {(r.symbol, r.open_time_ms) for r in readers.read_candle_times(spark, out).collect()} == {("AAAUSDT", JAN), ("AAAUSDT", JAN + MIN), ("AAAUSDT", FEB)}
    again = run(verify=False)
    assert again["A", "1"][0] == again["A", "2"][0] == "SKIP_EXISTING" and again["B", "1"] == ("WRITTEN", 1)
    assert run(policy="overwrite")["A", "1"] == ("WRITTEN", 2)
    assert spark.read.parquet(out).count() == 4
    with pytest.raises(ValueError, match="market"):
        ingest.ingest_candles(spark, str(landed), out, ["A"], "2024-01-01", "2024-01-01", "moon", "1m")


def test_archives_are_unzipped_once_and_a_run_can_be_repeated(spark, tmp_path, monkeypatch):
    """Days are objects of their own beside each other; a run that stops between staging and publishing changes nothing, the next one ends as if it had not been."""
    landed, out = tmp_path / "in", str(tmp_path / "candles")
    day = 86_400_000
    for k in range(3):
        land(landed, "AAAUSDT", f"2024-01-0{k + 1}", [candle(JAN + k * day), candle(JAN + k * day + MIN)])
    reads = spark.sparkContext.accumulator(0)
    run = lambda last, **kw: {r.period[-1]: r.state for r in ingest.ingest_candles(spark, str(landed), out, ["AAAUSDT"], "2024-01-01", last, "futures-um", "1m", unit="day", reads=reads, **kw).collect()}
    assert run("2024-01-01") == {"1": "WRITTEN"} and reads.value == 1
    real = ingest.publish
    monkeypatch.setattr(ingest, "publish", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError, match="lost"):
        run("2024-01-03")
    assert spark.read.parquet(out).count() == 2 and reads.value == 3
    monkeypatch.setattr(ingest, "publish", real)
    assert run("2024-01-03") == {"1": "SKIP_EXISTING", "2": "WRITTEN", "3": "WRITTEN"} and reads.value == 5
    assert run("2024-01-03") == dict.fromkeys("123", "SKIP_EXISTING") and reads.value == 5
    assert sorted(r.open_time_ms for r in spark.read.parquet(out).collect()) == [JAN + k * day + m for k in range(3) for m in (0, MIN)]


def test_sentiment_from_files_to_a_table(spark, tmp_path):
    """The first item of a day wins by file and place; bounds are those of the caller; a series with a broken rule is not written."""
    day = 86_400
    item = lambda k, v, label="Extreme Fear": {"value": str(v), "value_classification": label, "timestamp": str(JAN // 1000 + k * day)}
    (tmp_path / "in").mkdir()
    (tmp_path / "in/b.json").write_text(json.dumps({"data": [item(1, 99), item(31, 70, "Greed"), item(32, 400), item(90, 1)]}))
    (tmp_path / "in/a.json").write_text(json.dumps({"data": [item(1, 20), item(1, 30), item(0, 10)]}))
    out = str(tmp_path / "out")
    r = ingest.ingest_sentiment(spark, str(tmp_path / "in"), out, JAN, JAN + 60 * day * 1000).first()
    assert (r.row_count, r.objects, r.coverage_start_ms, r.coverage_end_ms, r.status, r.reason) == (3, 2, JAN, JAN + 31 * day * 1000, "PASS", None)
    assert r.object_keys.split(",")[0] == "datasets/sentiment/source=alternative_me/dataset=fear_greed/scope=global/interval=1d/year=2024/month=01/fear_greed-2024-01.parquet"
    rows = readers.read_series(spark, out).orderBy("event_time_ms").collect()
    assert [(x.event_time_ms, x.score, x.label, x.available_at_ms) for x in rows][:2] == [(JAN, 10.0, "extreme_fear", JAN + day * 1000), (JAN + day * 1000, 20.0, "extreme_fear", JAN + 2 * day * 1000)]
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad/a.json").write_text(json.dumps({"data": [item(0, 10), item(1, 20, "")]}))
    r = ingest.ingest_sentiment(spark, str(tmp_path / "bad"), str(tmp_path / "none"), JAN, JAN + 60 * day * 1000).first()
    assert (r.row_count, r.status, r.reason) == (0, "FAIL", "missing label") and not list((tmp_path / "none").glob("kind=*"))
    r = ingest.ingest_sentiment(spark, str(tmp_path / "bad"), str(tmp_path / "none"), 1, 2).first()
    assert (r.row_count, r.status, r.reason) == (0, "FAIL", "empty rows")


def test_hashes_and_archives_of_any_size(spark, tmp_path):
    """Files larger than a piece, in both ways of reading them."""
    big = tmp_path / "big.bin"
    with big.open("wb") as f:
        for k in range(40):
            f.write(bytes([k]) * (1 << 20))
    want = hashlib.sha256(big.read_bytes()).hexdigest()
    assert readers.read_hashes(spark, str(tmp_path), "*.bin").first().sha256 == want
    lines = [candle(JAN + k * MIN) for k in range(120_000)]
    land(tmp_path / "z", "AAAUSDT", "2024-01", lines)
    assert readers.read_candle_zip(spark, str(tmp_path / "z")).count() == 120_000
    whole = spark.read.format("binaryFile").load(str(tmp_path / "z/*.zip")).select("path", "content")
    assert readers.read_archives(whole).agg(F.max("open_time_ms")).first()[0] == JAN + 119_999 * MIN


def test_derivatives_from_pages_to_a_table(spark, tmp_path):
    page = lambda *at: json.dumps([{"fundingRate": "0.5", "markPrice": "x", "fundingTime": t} for t in at])
    for s, pages in {"AAAUSDT": [page(JAN, JAN + 8 * 60 * MIN), page(JAN + 8 * 60 * MIN, FEB)], "BBBUSDT": [page(5)]}.items():
        (tmp_path / "in" / s).mkdir(parents=True)
        for k, text in enumerate(pages):
            (tmp_path / "in" / s / f"{k}.json").write_text(text)
    got = {r.symbol: r for r in ingest.ingest_derivatives(spark, str(tmp_path / "in"), str(tmp_path / "out"), "funding_rate", ["AAAUSDT", "BBBUSDT"], JAN, FEB).collect()}
    a, b = got["AAAUSDT"], got["BBBUSDT"]
    assert (a.row_count, a.objects, a.coverage_start_ms, a.coverage_end_ms, a.status, a.reason) == (3, 2, JAN, FEB, "PASS", None)
    assert a.object_keys.split(",")[0] == "datasets/derivatives/source=exchange/dataset=funding_rate/market=futures-um/symbol=AAAUSDT/interval=8h/year=2024/month=01/AAAUSDT-funding_rate-2024-01.parquet"
    assert (b.row_count, b.status, b.reason) == (0, "FAIL", "empty rows")
    assert readers.read_series(spark, str(tmp_path / "out"), "2024-02", symbol="AAAUSDT").count() == 1


@pytest.mark.parametrize(("dataset", "record"), [("open_interest", {"sumOpenInterest": "3", "sumOpenInterestValue": "4.5"}), ("long_short_ratio", {"longShortRatio": "3", "longAccount": "4.5", "shortAccount": "bad"}), ("top_trader_ratio", {"longShortRatio": "3", "longAccount": "4.5"}), ("taker_volume", {"buySellRatio": "3", "buyVol": "4.5", "sellVol": None})])
def test_derivatives_datasets(spark, tmp_path, dataset, record):
    (tmp_path / "x.json").write_text(json.dumps([record | {"timestamp": JAN}]))
    r = readers.read_derivatives_json(spark, str(tmp_path), dataset, "AAAUSDT").first()
    assert (r.value, r.extra_1, r.extra_2, r.event_time_ms) == (3.0, 4.5, None, JAN)


def test_lifecycle_readers(spark, tmp_path):
    (tmp_path / "a.csv").write_text("Symbol, LISTED_AT_UTC,delisted_at_utc,evidence_level,source_hash,source_uri_or_path\n aaausdt,2024-01-01T02:00:00+02:00,not-a-date,,,/x\nBBBUSDT,UNKNOWN,,verified_exchange_listing,h,\n")
    a, b = readers.read_lifecycle_csv(spark, str(tmp_path / "a.csv"), exchange="x").orderBy("symbol").collect()
    assert (a.symbol, a.base_asset, a.quote_asset, a.exchange, a.listed_at, a.delisted_at, a.malformed, a.evidence_level, a.source_uri) == ("AAAUSDT", "AAA", "USDT", "x", "2024-01-01T00:00:00Z", "not-a-date", True, "USER_PROVIDED_UNVERIFIED", "/x")
    assert (b.listed_at, b.delisted_at, b.malformed, b.evidence_level) == (None, None, False, "VERIFIED_EXCHANGE_LISTING")
    (tmp_path / "m.json").write_text(json.dumps({"exchange": "e", "quote_asset": "USDT", "symbols": [{"symbol": "ccc", "status": "active", "market_type": "spot"}]}))
    m = readers.read_lifecycle_json(spark, str(tmp_path / "m.json"), market_type="futures").first()
    assert (m.symbol, m.status, m.exchange, m.market_type, m.evidence_level, m.source_hash) == ("CCC", "ACTIVE", "e", "spot", "UNKNOWN", None)
    (tmp_path / "s.json").write_text(json.dumps([{"symbol": "DDDUSDT"}]))
    s = readers.read_lifecycle_json(spark, str(tmp_path / "s.json")).first()
    assert s.evidence_level == "USER_PROVIDED_UNVERIFIED" and s.source_hash == hashlib.sha256((tmp_path / "s.json").read_bytes()).hexdigest()
    assert readers.read_manifest(spark, str(tmp_path / "m.json"), "exchange string, missing string").collect() == [("e", None)]
    graded = lifecycle.grade_sources(spark.createDataFrame([("/x", None, "HISTORICAL_SNAPSHOT_EVIDENCE"), ("/y", None, "HISTORICAL_SNAPSHOT_EVIDENCE")], "source_uri string, source_hash string, evidence_level string"), spark.createDataFrame([("/x", "f")], "path string, sha256 string"))
    assert {(r.source_uri, r.source_hash, r.confidence) for r in graded.collect()} == {("/x", "f", "MEDIUM"), ("/y", None, "LOW")}


def payload(symbols, time=JAN):
    return json.dumps({"serverTime": time, "symbols": [{"symbol": s, "status": "TRADING", "onboardDate": JAN, "deliveryDate": 0, "permissions": ["B", "A"]} for s in symbols]})


def test_listing_files_and_backfill(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for name, text in {"2024-01-05": payload(["AAAUSDT"]), "x": payload(["AAAUSDT"], FEB), "y": payload(["BBBBTC"]), "z": "no json", "w": '{"symbols": []}'}.items():
        (tmp_path / f"in/{name}.json").write_text(text)
    s = listing.listing_symbols(readers.read_listing_json(spark, str(tmp_path / "in/y.json"))).first()
    assert (s.symbol, s.base_asset, s.quote_asset, s.status, s.onboard_at, s.delivery_at, s.permissions, s.source_fields) == ("BBBBTC", "BBB", "BTC", "TRADING", "2024-01-01T00:00:00Z", None, "A,B", "symbol,status,onboardDate")
    assert listing.listing_symbols(readers.read_listing_json(spark, str(tmp_path / "in")), " btc ").select("symbol").distinct().count() == 1
    rows = readers.read_backfill(spark, [str(tmp_path / "in/x.json")], str(tmp_path / "in"), "yyyy-MM-dd")
    got = {r.path.rsplit("/", 1)[-1]: r for r in rows.collect()}
    assert len(got) == 5 and got["2024-01-05.json"].observed == "2024-01-05T00:00:00Z" and got["x.json"].observed == "2024-02-01T00:00:00Z" and got["z.json"].hash is None and got["w.json"].hash is None
    done, findings = listing.backfill_report(rows, rows.filter("path like '%/y.json'").select("hash"), "UNKNOWN")
    assert {r.path.rsplit("/", 1)[-1]: r.outcome for r in done.collect()} == {"2024-01-05.json": "IMPORTED", "x.json": "DUPLICATE", "y.json": "DUPLICATE", "z.json": "SKIPPED", "w.json": "SKIPPED"}
    codes = sorted(r.code.removeprefix("EXCHANGE_BACKFILL_") for r in findings.collect())
    assert codes == ["DUPLICATE_SNAPSHOT"] * 2 + ["INPUT_PARSE_FAILED"] * 2 + ["TRUST_LEVEL_UNKNOWN"]
    assert [r.code for r in listing.backfill_report(rows.limit(0), rows.select("hash"), None)[1].collect()] == ["EXCHANGE_BACKFILL_INPUT_EMPTY"]
    h = listing.intake_hashes(done, "UNKNOWN").first()
    assert len(h.source_batch_hash) == len(h.imported_snapshot_set_hash) == 64


def test_archive_integrity(spark, tmp_path):
    body = payload(["AAAUSDT"])
    digest = hashlib.sha256(body.encode()).hexdigest()
    (tmp_path / f"raw_1_{digest}.json").write_text(body)
    (tmp_path / f"raw_2_{'b' * 64}.json").write_text("other")
    raw = readers.read_raw_payloads(spark, str(tmp_path))
    rows = [("ok", "h1", "h1", digest, 1, "archive"), ("changed", "h2", "h3", "b" * 64, 1, "archive"), ("lost", "h4", "h4", "c" * 64, 1, "public_endpoint_current"), ("empty", "h5", "h5", "UNKNOWN", 0, "a"), ("torn", None, None, None, None, None), ("twice", "h6", "h6", None, 1, "a"), ("twice", "h7", "h7", None, 1, "a"), ("same", "h8", "h8", None, 1, "a"), ("same", "h8", "h8", None, 1, "a")]
    snaps = spark.createDataFrame(rows, "snapshot_id string, snapshot_hash string, computed_hash string, raw_sha256 string, symbols long, source_type string")
    manifest = lambda n, sound: spark.createDataFrame([(n, sound)], "snapshot_count long, sound boolean")
    found = lambda *a, **kw: sorted((r.target, r.code.removeprefix("EXCHANGE_ARCHIVE_"), r.severity) for r in listing.archive_integrity(*a, **kw).collect())
    want = [("changed", "HASH_MISMATCH", "FAIL"), ("changed", "RAW_PAYLOAD_MISSING", "FAIL"), ("empty", "EMPTY", "FAIL"), ("lost", "CURRENT_ONLY_EVIDENCE", "WARN"), ("lost", "RAW_PAYLOAD_MISSING", "WARN"), ("same", "DUPLICATE_SNAPSHOT", "WARN"), ("torn", "SNAPSHOT_PARSE_FAILED", "FAIL"), ("twice", "CONFLICTING_SNAPSHOT", "FAIL")]
    assert found(snaps, raw, manifest(8, True)) == want
    strict = [(a, b, "FAIL" if b in ("DUPLICATE_SNAPSHOT",) or (a, b) == ("lost", "RAW_PAYLOAD_MISSING") else c) for a, b, c in want]
    assert found(snaps, raw, manifest(7, True), strict=True) == sorted([*strict, ("manifest", "MANIFEST_STALE", "FAIL")])
    assert found(snaps.filter("snapshot_id = 'ok'"), raw, manifest(1, False)) == [("manifest", "HASH_MISMATCH", "FAIL")]
    assert found(snaps.filter("snapshot_id = 'ok'"), raw, manifest(1, True).limit(0)) == [("manifest", "MANIFEST_STALE", "FAIL")]
    assert found(snaps.limit(0), raw, manifest(0, True)) == [("archive", "EMPTY", "FAIL")]


def test_archive_tables(spark, tmp_path):
    rows = spark.createDataFrame([("a", "2024-01-01T23:30:00-02:00", "h"), ("b", "2024-01-01T01:00:00Z", "g")], "snapshot_id string, collected_at string, snapshot_hash string")
    sinks.append_archive(rows, str(tmp_path / "archive"))
    assert {(r.snapshot_id, int(r.day)) for r in spark.read.parquet(str(tmp_path / "archive")).collect()} == {("a", 2), ("b", 1)}
    sinks.write_payloads(rows.select(F.col("snapshot_hash").alias("sha256"), F.lit(b"raw").alias("content"), "collected_at"), str(tmp_path / "raw"))
    assert bytes(spark.read.parquet(str(tmp_path / "raw")).first().content) == b"raw"
    utc = rows.withColumn("collected_at", F.when(F.col("snapshot_id") == "a", "2024-01-02T01:30:00Z").otherwise(F.col("collected_at")))
    sinks.write_latest(utc, str(tmp_path / "latest"))
    assert [r.snapshot_id for r in spark.read.parquet(str(tmp_path / "latest")).collect()] == ["a"]
    one = listing.snapshot_manifest(utc.withColumnRenamed("collected_at", "collected").withColumns({"trust": F.lit("OFFICIAL"), "observed": F.col("collected"), "symbols": F.lit(1)})).first()
    assert one.snapshots == 2 and len(one.archive_hash) == 64
    sinks.write_csv(rows, str(tmp_path / "csv"), ["snapshot_hash", "snapshot_id"])
    assert spark.read.option("header", "true").csv(str(tmp_path / "csv")).columns == ["snapshot_hash", "snapshot_id"]
    sinks.write_json(rows.withColumn("none", F.lit(None).cast("string")), str(tmp_path / "json"))
    assert spark.read.json(str(tmp_path / "json")).columns == ["collected_at", "snapshot_hash", "snapshot_id"]
    (tmp_path / "snap").mkdir()
    (tmp_path / "snap/a.json").write_text(json.dumps({"schema_version": "1", "snapshot_id": "a", "symbols": [{"symbol": "A"}]}))
    (tmp_path / "snap/b.json").write_text("{}")
    assert [r.snapshot_id for r in readers.read_snapshots(spark, str(tmp_path / "snap")).collect()] == ["a"]
    assert {r.path.rsplit("/", 1)[-1] for r in readers.read_files(spark, str(tmp_path / "snap"), "*.json").collect()} == {"a.json", "b.json"}


def test_catalogue_targets_and_labels(spark):
    c = spark.createDataFrame([("a", "VERIFIED", 1), ("b", "VERIFIED", 1), ("c", "KEPT", 1), ("d", "VERIFIED", 1)], "path string, status string, length long")
    seen = spark.createDataFrame([("a", "VERIFIED", 2), ("b", "SIZE_MISMATCH", 1), ("e", "VERIFIED", 1), ("f", "LOCAL_ONLY", 1)], "path string, status string, length long")
    assert {(r.path, r.status) for r in storage.catalogue_update(c, seen).collect()} == {("a", "VERIFIED"), ("b", "UNKNOWN"), ("c", "KEPT"), ("d", "UNKNOWN"), ("e", "VERIFIED"), ("f", "UNKNOWN")}
    files = spark.createDataFrame([("A", "2023"), ("A", "2025"), ("B", "2023")], "symbol string, year string")
    assert storage.targets(files, [" a"], 2022, 2024).count() == 1 and storage.targets(files, None, 2022, 2024).count() == 2
    label = lambda *o, **kw: storage.outcome_summary(spark.createDataFrame([(x,) for x in o], "outcome string"), **kw).first().final_label
    assert label("MISSING", "FAILED_VALIDATION") == "blocked_missing_r2_objects" and label("FAILED_VALIDATION", "FAILED_RESTORE") == "blocked_validation_failure"
    assert label("FAILED_RESTORE", "RESTORED") == "partial_restore" and label("PLANNED", dry_run=True) == "dry_run_complete" and label("RESTORED") == "restore_complete"


def test_objects_and_lifecycle_base(spark, tmp_path):
    for name in ("A-1m-2024-01.parquet", "A-1m-2024-02-10.parquet", "A-1m-2024-03.parquet", "other.parquet"):
        (tmp_path / name).write_text("x")
    assert sorted(r.path[-18:] for r in readers.list_objects(spark, str(tmp_path), "2024-01-31", "2024-02-10").collect()) == ["-1m-2024-01.parquet"[-18:], "m-2024-02-10.parquet"[-18:]]
    (tmp_path / "l.csv").write_text("symbol,status,listed_at,evidence_level\nAAA,ACTIVE,2024-01-01T00:00:00Z,USER_PROVIDED_UNVERIFIED\n")
    data = lifecycle.lifecycle_from_data(spark.createDataFrame([("AAA", "1m", "spot", 5), ("BBB", "1m", "spot", 7)], "symbol string, interval string, market string, t long"), "t")
    base = lifecycle.lifecycle_base(readers.read_lifecycle_csv(spark, str(tmp_path / "l.csv")), data)
    got = {r.symbol: (r.status, r.listed_ms, r.evidence_level) for r in base.collect()}
    assert got == {"AAA": ("ACTIVE", JAN, "USER_PROVIDED_UNVERIFIED"), "BBB": ("UNKNOWN", None, "LOCAL_DATA_FIRST_SEEN")}
    seen = spark.createDataFrame([("BBB", 1, "DELIVERED", JAN, FEB, False)], "symbol string, seq long, status string, onboard_ms long, delivery_ms long, unverified boolean")
    merged = {r.symbol: (r.status, r.listed_ms, r.delisted_ms, r.evidence_level) for r in lifecycle.merge_snapshots(base, seen).collect()}
    assert merged["BBB"] == ("DELISTED", JAN, FEB, "HISTORICAL_SNAPSHOT_EVIDENCE") and merged["AAA"][0] == "ACTIVE"


def test_a_folder_of_series_to_manifest_and_plans(spark, tmp_path):
    from tidemark.operators import universe

    rows = spark.createDataFrame([("futures", "1m", s, "2024", "01", JAN + k * MIN) for s in ("AAAUSDT", "BBBUSDT") for k in range(3)], "market string, interval string, symbol string, year string, month string, open_time_ms long")
    root = str(tmp_path / "t")
    sinks.write_table(rows, root, ["market", "interval", "symbol", "year", "month"], ["open_time_ms"])
    files = readers.scan_dataset(spark, root)
    got = {r.symbol: r for r in files.collect()}
    a = got["AAAUSDT"]
    assert (a.interval, a.market, a.row_count, a.lo, a.hi) == ("1m", "futures", 3, JAN, JAN + 2 * MIN) and a.path.startswith("market=futures/interval=1m/symbol=AAAUSDT/year=2024/month=01/")
    uni = universe.build_universe(universe.discover_symbols(files).withColumn("first_seen", F.lit(JAN)), spark.createDataFrame([("AAAUSDT", "ACTIVE", JAN, None, "UNKNOWN")], "symbol string, status string, listed_ms long, delisted_ms long, evidence_level string"), JAN, FEB)
    assert {r.symbol: r.in_lifecycle for r in uni.collect()} == {"AAAUSDT": True, "BBBUSDT": False}
    found = universe.union_warnings(universe.symbol_reconcile(files, uni, "USDT", "spot"), universe.range_findings(files.agg(F.min("lo").alias("start_ms"), F.max("hi").alias("end_ms")), JAN, FEB))
    m = universe.dataset_manifest(files, found).first()
    assert (m.symbols, m.files, m.rows, m.status, m.warning_codes) == (2, 2, 6, "FAIL", "UNIVERSE_DATASET_MARKET_TYPE_MISMATCH")
    local = readers.scan_files(spark, root, "*.parquet")
    assert {(r.symbol, r.year, r.month) for r in local.collect()} == {(s, "2024", "01") for s in got}
    usage = {(r.symbol, r.year, r.month): r.files for r in storage.storage_usage(local).collect()}
    assert usage[None, None, None] == 2 and usage["AAAUSDT", None, None] == 1
    seen = storage.archive_reconcile(local, local.filter("symbol = 'AAAUSDT'"))
    assert {(r.status) for r in seen.collect()} == {"VERIFIED", "LOCAL_ONLY"}


def test_snapshots_are_built_and_verified(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for n, text in {"a": payload(["AAAUSDT", "BBBBTC"]), "b": payload(["BBBBTC", "AAAUSDT"], FEB)}.items():
        (tmp_path / f"in/{n}.json").write_text(text)
    build = lambda: listing.build_snapshots(listing.listing_symbols(readers.read_listing_json(spark, str(tmp_path / "in"))), "X", "futures_um", "2024-03-01T00:00:00Z", "OFFICIAL_ARCHIVE", "archive")
    a, b = build().orderBy("observed_at").collect()
    assert a.snapshot_hash == b.snapshot_hash and a.snapshot_id == f"x_futures_um_20240301_000000_{a.snapshot_hash[:12]}" and (a.observed_at, b.observed_at) == ("2024-01-01T00:00:00Z", "2024-02-01T00:00:00Z")
    sinks.append_archive(build(), str(tmp_path / "archive"))
    archive = spark.read.parquet(str(tmp_path / "archive"))
    manifest = spark.createDataFrame([(2, True)], "snapshot_count long, sound boolean")
    found = lambda df: sorted(r.code.removeprefix("EXCHANGE_ARCHIVE_") for r in listing.archive_integrity(listing.verified_snapshots(df), archive.select(F.col("raw_sha256").alias("name_hash"), F.col("raw_sha256").alias("sha256")), manifest).collect())
    assert found(archive) == ["DUPLICATE_SNAPSHOT"]
    assert found(archive.withColumn("symbols", F.slice("symbols", 1, 1))) == ["DUPLICATE_SNAPSHOT", "HASH_MISMATCH"]
