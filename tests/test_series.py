"""Coverage audits and validators on micro-fixtures with exact expected counts."""

import random

import pytest
from pyspark.sql import functions as F

from tidemark.functions import exprs
from tidemark.operators import lifecycle, listing, series, storage
from tidemark.sources import readers

T0, MIN = 1704067200000, 60_000


def audit(spark, at, **kw):
    df = spark.createDataFrame([("BTCUSDT", "1m", T0 + i * MIN) for i in at], "symbol string, interval string, t long")
    return series.gap_audit(df, ["symbol", "interval"], "t", MIN, **kw).first()


@pytest.mark.parametrize("part_ms", [10 * MIN, 10**12])
def test_gap_audit(spark, part_ms):
    r = audit(spark, range(60), part_ms=part_ms)
    assert (r.rows, r.expected_rows, r.missing_rows, r.duplicate_rows, r.gap_count, r.status) == (60, 60, 0, 0, 0, "PASS")
    r = audit(spark, [i for i in range(60) if i != 30], min_pct=100.0, part_ms=part_ms)
    assert (r.rows, r.missing_rows, r.gap_count, r.largest_gap_seconds, r.status) == (59, 1, 1, 60, "FAIL")
    r = audit(spark, [*range(10), 5], part_ms=part_ms)
    assert (r.rows, r.expected_rows, r.duplicate_rows, r.status) == (11, 10, 1, "WARN")
    r = audit(spark, [0, 40], part_ms=part_ms)
    assert (r.missing_rows, r.gap_count, r.largest_gap_seconds) == (39, 1, 39 * 60)


@pytest.mark.parametrize(("at", "lo", "hi", "missing", "dups", "first", "status"), [([0, 1, 2], 0, 2, 0, 0, None, "PASS"), ([0, 2], 0, 2, 1, 0, 1, "FAIL"), ([0, 1, 1, 2], 0, 2, 0, 1, None, "FAIL"), ([9], 0, 2, 3, 0, 0, "FAIL"), ([2, 3], 0, 5, 4, 0, 0, "FAIL")])
def test_range_coverage(spark, at, lo, hi, missing, dups, first, status):
    df = spark.createDataFrame([("L", T0 + i * MIN) for i in at], "symbol string, t long")
    r = series.range_coverage(df, ["symbol"], "t", MIN, T0 + lo * MIN, T0 + hi * MIN).first()
    assert (r.missing_rows, r.duplicate_rows, r.status) == (missing, dups, status)
    assert r.first_missing_ms == (None if first is None else T0 + first * MIN)


def test_out_of_order(spark):
    df = spark.createDataFrame([("B", k, t) for k, t in enumerate([0, 2, 1, 3])], "s string, k int, t int")
    assert series.out_of_order(df, ["s"], "t", ["k"]).first().out_of_order_rows == 1


@pytest.mark.parametrize(("event", "available", "rule"), [(0, 0, "event_time_ms <= 0"), (2000, 0, "available_at_ms <= 0"), (2000, 1000, "available_at_ms < event_time_ms"), (2000, 2000, None)])
def test_validate(spark, event, available, rule):
    df = spark.createDataFrame([("x", event, available)], "s string, e long, a long")
    assert series.validate_rows(df, ["s"], ["e"], "e", "a", []).first().first_rule == rule


@pytest.mark.parametrize("block_files", [1, 3, 1000])
def test_one_budget_over_all_files(spark, block_files):
    """Against a walk file by file: large files are passed over, later smaller ones still fit, whatever block they lie in."""
    draw = random.Random(7)
    rows = [(f"candles/m/1h/symbol={draw.choice('ABC')}/{draw.choice(['year=1', 'year=1-x', 'y.z'])}/{k:03}.parquet", draw.choice([0, 1, 2, 7, 30, 90])) for k in range(120)] + [("z", None), ("candles", 3), ("candles", 3)]
    df = spark.createDataFrame(rows, "path string, length long")
    for budget in (0, 10, 500, 10**6):
        left, want = budget, []
        for path, n in sorted(rows, key=lambda r: (r[0].split("/"), -1 if r[1] is None else r[1])):
            want.append((path, n or 0, n is not None and n <= left))
            left -= n if want[-1][2] else 0
        assert sorted((r.path, r.length or 0, r.fits) for r in storage.within_budget(df, budget, block_files).collect()) == sorted(want)
    assert storage.within_budget(df.limit(0), 5).collect() == []


def test_cleanup_has_one_budget(spark):
    at = lambda s, k=0, m="spot": f"candles/{m}/1h/symbol={s}/year=2024/{k}.parquet"
    rows = [(at("A"), "A", "2024", 6, "VERIFIED"), (at("B"), "B", "2024", 6, "VERIFIED"), (at("C"), "C", "2024", 4, "VERIFIED"), (at("D"), "D", "2024", 1, "LOCAL_ONLY"), (at("E"), "E", "2024", 1, "VERIFIED"), (at("C", 1), "C", "2020", 1, "VERIFIED"), (at("F", m="um"), "F", "2024", 1, "VERIFIED"), ("reports/x", None, None, 1, None), ("manifests/x", None, None, 1, None), ("x", None, None, 1, "VERIFIED")]
    df = spark.createDataFrame(rows, "path string, symbol string, year string, length long, status string")
    got = {r.path: r.reason for r in storage.cleanup_plan(df, ["E"], 2023, 2025, 10, market="spot", interval="1h").collect()}
    assert got == {at("A"): "DELETE", at("B"): "OVER_BUDGET", at("C"): "DELETE", at("D"): "NOT_VERIFIED", at("E"): "RETAINED_SYMBOL", at("C", 1): "NOT_TARGET", at("F", m="um"): "NOT_TARGET", "reports/x": "REPORT", "manifests/x": "PROTECTED", "x": "NOT_TARGET"}
    assert storage.cleanup_plan(df, [], 2023, 2025, None).filter("delete").agg(F.sum("length")).first()[0] == 18


def test_cleanup_evaluates_its_files_once(spark):
    """Count, ranges, sort and result all see one evaluation, however dear the plan behind the files is."""
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    rows = [(f"candles/spot/1h/symbol=S/year=2024/{k:03}.parquet", "S", "2024", k, "VERIFIED") for k in range(100)]
    kinds = "path string, symbol string, year string, length long, status string"
    df = spark.createDataFrame(rows, kinds).mapInArrow(count, kinds)
    plan = storage.cleanup_plan(df, [], 2023, 2025, 10)
    assert plan.filter("delete").count() == 5
    assert seen.value == 100



def test_exactly_one_input_of_a_hash_is_imported(spark):
    rows = [("h", "same")] * 5 + [("g", "b"), ("g", "a"), ("g", "a"), (None, "x"), (None, "x"), ("old", "q")]
    df = spark.createDataFrame(rows, "hash string, path string").repartition(4)
    done = listing.intake(df, spark.createDataFrame([("old",), ("old",)], "hash string"))
    assert {(r.hash, r.path, r.outcome): r["count"] for r in done.groupBy("hash", "path", "outcome").count().collect()} == {("h", "same", "IMPORTED"): 1, ("h", "same", "DUPLICATE"): 4, ("g", "a", "IMPORTED"): 1, ("g", "a", "DUPLICATE"): 1, ("g", "b", "DUPLICATE"): 1, (None, "x", "SKIPPED"): 2, ("old", "q", "DUPLICATE"): 1}


def test_disappeared(spark):
    df = spark.createDataFrame([("BTC", 1, "TRADING"), ("ETH", 1, "TRADING"), ("OLD", 1, "DELIVERED"), ("BTC", 2, "TRADING")], "symbol string, seq long, status string")
    assert [r.symbol for r in lifecycle.disappeared(df).collect()] == ["ETH"]


def test_last_snapshot_decides_evidence(spark):
    base = spark.createDataFrame([("A", "UNKNOWN", None, None, "LOCAL_DATA_FIRST_SEEN")], "symbol string, status string, listed_ms long, delisted_ms long, evidence_level string")
    seen = lambda u: spark.createDataFrame([("A", k, "TRADING", T0, None, x) for k, x in enumerate(u)], "symbol string, seq long, status string, onboard_ms long, delivery_ms long, unverified boolean")
    got = [lifecycle.merge_snapshots(base, seen(u)).first() for u in ([False, True], [True, False])]
    assert [g.evidence_level for g in got] == ["USER_PROVIDED_UNVERIFIED", "HISTORICAL_SNAPSHOT_EVIDENCE"]
    assert got[0].listed_ms == T0 and got[0].status == "ACTIVE"


def test_partitions_do_not_change_an_audit(spark):
    df = spark.range(500).select(F.lit("A").alias("s"), (F.col("id") * 7 % 400 * MIN).alias("t"))
    a, b = (series.gap_audit(x, ["s"], "t", MIN, part_ms=50 * MIN).collect() for x in (df.repartition(1), df.repartition(8)))
    assert a == b


@pytest.mark.parametrize("part_ms", [10 * MIN, 10**12])
def test_gap_audit_from_clamped_bounds(spark, part_ms):
    at = [*range(5), *range(15, 25), *range(35, 40)]
    got = lambda lo, hi: audit(spark, at, start=T0 + lo * MIN, end=T0 + hi * MIN, part_ms=part_ms, tail=True)
    r = got(10, 30)
    assert (r.expected_rows, r.missing_rows, r.gap_count, r.largest_gap_seconds, r.min_time_ms, r.max_time_ms) == (21, 11, 2, 360, T0 + 10 * MIN, T0 + 30 * MIN)
    r = got(6, 13)
    assert (r.expected_rows, r.missing_rows, r.gap_count, r.largest_gap_seconds) == (8, 8, 1, 480)
    r = got(-9, 99)
    assert (r.expected_rows, r.missing_rows, r.gap_count, r.largest_gap_seconds) == (40, 20, 2, 600)
    r = got(50, 60)
    assert (r.rows, r.expected_rows, r.missing_rows, r.gap_count, r.status, r.warnings) == (20, 0, 0, 0, "PASS", "")


def test_audit_of_what_has_no_symbol_or_interval(spark):
    rows = [("A", "1m", T0), ("A", "1m", T0 + MIN), ("", "1m", T0), (None, "1m", T0), ("B", "soon", T0), (None, None, T0), ("A", "5m", T0), ("A", "5m", T0 + 10 * MIN)]
    df = spark.createDataFrame(rows, "symbol string, interval string, t long")
    got = {(r.symbol, r.interval): (r.status, r.rows, r.expected_rows, r.missing_rows, r.warnings) for r in series.gap_audit(df, ["symbol", "interval"], "t", exprs.interval_ms(F.col("interval"))).collect()}
    none = ("UNKNOWN", 0, 0, 0)
    assert got[None, "1m"] == got["", "1m"] == (*none, "DATASET_SYMBOL_INFER_FAILED") and got["B", "soon"] == (*none, "DATASET_INTERVAL_INFER_FAILED")
    assert got[None, None] == (*none, "DATASET_SYMBOL_INFER_FAILED,DATASET_INTERVAL_INFER_FAILED")
    assert got["A", "1m"] == ("PASS", 2, 2, 0, "") and got["A", "5m"][:4] == ("FAIL", 2, 3, 1)


@pytest.mark.parametrize("file_rows", [2, 10**6])
def test_audit_warns_of_rows_out_of_order_in_files(spark, tmp_path, file_rows):
    """Order is that of the rows in a file and of the files by path; across files, parts and within them."""
    for name, at in (("symbol=A/interval=1m/1", [0, 2, 1, 3, 4]), ("symbol=A/interval=1m/2", [3, 5, 6]), ("symbol=B/interval=1m/1", [0, 1])):
        spark.createDataFrame([(T0 + i * MIN,) for i in at], "open_time_ms long").coalesce(1).write.parquet(str(tmp_path / name))
    rows = readers.read_candle_times(spark, str(tmp_path), place=True)
    order, part = series.file_order(file_rows)
    got = {r.symbol: (r.out_of_order_rows, r.duplicate_rows, r.status, r.warnings) for r in series.gap_audit(rows, ["symbol", "interval"], "open_time_ms", MIN, order=order, arrival=part).collect()}
    assert got == {"A": (2, 1, "WARN", "DATASET_DUPLICATE_TIMESTAMPS,DATASET_OUT_OF_ORDER_TIMESTAMPS"), "B": (0, 0, "PASS", "")}
    assert {r.symbol: r.out_of_order_rows for r in series.out_of_order(rows, ["symbol"], "open_time_ms", order, part).collect()} == {"A": 2, "B": 0}


def test_coverage_of_rows_in_the_window_alone(spark):
    at = [*range(50), 60, 61]
    r = audit(spark, at, start=T0 + 55 * MIN, end=T0 + 70 * MIN)
    assert (r.rows, r.expected_rows, r.coverage_pct, r.status) == (52, 7, 100.0, "WARN")
    r = audit(spark, at, start=T0 + 55 * MIN, end=T0 + 70 * MIN, in_window=True)
    assert (r.rows, r.expected_rows, round(r.coverage_pct), r.status) == (52, 7, 29, "FAIL")
