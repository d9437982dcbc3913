"""Rules, verdicts and times on small fixtures, in two time zones."""

import pytest
from pyspark.sql import functions as F

from tidemark.functions import exprs as X
from tidemark.operators import lifecycle, listing, series, universe

T0, MIN = 1704067200000, 60_000


@pytest.fixture(params=["UTC", "America/New_York"])
def zone(spark, request):
    spark.conf.set("spark.sql.session.timeZone", request.param)
    yield request.param
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_times_do_not_depend_on_the_zone(spark, zone):
    df = spark.createDataFrame([(T0, "2024-03-10T04:30:00+02:00", "2024-01-01 00:00:00", " Unknown")], "ms long, good string, bad string, none string")
    r = df.select(X.rfc3339(F.col("ms")), X.normalized_time(F.col("good")), X.normalized_time(F.col("bad")), X.malformed_time(F.col("bad")), X.normalized_time(F.col("none")), X.malformed_time(F.col("none")), X.rfc3339(F.lit(0)), X.observed_time(F.lit("/x/20240101_0130.json"), "yyyyMMdd_HHmm", F.lit(None), F.lit(None).cast("long"))).first()
    assert list(r) == ["2024-01-01T00:00:00Z", "2024-03-10T02:30:00Z", "2024-01-01 00:00:00", True, None, False, None, "2024-01-01T01:30:00Z"]
    m = series.month_partitions(df, [], "ms").first()
    assert (m.year, m.month) == ("2024", "01")


@pytest.mark.parametrize(("row", "rule"), [((0, 0, 500.0), "event_time_ms <= 0"), ((5, 0, 500.0), "available_at_ms <= 0"), ((5, 4, 500.0), "available_at_ms < event_time_ms"), ((5, 5, 500.0), "score outside 0..100"), ((5, 5, 50.0), None), ((5, 5, None), None)])
def test_rules_go_in_order(spark, row, rule):
    df = spark.createDataFrame([("x", "s", *row)], "k string, source string, e long, a long, score double")
    check = lambda d: series.validate_rows(d, ["k"], ["e"], "e", "a", ["source"], series.sentiment_bounds(F.col("score"))).first().first_rule
    assert check(df) == rule
    assert check(df.withColumn("source", F.lit(" "))) == "missing source"


@pytest.mark.parametrize("part", [None, 2, 100])
def test_rows_meet_across_parts(spark, part):
    rows = [("x", k, t, t) for k, t in enumerate([10, 20, 15, 20, 30, 30, 40, 5])] + [("y", 0, 7, 7), ("y", 9, 8, 8)]
    df = spark.createDataFrame(rows, "k string, n long, e long, a long")
    by = None if part is None else F.floor(F.col("n") / part)
    r = {x.k: x for x in series.validate_rows(df, ["k"], ["n"], "e", "a", part=by).collect()}
    assert (r["x"].rows, r["x"].bad_rows, r["x"].first_bad_row, r["x"].first_rule) == (8, 4, 2, "event_time_ms out of order")
    assert (r["y"].bad_rows, r["y"].first_bad_row) == (0, None)
    o = {x.k: x.out_of_order_rows for x in series.out_of_order(df, ["k"], "e", ["n"], by).collect()}
    assert o == {"x": 2, "y": 0}
    v = {x.k: x.sort_errors for x in series.dataset_verify(df, ["k"], "e", "a", 0, 100).collect()}
    assert v == {"x": 2, "y": 0}


@pytest.mark.parametrize("part_ms", [3 * MIN, 10**12])
def test_range_coverage_across_parts(spark, part_ms):
    at = [1, 2, 5, 6, 6, 11]
    df = spark.createDataFrame([("A", T0 + i * MIN) for i in at] + [("A", T0 + 90_000)], "s string, t long")
    r = series.range_coverage(df, ["s"], "t", MIN, T0, T0 + 12 * MIN, part_ms).first()
    ms = lambda i: T0 + i * MIN
    assert (r.expected_rows, r.actual_rows, r.duplicate_rows, r.missing_rows, r.first_missing_ms, r.last_missing_ms) == (13, 7, 1, 8, ms(0), ms(12))
    r = series.range_coverage(df, ["s"], "t", MIN, ms(1), ms(11), part_ms).first()
    assert (r.missing_rows, r.first_missing_ms, r.last_missing_ms) == (6, ms(3), ms(10))


def test_audit_window_without_tail(spark):
    df = spark.createDataFrame([("A", T0 + i * MIN) for i in range(10) if i not in (3, 8)], "s string, t long")
    r = series.gap_audit(df, ["s"], "t", MIN, start=T0 + 3 * MIN, end=T0 + 8 * MIN, min_pct=50.0, tail=False).first()
    assert (r.expected_rows, r.missing_rows, r.gap_count, r.min_time_ms, r.status, r.warnings) == (6, 1, 1, T0 + 3 * MIN, "WARN", "DATASET_GAPS_DETECTED")


def codes(df, target=None):
    return sorted((r.code, r.severity) for r in df.collect() if target is None or r.target == target)


def test_lifecycle_rules(spark):
    schema = "symbol string, status string, listed_ms long, delisted_ms long, evidence_level string, malformed boolean"
    src = spark.createDataFrame([("AAA", "h", 1), ("BBB", None, 1), ("BBB", None, 2), ("CCC", "h", None), ("ZZZ", None, 1)], "symbol string, source_hash string, observed_ms long")
    rows = [("AAA", "DELISTED", 1, 2, "VERIFIED_EXCHANGE_DELISTING", False), ("BBB", "ACTIVE", None, None, "VERIFIED_EXCHANGE_LISTING", False), ("CCC", "PAUSED", 3, 2, "RUMOUR", True), ("d-d", "UNKNOWN", 1, 2, "UNKNOWN", False)]
    got = lifecycle.lifecycle_findings(spark.createDataFrame(rows, schema), src)
    short = lambda t: [(c.removeprefix("LIFECYCLE_"), s) for c, s in codes(got, t)]
    assert short("AAA") == [] and short("ZZZ") == []
    assert short("BBB") == [("DELISTED_DATE_MISSING", "WARN"), ("LISTED_DATE_MISSING", "FAIL"), ("LISTED_DATE_MISSING", "WARN"), ("SOURCE_HASH_MISSING", "WARN")]
    assert short("CCC") == [("EVIDENCE_MISSING", "FAIL"), ("LISTED_AFTER_DELISTED", "FAIL"), ("STATUS_UNKNOWN", "FAIL")]
    assert short("d-d") == [("EVIDENCE_MISSING", "WARN"), ("STATUS_UNKNOWN", "WARN"), ("SYMBOL_MALFORMED", "FAIL")]
    assert short("") == [("LOW_RISK_UNPROVEN", "WARN")]
    sound = spark.createDataFrame(rows[:1], schema)
    assert lifecycle.evidence_support(sound, src).first()[1:] == ("VERIFIED", "VERIFIED", "LOW_SUPPORTED")
    assert codes(lifecycle.lifecycle_findings(sound, src)) == []
    assert codes(lifecycle.lifecycle_findings(sound.limit(0), src)) == [("LIFECYCLE_EMPTY", "FAIL"), ("LIFECYCLE_LOW_RISK_UNPROVEN", "WARN")]
    assert lifecycle.evidence_support(sound.limit(0), src).first()[1:] == ("MISSING", "MISSING", "UNKNOWN")


def test_listing_rules(spark):
    rows = [("AAA", "TRADING", "TRADING", "2024-01-01T00:00:00Z", "soon"), ("BBB", "UNKNOWN", "ODD", None, None), ("BBB", "CLOSED", None, None, None)]
    got = codes(listing.listing_findings(spark.createDataFrame([("s", *r) for r in rows], "id string, symbol string, status string, raw_status string, onboard_at string, delivery_at string"), ["id"]))
    assert [c.removeprefix("EXCHANGE_META_") + s[0] for c, s in got] == ["DELIVERY_DATE_MISSINGF", "DELIVERY_DATE_MISSINGW", "DELIVERY_DATE_MISSINGW", "DUPLICATE_SYMBOLF", "ONBOARD_DATE_MISSINGW", "ONBOARD_DATE_MISSINGW", "STATUS_UNKNOWNF", "STATUS_UNKNOWNW", "SYMBOL_STATUS_UNMAPPEDW"]
    none = spark.createDataFrame([("s", "UNKNOWN", None, "Current", 0)], "snapshot_id string, raw_sha256 string, observed string, source_type string, symbols int")
    assert [c.removeprefix("EXCHANGE_META_") for c, _ in codes(listing.snapshot_findings(none))] == ["CURRENT_ONLY_SOURCE", "EMPTY_SYMBOL_SET", "RAW_PAYLOAD_MISSING", "SOURCE_TIME_UNKNOWN"]


def test_intake_never_gathers_a_hash(spark):
    incoming = spark.createDataFrame([(None, f"p{k}") for k in range(50)] + [("h", f"q{k}") for k in range(50)] + [("old", "r")], "hash string, path string")
    got = listing.intake(incoming, incoming.filter("hash = 'old'").select("hash"))
    assert {(r.outcome, r["count"]) for r in got.groupBy("outcome").count().collect()} == {("SKIPPED", 50), ("DUPLICATE", 50), ("IMPORTED", 1)}


UNI = "symbol string, first_seen long, listed_ms long, delisted_ms long, active_during_window boolean, in_lifecycle boolean"


def test_universe_rules_and_risk(spark):
    u = spark.createDataFrame([("AAA", 1, 1, 2, True, True), ("BBB", 1, None, None, False, False)], UNI)
    verified = spark.createDataFrame([(1, "VERIFIED", "VERIFIED", "LOW_SUPPORTED")], "symbols long, listing string, delisting string, survivorship string")
    weak = spark.createDataFrame([(1, "MISSING", "MISSING", "ELEVATED")], verified.schema)
    short = lambda t, *a, **kw: [(c.removeprefix("UNIVERSE_"), s) for c, s in codes(universe.universe_findings(u, *a, **kw), t)]
    pit = "POINT_IN_TIME_EXCHANGE_UNIVERSE"
    assert short("BBB", pit, 1, 2, verified) == [("DELISTING_EVIDENCE_MISSING", "WARN"), ("LISTING_EVIDENCE_MISSING", "WARN"), ("SYMBOL_MISSING_LIFECYCLE", "FAIL"), ("SYMBOL_NOT_ACTIVE_DURING_WINDOW", "FAIL")]
    assert short("", pit, 1, 2, verified, coverage="COVERS_WINDOW", includes_delisted="true", risk="LOW") == []
    assert short("", pit, 3, 2, includes_delisted="false") == [("EFFECTIVE_WINDOW_INVALID", "FAIL"), ("LIFECYCLE_MANIFEST_MISSING", "FAIL")]
    assert short("", "NO_SUCH", 1, 2) == [("DELISTED_STATUS_UNKNOWN", "WARN"), ("POLICY_UNKNOWN", "FAIL")]
    assert [c for c, _ in short("", pit, 1, 2, weak, coverage="CURRENT_ONLY", snapshot_current_only=True, includes_delisted="true", risk="LOW")] == ["DELISTED_STATUS_UNKNOWN", "DELISTING_EVIDENCE_MISSING", "DELISTING_NOT_PROVEN_BY_SNAPSHOTS", "LIFECYCLE_EVIDENCE_WEAK", "LISTING_EVIDENCE_MISSING", "LISTING_NOT_PROVEN_BY_SNAPSHOTS", "LOW_RISK_UNPROVEN", "POINT_IN_TIME_EVIDENCE_PARTIAL", "SNAPSHOT_ARCHIVE_CURRENT_ONLY"]
    risk = lambda *a: universe.survivorship_risk(u, *a).first().risk
    assert [risk(p, "LOW") for p in ("EXPLICIT_SYMBOL_LIST", "CURRENT_ACTIVE_SYMBOL_LIST", "LOCAL_DATA_DISCOVERED_SYMBOLS", pit)] == ["HIGH", "HIGH", "MEDIUM", "UNKNOWN"]
    assert risk(pit, "LOW", verified, "true") == "LOW" and risk(pit, "LOW", weak, "true") == "MEDIUM" and risk(pit, "HIGH", verified, "true") == "HIGH"
    assert risk(pit, "LOW", None, "true", "point in time") == "MEDIUM"
    files = spark.createDataFrame([("a/symbol=btc/x.parquet",), ("symbol=ETH/y",), ("z",)], "path string")
    assert sorted(r.symbol for r in universe.discover_symbols(files).collect()) == ["BTC", "ETH"]


def test_verdicts_and_ranges(spark):
    none = spark.createDataFrame([], "eligibility string, risk string, blocking_reason string")
    r = universe.pit_verdict(none, "MEDIUM").first()
    assert (r.symbols, r.verdict, r.promotion, r.risk) == (0, "PIT_ELIGIBLE", "ALLOW_STRICT_PROMOTION", "MEDIUM")
    head = spark.createDataFrame([(5, 9)], "start_ms long, end_ms long")
    assert [len(universe.range_findings(head, *w).collect()) for w in ((5, 9), (6, 9), (1, 8), (None, None))] == [0, 1, 1, 0]
    u = spark.createDataFrame([(s, 1, 1, None, True, True) for s in ("AAA", "BBB", "CCC")], UNI)
    life = spark.createDataFrame([("AAA", "UNKNOWN", None, 1), ("BBB", "HISTORICAL_SNAPSHOT_EVIDENCE", 5, 1)], "symbol string, evidence_level string, delisted_ms long, position long")
    src = spark.createDataFrame([("BBB", "USER_PROVIDED_UNVERIFIED", 1), ("BBB", "official", None)], "symbol string, trust string, observed_ms long")
    got = {r.symbol: r for r in universe.pit_evidence(u, life, src, "LOW", "MY_POINT_IN_TIME_LIST").collect()}
    assert (got["AAA"].grade, got["AAA"].blocking_reason, got["AAA"].risk) == ("MISSING_LIFECYCLE", "EVIDENCE_MISSING", "MEDIUM")
    assert (got["BBB"].grade, got["BBB"].blocking_reason, got["BBB"].sources, got["BBB"].observed, got["BBB"].trust_levels) == ("UNVERIFIED_ONLY", "UNVERIFIED_EVIDENCE", 2, 1, "OFFICIAL=1,USER_PROVIDED_UNVERIFIED=1")
    assert (got["CCC"].grade, got["CCC"].blocking_reason, got["CCC"].risk) == ("MISSING_LIFECYCLE", "MISSING_LIFECYCLE_MANIFEST_OR_ENTRY", "LOW")


def test_coverage_findings_and_funding(spark):
    audit = spark.createDataFrame([("A", "DATASET_GAPS_DETECTED,DATASET_COVERAGE_BELOW_THRESHOLD", "FAIL"), ("B", "", "PASS")], "symbol string, warnings string, status string")
    assert codes(universe.coverage_findings(audit)) == [("DATASET_COVERAGE_BELOW_THRESHOLD", "FAIL"), ("DATASET_GAPS_DETECTED", "FAIL")]
    rows = spark.createDataFrame([("A", T0, T0), ("A", T0 + 1, T0 + 1), ("B", T0, T0), ("B", T0, T0)], "symbol string, e long, a long")
    got = {r.symbol: r for r in series.funding_verify(series.dataset_verify(rows, ["symbol"], "e", "a", T0, T0), F.lit("PASS"), "2024-01-01", "2024-01-01").collect()}
    assert (got["A"].verification_status, got["A"].row_count, got["B"].verification_status, got["B"].duplicate_event_time_count) == ("PASS", 2, "FAIL", 1)


def test_lifecycle_from_files(spark):
    rows = spark.createDataFrame([("A", "1m", "spot", 5)], "symbol string, interval string, market string, t long")
    files = spark.createDataFrame([("A", "b", "2"), ("A", "a", "1")], "symbol string, path string, sha256 string")
    r = lifecycle.lifecycle_from_files(rows, files, "t", "2024-01-01T00:00:00Z").first()
    assert (r.interval, r.observed_at, len(r.source_hash)) == ("1m", "2024-01-01T00:00:00Z", 64)


@pytest.mark.parametrize("name", ["month_partition", "timestamp_normalize", "gap_audit_window", "listing_payload", "snapshot_findings"])
def test_queries_do_not_depend_on_the_zone(spark, name):
    from tidemark.plans.queries import QUERIES

    rows = lambda: sorted(map(str, QUERIES[name](spark, "/root/testdata/sf0.001").collect()))
    want = rows()
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        assert rows() == want
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
