"""Universes: lifecycle joined to symbols, findings, reconciliation with a dataset, point-in-time evidence."""

from __future__ import annotations

import ctypes
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import exprs
from ..functions.lineage import cut
from .listing import count_map, explode_rules

# Policies, those that claim a point in time, and what a policy makes of a LOW risk.
POLICIES = ("POINT_IN_TIME_EXCHANGE_UNIVERSE", "POINT_IN_TIME_VOLUME_FILTERED_UNIVERSE", "POINT_IN_TIME_MARKET_CAP_FILTERED_UNIVERSE", "EXPLICIT_SYMBOL_LIST", "CURRENT_ACTIVE_SYMBOL_LIST", "LOCAL_DATA_DISCOVERED_SYMBOLS")
POINT_IN_TIME = POLICIES[:3]
POLICY_RISK = {"EXPLICIT_SYMBOL_LIST": "HIGH", "CURRENT_ACTIVE_SYMBOL_LIST": "HIGH", "LOCAL_DATA_DISCOVERED_SYMBOLS": "MEDIUM"}
POLICY_CODE = {"EXPLICIT_SYMBOL_LIST": "UNIVERSE_EXPLICIT_SYMBOL_LIST_SURVIVORSHIP_RISK", "CURRENT_ACTIVE_SYMBOL_LIST": "UNIVERSE_CURRENT_ACTIVE_SURVIVORSHIP_RISK", "LOCAL_DATA_DISCOVERED_SYMBOLS": "UNIVERSE_LOCAL_DATA_DISCOVERY_NOT_POINT_IN_TIME"}


def build_universe(symbols: DataFrame, lifecycle: DataFrame, start_ms: int, end_ms: int) -> DataFrame:
    """symbols(symbol, first_seen) left-joined to lifecycle(symbol, status, listed_ms, delisted_ms, evidence_level)."""
    m = symbols.join(lifecycle.select("symbol", F.col("status").alias("life_status"), "listed_ms", "delisted_ms", "evidence_level"), "symbol", "left")
    active = exprs.active_during(F.col("listed_ms"), F.col("delisted_ms"), F.lit(start_ms), F.lit(end_ms))
    return m.select(
        "symbol", exprs.base_asset(F.col("symbol")).alias("base_asset"), exprs.quote_asset(F.col("symbol")).alias("quote_asset"), "first_seen", "listed_ms", "delisted_ms", active.alias("active_during_window"),
        F.greatest(F.coalesce("listed_ms", "first_seen"), F.lit(start_ms)).alias("available_from"), F.least(F.coalesce("delisted_ms", F.lit(end_ms)), F.lit(end_ms)).alias("available_until"),
        F.col("evidence_level"), F.col("life_status").isNotNull().alias("in_lifecycle"),
    )


def discover_symbols(files: DataFrame) -> DataFrame:
    """The symbols of the folders `symbol=` over files(path, ...), each once."""
    return files.select(exprs.folder_symbol(F.col("path")).alias("symbol")).filter("symbol is not null").distinct()


def universe_findings(
    universe: DataFrame, policy: str, start_ms: int | None, end_ms: int | None, support: DataFrame | None = None,
    coverage: str | None = None, snapshot_current_only: bool = False, includes_delisted: str = "unknown", risk: str = "HIGH", source_type: str = "",
) -> DataFrame:
    """I4: distinct findings of a universe and of what its header claims.

    support is evidence_support's row for the lifecycle, null where there is
    none; coverage how snapshots cover the window (window_coverage), null without
    snapshots; risk the claimed survivorship risk. Findings of the header have the empty target.
    """
    w = Window.partitionBy("symbol").orderBy("first_seen")
    rows = universe.withColumn("__k", F.row_number().over(w))
    life, snapshots = support is not None, coverage is not None
    rules = [("UNIVERSE_DUPLICATE_SYMBOL", "FAIL", F.col("__k") > 1), ("UNIVERSE_SYMBOL_MALFORMED", "FAIL", ~exprs.market_symbol(F.col("symbol")))]
    if life:
        rules += [
            ("UNIVERSE_SYMBOL_MISSING_LIFECYCLE", "FAIL", ~F.col("in_lifecycle")),
            ("UNIVERSE_SYMBOL_NOT_ACTIVE_DURING_WINDOW", "FAIL", ~F.col("active_during_window")),
            ("UNIVERSE_LISTING_EVIDENCE_MISSING", "WARN", F.col("listed_ms").isNull()),
            ("UNIVERSE_DELISTING_EVIDENCE_MISSING", "WARN", F.col("delisted_ms").isNull()),
        ]
    head = _proof(universe, support).select(F.lit("").alias("t"), "*")
    listing, delisting = F.col("listing") == "VERIFIED", F.col("delisting") == "VERIFIED"
    proven = _proven(policy, includes_delisted, source_type)
    low = F.lit(risk == "LOW")
    whole = [
        ("UNIVERSE_EMPTY", "FAIL", F.col("n") == 0),
        ("UNIVERSE_EFFECTIVE_WINDOW_INVALID", "FAIL", F.lit(start_ms is not None and end_ms is not None and start_ms > end_ms)),
        ("UNIVERSE_LIFECYCLE_MANIFEST_MISSING", "FAIL", F.lit(not life and policy in POINT_IN_TIME)),
        ("UNIVERSE_SNAPSHOT_ARCHIVE_CURRENT_ONLY", "WARN", F.lit(life and snapshot_current_only)),
        ("UNIVERSE_SNAPSHOT_ARCHIVE_DOES_NOT_COVER_WINDOW", "WARN", F.lit(life and snapshots and coverage not in ("COVERS_WINDOW", "CURRENT_ONLY"))),
        ("UNIVERSE_POINT_IN_TIME_EVIDENCE_PARTIAL", "WARN", F.lit(life and snapshots and coverage != "COVERS_WINDOW")),
        ("UNIVERSE_LISTING_EVIDENCE_MISSING", "WARN", F.lit(life) & ~listing),
        ("UNIVERSE_LISTING_NOT_PROVEN_BY_SNAPSHOTS", "WARN", F.lit(life and snapshots) & ~listing),
        ("UNIVERSE_DELISTING_EVIDENCE_MISSING", "WARN", F.lit(life) & ~delisting),
        ("UNIVERSE_DELISTING_NOT_PROVEN_BY_SNAPSHOTS", "WARN", F.lit(life and snapshots) & ~delisting),
        ("UNIVERSE_LIFECYCLE_EVIDENCE_WEAK", "WARN", F.lit(life) & (F.col("survivorship") != "LOW_SUPPORTED")),
        ("UNIVERSE_POLICY_UNKNOWN", "FAIL", F.lit(policy not in POLICIES)),
        *[(code, "WARN", F.lit(policy == name)) for name, code in POLICY_CODE.items()],
        ("UNIVERSE_DELISTED_STATUS_UNKNOWN", "FAIL", F.lit(includes_delisted == "true") & ~proven),
        ("UNIVERSE_DELISTED_STATUS_UNKNOWN", "WARN", F.lit(includes_delisted == "unknown")),
        ("UNIVERSE_LOW_RISK_UNPROVEN", "WARN", low & ~proven),
    ]
    return explode_rules(rows, "symbol", rules).unionByName(explode_rules(head, "t", whole)).distinct()


def _proof(universe: DataFrame, support: DataFrame | None) -> DataFrame:
    """One row: the universe's symbols and whether all have a listing date, beside the lifecycle's support."""
    n = universe.agg(F.count("*").alias("n"), F.coalesce(F.bool_and(F.col("listed_ms").isNotNull()), F.lit(False)).alias("all_listed"))
    names = ("listing", "delisting", "survivorship")
    if support is None:
        return n.withColumns({c: F.lit("MISSING") for c in names})
    return n.join(F.broadcast(support.select(*names)))


def _proven(policy: str, includes_delisted: str, source_type: str) -> Column:
    """Whether a header of _proof() proves listings and delistings at a point in time."""
    if policy not in POINT_IN_TIME or includes_delisted != "true":
        return F.lit(False)
    verified = (F.col("listing") == "VERIFIED") & (F.col("delisting") == "VERIFIED") & (F.col("survivorship") == "LOW_SUPPORTED")
    named = any(x in source_type.lower() for x in ("point", "listing", "delisting"))
    return verified | (F.lit(named) & F.col("all_listed") & (F.col("n") > 0))


def survivorship_risk(universe: DataFrame, policy: str, claimed: str, support: DataFrame | None = None, includes_delisted: str = "unknown", source_type: str = "") -> DataFrame:
    """I4: one row with the risk that policy and evidence leave of the claimed one. LOW stays only with proof at a point in time."""
    proven = _proven(policy, includes_delisted, source_type)
    unproven = POLICY_RISK.get(policy, "MEDIUM" if includes_delisted == "true" else "UNKNOWN")
    risk = F.lit(claimed) if claimed != "LOW" else F.when(proven, "LOW").otherwise(unproven)
    return _proof(universe, support).select(F.col("n").alias("symbols"), proven.alias("proven"), risk.alias("risk"))


def symbol_reconcile(dataset: DataFrame, universe: DataFrame, quote: str | None = None, market: str | None = None) -> DataFrame:
    """Symbols of one side alone, symbols of another quote asset, and a market type that the dataset has not, as findings.

    The market is looked for among the dataset's column market, if it has one; a dataset that shows none is not held against it.
    """
    d, u = dataset.select("symbol").distinct(), universe.select("symbol").distinct()
    finding = lambda df, code, severity: df.select(F.col("symbol").alias("target"), F.lit(code).alias("code"), F.lit(severity).alias("severity"))
    out = finding(d.join(u, "symbol", "left_anti"), "DATASET_SYMBOL_NOT_IN_UNIVERSE", "FAIL").unionByName(finding(u.join(d, "symbol", "left_anti"), "UNIVERSE_SYMBOL_MISSING_DATA", "WARN"))
    if quote:
        out = out.unionByName(finding(d.filter(~F.col("symbol").endswith(quote)), "UNIVERSE_DATASET_QUOTE_ASSET_MISMATCH", "FAIL"))
    if market and "market" in dataset.columns:
        other = dataset.agg(F.count("market").alias("n"), F.count_if(F.col("market") == market).alias("k")).filter("n > 0 and k = 0")
        out = out.unionByName(finding(other.select(F.lit("").alias("symbol")), "UNIVERSE_DATASET_MARKET_TYPE_MISMATCH", "FAIL"))
    return out


def range_findings(head: DataFrame, start_ms: int | None, end_ms: int | None) -> DataFrame:
    """A finding if the dataset's range, head(start_ms, end_ms), is not within the universe's window; open or empty bounds hold nothing out."""
    early = F.lit(False) if start_ms is None else F.coalesce(F.col("start_ms") < start_ms, F.lit(False))
    late = F.lit(False) if end_ms is None else F.coalesce(F.col("end_ms") > end_ms, F.lit(False))
    return explode_rules(head.withColumn("t", F.lit("")), "t", [("DATASET_RANGE_OUTSIDE_UNIVERSE_WINDOW", "FAIL", early | late)])


def coverage_findings(audit: DataFrame) -> DataFrame:
    """The warnings of a coverage audit as findings of its symbols; those of a failed audit are failures."""
    each = audit.select(F.col("symbol").alias("target"), F.explode(F.filter(F.split("warnings", ","), lambda x: x != "")).alias("code"), F.when(F.col("status") == "FAIL", "FAIL").otherwise("WARN").alias("severity"))
    return each.distinct()


def union_warnings(*frames: DataFrame) -> DataFrame:
    """Distinct (target, code, severity) of all frames."""
    out = frames[0].select("target", "code", "severity")
    for f in frames[1:]:
        out = out.unionByName(f.select("target", "code", "severity"))
    return out.distinct()


def dataset_manifest(files: DataFrame, findings: DataFrame, carried: DataFrame | None = None) -> DataFrame:
    """One row: files(path, symbol, sha256, row_count, lo, hi) with the dataset's hash, range, symbols, worst finding and sorted codes.

    carried is a header row to carry on from the universe and its lifecycle
    (provenance, D17); its columns come before the manifest's own.
    """
    each = files.groupBy("symbol").agg(F.count("*").alias("files"), F.sum("row_count").alias("rows"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    head = each.agg(F.count("*").alias("symbols"), F.sum("files").alias("files"), F.sum("rows").alias("rows"), F.min("lo").alias("start_ms"), F.max("hi").alias("end_ms"))
    codes = F.array_join(F.array_sort(F.collect_set("code")), ",")
    found = findings.groupBy("code", "severity").agg(F.count("*").alias("n")).agg(
        F.coalesce(F.sum(F.when(F.col("severity") == "FAIL", F.col("n"))), F.lit(0)).alias("invalid"), F.coalesce(F.sum(F.when(F.col("severity") == "WARN", F.col("n"))), F.lit(0)).alias("warnings"), codes.alias("warning_codes")
    )
    digest = dataset_hash(files)
    out = head.join(F.broadcast(found)).join(F.broadcast(digest.select("dataset_hash")))
    out = out.withColumn("status", F.when(F.col("invalid") > 0, "FAIL").when(F.col("warnings") > 0, "WARN").otherwise("PASS"))
    return out if carried is None else carried.join(F.broadcast(out))


def provenance(universe: DataFrame, lifecycle: DataFrame, support: DataFrame, risk: DataFrame, policy: str, universe_id: str = "universe", lifecycle_id: str = "lifecycle") -> DataFrame:
    """One row that a dataset's manifest carries on: ids and hashes of universe and lifecycle, levels, evidence, policy and risk."""
    tree = lambda df, line: df.groupBy(F.substring(F.sha2(line, 256), 1, 2).alias("d")).agg(exprs.set_hash(line).alias("h")).agg(exprs.set_hash(F.concat_ws("|", "d", "h")).alias("h"))
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("UNKNOWN"))
    u = tree(universe, F.concat_ws("|", text("symbol"), text("listed_ms"), text("delisted_ms"), text("active_during_window"))).withColumnRenamed("h", "universe_hash")
    m = tree(lifecycle, F.concat_ws("|", text("symbol"), text("status"), text("listed_ms"), text("delisted_ms"), text("evidence_level"))).withColumnRenamed("h", "lifecycle_hash")
    levels = evidence_histogram(lifecycle).select(F.col("levels").alias("evidence_levels"))
    out = u.select(F.lit(universe_id).alias("universe_id"), "universe_hash", F.lit(policy).alias("universe_policy"), F.lit(lifecycle_id).alias("lifecycle_id"))
    for one in (m, levels, support.select(F.col("listing").alias("listing_evidence"), F.col("delisting").alias("delisting_evidence"), F.col("survivorship").alias("survivorship_support")), risk.select("risk")):
        out = out.join(F.broadcast(one))
    return out


def fold_verdict(manifest: DataFrame, verdict: DataFrame) -> DataFrame:
    """A manifest's row with the point-in-time verdict, its promotion and a hash of the whole, made anew."""
    out = manifest.drop("pit_status", "pit_promotion", "manifest_hash").join(F.broadcast(verdict.select(F.col("verdict").alias("pit_status"), F.col("promotion").alias("pit_promotion"))))
    return out.withColumn("manifest_hash", exprs.fingerprint(*out.columns))


def file_set_hash(files: DataFrame) -> DataFrame:
    """(symbol, h, n): SHA-256 over a symbol's `path:sha256` lines in path order, and how many they are."""
    return files.groupBy("symbol").agg(exprs.set_hash(F.concat("path", F.lit(":"), "sha256")).alias("h"), F.count("*").alias("n"))


def dataset_hash(files: DataFrame) -> DataFrame:
    """SHA-256 over `path:sha256` lines in path order, as a tree: symbols' hashes, then the hash of those, so that no task holds all lines."""
    return file_set_hash(files).agg(exprs.set_hash(F.concat("symbol", F.lit(":"), "h")).alias("dataset_hash"), F.sum("n").alias("files"))


def _openssl_resumes() -> bool:
    """Whether the OpenSSL that hashlib uses lets a digest's state be handed on; builds may hide its functions."""
    try:
        import _hashlib

        return all(hasattr(ctypes.CDLL(_hashlib.__file__), f"SHA256_{f}") for f in ("Init", "Update", "Final"))
    except (ImportError, OSError):
        return False


def _digest(state: bytes | None, resumes: bool):
    """Batches (line) to a row: the digest of all lines so far, its state for the lines that follow, and how many these were.

    state is OpenSSL's SHA256_CTX after the lines before, 112 bytes; None begins.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if resumes:
            import _hashlib

            lib, made, end, out = ctypes.CDLL(_hashlib.__file__), *(ctypes.create_string_buffer(k) for k in (112, 112, 32))
            if state is None:
                lib.SHA256_Init(made)
            else:
                made.raw = state
            update = lambda data: lib.SHA256_Update(made, data, ctypes.c_size_t(len(data)))
        else:
            plain = hashlib.sha256()
            update = plain.update
        n = 0
        for b in batches:
            update("".join(b.column("line").drop_null().to_pylist()).encode("utf-8"))
            n += len(b)
        if resumes:
            end.raw = made.raw
            lib.SHA256_Final(out, end)
        h, left = (out.raw.hex(), made.raw) if resumes else (plain.hexdigest(), None)
        yield pa.RecordBatch.from_arrays([pa.array([h]), pa.array([left], pa.binary()), pa.array([n], pa.int64())], names=["h", "state", "n"])

    return run


def flat_hash(files: DataFrame) -> DataFrame:
    """SHA-256 over all `path:sha256` lines, each with its line end, in path order: one digest of one stream, and files, how many there were.

    The lines are sorted by ranges. One small job a range, one after the other,
    passes its lines through the digest, whose state the driver hands on from range
    to range: the stream is one, as the flat form asks for, but no task reads more
    than a range. dataset_hash is the one whose work is spread. Where OpenSSL hides
    its state, one task sorts and reads all. No files give the digest of nothing;
    a file without path or hash has no line.
    """
    resumes, spark = _openssl_resumes(), files.sparkSession
    lines = files.select("path", F.concat("path", F.lit(":"), "sha256", F.lit("\n")).alias("line"))
    lines = cut(lines.sort("path", "line").select("line")) if resumes else lines.repartition(1).sortWithinPartitions("path", "line").select("line")
    h, state, files_seen = hashlib.sha256().hexdigest(), None, 0
    for k in range(lines.rdd.getNumPartitions()):
        for h, state, n in spark.sparkContext.runJob(lines.mapInArrow(_digest(state, resumes), "h string, state binary, n bigint").rdd, list, [k]):
            state, files_seen = state and bytes(state), files_seen + n
    return spark.createDataFrame([(h, files_seen)], "dataset_hash string, files bigint")


def evidence_histogram(symbols: DataFrame) -> DataFrame:
    """Symbols by evidence level; one row."""
    each = symbols.groupBy("evidence_level").agg(F.count("*").alias("n"))
    return each.agg(F.sum("n").alias("symbols"), count_map("evidence_level").alias("levels"))


def pit_evidence(universe: DataFrame, lifecycle: DataFrame, sources: DataFrame, risk: str, policy: str, allow_unverified: bool = False) -> DataFrame:
    """The point-in-time grade of each active symbol, the first rule that holds deciding, with what blocks promotion and E11's counters."""
    trust = F.coalesce(exprs.upper_or_null(F.col("trust")), F.lit(""))
    per = sources.groupBy("symbol", trust.alias("trust")).agg(F.count("*").alias("n"), F.count_if(F.col("observed_ms").isNull()).alias("m"))
    shut = exprs.unverified(F.col("trust"))
    each = per.groupBy("symbol").agg(F.sum("n").alias("sources"), F.sum(F.when(shut, F.col("n"))).alias("unverified"), F.sum("m").alias("missing_time"), count_map("trust").alias("trust_levels"))
    life = lifecycle.groupBy("symbol").agg(F.min_by(F.struct("evidence_level", "delisted_ms"), "position").alias("l")).select("symbol", F.col("l.evidence_level").alias("level"), F.col("l.delisted_ms").alias("ended"), F.lit(True).alias("found"))
    m = universe.filter("active_during_window").select("symbol").join(life, "symbol", "left").join(each, "symbol", "left")
    n = lambda c: F.coalesce(F.col(c), F.lit(0))
    unknown = exprs.known(F.col("level")).isNull()
    grade = (
        F.when(F.col("found").isNull() | unknown, "MISSING_LIFECYCLE").when(F.col("level") == "LOCAL_DATA_FIRST_SEEN", "LOCAL_DATA_ONLY")
        .when(F.col("level") == "CURRENT_ACTIVE_ONLY", "CURRENT_ONLY").when(n("unverified") > 0, "UNVERIFIED_ONLY").when(n("missing_time") > 0, "PARTIAL_FOR_WINDOW").otherwise("VERIFIED_FOR_WINDOW")
    )
    g, allowed = F.col("grade"), F.lit(allow_unverified)
    m = m.withColumn("grade", grade)
    eligible = F.when(g == "VERIFIED_FOR_WINDOW", "PIT_ELIGIBLE").when((g == "PARTIAL_FOR_WINDOW") | ((g == "UNVERIFIED_ONLY") & allowed), "PIT_PARTIAL").otherwise("PIT_NOT_ELIGIBLE")
    reason = (
        F.when(F.col("found").isNull(), "MISSING_LIFECYCLE_MANIFEST_OR_ENTRY").when(unknown, "EVIDENCE_MISSING").when(g.isin("LOCAL_DATA_ONLY", "CURRENT_ONLY"), g)
        .when((g == "UNVERIFIED_ONLY") & ~allowed, "UNVERIFIED_EVIDENCE")
    )
    raised = F.lit(risk == "LOW") & (((g == "UNVERIFIED_ONLY") & allowed) | (F.col("found").isNotNull() & F.col("ended").isNull() & F.lit("POINT_IN_TIME" in policy)))
    return m.select(
        "symbol", "grade", eligible.alias("eligibility"), F.when(raised, "MEDIUM").otherwise(risk).alias("risk"), reason.alias("blocking_reason"),
        n("sources").alias("sources"), (n("sources") - n("missing_time")).alias("observed"), n("unverified").alias("unverified"), n("missing_time").alias("missing_time"), F.coalesce("trust_levels", F.lit("")).alias("trust_levels"),
    )


def pit_verdict(rows: DataFrame, risk: str | None = None) -> DataFrame:
    """The worst eligibility of all symbols, the promotion that it allows, and the gravest risk; no symbols are eligible, at the risk given."""
    rank = F.when(F.col("eligibility") == "PIT_NOT_ELIGIBLE", 2).when(F.col("eligibility") == "PIT_PARTIAL", 1).otherwise(0)
    grave = F.when(F.col("risk") == "HIGH", 3).when(F.col("risk") == "MEDIUM", 2).when(F.col("risk") == "LOW", 1).otherwise(0)
    out = rows.agg(F.count("*").alias("symbols"), F.count("blocking_reason").alias("blocked"), F.coalesce(F.max(rank), F.lit(0)).alias("__r"), F.max_by("risk", grave).alias("risk"))
    pick = lambda a, b, c: F.when(F.col("__r") == 2, a).when(F.col("__r") == 1, b).otherwise(c)
    return out.select("symbols", "blocked", pick("PIT_NOT_ELIGIBLE", "PIT_PARTIAL", "PIT_ELIGIBLE").alias("verdict"), pick("BLOCK_STRICT_PROMOTION", "DOWNGRADE_PROMOTION", "ALLOW_STRICT_PROMOTION").alias("promotion"), F.coalesce("risk", F.lit(risk or "LOW")).alias("risk"))
