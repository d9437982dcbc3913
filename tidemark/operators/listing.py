"""Listings: payload normalisation, snapshot findings, evidence, archive summary, intake."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import exprs
from ..functions.lineage import cut

UNVERIFIED = exprs.UNVERIFIED
# Statuses that a listing may have.
STATUSES = ("ACTIVE", "TRADING", "BREAK", "HALT", "PRE_TRADING", "SETTLING", "DELIVERED", "DELISTED", "EXPIRED", "UNKNOWN")


def explode_rules(rows: DataFrame, target: str, rules: list[tuple[str, str, Column]]) -> DataFrame:
    """Findings (target, code, severity): one row for each broken rule of each row. rules are (code, severity, condition)."""
    found = F.array_compact(F.array(*[F.when(c, F.struct(F.lit(code).alias("code"), F.lit(sev).alias("severity"))) for code, sev, c in rules]))
    return rows.select(F.col(target).alias("target"), F.explode(found).alias("f")).select("target", "f.code", "f.severity")


def count_map(col: str, n: str = "n") -> Column:
    """A histogram from rows (value, n), as sorted `value=n` text; an aggregate."""
    return F.array_join(F.array_sort(F.collect_list(F.concat(F.col(col), F.lit("="), F.col(n).cast("string")))), ",")


def listing_symbols(raw: DataFrame, quote: str | None = None) -> DataFrame:
    """Normalised symbols of raw(symbol, status, onboard_ms, delivery_ms, permissions); with its other columns behind.

    Assets as stated, where raw has base_asset and quote_asset, else as the symbol ends. quote keeps one quote asset, blank or null all (C4).
    """
    given = lambda c: exprs.upper_or_null(F.col(c)) if c in raw.columns else F.lit(None).cast("string")
    known = ("symbol", "status", "onboard_ms", "delivery_ms", "permissions", "base_asset", "quote_asset")
    rest = [c for c in raw.columns if c not in known]
    rows = raw.withColumns({"symbol": F.upper(F.trim("symbol")), "quote_asset": given("quote_asset"), "base_asset": given("base_asset")})
    rows = rows.withColumns({"quote_asset": F.coalesce("quote_asset", exprs.quote_asset(F.col("symbol"))), "base_asset": F.coalesce("base_asset", exprs.base_asset(F.col("symbol")))})
    if quote and quote.strip():
        rows = rows.filter(F.col("quote_asset") == quote.strip().upper())
    onboard, delivery = exprs.rfc3339(F.col("onboard_ms")), exprs.rfc3339(F.col("delivery_ms"))
    return rows.select(
        "symbol", "base_asset", "quote_asset", exprs.exchange_status(F.col("status")).alias("status"), exprs.upper_or_null(F.col("status")).alias("raw_status"),
        onboard.alias("onboard_at"), delivery.alias("delivery_at"), F.array_join(F.array_sort(F.col("permissions")), ",").alias("permissions"),
        F.array_join(exprs.fields_present(status=F.nullif(F.trim("status"), F.lit("")), onboardDate=onboard, deliveryDate=delivery), ",").alias("source_fields"), *rest,
    )


def snapshot_hash(symbols: Column, *header: Column) -> Column:
    """H17 for snapshots: SHA-256 of the canonical JSON of the sorted symbols and what the header states of them."""
    return F.sha2(F.to_json(F.struct(*[c.alias(f"h{k}") for k, c in enumerate(header)], F.array_sort(symbols).alias("symbols")), {"ignoreNullFields": "false"}), 256)


def build_snapshots(symbols: DataFrame, exchange: str, market: str, collected: str, trust: str, source_type: str, by: str = "path") -> DataFrame:
    """One snapshot for each payload (by) of symbols(by, hash, observed_ms, symbol, status, ...) as listing_symbols makes them.

    The columns are those of an archive: id, hash, times, trust, the payload's own hash and the symbols. A snapshot holds
    one exchange's symbols, which are few. trust is what the caller vouches for and has no default.
    """
    fields = ("symbol", "status", F.col("onboard_at"), F.col("delivery_at"))
    one = symbols.groupBy(by).agg(F.array_sort(F.collect_list(F.struct(*fields))).alias("symbols"), F.max("hash").alias("raw_sha256"), F.max("observed_ms").alias("ms"))
    rows = one.select(F.lit("1.0.0").alias("schema_version"), F.lit(exchange).alias("exchange"), F.lit(market).alias("market"), F.lit(collected).alias("collected_at"), exprs.rfc3339(F.col("ms")).alias("observed_at"), F.lit(trust).alias("trust_level"), F.lit(source_type).alias("source_type"), "raw_sha256", "symbols")
    digest = snapshot_hash(F.col("symbols"), F.col("exchange"), F.col("market"), F.col("collected_at"))
    return rows.withColumn("snapshot_hash", digest).withColumn("snapshot_id", exprs.snapshot_id(F.col("exchange"), F.col("market"), F.col("collected_at"), F.col("snapshot_hash")))


def verified_snapshots(archive: DataFrame) -> DataFrame:
    """Archived snapshots as archive_integrity takes them: the hash that they state and the one that their symbols have now."""
    now = snapshot_hash(F.col("symbols"), F.col("exchange"), F.col("market"), F.col("collected_at"))
    return archive.select("snapshot_id", "snapshot_hash", now.alias("computed_hash"), "raw_sha256", F.size("symbols").cast("bigint").alias("symbols"), "source_type")


def listing_findings(symbols: DataFrame, by: list[str]) -> DataFrame:
    """I1 by symbol: findings over symbols(by, symbol, status, raw_status, onboard_at, delivery_at) of every snapshot; times are text or null."""
    w = Window.partitionBy(*by, "symbol").orderBy("status")
    rows = symbols.withColumn("__k", F.row_number().over(w)).withColumn("__t", F.concat_ws("/", *by, "symbol"))
    status = F.coalesce("status", F.lit("UNKNOWN"))
    rules = [
        ("EXCHANGE_META_DUPLICATE_SYMBOL", "FAIL", F.col("__k") > 1),
        ("EXCHANGE_META_SYMBOL_MALFORMED", "FAIL", ~exprs.snapshot_symbol(F.col("symbol"))),
        ("EXCHANGE_META_STATUS_UNKNOWN", "FAIL", ~status.isin(*STATUSES)),
        ("EXCHANGE_META_STATUS_UNKNOWN", "WARN", status == "UNKNOWN"),
        ("EXCHANGE_META_SYMBOL_STATUS_UNMAPPED", "WARN", (status == "UNKNOWN") & exprs.upper_or_null(F.col("raw_status")).isNotNull()),
    ]
    for name, at in (("ONBOARD", F.col("onboard_at")), ("DELIVERY", F.col("delivery_at"))):
        rules += [(f"EXCHANGE_META_{name}_DATE_MISSING", "WARN", at.isNull()), (f"EXCHANGE_META_{name}_DATE_MISSING", "FAIL", at.isNotNull() & exprs.parsed_ms(at).isNull())]
    return explode_rules(rows, "__t", rules)


def snapshot_findings(snapshots: DataFrame) -> DataFrame:
    """I1 by snapshot: findings over snapshots(snapshot_id, raw_sha256, observed, source_type, symbols), observed being null where it is unknown."""
    rules = [
        ("EXCHANGE_META_RAW_PAYLOAD_MISSING", "WARN", exprs.known(F.col("raw_sha256")).isNull()),
        ("EXCHANGE_META_SOURCE_TIME_UNKNOWN", "WARN", F.col("observed").isNull()),
        ("EXCHANGE_META_CURRENT_ONLY_SOURCE", "WARN", exprs.current_only(F.col("source_type"))),
        ("EXCHANGE_META_EMPTY_SYMBOL_SET", "FAIL", F.coalesce(F.col("symbols") == 0, F.lit(True))),
    ]
    return explode_rules(snapshots, "snapshot_id", rules)


def snapshot_manifest(snapshots: DataFrame) -> DataFrame:
    """One row: archive_summary with the hash of the archive's snapshot hashes in the order of collection (a tree: days, then their hashes)."""
    line = F.concat_ws("|", "collected", "snapshot_id", "snapshot_hash")
    days = snapshots.groupBy(F.substring("collected", 1, 10).alias("day")).agg(exprs.set_hash(line).alias("h"))
    digest = days.agg(exprs.set_hash(F.concat_ws("|", "day", "h")).alias("archive_hash"))
    return archive_summary(snapshots).join(F.broadcast(digest))


def verdict(findings: DataFrame) -> DataFrame:
    """Counts by severity and the worst: FAIL, WARN or PASS."""
    out = findings.agg(F.count_if(F.col("severity") == "FAIL").alias("invalid"), F.count_if(F.col("severity") == "WARN").alias("warnings"))
    return out.withColumn("status", F.when(F.col("invalid") > 0, "FAIL").when(F.col("warnings") > 0, "WARN").otherwise("PASS"))


def symbol_evidence(seen: DataFrame) -> DataFrame:
    """E8 over seen(symbol, snapshot_id, collected, status, onboard_ms, delivery_ms); with a column hash also the sorted hashes of the snapshots."""
    hashes = [F.array_join(F.array_sort(F.collect_set("hash")), ",").alias("snapshot_hashes")] if "hash" in seen.columns else []
    return seen.groupBy("symbol").agg(
        F.min("collected").alias("first_seen"), F.max("collected").alias("last_seen"), F.countDistinct("snapshot_id").alias("times_seen"),
        F.array_join(F.array_sort(F.collect_set("status")), ",").alias("statuses"), F.bool_or(F.coalesce(F.col("onboard_ms") > 0, F.lit(False))).alias("has_onboard"), F.bool_or(F.coalesce(F.col("delivery_ms") > 0, F.lit(False))).alias("has_delivery"), *hashes,
    )


def summary_parts(snapshots: DataFrame, keys: list[str] = ()) -> DataFrame:
    """What archive_summary adds up, by keys and trust level: parts of a day can be kept and replaced without the others."""
    trust = F.coalesce(F.col("trust"), F.lit(""))
    return snapshots.groupBy(*keys, trust.alias("trust")).agg(F.count("*").alias("n"), F.count_if(F.col("observed").isNull()).alias("missing_time"), F.min("observed").alias("lo"), F.max("observed").alias("hi"), F.count_if(F.col("symbols") == 0).alias("empty"))


def summed_up(parts: DataFrame) -> DataFrame:
    """E9 from parts: counts, trust histogram, range, status."""
    each = parts.groupBy("trust").agg(*[F.sum(c).alias(c) for c in ("n", "missing_time", "empty")], F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    return each.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("snapshots"), count_map("trust").alias("trust_levels"),
        F.coalesce(F.sum(F.when(~F.col("trust").isin(*UNVERIFIED), F.col("n"))), F.lit(0)).alias("official"), F.coalesce(F.sum(F.when(F.col("trust").isin(*UNVERIFIED), F.col("n"))), F.lit(0)).alias("unverified"),
        F.coalesce(F.sum("missing_time"), F.lit(0)).alias("missing_time"), F.min("lo").alias("earliest"), F.max("hi").alias("latest"),
        F.when(F.coalesce(F.sum("n"), F.lit(0)) == 0, "FAIL").when(F.sum("empty") > 0, "WARN").otherwise("PASS").alias("status"),
    )


def archive_summary(snapshots: DataFrame) -> DataFrame:
    """E9 over snapshots(snapshot_id, trust, observed, symbols): counts, trust histogram, range, status."""
    return summed_up(summary_parts(snapshots))


def evidence_parts(seen: DataFrame, keys: list[str]) -> DataFrame:
    """symbol_evidence's aggregates by keys and symbol, before they are put together; a snapshot belongs to one value of keys."""
    return seen.groupBy(*keys, "symbol").agg(
        F.min("collected").alias("first_seen"), F.max("collected").alias("last_seen"), F.countDistinct("snapshot_id").alias("times_seen"), F.collect_set("status").alias("statuses"),
        F.bool_or(F.coalesce(F.col("onboard_ms") > 0, F.lit(False))).alias("has_onboard"), F.bool_or(F.coalesce(F.col("delivery_ms") > 0, F.lit(False))).alias("has_delivery"),
    )


def evidence_of(parts: DataFrame) -> DataFrame:
    """E8 from parts: one row a symbol."""
    return parts.groupBy("symbol").agg(
        F.min("first_seen").alias("first_seen"), F.max("last_seen").alias("last_seen"), F.sum("times_seen").alias("times_seen"),
        F.array_join(F.array_sort(F.array_distinct(F.flatten(F.collect_set("statuses")))), ",").alias("statuses"), F.bool_or("has_onboard").alias("has_onboard"), F.bool_or("has_delivery").alias("has_delivery"),
    )


def intake(incoming: DataFrame, archive: DataFrame, key: str = "hash", order: str = "path") -> DataFrame:
    """Each input with its outcome. The first of a batch wins, what the archive holds is a duplicate.

    Outcomes: SKIPPED (no hash), DUPLICATE, IMPORTED; of each hash that the
    archive lacks exactly one input is IMPORTED, also where order does not tell
    inputs apart. For that the batch is numbered once, in the shared folder. The
    first is a map-side minimum, so that inputs of one hash, or of none, never meet.
    """
    rows = cut(incoming.withColumn("__id", F.monotonically_increasing_id()))
    have = archive.select(F.col(key).alias("__have")).distinct()
    first = rows.filter(F.col(key).isNotNull()).groupBy(F.col(key).alias("__key")).agg(F.min(F.struct(order, "__id"))["__id"].alias("__first"))
    won = first.join(have, F.col("__key") == F.col("__have"), "left_anti").select("__first")
    outcome = F.when(F.col(key).isNull(), "SKIPPED").when(F.col("__first").isNull(), "DUPLICATE").otherwise("IMPORTED")
    return rows.join(won, F.col("__id") == F.col("__first"), "left").withColumn("outcome", outcome).drop("__id", "__first")


def backfill_report(inputs: DataFrame, archive: DataFrame, trust: str | None, order: str = "path") -> tuple[DataFrame, DataFrame]:
    """inputs(path, hash, observed, ...) with their outcome, and the findings of the whole intake.

    hash is null for inputs without symbols. trust is what the caller vouches
    for: none is unverified.
    """
    done = intake(inputs, archive, order=order)
    rules = [
        ("EXCHANGE_BACKFILL_INPUT_PARSE_FAILED", "WARN", F.col("outcome") == "SKIPPED"),
        ("EXCHANGE_BACKFILL_OBSERVED_TIME_MISSING", "WARN", (F.col("outcome") != "SKIPPED") & F.col("observed").isNull()),
        ("EXCHANGE_BACKFILL_DUPLICATE_SNAPSHOT", "WARN", F.col("outcome") == "DUPLICATE"),
    ]
    level = (trust or "").strip().upper() or "USER_PROVIDED_UNVERIFIED"
    head = [
        ("EXCHANGE_BACKFILL_INPUT_EMPTY", "FAIL", F.col("n") == 0),
        ("EXCHANGE_BACKFILL_USER_PROVIDED_UNVERIFIED", "WARN", (F.col("n") > 0) & F.lit(level == "USER_PROVIDED_UNVERIFIED")),
        ("EXCHANGE_BACKFILL_TRUST_LEVEL_UNKNOWN", "WARN", (F.col("n") > 0) & F.lit(level == "UNKNOWN")),
    ]
    whole = inputs.agg(F.count("*").alias("n")).withColumn("t", F.lit(""))
    return done, explode_rules(done.withColumn("__t", F.col(order).cast("string")), "__t", rules).unionByName(explode_rules(whole, "t", head))


def intake_hashes(done: DataFrame, trust: str) -> DataFrame:
    """E21 for an intake: one row with the hashes of what came in and of what was imported; trees by the hash's first character, so that no task holds all lines."""
    line = F.concat_ws("|", exprs.basename(F.col("path")), "input_sha256", F.coalesce("observed", F.lit("null")), F.lit(trust))
    imported = F.when(F.col("outcome") == "IMPORTED", F.concat_ws("|", F.coalesce("observed", F.lit("")), "hash"))
    each = done.filter("outcome <> 'SKIPPED'").groupBy(F.substring("input_sha256", 1, 2).alias("d")).agg(exprs.set_hash(line).alias("a"), exprs.set_hash(imported).alias("b"))
    return each.agg(exprs.set_hash(F.concat_ws("|", "d", "a")).alias("source_batch_hash"), exprs.set_hash(F.concat_ws("|", "d", "b")).alias("imported_snapshot_set_hash"))


def archive_integrity(snapshots: DataFrame, raw: DataFrame, manifest: DataFrame, strict: bool = False) -> DataFrame:
    """I7 with D10, D13 and D16: distinct findings of an archive.

    snapshots(snapshot_id, snapshot_hash, computed_hash, raw_sha256, symbols, source_type), an unparsed one having a null
    snapshot_hash; raw(name_hash, sha256) of stored payloads, by the hash in their names and that of their bytes; manifest
    (snapshot_count, sound), of no row where there is none. strict makes missing payloads and duplicates failures.
    """
    lax = "FAIL" if strict else "WARN"
    have = raw.groupBy(F.col("name_hash").alias("__name")).agg(F.bool_and(F.col("sha256") == F.col("name_hash")).alias("__same"))
    parsed = F.col("snapshot_hash").isNotNull()
    wanted = parsed & exprs.known(F.col("raw_sha256")).isNotNull()
    rows = snapshots.join(have, F.col("raw_sha256") == F.col("__name"), "left")
    rules = [
        ("EXCHANGE_ARCHIVE_SNAPSHOT_PARSE_FAILED", "FAIL", ~parsed),
        ("EXCHANGE_ARCHIVE_HASH_MISMATCH", "FAIL", parsed & (F.col("computed_hash") != F.col("snapshot_hash"))),
        ("EXCHANGE_ARCHIVE_RAW_PAYLOAD_MISSING", lax, wanted & F.col("__name").isNull()),
        ("EXCHANGE_ARCHIVE_RAW_PAYLOAD_MISSING", "FAIL", wanted & ~F.col("__same")),
        ("EXCHANGE_ARCHIVE_EMPTY", "FAIL", parsed & (F.col("symbols") == 0)),
        ("EXCHANGE_ARCHIVE_CURRENT_ONLY_EVIDENCE", "WARN", parsed & exprs.current_only(F.col("source_type"))),
    ]
    found = explode_rules(rows, "snapshot_id", rules)
    ids = snapshots.filter(parsed).groupBy("snapshot_id").agg(F.count("*").alias("n"), F.countDistinct("snapshot_hash").alias("h"))
    found = found.unionByName(explode_rules(ids, "snapshot_id", [("EXCHANGE_ARCHIVE_CONFLICTING_SNAPSHOT", "FAIL", F.col("h") > 1), ("EXCHANGE_ARCHIVE_DUPLICATE_SNAPSHOT", lax, F.col("n") > F.col("h"))]))
    counts = ids.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).join(F.broadcast(manifest.agg(F.max("snapshot_count").alias("said"), F.bool_and("sound").alias("sound"))))
    some = F.col("n") > 0
    head = [
        ("EXCHANGE_ARCHIVE_EMPTY", "FAIL", "archive", ~some),
        ("EXCHANGE_ARCHIVE_MANIFEST_STALE", "FAIL", "manifest", some & (F.col("said").isNull() | (F.col("sound") & (F.col("said") != F.col("n"))))),
        ("EXCHANGE_ARCHIVE_HASH_MISMATCH", "FAIL", "manifest", some & ~F.col("sound")),
    ]
    for code, severity, target, holds in head:
        found = found.unionByName(explode_rules(counts.withColumn("t", F.lit(target)), "t", [(code, severity, holds)]))
    return found.distinct()


def snapshot_conflicts(snapshots: DataFrame, by: str = "snapshot_id", key: str = "hash") -> DataFrame:
    """Ids with several hashes, and ids that repeat one."""
    out = snapshots.groupBy(by).agg(F.count("*").alias("entries"), F.countDistinct(key).alias("hashes"))
    return out.filter("entries > 1").withColumn("code", F.when(F.col("hashes") > 1, "CONFLICTING_HASHES").otherwise("DUPLICATE_SNAPSHOT"))


def latest(snapshots: DataFrame, collected: str = "collected", tie: str = "snapshot_id") -> DataFrame:
    """the rows of the latest snapshot; found by an aggregate, not by a window over everything."""
    top = snapshots.agg(F.max(F.struct(F.col(collected).alias("c"), F.col(tie).alias("i"))).alias("top"))
    return snapshots.join(F.broadcast(top), (F.col(collected) == F.col("top.c")) & (F.col(tie) == F.col("top.i"))).drop("top")
