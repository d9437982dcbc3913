"""Symbol lifecycles: from data, merged from listing snapshots, and their findings."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import exprs
from .listing import UNVERIFIED, explode_rules

# Statuses and evidence levels that a lifecycle may have.
STATUSES = ("ACTIVE", "DELISTED", "EXPIRED", "RENAMED", "UNKNOWN")
LEVELS = ("VERIFIED_EXCHANGE_LISTING", "VERIFIED_EXCHANGE_DELISTING", "HISTORICAL_SNAPSHOT_EVIDENCE", "LOCAL_DATA_FIRST_SEEN", "CURRENT_ACTIVE_ONLY", "USER_PROVIDED_UNVERIFIED", "UNKNOWN")
ENDS_PROVEN = ("VERIFIED_EXCHANGE_DELISTING", "HISTORICAL_SNAPSHOT_EVIDENCE")


def lifecycle_from_files(rows: DataFrame, files: DataFrame, t: str, start: str | None = None, end: str | None = None) -> DataFrame:
    """E18 with the hash of the symbol's files(path, symbol, sha256), in path order, and H28's time of observation."""
    from .universe import file_set_hash

    out = lifecycle_from_data(rows, t).join(file_set_hash(files).withColumnRenamed("h", "source_hash").drop("n"), "symbol", "left")
    return out.withColumn("observed_at", exprs.observed_at(F.lit(start), F.lit(end)))


def lifecycle_from_data(rows: DataFrame, t: str) -> DataFrame:
    """What local rows(symbol, interval, market, time) show of each symbol; never a listing date."""
    one = lambda c: F.when(F.countDistinct(c) == 1, F.min(c))
    return rows.groupBy("symbol").agg(F.min(t).alias("first_seen"), F.max(t).alias("last_seen"), one("interval").alias("interval"), one("market").alias("market"), F.count("*").alias("rows"), F.lit("LOCAL_DATA_FIRST_SEEN").alias("evidence_level"))


def lifecycle_base(*rows: DataFrame) -> DataFrame:
    """Lifecycles read from files, with times as text, or from data, with times in milliseconds, as one base to merge snapshots into.

    The first frame that has a symbol decides; rows that repeat it within that
    frame stay, as duplicates are findings. What data show is never a listing date.
    """
    names = {"symbol": "string", "status": "string", "listed_ms": "bigint", "delisted_ms": "bigint", "evidence_level": "string", "malformed": "boolean"}
    out = None
    for df in rows:
        if "listed_at" in df.columns:
            df = df.withColumns({"listed_ms": exprs.parsed_ms(F.col("listed_at")), "delisted_ms": exprs.parsed_ms(F.col("delisted_at"))})
        one = df.select(*[(F.col(c) if c in df.columns else F.lit(None)).cast(kind).alias(c) for c, kind in names.items()])
        one = one.withColumns({"status": F.coalesce("status", F.lit("UNKNOWN")), "malformed": F.coalesce("malformed", F.lit(False))})
        out = one if out is None else out.unionByName(one.join(out.select(F.col("symbol").alias("__have")).distinct(), F.col("symbol") == F.col("__have"), "left_anti"))
    return out


def merge_snapshots(base: DataFrame, seen: DataFrame) -> DataFrame:
    """base(symbol, status, listed_ms, delisted_ms, evidence_level) brought up to date by seen(symbol, seq, status, onboard_ms, delivery_ms, unverified).

    Statuses go in the order of seq: the last terminal one wins, else the first
    known, the base's before theirs. An onboarding date is taken where no listing
    date is known; a delivery date only from a snapshot by which the status is
    terminal. The last
    snapshot decides the evidence level.
    """
    w = Window.partitionBy("symbol").orderBy("seq").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    life = exprs.lifecycle_status(F.col("status"))
    rows = seen.select("symbol", "seq", life.alias("life"), "onboard_ms", "delivery_ms", "unverified")
    rows = rows.withColumn("ended", F.max(exprs.terminal(F.col("life"))).over(w))
    final, is_known = exprs.terminal(F.col("life")), F.col("life") != "UNKNOWN"
    late = F.col("ended") & F.col("delivery_ms").isNotNull()
    each = rows.groupBy("symbol").agg(
        F.max_by(F.when(final, F.col("life")), F.when(final, F.col("seq"))).alias("s_terminal"), F.min_by(F.when(is_known, F.col("life")), F.when(is_known, F.col("seq"))).alias("s_known"),
        F.min_by("delivery_ms", F.when(F.col("delivery_ms").isNotNull(), F.col("seq"))).alias("s_any_delivery"), F.min_by("onboard_ms", F.when(F.col("onboard_ms").isNotNull(), F.col("seq"))).alias("s_onboard"), F.min_by(F.when(late, F.col("delivery_ms")), F.when(late, F.col("seq"))).alias("s_delivery"),
        F.max_by("unverified", "seq").alias("s_unverified"), F.min("seq").alias("first_seq"), F.max("seq").alias("last_seq"), F.count("*").alias("snapshots"),
    )
    b = base.select("symbol", F.nullif("status", F.lit("UNKNOWN")).alias("b_status"), "listed_ms", "delisted_ms", "evidence_level")
    m = b.join(each, "symbol", "full_outer")
    kept = F.when(exprs.terminal(F.col("b_status")), F.col("b_status"))
    level = F.when(F.col("snapshots").isNull(), F.col("evidence_level")).when(F.col("s_unverified"), "USER_PROVIDED_UNVERIFIED").when(F.col("evidence_level").startswith("VERIFIED"), F.col("evidence_level")).otherwise("HISTORICAL_SNAPSHOT_EVIDENCE")
    return m.select(
        "symbol", exprs.unknown(F.coalesce("s_terminal", kept, "b_status", "s_known")).alias("status"), F.coalesce("listed_ms", "s_onboard").alias("listed_ms"), F.coalesce("delisted_ms", F.when(kept.isNotNull(), F.col("s_any_delivery")), "s_delivery").alias("delisted_ms"),
        "first_seq", "last_seq", F.coalesce("snapshots", F.lit(0)).alias("snapshots"), level.alias("evidence_level"),
    )


def disappeared(seen: DataFrame) -> DataFrame:
    """symbols of some snapshot that the last lacks, without a terminal status; none if there is one snapshot."""
    span = seen.agg(F.max("seq").alias("__top"), F.min("seq").alias("__low"))
    each = seen.groupBy("symbol").agg(F.max("seq").alias("last_seq"), F.bool_or(exprs.terminal(exprs.lifecycle_status(F.col("status")))).alias("__end"))
    return each.join(F.broadcast(span)).filter("__top > __low and last_seq < __top and not __end").select("symbol", "last_seq")


def lifecycle_findings(symbols: DataFrame, sources: DataFrame) -> DataFrame:
    """Distinct findings over symbols(symbol, status, listed_ms, delisted_ms, evidence_level) and sources(symbol, source_hash, observed_ms).

    A boolean column malformed, of either side, marks rows that had times that
    are none. What the manifest as a whole lacks has the empty target.
    """
    w = Window.partitionBy("symbol").orderBy("status")
    have = sources.select(F.col("symbol").alias("__s")).distinct()
    rows = symbols.withColumn("__k", F.row_number().over(w)).join(have, F.col("symbol") == F.col("__s"), "left")
    broken = lambda df: F.coalesce(F.col("malformed"), F.lit(False)) if "malformed" in df.columns else F.lit(False)
    level, listed, delisted = F.col("evidence_level"), F.col("listed_ms"), F.col("delisted_ms")
    status = F.coalesce("status", F.lit("UNKNOWN"))
    rules = [
        ("LIFECYCLE_DUPLICATE_SYMBOL", "FAIL", F.col("__k") > 1),
        ("LIFECYCLE_SYMBOL_MALFORMED", "FAIL", ~exprs.market_symbol(F.col("symbol"))),
        ("LIFECYCLE_EVIDENCE_MISSING", "FAIL", broken(symbols) | ~F.coalesce(level, F.lit("UNKNOWN")).isin(*LEVELS)),
        ("LIFECYCLE_LISTED_AFTER_DELISTED", "FAIL", listed > delisted),
        ("LIFECYCLE_STATUS_UNKNOWN", "WARN", status == "UNKNOWN"),
        ("LIFECYCLE_STATUS_UNKNOWN", "FAIL", ~status.isin(*STATUSES)),
        ("LIFECYCLE_LISTED_DATE_MISSING", "WARN", listed.isNull()),
        ("LIFECYCLE_DELISTED_DATE_MISSING", "WARN", delisted.isNull()),
        ("LIFECYCLE_EVIDENCE_MISSING", "WARN", exprs.known(level).isNull() | F.col("__s").isNull()),
        ("LIFECYCLE_LOCAL_DATA_ONLY_NOT_LISTING_PROOF", "WARN", level == "LOCAL_DATA_FIRST_SEEN"),
        ("LIFECYCLE_CURRENT_ACTIVE_ONLY_RISK", "WARN", level == "CURRENT_ACTIVE_ONLY"),
        ("LIFECYCLE_USER_PROVIDED_UNVERIFIED", "WARN", level == "USER_PROVIDED_UNVERIFIED"),
        ("LIFECYCLE_LISTED_DATE_MISSING", "FAIL", (level == "VERIFIED_EXCHANGE_LISTING") & listed.isNull()),
        ("LIFECYCLE_DELISTED_DATE_MISSING", "FAIL", (level == "VERIFIED_EXCHANGE_DELISTING") & delisted.isNull()),
    ]
    of_source = [("LIFECYCLE_SOURCE_HASH_MISSING", "WARN", F.col("source_hash").isNull()), ("LIFECYCLE_EVIDENCE_MISSING", "FAIL", broken(sources))]
    # Sources count where their symbol is in the manifest.
    of_symbols = sources.join(symbols.select("symbol").distinct(), "symbol", "left_semi")
    found = explode_rules(rows, "symbol", rules).unionByName(explode_rules(of_symbols, "symbol", of_source)).distinct()
    whole = evidence_support(symbols, sources).select(F.lit("").alias("target"), F.array_compact(F.array(F.when(F.col("symbols") == 0, F.struct(F.lit("LIFECYCLE_EMPTY").alias("code"), F.lit("FAIL").alias("severity"))), F.when(F.col("survivorship") != "LOW_SUPPORTED", F.struct(F.lit("LIFECYCLE_LOW_RISK_UNPROVEN").alias("code"), F.lit("WARN").alias("severity"))))).alias("f"))
    return found.unionByName(whole.select("target", F.inline("f")))


def evidence_support(symbols: DataFrame, sources: DataFrame) -> DataFrame:
    """How far a manifest's listing, delisting and survivorship evidence goes; one row. What holds must hold for every symbol."""
    level = F.coalesce("evidence_level", F.lit("UNKNOWN"))
    hashed = sources.groupBy(F.col("symbol").alias("__s")).agg(F.bool_and(F.col("source_hash").isNotNull()).alias("__hashed"))
    rows = symbols.join(hashed, F.col("symbol") == F.col("__s"), "left")
    listed = F.col("listed_ms").isNotNull() & level.isin("VERIFIED_EXCHANGE_LISTING", *ENDS_PROVEN)
    ended = F.col("delisted_ms").isNotNull() & level.isin(*ENDS_PROVEN)
    supported = F.col("listed_ms").isNotNull() & ended & F.coalesce("__hashed", F.lit(True))
    some = lambda x: F.bool_or(level == x)
    none = F.count("*") == 0
    return rows.agg(
        F.count("*").alias("symbols"),
        F.when(none, "MISSING").when(F.bool_and(listed), "VERIFIED").when(some("LOCAL_DATA_FIRST_SEEN"), "FIRST_SEEN_ONLY").when(some("CURRENT_ACTIVE_ONLY"), "CURRENT_ACTIVE_ONLY").when(some("USER_PROVIDED_UNVERIFIED"), "USER_PROVIDED_UNVERIFIED").otherwise("MISSING").alias("listing"),
        F.when(none, "MISSING").when(F.bool_and(ended), "VERIFIED").otherwise("MISSING").alias("delisting"),
        F.when(none, "UNKNOWN").when(F.bool_and(supported), "LOW_SUPPORTED").otherwise("ELEVATED").alias("survivorship"),
    )


def grade_sources(sources: DataFrame, files: DataFrame | None = None) -> DataFrame:
    """I16: without a hash a source is unverified; confidence is MEDIUM only for hashed evidence of a verified level.

    files(path, sha256) are source files that exist: the hash of a source's own file, by source_uri, replaces the stated one.
    """
    if files is not None:
        own = files.select(F.col("path").alias("__p"), F.col("sha256").alias("__h")).dropDuplicates(["__p"])
        sources = sources.join(own, F.col("source_uri") == F.col("__p"), "left").withColumn("source_hash", F.coalesce("__h", "source_hash")).drop("__p", "__h")
    hashed = F.col("source_hash").isNotNull()
    level = F.when(hashed, F.col("evidence_level")).otherwise("USER_PROVIDED_UNVERIFIED")
    return sources.withColumns({"evidence_level": level, "confidence": F.when(hashed & ~F.col("evidence_level").isin(*UNVERIFIED), "MEDIUM").otherwise("LOW")})


def duplicate_keys(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Every key that repeats, with its rows and the first and last of them."""
    return rows.groupBy(*keys).agg(F.count("*").alias("rows"), F.min(order).alias("first_row"), F.max(order).alias("last_row")).filter("rows > 1")
