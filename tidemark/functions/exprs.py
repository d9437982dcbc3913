"""Scalar expressions: intervals, times, identifiers, statuses, keys and hashes. Every function takes and returns columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the data formats: milliseconds by unit, quote assets by priority, statuses by exchange code.
UNIT_MS = {"m": 60_000, "h": 3_600_000, "d": 86_400_000, "w": 604_800_000}
RANGE_INTERVALS = ("1m", "3m", "5m", "15m", "1h", "4h", "1d")
QUOTES = ("USDT", "USDC", "USD", "BTC", "ETH")
EXCHANGE_STATUS = {"ACTIVE": "ACTIVE", "TRADING": "TRADING", "BREAK": "BREAK", "HALT": "HALT", "PENDING_TRADING": "PRE_TRADING", "PRE_TRADING": "PRE_TRADING", "SETTLING": "SETTLING", "DELIVERED": "DELIVERED", "DELISTED": "DELISTED", "EXPIRED": "EXPIRED"}
LIFECYCLE_STATUS = {"ACTIVE": "ACTIVE", "TRADING": "ACTIVE", "BREAK": "ACTIVE", "HALT": "ACTIVE", "PRE_TRADING": "ACTIVE", "SETTLING": "ACTIVE", "DELIVERED": "DELISTED", "DELISTED": "DELISTED", "EXPIRED": "EXPIRED"}
TERMINAL = ("DELISTED", "EXPIRED")
UNVERIFIED = ("USER_PROVIDED_UNVERIFIED", "UNKNOWN", "")
# What a time with a zone looks like.
RFC3339 = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}(\.[0-9]+)?(Z|[+-][0-9]{2}:[0-9]{2})$"
DAY_MS = 86_400_000


def epoch_ms(ts: Column) -> Column:
    """Milliseconds since 1970 of a timestamp without time zone, whatever the session's zone."""
    days = F.date_diff(F.to_date(ts), F.lit("1970-01-01").cast("date")).cast("bigint")
    seconds = F.floor(F.extract(F.lit("SECOND"), ts) * 1000).cast("bigint")
    return days * DAY_MS + F.hour(ts) * 3_600_000 + F.minute(ts) * 60_000 + seconds


def interval_ms(token: Column) -> Column:
    """H1: `15m` to milliseconds; null for what is no interval."""
    n, unit = F.regexp_extract(token, r"^([0-9]+)([mhdw])$", 1), F.regexp_extract(token, r"^([0-9]+)([mhdw])$", 2)
    scale = F.coalesce(*[F.when(unit == u, F.lit(ms)) for u, ms in UNIT_MS.items()])
    return F.when(n != "", n).try_cast("bigint") * scale


def range_interval_ms(token: Column) -> Column:
    """H2: the same for the fixed set that range reports support."""
    return F.when(token.isin(*RANGE_INTERVALS), interval_ms(token))


def expected_rows(lo: Column, hi: Column, step: Column) -> Column:
    """H3: slots from lo to hi, both included."""
    return F.floor((hi - lo) / step) + 1


def utc_date(ms: Column) -> Column:
    """The UTC day of epoch milliseconds as `YYYY-MM-DD`, whatever the session's zone."""
    return F.date_add(F.lit("1970-01-01").cast("date"), F.floor(ms / DAY_MS).cast("int")).cast("string")


def _utc(ms: Column) -> Column:
    s = F.floor(F.pmod(ms, F.lit(DAY_MS)) / 1000)
    return F.concat(utc_date(ms), F.format_string("T%02d:%02d:%02dZ", F.floor(s / 3600), F.floor(s % 3600 / 60), s % 60))


def rfc3339(ms: Column) -> Column:
    """Epoch milliseconds to UTC seconds as text; null if not positive."""
    return F.when(ms > 0, _utc(ms))


def parsed_ms(text: Column) -> Column:
    """Epoch milliseconds of RFC 3339 text; null for anything else."""
    return F.when(F.trim(text).rlike(RFC3339), F.unix_millis(F.try_to_timestamp(F.trim(text))))


def normalized_time(text: Column) -> Column:
    """H9: RFC 3339 text to UTC seconds; null for blank and UNKNOWN; malformed text stays as it is, which malformed_time() tells."""
    return F.coalesce(_utc(parsed_ms(text)), known(text))


def malformed_time(text: Column) -> Column:
    """Whether text is given and is no time."""
    return known(text).isNotNull() & parsed_ms(text).isNull()


def known(text: Column) -> Column:
    """Blank and UNKNOWN become null."""
    trimmed = F.trim(text)
    return F.when((trimmed != "") & (F.upper(trimmed) != "UNKNOWN"), trimmed)


def unknown(text: Column) -> Column:
    return F.coalesce(text, F.lit("UNKNOWN"))


def snake(label: Column) -> Column:
    """H11."""
    return F.replace(F.lower(F.trim(label)), F.lit(" "), F.lit("_"))


def intensity(score: Column) -> Column:
    """Distance from the middle of a score of 0 to 100."""
    return F.abs(score - 50) / 50


def market_symbol(s: Column) -> Column:
    """Upper-case symbol of 3 to 30 letters and digits."""
    return s.rlike("^[A-Z0-9]{3,30}$")


def snapshot_symbol(s: Column) -> Column:
    """As listings have it, of 3 to 40."""
    return s.rlike("^[A-Z0-9]{3,40}$")


def series_symbol(s: Column) -> Column:
    """As series have it, underscores allowed."""
    return s.rlike("^[A-Z0-9_]+$")


def current_only(source_type: Column) -> Column:
    """C14: whether a source shows only what is current."""
    return F.coalesce(F.lower(source_type).contains("current"), F.lit(False))


def unverified(trust: Column) -> Column:
    """C15."""
    return F.coalesce(F.upper(F.trim(trust)), F.lit("")).isin(*UNVERIFIED)


def upper_or_null(s: Column) -> Column:
    """Upper case, null for blank."""
    return F.nullif(F.upper(F.trim(s)), F.lit(""))


def safe_identifier(s: Column) -> Column:
    """C11: not blank, no parent reference, no separators."""
    return (F.length(F.trim(s)) > 0) & ~s.contains("..") & ~s.contains("/") & ~s.contains("\\")


def quote_asset(symbol: Column) -> Column:
    """H7: the first known quote asset that a symbol ends with and something stands before."""
    return F.coalesce(*[F.when(symbol.endswith(q) & (F.length(symbol) > len(q)), F.lit(q)) for q in QUOTES])


def base_asset(symbol: Column) -> Column:
    q = quote_asset(symbol)
    return F.when(q.isNotNull(), F.substring(symbol, F.lit(1), F.length(symbol) - F.length(q)))


def _lookup(table: dict[str, str], key: Column) -> Column:
    return F.coalesce(*[F.when(key == k, F.lit(v)) for k, v in table.items()], F.lit("UNKNOWN"))


def exchange_status(raw: Column) -> Column:
    """H8."""
    return _lookup(EXCHANGE_STATUS, F.upper(F.trim(raw)))


def lifecycle_status(status: Column) -> Column:
    return _lookup(LIFECYCLE_STATUS, status)


def terminal(status: Column) -> Column:
    return status.isin(*TERMINAL)


def _part(path: Column, pattern: str) -> Column:
    return F.nullif(F.regexp_extract(path, pattern, 1), F.lit(""))


def path_symbol(path: Column) -> Column:
    """H4: from `symbol=`, else from the file's name."""
    return F.coalesce(_part(path, "symbol=([^/]+)"), _part(path, "([A-Z0-9_]+)-[0-9]+[mhdw]-[^/]*$"))


def path_interval(path: Column) -> Column:
    return F.coalesce(_part(path, "interval=([^/]+)"), _part(path, "/([0-9]+[mhdw])/"), _part(path, "-([0-9]+[mhdw])-[^/]*$"))


def audit_symbol(path: Column, hint: Column | None = None) -> Column:
    """H4 for audits: a hint, else `symbol=`, else what the file's name begins with."""
    return F.coalesce(*([] if hint is None else [hint]), _part(path, "symbol=([A-Z0-9]+)"), _part(path, "(?:^|/)([A-Z0-9]+)-[^/]*$"))


def audit_interval(path: Column, hint: Column | None = None) -> Column:
    return F.coalesce(*([] if hint is None else [hint]), _part(path, "interval=([0-9]+[mhdw])"), _part(path, "-([0-9]+[mhdw])-[^/]*$"))


def folder_symbol(path: Column) -> Column:
    """H4 for manifests: the folder `symbol=` alone."""
    return F.upper(_part(path, "(?:^|/)symbol=([^/]+)"))


def folder_interval(path: Column) -> Column:
    """H4 for manifests and lifecycles: the folder `interval=`, else the first folder that is an interval."""
    folders = F.filter(F.split(path, "/"), lambda x, i: (i > 0) & interval_token(x))
    return F.coalesce(_part(path, "(?:^|/)interval=([^/]+)"), F.get(folders, F.lit(0)))


def lifecycle_symbol(path: Column) -> Column:
    """H4 for lifecycles: the folder, else the file's name up to its first dash."""
    return F.coalesce(folder_symbol(path), F.upper(_part(path, "(?:^|/)([^/-]+)-[^/]*$")))


def path_market(path: Column) -> Column:
    """H5."""
    return F.when(path.contains("futures"), F.lit("futures")).when(path.contains("spot"), F.lit("spot"))


def interval_token(text: Column) -> Column:
    """H6."""
    return text.rlike("^[0-9]+[mhdw]$")


def basename(path: Column) -> Column:
    """H21."""
    return F.element_at(F.split(path, "/"), -1)


def key_period(key: Column) -> Column:
    """`YYYY-MM` or `YYYY-MM-DD` at the end of an object's name, else null."""
    return _part(key, r"-([0-9]{4}-[0-9]{2}(?:-[0-9]{2})?)\.[a-z]+$")


def period_start(period: Column) -> Column:
    return F.try_to_date(F.when(F.length(period) == 7, F.concat(period, F.lit("-01"))).otherwise(period))


def period_end(period: Column) -> Column:
    return F.when(F.length(period) == 7, F.last_day(period_start(period))).otherwise(period_start(period))


def overlaps(key: Column, lo: Column, hi: Column) -> Column:
    """Whether an object's period overlaps [lo, hi]; false for keys without a period."""
    # A lambda's argument is evaluated once, however often it stands in the body.
    met = F.transform(F.array(key_period(key)), lambda p: (period_start(p) <= hi) & (period_end(p) >= lo))
    return F.coalesce(F.get(met, F.lit(0)), F.lit(False))


def candle_key(market: Column, interval: Column, symbol: Column, period: Column) -> Column:
    """The object of one series and month or day."""
    return F.concat(F.lit("candles/"), market, F.lit("/"), interval, F.lit("/symbol="), F.upper(symbol), F.lit("/year="), F.substring(period, 1, 4), F.lit("/month="), F.substring(period, 6, 2), F.lit("/"), F.upper(symbol), F.lit("-"), interval, F.lit("-"), period, F.lit(".parquet"))


def _folders(**parts: Column | str) -> list[Column]:
    return [x for k, v in parts.items() for x in (F.lit(f"/{k}="), F.lit(v) if isinstance(v, str) else v)]


def candle_manifest_key(market: Column, interval: Column, symbol: Column) -> Column:
    """The manifest of one candle series."""
    return F.concat(F.lit("manifests/"), market, F.lit("/"), interval, F.lit("/symbol="), symbol, F.lit("/manifest.json"))


def _safe(key: Column, *parts: Column) -> Column:
    ok = F.lit(True)
    for x in parts:
        ok = ok & F.coalesce(safe_identifier(x), F.lit(False))
    return F.when(ok, key)


def sentiment_key(source: Column, dataset: Column, scope: Column, interval: Column, period: Column) -> Column:
    """The object of one sentiment series and month; null for unsafe parts or another period."""
    key = F.concat(F.lit("datasets/sentiment"), *_folders(source=source, dataset=dataset, scope=scope, interval=interval, year=F.substring(period, 1, 4), month=F.substring(period, 6, 2)), F.lit("/"), dataset, F.lit("-"), period, F.lit(".parquet"))
    return F.when(period.rlike("^[0-9]{4}-[0-9]{2}$"), _safe(key, source, dataset, scope, interval))


def derivatives_key(source: Column, dataset: Column, market: Column, symbol: Column, interval: Column, period: Column) -> Column:
    """The same of a derivatives series."""
    key = F.concat(F.lit("datasets/derivatives"), *_folders(source=source, dataset=dataset, market=market, symbol=symbol, interval=interval, year=F.substring(period, 1, 4), month=F.substring(period, 6, 2)), F.lit("/"), symbol, F.lit("-"), dataset, F.lit("-"), period, F.lit(".parquet"))
    return F.when(period.rlike("^[0-9]{4}-[0-9]{2}$"), _safe(key, source, dataset, market, symbol, interval))


def sentiment_manifest_key(source: Column, dataset: Column, scope: Column) -> Column:
    return _safe(F.concat(F.lit("manifests/datasets/sentiment/"), source, F.lit("/"), dataset, *_folders(scope=scope), F.lit("/manifest.json")), source, dataset, scope)


def derivatives_manifest_key(source: Column, dataset: Column, market: Column, symbol: Column, interval: Column) -> Column:
    return _safe(F.concat(F.lit("manifests/datasets/derivatives/"), source, F.lit("/"), dataset, *_folders(market=market, symbol=symbol, interval=interval), F.lit("/manifest.json")), source, dataset, market, symbol)


def snapshot_id(exchange: Column, market: Column, collected: Column, digest: Column) -> Column:
    """Exchange, market, compact time of collection and the hash's first twelve characters, in lower case."""
    compact = F.replace(F.translate(collected, "-:Z", ""), F.lit("T"), F.lit("_"))
    return F.lower(F.concat_ws("_", exchange, market, compact, F.substring(digest, 1, 12)))


def observed_time(path: Column, layout: str | None, stated: Column, payload_ms: Column) -> Column:
    """From the file's name by a layout, else as stated, else the payload's own time; UTC seconds as text or null."""
    name = F.regexp_replace(basename(path), r"\.[^.]*$", "")
    named = F.lit(None).cast("bigint") if layout is None else F.unix_millis(F.try_to_timestamp(F.concat(name, F.lit(" Z")), F.lit(f"{layout} X")))
    return F.coalesce(_utc(named), normalized_time(stated), rfc3339(payload_ms))


def observed_at(start: Column, end: Column) -> Column:
    """When evidence without a time of its own was observed: the window's end, else its start, else null."""
    return F.coalesce(known(end), known(start))


def fields_present(**fields: Column) -> Column:
    """Names of the fields that are not null, `symbol` first."""
    return F.array_compact(F.array(F.lit("symbol"), *[F.when(c.isNotNull(), F.lit(n)) for n, c in fields.items()]))


def fingerprint(*cols: str) -> Column:
    """SHA-256 of a row's canonical JSON, nulls included."""
    return F.sha2(F.to_json(F.struct(*cols), {"ignoreNullFields": "false"}), 256)


def set_hash(member: Column, separator: str = "\n") -> Column:
    """SHA-256 over the ordered members of a group; an aggregate. A group is a manifest's list, which stays small."""
    return F.sha2(F.array_join(F.array_sort(F.collect_list(member)), separator), 256)


def window_coverage(current_only: Column, lo: Column, hi: Column, start: Column, end: Column) -> Column:
    """How evidence from lo to hi covers a window."""
    missing = lo.isNull() | hi.isNull() | start.isNull() | end.isNull()
    return F.when(current_only, F.lit("CURRENT_ONLY")).when(missing, F.lit("UNKNOWN")).when((lo > start) | (hi < end), F.lit("PARTIAL")).otherwise(F.lit("COVERS_WINDOW"))


def active_during(listed: Column, delisted: Column, start: Column, end: Column) -> Column:
    """Not active if listed after the window or delisted before it; active where a bound is unknown."""
    return ~(F.coalesce(listed > end, F.lit(False)) | F.coalesce(delisted < start, F.lit(False)))
