"""Driver queries over the provided tables, and the SQL that checks them.

Views: candles are events as hourly series; obs are line items observed at the
order's date and available at the ship date; snapshots are a month's orders;
files are line items by supplier and month; lifecycle and universe are customers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import exprs as X
from ..functions.lineage import cut
from ..operators import lifecycle as L
from ..operators import listing as G
from ..operators import series as S
from ..operators import storage as P
from ..operators import universe as U

HOUR = 3_600_000
LO, HI = 1_704_067_200_000, 1_706_400_000_000  # 2024-01-01 and 2024-01-28, UTC
WINDOW = (904_608_000_000, 946_684_800_000)
CORE = ["S1USDT", "S2USDT"]
# Bytes that a cleanup may delete.
BUDGET = 20_000
# Arrival numbers of one part of a series.
ARRIVALS = 1_000_000


def table(spark, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def candles(spark, d) -> DataFrame:
    t = X.epoch_ms(F.col("ts"))
    return table(spark, d, "events").select(F.concat(F.upper("event_type"), F.lit("USDT")).alias("symbol"), F.lit("1h").alias("interval"), (F.floor(t / HOUR) * HOUR).alias("open_time_ms"), t.alias("ms"), "event_id", "value", "event_type", "props")


def obs(spark, d) -> DataFrame:
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate", "l_extendedprice")
    j = li.join(o, li["l_orderkey"] == o["o_orderkey"])
    return j.select(F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("symbol"), X.epoch_ms(F.col("o_orderdate")).alias("event_ms"), X.epoch_ms(F.col("l_shipdate")).alias("available_ms"), "l_orderkey", "l_linenumber", F.col("l_extendedprice").alias("value"))


def seen(spark, d) -> DataFrame:
    ms = X.epoch_ms(F.col("o_orderdate"))
    status = F.when(F.col("o_orderstatus") == "F", "DELIVERED").when(F.col("o_orderstatus") == "O", "TRADING").otherwise("PENDING_TRADING")
    return table(spark, d, "orders").select(
        F.date_format("o_orderdate", "yyyy-MM").alias("snapshot_id"), F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("symbol"), ms.alias("seq_ms"), F.col("o_orderkey").alias("seq"), X.exchange_status(status).alias("status"), status.alias("raw_status"),
        F.when(F.col("o_orderpriority") != "5-LOW", ms).alias("onboard_ms"), F.when(F.col("o_orderstatus") == "F", ms).alias("delivery_ms"), (F.col("o_orderpriority") == "1-URGENT").alias("unverified"), F.col("o_orderdate").alias("collected"),
    )


def by_month(rows: DataFrame, ts: str) -> DataFrame:
    """Rows with l_suppkey as objects of a supplier and month: keys are made of a group's first time, once a group and not once a row (nor can a filter on them move below the grouping)."""
    t = F.col(ts)
    g = rows.groupBy("l_suppkey", (F.year(t) * 12 + F.month(t)).alias("__month")).agg(F.count("*").alias("row_count"), F.min(t).alias("first"), F.max(t).alias("last"))
    keyed = g.select(F.concat(F.lit("S"), F.col("l_suppkey").cast("string"), F.lit("USDT")).alias("symbol"), F.date_format("first", "yyyy-MM").alias("period"), "row_count", "first", "last")
    return keyed.withColumn("path", X.candle_key(F.lit("futures-um"), F.lit("1h"), F.col("symbol"), F.col("period")))


def files(spark, d) -> DataFrame:
    g = by_month(table(spark, d, "lineitem").select("l_suppkey", "l_shipdate"), "l_shipdate")
    return g.select("symbol", "period", F.substring("period", 1, 4).alias("year"), F.substring("period", 6, 2).alias("month"), "path", (F.col("row_count") * 64).alias("length"), "row_count", X.epoch_ms(F.col("first")).alias("lo"), X.epoch_ms(F.col("last")).alias("hi"), F.sha2(F.concat("path", F.lit("#"), F.col("row_count").cast("string")), 256).alias("sha256"))


def base(spark, d) -> DataFrame:
    """Lifecycle base: the customers with order history, with a level by their nation."""
    k = F.col("c_custkey")
    ordered = table(spark, d, "orders").select(F.col("o_custkey").alias("c_custkey"))
    level = F.when(F.col("c_nationkey") % 4 == 0, "VERIFIED_EXCHANGE_DELISTING").when(F.col("c_nationkey") % 4 == 1, "LOCAL_DATA_FIRST_SEEN").when(F.col("c_nationkey") % 4 == 2, "CURRENT_ACTIVE_ONLY").otherwise("HISTORICAL_SNAPSHOT_EVIDENCE")
    return table(spark, d, "customer").join(ordered, "c_custkey", "left_semi").select(F.concat(F.lit("C"), k.cast("string")).alias("symbol"), F.when(k % 2 == 0, "ACTIVE").otherwise("UNKNOWN").alias("status"), F.when(k % 5 == 0, WINDOW[0] - 86_400_000).alias("listed_ms"), F.when(k % 7 == 0, WINDOW[0] + k % 11 * 86_400_000).alias("delisted_ms"), level.alias("evidence_level"), k.alias("position"))


def sources(spark, d) -> DataFrame:
    k = F.col("o_orderkey")
    return table(spark, d, "orders").select(F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("symbol"), F.when(F.col("o_orderpriority") == "1-URGENT", "UNKNOWN").otherwise("OFFICIAL").alias("trust"), F.when(k % 6 != 0, X.epoch_ms(F.col("o_orderdate"))).alias("observed_ms"), F.when(k % 4 != 0, F.sha2(k.cast("string"), 256)).alias("source_hash"), F.when(k % 3 == 0, "HISTORICAL_SNAPSHOT_EVIDENCE").otherwise("UNKNOWN").alias("evidence_level"), k.alias("source_id"))


def members(spark, d) -> DataFrame:
    """A universe is a chosen set of symbols, here the customers of one market segment; reconciliation holds it against all that trade."""
    c = table(spark, d, "customer").filter("c_mktsegment = 'BUILDING'")
    return c.select(F.concat(F.lit("C"), F.col("c_custkey").cast("string")).alias("symbol"), (F.lit(WINDOW[0]) + F.col("c_custkey") * 86_400_000).alias("first_seen"))


def universe(spark, d) -> DataFrame:
    return U.build_universe(members(spark, d), base(spark, d), *WINDOW)


# The same views for DuckDB.
SQL_CANDLES = f"""candles as (select upper(event_type) || 'USDT' as symbol, '1h' as interval, epoch_us(ts) // 1000 // {HOUR} * {HOUR} as open_time_ms,
 epoch_us(ts) // 1000 as ms, event_id, value, event_type, props from events)"""
SQL_OBS = """obs as (select 'C' || o_custkey as symbol, epoch_ms(o_orderdate) as event_ms, epoch_ms(l_shipdate) as available_ms, l_orderkey,
 l_linenumber, l_extendedprice as value from lineitem join orders on l_orderkey = o_orderkey)"""
SQL_SEEN = """seen as (select strftime(o_orderdate, '%Y-%m') as snapshot_id, 'C' || o_custkey as symbol, epoch_ms(o_orderdate) as seq_ms, o_orderkey as seq,
 case o_orderstatus when 'F' then 'DELIVERED' when 'O' then 'TRADING' else 'PRE_TRADING' end as status, case when o_orderpriority <> '5-LOW' then epoch_ms(o_orderdate) end as onboard_ms,
 case when o_orderstatus = 'F' then epoch_ms(o_orderdate) end as delivery_ms, o_orderpriority = '1-URGENT' as unverified, o_orderdate as collected,
 case o_orderstatus when 'F' then 'DELISTED' else 'ACTIVE' end as life from orders)"""
SQL_FILES = """g as (select 'S' || l_suppkey || 'USDT' as symbol, strftime(l_shipdate, '%Y-%m') as period, count(*) as row_count,
 min(epoch_ms(l_shipdate)) as lo, max(epoch_ms(l_shipdate)) as hi from lineitem group by 1, 2),
g2 as (select *, period[1:4] as year, period[6:7] as month,
 'candles/futures-um/1h/symbol=' || symbol || '/year=' || period[1:4] || '/month=' || period[6:7] || '/' || symbol || '-1h-' || period || '.parquet' as path
 from g),
files as (select *, row_count * 64 as length, sha256(path || '#' || row_count) as sha256 from g2)"""
SQL_BASE = f"""base as (select 'C' || c_custkey as symbol, case when c_custkey % 2 = 0 then 'ACTIVE' else 'UNKNOWN' end as status, case
 when c_custkey % 5 = 0 then {WINDOW[0] - 86_400_000} end as listed_ms,
 case when c_custkey % 7 = 0 then {WINDOW[0]} + c_custkey % 11 * 86400000 end as delisted_ms, case c_nationkey % 4
 when 0 then 'VERIFIED_EXCHANGE_DELISTING' when 1 then 'LOCAL_DATA_FIRST_SEEN'
 when 2 then 'CURRENT_ACTIVE_ONLY' else 'HISTORICAL_SNAPSHOT_EVIDENCE' end as evidence_level, c_custkey as position
 from customer where c_custkey in (select o_custkey from orders))"""
SQL_SOURCES = """sources as (select 'C' || o_custkey as symbol, case when o_orderpriority = '1-URGENT' then 'UNKNOWN' else 'OFFICIAL' end as trust,
 case when o_orderkey % 6 <> 0 then epoch_ms(o_orderdate) end as observed_ms,
 case when o_orderkey % 4 <> 0 then sha256(cast(o_orderkey as varchar)) end as source_hash, case
 when o_orderkey % 3 = 0 then 'HISTORICAL_SNAPSHOT_EVIDENCE' else 'UNKNOWN' end as evidence_level, o_orderkey as source_id from orders)"""
SQL_UNIVERSE = f"""{SQL_BASE}, members as (select 'C' || c_custkey as symbol, {WINDOW[0]} + c_custkey * 86400000 as first_seen from customer where c_mktsegment = 'BUILDING'),
universe as (select m.symbol, cast(null as varchar) as base_asset, cast(null as varchar) as quote_asset, first_seen, listed_ms, delisted_ms,
 not (coalesce(listed_ms > {WINDOW[1]}, false) or coalesce(delisted_ms < {WINDOW[0]}, false)) as active_during_window,
 greatest(coalesce(listed_ms, first_seen), {WINDOW[0]}) as available_from, least(coalesce(delisted_ms, {WINDOW[1]}), {WINDOW[1]}) as available_until,
 evidence_level, b.symbol is not null as in_lifecycle from members m left join base b on b.symbol = m.symbol)"""
SQL_AUDIT = f"""c as (select symbol, interval, open_time_ms as t, lag(open_time_ms, 1, null) over (partition by symbol, interval order by open_time_ms) as p from candles),
a as (select symbol, interval, count(*) as rows, (max(t) - min(t)) // {HOUR} + 1 as expected_rows, cast(coalesce(sum(case
 when t - p > {HOUR} then (t - p) // {HOUR} - 1 end), 0) as bigint) as missing_rows, count(*) filter (t = p) as duplicate_rows,
 count(*) filter (t - p > {HOUR}) as gap_count, coalesce(max(case when t - p > {HOUR} then (t - p - {HOUR}) // 1000 end), 0) as largest_gap_seconds,
 min(t) as min_time_ms, max(t) as max_time_ms from c group by 1, 2),
audit as (select *, least(rows - duplicate_rows, expected_rows) * 100.0 / expected_rows as coverage_pct, case when least(rows - duplicate_rows,
 expected_rows) * 100.0 / expected_rows < 99 then 'FAIL' when gap_count > 0 or duplicate_rows > 0 then 'WARN' else 'PASS' end as status,
 concat_ws(',', case when gap_count > 0 then 'DATASET_GAPS_DETECTED' end, case when duplicate_rows > 0 then 'DATASET_DUPLICATE_TIMESTAMPS' end, case
 when least(rows - duplicate_rows, expected_rows) * 100.0 / expected_rows < 99 then 'DATASET_COVERAGE_BELOW_THRESHOLD' end) as warnings from a)"""

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            ORACLE_SQL[name] = sql
        return f

    return add


def audit(spark, d):
    return S.gap_audit(candles(spark, d), ["symbol", "interval"], "open_time_ms", HOUR)


query("gap_audit", f"""with {SQL_CANDLES}, {SQL_AUDIT} select symbol, interval, rows, expected_rows, missing_rows, duplicate_rows, gap_count,
 largest_gap_seconds, cast(coverage_pct as double) as coverage_pct, min_time_ms, max_time_ms, status, warnings from audit""")(audit)

# Bounds off the hours' grid and within the data, so that the first and last slots are clamped.
CLAMP = (LO + 5 * 86_400_000 + 1_800_000, LO + 20 * 86_400_000 + 1_800_000)


@query("gap_audit_window", f"""with {SQL_CANDLES}, x as (select *, greatest(min(open_time_ms) over (partition by symbol, interval), {CLAMP[0]}) as lo,
 least(max(open_time_ms) over (partition by symbol, interval), {CLAMP[1]}) as hi, count(*) over (partition by symbol, interval) as n from candles),
d as (select *, open_time_ms - coalesce(lag(open_time_ms) over (partition by symbol, interval order by open_time_ms), lo - {HOUR}) as diff from x where open_time_ms between lo and hi),
a as (select symbol, interval, min(n) as rows, (min(hi) - min(lo)) // {HOUR} + 1 as expected_rows, cast(coalesce(sum(case
 when diff > {HOUR} then diff // {HOUR} - 1 end), 0) as bigint) as missing_rows, count(*) filter (diff = 0) as duplicate_rows,
 count(*) filter (diff > {HOUR}) as gap_count, coalesce(max(case when diff > {HOUR} then (diff - {HOUR}) // 1000 end), 0) as largest_gap_seconds,
 min(lo) as min_time_ms, min(hi) as max_time_ms from d group by 1, 2),
b as (select *, cast(least(rows - duplicate_rows, expected_rows) * 100.0 / expected_rows as double) as coverage_pct from a)
select *, case when coverage_pct < 99 then 'FAIL' when gap_count > 0 or duplicate_rows > 0 then 'WARN' else 'PASS' end as status, concat_ws(',', case
 when gap_count > 0 then 'DATASET_GAPS_DETECTED' end, case when duplicate_rows > 0 then 'DATASET_DUPLICATE_TIMESTAMPS' end, case
 when coverage_pct < 99 then 'DATASET_COVERAGE_BELOW_THRESHOLD' end) as warnings from b""")
def _(spark, d):
    return S.gap_audit(candles(spark, d), ["symbol", "interval"], "open_time_ms", HOUR, *CLAMP)



def odd_candles(spark, d) -> DataFrame:
    """Candles of which some name no symbol, some no interval, and some lie before every window; event_id is their arrival."""
    c, kind = candles(spark, d), F.col("event_type")
    early = F.when(kind == "signup", 60 * 86_400_000).otherwise(0)
    return c.select(F.when(kind == "error", "").otherwise(F.col("symbol")).alias("symbol"), F.when(kind != "view", F.col("interval")).alias("interval"), (F.col("open_time_ms") - early).alias("open_time_ms"), "event_id")


# The audit's rules over those, from bounds that clamp inwards: unresolved series count nothing, an empty window passes.
SQL_ODD = f"""with {SQL_CANDLES},
x as (select case when event_type = 'error' then '' else symbol end as symbol, case when event_type <> 'view' then interval end as interval,
  open_time_ms - case when event_type = 'signup' then {60 * 86_400_000} else 0 end as t, event_id from candles),
g as (select symbol, interval, count(*) as n, greatest(min(t), {CLAMP[0]}) as lo, least(max(t), {CLAMP[1]}) as hi from x group by 1, 2),
o as (select symbol, interval, count(*) filter (t < p) as back from (select *, lag(t) over (partition by symbol, interval order by event_id) as p from x) group by 1, 2),
w as (select x.symbol, x.interval, t, t - coalesce(lag(t) over (partition by x.symbol, x.interval order by t), lo - {HOUR}) as diff
  from x join g on g.symbol is not distinct from x.symbol and g.interval is not distinct from x.interval where t between lo and hi),
a as (select symbol, interval, count(*) filter (diff = 0) as dups, count(*) filter (diff > {HOUR}) as gaps, coalesce(max(case when diff > {HOUR} then (diff - {HOUR}) // 1000 end), 0) as widest,
  coalesce(sum(case when diff > {HOUR} then diff // {HOUR} - 1 end), 0) as missing from w group by 1, 2),
j as (select g.symbol, g.interval, n, lo, hi, back, coalesce(dups, 0) as dups, coalesce(gaps, 0) as gaps, coalesce(widest, 0) as widest, coalesce(missing, 0) as missing,
  case when lo <= hi then (hi - lo) // {HOUR} + 1 else 0 end as expected, coalesce(g.symbol, '') = '' as no_symbol, coalesce(g.interval, '') = '' as no_interval
  from g join o on o.symbol is not distinct from g.symbol and o.interval is not distinct from g.interval left join a on a.symbol is not distinct
 from g.symbol and a.interval is not distinct from g.interval),
p as (select *, no_symbol or no_interval as u, case when expected > 0 then least(n - dups, expected) * 100.0 / expected else 0 end as pct from j),
v as (select *, case when u then concat_ws(',', case when no_symbol then 'DATASET_SYMBOL_INFER_FAILED' end, case when no_interval then 'DATASET_INTERVAL_INFER_FAILED' end)
  when expected = 0 then case when back > 0 then 'DATASET_OUT_OF_ORDER_TIMESTAMPS' else '' end
  else concat_ws(',', case when gaps > 0 then 'DATASET_GAPS_DETECTED' end, case when dups > 0 then 'DATASET_DUPLICATE_TIMESTAMPS' end, case when back > 0 then 'DATASET_OUT_OF_ORDER_TIMESTAMPS' end,
    case when pct < 99 then 'DATASET_COVERAGE_BELOW_THRESHOLD' end) end as warnings from p)
select symbol, interval, case when u then 0 else n end as rows, case when u then 0 else expected end as expected_rows, cast(case when u then 0 else missing end as bigint) as missing_rows,
  case when u then 0 else dups end as duplicate_rows, case when u then 0 else back end as out_of_order_rows, case
 when u then 0 else gaps end as gap_count, case when u then 0 else widest end as largest_gap_seconds,
  cast(case when u then 0 else pct end as double) as coverage_pct, case when not u then lo end as min_time_ms, case when not u then hi end as max_time_ms,
  case when u then 'UNKNOWN' when expected > 0 and pct < 99 then 'FAIL' when warnings <> '' then 'WARN' else 'PASS' end as status, warnings from v"""


@query("gap_audit_strict", SQL_ODD)
def _(spark, d):
    step = X.interval_ms(F.col("interval"))
    return S.gap_audit(odd_candles(spark, d), ["symbol", "interval"], "open_time_ms", step, *CLAMP, order=["event_id"], arrival=F.floor(F.col("event_id") / ARRIVALS))


@query("gap_audit_total", f"""with {SQL_CANDLES}, {SQL_AUDIT} select count(*) as series, cast(sum(rows) as bigint) as rows,
 cast(sum(expected_rows) as bigint) as expected_rows, cast(sum(missing_rows) as bigint) as missing_rows,
 cast(sum(duplicate_rows) as bigint) as duplicate_rows, cast(sum(gap_count) as bigint) as gap_count, max(largest_gap_seconds) as largest_gap_seconds,
 case max(case status when 'FAIL' then 3 when 'WARN' then 2 else 0 end) when 3 then 'FAIL' when 2 then 'WARN' else 'PASS' end as status from audit""")
def _(spark, d):
    return S.gap_audit_total(audit(spark, d))


def coverage(spark, d):
    return S.range_coverage(candles(spark, d), ["symbol", "interval"], "open_time_ms", HOUR, LO, HI)


SQL_COVER = f"""grid as (select s.symbol, s.interval, u.t from (select distinct symbol, interval from candles) s, (select unnest(range({LO}, {HI} + 1, {HOUR})) as t) u),
miss as (select g.symbol, g.interval, count(*) filter (c.symbol is null) as missing_rows, count(*) as expected_rows, min(case
 when c.symbol is null then t end) as first_missing_ms, max(case when c.symbol is null then t end) as last_missing_ms from grid g left
 join (select distinct symbol, open_time_ms from candles) c on c.symbol = g.symbol and c.open_time_ms = g.t group by 1, 2),
act as (select symbol, count(*) as actual_rows, count(*) - count(distinct open_time_ms) as duplicate_rows from candles where open_time_ms between {LO} and {HI} group by 1),
cover as (select m.symbol, m.interval, expected_rows, coalesce(actual_rows, 0) as actual_rows, coalesce(duplicate_rows, 0) as duplicate_rows,
 missing_rows, first_missing_ms, last_missing_ms, case when missing_rows > 0 or coalesce(duplicate_rows,
 0) > 0 or actual_rows is null then 'FAIL' else 'PASS' end as status from miss m left join act a on a.symbol = m.symbol)"""
query("range_coverage", f"with {SQL_CANDLES}, {SQL_COVER} select * from cover")(coverage)


@query("usability_report", f"with {SQL_CANDLES}, {SQL_COVER} select *, missing_rows = 0 as usable from cover")
def _(spark, d):
    return S.usability(coverage(spark, d))


@query("out_of_order", """with x as (select 'C' || o_custkey as symbol, o_orderdate < lag(o_orderdate) over (partition by o_custkey
 order by o_orderkey) as back from orders) select symbol, count(*) as rows, count(*) filter (back) as out_of_order_rows, case when
 count(*) filter (back) > 0 then 'DATASET_OUT_OF_ORDER_TIMESTAMPS' else '' end as warnings from x group by 1""")
def _(spark, d):
    return S.out_of_order(seen(spark, d), ["symbol"], "seq_ms", ["seq"], F.floor(F.col("seq") / ARRIVALS))


@query("interval_math", f"""with {SQL_CANDLES}, t as (select unnest(['1m','3m','5m','15m','1h','4h','1d','2m','1w','x']) as token,
 unnest([60000,180000,300000,900000,3600000,14400000,86400000,120000,604800000,null]) as ms), r as (select min(open_time_ms) as lo,
 max(open_time_ms) as hi from candles) select token, ms as interval_ms, case when token not in ('2m', '1w', 'x') then ms end as range_ms,
 (hi - lo) // ms + 1 as expected_rows from t, r""")
def _(spark, d):
    span = candles(spark, d).agg(F.min("open_time_ms").alias("lo"), F.max("open_time_ms").alias("hi"))
    t = span.withColumn("token", F.explode(F.array(*[F.lit(x) for x in ("1m", "3m", "5m", "15m", "1h", "4h", "1d", "2m", "1w", "x")])))
    ms = X.interval_ms(F.col("token"))
    return t.select("token", ms.alias("interval_ms"), X.range_interval_ms(F.col("token")).alias("range_ms"), X.expected_rows(F.col("lo"), F.col("hi"), ms).cast("bigint").alias("expected_rows"))


@query("dataset_verify", f"""with {SQL_OBS}, x as (select *, lag(event_ms) over (partition by symbol order by event_ms) as p from obs),
 y as (select symbol, count(*) as rows, count(*) filter (event_ms <= p) as sort_errors,
 count(*) filter (available_ms < event_ms) as availability_errors,
 count(*) filter (event_ms between {WINDOW[0]} and {WINDOW[1]} + 86400000) as rows_in_range from x group by 1)
select *, case when sort_errors > 0 then 'UNSORTED_OR_DUPLICATE' when availability_errors > 0 then 'AVAILABILITY' when rows_in_range = 0 then 'NONE_IN_RANGE' else 'PASS' end as verdict from y""")
def _(spark, d):
    return S.dataset_verify(obs(spark, d), ["symbol"], "event_ms", "available_ms", *WINDOW)


@query("availability_violations", f"with {SQL_OBS} select symbol, l_orderkey, l_linenumber, event_ms, available_ms from obs where available_ms < event_ms")
def _(spark, d):
    return S.availability_violations(obs(spark, d), "event_ms", "available_ms").select("symbol", "l_orderkey", "l_linenumber", "event_ms", "available_ms")


@query("availability_lag", f"with {SQL_OBS} select cast(floor((available_ms - event_ms) / 86400000) as bigint) as lag_days, count(*) as rows from obs group by 1")
def _(spark, d):
    return S.availability_lag(obs(spark, d), "event_ms", "available_ms")


@query("object_stats", f"""with {SQL_OBS} select symbol, count(*) as row_count, min(event_ms) as min_event_ms, max(event_ms) as max_event_ms,
 min(available_ms) as min_available_ms, max(available_ms) as max_available_ms from obs group by 1""")
def _(spark, d):
    return S.object_stats(obs(spark, d), ["symbol"], ["event_ms", "available_ms"])


@query("object_manifest", f"""with {SQL_FILES} select symbol, count(*) as objects, cast(sum(row_count) as bigint) as row_count,
 min(lo) as coverage_start_ms, max(hi) as coverage_end_ms, string_agg(path, ',' order by path) as object_keys, 'PASS' as status from files
 group by 1""")
def _(spark, d):
    return S.publishable(S.object_manifest(files(spark, d), ["symbol"], "path", "lo", "hi"))


@query("month_partition", f"""with {SQL_CANDLES} select symbol, strftime(make_timestamp(ms * 1000), '%Y') as year, strftime(make_timestamp(ms * 1000),
 '%m') as month, count(*) as rows, min(ms) as lo, max(ms) as hi from candles group by all""")
def _(spark, d):
    return S.month_partitions(candles(spark, d), ["symbol"], "ms").groupBy("symbol", "year", "month").agg(F.count("*").alias("rows"), F.min("ms").alias("lo"), F.max("ms").alias("hi"))


@query("sentiment_normalize", f"""with {SQL_CANDLES}, x as (select *, row_number() over (partition by symbol, open_time_ms order by event_id) as k
 from candles where open_time_ms between {LO} and {HI}) select symbol, open_time_ms as event_time_ms, open_time_ms + 86400000 as available_at_ms,
 value as score, replace(lower(trim(event_type)), ' ', '_') as label, abs(value - 50) / 50 as intensity from x
 where k = 1 and value between 0 and 100""")
def _(spark, d):
    return S.normalize_sentiment(candles(spark, d), ["symbol"], "open_time_ms", ["event_id"], F.col("value"), F.col("event_type"), LO, HI)


@query("sentiment_validate", f"""with {SQL_CANDLES}, x as (select *, row_number() over (partition by symbol order by event_id) - 1 as r,
 lag(open_time_ms) over (partition by symbol order by event_id) as p, row_number() over (partition by symbol, open_time_ms order by event_id) as k
 from candles),
y as (select *, case when trim(coalesce(event_type, '')) = '' then 'missing event_type' when open_time_ms <= 0 then 'event_time_ms <= 0'
 when k > 1 then 'duplicate event_time_ms' when open_time_ms < p then 'event_time_ms out of order'
 when not value between 0 and 100 then 'score outside 0..100' when not abs(value - 50) / 50 between 0 and 1 then 'intensity outside 0..1' end as rule
 from x)
select symbol, count(*) as rows, count(rule) as bad_rows, min(case when rule is not null then r end) as first_bad_row, arg_min(rule, r) filter (rule is not null) as first_rule from y group by 1""")
def _(spark, d):
    rows = candles(spark, d).withColumn("available_ms", F.col("open_time_ms"))
    return S.validate_rows(rows, ["symbol"], ["event_id"], "open_time_ms", "available_ms", ["event_type"], S.sentiment_bounds(F.col("value"), X.intensity(F.col("value"))), F.floor(F.col("event_id") / ARRIVALS))


@query("derivatives_validate", f"""with {SQL_OBS}, x as (select *, row_number() over (partition by symbol order by l_orderkey, l_linenumber,
 available_ms, value) - 1 as r, lag(event_ms) over (partition by symbol order by l_orderkey, l_linenumber, available_ms, value) as p,
 row_number() over (partition by symbol, event_ms order by l_orderkey, l_linenumber, available_ms, value) as k from obs),
y as (select *, case when value is null then 'missing value' when event_ms <= 0 then 'event_time_ms <= 0'
 when available_ms <= 0 then 'available_at_ms <= 0' when available_ms < event_ms then 'available_at_ms < event_time_ms'
 when k > 1 then 'duplicate event_time_ms' when event_ms < p then 'event_time_ms out of order' end as rule from x)
select symbol, count(*) as rows, count(rule) as bad_rows, min(case when rule is not null then r end) as first_bad_row, arg_min(rule, r) filter (rule is not null) as first_rule from y group by 1""")
def _(spark, d):
    return S.validate_rows(obs(spark, d), ["symbol"], ["l_orderkey", "l_linenumber", "available_ms", "value"], "event_ms", "available_ms", ["value"], part=F.floor(F.col("l_orderkey") / ARRIVALS))


@query("key_range_overlap", f"with {SQL_FILES} select path from files where period >= '1995-03' and period <= '1996-02'")
def _(spark, d):
    return files(spark, d).select("path").filter(X.overlaps(F.col("path"), F.lit("1995-03-15").cast("date"), F.lit("1996-02-10").cast("date")))


@query("path_infer", f"with {SQL_FILES} select symbol as path_symbol, '1h' as path_interval, 'futures' as market, symbol || '-1h-' || period || '.parquet' as name, period from files")
def _(spark, d):
    p = F.col("path")
    return files(spark, d).select(X.path_symbol(p).alias("path_symbol"), X.path_interval(p).alias("path_interval"), X.path_market(p).alias("market"), X.basename(p).alias("name"), X.key_period(p).alias("period"))


def plan(spark, d):
    have = files(spark, d)
    return P.ingest_plan(have, P.expand_periods(spark, "1994-01-01", "1997-12-01", "month"), have.filter("row_count > 2"), "futures-um", "1h")


SQL_PLAN = f"""{SQL_FILES}, p as (select strftime(unnest(generate_series(date '1994-01-01', date '1997-12-01', interval 1 month)),
 '%Y-%m') as period), plan as (select 'candles/futures-um/1h/symbol=' || s.symbol || '/year=' || p.period[1:4] || '/month=' || p.period[6:7] || '/' || s.symbol || '-1h-' || p.period || '.parquet' as key,
 s.symbol, p.period, case when f.path is null then 'FETCH' else 'SKIP_EXISTING' end as state from (select distinct symbol from files) s cross join p
 left join files f on f.symbol = s.symbol and f.period = p.period and f.row_count > 2)"""
query("ingest_plan", f"with {SQL_PLAN} select * from plan")(plan)


@query("ingest_plan_summary", f"""with {SQL_PLAN} select count(*) as objects, count(*) filter (state = 'FETCH') as to_fetch,
 count(*) filter (state = 'SKIP_EXISTING') as skipped, 'INCOMPLETE' as label from plan""")
def _(spark, d):
    return P.plan_summary(plan(spark, d))


@query("listing_payload", f"""with {SQL_CANDLES} select symbol, upper(event_type) as base_asset, 'USDT' as quote_asset, 'UNKNOWN' as status,
 upper(event_type) as raw_status, strftime(make_timestamp(ms // 1000 * 1000000), '%Y-%m-%dT%H:%M:%SZ') as onboard_at,
 cast(null as varchar) as delivery_at, case when event_type < 'm' then 'MARGIN,SPOT' else 'SPOT' end as permissions,
 'symbol,status,onboardDate' as source_fields, event_id, cast(json_extract(props, '$.k') as bigint) as k from candles""")
def _(spark, d):
    granted = F.when(F.col("event_type") < "m", F.array(F.lit("SPOT"), F.lit("MARGIN"))).otherwise(F.array(F.lit("SPOT")))
    raw = candles(spark, d).select(F.lower("symbol").alias("symbol"), F.col("event_type").alias("status"), F.col("ms").alias("onboard_ms"), F.lit(0).cast("bigint").alias("delivery_ms"), granted.alias("permissions"), "event_id", F.from_json("props", "k bigint")["k"].alias("k"))
    return G.listing_symbols(raw, "usdt")


@query("listing_findings", f"""with {SQL_SEEN}, x as (select *, row_number() over (partition by snapshot_id, symbol order by status) as k from seen), r as (
 select snapshot_id || '/' || symbol as target, 'EXCHANGE_META_DUPLICATE_SYMBOL' as code, 'FAIL' as severity from x where k > 1 union all
 select snapshot_id || '/' || symbol, 'EXCHANGE_META_SYMBOL_MALFORMED', 'FAIL' from x where length(symbol) < 3
 union all select snapshot_id || '/' || symbol, 'EXCHANGE_META_ONBOARD_DATE_MISSING', 'WARN' from x where onboard_ms is null union all
 select snapshot_id || '/' || symbol, 'EXCHANGE_META_DELIVERY_DATE_MISSING', 'WARN' from x where delivery_ms is null) select * from r""")
def _(spark, d):
    rows = seen(spark, d).withColumns({"onboard_at": X.rfc3339(F.col("onboard_ms")), "delivery_at": X.rfc3339(F.col("delivery_ms"))})
    return G.listing_findings(rows, ["snapshot_id"])


@query("snapshot_findings", f"""with {SQL_SEEN}, s as (select snapshot_id, count(distinct symbol) as symbols, bool_or(unverified) as u,
 snapshot_id[6:7] as m from seen group by 1), r as (select snapshot_id as target, 'EXCHANGE_META_RAW_PAYLOAD_MISSING' as code, 'WARN' as severity
 from s where m = '02'
 union all select snapshot_id, 'EXCHANGE_META_SOURCE_TIME_UNKNOWN', 'WARN' from s where m = '12' union all select snapshot_id,
 'EXCHANGE_META_CURRENT_ONLY_SOURCE', 'WARN' from s where u) select * from r""")
def _(spark, d):
    month = F.substring("snapshot_id", 6, 2)
    s = seen(spark, d).groupBy("snapshot_id").agg(F.countDistinct("symbol").alias("symbols"), F.bool_or("unverified").alias("u"), F.max("seq_ms").alias("seq_ms"))
    return G.snapshot_findings(s.select("snapshot_id", "symbols", F.when(month != "02", F.sha2("snapshot_id", 256)).otherwise("UNKNOWN").alias("raw_sha256"), F.when(month != "12", X.rfc3339(F.col("seq_ms"))).alias("observed"), F.when(F.col("u"), "public_endpoint_current").otherwise("archive").alias("source_type")))


@query("symbol_rules", """select c_custkey, regexp_matches(c_name, '^[A-Z0-9]{3,30}$') as name_ok, regexp_matches(replace(upper(c_name), '#', ''),
 '^[A-Z0-9]{3,40}$') as listing_ok, regexp_matches(replace(upper(c_name), '#', '_'), '^[A-Z0-9_]+$') as series_ok,
 length(trim(c_name)) > 0 and not contains(c_name, '..') and not contains(c_name, '/') and not contains(c_name, '\\') as safe from customer""")
def _(spark, d):
    name, up = F.col("c_name"), F.upper("c_name")
    return table(spark, d, "customer").select("c_custkey", X.market_symbol(name).alias("name_ok"), X.snapshot_symbol(F.replace(up, F.lit("#"), F.lit(""))).alias("listing_ok"), X.series_symbol(F.replace(up, F.lit("#"), F.lit("_"))).alias("series_ok"), X.safe_identifier(name).alias("safe"))


@query("asset_infer", """with x as (select p_partkey, 'P' || p_partkey || case p_partkey % 6 when 0 then 'USDT' when 1 then 'USDC' when 2 then 'USD'
 when 3 then 'BTC' when 4 then 'ETH' else '' end as symbol, case p_partkey % 6 when 0 then 'USDT' when 1 then 'USDC' when 2 then 'USD'
 when 3 then 'BTC' when 4 then 'ETH' end as quote_asset from part) select *, case when quote_asset is not null then 'P' || p_partkey end as base_asset
 from x""")
def _(spark, d):
    k = F.col("p_partkey")
    q = F.element_at(F.array(*[F.lit(x) for x in (*X.QUOTES, "")]), (k % 6 + 1).cast("int"))
    s = table(spark, d, "part").select("p_partkey", F.concat(F.lit("P"), k.cast("string"), q).alias("symbol"))
    return s.select("p_partkey", "symbol", X.quote_asset(F.col("symbol")).alias("quote_asset"), X.base_asset(F.col("symbol")).alias("base_asset"))


@query("status_map", f"with {SQL_SEEN} select status, life, count(*) as rows from seen group by 1, 2")
def _(spark, d):
    return seen(spark, d).groupBy("status", X.lifecycle_status(F.col("status")).alias("life")).agg(F.count("*").alias("rows"))


@query("timestamp_normalize", """select event_id, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') as from_ms, strftime(ts - interval 2 hour,
 '%Y-%m-%dT%H:%M:%SZ') as from_text, cast(null as varchar) as from_unknown, event_type as from_malformed, true as malformed from events""")
def _(spark, d):
    # The day and clock of ts are written without the session's zone.
    ms = X.epoch_ms(F.col("ts"))
    text = F.concat(F.replace(X.rfc3339(ms), F.lit("Z"), F.lit("")), F.lit("+02:00"))
    return table(spark, d, "events").select("event_id", X.rfc3339(ms).alias("from_ms"), X.normalized_time(text).alias("from_text"), X.normalized_time(F.lit(" unknown ")).alias("from_unknown"), X.normalized_time(F.col("event_type")).alias("from_malformed"), X.malformed_time(F.col("event_type")).alias("malformed"))


@query("object_keys", f"""with {SQL_FILES} select path,
 'datasets/sentiment/source=s/dataset=index/scope=' || symbol || '/interval=1h/year=' || year || '/month=' || month || '/index-' || period || '.parquet' as sentiment,
 'datasets/derivatives/source=s/dataset=rate/market=futures-um/symbol=' || symbol || '/interval=8h/year=' || year || '/month=' || month || '/' || symbol || '-rate-' || period || '.parquet' as derivatives,
 'manifests/futures-um/1h/symbol=' || symbol || '/manifest.json' as candle_manifest,
 'manifests/datasets/sentiment/s/index/scope=' || symbol || '/manifest.json' as sentiment_manifest,
 'manifests/datasets/derivatives/s/rate/market=futures-um/symbol=' || symbol || '/interval=8h/manifest.json' as derivatives_manifest,
 'x_futures_um_' || year || month || '01_000000_' || sha256[1:12] as snapshot_id, cast(null as varchar) as unsafe, symbol as audit_symbol,
 '1h' as audit_interval, symbol as folder_symbol, '1h' as folder_interval, symbol as lifecycle_symbol from files""")
def _(spark, d):
    s, lit = F.col("symbol"), F.lit
    p, path = F.col("period"), F.col("path")
    collected = F.concat(p, lit("-01T00:00:00Z"))
    return files(spark, d).select(
        "path", X.sentiment_key(lit("s"), lit("index"), s, lit("1h"), p).alias("sentiment"), X.derivatives_key(lit("s"), lit("rate"), lit("futures-um"), s, lit("8h"), p).alias("derivatives"),
        X.candle_manifest_key(lit("futures-um"), lit("1h"), s).alias("candle_manifest"), X.sentiment_manifest_key(lit("s"), lit("index"), s).alias("sentiment_manifest"), X.derivatives_manifest_key(lit("s"), lit("rate"), lit("futures-um"), s, lit("8h")).alias("derivatives_manifest"),
        X.snapshot_id(lit("X"), lit("futures_um"), collected, F.col("sha256")).alias("snapshot_id"), X.sentiment_key(lit("s"), lit("../x"), s, lit("1h"), p).alias("unsafe"),
        X.audit_symbol(path).alias("audit_symbol"), X.audit_interval(path).alias("audit_interval"), X.folder_symbol(path).alias("folder_symbol"), X.folder_interval(path).alias("folder_interval"), X.lifecycle_symbol(path).alias("lifecycle_symbol"),
    )


@query("symbol_evidence", f"""with {SQL_SEEN} select symbol, min(collected) as first_seen, max(collected) as last_seen,
 count(distinct snapshot_id) as times_seen, string_agg(distinct status, ',' order by status) as statuses, bool_or(coalesce(onboard_ms > 0,
 false)) as has_onboard, bool_or(coalesce(delivery_ms > 0, false)) as has_delivery from seen group by 1""")
def _(spark, d):
    return G.symbol_evidence(seen(spark, d))


def snapshots(spark, d):
    s = seen(spark, d).groupBy("snapshot_id").agg(F.max("seq_ms").alias("observed"), F.countDistinct("symbol").alias("symbols"), F.bool_or("unverified").alias("u"))
    month = F.substring("snapshot_id", 6, 2).cast("int")
    return s.select("snapshot_id", F.when(month % 3 == 0, "UNKNOWN").when(month % 3 == 1, "OFFICIAL").alias("trust"), F.when(month != 12, F.col("observed")).alias("observed"), "symbols")


@query("archive_summary", f"""with {SQL_SEEN}, s as (select snapshot_id, case cast(snapshot_id[6:7] as int) % 3 when 0 then 'UNKNOWN'
 when 1 then 'OFFICIAL' else '' end as trust, case when snapshot_id[6:7] <> '12' then max(seq_ms) end as observed from seen group by 1),
 h as (select trust, count(*) as n from s group by 1)
select (select count(*) from s) as snapshots, (select string_agg(trust || '=' || n, ',' order by trust || '=' || n) from h) as trust_levels,
 count(*) filter (trust = 'OFFICIAL') as official, count(*) filter (trust <> 'OFFICIAL') as unverified,
 count(*) filter (observed is null) as missing_time, min(observed) as earliest, max(observed) as latest, 'PASS' as status from s""")
def _(spark, d):
    return G.archive_summary(snapshots(spark, d))


@query("evidence_histogram", f"""with {SQL_BASE}, h as (select evidence_level, count(*) as n from base group by 1) select
 cast(sum(n) as bigint) as symbols, string_agg(evidence_level || '=' || n, ',' order by evidence_level || '=' || n) as levels from h""")
def _(spark, d):
    return U.evidence_histogram(base(spark, d))


@query("snapshot_dedupe", """with x as (select doc_id, sha256(text) as hash, row_number() over (partition by text order by doc_id) as k
 from documents) select doc_id, hash, case when hash is null then 'SKIPPED' when k > 1 or hash in (select sha256(text) from documents
 where doc_id in (select doc_id from labels) and text is not null) then 'DUPLICATE' else 'IMPORTED' end as outcome from x""")
def _(spark, d):
    docs = table(spark, d, "documents").select("doc_id", F.sha2("text", 256).alias("hash"))
    return G.intake(docs, docs.join(table(spark, d, "labels").select("doc_id"), "doc_id", "left_semi").select("hash"), order="doc_id")


@query("snapshot_dedupe_ties", """with x as (select sha256(text) as hash, count(*) as n, bool_or(doc_id in (select doc_id from labels)) as archived from documents group by 1)
select hash, 'IMPORTED' as outcome, 1::bigint as inputs from x where hash is not null and not archived
union all select hash, 'DUPLICATE', n - case when archived then 0 else 1 end from x where hash is not null and (archived or n > 1)
union all select hash, 'SKIPPED', n from x where hash is null""")
def _(spark, d):
    """Inputs that arrive together have the same place in the order: still one of each hash is imported."""
    docs = table(spark, d, "documents").select("doc_id", F.sha2("text", 256).alias("hash"), F.lit(1).alias("arrival"))
    archive = docs.join(table(spark, d, "labels").select("doc_id"), "doc_id", "left_semi").select("hash")
    return G.intake(docs, archive, order="arrival").groupBy("hash", "outcome").agg(F.count("*").alias("inputs"))


@query("backfill_findings", """with x as (select doc_id, source, sha256(text) as hash, row_number() over (partition by text order by doc_id) as k
 from documents), o as (select *, case when hash is null then 'SKIPPED' when k > 1 or hash in (select sha256(text) from documents
 where doc_id in (select doc_id from labels) and text is not null) then 'DUPLICATE' else 'IMPORTED' end as outcome from x)
select cast(doc_id as varchar) as target, 'EXCHANGE_BACKFILL_INPUT_PARSE_FAILED' as code, 'WARN' as severity from o where outcome = 'SKIPPED'
 union all select cast(doc_id as varchar), 'EXCHANGE_BACKFILL_OBSERVED_TIME_MISSING', 'WARN' from o where outcome <> 'SKIPPED' and source is null
 union all select cast(doc_id as varchar), 'EXCHANGE_BACKFILL_DUPLICATE_SNAPSHOT', 'WARN' from o where outcome = 'DUPLICATE' union all select '',
 'EXCHANGE_BACKFILL_USER_PROVIDED_UNVERIFIED', 'WARN'""")
def _(spark, d):
    docs = table(spark, d, "documents").select("doc_id", F.sha2("text", 256).alias("hash"), F.col("source").alias("observed"))
    return G.backfill_report(docs, docs.join(table(spark, d, "labels").select("doc_id"), "doc_id", "left_semi"), None, order="doc_id")[1]


@query("archive_integrity", f"""with {SQL_SEEN}, s as (select snapshot_id, count(distinct symbol) as symbols, count(*) as n, bool_or(unverified) as u
 from seen group by 1), raw as (select distinct strftime(l_shipdate, '%Y-%m') as m from lineitem), r as (
 select snapshot_id as target, 'EXCHANGE_ARCHIVE_HASH_MISMATCH' as code, 'FAIL' as severity from s where n <> symbols union all select snapshot_id,
 'EXCHANGE_ARCHIVE_RAW_PAYLOAD_MISSING', 'WARN' from s where snapshot_id not in (select m from raw) union all select snapshot_id,
 'EXCHANGE_ARCHIVE_CURRENT_ONLY_EVIDENCE', 'WARN' from s where u
 union all select 'manifest', 'EXCHANGE_ARCHIVE_MANIFEST_STALE', 'FAIL' where (select count(*) from s) <> (select count(*) from raw)) select * from r""")
def _(spark, d):
    each = seen(spark, d).groupBy("snapshot_id").agg(F.countDistinct("symbol").alias("symbols"), F.count("*").alias("n"), F.bool_or("unverified").alias("u"))
    h = lambda c: F.sha2(F.concat_ws(":", "snapshot_id", c), 256)
    snaps = each.select("snapshot_id", h("symbols").alias("snapshot_hash"), h("n").alias("computed_hash"), F.sha2("snapshot_id", 256).alias("raw_sha256"), "symbols", F.when(F.col("u"), "public_endpoint_current").otherwise("archive").alias("source_type"))
    months = table(spark, d, "lineitem").select(F.sha2(F.date_format("l_shipdate", "yyyy-MM"), 256).alias("name_hash")).distinct().withColumn("sha256", F.col("name_hash"))
    return G.archive_integrity(snaps, months, months.agg(F.count("*").alias("snapshot_count"), F.lit(True).alias("sound")))


@query("snapshot_conflicts", f"""with {SQL_SEEN}, x as (select snapshot_id || '/' || symbol as snapshot_id, sha256(status) as hash from seen)
 select snapshot_id, count(*) as entries, count(distinct hash) as hashes, case when
 count(distinct hash) > 1 then 'CONFLICTING_HASHES' else 'DUPLICATE_SNAPSHOT' end as code from x group by 1 having count(*) > 1""")
def _(spark, d):
    rows = seen(spark, d).select(F.concat_ws("/", "snapshot_id", "symbol").alias("snapshot_id"), F.sha2("status", 256).alias("hash"))
    return G.snapshot_conflicts(rows)


@query("latest_snapshot", "select 'C' || o_custkey as symbol, o_orderkey as seq from orders where strftime(o_orderdate, '%Y-%m') = (select max(strftime(o_orderdate, '%Y-%m')) from orders)")
def _(spark, d):
    return G.latest(seen(spark, d), collected="snapshot_id").select("symbol", "seq")


@query("disappeared_symbols", f"""with {SQL_SEEN}, q as (select *, cast(snapshot_id[1:4] as bigint) * 12 + cast(snapshot_id[6:7] as bigint) as r
 from seen) select symbol, max(r) as last_seq from q group by 1 having max(r) < (select max(r) from q) and not bool_or(life = 'DELISTED')""")
def _(spark, d):
    month = F.substring("snapshot_id", 1, 4).cast("bigint") * 12 + F.substring("snapshot_id", 6, 2).cast("bigint")
    return L.disappeared(seen(spark, d).withColumn("seq", month))


def merged(spark, d):
    return L.merge_snapshots(base(spark, d), seen(spark, d))


SQL_MERGED = f"""{SQL_SEEN}, {SQL_BASE}, w as (select *, max(life = 'DELISTED') over (partition by symbol order by seq) as ended from seen),
 e as (select symbol, max(case when life = 'DELISTED' then life end) as s_terminal, arg_min(life, seq) as s_known, arg_min(onboard_ms,
 seq) filter (onboard_ms is not null) as s_onboard,
 arg_min(delivery_ms, seq) filter (ended and delivery_ms is not null) as s_delivery, arg_max(unverified, seq) as s_unverified, min(seq) as first_seq,
 max(seq) as last_seq, count(*) as snapshots from w group by 1),
merged as (select coalesce(b.symbol, e.symbol) as symbol, coalesce(s_terminal, nullif(status, 'UNKNOWN'), s_known, 'UNKNOWN') as status,
 coalesce(listed_ms, s_onboard) as listed_ms, coalesce(delisted_ms, s_delivery) as delisted_ms, first_seq, last_seq, coalesce(snapshots,
 0) as snapshots,
 case when snapshots is null then evidence_level when s_unverified then 'USER_PROVIDED_UNVERIFIED'
 when evidence_level like 'VERIFIED%' then evidence_level else 'HISTORICAL_SNAPSHOT_EVIDENCE' end as evidence_level from base b full
 join e on b.symbol = e.symbol)"""
query("lifecycle_from_snapshots", f"with {SQL_MERGED} select * from merged")(merged)


@query("lifecycle_from_data", f"""with {SQL_CANDLES} select symbol, min(open_time_ms) as first_seen, max(open_time_ms) as last_seen, '1h' as interval,
 'futures' as market, count(*) as rows, 'LOCAL_DATA_FIRST_SEEN' as evidence_level from candles group by 1""")
def _(spark, d):
    return L.lifecycle_from_data(candles(spark, d).withColumn("market", F.lit("futures")), "open_time_ms")


SQL_SUPPORT = """support as (select count(*) as symbols, case when count(*) = 0 then 'MISSING'
 when bool_and(listed_ms is not null and lv in ('VERIFIED_EXCHANGE_LISTING', 'VERIFIED_EXCHANGE_DELISTING',
 'HISTORICAL_SNAPSHOT_EVIDENCE')) then 'VERIFIED' when bool_or(lv = 'LOCAL_DATA_FIRST_SEEN') then 'FIRST_SEEN_ONLY'
 when bool_or(lv = 'CURRENT_ACTIVE_ONLY') then 'CURRENT_ACTIVE_ONLY'
 when bool_or(lv = 'USER_PROVIDED_UNVERIFIED') then 'USER_PROVIDED_UNVERIFIED' else 'MISSING' end as listing,
 case when bool_and(delisted_ms is not null and lv in ('VERIFIED_EXCHANGE_DELISTING',
 'HISTORICAL_SNAPSHOT_EVIDENCE')) then 'VERIFIED' else 'MISSING' end as delisting, case when count(*) = 0 then 'UNKNOWN'
 when bool_and(listed_ms is not null and delisted_ms is not null and lv in ('VERIFIED_EXCHANGE_DELISTING', 'HISTORICAL_SNAPSHOT_EVIDENCE') and
 coalesce(hashed, true)) then 'LOW_SUPPORTED' else 'ELEVATED' end as survivorship
 from (select m.*, coalesce(m.evidence_level, 'UNKNOWN') as lv, hashed from {t} m left join (select symbol as hs,
 bool_and(source_hash is not null) as hashed from sources group by 1) on hs = m.symbol))"""


@query("lifecycle_findings", f"""with {SQL_MERGED}, {SQL_SOURCES}, {SQL_SUPPORT.format(t="merged")}, r as (select symbol as target,
 'LIFECYCLE_SYMBOL_MALFORMED' as code, 'FAIL' as severity from merged where not regexp_matches(symbol, '^[A-Z0-9]{{3,30}}$') union all select symbol,
 'LIFECYCLE_LISTED_AFTER_DELISTED', 'FAIL' from merged where listed_ms > delisted_ms
 union all select symbol, 'LIFECYCLE_STATUS_UNKNOWN', 'WARN' from merged where status = 'UNKNOWN' union all select symbol,
 'LIFECYCLE_LISTED_DATE_MISSING', 'WARN' from merged where listed_ms is null union all select symbol, 'LIFECYCLE_DELISTED_DATE_MISSING', 'WARN'
 from merged where delisted_ms is null
 union all select symbol, 'LIFECYCLE_EVIDENCE_MISSING', 'WARN' from merged where coalesce(evidence_level, 'UNKNOWN') = 'UNKNOWN' or symbol not in (select symbol from sources)
 union all select symbol, 'LIFECYCLE_LOCAL_DATA_ONLY_NOT_LISTING_PROOF', 'WARN' from merged where evidence_level = 'LOCAL_DATA_FIRST_SEEN' union all
 select symbol, 'LIFECYCLE_CURRENT_ACTIVE_ONLY_RISK', 'WARN' from merged where evidence_level = 'CURRENT_ACTIVE_ONLY' union all select symbol,
 'LIFECYCLE_USER_PROVIDED_UNVERIFIED', 'WARN' from merged where evidence_level = 'USER_PROVIDED_UNVERIFIED'
 union all select symbol, 'LIFECYCLE_LISTED_DATE_MISSING', 'FAIL' from merged where evidence_level = 'VERIFIED_EXCHANGE_LISTING' and listed_ms is null
 union all select symbol, 'LIFECYCLE_DELISTED_DATE_MISSING', 'FAIL' from merged
 where evidence_level = 'VERIFIED_EXCHANGE_DELISTING' and delisted_ms is null
 union all select symbol, 'LIFECYCLE_SOURCE_HASH_MISSING', 'WARN' from (select distinct symbol from sources where source_hash is null)
 where symbol in (select symbol from merged) union all select '', 'LIFECYCLE_LOW_RISK_UNPROVEN', 'WARN' from support
 where survivorship <> 'LOW_SUPPORTED') select * from r""")
def _(spark, d):
    return L.lifecycle_findings(merged(spark, d), sources(spark, d))


@query("evidence_classify", f"with {SQL_MERGED}, {SQL_SOURCES}, {SQL_SUPPORT.format(t='merged')} select * from support")
def _(spark, d):
    return L.evidence_support(merged(spark, d), sources(spark, d))


@query("source_grades", f"""with {SQL_SOURCES} select source_id, symbol, case
 when source_hash is null then 'USER_PROVIDED_UNVERIFIED' else evidence_level end as evidence_level, case
 when source_hash is not null and evidence_level <> 'UNKNOWN' then 'MEDIUM' else 'LOW' end as confidence from sources""")
def _(spark, d):
    return L.grade_sources(sources(spark, d)).select("source_id", "symbol", "evidence_level", "confidence")


@query("duplicate_keys", """select 'C' || o_custkey as symbol, strftime(o_orderdate, '%Y-%m') as snapshot_id, count(*) as rows,
 min(o_orderkey) as first_row, max(o_orderkey) as last_row from orders group by 1, 2 having count(*) > 1""")
def _(spark, d):
    return L.duplicate_keys(seen(spark, d), ["symbol", "snapshot_id"], "seq")


query("universe_build", f"with {SQL_UNIVERSE} select * from universe")(universe)
SQL_UFIND = f"""{SQL_UNIVERSE}, {SQL_SOURCES}, {SQL_SUPPORT.format(t="base")}, ufind as (select symbol as target, 'UNIVERSE_SYMBOL_MALFORMED' as code,
 'FAIL' as severity from universe where not regexp_matches(symbol, '^[A-Z0-9]{{3,30}}$') union all select symbol, 'UNIVERSE_SYMBOL_MISSING_LIFECYCLE',
 'FAIL' from universe where not in_lifecycle union all select symbol, 'UNIVERSE_SYMBOL_NOT_ACTIVE_DURING_WINDOW', 'FAIL' from universe
 where not active_during_window
 union all select symbol, 'UNIVERSE_LISTING_EVIDENCE_MISSING', 'WARN' from universe where listed_ms is null union all select symbol,
 'UNIVERSE_DELISTING_EVIDENCE_MISSING', 'WARN' from universe where delisted_ms is null union all select '',
 unnest(['UNIVERSE_LOCAL_DATA_DISCOVERY_NOT_POINT_IN_TIME', 'UNIVERSE_SNAPSHOT_ARCHIVE_DOES_NOT_COVER_WINDOW',
 'UNIVERSE_POINT_IN_TIME_EVIDENCE_PARTIAL', 'UNIVERSE_DELISTED_STATUS_UNKNOWN', 'UNIVERSE_LOW_RISK_UNPROVEN']), 'WARN'
 union all select '', unnest(['UNIVERSE_LISTING_EVIDENCE_MISSING', 'UNIVERSE_LISTING_NOT_PROVEN_BY_SNAPSHOTS']), 'WARN' from support
 where listing <> 'VERIFIED' union all select '', unnest(['UNIVERSE_DELISTING_EVIDENCE_MISSING', 'UNIVERSE_DELISTING_NOT_PROVEN_BY_SNAPSHOTS']),
 'WARN' from support where delisting <> 'VERIFIED' union all select '', 'UNIVERSE_LIFECYCLE_EVIDENCE_WEAK', 'WARN' from support
 where survivorship <> 'LOW_SUPPORTED')"""


def support(spark, d):
    return L.evidence_support(base(spark, d), sources(spark, d))


def ufind(spark, d):
    return U.universe_findings(universe(spark, d), "LOCAL_DATA_DISCOVERED_SYMBOLS", *WINDOW, support(spark, d), coverage="PARTIAL", risk="LOW")


query("universe_findings", f"with {SQL_UFIND} select * from ufind")(ufind)


@query("universe_risk", f"""with {SQL_UNIVERSE}, {SQL_SOURCES}, {SQL_SUPPORT.format(t='base')},
 p as (select listing = 'VERIFIED' and delisting = 'VERIFIED' and survivorship = 'LOW_SUPPORTED' as proven from support) select (select count(*)
 from universe) as symbols, proven, case when proven then 'LOW' else 'MEDIUM' end as risk from p""")
def _(spark, d):
    return U.survivorship_risk(universe(spark, d), "POINT_IN_TIME_EXCHANGE_UNIVERSE", "LOW", support(spark, d), "true")


@query("window_coverage_status", f"""with {SQL_UNIVERSE} select symbol, case when evidence_level = 'CURRENT_ACTIVE_ONLY' then 'CURRENT_ONLY'
 when listed_ms is null or delisted_ms is null then 'UNKNOWN'
 when listed_ms > {WINDOW[0]} or delisted_ms < {WINDOW[1]} then 'PARTIAL' else 'COVERS_WINDOW' end as coverage from universe""")
def _(spark, d):
    return universe(spark, d).select("symbol", X.window_coverage(F.coalesce(F.col("evidence_level") == "CURRENT_ACTIVE_ONLY", F.lit(False)), F.col("listed_ms"), F.col("delisted_ms"), F.lit(WINDOW[0]), F.lit(WINDOW[1])).alias("coverage"))


SQL_REC = f"""{SQL_UNIVERSE}, ds as (select distinct 'C' || o_custkey as symbol from orders), rec as (select symbol as target,
 'DATASET_SYMBOL_NOT_IN_UNIVERSE' as code, 'FAIL' as severity from ds where symbol not in (select symbol from universe) union all select symbol,
 'UNIVERSE_SYMBOL_MISSING_DATA', 'WARN' from universe where symbol not in (select symbol from ds))"""


def rec(spark, d):
    return U.symbol_reconcile(seen(spark, d), universe(spark, d))


query("symbol_reconcile", f"with {SQL_REC} select * from rec")(rec)


@query("market_reconcile", """with p as (select p_partkey, p_size, 'P' || p_partkey || case p_partkey % 6 when 0 then 'USDT' when 1 then 'USDC'
 when 2 then 'USD' when 3 then 'BTC' when 4 then 'ETH' else '' end as symbol from part), u as (select symbol from p where p_size <= 25)
select symbol as target, 'DATASET_SYMBOL_NOT_IN_UNIVERSE' as code, 'FAIL' as severity from p where symbol not in (select symbol from u) union all
 select symbol, 'UNIVERSE_DATASET_QUOTE_ASSET_MISMATCH', 'FAIL' from p where not suffix(symbol, 'USDT') union all select '',
 'UNIVERSE_DATASET_MARKET_TYPE_MISMATCH', 'FAIL'""")
def _(spark, d):
    k = F.col("p_partkey")
    q = F.element_at(F.array(*[F.lit(x) for x in (*X.QUOTES, "")]), (k % 6 + 1).cast("int"))
    listed = table(spark, d, "part").select(F.concat(F.lit("P"), k.cast("string"), q).alias("symbol"), F.lit("spot").alias("market"), "p_size")
    return U.symbol_reconcile(listed, listed.filter("p_size <= 25"), "USDT", "futures")


@query("warnings_union", f"with {SQL_REC}, {SQL_UFIND.replace(SQL_UNIVERSE + ', ', '')} select * from rec union select * from ufind")
def _(spark, d):
    return U.union_warnings(rec(spark, d), ufind(spark, d))


SQL_DHASH = f"""{SQL_FILES}, dh as (select symbol, sha256(string_agg(path || ':' || sha256, chr(10) order by path || ':' || sha256)) as h,
 count(*) as n from files group by 1), dhash as (select sha256(string_agg(symbol || ':' || h, chr(10) order by symbol || ':' || h)) as dataset_hash,
 cast(sum(n) as bigint) as files from dh)"""


@query("dataset_hash", f"with {SQL_DHASH} select * from dhash")
def _(spark, d):
    return U.dataset_hash(files(spark, d))


@query("dataset_hash_flat", f"with {SQL_FILES} select sha256(string_agg(path || ':' || sha256 || chr(10), '' order by path)) as dataset_hash, count(*) as files from files")
def _(spark, d):
    return U.flat_hash(files(spark, d))


def daily(spark, d) -> DataFrame:
    """The files' rows as daily series: a supplier's shipments."""
    return table(spark, d, "lineitem").select(F.concat(F.lit("S"), F.col("l_suppkey").cast("string"), F.lit("USDT")).alias("symbol"), F.lit("1d").alias("interval"), X.epoch_ms(F.col("l_shipdate")).alias("t"))


def manifest(spark, d):
    """Files against the universe: reconciled symbols, the universe's own findings, the range and the coverage of the series, with what the universe hands on. Each input is taken once."""
    f, b = cut(files(spark, d)), cut(base(spark, d))
    s = cut(L.evidence_support(b, sources(spark, d)))
    u = cut(U.build_universe(members(spark, d), b, *WINDOW))
    span = U.range_findings(f.agg(F.min("lo").alias("start_ms"), F.max("hi").alias("end_ms")), *WINDOW)
    thin = U.coverage_findings(S.gap_audit(daily(spark, d), ["symbol", "interval"], "t", 86_400_000))
    risk = U.survivorship_risk(u, "LOCAL_DATA_DISCOVERED_SYMBOLS", "LOW", s)
    carried = U.provenance(u, b, s, risk, "LOCAL_DATA_DISCOVERED_SYMBOLS")
    own = U.universe_findings(u, "LOCAL_DATA_DISCOVERED_SYMBOLS", *WINDOW, s, coverage="PARTIAL", risk="LOW")
    return U.dataset_manifest(f, U.union_warnings(U.symbol_reconcile(seen(spark, d), u), own, span, thin), carried)


SQL_MANIFEST = f"""{SQL_DHASH}, {SQL_UFIND}, {SQL_REC.replace(SQL_UNIVERSE + ", ", "")}, s as (select count(distinct symbol) as symbols,
 count(*) as files, cast(sum(row_count) as bigint) as rows, min(lo) as start_ms, max(hi) as end_ms from files),
dd as (select 'S' || l_suppkey || 'USDT' as symbol, epoch_ms(l_shipdate) as t, lag(epoch_ms(l_shipdate)) over (partition by l_suppkey order by l_shipdate) as p from lineitem),
da as (select symbol, count(*) - count(*) filter (t = p) as there, count(*) filter (t = p) as dups, count(*) filter (t - p > 86400000) as gaps,
 (max(t) - min(t)) // 86400000 + 1 as expected from dd group by 1),
dw as (select symbol, unnest(list_filter([case when gaps > 0 then 'DATASET_GAPS_DETECTED' end, case
 when dups > 0 then 'DATASET_DUPLICATE_TIMESTAMPS' end, case when least(there,
 expected) * 100.0 / expected < 99 then 'DATASET_COVERAGE_BELOW_THRESHOLD' end], lambda x: x is not null)) as code,
 case when least(there, expected) * 100.0 / expected < 99 then 'FAIL' else 'WARN' end as severity from da),
found as (select target, code, severity from rec union select target, code, severity from ufind union select symbol, code, severity from dw union
 select '', 'DATASET_RANGE_OUTSIDE_UNIVERSE_WINDOW', 'FAIL' from s where start_ms < {WINDOW[0]} or end_ms > {WINDOW[1]}),
ul as (select concat_ws('|', symbol, coalesce(cast(listed_ms as varchar), 'UNKNOWN'), coalesce(cast(delisted_ms as varchar), 'UNKNOWN'),
 cast(active_during_window as varchar)) as line from universe), ud as (select sha256(line)[1:2] as d, sha256(string_agg(line, chr(10)
 order by line)) as h from ul group by 1),
ll as (select concat_ws('|', symbol, status, coalesce(cast(listed_ms as varchar), 'UNKNOWN'), coalesce(cast(delisted_ms as varchar), 'UNKNOWN'),
 evidence_level) as line from base), ld as (select sha256(line)[1:2] as d, sha256(string_agg(line, chr(10) order by line)) as h from ll group by 1),
lev as (select evidence_level || '=' || count(*) as x from base group by evidence_level),
manifest as (select 'universe' as universe_id, (select sha256(string_agg(d || '|' || h, chr(10) order by d || '|' || h)) from ud) as universe_hash,
 'LOCAL_DATA_DISCOVERED_SYMBOLS' as universe_policy, 'lifecycle' as lifecycle_id, (select sha256(string_agg(d || '|' || h, chr(10)
 order by d || '|' || h)) from ld) as lifecycle_hash, (select string_agg(x, ',' order by x) from lev) as evidence_levels,
 (select listing from support) as listing_evidence, (select delisting from support) as delisting_evidence, (select survivorship
 from support) as survivorship_support, 'MEDIUM' as risk, s.*, (select count(*) from found where severity = 'FAIL') as invalid, (select count(*)
 from found where severity = 'WARN') as warnings, (select string_agg(distinct code, ',' order by code) from found) as warning_codes,
 (select dataset_hash from dhash) as dataset_hash, 'FAIL' as status from s)"""
query("dataset_manifest", f"with {SQL_MANIFEST} select * from manifest")(manifest)


def pit(spark, d):
    return U.pit_evidence(universe(spark, d), base(spark, d), sources(spark, d), "LOW", "POINT_IN_TIME_EXCHANGE_UNIVERSE", allow_unverified=True)


SQL_PIT = f"""{SQL_UNIVERSE}, {SQL_SOURCES}, st as (select symbol, trust, count(*) as n, count(*) filter (observed_ms is null) as m from sources
 group by 1, 2), sc as (select symbol, cast(sum(n) as bigint) as n, cast(coalesce(sum(n) filter (trust = 'UNKNOWN'), 0) as bigint) as u,
 cast(sum(m) as bigint) as m, string_agg(trust || '=' || n, ',' order by trust || '=' || n) as trust_levels from st group by 1),
g1 as (select v.symbol, b.delisted_ms as ended, b.symbol as found, coalesce(n, 0) as sources, coalesce(n, 0) - coalesce(m, 0) as observed, coalesce(u,
 0) as unverified, coalesce(m, 0) as missing_time, coalesce(trust_levels, '') as trust_levels, case when b.symbol is null then 'MISSING_LIFECYCLE'
 when b.evidence_level = 'LOCAL_DATA_FIRST_SEEN' then 'LOCAL_DATA_ONLY' when b.evidence_level = 'CURRENT_ACTIVE_ONLY' then 'CURRENT_ONLY' when
 coalesce(u, 0) > 0 then 'UNVERIFIED_ONLY' when coalesce(m, 0) > 0 then 'PARTIAL_FOR_WINDOW' else 'VERIFIED_FOR_WINDOW' end as grade
 from universe v left join base b on b.symbol = v.symbol left join sc on sc.symbol = v.symbol where v.active_during_window),
pit as (select symbol, grade, case when grade = 'VERIFIED_FOR_WINDOW' then 'PIT_ELIGIBLE' when grade in ('PARTIAL_FOR_WINDOW',
 'UNVERIFIED_ONLY') then 'PIT_PARTIAL' else 'PIT_NOT_ELIGIBLE' end as eligibility, case
 when grade = 'UNVERIFIED_ONLY' or (found is not null and ended is null) then 'MEDIUM' else 'LOW' end as risk,
 case when found is null then 'MISSING_LIFECYCLE_MANIFEST_OR_ENTRY' when grade in ('LOCAL_DATA_ONLY',
 'CURRENT_ONLY') then grade end as blocking_reason, sources, observed, unverified, missing_time, trust_levels from g1)"""
query("pit_evidence", f"with {SQL_PIT} select * from pit")(pit)
SQL_VERDICT = """verdict as (select count(*) as symbols, count(blocking_reason) as blocked, case when bool_or(eligibility = 'PIT_NOT_ELIGIBLE') then 'PIT_NOT_ELIGIBLE' when bool_or(eligibility = 'PIT_PARTIAL') then 'PIT_PARTIAL' else 'PIT_ELIGIBLE' end as verdict, case when bool_or(eligibility = 'PIT_NOT_ELIGIBLE') then 'BLOCK_STRICT_PROMOTION' when bool_or(eligibility = 'PIT_PARTIAL') then 'DOWNGRADE_PROMOTION' else 'ALLOW_STRICT_PROMOTION' end as promotion, case when bool_or(risk = 'MEDIUM') then 'MEDIUM' else 'LOW' end as risk from pit)"""


@query("pit_verdict", f"with {SQL_PIT}, {SQL_VERDICT} select * from verdict")
def _(spark, d):
    return U.pit_verdict(pit(spark, d), "LOW")


@query("manifest_with_verdict", f"""with {SQL_MANIFEST}, {SQL_PIT.replace(SQL_UNIVERSE + ', ' + SQL_SOURCES + ', ', '')}, {SQL_VERDICT}
 select m.universe_id, m.universe_hash, m.dataset_hash, m.status, v.verdict as pit_status, v.promotion as pit_promotion from manifest m, verdict v""")
def _(spark, d):
    folded = U.fold_verdict(manifest(spark, d), U.pit_verdict(pit(spark, d), "LOW"))
    return folded.select("universe_id", "universe_hash", "dataset_hash", "status", "pit_status", "pit_promotion")


@query("storage_usage", f"""with {SQL_FILES}, x as (select *, string_split(path, '/')[1] as area from files)
select symbol, year, month, area, cast(sum(length) as bigint) as bytes, count(*) as files from x group by grouping sets ((symbol), (year), (month), (area), ())""")
def _(spark, d):
    return P.storage_usage(files(spark, d))


@query("storage_rollup", f"""with {SQL_FILES}, x as (select length, string_split(path, '/') as p from files), y as (select length,
 array_to_string(p[1:k], '/') as dir from (select length, p, unnest(range(1, len(p))) as k from x)) select dir, cast(sum(length) as bigint) as bytes,
 count(*) as files, count(*) as parquet_files from y group by 1""")
def _(spark, d):
    return P.storage_rollup(files(spark, d))


@query("top_files", f"with {SQL_FILES}, x as (select symbol, path, length, row_number() over (partition by symbol order by length desc, path) as rank from files) select * from x where rank <= 5")
def _(spark, d):
    return P.top_files(files(spark, d), "symbol").withColumn("rank", F.col("rank").cast("bigint"))


@query("staging_estimate", f"""with {SQL_FILES} select case when symbol in ('S1USDT', 'S2USDT') then 'core' else 'expansion' end as target, year,
 cast(sum(length) as bigint) as bytes, count(distinct symbol) as symbols, sum(length) <= 100000 as fits from files group by 1, 2""")
def _(spark, d):
    return P.staging_estimate(files(spark, d), CORE, 100_000)


def reconciled(spark, d, local: DataFrame | None = None):
    """Local files by month of shipment against remote ones by month of order, both over all line items."""
    o = table(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate")
    remote = by_month(table(spark, d, "lineitem").select("l_orderkey", "l_suppkey").join(o, "l_orderkey"), "o_orderdate")
    return P.archive_reconcile(files(spark, d) if local is None else local, remote.select("path", (F.col("row_count") * 64).alias("length")))


SQL_RECON = f"""{SQL_FILES}, rg as (select 'S' || l_suppkey || 'USDT' as symbol, strftime(o_orderdate, '%Y-%m') as period, count(*) * 64 as length
 from lineitem join orders on l_orderkey = o_orderkey group by 1, 2),
 remote as (select 'candles/futures-um/1h/symbol=' || symbol || '/year=' || period[1:4] || '/month=' || period[6:7] || '/' || symbol || '-1h-' || period || '.parquet' as path,
 length from rg), recon as (select coalesce(l.path, r.path) as path, l.length as local_bytes, r.length as remote_bytes from files l full
 join remote r on l.path = r.path), recon2 as (select *, case when remote_bytes is null then 'LOCAL_ONLY' when local_bytes is null then 'REMOTE_ONLY'
 when local_bytes = remote_bytes then 'VERIFIED' else 'SIZE_MISMATCH' end as status from recon)"""
query("archive_reconcile", f"with {SQL_RECON} select *, status = 'VERIFIED' as safe_to_delete from recon2")(reconciled)


# What a budget over all files leaves to delete: one walk in path order, file by file.
SQL_CLEANUP = f"""with recursive {SQL_RECON},
x as (select f.path, f.symbol, f.length, case when f.symbol in ('S1USDT', 'S2USDT') then 'RETAINED_SYMBOL' when not cast(year as int) between 1993 and 1997 then 'NOT_TARGET'
  when coalesce(status, '') <> 'VERIFIED' then 'NOT_VERIFIED' end as why from files f left join recon2 r on r.path = f.path),
free as materialized (select path, length, row_number() over (order by string_split(path, '/'), length) as k from x where why is null),
walk as (select 0::bigint as k, {BUDGET}::bigint as left_over, false as fits
  union all select f.k, case when f.length <= w.left_over then w.left_over - f.length else w.left_over end, f.length <= w.left_over from walk w join free f on f.k = w.k + 1)
select x.path, x.symbol, x.length, coalesce(why, case when fits then 'DELETE' else 'OVER_BUDGET' end) as reason, why is null and fits as delete
from x left join free using (path) left join walk on walk.k = free.k"""


@query("cleanup_plan", SQL_CLEANUP)
def _(spark, d):
    local = cut(files(spark, d).select("path", "symbol", "year", "length"))
    f = local.join(reconciled(spark, d, local).select("path", "status"), "path", "left").withColumn("status", F.coalesce("status", F.lit("")))
    return P.cleanup_plan(f, CORE, 1993, 1997, BUDGET, market="futures-um", interval="1h")


@query("row_fingerprint", """select l_orderkey, l_linenumber, sha256('{"l_orderkey":' || l_orderkey || ',"l_linenumber":' || l_linenumber || ',"l_returnflag":"' || l_returnflag || '"}') as fingerprint from lineitem""")
def _(spark, d):
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", X.fingerprint("l_orderkey", "l_linenumber", "l_returnflag").alias("fingerprint"))
