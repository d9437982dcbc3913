"""Time series: gaps, coverage, validation, object statistics and manifests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SEVERITY = {"PASS": 0, "UNKNOWN": 1, "WARN": 2, "FAIL": 3}
#: What an audit warns of.
GAPS, DUPLICATES, OUT_OF_ORDER, BELOW = "DATASET_GAPS_DETECTED", "DATASET_DUPLICATE_TIMESTAMPS", "DATASET_OUT_OF_ORDER_TIMESTAMPS", "DATASET_COVERAGE_BELOW_THRESHOLD"
NO_SYMBOL, NO_INTERVAL = "DATASET_SYMBOL_INFER_FAILED", "DATASET_INTERVAL_INFER_FAILED"
PART_MS = 30 * 86_400_000


def _slots(rows: DataFrame, keys: list[str], t: str, part_ms: int) -> DataFrame:
    """One row for each distinct time of a series, with its rows; pre-aggregated, so that duplicates don't travel."""
    return rows.groupBy(*keys, F.floor(F.col(t) / part_ms).alias("__part"), F.col(t).alias("__t")).agg(F.count("*").alias("__n"))


def gap_audit(
    rows: DataFrame, keys: list[str], t: str, step_ms: int | Column, start: int | None = None, end: int | None = None, min_pct: float = 99.0, part_ms: int = PART_MS,
    tail: bool = False, in_window: bool = False, order: list[str] | None = None, arrival: Column | None = None,
) -> DataFrame:
    """Coverage of every series, one row each.

    Two levels, so that a long series is no single task: times meet their
    predecessor within a part of part_ms, and then the parts' first and last
    times meet in a window over one row a part. step_ms may be a column that
    the keys decide, null where a series' interval is none.

    start and end clamp the window inwards: slots are expected from the clamped
    first to the clamped last time, and those before the first row inside are
    missing; with tail also those after the last one. A series with an empty or
    null key, or without step, is UNKNOWN and counts nothing; one with no time
    left between the clamped bounds passes. coverage_pct counts the rows outside
    the window too, unless in_window says otherwise. order, columns of arrival
    (see out_of_order, arrival being its part), adds out_of_order_rows and warns
    of them. warnings lists the codes of what was found. Null times are ignored.
    """
    rows = rows.filter(F.col(t).isNotNull()).withColumn("__step", (step_ms if isinstance(step_ms, Column) else F.lit(step_ms)).cast("bigint"))
    series, step = [*keys, "__step"], F.col("__step")
    inside = F.lit(True)
    if start is not None:
        inside = inside & (F.col("__t") >= start)
    if end is not None:
        inside = inside & (F.col("__t") <= end)
    slots = _slots(rows, series, t, part_ms).withColumn("__in", inside)
    w = Window.partitionBy(*series, "__part").orderBy("__t")
    slots = slots.withColumn("__d", F.when(F.col("__in"), F.col("__t") - F.lag(F.when(F.col("__in"), F.col("__t"))).over(w)))
    gap = F.col("__d") > step
    missing = lambda d: F.floor(d / step) - 1
    none = lambda c: F.coalesce(c, F.lit(0))
    parts = slots.groupBy(*series, "__part").agg(
        F.sum("__n").alias("all_rows"), none(F.sum(F.when(F.col("__in"), F.col("__n")))).alias("in_rows"), F.min("__t").alias("lo"), F.max("__t").alias("hi"),
        none(F.sum(F.when(F.col("__in"), F.col("__n") - 1))).alias("dups"),
        F.min(F.when(F.col("__in"), F.col("__t"))).alias("first"), F.max(F.when(F.col("__in"), F.col("__t"))).alias("last"),
        F.count_if(gap).alias("gaps"), none(F.sum(F.when(gap, missing(F.col("__d"))))).alias("lost"), none(F.max(F.when(gap, F.col("__d")))).alias("widest"),
    )
    w = Window.partitionBy(*series).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("__d", F.col("first") - F.max("last").over(w))
    low, high = F.min("lo"), F.max("hi")
    out = parts.groupBy(*series).agg(
        F.sum("all_rows").alias("rows"), F.sum("in_rows").alias("__rows"), F.sum("dups").alias("duplicate_rows"), F.min("first").alias("__first"), F.max("last").alias("__last"),
        (low if start is None else F.greatest(low, F.lit(start))).alias("min_time_ms"), (high if end is None else F.least(high, F.lit(end))).alias("max_time_ms"),
        (F.sum("gaps") + F.count_if(gap)).alias("gap_count"), (F.sum("lost") + none(F.sum(F.when(gap, missing(F.col("__d")))))).alias("missing_rows"),
        F.greatest(F.max("widest"), none(F.max(F.when(gap, F.col("__d"))))).alias("__widest"),
    )
    # From the clamped first time to the first row inside, and with tail from the last one to the clamped last time.
    before = none(F.col("__first") - F.col("min_time_ms"))
    after = F.col("max_time_ms") - F.coalesce(F.col("__last"), F.col("min_time_ms") - step) if tail else F.lit(0)
    ends = F.when(before > 0, 1).otherwise(0) + F.when(after >= step, 1).otherwise(0)
    lost = F.floor(before / step) + F.when(after >= step, F.floor(after / step)).otherwise(0)
    widest = F.greatest("__widest", F.when(before > 0, before + step).otherwise(0), F.when(after >= step, after + step).otherwise(0))
    out = out.withColumns({"gap_count": F.col("gap_count") + ends, "missing_rows": F.col("missing_rows") + lost, "__widest": widest})
    expected = F.greatest(none(F.floor((F.col("max_time_ms") - F.col("min_time_ms")) / step) + 1), F.lit(0))
    pct = F.when(expected > 0, F.least(F.col("__rows" if in_window else "rows") - F.col("duplicate_rows"), expected) * 100.0 / expected).otherwise(F.lit(0.0))
    out = out.withColumns({"expected_rows": expected.cast("bigint"), "coverage_pct": pct, "largest_gap_seconds": F.greatest(F.floor((F.col("__widest") - step) / 1000), F.lit(0)).cast("bigint")})
    back = F.lit(0).cast("bigint")
    if order is not None:
        seen = out_of_order(rows, series, t, order, arrival).select(*[F.col(k).alias(f"__o_{k}") for k in series], "out_of_order_rows")
        out = out.join(seen, [F.col(k).eqNullSafe(F.col(f"__o_{k}")) for k in series], "left")
        back = none(F.col("out_of_order_rows"))
    unresolved = [F.when(step.isNull() | (step <= 0) | (F.coalesce(F.col(k).cast("string"), F.lit("")) == "") if k == "interval" else F.coalesce(F.col(k).cast("string"), F.lit("")) == "", NO_INTERVAL if k == "interval" else NO_SYMBOL) for k in keys]
    if "interval" not in keys:
        unresolved.append(F.when(step.isNull() | (step <= 0), NO_INTERVAL))
    unknown = F.array_distinct(F.array_compact(F.array(*unresolved)))
    some = expected > 0
    found = [F.when(F.col("gap_count") > 0, GAPS), F.when(F.col("duplicate_rows") > 0, DUPLICATES), F.when(back > 0, OUT_OF_ORDER), F.when(some & (F.col("coverage_pct") < min_pct), BELOW)]
    warnings = F.when(F.size(unknown) > 0, F.concat_ws(",", unknown)).otherwise(F.concat_ws(",", *found))
    status = F.when(F.size(unknown) > 0, "UNKNOWN").when(some & (F.col("coverage_pct") < min_pct), "FAIL").when(warnings != "", "WARN").otherwise("PASS")
    counts = ["rows", "expected_rows", "missing_rows", "duplicate_rows", *(["out_of_order_rows"] if order is not None else []), "gap_count", "largest_gap_seconds"]
    resolved = F.size(unknown) == 0
    return out.select(
        *keys, *[F.when(resolved, back if c == "out_of_order_rows" else F.col(c)).otherwise(F.lit(0)).cast("bigint").alias(c) for c in counts], F.when(resolved, F.col("coverage_pct")).otherwise(F.lit(0.0)).alias("coverage_pct"),
        *[F.when(resolved, F.col(c)).alias(c) for c in ("min_time_ms", "max_time_ms")], status.alias("status"), warnings.alias("warnings"),
    )


def worst(status: Column) -> Column:
    """The gravest status of a group; an aggregate."""
    rank = F.coalesce(*[F.when(status == s, F.lit(k)) for s, k in SEVERITY.items()])
    return F.coalesce(F.max_by(status, rank), F.lit("PASS"))


def gap_audit_total(audit: DataFrame) -> DataFrame:
    """Sums, the largest gap and the worst status over all series."""
    sums = [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("rows", "expected_rows", "missing_rows", "duplicate_rows", "gap_count")]
    return audit.agg(F.count("*").alias("series"), *sums, F.coalesce(F.max("largest_gap_seconds"), F.lit(0)).alias("largest_gap_seconds"), worst(F.col("status")).alias("status"))


def _parted(rows: DataFrame, part: Column | None) -> DataFrame:
    return rows.withColumn("__part", F.lit(0) if part is None else part)


def out_of_order(rows: DataFrame, keys: list[str], t: str, order: list[str], part: Column | None = None) -> DataFrame:
    """rows whose time is below the one that arrived before, by the arrival order given; warnings names them.

    Two levels in one pass over the rows: part is a coarse value that never falls
    along the order. Within a part rows meet their predecessor in a window, and
    parts meet by their first and last rows, in a window over one row a part.
    Without part a series is one part, and one task.
    """
    rows = _parted(rows.select(*dict.fromkeys([*keys, t, *order])) if part is None else rows, part)
    w = Window.partitionBy(*keys, "__part").orderBy(*order)
    seen = rows.withColumns({"__prev": F.lag(t).over(w), "__row": F.row_number().over(w)})
    parts = seen.groupBy(*keys, "__part").agg(F.count("*").alias("n"), F.count_if(F.col(t) < F.col("__prev")).alias("back"), F.max(F.when(F.col("__row") == 1, F.col(t))).alias("first"), F.max_by(t, "__row").alias("last"))
    before = F.lag("last").over(Window.partitionBy(*keys).orderBy("__part"))
    out = parts.withColumn("__prev", before).groupBy(*keys).agg(F.sum("n").alias("rows"), (F.sum("back") + F.count_if(F.col("first") < F.col("__prev"))).alias("out_of_order_rows"))
    return out.withColumn("warnings", F.when(F.col("out_of_order_rows") > 0, OUT_OF_ORDER).otherwise(""))


def file_order(file_rows: int = 1_000_000) -> tuple[list[str], Column]:
    """The order of rows as they lie in files, for rows of readers.read_candle_times(place=True), and its parts: stretches of file_rows of one file.

    The part is text that sorts as the order does, so that neither a series nor a large file is one task.
    """
    return ["path", "row_index"], F.struct(F.col("path"), F.floor(F.col("row_index") / file_rows).alias("stretch"))


def range_coverage(rows: DataFrame, keys: list[str], t: str, step_ms: int | None, lo: int, hi: int, part_ms: int = PART_MS) -> DataFrame:
    """Each series against the slots of [lo, hi]; rows off the grid are ignored for what is missing.

    Counts are arithmetic on distinct times; the first and last missing slots
    come from neighbours within parts of part_ms, and then from the parts' ends,
    as in gap_audit. No grid is generated.
    """
    inside = rows.filter(F.col(t).between(lo, hi)) if step_ms else rows
    series = rows.select(*keys).distinct()
    if not step_ms or lo > hi:
        return series.select(*keys, *[F.lit(0).cast("bigint").alias(c) for c in ("expected_rows", "actual_rows", "duplicate_rows", "missing_rows")], *[F.lit(None).cast("bigint").alias(c) for c in ("first_missing_ms", "last_missing_ms")], F.lit("FAIL").alias("status"))
    expected = (hi - lo) // step_ms + 1
    top = lo + (expected - 1) * step_ms
    slots = _slots(inside, keys, t, part_ms).withColumn("__g", F.when((F.col("__t") - lo) % step_ms == 0, F.col("__t")))
    w = Window.partitionBy(*keys, "__part").orderBy("__t").rowsBetween(Window.unboundedPreceding, -1)
    slots = slots.withColumn("__prev", F.max("__g").over(w))
    gap = F.col("__g") - F.col("__prev") > step_ms
    parts = slots.groupBy(*keys, "__part").agg(
        F.sum("__n").alias("n"), F.sum(F.col("__n") - 1).alias("dups"), F.count("__g").alias("there"), F.min("__g").alias("first"), F.max("__g").alias("last"),
        F.min(F.when(gap, F.col("__prev") + step_ms)).alias("a"), F.max(F.when(gap, F.col("__g") - step_ms)).alias("b"),
    )
    w = Window.partitionBy(*keys).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("__prev", F.coalesce(F.max("last").over(w), F.lit(lo - step_ms)))
    gap = F.col("first") - F.col("__prev") > step_ms
    got = parts.groupBy(*keys).agg(
        F.sum("n").alias("actual_rows"), F.sum("dups").alias("duplicate_rows"), F.sum("there").alias("__there"), F.max("last").alias("__last"),
        F.least(F.min("a"), F.min(F.when(gap, F.col("__prev") + step_ms))).alias("__a"), F.greatest(F.max("b"), F.max(F.when(gap, F.col("first") - step_ms))).alias("__b"),
    )
    out = series.join(got, keys, "left")
    missing = F.lit(expected) - F.coalesce("__there", F.lit(0))
    last = F.coalesce("__last", F.lit(lo - step_ms))
    ends = last < top
    return out.select(
        *keys, F.lit(expected).cast("bigint").alias("expected_rows"), F.coalesce("actual_rows", F.lit(0)).alias("actual_rows"), F.coalesce("duplicate_rows", F.lit(0)).alias("duplicate_rows"), missing.cast("bigint").alias("missing_rows"),
        F.coalesce("__a", F.when(ends, last + step_ms)).cast("bigint").alias("first_missing_ms"), F.when(ends, F.lit(top)).otherwise(F.col("__b")).cast("bigint").alias("last_missing_ms"),
        F.when((missing > 0) | (F.coalesce("duplicate_rows", F.lit(0)) > 0) | F.col("actual_rows").isNull(), "FAIL").otherwise("PASS").alias("status"),
    )


def usability(coverage: DataFrame) -> DataFrame:
    """A series is usable if nothing is missing."""
    return coverage.withColumn("usable", F.col("missing_rows") == 0)


def dataset_verify(rows: DataFrame, keys: list[str], event: str, available: str, lo: int, hi: int) -> DataFrame:
    """Order, availability and range of every series.

    Order is judged by event time, so that what is out of order is each further
    row of one time, and rows need not be sorted for that: they are counted by
    time before they travel. hi is the last day's first millisecond, and a whole
    day is added to it.
    """
    times = rows.groupBy(*keys, event).agg(F.count("*").alias("n"), F.count_if(F.col(available) < F.col(event)).alias("early"))
    out = times.groupBy(*keys).agg(
        F.sum("n").alias("rows"), F.coalesce(F.sum(F.when(F.col(event).isNotNull(), F.col("n") - 1)), F.lit(0)).alias("sort_errors"),
        F.sum("early").alias("availability_errors"), F.coalesce(F.sum(F.when(F.col(event).between(lo, hi + 86_400_000), F.col("n"))), F.lit(0)).alias("rows_in_range"),
    )
    verdict = F.when(F.col("rows") == 0, "EMPTY").when(F.col("sort_errors") > 0, "UNSORTED_OR_DUPLICATE").when(F.col("availability_errors") > 0, "AVAILABILITY").when(F.col("rows_in_range") == 0, "NONE_IN_RANGE").otherwise("PASS")
    return out.withColumn("verdict", verdict)


def funding_verify(verified: DataFrame, manifest_status: Column, start: str, end: str) -> DataFrame:
    """The report of each verified series: its rows and window, PASS only where the verdict is."""
    ok = F.col("verdict") == "PASS"
    status = F.when(ok, "PASS").otherwise("FAIL")
    none = F.lit(0).cast("bigint")
    return verified.select("symbol", F.col("rows").alias("row_count"), F.lit(start).alias("coverage_start"), F.lit(end).alias("coverage_end"), none.alias("missing_intervals"), F.when(ok, none).otherwise(F.col("sort_errors")).alias("duplicate_event_time_count"), ok.alias("available_at_valid"), manifest_status.alias("manifest_status"), status.alias("verification_status"))


def availability_violations(rows: DataFrame, event: str, available: str) -> DataFrame:
    """The rows that were available before they happened."""
    return rows.filter(F.col(available) < F.col(event))


#: Tasks that further rows of one time are dealt to.
SALTS = 64


def validate_rows(rows: DataFrame, keys: list[str], order: list[str], event: str, available: str, required: list[str] = (), bounds: list[tuple[str, Column]] = (), part: Column | None = None) -> DataFrame:
    """each series' first offending row (counted from 0) and its first broken rule; series without one have nulls.

    Required fields come first, then times, then duplicates and order against
    the rows before, and bounds, (rule, whether it is broken), last. part as in
    out_of_order. One pass: rows are numbered and meet their predecessor within
    a part, the first of each time in a part meets those of other parts, and
    parts, one row each, give each other their numbers and last times.
    """
    rows = _parted(rows, part)
    here = Window.partitionBy(*keys, "__part").orderBy(*order)
    seen = rows.withColumns({"__row": F.row_number().over(here), "__prev": F.lag(event).over(here)})
    seen = seen.withColumn("__again", F.col("__row") > F.min("__row").over(Window.partitionBy(*keys, "__part", event)))
    # What is a repetition within its part is so whatever other parts hold: it need not meet them.
    seen = seen.withColumn("__salt", F.when(F.col("__again"), 1 + F.col("__row") % SALTS).otherwise(0))
    elsewhere = F.min("__part").over(Window.partitionBy(*keys, event, "__salt"))
    seen = seen.withColumn("__again", F.col("__again") | (F.col("__part") > elsewhere))
    checks = [(f"missing {c}", F.coalesce(F.trim(F.col(c).cast("string")), F.lit("")) == "") for c in required]
    checks += [("event_time_ms <= 0", F.col(event) <= 0), ("available_at_ms <= 0", F.col(available) <= 0), ("available_at_ms < event_time_ms", F.col(available) < F.col(event))]
    checks.append(("duplicate event_time_ms", F.col("__again")))
    name = lambda found: F.coalesce(*[F.when(c, F.lit(n)) for n, c in found]) if found else F.lit(None).cast("string")
    disorder = "event_time_ms out of order"
    seen = seen.withColumns({"__early": name(checks), "__late": name(list(bounds))})
    seen = seen.withColumn("__rule", F.coalesce("__early", F.when(F.col(event) < F.col("__prev"), disorder), "__late"))
    first, bad = F.col("__row") == 1, (F.col("__row") > 1) & F.col("__rule").isNotNull()
    parts = seen.groupBy(*keys, "__part").agg(
        F.count("*").alias("n"), F.count_if(bad).alias("bad"), F.min(F.when(bad, F.col("__row"))).alias("at"), F.min_by(F.when(bad, F.col("__rule")), F.when(bad, F.col("__row"))).alias("rule"),
        F.max_by(event, "__row").alias("last"), F.max(F.when(first, F.col(event))).alias("head"), F.max(F.when(first, F.col("__early"))).alias("early"), F.max(F.when(first, F.col("__late"))).alias("late"),
    )
    before = Window.partitionBy(*keys).orderBy("__part")
    parts = parts.withColumns({"__prev": F.lag("last").over(before), "__start": F.coalesce(F.sum("n").over(before.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))})
    parts = parts.withColumn("__first", F.coalesce("early", F.when(F.col("head") < F.col("__prev"), disorder), "late"))
    parts = parts.withColumns({"at": F.col("__start") + F.when(F.col("__first").isNotNull(), 0).otherwise(F.col("at") - 1), "rule": F.coalesce("__first", "rule"), "bad": F.col("bad") + F.col("__first").isNotNull().cast("int")})
    return parts.groupBy(*keys).agg(F.sum("n").alias("rows"), F.sum("bad").alias("bad_rows"), F.min("at").cast("bigint").alias("first_bad_row"), F.min_by("rule", "at").alias("first_rule"))


def sentiment_bounds(score: Column, strength: Column | None = None) -> list[tuple[str, Column]]:
    """Bounds of sentiment rows, for validate_rows; nulls are within."""
    outside = lambda c, lo, hi: ~F.coalesce(c.between(lo, hi), F.lit(True))
    return [("score outside 0..100", outside(score, 0, 100)), *([] if strength is None else [("intensity outside 0..1", outside(strength, 0, 1))])]


def object_stats(rows: DataFrame, keys: list[str], times: list[str]) -> DataFrame:
    """Rows and the range of each time column of every object; a scan of those columns alone."""
    return rows.groupBy(*keys).agg(F.count("*").alias("row_count"), *[f(t).alias(f"{name}_{t}") for t in times for name, f in (("min", F.min), ("max", F.max))])


def object_status(stats: DataFrame, lo: str, hi: str, ok: Column | None = None) -> DataFrame:
    """E23, by object: FAIL for no rows or a bad range."""
    bad = (F.col("row_count") <= 0) | F.col(lo).isNull() | (F.col(lo) <= 0) | (F.col(lo) > F.col(hi))
    return stats.withColumn("status", F.when(bad if ok is None else bad | ~ok, "FAIL").otherwise("PASS"))


def object_manifest(stats: DataFrame, series: list[str], key: str, lo: str, hi: str) -> DataFrame:
    """One row a series: its objects, their range, the sorted list of keys, PASS or FAIL (a key twice is a failure)."""
    judged = object_status(stats, lo, hi)
    out = judged.groupBy(*series).agg(
        F.count("*").alias("objects"), F.sum("row_count").alias("row_count"), F.min(lo).alias("coverage_start_ms"), F.max(hi).alias("coverage_end_ms"),
        F.array_join(F.array_sort(F.collect_set(key)), ",").alias("object_keys"), F.countDistinct(key).alias("__keys"), F.bool_or(F.col("status") == "FAIL").alias("__bad"),
    )
    return out.withColumn("status", F.when(F.col("__bad") | (F.col("__keys") < F.col("objects")), "FAIL").otherwise("PASS")).drop("__keys", "__bad")


def publishable(manifest: DataFrame, allow_failed: bool = False) -> DataFrame:
    """The manifests that may be published."""
    return manifest if allow_failed else manifest.filter(F.col("status") == "PASS")


def month_partitions(rows: DataFrame, keys: list[str], event: str) -> DataFrame:
    """Rows with the year and month of their event time in UTC, as the partitioned sink lays them out."""
    from ..functions import exprs

    day = exprs.utc_date(F.col(event))
    return rows.withColumns({"year": F.substring(day, 1, 4), "month": F.substring(day, 6, 2)})


def normalize_sentiment(rows: DataFrame, series: list[str], event: str, order: list[str], score: Column, label: Column, lo: int, hi: int) -> DataFrame:
    """The first row of each event time wins, then scores outside 0 to 100 go; available a day after the event."""
    from ..functions import exprs

    # The first of each time is a map-side minimum over the order, so that repetitions of a time never meet.
    cols = F.struct(*[F.col(c) for c in order], score.alias("__score"), label.alias("__label"))
    first = rows.filter(F.col(event).between(lo, hi)).groupBy(*series, event).agg(F.min(cols).alias("__first"))
    out = first.select(*series, F.col(event).alias("event_time_ms"), (F.col(event) + exprs.DAY_MS).alias("available_at_ms"), F.col("__first.__score").alias("score"), exprs.snake(F.col("__first.__label")).alias("label"))
    return out.filter(F.col("score").between(0, 100)).withColumn("intensity", exprs.intensity(F.col("score")))


def availability_lag(rows: DataFrame, event: str, available: str) -> DataFrame:
    """K4: rows by whole days between event and availability."""
    return rows.groupBy(F.floor((F.col(available) - F.col(event)) / 86_400_000).alias("lag_days")).agg(F.count("*").alias("rows"))
