"""Operator 5, mixing sources to target weights: capped water-filling, then seeded whole and fractional repetitions.

Native: DataFrame and SQL functions only. Sizes are counted once and cut to the
checkpoint folder. Water-filling runs over one row a source: sorted by cap over
weight, the sources that reach their cap come first, and running sums give the
level at which the rest share what is left. Documents then take the whole part
of their source's repetitions, and a fraction of them one more: each source is
dealt by a seeded hash of id and text into small buckets, so that no task holds
a hot source or a hot id (rows that repeat both are counted beforehand), and
within a bucket the fractions owed are added up in order of size, largest
first and seeded within sizes of one power of two; a document is taken once more
when what is owed reaches half of it. A bucket so ends within half of its last,
small, documents of its target.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import cut, documents, same, unused

WEIGHTS, MAX_EPOCHS, SEED = (5, 2, 1), 3, "mix-1"
#: Documents of a source that are dealt to one bucket, about.
BUCKET = 1000
MAX_BROADCAST_SOURCES = 100_000


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """(source, n_docs, source_size, target) from sizes(source, size); the targets sum to all sizes."""
    by = sizes.groupBy("source").agg(F.count("*").alias("n_docs"), F.sum("size").alias("source_size"))
    ranked = by.withColumn("rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())))
    weighed = ranked.withColumn("weight", F.element_at(F.array(*[F.lit(w) for w in weights]), (F.pmod(F.col("rank") - 1, F.lit(len(weights))) + 1).cast("int")))
    weighed = weighed.withColumn("cap", F.col("source_size") * max_epochs).withColumn("fill", F.col("cap").cast("double") / F.col("weight"))
    order = Window.orderBy("fill", "rank")
    before, everything = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0))
    weight_left = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    levels = weighed.withColumn("level", left.cast("double") / weight_left)
    # The first source that stays below its cap has the level of all that follow it.
    free = F.when(F.col("fill") > F.col("level"), F.struct("fill", "rank", "level"))
    levels = levels.withColumn("water", F.min(free).over(everything)["level"])
    target = F.least(F.col("cap").cast("double"), F.coalesce(F.col("water"), F.lit(0.0)) * F.col("weight"))
    return levels.select("source", "n_docs", "source_size", target.alias("target"))


def mix(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """One row for each row of docs(doc_id, text, source): keep, size, source_size, target, copies, taken.

    size counts the words of the whole text (null: 0), copies are 0 to max_epochs,
    taken is size times copies. Sources are ranked by code point, null last, and
    weigh as `weights` repeats. Sources without words have a target of 0. Every
    row counts, those that repeat a doc_id too; order and seed depend on doc_id
    and text alone, so reruns agree. Documents are taken whole, so that a source
    of a few documents comes as near to its target as whole texts allow. Columns
    that aren't in keep are dropped; an empty table gives none.
    """
    kept = [f"keep_{c}" for c in keep]
    seed = F.md5(F.concat(F.lit(f"{SEED}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.lit(":"), F.md5(F.coalesce("text", F.lit("")))))
    size = F.regexp_count(F.coalesce("text", F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("bigint")
    sizes = docs.select(*[F.col(c).alias(f"keep_{c}") for c in keep], F.col("doc_id").alias("id"), "source", size.alias("size"), seed.alias("seed"))
    number = lambda at: F.conv(F.substring("seed", at, 8), 16, 10).cast("bigint")
    sizes = cut(sizes.withColumns({"deal": number(1), "h": number(9)}).drop("seed"))
    targets = cut(source_targets(sizes, weights, max_epochs))
    few = targets.count() <= MAX_BROADCAST_SOURCES
    right = targets.withColumnRenamed("source", "__s")
    entries = sizes.groupBy("source", "id", "size", "deal", "h", *kept).agg(F.count("*").alias("k"))
    rows = entries.join(F.broadcast(right) if few else right, same(F.col("source"), F.col("__s"))).drop("__s")
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    rows = rows.withColumn("whole", F.floor(ratio)).withColumn("part", ratio - F.floor(ratio))
    rows = rows.withColumn("bucket", F.pmod("deal", F.ceil(F.col("n_docs") / F.lit(float(BUCKET)))))
    octave = F.expr("-cast(case when size > 0 then floor(log2(size)) else -1 end as int)").alias("octave")
    dealt = rows.groupBy("source", "bucket", "source_size", "target", "whole", "part").agg(F.sort_array(F.collect_list(F.struct(octave, "h", "id", "size", *kept, "k"))).alias("entries"))
    start = F.struct(F.lit(0.0).alias("owed"), F.array().cast("array<bigint>").alias("more"))

    def step(acc, x):
        owed = acc["owed"] + F.col("part") * x["size"] * x["k"]
        due = F.least(x["k"], F.greatest(F.lit(1), F.floor(owed / x["size"] + F.lit(0.5))))
        more = F.when((x["size"] > 0) & (owed >= x["size"] / F.lit(2.0)), due).otherwise(F.lit(0)).cast("bigint")
        return F.struct((owed - more * x["size"]).alias("owed"), F.concat(acc["more"], F.array(more)).alias("more"))

    chosen = dealt.withColumn("more", F.aggregate("entries", start, step)["more"])
    flat = chosen.select("source_size", "target", "whole", F.explode(F.arrays_zip("entries", "more")).alias("x"))
    each = flat.select("source_size", "target", "whole", "x", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("x.entries.k"))).alias("row"))
    copies = F.col("whole") + F.when(F.col("row") <= F.col("x.more"), 1).otherwise(0)
    return each.select(
        *[F.col(f"x.entries.keep_{c}").alias(c) for c in keep], F.col("x.entries.size").alias("size"), "source_size", "target",
        copies.cast("bigint").alias("copies"), (copies * F.col("x.entries.size")).cast("bigint").alias("taken"),
    )


def repeat_to_targets(docs: DataFrame) -> DataFrame:
    """The mixed corpus: the rows of docs as often as mix takes them.

    Rows that repeat doc_id and text share what mix takes of them all, a null
    doc_id or text being a value like any other. Texts without words have no
    size and are taken as mix says; no rows give none.
    """
    h, key, k, n, m = (unused(c, docs) for c in ("text_hash", "planned_id", "planned_hash", "rows", "taken"))
    rows = docs.withColumn(h, F.xxhash64("text"))
    plan = mix(rows, keep=("doc_id", h)).groupBy(F.col("doc_id").alias(key), F.col(h).alias(k)).agg(F.count("*").alias(n), F.sum("copies").alias(m))
    taken = rows.join(plan.filter(F.col(m) > 0), same(F.col("doc_id"), F.col(key)) & (F.col(h) == F.col(k)))
    # The join has brought these rows together, so that numbering them needs no exchange.
    place = F.row_number().over(Window.partitionBy(key, k).orderBy(k))
    own = F.floor(F.col(m) / F.col(n)) + F.when(place <= F.col(m) % F.col(n), 1).otherwise(0)
    return taken.withColumn(m, own).filter(F.col(m) > 0).withColumn(m, F.explode(F.sequence(F.lit(1).cast("bigint"), F.col(m)))).select(*docs.columns)


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(documents(spark, sf_dir))


def _hex(digits: str) -> str:
    return f"cast(concat('0x', substr(seed, {digits})) as bigint)"


OP5_SQL = f"""
with recursive s as (select doc_id, source, cast(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) as bigint) as size,
  md5('{SEED}:' || coalesce(cast(doc_id as varchar), 'null') || ':' || md5(coalesce(text, ''))) as seed from documents),
b as (select source, count(*) as n_docs, cast(sum(size) as bigint) as source_size, row_number() over (order by source nulls last) as rank from s group by source),
w as (select *, case (rank - 1) % 3 when 0 then 5 when 1 then 2 else 1 end as weight, 3 * source_size as cap from b),
f as (select *, cast(cap as double) / weight as fill from w),
l as (select *, cast(sum(source_size) over () - coalesce(sum(cap) over (order by fill, rank rows between unbounded preceding and 1 preceding), 0) as double)
  / (sum(weight) over () - coalesce(sum(weight) over (order by fill, rank rows between unbounded preceding and 1 preceding), 0)) as level from f),
t as (select source, n_docs, source_size, least(cast(cap as double), coalesce((select first(level order by fill, rank) from l where fill > level), 0e0) * weight) as target from l),
r as (select s.doc_id, size, source_size, target, t.source, case when source_size > 0 then target / source_size else 0e0 end as ratio,
  {_hex("1, 8")} % cast(ceil(n_docs / {BUCKET}e0) as bigint) as bucket,
  -(case when size > 0 then floor(log2(size)) else -1 end) as octave, {_hex("9, 8")} as h from s join t on s.source is not distinct from t.source),
o as materialized (select *, floor(ratio) as whole, ratio - floor(ratio) as part, row_number() over (partition by source, bucket order by octave, h, doc_id, size) as k from r),
a as (select doc_id, source, bucket, k, 0e0 + part * size as owed, size from o where k = 1
  union all select o.doc_id, o.source, o.bucket, o.k, (a.owed - case when a.size > 0 and a.owed >= a.size / 2e0 then a.size else 0 end) + o.part * o.size, o.size
  from a join o on o.source is not distinct from a.source and o.bucket = a.bucket and o.k = a.k + 1)
select o.doc_id, o.size, source_size, target, cast(whole + case when o.size > 0 and owed >= o.size / 2e0 then 1 else 0 end as bigint) as copies,
  cast((whole + case when o.size > 0 and owed >= o.size / 2e0 then 1 else 0 end) * o.size as bigint) as taken
from o join a on o.source is not distinct from a.source and o.bucket = a.bucket and o.k = a.k"""
