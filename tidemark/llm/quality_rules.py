"""Operator 9, quality rules: base rules, then robust multivariate outliers per language and source.

Native: DataFrame and SQL functions only. Statistics are made once per text and
cut to the checkpoint folder; all later passes read counts of their distinct
transformed values, four small whole numbers. The minimum covariance determinant
of every group is sought from several starts by concentration steps: distances,
the nearest H_SHARE of the group, their mean and covariance, and again until no
group changes; of a group's starts the one of the least determinant is taken.
A step is one map-side aggregate of exact whole-number sums by bins of distance,
which a group of any size passes through, so that reruns agree. A group's
estimate then counts as its documents beside PRIOR documents of all groups
together, so that a small group leans on the others without any threshold.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, documents, same, unused
from .textstats import text_stats

#: A statistic is stored as whole 1/256 of its logarithm.
UNIT = 256
#: The transformed statistics: word length, symbols, repeated lines and words in repeated windows, a hundred words.
FEATURES = {
    "z1": f"cast(floor({UNIT} * ln(cast(word_chars as double) / n_words) + 5e-1) as bigint)",
    "z2": f"cast(floor({UNIT} * ln(1e0 + 1e2 * n_symbols / n_words) + 5e-1) as bigint)",
    "z3": f"cast(floor({UNIT} * ln(1e0 + 1e2 * n_dup_lines / n_words) + 5e-1) as bigint)",
    "z4": f"cast(floor({UNIT} * ln(1e0 + 1e2 * n_repeat_words / n_words) + 5e-1) as bigint)",
}
Z = list(FEATURES)
#: Spread that every statistic is granted, in logarithms: most are zero in most texts, so that a group's own covariance is singular.
FLOOR = {"z1": 0.08, "z2": 0.25, "z3": 0.5, "z4": 1.0}
#: Share of a group that the determinant is taken over, and what makes that covariance consistent for normal data in four dimensions.
H_SHARE, CONSISTENCY = 0.75, 1.485
#: Squared distance beyond which a document is rejected: the 0.99999 quantile of chi-square with four degrees of freedom.
CUTOFF = 28.5
#: Concentration steps at most; they stop when no group changes, which takes a handful.
MAX_STEPS = 12
#: Documents of all groups together that stand beside a group's own.
PRIOR = 50
#: Groups whose estimates are sent to every executor; with more, they are joined by shuffle.
MAX_BROADCAST_GROUPS = 100_000
BASE_FAILED = "n_words < 50 or 100 * n_repeat_words > 50 * n_words"
KEY = ["pooled", "g_lang", "g_source"]
RUN = [*KEY, "start"]
PAIRS = [(i, j) for j in range(4) for i in range(j, 4)]
MEANS, COVS, FACTORS = [f"m{i + 1}" for i in range(4)], [f"c{i + 1}{j + 1}" for i, j in PAIRS], [f"l{i + 1}{j + 1}" for i, j in PAIRS]
SUMS = ["n"] + [f"s{i + 1}" for i in range(4)] + [f"s{i + 1}{j + 1}" for i, j in PAIRS]

#: Cholesky factor of a covariance; each line may name the ones above it.
CHOLESKY = []
for _i, _j in PAIRS:
    _rest = "".join(f" - l{_i + 1}{k + 1} * l{_j + 1}{k + 1}" for k in range(_j))
    CHOLESKY.append(f"sqrt(c{_i + 1}{_i + 1}{_rest}) as l{_i + 1}{_i + 1}" if _i == _j else f"(c{_i + 1}{_j + 1}{_rest}) / l{_j + 1}{_j + 1} as l{_i + 1}{_j + 1}")
#: Mean, covariance and its factor from a group's sums.
MOMENTS = [f"cast(s{i + 1} as double) / n as m{i + 1}" for i in range(4)]
MOMENTS += [
    f"{CONSISTENCY}e0 * (cast(s{i + 1}{j + 1} as double) / n - (cast(s{i + 1} as double) / n) * (cast(s{j + 1} as double) / n))" + (f" + {(FLOOR[Z[i]] * UNIT) ** 2}e0" if i == j else "") + f" as c{i + 1}{j + 1}"
    for i, j in PAIRS
]
#: Forward substitution and the squared Mahalanobis distance.
SOLVE = [f"(z{i + 1} - m{i + 1}" + "".join(f" - l{i + 1}{k + 1} * y{k + 1}" for k in range(i)) + f") / l{i + 1}{i + 1} as y{i + 1}" for i in range(4)]
DISTANCE = "y1 * y1 + y2 * y2 + y3 * y3 + y4 * y4"
BIN = "cast(floor(6.4e1 * ln(1e0 + d2)) as bigint)"
DETERMINANT = "l11 * l22 * l33 * l44"


def _sums(k: str) -> list[str]:
    """Sums of a group's documents and of their products; k is how many documents a row stands for."""
    return [f"cast(sum({k}) as bigint) as n", *[f"cast(sum({z} * {k}) as bigint) as s{i + 1}" for i, z in enumerate(Z)], *[f"cast(sum({Z[i]} * {Z[j]} * {k}) as bigint) as s{i + 1}{j + 1}" for i, j in PAIRS]]


def _blend(own: dict[str, str], rest: dict[str, str]) -> list[str]:
    """Mean and covariance of a mixture of two groups, w being the first one's share."""
    means = [f"w * {own[m]} + (1e0 - w) * {rest[m]} as m{i + 1}" for i, m in enumerate(MEANS)]
    apart = lambda i: f"({own[MEANS[i]]} - {rest[MEANS[i]]})"
    return means + [f"w * {own[c]} + (1e0 - w) * {rest[c]} + w * (1e0 - w) * {apart(i)} * {apart(j)} as {c}" for c, (i, j) in zip(COVS, PAIRS, strict=True)]


def _with(rows: DataFrame, groups: DataFrame, few: bool, key: list[str]) -> DataFrame:
    """rows with their group's columns. groups is broadcast only if it was counted to be small."""
    right = groups.select(*[F.col(k).alias(f"__{k}") for k in key], *[c for c in groups.columns if c not in key])
    on = [same(F.col(k), F.col(f"__{k}")) for k in key]
    return rows.join(F.broadcast(right) if few else right, on).drop(*[f"__{k}" for k in key])


def _starts(cells: DataFrame, few: bool) -> DataFrame:
    """Where the steps start, one row for each group and start: medians with median deviations, the moments of all, medians with the least spreads."""
    medians = cells.groupBy(*KEY).agg(*[F.expr(f"percentile({z}, 0.5, k)").alias(m) for z, m in zip(Z, MEANS, strict=True)])
    spread = _with(cells, medians, few, KEY).groupBy(*KEY, *MEANS).agg(*[F.expr(f"percentile(abs({z} - {m}), 0.5, k)").alias(f"a{i + 1}") for i, (z, m) in enumerate(zip(Z, MEANS, strict=True))])
    least = [f"{FLOOR[z] * UNIT}e0" for z in Z]
    factor = lambda s: [f"{s[i]} as l{i + 1}{i + 1}" if i == j else f"0e0 as l{i + 1}{j + 1}" for i, j in PAIRS]
    moments = cells.groupBy(*KEY).agg(*map(F.expr, _sums("k"))).selectExpr(*KEY, "1 as start", *MOMENTS).selectExpr("*", *CHOLESKY)
    return (
        spread.selectExpr(*KEY, "0 as start", *MEANS, *factor([f"greatest(a{i + 1} * 1.4826e0, {x})" for i, x in enumerate(least)]))
        .unionByName(moments.select(*RUN, *MEANS, *FACTORS)).unionByName(spread.selectExpr(*KEY, "2 as start", *MEANS, *factor(least)))
    )


def _estimates(cells: DataFrame, few: bool) -> DataFrame:
    """The estimate of the least determinant for every group of cells(KEY, z1.., k): KEY, MEANS, COVS."""
    mark = lambda df: df.agg(F.count("*"), F.bit_xor(F.xxhash64(*RUN, *MEANS, *FACTORS))).first()
    params = cut(_starts(cells, few))
    seen = mark(params)
    for _ in range(MAX_STEPS):
        near = _with(cells, params, few, KEY).selectExpr("*", *SOLVE).selectExpr("*", f"{DISTANCE} as d2").selectExpr("*", f"{BIN} as bin")
        bins = near.groupBy(*RUN, "bin").agg(*map(F.expr, _sums("k")))
        # A group's bins, of which there are some hundreds at most, meet in one row; the sums within the bound need no further exchange.
        met = bins.groupBy(*RUN).agg(F.expr(f"percentile(bin, {H_SHARE}, n)").alias("h_bin"), F.collect_list(F.struct("bin", *SUMS)).alias("bins"))
        inner = met.select(*RUN, "h_bin", F.inline("bins")).filter("bin <= h_bin").groupBy(*RUN).agg(*[F.sum(s).alias(s) for s in SUMS])
        params = cut(inner.selectExpr(*RUN, *MOMENTS).selectExpr("*", *CHOLESKY))
        before, seen = seen, mark(params)
        if before == seen:
            break
    best = params.groupBy(*KEY).agg(F.min(F.struct(F.expr(DETERMINANT).alias("determinant"), "start", *MEANS, *COVS)).alias("b"))
    return best.select(*KEY, *[F.col(f"b.{c}").alias(c) for c in (*MEANS, *COVS)])


def quality_rules(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """One row for each row of docs(text, lang, source, ...): keep, the statistics, base_failed, kept.

    base_failed: under 50 words, or over half of the words in repeated windows
    (so null and empty texts fail). Others are kept unless their Mahalanobis
    distance from their language and source is over CUTOFF. Null languages and
    sources are groups like any other. Rows that repeat are judged alike.
    Columns of docs that aren't in keep are dropped; an empty table gives none.
    """
    pre = docs.select(*[F.col(c).alias(f"keep_{c}") for c in keep], "text", F.col("lang").alias("g_lang"), F.col("source").alias("g_source"))
    kept = tuple(f"keep_{c}" for c in keep)
    stats = text_stats(pre, keep=(*kept, "g_lang", "g_source")).withColumn("base_failed", F.expr(BASE_FAILED))
    stats = cut(stats.selectExpr("*", *[f"case when not base_failed then {e} end as {z}" for z, e in FEATURES.items()]))
    own = stats.filter("not base_failed").groupBy("g_lang", "g_source", *Z).agg(F.count("*").alias("k")).select(F.lit(False).alias("pooled"), "g_lang", "g_source", *Z, "k")
    own = cut(own)
    everything = own.groupBy(*Z).agg(F.sum("k").alias("k")).select(F.lit(True).alias("pooled"), F.lit(None).cast(own.schema["g_lang"].dataType).alias("g_lang"), F.lit(None).cast(own.schema["g_source"].dataType).alias("g_source"), *Z, "k")
    cells = cut(own.unionByName(everything))
    sizes = cut(own.groupBy(*KEY).agg(F.sum("k").alias("size")))
    few = sizes.count() <= MAX_BROADCAST_GROUPS
    found = cut(_estimates(cells, few))
    # The estimate of all groups together is one row of numbers.
    rest = found.filter("pooled").first()
    if rest is None:
        judged = stats.withColumn("d2", F.lit(None).cast("double"))
    else:
        named = {c: c for c in (*MEANS, *COVS)}
        blend = _blend(named, {c: f"cast('{rest[c]!r}' as double)" for c in named})
        params = _with(found, sizes, few, KEY).selectExpr(*KEY, f"cast(size as double) / (size + {PRIOR}) as w", *MEANS, *COVS).selectExpr("g_lang", "g_source", *blend).selectExpr("*", *CHOLESKY)
        right = cut(params.select(F.col("g_lang").alias("__l"), F.col("g_source").alias("__s"), *MEANS, *FACTORS))
        on = [same(F.col("g_lang"), F.col("__l")), same(F.col("g_source"), F.col("__s"))]
        judged = stats.join(F.broadcast(right) if few else right, on, "left").selectExpr("*", *SOLVE).selectExpr("*", f"{DISTANCE} as d2")
    return judged.select(
        *[F.col(f"keep_{c}").alias(c) for c in keep],
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & F.coalesce(F.col("d2") <= CUTOFF, F.lit(False))).alias("kept"),
    )


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of docs that quality_rules keeps, with all their columns.

    A row is matched with its verdict by all that the verdict hangs on, doc_id,
    a hash of the text, lang and source, so that of two rows that differ in one
    of these each gets its own. Nulls match nulls; an empty table gives none.
    """
    h = unused("text_hash", docs)
    key = docs.withColumn(h, F.xxhash64("text"))
    by = ("doc_id", h, "lang", "source")
    names = [unused(f"kept_{k}", key) for k in range(len(by))]
    verdict = quality_rules(key, keep=by).filter("kept").select(*[F.col(c).alias(n) for c, n in zip(by, names, strict=True)])
    met = [same(F.col(c), F.col(n)) for c, n in zip(by, names, strict=True)]
    return key.join(verdict, met, "left_semi").drop(h)


def op9_quality_rules(spark, sf_dir: str) -> DataFrame:
    return quality_rules(documents(spark, sf_dir))


def _oracle() -> str:
    """The same in DuckDB, over documents and not over counts: windows counted by grouping, continuous quantiles, steps as chained CTEs, as many as there may be."""
    on = lambda a, b, key=KEY: " and ".join(f"{a}.{k} is not distinct from {b}.{k}" for k in key)
    key, run = ", ".join(KEY), ", ".join(RUN)
    least = [f"{FLOOR[z] * UNIT}e0" for z in Z]
    factor = lambda s: ", ".join(f"{s[i]} as l{i + 1}{i + 1}" if i == j else f"0e0 as l{i + 1}{j + 1}" for i, j in PAIRS)
    sql = f"""
with d as (select doc_id, lang, source, coalesce(text, '') as t from documents),
w as (select doc_id, lang, source, t, list_filter(regexp_split_to_array(t, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') as w from d),
pos as (select doc_id, w, unnest(range(1, len(w) - 1)) as p from w where len(w) >= 3),
gram as (select doc_id, p, count(*) over (partition by doc_id, w[p], w[p + 1], w[p + 2]) as k from pos),
rep as (select doc_id, count(distinct q) as n from (select doc_id, unnest([p, p + 1, p + 2]) as q from gram where k > 1) group by 1),
st as (select w.doc_id, lang, source, cast(len(w) as bigint) as n_words, cast(length(array_to_string(w, '')) as bigint) as word_chars,
  cast(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) as bigint) as n_symbols,
  cast(len(list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]'))) - len(list_distinct(list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')))) as bigint) as n_dup_lines,
  cast(coalesce(rep.n, 0) as bigint) as n_repeat_words from w left join rep on w.doc_id = rep.doc_id),
b as (select *, ({BASE_FAILED}) as base_failed from st),
r as materialized (select *, lang as g_lang, source as g_source, {", ".join(f"case when not base_failed then {e} end as {z}" for z, e in FEATURES.items())} from b),
g as materialized (select false as pooled, g_lang, g_source, {", ".join(Z)} from r where not base_failed union all select true, null, null, {", ".join(Z)} from r where not base_failed),
med as (select {key}, {", ".join(f"quantile_cont({z}, 0.5) as m{i + 1}" for i, z in enumerate(Z))} from g group by all),
mad as materialized (select {", ".join(f"med.{c}" for c in [*KEY, *MEANS])}, {", ".join(f"quantile_cont(abs({z} - m{i + 1}), 0.5) as a{i + 1}" for i, z in enumerate(Z))} from g join med on {on("g", "med")} group by all),
allsum as (select {key}, 1 as start, {", ".join(_sums("1"))} from g group by all),
allmom as (select *, {", ".join(CHOLESKY)} from (select {run}, {", ".join(MOMENTS)} from allsum)),
p0 as materialized (select {key}, 0 as start, {", ".join(MEANS)}, {factor([f"greatest(a{i + 1} * 1.4826e0, {x})" for i, x in enumerate(least)])} from mad
  union all select {run}, {", ".join(MEANS)}, {", ".join(FACTORS)} from allmom union all select {key}, 2 as start, {", ".join(MEANS)}, {factor(least)} from mad)"""
    for k in range(MAX_STEPS):
        sql += f""",
x{k} as materialized (select g.*, start, {", ".join(SOLVE)}, {DISTANCE} as d2, {BIN} as bin from g join p{k} on {on("g", f"p{k}")}),
h{k} as (select {run}, quantile_cont(bin, {H_SHARE}) as h_bin from x{k} group by all),
t{k} as (select {", ".join(f"x{k}.{c}" for c in RUN)}, {", ".join(_sums("1"))} from x{k} join h{k} on {on(f"x{k}", f"h{k}", RUN)} where bin <= h_bin group by all),
p{k + 1} as materialized (select *, {", ".join(CHOLESKY)} from (select {run}, {", ".join(MOMENTS)} from t{k}))"""
    blend = _blend({c: f"o.{c}" for c in (*MEANS, *COVS)}, {c: f"a.{c}" for c in (*MEANS, *COVS)})
    return sql + f""",
best as (select * from p{MAX_STEPS} qualify row_number() over (partition by {key} order by {DETERMINANT}, start) = 1),
sized as (select {key}, count(*) as size from g group by all),
own as (select best.*, cast(size as double) / (size + {PRIOR}) as w from best join sized on {on("best", "sized")} where not best.pooled),
params as (select *, {", ".join(CHOLESKY)} from (select o.g_lang, o.g_source, {", ".join(blend)} from own o, (select * from best where pooled) a))
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, not base_failed and coalesce(d2 <= {CUTOFF}, false) as kept
from (select r.*, {", ".join(SOLVE)}, {DISTANCE} as d2 from r left join params on r.g_lang is not distinct from params.g_lang and r.g_source is not distinct from params.g_source)"""


OP9_SQL = _oracle()
