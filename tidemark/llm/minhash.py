"""Operator 2, MinHash near-dedup: a chosen-path set similarity join, confirmed on the full shingle sets.

Equal sets are one representative from the start. Each of TREES independent
trees sends a representative to the node of one minwise token. A node first
compares its members with one of them, its centre, which joins large groups of
copies without all of their pairs; nodes that it leaves in many components get
several more centres. Nodes that then hold more than one component go on: those
with few members outside their largest component compare these with all the
others, the rest branch, each member following the minwise tokens that the
node's own path selects; what is still large at DEPTH is compared in blocks.
Compared pairs pass a bound on sizes and two sketches (which keep a pair at the
threshold with a probability of about 1 - 1e-7) and are confirmed by
intersecting the full sets. At the threshold a tree's root alone brings a pair
together with probability 3/4, so that twelve trees lose about one such pair in
ten million. In nodes that branch twice at every level a pair stays together
with probability 8/9 however deep they go, so 2/3 a tree, and twelve trees lose
about two pairs in a million; the tests measure this against all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import MAX_BROADCAST_BYTES, components, cut, documents, lowered_words_of, meet, open_nodes, unused

WORDS, PERCENT = 5, 75
TREES, TOKENS, SKETCH = 12, 32, 128
#: Members outside its largest component up to which a node is compared exhaustively, and how deep larger ones branch before they are compared all the same.
SMALL_NODE, DEPTH, BRANCHES = 512, 10, 2
#: Shingles of the hubs that one place holds, about, and pairs of one hub from which on it has several places.
PLACE, HOT = 1_000_000, 50_000
#: Further centres of a node that the first left in many components.
CENTRES = 8
#: Differing sketch bits beyond which a pair cannot be near: 16 are expected at 75 percent, with a deviation of 3.74.
MAX_BITS = 38
#: Numbers of 64 places of an odd sketch.
ODD = 16
_rng = np.random.Generator(np.random.PCG64(20240229))
_MULT = _rng.integers(1, 1 << 63, SKETCH + TOKENS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _rng.integers(0, 1 << 63, SKETCH + TOKENS, dtype=np.uint64)
_STEP = _rng.integers(1, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def shingle_set(text: str | None, words: int = WORDS) -> np.ndarray:
    """The distinct 64-bit hashes of a text's shingles, sorted; of the whole sequence where it is shorter than one."""
    found = lowered_words_of(text)
    if not found:
        return np.empty(0, np.uint64)
    digest = xxhash.xxh3_64_intdigest
    hashes = np.fromiter((digest(w) for w in found), np.uint64, len(found))
    k = min(words, len(found))
    total = np.zeros(len(found) - k + 1, np.uint64)
    for i in range(k):
        total += hashes[i : i + len(total)] * _STEP[i]
    return np.unique(_mix(total + np.uint64(k)))


def signature(found: np.ndarray) -> tuple[np.ndarray, int, int]:
    """Minwise tokens of a set, and two words of one-bit sketches, from independent hash functions."""
    low = np.full(SKETCH + TOKENS, np.uint64((1 << 64) - 1))
    for k in range(0, len(found), 1024):
        part = found[k : k + 1024]
        low = np.minimum(low, ((part[None, :] ^ _ADD[:, None]) * _MULT[:, None]).min(axis=1))
    bits = _mix(low[TOKENS:]) & np.uint64(1)
    one, two = (int((bits[i : i + 64] << np.arange(64, dtype=np.uint64)).sum(dtype=np.uint64)) for i in (0, 64))
    return low[:TOKENS].view(np.int64), one - ((one >> 63) << 64), two - ((two >> 63) << 64)


def odd_sketch(found: np.ndarray) -> np.ndarray:
    """Which of 64 * ODD places an odd number of the set's elements fall on. Two sketches differ in no more places than the sets in elements."""
    odd = np.bincount((_mix(found ^ np.uint64(ODD)) % np.uint64(64 * ODD)).astype(np.int64), minlength=64 * ODD) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _sketches(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(0, b.num_rows, 500):
                part = b.slice(k, 500)
                rows, wide = [], []
                for text in part.column(1).to_pylist():
                    found = shingle_set(text, words)
                    if len(found):
                        both = xxhash.xxh3_128_intdigest(found.tobytes())
                        tokens, one, two = signature(found)
                        rows.append((len(found), (both >> 64) - (1 << 63), (both & ((1 << 64) - 1)) - (1 << 63), one, two))
                        wide.append(np.concatenate((tokens, odd_sketch(found))))
                    else:
                        rows.append((0, 0, 0, 0, 0))
                        wide.append(np.zeros(TOKENS + ODD, np.int64))
                cols = [pa.array(c, pa.int64()) for c in zip(*rows, strict=True)]
                for lo, hi in ((0, TOKENS), (TOKENS, TOKENS + ODD)):
                    flat = np.concatenate([x[lo:hi] for x in wide])
                    cols.append(pa.ListArray.from_arrays(pa.array(np.arange(len(wide) + 1, dtype=np.int32) * (hi - lo)), pa.array(flat)))
                yield pa.RecordBatch.from_arrays([part.column(0), *cols], ["doc_id", "n", "s1", "s2", "b1", "b2", "tokens", "odd"])

    return run


def _sets(words: int):
    """(id, places, shingles) of texts; rows whose text is another one of the same doc_id are left out, as s1 tells."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(0, b.num_rows, 500):
                part = b.slice(k, 500)
                found = [shingle_set(t, words) for t in part.column("text").to_pylist()]
                own = [(xxhash.xxh3_128_intdigest(x.tobytes()) >> 64) - (1 << 63) == s for x, s in zip(found, part.column("s1").to_pylist(), strict=True)]
                found = [x.view(np.int64) for x, ok in zip(found, own, strict=True) if ok]
                ends = np.cumsum([0, *(len(x) for x in found)])
                flat = np.concatenate(found) if found else np.empty(0, np.int64)
                part = part.filter(pa.array(own))
                yield pa.RecordBatch.from_arrays([part.column("id"), part.column("places"), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))], ["id", "places", "shingles"])

    return run


def _near(percent: int):
    """The pairs that reach the threshold, from rows sorted by place: its hubs' sets first, which stay, then the sets to compare with them, which pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, held = None, {}
        for b in batches:
            lists = b.column("shingles")
            ends, flat = lists.offsets.to_numpy(), lists.values.to_numpy(zero_copy_only=False).view(np.uint64)
            out = []
            for i, (at, salt, hubs, own) in enumerate(zip(*(b.column(c).to_pylist() for c in ("place", "salt", "hubs", "id")), strict=True)):
                if (at, salt) != place:
                    place, held = (at, salt), {}
                x = flat[ends[i] : ends[i + 1]]
                if hubs is None:
                    held[own] = x.copy()
                    continue
                for h in hubs:
                    y = held[h]
                    shared = int((y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x).sum())
                    if shared * 100 >= (len(x) + len(y) - shared) * percent:
                        out.append((min(h, own), max(h, own)))
            yield pa.RecordBatch.from_arrays([pa.array([p[k] for p in out], pa.int64()) for k in (0, 1)], ["a", "b"])

    return run


def _may_be_near(a: str, b: str, percent: int) -> Column:
    """What sizes and sketches allow; no pair at the threshold has sizes further apart."""
    n1, n2 = F.col(f"{a}.n"), F.col(f"{b}.n")
    differ = F.bit_count(F.col(f"{a}.b1").bitwiseXOR(F.col(f"{b}.b1"))) + F.bit_count(F.col(f"{a}.b2").bitwiseXOR(F.col(f"{b}.b2")))
    return (F.least(n1, n2) * 100 >= F.greatest(n1, n2) * percent) & (differ <= MAX_BITS)


def _sets_may_be_near(a: str, b: str, percent: int) -> Column:
    """What odd sketches allow. Sets at the threshold differ in (100 - percent) / (100 + percent) of their sizes' sum, so
    the sketches in no more places; for large sets in about places / 2 * (1 - exp(-2 * elements / places)) with a deviation under 16."""
    places = 64 * ODD
    most = (F.col(f"{a}.n") + F.col(f"{b}.n")) * F.lit((100 - percent) / (100 + percent))
    expected = F.lit(places / 2) * (F.lit(1.0) - F.exp(most * F.lit(-2 / places)))
    differ = sum((F.bit_count(F.get(f"{a}.odd", F.lit(i)).bitwiseXOR(F.get(f"{b}.odd", F.lit(i)))) for i in range(ODD)), F.lit(0))
    return differ <= F.least(most, expected + F.lit(6.0 * (places**0.5) / 2))


def _cross(left: DataFrame, right: DataFrame, percent: int, many: str | None = None) -> DataFrame:
    """Pairs (hub, spoke) of a row of left and one of right in the same node, of different components, that may be near."""
    return meet(left, right, _may_be_near("x", "y", percent) & _sets_may_be_near("x", "y", percent), many)


def _once(pairs: DataFrame) -> DataFrame:
    """Pairs (hub, spoke) with their ordered ids (a, b), each pair once, whichever of the two is the hub."""
    return pairs.withColumns({"a": F.least("hub", "spoke"), "b": F.greatest("hub", "spoke")}).dropDuplicates(["a", "b"])


def _confirm(pairs: DataFrame, reps: DataFrame, docs: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs (hub, spoke) whose full sets reach the threshold, as (a, b). Only documents that are in a pair have their sets made again.

    Hubs are dealt into places. A set travels once to each place where a hub of
    it is, and not once a pair; hubs with very many pairs have several places,
    which share the spokes. A task holds one place's hubs while spokes stream by.
    """
    load = pairs.select(F.col("hub").alias("id")).distinct().join(reps.select("id", "n"), "id").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    hot = cut(pairs.groupBy("hub").agg(F.ceil(F.count("*") / HOT).cast("int").alias("salts")).filter("salts > 1"))
    # At most one hub for every HOT pairs.
    dealt = pairs.join(F.broadcast(hot), "hub", "left").withColumn("salts", F.coalesce("salts", F.lit(1))) if hot.limit(1).count() else pairs.withColumn("salts", F.lit(1))
    dealt = dealt.withColumn("place", F.pmod(F.xxhash64(F.lit("place"), "hub"), F.lit(1 + load // PLACE)))
    spokes = dealt.groupBy(F.col("spoke").alias("id"), "place", F.pmod(F.xxhash64(F.lit("salt"), "spoke"), F.col("salts")).cast("int").alias("salt")).agg(F.collect_list("hub").alias("hubs"))
    hubs = dealt.select(F.col("hub").alias("id"), "place", "salts").distinct().select("id", "place", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), F.lit(None).cast("array<bigint>").alias("hubs"))
    wanted = spokes.unionByName(hubs).groupBy("id").agg(F.collect_list(F.struct("place", "salt", "hubs")).alias("places"))
    wanted = cut(wanted.join(reps.select("id", "doc", "s1"), "id"))
    # What would be sent, places and the hubs listed in them, is weighed.
    size = F.aggregate("places", F.lit(64), lambda sum, x: sum + 48 + 8 * F.coalesce(F.size(x["hubs"]), F.lit(0)))
    few = wanted.agg(F.coalesce(F.sum(size), F.lit(0))).first()[0] <= MAX_BROADCAST_BYTES
    texts = docs.join(F.broadcast(wanted) if few else wanted, docs["doc_id"] == wanted["doc"]).select("id", "s1", "places", "text")
    place = "place bigint, salt int, hubs array<bigint>"
    sets = texts.mapInArrow(_sets(words), f"id bigint, places array<struct<{place.replace(' ', ': ').replace(',:', ',')}>>, shingles array<bigint>")
    rows = sets.select("id", "shingles", F.inline("places")).repartition("place", "salt").sortWithinPartitions("place", "salt", F.col("hubs").isNotNull())
    return rows.select("place", "salt", "hubs", "id", "shingles").mapInArrow(_near(percent), "a bigint, b bigint").distinct()


def near_dedup(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, trees: int = TREES, small_node: int = SMALL_NODE, depth_limit: int = DEPTH) -> DataFrame:
    """One row for each row of docs(doc_id, text, ...): doc_id, n_shingles, component_id, kept.

    Documents are linked when their sets of shingles (A-Z lower-cased words, the
    whole sequence of shorter texts) overlap by at least percent of their union.
    component_id is the smallest doc_id that links reach; kept marks its own row.
    Null, empty and wordless texts are linked with nothing. Rows that repeat a
    doc_id are one document if their text is the same, else documents of their
    own: they are linked only if their texts are, and each has its own text's
    component_id. doc_id must not be null for a row to be linked. Other columns
    of docs are ignored; no rows give none.
    """
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    schema = "doc_id bigint, n bigint, s1 bigint, s2 bigint, b1 bigint, b2 bigint, tokens array<bigint>, odd array<bigint>"
    made = cut(docs.mapInArrow(_sketches(words), schema))
    # One representative for each set: the smallest doc_id. A group of equal texts of any size is a map-side minimum.
    least = made.filter("n > 0 and doc_id is not null").groupBy("s1", "s2").agg(F.min(F.struct("doc_id", "n", "b1", "b2", "tokens", "odd")).alias("r"))
    reps = cut(least.select("s1", "s2", F.col("r.doc_id").alias("id"), F.col("r.doc_id").alias("doc"), "r.n", "r.b1", "r.b2", "r.tokens", "r.odd"))
    clash = reps.groupBy("id").agg(F.count("*").alias("k")).filter("k > 1").limit(1).count() > 0
    if clash:
        # One doc_id stands for several sets: they are numbered in its place. Partitions of a sorted table follow each other, and so do the numbers.
        reps = cut(reps.orderBy("doc", "s1", "s2").withColumn("id", F.monotonically_increasing_id()))
    tokens = reps.select("id", "tokens")
    rooted = tokens.select("id", F.posexplode(F.slice("tokens", 1, trees)).alias("tree", "token")).select("id", F.xxhash64("tree", "token").alias("node"))
    lean = reps.select("id", "n", "b1", "b2")
    count = rooted.join(lean, "id").groupBy("node").agg(F.count("*").alias("k"), F.min(F.struct(F.xxhash64("node", "id"), "id", "n", "b1", "b2")).alias("centre"))
    rows = cut(rooted.join(lean, "id").join(count.filter("k > 1").drop("k"), "node"))
    star = rows.select("node", "centre", F.struct("id", "n", "b1", "b2").alias("m")).filter("m.id <> centre.id").filter(_may_be_near("centre", "m", percent))
    pairs = cut(_once(star.select(F.col("centre.id").alias("hub"), F.col("m.id").alias("spoke"))))
    links = cut(_confirm(pairs, reps, docs, words, percent))
    rows = open_nodes(rows.select("id", "n", "b1", "b2", "node"), components(links), reps.select("id", "odd"))
    large = rows.filter(F.col("minor") > small_node)
    if large.limit(1).count():
        # Groups of many near copies: several more centres each, so that few members stay outside the largest component.
        slot = F.pmod(F.xxhash64(F.lit("slot"), "id"), F.lit(CENTRES))
        centres = large.groupBy("node", slot.alias("slot")).agg(F.min(F.struct(F.xxhash64("node", "id"), "id", "n", "b1", "b2", "odd", "component", "members")).alias("c")).select("node", "c.*")
        met = cut(_once(_cross(centres, large, percent)).join(pairs.select("a", "b"), ["a", "b"], "left_anti"))
        links = cut(links.unionByName(_confirm(met, reps, docs, words, percent)))
        pairs = cut(pairs.unionByName(met))
        rows = open_nodes(rows.select("id", "n", "b1", "b2", "odd", "node"), components(links))
    more = None
    for depth in range(1, depth_limit + 1):
        last = depth == depth_limit
        small = rows if last else rows.filter(F.col("minor") <= small_node)
        cross = _cross(small.filter("component <> major"), small, percent, "minor")
        more = cross if more is None else more.unionByName(cross)
        large = rows.filter(F.col("minor") > small_node)
        if last or large.limit(1).count() == 0:
            break
        pick = F.sequence(F.lit(1), F.lit(BRANCHES))
        wide = large.join(tokens, "id").select("id", "n", "b1", "b2", "odd", "component", "node", "tokens", F.explode(pick).alias("branch"))
        place = (F.pmod(F.xxhash64("node", "branch"), F.lit(TOKENS)) + 1).cast("int")
        rows = open_nodes(wide.select("id", "n", "b1", "b2", "odd", "component", F.xxhash64("node", "branch", F.element_at("tokens", place)).alias("node")))
    more = cut(_once(more).join(pairs.select("a", "b"), ["a", "b"], "left_anti"))
    if more.limit(1).count():
        links = cut(links.unionByName(_confirm(more, reps, docs, words, percent)))
    group = components(links)
    named = reps.select("s1", "s2", "id").join(group, "id", "left").select("s1", "s2", F.coalesce("component", "id").alias("component_id"))
    if clash:
        named = named.join(reps.select(F.col("id").alias("component_id"), "doc"), "component_id").select("s1", "s2", F.col("doc").alias("component_id"))
    out = made.select("doc_id", "n", "s1", "s2").join(named, ["s1", "s2"], "left")
    label = F.when((F.col("n") > 0) & F.col("doc_id").isNotNull(), F.col("component_id")).otherwise(F.col("doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), label.alias("component_id"), (F.coalesce(F.col("doc_id") == label, F.lit(True))).alias("kept"))


def drop_near(docs: DataFrame) -> DataFrame:
    """One row of each component of near_dedup: that of the smallest doc_id.

    Rows that repeat both doc_id and text are one row, the smallest by their other
    columns. Another text of the same doc_id, and a text without one, is a
    document of its own and takes part in the components; of one doc_id the
    smallest hash comes first, and rows without one come last.
    """
    own, h, r, n, kept = (unused(c, docs) for c in ("own_id", "text_hash", "whole_row", "number", "kept_id"))
    odd = docs.groupBy("doc_id").agg(F.count("*").alias("n")).filter("n > 1 or doc_id is null")
    if odd.limit(1).count() == 0:
        keep = near_dedup(docs).filter("kept").select(F.col("doc_id").alias(kept))
        return docs.join(keep, docs["doc_id"] == keep[kept], "left_semi").select(*docs.columns)
    # A pair that repeats often is a map-side minimum. Partitions of a sorted table follow each other, and so do the numbers.
    one = docs.groupBy(F.col("doc_id").alias(own), F.md5("text").alias(h)).agg(F.min(F.struct(*docs.columns)).alias(r))
    rows = cut(one.orderBy(F.col(own).asc_nulls_last(), h).select(F.monotonically_increasing_id().alias(n), f"{r}.*"))
    keep = near_dedup(rows.select(F.col(n).alias("doc_id"), "text")).filter("kept").select(F.col("doc_id").alias(kept))
    return rows.join(keep, F.col(n) == F.col(kept), "left_semi").select(*docs.columns)


def op2_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup(documents(spark, sf_dir))


OP2_SQL = r"""
with recursive w as (select doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') as w from documents),
s as (select distinct doc_id, array_to_string(w[p : p + 4], ' ') as g from (select doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) as p from w where len(w) > 0)),
n as (select doc_id, count(*) as n from s group by 1),
i as (select a.doc_id as a, b.doc_id as b, count(*) as i from s a join s b on a.g = b.g and a.doc_id <> b.doc_id group by all),
e as materialized (select a, b from i join n x on a = x.doc_id join n y on b = y.doc_id where 100 * i >= 75 * (x.n + y.n - i)),
r(id, c) as (select doc_id, doc_id from documents union select e.b, r.c from r join e on e.a = r.id),
m as (select id, min(c) as c from r group by id)
select d.doc_id, coalesce(n.n, 0) as n_shingles, m.c as component_id, d.doc_id = m.c as kept
from documents d join m on m.id = d.doc_id left join n on n.doc_id = d.doc_id"""
