"""Operator 4, document fingerprints: SimHash with permuted block tables.

A text's terms are its words and pairs of neighbouring words, lower-cased; each
term's 128-bit hash votes on every bit with the term's damped count, and the
signs of the sums are the fingerprint. Near fingerprints are found in tables
keyed by every choice of blocks: with more blocks than the radius, two
fingerprints within it agree on some choice. A key's fingerprints are compared
with one of them first, which joins large groups of near copies without all of
their pairs; keys that still hold several components compare the members outside
the largest one with the others, in blocks, and keys with very many of those are
looked up again in tables of more and narrower blocks, whose keys are longer.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import components, cut, documents, lowered_words_of, meet, open_nodes, same

BITS = 128
#: Radius of near fingerprints, and the blocks that its tables choose from: C(4, 1) tables keyed by 32 bits, then C(8, 5) keyed by 80 bits.
RADIUS, BLOCKS = 3, (4, 8)
#: Fingerprints of a key outside its largest component from which on the key's are looked up in the next tables.
CROWDED = 512
#: Documents of one run of neighbouring ids, about, and the most runs that there are.
RUN, MAX_RUNS = 2_000, 100_000
_PAIR = np.uint64(0x9E3779B97F4A7C15)
_OTHER = np.uint64(0xD6E8FEB86659FD93)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def fingerprint(text: str | None) -> bytes:
    """The 16 bytes of a text's fingerprint; all zero for texts without words."""
    words = lowered_words_of(text)
    if not words:
        return bytes(BITS // 8)
    digest = xxhash.xxh3_64_intdigest
    one = np.fromiter((digest(w) for w in words), np.uint64, len(words))
    terms, counts = np.unique(np.concatenate((one, _mix(one[:-1] * _PAIR + one[1:]))), return_counts=True)
    weights = (1 + np.log(counts)).astype(np.float32)
    votes = np.zeros(BITS, np.float64)
    for k in range(0, len(terms), 4096):
        part, w = terms[k : k + 4096], weights[k : k + 4096]
        both = np.stack((_mix(part), _mix(part ^ _OTHER)), axis=1).astype("<u8")
        bits = np.unpackbits(both.view(np.uint8), axis=1).astype(np.float32)
        votes += (w @ bits).astype(np.float64) * 2 - w.sum(dtype=np.float64)
    return np.packbits(votes > 0).tobytes()


def _prints(with_runs):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bounds = with_runs.value
        for b in batches:
            for k in range(0, b.num_rows, 1000):
                part = b.slice(k, 1000)
                texts = ["" if t is None else t for t in part.column("text").to_pylist()]
                ids, at = part.column("doc_id").to_pylist(), part.column("at").to_pylist()
                runs = np.searchsorted(bounds, [(-(1 << 63) if i is None else i) for i in ids], side="left").tolist()
                runs = [own if given is None else given for own, given in zip(runs, at, strict=True)]
                prints = [fingerprint(t).hex() for t in texts]
                cols = [part.column("doc_id"), part.column("at"), pa.array(runs, pa.int64()), pa.array(texts, pa.string()), pa.array(prints, pa.string())]
                yield pa.RecordBatch.from_arrays(cols, ["doc_id", "at", "run", "text", "fingerprint"])

    return run


def _runs(with_runs):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = [(-(1 << 63) if i is None else i) for i in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(np.searchsorted(with_runs.value, ids, side="left"), pa.int64())], ["doc_id", "run"])

    return run


def _ham(a: str, b: str) -> int:
    return (int(a, 16) ^ int(b, 16)).bit_count()


def edited_text(text: str, following: str) -> str:
    """text with its last third replaced by as many characters from the beginning of the following text, or all of them."""
    n = len(text) // 3
    return text[: len(text) - n] + following[:n]


def _edited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        rows = []
        for doc, text, own, head, after in zip(*(b.column(i).to_pylist() for i in range(5)), strict=True):
            changed = edited_text(text, head)
            other = fingerprint(changed).hex() if changed != text else own
            halves = np.frombuffer(bytes.fromhex(own), ">u8").astype(np.uint64).view(np.int64).tolist()
            rows.append((doc, len(text), hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest(), own, other, 1 - _ham(own, other) / BITS, 1 - _ham(own, after) / BITS, *halves))
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64(), pa.int64(), pa.int64()]
        names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "f1", "f2"]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names)


def fingerprint_edits(docs: DataFrame, run: int = RUN) -> DataFrame:
    """One row for each row of docs(doc_id, text, ...): n_chars, edited_sha256, both fingerprints, near_edited, near_next, and the fingerprint as two numbers f1, f2.

    The next document is the one before in the order of ids, and for the smallest
    the largest; rows of one id go by text, a null id is the smallest. A null text
    is empty; the only document is its own next. Other columns are ignored; no
    rows give none. Rows that repeat one id are neighbours in one task, whose
    sort may spill but which holds only two texts at a time.

    Ids are dealt into runs of neighbours at approximate quantiles, so that the
    order never meets in one task; the first document of the run below joins a run
    as its last row, so that one exchange of the texts brings all neighbours together.
    """
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    n = docs.count()
    runs = max(1, min(MAX_RUNS, -(-n // run)))
    cuts = docs.stat.approxQuantile("doc_id", [k / runs for k in range(1, runs)], 0.1 / runs) if runs > 1 else []
    sent = docs.sparkSession.sparkContext.broadcast(np.array(sorted(set(cuts)), np.float64))
    # The first document of each run, found by the ids alone; then its text, of which there is one a run.
    top = docs.select("doc_id").mapInArrow(_runs(sent), "doc_id bigint, run bigint").groupBy("run").agg(F.max("doc_id").alias("id"))
    falling = Window.orderBy(F.col("run").desc())
    follow = top.select("run", F.coalesce(F.lead("id").over(falling), F.max("id").over(Window.partitionBy())).alias("id"))
    heads = docs.join(F.broadcast(follow), same(F.col("doc_id"), F.col("id"))).groupBy("run").agg(F.max(F.coalesce("text", F.lit(""))).alias("text"))
    heads = cut(heads.select(F.lit(None).cast("bigint").alias("doc_id"), "text", F.col("run").alias("at")))
    rows = docs.withColumn("at", F.lit(None).cast("bigint")).unionByName(heads)
    made = rows.mapInArrow(_prints(sent), "doc_id bigint, at bigint, run bigint, text string, fingerprint string")
    # A run's own rows come first, then the head of the run below, which only serves as the last one's next.
    w = Window.partitionBy("run").orderBy(F.col("at").isNotNull(), F.col("doc_id").desc_nulls_last(), F.col("text").desc())
    led = made.withColumns({"next": F.lead("text").over(w), "after": F.lead("fingerprint").over(w)}).filter("at is null")
    # Only as much of the next text as the edit needs goes on.
    head = F.substring(F.col("next"), F.lit(1), F.floor(F.length("text") / 3).cast("int")).alias("head")
    schema = "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, f1 bigint, f2 bigint"
    return led.select("doc_id", "text", "fingerprint", head, "after").mapInArrow(_edited, schema)


def _block(k: int, blocks: int) -> Column:
    """Block k of a fingerprint: bits k * width and on of its 128, as a number; blocks never straddle the two halves."""
    half = blocks // 2
    width = 64 // half
    own = F.col("f1") if k < half else F.col("f2")
    return F.shiftrightunsigned(F.shiftleft(own, (k % half) * width), 64 - width)


def _tables(prints: DataFrame, blocks: int, radius: int) -> DataFrame:
    """(node, id): each fingerprint's keys in the tables of every choice of blocks - radius blocks."""
    keys = [F.xxhash64(F.lit(blocks), F.lit(i), *[_block(k, blocks) for k in chosen]) for i, chosen in enumerate(combinations(range(blocks), blocks - radius))]
    return prints.select("id", F.explode(F.array(*keys)).alias("node"))


def near_classes(prints: DataFrame, radius: int = RADIUS, blocks: tuple[int, ...] = BLOCKS, crowded: int = CROWDED) -> DataFrame:
    """(f1, f2, class_id) for every fingerprint of prints(doc_id, f1, f2, ...): the smallest doc_id that steps of at most radius bits reach.

    Fingerprints within the radius differ in at most radius of the blocks, so
    they agree on some choice of the others; each choice is a table that both
    are looked up in, so that no link is lost. Equal fingerprints are one.
    Left out are null doc_ids and fingerprints of texts without words, which are
    all zero and near nothing. blocks are the numbers of blocks of the tables to
    try one after the other: even, dividing 128, over the radius, at most 64 bits
    wide. Members of a key of the last table that lie outside its largest class
    meet all of the key's: that is quadratic where thousands of different texts
    share 80 bits, and the price of losing no link.
    """
    if any(not 0 < radius < n or n % 2 or 64 % (n // 2) for n in blocks):
        raise ValueError("blocks must be even, divide 128 and exceed the radius")
    some = prints.filter("doc_id is not null and (f1 <> 0 or f2 <> 0)")
    own = cut(some.groupBy("f1", "f2").agg(F.min("doc_id").alias("id")))
    clash = own.groupBy("id").agg(F.count("*").alias("k")).filter("k > 1").limit(1).count() > 0
    own = own.withColumn("doc", F.col("id"))
    if clash:
        # One doc_id stands for several fingerprints: they are numbered in its place, in the order of ids.
        own = cut(own.orderBy("doc", "f1", "f2").withColumn("id", F.monotonically_increasing_id()))
    bits = lambda a, b: F.bit_count(F.col(f"{a}.f1").bitwiseXOR(F.col(f"{b}.f1"))) + F.bit_count(F.col(f"{a}.f2").bitwiseXOR(F.col(f"{b}.f2")))
    links, left = None, own
    for level, n in enumerate(blocks):
        found = _tables(left, n, radius)
        shared = found.groupBy("node").agg(F.count("*").alias("k")).filter("k > 1").select("node")
        rows = cut(found.join(shared, "node", "left_semi").join(own.select("id", "f1", "f2"), "id"))
        centre = rows.groupBy("node").agg(F.min(F.struct(F.xxhash64("node", "id"), "id", "f1", "f2")).alias("x"))
        star = rows.alias("y").join(centre, "node").filter((F.col("x.id") != F.col("y.id")) & (bits("x", "y") <= radius))
        star = star.select(F.least("x.id", "y.id").alias("a"), F.greatest("x.id", "y.id").alias("b")).distinct()
        links = cut(star if links is None else links.unionByName(star).distinct())
        rows = open_nodes(rows, components(links))
        last = level == len(blocks) - 1
        few = rows if last else rows.filter(F.col("minor") <= crowded)
        met = meet(few.filter("component <> major"), few, bits("x", "y") <= radius, "minor")
        links = cut(links.unionByName(met.select(F.least("hub", "spoke").alias("a"), F.greatest("hub", "spoke").alias("b"))).distinct())
        if last:
            break
        left = cut(rows.filter(F.col("minor") > crowded).select("id", "f1", "f2").distinct())
        if left.limit(1).count() == 0:
            break
    group = components(links)
    named = own.join(group, "id", "left").select("f1", "f2", F.coalesce("component", "id").alias("class_id"))
    if clash:
        named = named.join(own.select(F.col("id").alias("class_id"), "doc"), "class_id").select("f1", "f2", F.col("doc").alias("class_id"))
    return named


def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints and edits of all documents, and class_id, the smallest doc_id of each one's class of near fingerprints (its own for a text without words)."""
    made = cut(fingerprint_edits(documents(spark, sf_dir)))
    classes = near_classes(made).withColumnsRenamed({"f1": "g1", "f2": "g2"})
    joined = made.join(classes, (F.col("f1") == F.col("g1")) & (F.col("f2") == F.col("g2")), "left")
    return joined.withColumn("class_id", F.coalesce("class_id", "doc_id")).drop("f1", "f2", "g1", "g2")
