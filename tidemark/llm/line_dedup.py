"""Operator 1, line dedup: a sharded minimal perfect hash over line hashes, probed by the documents.

Lines become 128-bit hashes. One map-side aggregate per hash gives its number of
documents and its largest doc_id. The hashes of more than one document (no
threshold drops a line of a single one) are dealt into shards by their own bits,
so that no shard can be hot, and each shard turns them into a minimal perfect
hash (levels of bits, ranked by running popcounts) with arrays of fingerprints,
counts (saturated at 65,535) and largest ids at the places it gives. Documents
then probe the arrays: a line goes if its fingerprint is there, its count
reaches the threshold and the largest id is another. While the index is small it is sent to every
executor and the probe is a pass over the documents without a shuffle; beyond
`max_broadcast_bytes` the documents' hashes travel to the shards instead, and
only the hits travel back.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import MAX_BROADCAST_BYTES, WHITE_SPACE, cut, documents, unused

MIN_CHARS, MIN_DOCS = 40, 5
#: Documents from which on a key has a place in the index; the largest number that its array of counts holds.
INDEXED, MOST = 2, 65_535
#: Keys that one shard holds, about.
SHARD_KEYS = 250_000
#: Probes that one task of the shuffled path takes, about.
PROBES = 2_000_000
#: Bits of a level for each key that reaches it.
GAMMA = 2.0
MAX_LEVELS = 64
_MASK = (1 << 64) - 1


def line_key(line: str) -> bytes:
    return line.strip(WHITE_SPACE).encode("utf-8", "surrogatepass").lower()


def line_hashes(lines: list[str], min_chars: int) -> list[int]:
    """A 128-bit hash for every line, 0 for lines whose key is too short."""
    out = []
    for x in lines:
        x = x.strip(WHITE_SPACE)
        out.append(xxhash.xxh3_128_intdigest(x.encode("utf-8", "surrogatepass").lower()) or 1 if len(x) >= min_chars else 0)
    return out


def halves(hashes: list[int]) -> tuple[np.ndarray, np.ndarray]:
    return np.array([h >> 64 for h in hashes], np.uint64), np.array([h & _MASK for h in hashes], np.uint64)


def _place(high: np.ndarray, level: int, size: int) -> np.ndarray:
    x = high + np.uint64((0x9E3779B97F4A7C15 * (level + 1)) & _MASK)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return (x ^ (x >> np.uint64(31))) % np.uint64(size)


class Shard:
    """A minimal perfect hash over keys' high halves, with arrays at the places it gives.

    Level k holds a bit for each place that exactly one of the keys still
    without a place falls on; the others go to level k + 1. A key's place is the
    number of bits set before its own.
    """

    def __init__(self, levels: list[np.ndarray], prints: np.ndarray, counts: np.ndarray, largest: np.ndarray):
        self.levels, self.prints, self.counts, self.largest = levels, prints, counts, largest
        self.ranks, before = [], 0
        for bits in levels:
            run = np.concatenate(([0], np.cumsum(np.bitwise_count(bits), dtype=np.int64)[:-1])) + before
            self.ranks.append(run)
            before += int(np.bitwise_count(bits).sum())

    @classmethod
    def build(cls, high: np.ndarray, low: np.ndarray, counts: np.ndarray, largest: np.ndarray) -> Shard:
        levels, left = [], np.unique(high)
        if len(left) != len(high):
            raise ValueError("two keys share the half that places them")
        while len(left):
            if len(levels) == MAX_LEVELS:
                raise RuntimeError("the perfect hash did not settle")
            words = max(1, int(np.ceil(GAMMA * len(left) / 64)))
            at = _place(left, len(levels), words * 64)
            place, first, times = np.unique(at, return_index=True, return_counts=True)
            alone = place[times == 1]
            bits = np.zeros(words, np.uint64)
            np.bitwise_or.at(bits, (alone >> np.uint64(6)).astype(np.int64), np.uint64(1) << (alone & np.uint64(63)))
            levels.append(bits)
            taken = np.zeros(len(left), bool)
            taken[first[times == 1]] = True
            left = left[~taken]
        shard = cls(levels, low, counts, largest)
        order = np.argsort(shard.places(high))
        shard.prints, shard.counts, shard.largest = low[order], np.minimum(counts[order], MOST).astype(np.uint16), largest[order]
        return shard

    def places(self, high: np.ndarray) -> np.ndarray:
        """Each key's place; -1 for some keys that are not of the shard, any place for others."""
        out, todo = np.full(len(high), -1, np.int64), np.arange(len(high))
        for level, (bits, rank) in enumerate(zip(self.levels, self.ranks, strict=True)):
            at = _place(high[todo], level, len(bits) * 64)
            word, bit = (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63)
            here = (bits[word] >> bit) & np.uint64(1) == 1
            below = np.bitwise_count(bits[word] & ((np.uint64(1) << bit) - np.uint64(1)))
            out[todo[here]] = (rank[word] + below)[here]
            todo = todo[~here]
            if not len(todo):
                break
        return out

    def probe(self, high: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The number of documents of each key by the arrays, 0 where the fingerprint is another, and the largest doc_id of those."""
        if not len(self.prints):
            return np.zeros(len(high), np.int64), np.zeros(len(high), np.int64)
        at = self.places(high)
        hit = (at >= 0) & (self.prints[at] == low)
        return np.where(hit, self.counts[at], 0).astype(np.int64), np.where(hit, self.largest[at], 0)

    def to_bytes(self) -> bytes:
        head = np.array([len(self.prints), len(self.levels), *(len(x) for x in self.levels)], np.int64)
        return b"".join(x.tobytes() for x in (head, *self.levels, self.prints, self.counts, self.largest))

    @classmethod
    def from_bytes(cls, blob: bytes) -> Shard:
        n, k = np.frombuffer(blob, np.int64, 2)
        sizes, at, parts = np.frombuffer(blob, np.int64, k, 16), 16 + 8 * int(k), []
        for size, kind in [*((s, np.uint64) for s in sizes), (n, np.uint64), (n, np.uint16), (n, np.int64)]:
            parts.append(np.frombuffer(blob, kind, size, at))
            at += np.dtype(kind).itemsize * int(size)
        return cls(parts[:-3], *parts[-3:])


#: Stands for a null doc_id, which is smaller than every other.
NO_ID = -(1 << 63)


def _emit(min_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            high, low, ids = [], [], []
            for doc, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                found = {h for h in line_hashes((text or "").split("\n"), min_chars) if h}
                hi, lo = halves(list(found))
                high.append(hi)
                low.append(lo)
                ids.append(np.full(len(hi), NO_ID if doc is None else doc, np.int64))
            for k in range(0, len(high), 500):
                cols = [np.concatenate(x[k : k + 500]).view(np.int64) for x in (high, low, ids)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], ["high", "low", "doc"])

    return run


def line_counts(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(high, low, n, largest) for every line key: its hash, its number of documents, the largest doc_id that holds it."""
    rows = docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(_emit(min_chars), "high bigint, low bigint, doc bigint")
    return rows.groupBy("high", "low").agg(F.count("*").alias("n"), F.max("doc").alias("largest"))


def build_index(counts: DataFrame, shard_keys: int = SHARD_KEYS) -> tuple[DataFrame, int]:
    """(shard, keys, index) and the number of shards: one perfect hash with its arrays for each shard of counts, written to the checkpoint folder."""
    keys = cut(counts)
    shards = max(1, -(-keys.count() // shard_keys))

    def make(pdf):
        high, low = (pdf[c].to_numpy().view(np.uint64) for c in ("high", "low"))
        shard = Shard.build(high, low, pdf["n"].to_numpy(), pdf["largest"].to_numpy())
        return pdf.iloc[:1].assign(index=[shard.to_bytes()], keys=[len(pdf)])[["shard", "keys", "index"]]

    dealt = keys.withColumn("shard", F.pmod("low", F.lit(shards)))
    return cut(dealt.groupBy("shard").applyInPandas(make, "shard bigint, keys bigint, index binary")), shards


def _clean(doc: int | None, text: str | None, hashes: list[int], dropped: set[int]) -> tuple[int, int, str]:
    lines = (text or "").split("\n")
    kept = [x for x, h in zip(lines, hashes, strict=True) if h not in dropped]
    return len(lines), len(lines) - len(kept), "\n".join(kept)


def _probe_sent(sent, shards: int, min_docs: int, min_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = {k: Shard.from_bytes(x) for k, x in sent.value}
        for b in batches:
            table = pa.Table.from_batches([b])
            for k in range(0, b.num_rows, 500):
                part = table.slice(k, 500)
                docs, texts = part.column("doc_id").to_pylist(), part.column("text").to_pylist()
                hashes = [line_hashes((t or "").split("\n"), min_chars) for t in texts]
                flat, owner = [h for x in hashes for h in x if h], [NO_ID if d is None else d for d, x in zip(docs, hashes, strict=True) for h in x if h]
                high, low = halves(flat)
                gone = np.zeros(len(flat), bool)
                to = (low.view(np.int64) % shards).astype(np.int64)
                for s in np.unique(to):
                    if s in index:
                        at = np.flatnonzero(to == s)
                        held, largest = index[s].probe(high[at], low[at])
                        gone[at] = (held >= min_docs) & (largest != np.array(owner, np.int64)[at])
                drop, at, out = gone.tolist(), 0, []
                for d, t, x in zip(docs, texts, hashes, strict=True):
                    dead = set()
                    for h in x:
                        if h:
                            if drop[at]:
                                dead.add(h)
                            at += 1
                    out.append(_clean(d, t, x, dead))
                for name, kind, i in (("n_lines", pa.int64(), 0), ("n_dropped", pa.int64(), 1), ("kept_text", pa.string(), 2)):
                    part = part.append_column(name, pa.array([o[i] for o in out], kind))
                yield from part.combine_chunks().to_batches()

    return run


def _hits(docs: DataFrame, index: DataFrame, shards: int, min_docs: int, min_chars: int) -> DataFrame:
    """(doc, high, low) of the lines to drop, found in the shards' own tasks.

    The index is cut further by salting: each of a shard's salts holds a copy of
    that shard alone and an equal part of the probes.
    """
    rows = docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(_emit(min_chars), "high bigint, low bigint, doc bigint")
    rows = rows.withColumn("shard", F.pmod("low", F.lit(shards)))

    def look(key, left, right):
        high, low, doc = (left[c].to_numpy() for c in ("high", "low", "doc"))
        if not len(right) or not len(left):
            return left[["doc", "high", "low"]].iloc[:0]
        held, largest = Shard.from_bytes(right["index"].iloc[0]).probe(high.view(np.uint64), low.view(np.uint64))
        return left[["doc", "high", "low"]][(held >= min_docs) & (largest != doc)]

    most = max(1, rows.groupBy("shard").agg(F.count("*").alias("k")).agg(F.coalesce(F.max("k"), F.lit(0))).first()[0])
    salts = -(-most // PROBES)
    spread = F.sequence(F.lit(0), F.lit(salts - 1))
    left = rows.withColumn("salt", F.pmod(F.xxhash64("doc"), F.lit(salts)).cast("int"))
    right = index.select("shard", "index", F.explode(spread).alias("salt"))
    return left.groupBy("shard", "salt").cogroup(right.groupBy("shard", "salt")).applyInPandas(look, "doc bigint, high bigint, low bigint")


def _drop_hits(gone_name: str, min_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            table, out = pa.Table.from_batches([b]), []
            for d, t, gone in zip(*(table.column(c).to_pylist() for c in ("doc_id", "text", gone_name)), strict=True):
                dead = {((x["high"] & _MASK) << 64) | (x["low"] & _MASK) for x in gone or ()}
                out.append(_clean(d, t, line_hashes((t or "").split("\n"), min_chars), dead))
            table = table.drop_columns([gone_name])
            for name, kind, i in (("n_lines", pa.int64(), 0), ("n_dropped", pa.int64(), 1), ("kept_text", pa.string(), 2)):
                table = table.append_column(name, pa.array([o[i] for o in out], kind))
            yield from table.combine_chunks().to_batches()

    return run


def line_dedup(docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS, max_broadcast_bytes: int = MAX_BROADCAST_BYTES, shard_keys: int = SHARD_KEYS) -> DataFrame:
    """docs(doc_id, text, ...) with n_lines, n_dropped and kept_text.

    A line's key is the line stripped of white space, A-Z lower-cased. Keys of at
    least min_chars code points that at least min_docs rows hold keep their lines
    only in the row of the largest doc_id (each row counts as a document; rows
    that repeat the largest doc_id all keep them; a null doc_id is smaller than
    any other). A null or empty text is one empty line, and stays; a text all of
    whose lines go becomes empty. Columns of docs with the names of new ones are
    replaced; an empty table gives none.
    """
    if not 2 <= min_docs <= MOST:
        raise ValueError(f"min_docs must be from 2 to {MOST}")
    docs = docs.drop("n_lines", "n_dropped", "kept_text")
    index, shards = build_index(line_counts(docs, min_chars).filter(F.col("n") >= INDEXED), shard_keys)
    size = index.agg(F.coalesce(F.sum(F.length("index")), F.lit(0))).first()[0]
    kinds = [f"`{c}` {t}" for c, t in docs.dtypes]
    out = ", ".join([*kinds, "n_lines bigint", "n_dropped bigint", "kept_text string"])
    if size <= max_broadcast_bytes:
        sent = docs.sparkSession.sparkContext.broadcast([(r["shard"], bytes(r["index"])) for r in index.select("shard", "index").collect()])
        return docs.mapInArrow(_probe_sent(sent, shards, min_docs, min_chars), out)
    owner, gone = unused("owner", docs), unused("gone", docs)
    hits = _hits(docs, index, shards, min_docs, min_chars).groupBy(F.col("doc").alias(owner)).agg(F.collect_list(F.struct("high", "low")).alias(gone))
    joined = docs.join(hits, F.coalesce(F.col("doc_id").cast("bigint"), F.lit(NO_ID)) == F.col(owner), "left").drop(owner)
    return joined.mapInArrow(_drop_hits(gone, min_chars), out)


def drop_lines(docs: DataFrame) -> DataFrame:
    """docs with their texts as line_dedup leaves them, and n_chars, where there is one, counted again.

    A null text becomes empty; rows that repeat a doc_id are one document where
    documents are counted, and each loses its lines; no rows give none.
    """
    rows = line_dedup(docs).withColumn("text", F.col("kept_text"))
    if "n_chars" in docs.columns:
        rows = rows.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return rows.select(*docs.columns)


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = line_dedup(documents(spark, sf_dir).select("doc_id", "text"))
    return rows.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


OP1_SQL = r"""
with l as (select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) as pos from documents),
k as (select *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key from l),
c as (select key, max(doc_id) as largest from k where length(key) >= 40 group by key having count(distinct doc_id) >= 5)
select doc_id, count(*) as n_lines, cast(sum(case when largest is not null and doc_id <> largest then 1 else 0 end) as bigint) as n_dropped,
  sha256(coalesce(string_agg(line, chr(10) order by pos) filter (where largest is null or doc_id = largest), '')) as kept_sha256
from k left join c on k.key = c.key group by doc_id"""
