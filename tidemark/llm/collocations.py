"""Operator 12, phrase collocation mining: Rabin-Karp fingerprints of every n-gram by numpy prefix polynomials.

Texts lie side by side in one buffer. A prefix polynomial over the bytes gives
each word's hash as a difference of two places, one over the words' hashes each
n-gram's, whatever n is. A fingerprint has a second half, made in the same way of
the words' ends and lengths beside their hashes, so that two phrases are told
apart by 128 bits.

A first pass only counts into tables of bounded size, a table for each length,
at the slots that the fingerprints name. A phrase is at most as frequent as its
slot and as the phrases inside it, so the second pass gathers only those whose
slots all reach the threshold: a slot that others fill costs work and changes no
count. (They prune while there are fewer than about `least` words a slot; more
slots take memory in every worker, `longest` bytes each.) The shuffle brings
tasks' counts together by parts of the fingerprints' space, as blocks, and adds
up, per fingerprint, the number and one occurrence as a pointer (text, byte). Only
phrases found frequent are read from the texts again; what stands at a pointer
must have the fingerprint that it was counted under.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import KeyBits, cut, documents, only

LEAST, LONGEST, TOP = 100, 5, 2000
#: Bytes of text hashed at a time, and fingerprints a task gathers before it counts them and before it hands them on.
STRETCH, GATHERED, HANDED = 1 << 20, 600_000, 1_000_000
#: Phrases read from texts at a time.
PHRASES = 5_000
#: Slots of a length's table, a byte each, and of one segment of it; the largest count that a slot holds.
SLOTS, SEGMENT, FULL = 1 << 24, 1 << 14, 255
_SPACE, _BREAK = 1, 2
#: Behind these a phrase ends.
_ENDS = re.compile(rb"[.,;:!?\x0A-\x0D]")
_KIND = np.zeros(256, np.uint8)
_KIND[[0x20, 0x09]] = _SPACE
_KIND[list(b".,;:!?\x0a\x0b\x0c\x0d")] = _BREAK
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
_SEEDS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_FULL = (1 << 64) - 1


def mixed(x: np.ndarray) -> np.ndarray:
    """Bits of 64-bit numbers stirred, one to one."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


class Polynomial:
    """Prefix sums of value * base ** place modulo 2 ** 64; a stretch's hash is a difference, moved to place 0."""

    def __init__(self, seed: int):
        self.base = seed | 1
        self.inverse = pow(self.base, -1, 1 << 64)
        self.up = self.down = np.ones(1, np.uint64)

    def _powers(self, n: int) -> None:
        while len(self.up) <= n:
            k = len(self.up)
            self.up = np.concatenate([self.up, self.up * np.uint64(pow(self.base, k, 1 << 64))])
            self.down = np.concatenate([self.down, self.down * np.uint64(pow(self.inverse, k, 1 << 64))])

    def prefix(self, values: np.ndarray) -> np.ndarray:
        self._powers(len(values))
        out = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * self.up[: len(values)], out=out[1:])
        return out

    def between(self, prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return (prefix[ends] - prefix[starts]) * self.down[starts]


@cache
def _hashes() -> tuple[Polynomial, tuple[Polynomial, Polynomial], np.ndarray]:
    """The polynomial over bytes, those over words for either half of a fingerprint, and the bytes' values. Made once in each worker."""
    bases = mixed(np.arange(1, 4, dtype=np.uint64) * np.uint64(_SEEDS[0])).tolist()
    values = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(_SEEDS[1])) | np.uint64(1)
    return Polynomial(bases[0]), (Polynomial(bases[1]), Polynomial(bases[2])), values


class Words:
    """Words of texts that lie in one buffer, text k from edges[k] on, and the fingerprints of their n-grams."""

    def __init__(self, raw: np.ndarray, edges: np.ndarray, languages: np.ndarray, names: list[str] | None = None):
        low = _LOWER[raw]
        self.names = names
        kind = _KIND[low]
        word = kind == 0
        new = np.zeros(len(raw) + 1, bool)
        new[edges] = True
        begins = word.copy()
        begins[1:] &= ~word[:-1] | new[1:-1]
        ends = word.copy()
        ends[:-1] &= ~word[1:] | new[1:-1]
        self.starts, ends = np.flatnonzero(begins), np.flatnonzero(ends) + 1
        self.text = np.searchsorted(edges, self.starts, side="right") - 1
        self.piece = np.cumsum(kind == _BREAK)[self.starts] + self.text
        self.language = languages
        in_bytes, over_words, values = _hashes()
        one = mixed(in_bytes.between(in_bytes.prefix(values[low]), self.starts, ends))
        # Words of up to 16 bytes are their first and last eight and their length; zeros stand in where the buffer ends.
        padded = np.zeros(len(low) + 15, np.uint8)
        padded[7:-8] = low
        eight = np.ndarray((len(low) + 8,), "<u8", padded.data, 0, (1,))
        size = np.minimum(ends - self.starts, 8)
        shift = ((8 - size) * 8).astype(np.uint64)
        other = mixed(eight[self.starts + 7] << shift) + mixed((eight[ends - 1] >> shift) ^ np.uint64(_SEEDS[1])) + (ends - self.starts).astype(np.uint64) * np.uint64(_SEEDS[0])
        two = mixed(other) ^ one
        self.hashes = [(p, p.prefix(w)) for p, w in zip(over_words, (one, two), strict=True)]

    def places(self, n: int) -> np.ndarray:
        """First words of the n-grams, none of which leaves its piece."""
        if len(self.starts) < n:
            return np.empty(0, np.int64)
        return np.flatnonzero(self.piece[n - 1 :] == self.piece[: len(self.piece) - n + 1])

    def prints(self, n: int, at: np.ndarray, half: int) -> np.ndarray:
        over_words, prefix = self.hashes[half]
        return mixed(over_words.between(prefix, at, at + n) + self.language[self.text[at]] + np.uint64(n * 0xD6E8FEB86659FD93 & _FULL))


def language_value(lang: str) -> int:
    return xxhash.xxh3_64_intdigest(lang.encode("utf-8", "surrogatepass"))


def _stretches(raw: np.ndarray, edges: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(bytes, edges, numbers of texts, bytes before each text's part) of about STRETCH bytes; a longer text is cut behind a mark that ends a piece."""
    k = 0
    while k + 1 < len(edges):
        j = max(k + 1, int(np.searchsorted(edges, edges[k] + STRETCH, side="right")) - 1)
        if j == k + 1 and edges[j] - edges[k] > STRETCH:
            text, begin = raw[edges[k] : edges[j]], 0
            while begin < len(text):
                end = min(begin + STRETCH, len(text))
                while end < len(text):
                    last = np.flatnonzero(_KIND[text[begin:end]] == _BREAK)
                    if len(last):
                        end = begin + int(last[-1]) + 1
                        break
                    end = min(end + STRETCH, len(text))
                yield text[begin:end], np.array([0]), np.array([k]), np.array([begin])
                begin = end
        elif edges[j] > edges[k]:
            yield raw[edges[k] : edges[j]], edges[k:j] - edges[k], np.arange(k, j), np.zeros(j - k, np.int64)
        k = j


def _buffer(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of an Arrow column of strings and where each begins, the end last; nulls are empty."""
    if texts.null_count:
        texts = texts.fill_null("")
    wide = pa.types.is_large_string(texts.type)
    edges = np.frombuffer(texts.buffers()[1], np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = texts.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[edges[0] : edges[-1]] if data is not None else np.empty(0, np.uint8)
    return raw, edges - edges[0]


_COUNTS = "print bigint, other bigint, n bigint, k1 bigint, at bigint, lang string"


def _each(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Words, np.ndarray, np.ndarray]]:
    """The words of batches (text, lang, k1), stretch by stretch, with each text's k1 and where its part in the stretch begins in it, counted from the stretch's start."""
    known: dict[str, int] = {}
    for b in batches:
        raw, edges = _buffer(b.column("text"))
        k1 = b.column("k1").to_numpy(zero_copy_only=False)
        names = b.column("lang").to_pylist()
        known.update({x: language_value(x) for x in {*names} - known.keys()})
        for part, begins, texts, before in _stretches(raw, edges):
            languages = [names[k] for k in texts.tolist()]
            yield Words(part, begins, np.array([known[x] for x in languages], np.uint64), languages), k1[texts], before - begins


_TABLES = "n int, segment int, counts binary"


def _sketch(longest: int, slots: int):
    """Counts of slots for each length, full at the largest, in compressed segments."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = np.zeros((longest, slots), np.uint8)
        for words, _, _ in _each(batches):
            for n in range(1, longest + 1):
                at = (words.prints(n, words.places(n), 0) & np.uint64(slots - 1)).astype(np.uint32)
                slot, times = np.unique(at, return_counts=True)
                tables[n - 1, slot] = np.minimum(tables[n - 1, slot] + times, FULL)
        width = min(slots, SEGMENT)
        squeeze = zstandard.ZstdCompressor(1).compress
        rows = []
        for n in range(longest):
            for k in range(slots // width):
                part = tables[n, k * width : (k + 1) * width]
                if part.any():
                    rows.append((n + 1, k, squeeze(part.tobytes())))
        for k in range(0, len(rows), 1000):
            cols = zip(*rows[k : k + 1000], strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(cols, (pa.int32(), pa.int32(), pa.binary()), strict=True)], names=["n", "segment", "counts"])

    return run


def _fill(least: int):
    """Which slots of each segment reach `least`, as bits; the rows of a segment come together, in any order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[int, int], np.ndarray] = {}
        for b in batches:
            for n, k, counts in zip(b.column("n").to_pylist(), b.column("segment").to_pylist(), b.column("counts"), strict=True):
                got = np.frombuffer(zstandard.ZstdDecompressor().decompress(counts.as_py()), np.uint8)
                if (n, k) in sums:
                    sums[n, k] += got
                else:
                    sums[n, k] = got.astype(np.int64)
        keys = [*sums]
        bits = [np.packbits(sums[x] >= least, bitorder="little").tobytes() for x in keys]
        yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in keys], pa.int32()), pa.array([x[1] for x in keys], pa.int32()), pa.array(bits, pa.binary())], names=["n", "segment", "bits"])

    return run


def frequent_slots(docs: DataFrame, least: int, longest: int, slots: int) -> np.ndarray:
    """Bitmaps (longest, slots / 8) of the slots that reach `least` over docs(text, lang, k1): slots bits a length, whatever the data, at most 10 MiB."""
    if least > FULL:
        raise ValueError(f"least is at most {FULL}")
    width = min(slots, SEGMENT)
    out = np.zeros((longest, slots // 8), np.uint8)
    found = docs.mapInArrow(_sketch(longest, slots), _TABLES).repartition("n", "segment").mapInArrow(_fill(least), "n int, segment int, bits binary")
    for r in found.toLocalIterator():
        out[r.n - 1, r.segment * width // 8 : (r.segment + 1) * width // 8] = np.frombuffer(r.bits, np.uint8)
    return out


#: Parts of the fingerprints' space; a task hands on a block of counts for each.
SPACES = 1024
_BLOCKS = "space int, lang string, total bigint, block binary"
Counts = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]


def _merge(parts: list[Counts]) -> Counts:
    """Counts (print, other, n, k1, at) added up by fingerprint, in their order; the occurrence that stays is as good as drawn, so that no text is pointed at by most phrases."""
    a, b, n, k1, at = (np.concatenate(x) for x in zip(*parts, strict=True))
    order = np.lexsort((at, mixed(k1.view(np.uint64) ^ a), b, a))
    a, b = a[order], b[order]
    new = np.ones(len(a), bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    first = np.flatnonzero(new)
    return a[first], b[first], np.add.reduceat(n[order], first) if len(first) else n, k1[order][first], at[order][first]


_NAMES = ["space", "lang", "total", "block"]


def _count(longest: int, sent):
    """Counts the n-grams whose slots, and those of the n-grams inside them, are all marked in the bitmaps sent, as blocks; and words by language."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks = sent.value
        last = np.uint64(marks.shape[1] * 8 - 1)
        squeeze = zstandard.ZstdCompressor(1).compress
        held: list[Counts] = []
        totals: Counter[str] = Counter()
        size = counted = 0

        def blocks(cols: Counts) -> pa.RecordBatch:
            edges = np.searchsorted(cols[0], np.arange(SPACES, dtype=np.uint64) * np.uint64((1 << 64) // SPACES)).tolist() + [len(cols[0])]
            rows = [(k, squeeze(np.concatenate([x[i:j].view(np.int64) for x in cols]).tobytes())) for k, (i, j) in enumerate(zip(edges, edges[1:], strict=False)) if i < j]
            none = pa.nulls(len(rows))
            return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), none.cast(pa.string()), none.cast(pa.int64()), pa.array([r[1] for r in rows], pa.binary())], names=_NAMES)

        for words, k1, shift in _each(batches):
            for k, c in enumerate(np.bincount(words.text, minlength=len(words.names)).tolist()):
                totals[words.names[k]] += c
            ok = np.ones(len(words.starts) + 1, bool)
            for n in range(1, longest + 1):
                at = words.places(n)
                at = at[ok[at] & ok[at + 1]] if n > 1 else at
                prints = words.prints(n, at, 0)
                slot = prints & last
                good = (marks[n - 1, (slot >> np.uint64(3)).astype(np.int64)] >> (slot & np.uint64(7)).astype(np.uint8)) & 1 == 1
                at, prints = at[good], prints[good]
                ok = np.zeros(len(words.starts) + 1, bool)
                ok[at] = True
                text = words.text[at]
                held.append((prints, words.prints(n, at, 1), np.ones(len(at), np.int64), k1[text], (words.starts[at] + shift[text]) << 3 | n))
                size += len(at)
            if size - counted > GATHERED:
                held = [_merge(held)]
                size = counted = len(held[0][0])
                if counted > HANDED:
                    yield blocks(held.pop())
                    size = counted = 0
        if held:
            yield blocks(_merge(held))
        langs = [*totals]
        yield pa.RecordBatch.from_arrays([pa.array([-1] * len(langs), pa.int32()), pa.array(langs, pa.string()), pa.array([totals[x] for x in langs], pa.int64()), pa.nulls(len(langs)).cast(pa.binary())], names=_NAMES)

    return run


def _sum(least: int):
    """The counts of blocks that come together by space, and what of them reaches `least`; and the totals by language, which come with them."""
    names = ["print", "other", "n", "k1", "at", "lang"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spaces: dict[int, list[Counts]] = {}
        totals: Counter[str] = Counter()
        for b in batches:
            for k, lang, total, block in zip(b.column("space").to_pylist(), b.column("lang").to_pylist(), b.column("total").to_pylist(), b.column("block"), strict=True):
                if k < 0:
                    totals[lang] += total
                    continue
                got = np.frombuffer(zstandard.ZstdDecompressor().decompress(block.as_py()), np.int64).reshape(5, -1)
                held = spaces.setdefault(k, [])
                held.append((got[0].view(np.uint64), got[1].view(np.uint64), *got[2:]))
                if len(held) == 64:
                    spaces[k] = [_merge(held)]
        for k in [*spaces]:
            cols = _merge(spaces.pop(k))
            keep = cols[2] >= least
            if keep.any():
                some = [pa.array(x[keep].view(np.int64)) for x in cols]
                yield pa.RecordBatch.from_arrays([*some, pa.nulls(len(some[0])).cast(pa.string())], names=names)
        langs = [*totals]
        none = pa.nulls(len(langs)).cast(pa.int64())
        yield pa.RecordBatch.from_arrays([none, none, pa.array([totals[x] for x in langs], pa.int64()), none, none, pa.array(langs, pa.string())], names=names)

    return run


_PHRASES = "lang string, phrase string, words int, print bigint, other bigint, a bigint, cuts array<struct<k: int, l1: bigint, l2: bigint, r1: bigint, r2: bigint>>"


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The phrases at the pointers of rows (text, lang, wanted), with the fingerprints of all their parts."""
    for b in batches:
        out: list[tuple] = []
        for text, lang, wanted in zip(b.column("text"), b.column("lang").to_pylist(), b.column("wanted"), strict=True):
            raw = text.as_py().encode("utf-8", "surrogatepass")
            for w in wanted.as_py():
                begin, n = w["at"] >> 3, w["at"] & 7
                parts, words, end = [b""], [], begin
                while len(parts) == 1 and len(words) <= n and end < len(raw):
                    end += max(64, 2 * (end - begin))
                    parts = _ENDS.split(raw[begin:end], 1)
                    words = parts[0].split()
                out.append((lang, b" ".join(words[:n]).lower(), n, w["print"], w["other"], w["n"]))
                if len(out) == PHRASES:
                    yield from _with_parts(out)
                    out = []
        yield from _with_parts(out)


def _with_parts(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
    """Rows (lang, phrase, words, print, other, a) whose phrase has that fingerprint, with the fingerprints of all first and last parts."""
    if not rows:
        return
    phrases = [r[1] for r in rows]
    edges = np.cumsum([0, *map(len, phrases)])
    words = Words(np.frombuffer(b"".join(phrases), np.uint8), edges[:-1], np.array([language_value(r[0]) for r in rows], np.uint64))
    first = np.searchsorted(words.text, np.arange(len(rows)))
    n = np.array([r[2] for r in rows])
    halves = []
    right = np.searchsorted(words.text, np.arange(len(rows)), side="right") - first == n
    for half in (0, 1):
        made = np.zeros(len(rows), np.uint64)
        for k in np.unique(n):
            at = np.flatnonzero((n == k) & right)
            made[at] = words.prints(int(k), first[at], half)
        halves.append(made)
        right &= made == np.array([r[3 + half] for r in rows], np.int64).view(np.uint64)
    cuts: list[list[dict]] = [[] for _ in rows]
    for size in np.unique(n[right]).tolist():
        at = np.flatnonzero((n == size) & right)
        for k in range(1, size):
            sides = [words.prints(m, first[at] + skip, half).view(np.int64).tolist() for m, skip in ((k, 0), (size - k, k)) for half in (0, 1)]
            for i, *four in zip(at.tolist(), *sides, strict=True):
                cuts[i].append(dict(zip(("l1", "l2", "r1", "r2"), four, strict=True)) | {"k": k})
    keep = np.flatnonzero(right).tolist()
    kinds = pa.list_(pa.struct([("k", pa.int32()), *[(c, pa.int64()) for c in ("l1", "l2", "r1", "r2")]]))
    cols = [pa.array([rows[i][0] for i in keep], pa.string()), pa.array([phrases[i].decode("utf-8", "replace") for i in keep], pa.string()), pa.array([rows[i][2] for i in keep], pa.int32())]
    cols += [pa.array([rows[i][c] for i in keep], pa.int64()) for c in (3, 4, 5)] + [pa.array([cuts[i] for i in keep], kinds)]
    yield pa.RecordBatch.from_arrays(cols, names=["lang", "phrase", "words", "print", "other", "a", "cuts"])


def phrase_counts(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, slots: int = SLOTS) -> tuple[DataFrame, DataFrame]:
    """counts(print, other, n, k1, at) of the words and phrases that docs(text, lang, k1) hold `least` times or more, and totals(lang, n) of all words."""
    marks = docs.sparkSession.sparkContext.broadcast(frequent_slots(docs, least, longest, slots))
    blocks = docs.mapInArrow(_count(longest, marks), _BLOCKS).repartition("space")
    found = cut(blocks.mapInArrow(_sum(least), _COUNTS))
    return found.filter("lang is null").drop("lang"), found.filter("lang is not null").groupBy("lang").agg(F.sum("n").alias("n"))


def collocations(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, top: int = TOP, slots: int = SLOTS) -> DataFrame:
    """The best-scored phrases of docs(text, lang) by language: lang, rank, phrase, a, l, r, n, score.

    Null texts are empty, a null language is `und`; texts without words count for
    nothing, repeated rows count each. Other columns are not looked at. Equal
    scores rank by a, then by phrase. An empty table gives no rows. longest is 2
    to 7, slots a power of two.
    """
    rows = docs.select(F.coalesce("text", F.lit("")).alias("text"), F.coalesce("lang", F.lit("und")).alias("lang"))
    rows = rows.withColumn("k1", F.xxhash64("text", "lang"))
    counts, totals = phrase_counts(rows, least, longest, slots)
    wanted = counts.filter(F.col("at").bitwiseAND(F.lit(7)) > 1).groupBy("k1").agg(F.collect_list(F.struct("print", "other", "n", "at")).alias("wanted"))
    wanted = cut(wanted)
    read = only(rows, KeyBits.of(wanted, "k1"), "k1").join(wanted, "k1").select("text", "lang", "wanted").mapInArrow(_read, _PHRASES)
    phrases = cut(read.dropDuplicates(["print", "other"]))
    inside = phrases.filter("words > 2").select("a", F.explode(F.array(F.struct(F.col("cuts")[0]["r1"].alias("print"), F.col("cuts")[0]["r2"].alias("other")), F.struct(F.element_at("cuts", -1)["l1"].alias("print"), F.element_at("cuts", -1)["l2"].alias("other")))).alias("part"))
    longer = inside.groupBy("part.print", "part.other").agg(F.max("a").alias("longer"))
    cuts = phrases.select("print", "other", "a", "lang", F.explode("cuts").alias("c")).select("print", "other", "a", "lang", "c.*")
    l = counts.select(F.col("print").alias("l1"), F.col("other").alias("l2"), F.col("n").alias("l"))
    r = counts.select(F.col("print").alias("r1"), F.col("other").alias("r2"), F.col("n").alias("r"))
    cuts = cuts.join(l, ["l1", "l2"]).join(r, ["r1", "r2"]).join(F.broadcast(totals), "lang")
    score = F.expr("(cast(1000 as decimal(4, 0)) * cast(a as decimal(19, 0)) * cast(n as decimal(15, 0))) div (cast(l as decimal(19, 0)) * cast(r as decimal(19, 0)))")
    best = cuts.withColumn("score", score).groupBy("print", "other").agg(F.min(F.struct("score", "k", "l", "r", "n")).alias("best"))
    scored = phrases.select("print", "other", "lang", "phrase", "a").join(best, ["print", "other"]).join(longer, ["print", "other"], "left")
    scored = scored.filter("longer is null or longer < a").select("lang", "phrase", "a", "best.l", "best.r", "best.n", "best.score")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = scored.withColumn("rank", F.row_number().over(order).cast("bigint")).filter(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(documents(spark, sf_dir).select("text", "lang"))


#: All phrases of all pieces, by their words.
OP12_SQL = f"""
WITH rows AS (SELECT row_number() OVER () AS d, coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
pieces AS (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS t FROM rows),
words AS MATERIALIZED (SELECT lang, list_filter(regexp_split_to_array(t, '[\x20\x09]+'), lambda x: x <> '') AS w FROM pieces),
totals AS (SELECT lang, sum(len(w)) AS n FROM words GROUP BY lang),
grams AS (SELECT lang, m, array_to_string(list_slice(w, i, i + m - 1), ' ') AS phrase FROM (
  SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM words CROSS JOIN range(1, {LONGEST + 1}) AS r(m))),
f AS MATERIALIZED (SELECT lang, m, phrase, count(*) AS a FROM grams GROUP BY ALL HAVING count(*) >= {LEAST}),
split AS (SELECT *, string_split(phrase, ' ') AS w FROM f WHERE m > 1),
cuts AS (SELECT s.lang, s.m, s.phrase, s.a, k, fl.a AS l, fr.a AS r, (1000::HUGEINT * s.a * n) // (fl.a::HUGEINT * fr.a) AS score
  FROM (SELECT *, unnest(range(1, m)) AS k FROM split) AS s JOIN totals USING (lang)
  JOIN f AS fl ON fl.lang = s.lang AND fl.phrase = array_to_string(list_slice(w, 1, k), ' ')
  JOIN f AS fr ON fr.lang = s.lang AND fr.phrase = array_to_string(list_slice(w, k + 1, s.m), ' ')),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
gone AS (SELECT DISTINCT s.lang, f.phrase FROM (
    SELECT lang, m, a, w, unnest(range(2, m)) AS size FROM split) AS s, f
  WHERE f.lang = s.lang AND f.m = s.size AND 100 * s.a >= 100 * f.a AND contains(' ' || array_to_string(s.w, ' ') || ' ', ' ' || f.phrase || ' ')),
ranked AS (SELECT lang, phrase, a, l, r, n, score, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank
  FROM (SELECT * FROM best ANTI JOIN gone USING (lang, phrase)) JOIN totals USING (lang))
SELECT lang, rank::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score FROM ranked WHERE rank <= {TOP}
"""
