"""Operator 11, suffix-array dedup: byte strings of `length` that also start elsewhere, removed wherever they stand.

Nothing sorts the whole corpus. Each text marks anchors: of every `length`-byte
window the place with the least mark, leftmost where equal, so that two equal
windows have an anchor at the same place inside and its gram (the bytes from the
anchor on that any such window holds) in common. An anchor stands for the run of
windows that chose it, so that each window is looked at once. Grams that occur
once are done. Of the others, runs of windows that are equal as a whole repeat
as a whole. What is left are anchors whose runs differ, near the ends of
passages. There the windows are taken in ranges of neighbours. All windows of a range share a core; ranges with the same
core are a bucket, and of each only the bytes left and right of the core are
carried. Buckets are put together into blocks of bounded size, and each block
is suffix-sorted by linear grouping: suffixes are grouped by their Lyndon
prefixes, groups are taken in descending order, each member's pointer to the
previous smaller suffix splits the groups of those it points to, and one pass
along the array then emits the order inside the groups. Neighbours in the array
whose windows are equal repeat. A bucket of more than `BUCKET` different ranges
(a passage in very many documents) is not sorted by one task: its windows are
counted one by one, an aggregate that no key makes hot.

Grams are met by 64-bit hashes, whole surroundings by 128 bits with their gram,
ranges by 128 bits of gram and core and by their bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import KeyBits, cut, documents, only, stored, unused

LENGTH = 400
#: Ranges that the windows over one anchor are taken in.
RANGES = 8
#: Different ranges of one bucket that a block may hold, and those of a block together, about.
BUCKET, BLOCK = 1_000, 2_000
#: Tasks that blocks are dealt to, at most.
MOST_TASKS = 20_000
#: Windows whose anchors are found at a time.
STRETCH = 1 << 20
_LOW = np.uint64((1 << 24) - 1)


def suffix_array(s: list[int]) -> list[int]:
    """Starts of the suffixes of s in their order, by linear grouping; the last symbol must be smaller than all others and occur once.

    head[i] is where the group of suffix i begins in the array; size is known at
    the beginnings. Members of a group are taken by position, so that a pointer
    that leads through a member of the same group finds it done.
    """
    n = len(s)
    order = np.argsort(np.array(s), kind="stable").tolist()
    at, head, size, before = [0] * n, [0] * n, [0] * n, [-1] * n
    first = 0
    for k, i in enumerate(order):
        if s[i] != s[order[first]]:
            first = k
        at[i], head[i] = k, first
        size[first] += 1
    end = n
    while end > 0:
        first = head[order[end - 1]]
        times: dict[int, int] = {}
        for i in order[first:end] if end - first == 1 else sorted(order[first:end]):
            p = i - 1
            while p >= 0 and head[p] >= first:
                p = before[p]
            before[i] = p
            if p >= 0:
                times[p] = times.get(p, 0) + 1
        end = first
        if not times:
            continue
        most = max(times.values())
        for times_here in range(most, 0, -1):
            pointed = times if most == 1 else [p for p, t in times.items() if t == times_here]
            moved: dict[int, list[int]] = {}
            for p in pointed:
                moved.setdefault(head[p], []).append(p)
            for h, members in moved.items():
                left = size[h]
                for p in members:
                    left -= 1
                    to, was = h + left, at[p]
                    other = order[to]
                    order[to], order[was], at[p], at[other] = p, other, to, was
                size[h] = left
                h += left
                size[h] = len(members)
                for p in members:
                    head[p] = h
    out, free, done = [n - 1] * n, list(range(n)), [False] * n
    done[n - 1] = True
    for k in range(n):
        i = out[k] - 1
        while i >= 0 and not done[i]:
            h = head[i]
            out[free[h]] = i
            free[h] += 1
            done[i] = True
            i = before[i]
    return out


def anchors(raw: bytes, length: int = LENGTH) -> tuple[list[int], list[int], list[int]]:
    """A text's anchors, ascending, with the first and the last of the windows that chose them: of each window of length bytes, the least mark among its first length // 2 places."""
    reach, n = length // 2, len(raw)
    found, firsts = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for begin in range(0, n - length + 1, STRETCH):
        windows = min(STRETCH, n - length + 1 - begin)
        count = windows + reach - 1
        marks = np.ndarray((count,), "<u8", raw, begin, (1,)) * np.uint64(0x9E3779B97F4A7C15)
        marks ^= marks >> np.uint64(29)
        marks *= np.uint64(0xBF58476D1CE4E5B9)
        marks &= ~_LOW
        marks |= np.arange(count, dtype=np.uint64)
        rows = -(-count // reach)
        table = np.full(rows * reach, np.iinfo(np.uint64).max)
        table[:count] = marks
        table = table.reshape(rows, reach)
        ahead = np.minimum.accumulate(table, axis=1).ravel()
        back = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1].ravel()
        least = (np.minimum(back[:windows], ahead[reach - 1 : reach - 1 + windows]) & _LOW).astype(np.int64)
        first = np.flatnonzero(np.diff(least, prepend=-1))
        found.append(least[first] + begin)
        firsts.append(first + begin)
    places, first = np.concatenate(found), np.concatenate(firsts)
    new = np.flatnonzero(np.diff(places, prepend=-1))
    places, first = places[new].tolist(), first[new].tolist()
    return places, first, [x - 1 for x in first[1:]] + [n - length] * bool(first)


def _raw(text: str | None) -> bytes:
    return text.encode("utf-8", "surrogatepass") if text else b""


def _place(k2at: int) -> tuple[int, int, int]:
    """An anchor's place, and how far before it the first and the last window begin that chose it: what the lower 48 bits hold."""
    return k2at >> 16 & 0xFFFFFFFF, k2at >> 8 & 0xFF, k2at & 0xFF


_ANCHORS = pa.schema([("gram", pa.int64()), ("around", pa.int64()), ("k1", pa.int64()), ("k2at", pa.int64())])


def _signed(values: list[int]) -> pa.Array:
    return pa.array(np.array(values, np.uint64).view(np.int64))


def _mark(length: int):
    reach = length // 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_64_intdigest
        for b in batches:
            grams, around, k1, k2at = [], [], [], []
            for text, a, c in zip(b.column("text"), b.column("k1").to_pylist(), b.column("k2").to_pylist(), strict=True):
                raw = _raw(text.as_py())
                places, firsts, lasts = anchors(raw, length)
                grams += [digest(raw[q : q + length - reach + 1]) for q in places]
                around += [digest(raw[i : j + length], q - i) for q, i, j in zip(places, firsts, lasts, strict=True)]
                k1 += [a] * len(places)
                k2at += [c << 48 | q << 16 | (q - i) << 8 | (q - j) for q, i, j in zip(places, firsts, lasts, strict=True)]
                if len(grams) > 500_000:
                    yield pa.RecordBatch.from_arrays([_signed(grams), _signed(around), pa.array(k1, pa.int64()), pa.array(k2at, pa.int64())], schema=_ANCHORS)
                    grams, around, k1, k2at = [], [], [], []
            yield pa.RecordBatch.from_arrays([_signed(grams), _signed(around), pa.array(k1, pa.int64()), pa.array(k2at, pa.int64())], schema=_ANCHORS)

    return run


_RANGES = "gram bigint, part int, core bigint, before binary, after binary, n bigint, k1 bigint, k2at bigint"


def _cores(length: int):
    """Rows of texts with the anchors wanted of them become a row for each range of windows over each of these."""
    step = -(-(length // 2) // RANGES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_64_intdigest
        for b in batches:
            for text, a, c, wanted in zip(b.column("text"), b.column("k1").to_pylist(), b.column("k2").to_pylist(), b.column("wanted"), strict=True):
                raw, out = _raw(text.as_py()), []
                for w in wanted.as_py():
                    q, far, near = _place(w["k2at"])
                    for part in range(near // step, far // step + 1):
                        left = q - part * step
                        right = left - step + 1 + length
                        core = digest(raw[left:right])
                        out.append((w["gram"], part, core - (1 << 64) if core >> 63 else core, raw[max(0, left - step + 1) : left], raw[right : left + length], w["n"], a, w["k2at"]))
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True), (pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.int64()), strict=True)], names=["gram", "part", "core", "before", "after", "n", "k1", "k2at"])

    return run


def repeats_in(rows: list[tuple[object, bytes, bytes]], size: int) -> list[list[int]]:
    """For each (bucket, before, after), which windows of its range repeat in another row of its bucket; by how many bytes before the core they begin.

    Rows of a bucket are different. A window is size symbols: the core counts as one symbol, a different one for each bucket.
    """
    buckets: dict[object, int] = {}
    s, starts = [], []
    for bucket, before, after in rows:
        starts.append(len(s))
        s += [x + 2 for x in before]
        s.append(258 + buckets.setdefault(bucket, len(buckets)))
        s += [x + 2 for x in after]
        s.append(1)
    s += [1] * size + [0]
    owner = np.zeros(len(s), np.int64)
    owner[starts] = 1
    owner = np.cumsum(owner) - 1
    symbols = np.array(s)
    firsts = np.array(starts)
    lefts, rights = np.array([len(x[1]) for x in rows]), np.array([len(x[2]) for x in rows])
    order = np.array(suffix_array(s))
    order = order[order < len(s) - size - 1]
    row = owner[order]
    offset = order - firsts[row]
    fits = (offset <= lefts[row]) & (offset + size <= lefts[row] + 1 + rights[row])
    order, row, offset = order[fits], row[fits], offset[fits]
    windows = np.lib.stride_tricks.sliding_window_view(symbols, size)[order]
    equal = (windows[1:] == windows[:-1]).all(axis=1)
    again = np.zeros(len(order), bool)
    again[1:] |= equal
    again[:-1] |= equal
    out: list[list[int]] = [[] for _ in rows]
    for r, o in zip(row[again].tolist(), (lefts[row] - offset)[again].tolist(), strict=True):
        out[r].append(o)
    return out


_SPANS = "k1 bigint, k2 int, start bigint, end bigint"


def _runs(offsets: list[int]) -> Iterator[tuple[int, int]]:
    """Runs of neighbours (largest, smallest) of numbers in any order."""
    offsets = sorted(offsets)
    k = 0
    while k < len(offsets):
        j = k
        while j + 1 < len(offsets) and offsets[j + 1] == offsets[j] + 1:
            j += 1
        yield offsets[j], offsets[k]
        k = j + 1


def _sorted_blocks(length: int):
    step = -(-(length // 2) // RANGES)

    def run(block: pa.Table) -> pa.Table:
        cols = [block.column(c).to_pylist() for c in ("gram", "part", "core", "before", "after", "n", "k1", "k2at")]
        rows = list(zip(*cols, strict=True))
        out = []
        for (_, part, _, _, _, n, k1, k2at), offsets in zip(rows, repeats_in([(r[:3], r[3], r[4]) for r in rows], step), strict=True):
            if n == 1:
                left = _place(k2at)[0] - part * step
                out += [(k1, k2at >> 48, left - far, left - near + length) for far, near in _runs(offsets)]
        return pa.Table.from_arrays([pa.array([x[k] for x in out], t) for k, t in enumerate((pa.int64(), pa.int32(), pa.int64(), pa.int64()))], names=["k1", "k2", "start", "end"])

    return run


def repeated_spans(texts: DataFrame, length: int = LENGTH, bucket: int = BUCKET) -> DataFrame:
    """(k1, k2, start, end) of texts(text, k1, k2): stretches of bytes that strings of `length`, which also start elsewhere, cover.

    Each row is a document; k1 (64 bits) and k2 (15) are equal for equal texts
    alone. Stretches may overlap and reach beyond a text's end. Texts shorter than
    `length`, empty and null ones have none. length is 16 to 510, texts are under 4 GiB.
    """
    if not 16 <= length <= 510:
        raise ValueError("length is 16 to 510 bytes")
    step = -(-(length // 2) // RANGES)
    at = F.shiftright("k2at", 16).bitwiseAND(F.lit(0xFFFFFFFF))
    far, near = F.shiftright("k2at", 8).bitwiseAND(F.lit(0xFF)), F.col("k2at").bitwiseAND(F.lit(0xFF))
    k2 = F.shiftright("k2at", 48).cast("int").alias("k2")
    long_ones = texts.filter(F.octet_length("text") >= length)
    marked = stored(long_ones.mapInArrow(_mark(length), "gram bigint, around bigint, k1 bigint, k2at bigint"))
    each = marked.groupBy("gram", "around").agg(F.count("*").alias("n"), F.min("k1").alias("k1"), F.min_by("k2at", "k1").alias("k2at"))
    grams = each.groupBy("gram").agg(F.count("*").alias("kinds"), F.count_if(F.col("n") == 1).alias("single"))
    each = cut(each.join(grams.filter("kinds > 1 or single = 0"), "gram"))
    whole = marked.join(each.filter("n > 1").select("gram", "around"), ["gram", "around"]).select("k1", "k2at").distinct()
    spans = whole.select("k1", k2, (at - far).alias("start"), (at - near + length).alias("end"))
    wanted = each.filter("kinds > 1 and single > 0").groupBy("k1", k2).agg(F.collect_list(F.struct("gram", "n", "k2at")).alias("wanted"))
    wanted = cut(wanted)
    ranges = cut(only(long_ones, KeyBits.of(wanted, "k1"), "k1").join(wanted, ["k1", "k2"]).select("text", "k1", "k2", "wanted").mapInArrow(_cores(length), _RANGES))
    key = ["gram", "part", "core"]
    kinds = ranges.groupBy(*key, "before", "after").agg(F.sum("n").alias("n"), F.min("k1").alias("k1"), F.min_by("k2at", "k1").alias("k2at"))
    buckets = kinds.groupBy(key).agg(F.count("*").alias("kinds"), F.count_if(F.col("n") == 1).alias("single"))
    kinds = cut(kinds.join(buckets.filter("kinds > 1 or single = 0"), key))
    left = at - F.col("part") * step
    same = ranges.filter("n = 1").join(kinds.filter("n > 1").select(*key, "before", "after"), [*key, "before", "after"])
    same = same.select("k1", k2, (left - F.octet_length("before")).alias("start"), (left - step + 1 + length + F.octet_length("after")).alias("end"))
    mixed = kinds.filter("kinds > 1 and single > 0")
    few = mixed.filter(F.col("kinds") <= bucket)
    blocks = max(1, -(-few.count() // BLOCK))
    # As many tasks as blocks, up to a bound: they are small in bytes and long in work.
    in_blocks = few.withColumn("block", F.pmod(F.xxhash64(*key), F.lit(blocks))).repartition(min(blocks, MOST_TASKS), "block").groupBy("block").applyInArrow(_sorted_blocks(length), _SPANS)
    spans = spans.unionByName(same.filter(F.col("end") - F.col("start") >= length)).unionByName(in_blocks)
    many = mixed.filter(F.col("kinds") > bucket).withColumn("far", F.explode(F.sequence(F.lit(0), F.lit(step - 1))))
    many = many.filter("far <= octet_length(before)").withColumn("near", F.lit(step - 1) - F.col("far")).filter("near <= octet_length(after)")
    many = many.select(*key, "far", F.expr("substring(before, octet_length(before) - far + 1, far)").alias("before"), F.expr("substring(after, 1, near)").alias("after"), "n", "k1", "k2at")
    window = [*key, "far", "before", "after"]
    again = many.groupBy(window).agg(F.sum("n").alias("times")).filter("times > 1")
    again = many.filter("n = 1").join(again.drop("times"), window)
    again = again.select("k1", k2, (left - F.col("far")).alias("start"), (left - F.col("far") + length).alias("end"))
    return spans.unionByName(again)


_KEPT = "n_removed bigint, n_spans bigint, kept binary"


def without(raw: bytes, starts: list[int], ends: list[int]) -> tuple[int, int, bytes]:
    """How many bytes and runs go from a text, and what stays."""
    kept, upto, runs, stay = [], 0, 0, 0
    edge = -1
    for a, b in sorted(zip(starts, ends, strict=True)):
        b = min(b, len(raw))
        if a > edge:
            kept.append(raw[upto:a])
            runs += 1
            edge = upto = b
        elif b > edge:
            edge = upto = b
    kept.append(raw[upto:])
    out = b"".join(kept)
    stay = len(out)
    return len(raw) - stay, runs, out


def drop_repeats(docs: DataFrame, length: int = LENGTH, bucket: int = BUCKET) -> DataFrame:
    """docs(text, ...) with n_bytes, n_removed, n_spans and kept (binary): each text's UTF-8 bytes without those that repeated strings cover.

    Null is empty; empty and short texts stay as they are. Every row is a document
    of its own: a text of length bytes or more that two rows hold goes from both.
    An empty table gives none. Other columns stay; those with the names of new
    ones are replaced. Bytes that stay need not be whole characters.
    """
    docs = docs.drop("n_bytes", "n_removed", "n_spans", "kept")
    names = docs.columns
    k1, k2, got = (unused(c, docs) for c in ("k1", "k2", "spans"))
    keyed = docs.withColumns({k1: F.xxhash64("text"), k2: F.hash("text").bitwiseAND(F.lit(0x7FFF))})
    spans = repeated_spans(keyed.select("text", F.col(k1).alias("k1"), F.col(k2).alias("k2")), length, bucket)
    spans = cut(spans.groupBy(F.col("k1").alias(k1), F.col("k2").alias(k2)).agg(F.collect_set(F.struct("start", "end")).alias(got)))
    kinds = ", ".join([*[f"`{c}` {t}" for c, t in docs.dtypes], "n_bytes bigint", _KEPT])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            removed, runs, kept, size = [], [], [], []
            for text, found in zip(b.column("text"), b.column(got), strict=True):
                raw = _raw(text.as_py())
                found = found.as_py() or []
                n, k, rest = without(raw, [x["start"] for x in found], [x["end"] for x in found])
                removed.append(n)
                runs.append(k)
                kept.append(rest)
                size.append(len(raw))
            cols = [b.column(c) for c in names] + [pa.array(x, pa.int64()) for x in (size, removed, runs)] + [pa.array(kept, pa.binary())]
            yield pa.RecordBatch.from_arrays(cols, names=[*names, "n_bytes", "n_removed", "n_spans", "kept"])

    # Only texts that may have lost something meet what they lost.
    bits = KeyBits.of(spans, k1)
    cols = [F.col(f"`{c}`") for c in names]
    touched = only(keyed, bits, k1).join(spans, [k1, k2], "left").select(*cols, got).mapInArrow(run, kinds)
    rest = only(keyed, bits, k1, there=False).select(*cols, F.octet_length(F.coalesce("text", F.lit(""))).cast("bigint").alias("n_bytes"))
    none = F.lit(0).cast("bigint")
    return touched.unionByName(rest.withColumns({"n_removed": none, "n_spans": none, "kept": F.encode(F.coalesce("text", F.lit("")), "utf-8")}))


def op11_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = drop_repeats(documents(spark, sf_dir).select("doc_id", "text"))
    return made.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


#: Every window of every text by its bytes; runs are islands of covered places.
OP11_SQL = f"""
WITH docs AS (SELECT row_number() OVER () AS d, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
pieces AS (SELECT d, q, substr(h, 2 * q + 1, 2 * (512 + {LENGTH - 1})) AS h FROM (SELECT d, h, unnest(range(0, greatest(0, length(h) // 2 - {LENGTH - 1}), 512)) AS q FROM docs)),
starts AS (SELECT d, q, h, unnest(range(0, least(512, length(h) // 2 - {LENGTH - 1}))) AS p FROM pieces),
windows AS (SELECT d, q + p AS p, md5_number(substr(h, 2 * p + 1, {2 * LENGTH})) AS w FROM starts),
again AS (SELECT d, p FROM windows SEMI JOIN (SELECT w FROM windows GROUP BY w HAVING count(*) > 1) USING (w)),
edges AS (SELECT d, p, CASE WHEN p <= lag(p) OVER (PARTITION BY d ORDER BY p) + {LENGTH} THEN 0 ELSE 1 END AS opens FROM again),
runs AS (SELECT d, p, sum(opens) OVER (PARTITION BY d ORDER BY p) AS run FROM edges),
spans AS (SELECT d, min(p) AS a, max(p) + {LENGTH} AS b FROM runs GROUP BY d, run),
listed AS (SELECT d, count(*) AS n_spans, sum(b - a) AS n_removed, list(a ORDER BY a) AS a, list(b ORDER BY a) AS b FROM spans GROUP BY d),
kept AS (
  SELECT doc_id, length(h) // 2 AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
    CASE WHEN n_spans IS NULL THEN h ELSE list_aggregate(list_transform(range(0, n_spans + 1), lambda k:
      substr(h, 2 * (CASE WHEN k = 0 THEN 0 ELSE b[k] END) + 1, 2 * ((CASE WHEN k = n_spans THEN length(h) // 2 ELSE a[k + 1] END) - (CASE WHEN k = 0 THEN 0 ELSE b[k] END)))), 'string_agg', '') END AS h
  FROM docs LEFT JOIN listed USING (d))
SELECT doc_id, n_bytes::BIGINT AS n_bytes, n_removed::BIGINT AS n_removed, n_spans::BIGINT AS n_spans, sha256(from_hex(h)) AS kept_sha256 FROM kept
"""
