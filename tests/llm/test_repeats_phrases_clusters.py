"""Suffix-array dedup, phrases and clusters against brute force, and on hard rows."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import clustering, collocations, common, suffix_dedup


def test_suffix_array_equals_sorting():
    draw = random.Random(5)
    for _ in range(1500):
        s = [draw.randint(1, draw.choice([1, 2, 3, 9])) for _ in range(draw.randint(0, 45))] + [0]
        assert suffix_dedup.suffix_array(s) == sorted(range(len(s)), key=lambda i: s[i:])


def test_equal_windows_have_equal_anchors():
    draw = random.Random(8)
    passage = bytes(draw.randrange(97, 120) for _ in range(700))
    for stretch in (1 << 20, 97):
        suffix_dedup.STRETCH, was = stretch, suffix_dedup.STRETCH
        try:
            chosen = []
            for _ in range(2):
                before = bytes(draw.randrange(97, 120) for _ in range(draw.randint(0, 600)))
                raw = before + passage + bytes(draw.randrange(97, 120) for _ in range(draw.randint(0, 600)))
                places, firsts, lasts = suffix_dedup.anchors(raw)
                assert firsts[0] == 0 and lasts[-1] == len(raw) - 400 and [x + 1 for x in lasts[:-1]] == firsts[1:]
                by_window = {w - len(before): q - len(before) for q, i, j in zip(places, firsts, lasts, strict=True) for w in range(i, j + 1)}
                chosen.append([by_window[w] for w in range(301)])
            assert chosen[0] == chosen[1]
        finally:
            suffix_dedup.STRETCH = was


def by_force(texts, length):
    found, out = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1)), []
    for t in texts:
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if found[t[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        runs = sum(1 for i in range(len(t)) if gone[i] and (i == 0 or not gone[i - 1]))
        out.append((len(t), sum(gone), runs, bytes(x for x, g in zip(t, gone, strict=True) if not g)))
    return out


@pytest.mark.parametrize("bucket", [1000, 1])
@pytest.mark.parametrize(("seed", "length", "letters"), [(1, 16, "ab"), (2, 21, "abc "), (3, 40, "aé"), (4, 33, "xyz")])
def test_repeats_equal_brute_force(spark, monkeypatch, seed, length, letters, bucket):
    """Passages between texts and inside them, periodic texts, copies, short, empty and null ones; a bucket of 1 counts all windows one by one, and its bitmaps are full."""
    if bucket == 1:
        monkeypatch.setattr(common, "KEY_BITS", 64)
    draw = random.Random(seed)
    some = lambda n: "".join(draw.choice(letters) for _ in range(draw.randint(0, n)))
    base = [some(120) for _ in range(20)]
    texts = [draw.choice(base) + some(20) + draw.choice(base)[draw.randint(0, 30) :] for _ in range(60)]
    texts += ["a" * 300, "ab" * 150, "a" * 301, "", None, base[0], base[0], "é" * 50 + "x"]
    docs = spark.createDataFrame([(k, t, "x", b"y") for k, t in enumerate(texts)], "doc_id long, text string, k1 string, kept binary")
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept), r.k1) for r in suffix_dedup.drop_repeats(docs, length, bucket).collect()}
    assert got == {k: (*w, "x") for k, w in enumerate(by_force([(t or "").encode() for t in texts], length))}


def test_repeats_of_long_texts_and_nothing(spark):
    """A text that repeats as a whole inside another; rows of one id and text are two documents; an empty table."""
    words = np.random.default_rng(3).integers(0, 10**9, 60_000)
    long = " ".join(map(str, words.tolist()))
    docs = spark.createDataFrame([(1, long), (2, long[200_000:203_000]), (3, "z" * 399), (3, "z" * 399), (4, "q" * 1000), (None, None)], "doc_id long, text string")
    got = sorted((r.doc_id or 0, r.n_bytes, r.n_removed, r.n_spans) for r in suffix_dedup.drop_repeats(docs).collect())
    assert got == [(0, 0, 0, 0), (1, len(long), 3000, 1), (2, 3000, 3000, 1), (3, 399, 0, 0), (3, 399, 0, 0), (4, 1000, 1000, 1)]
    assert suffix_dedup.drop_repeats(docs.limit(0)).collect() == []


def test_bitmaps_hold_all_their_keys(spark):
    keys = spark.range(-3000, 3000).select(F.xxhash64("id").alias("k"))
    bits = common.KeyBits.of(keys, "k")
    assert common.only(keys, bits, "k").count() == 6000 and common.only(keys, bits, "k", there=False).count() == 0
    others = spark.range(10_000, 60_000).select(F.xxhash64("id").alias("k"))
    assert common.only(others, bits, "k").count() < 5000
    assert common.only(others, common.KeyBits.of(keys.limit(0), "k"), "k").count() == 0


def phrases_by_force(rows, least, longest, top):
    totals, found = Counter(), Counter()
    for text, lang in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")):
            words = [w for w in re.split(r"[\x20\x09]+", piece) if w]
            totals[lang or "und"] += len(words)
            for n in range(1, longest + 1):
                for i in range(len(words) - n + 1):
                    found[lang or "und", tuple(words[i : i + n])] += 1
    frequent = {k: a for k, a in found.items() if a >= least}
    gone = set()
    for (lang, longer), a in frequent.items():
        for n in range(2, len(longer)):
            for i in range(len(longer) - n + 1):
                if 100 * a >= 100 * frequent[lang, longer[i : i + n]]:
                    gone.add((lang, longer[i : i + n]))
    scored = {}
    for (lang, p), a in frequent.items():
        if len(p) > 1 and (lang, p) not in gone:
            score, _, l, r = min((1000 * a * totals[lang] // (frequent[lang, p[:k]] * frequent[lang, p[k:]]), k, frequent[lang, p[:k]], frequent[lang, p[k:]]) for k in range(1, len(p)))
            scored.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), l, r))
    return sorted((lang, k + 1, p.decode(), -a, l, r, totals[lang], -s) for lang, all_ in scored.items() for k, (s, a, p, l, r) in enumerate(sorted(all_)[:top]))


@pytest.mark.parametrize(("slots", "stretch", "gathered"), [(1 << 20, 1 << 21, 1_500_000), (64, 300, 50)])
def test_phrases_equal_brute_force(spark, monkeypatch, slots, stretch, gathered):
    """Also with tables so small that every slot is full, texts cut into stretches and counts handed on often."""
    monkeypatch.setattr(collocations, "STRETCH", stretch)
    monkeypatch.setattr(collocations, "GATHERED", gathered)
    monkeypatch.setattr(collocations, "HANDED", gathered)
    draw = random.Random(11)
    words = ["Aa", "bb", "é", "ÀB", "dd-d", "x" * 20, "x" * 19 + "y", "1", "b\xa0b"]
    rows = [("".join(draw.choice(words) + draw.choice([" ", "  ", "\t", ", ", ". ", "\n", " "]) for _ in range(draw.randint(0, 60))), draw.choice(["en", "de", None])) for _ in range(150)]
    rows += [(None, "en"), ("", None), (" \t.", "fr"), ("aa bb", "fr"), *[("one two three four five six", "en")] * 9]
    docs = spark.createDataFrame([(t, lang, "x") for t, lang in rows], "text string, lang string, k1 string")
    # At least as many as the shortest words of the fixture, and all lengths.
    got = sorted(tuple(r) for r in collocations.collocations(docs, least=8, longest=5, top=70, slots=slots).collect())
    assert got == phrases_by_force(rows, 8, 5, 70)
    assert collocations.collocations(docs.limit(0), slots=slots).collect() == []


def clusters_by_force(rows, k, rounds, size):
    kept = [(i, [int(np.floor(256 * np.float64(np.float32(x)))) for x in v]) for i, v in rows if v is not None and len(v) == size and all(x is not None and np.isfinite(x) for x in v)]
    first = sorted((hashlib.sha256(f"2:{'' if i is None else i}".encode()).hexdigest(), v) for i, v in kept)[:k]
    centroids = [v for _, v in first]
    for turn in range(rounds + 1):
        found = [min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), n) for n, c in enumerate(centroids)) for _, v in kept]
        if turn < rounds:
            for n in range(len(centroids)):
                mine = [v for (_, v), (_, own) in zip(kept, found, strict=True) if own == n]
                if mine:
                    centroids[n] = [sum(x) // len(mine) for x in zip(*mine, strict=True)]
    return sorted((i or 0, n, d) for (i, _), (d, n) in zip(kept, found, strict=True)), centroids


@pytest.mark.parametrize(("k", "spread"), [(7, 1.0), (7, 0.01), (1, 1.0), (500, 1.0)])
def test_clusters_equal_brute_force(spark, k, spread):
    """Close groups and ties (few whole numbers), repeated and missing ids, unfit vectors, fewer vectors than centroids."""
    draw = np.random.default_rng(2)
    middles = draw.normal(size=(9, 5))
    rows = [(i, (middles[i % 9] + spread * draw.normal(size=5)).astype(np.float32).tolist()) for i in range(300)]
    rows += [(i + 1000, [float(x) / 256 for x in draw.integers(-1, 2, 5)]) for i in range(80)]
    rows += [(3, [1.0] * 5), (3, [1.0] * 5), (None, [0.5] * 5), (7, None), (8, [1.0] * 4), (9, [1.0, None, 0.0, 0.0, 0.0]), (10, [float("nan")] * 5), (11, [float("-inf")] * 5)]
    vectors = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<float>, cluster string")
    made, centroids = clustering.cluster_vectors(vectors, k=k, rounds=4, dimensions=5)
    want, places = clusters_by_force(rows, k, 4, 5)
    assert sorted((r.vec_id or 0, r.cluster, r.distance) for r in made.collect()) == want and centroids.tolist() == places


def test_clusters_of_nothing_and_of_too_large_components(spark):
    vectors = spark.createDataFrame([(1, [1e9] * 4)], "vec_id long, embedding array<double>")
    assert clustering.cluster_vectors(vectors.limit(0), dimensions=4)[0].collect() == []
    with pytest.raises(Exception, match="would not fit 64 bits"):
        clustering.cluster_vectors(vectors, dimensions=4)


def test_search_spares_distances():
    """Vectors that stay near their centroid are not searched again."""
    draw = np.random.default_rng(4)
    middles = draw.integers(-9000, 9000, (12, 8))
    v = np.repeat(middles, 50, axis=0) + draw.integers(-40, 40, (600, 8))
    one, two, upper, lower = np.zeros(600, np.int32), np.ones(600, np.int32), np.full(600, np.inf), np.full(600, -np.inf)
    # Those of centroid 0, where all begin, are within half the way to the next.
    assert len(clustering.Search(middles).run(v, one, two, upper, lower)) == 550
    moved = middles + draw.integers(-3, 3, middles.shape)
    assert len(clustering.Search(moved, middles).run(v, one, two, upper, lower)) == 0
    assert one.tolist() == np.repeat(np.arange(12), 50).tolist()
