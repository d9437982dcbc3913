"""The text operators against brute force, exact round trips and held-out labels, and on hard rows."""

import hashlib
import random
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import chat, labelled, line_dedup, minhash, mixing, quality_classifier, quality_rules, queries, sentencepieces, simhash, textstats, token_counts, toxicity
from tidemark.llm import common
from tidemark.llm.common import components


@pytest.fixture(params=[False, True], ids=["wide", "tight"])
def tight(request, monkeypatch):
    """Also with crowds, blocks, places and broadcasts so small that every way of splitting them is gone."""
    if request.param:
        for module, name, value in ((common, "BLOCK", 16), (minhash, "PLACE", 900), (minhash, "HOT", 9), (minhash, "MAX_BROADCAST_BYTES", 0)):
            monkeypatch.setattr(module, name, value)

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, n_words string"


@pytest.fixture(scope="module")
def hard(spark):
    """Nulls everywhere, empty and very long texts, ties, repeated rows, a clashing column."""
    long = " ".join(f"w{i % 977}x{i % 31}" for i in range(40_000))
    rows = [(1, None, None, None, None, "x"), (2, "", "en", "a", 0, None), (3, " \n\t ", "en", "a", 4, None), (4, long, "en", None, 1, None), (4, long, "en", None, 1, None), (5, "a b c", None, "b", 5, None), (None, "a b c", "en", "b", 5, None), (6, "### x\\ </turn>", "de", "a", 9, None)]
    return spark.createDataFrame(rows, DOCS)


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "conversations", "embeddings"):
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    got, want = queries.QUERIES[name](spark, SF).toPandas(), con.sql(queries.ORACLE_SQL[name]).df()
    same = lambda x: sorted(map(str, x[sorted(x.columns)].round(6).itertuples(index=False, name=None)))
    assert sorted(got.columns) == sorted(want.columns) and same(got) == same(want)


def test_hard_rows(spark, hard):
    assert line_dedup.line_dedup(hard).count() == 8
    near = {(r.doc_id, r.n_shingles): r for r in minhash.near_dedup(hard).collect()}
    assert near[1, 0].kept and near[3, 0].component_id == 3 and near[5, 1].component_id == 5
    assert quality_rules.quality_rules(hard).filter("not base_failed").count() == 2
    assert mixing.mix(hard).agg(F.sum("size")).first()[0] == 2 * 40_000 + 3 + 3 + 3
    assert simhash.fingerprint_edits(hard).count() == 8
    assert sentencepieces.decode(sentencepieces.encode(hard)).filter(F.col("decoded") != F.coalesce("text", F.lit(""))).count() == 0
    assert token_counts.token_trees(hard).filter("doc_id = 1").first().n_tokens == 0
    labels = spark.createDataFrame([(5, 1, 0), (6, 0, 1), (None, 1, 1), (4, None, None)], "doc_id long, quality int, toxic int")
    assert quality_classifier.quality_scores(hard, labels).filter("score between 0 and 1").count() == 8
    assert toxicity.toxicity_scores(hard, labels).filter("score between 0 and 1").count() == 8


def test_empty_tables(spark, hard):
    none = hard.limit(0)
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    for got in (line_dedup.line_dedup(none), minhash.near_dedup(none), quality_rules.quality_rules(none), mixing.mix(none), simhash.fingerprint_edits(none), sentencepieces.encode(none), token_counts.token_trees(none), quality_classifier.quality_scores(none, labels), toxicity.toxicity_scores(none, labels)):
        assert got.count() == 0


def test_line_dedup_by_shuffle_equals_broadcast(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumn("doc", F.lit(1)).withColumn("gone", F.lit("x")).withColumn("high", F.lit(2))
    a, b = (line_dedup.line_dedup(docs, min_docs=2, **kw).select("doc_id", "n_dropped", "kept_text").orderBy("doc_id").collect() for kw in ({}, {"max_broadcast_bytes": 0, "shard_keys": 7}))
    assert a == b and sum(r.n_dropped for r in a) > 0


def test_perfect_hash():
    rng = np.random.default_rng(1)
    high, low = rng.integers(0, 1 << 63, (2, 20_000)).astype(np.uint64)
    shard = line_dedup.Shard.from_bytes(line_dedup.Shard.build(high, low, np.arange(20_000), np.arange(20_000)).to_bytes())
    assert sorted(shard.places(high)) == list(range(20_000))
    held, largest = shard.probe(high, low)
    assert (held == np.arange(20_000)).all() and (largest == np.arange(20_000)).all()
    assert not shard.probe(low, high)[0].any()


def test_components(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(500), rng.randrange(500)) for _ in range(230)] + [(i, i + 1) for i in range(900, 940)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    touched = {x for e in edges if e[0] != e[1] for x in e}
    assert {r.id: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()} == {x: find(x) for x in touched}


def test_near_dedup_with_a_large_group_equals_brute_force(spark, tight):
    rng = random.Random(5)
    base = [f"w{rng.randrange(9999)}" for _ in range(120)]
    texts = []
    for _ in range(250):
        w = list(base)
        for _ in range(rng.randrange(5)):
            w[rng.randrange(120)] = f"z{rng.randrange(9999)}"
        texts.append(" ".join(w))
    texts += [" ".join(base[:30] + [f"y{rng.randrange(9999)}" for _ in range(60)]) for _ in range(60)]
    sets = [minhash.shingle_set(t) for t in texts]
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            i = len(np.intersect1d(sets[a], sets[b], assume_unique=True))
            if 100 * i >= 75 * (len(sets[a]) + len(sets[b]) - i):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in minhash.near_dedup(docs, small_node=8).collect()}
    assert got == {k: find(k) for k in range(len(texts))}


def test_odd_sketch_never_exceeds_the_difference():
    rng = np.random.default_rng(2)
    for n in (5, 200, 3000):
        a = np.unique(rng.integers(0, 1 << 62, n).astype(np.uint64))
        b = np.unique(np.concatenate((a[n // 5 :], rng.integers(0, 1 << 62, n // 5).astype(np.uint64))))
        differ = int(np.bitwise_count(minhash.odd_sketch(a).view(np.uint64) ^ minhash.odd_sketch(b).view(np.uint64)).sum())
        assert differ <= len(np.setxor1d(a, b))


def test_repeated_words(spark):
    rng = random.Random(4)
    texts = [" ".join(rng.choice("abcd") for _ in range(rng.randrange(14))) for _ in range(200)]

    def brute(words):
        grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
        return len({i + k for i, g in enumerate(grams) if grams.count(g) > 1 for k in range(3)})

    got = textstats.text_stats(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert {r.doc_id: r.n_repeat_words for r in got} == {k: brute(t.split()) for k, t in enumerate(texts)}


def test_water_filling(spark):
    sizes = {"a": 1000, "b": 10, "c": 500, "d": 1, None: 2000, "e": 0}
    rows = [(s, n) for s, n in sizes.items()]
    got = {r.source: r.target for r in mixing.source_targets(spark.createDataFrame(rows, "source string, size long")).collect()}
    order = sorted((s for s in sizes if s is not None)) + [None]
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    want, free, left = {}, set(order), float(sum(sizes.values()))
    while True:
        total = sum(weight[s] for s in free)
        over = {s for s in free if left * weight[s] / total > 3 * sizes[s]}
        if not over:
            want |= {s: left * weight[s] / total for s in free}
            break
        want |= {s: 3.0 * sizes[s] for s in over}
        left -= sum(want[s] for s in over)
        free -= over
    assert got == pytest.approx(want) and sum(got.values()) == pytest.approx(sum(sizes.values()))


def test_mix_comes_near_targets_and_repeats_agree(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = mixing.mix(docs)
    each = got.groupBy("source_size", "target").agg(F.sum("taken").alias("t"), F.max(F.col("taken") - 3 * F.col("size")).alias("over")).collect()
    assert all(abs(r.t - r.target) <= 0.01 * r.target and r.over <= 0 for r in each)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, mixing.mix(docs.repartition(7)).collect()))


def test_classifiers_on_held_out_labels(spark):
    d = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    for scored, column, least in ((quality_classifier.quality_scores(docs, labels), "quality", 0.97), (toxicity.toxicity_scores(docs, labels), "toxic", 0.9)):
        p = scored.join(labels, "doc_id").filter("held_out").toPandas()
        assert (p["predicted"] == p[column]).mean() >= least
    assert labels.join(labelled.training_labels(labels, "toxic"), "doc_id").filter(labelled.held_out(F.col("doc_id"))).count() == 0


def test_machine_learns_pairs():
    rng = np.random.default_rng(0)
    rows, labels = [], []
    for _ in range(2000):
        a, b = rng.integers(0, 2, 2)
        rows.append(np.array(sorted([1] * a + [2] * b + [3 + int(rng.integers(0, 5))])))
        labels.append(float(a and b))
    m = toxicity.train(rows, np.array(labels))
    at = {int(c): i for i, c in enumerate(m.chosen)}
    v, w = m.factors, m.weights
    pair = m.bias + w[at[1]] + w[at[2]] + v[at[1]] @ v[at[2]]
    assert pair > 0 > max(m.bias + w[at[1]], m.bias + w[at[2]])


def test_fingerprint_edits(spark):
    texts = [" ".join(f"w{(i * 7 + k) % 50}" for k in range(40 + i)) for i in range(60)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in simhash.fingerprint_edits(docs, run=7).collect()}
    for i, t in enumerate(texts):
        changed = simhash.edited_text(t, texts[i - 1])
        assert got[i].edited_sha256 == hashlib.sha256(changed.encode()).hexdigest()
        assert got[i].fingerprint == simhash.fingerprint(t).hex() and got[i].edited_fingerprint == simhash.fingerprint(changed).hex()
        assert got[i].near_next == 1 - simhash._ham(got[i].fingerprint, simhash.fingerprint(texts[i - 1]).hex()) / 128


@pytest.mark.parametrize(("blocks", "crowded"), [((4, 8), 512), ((4, 8), 2)])
def test_near_classes_equal_all_pairs(spark, tight, blocks, crowded):
    """Random fingerprints, chains of steps within the radius, and a crowd that shares a block but not much more."""
    rng = random.Random(6)
    prints = [rng.getrandbits(128) for _ in range(60)] + [0, 0]
    prints += [p ^ sum(1 << b for b in rng.sample(range(128), rng.randrange(1, 6))) for p in prints[:60]]
    prints += [p ^ sum(1 << b for b in rng.sample(range(128), rng.randrange(0, 4))) for p in prints[62:]]
    crowd = rng.getrandbits(32)
    prints += [crowd << 96 | rng.getrandbits(20) for _ in range(80)]
    root = list(range(len(prints)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, p in enumerate(prints):
        for j in range(i):
            if p and prints[j] and (p ^ prints[j]).bit_count() <= 3:
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    rows = [(k, signed(p >> 64), signed(p & ((1 << 64) - 1))) for k, p in enumerate(prints)]
    docs = spark.createDataFrame([*rows, (None, 5, 5), (None, 6, 5)], "doc_id long, f1 long, f2 long")
    got = {(r.f1, r.f2): r.class_id for r in simhash.near_classes(docs, blocks=blocks, crowded=crowded).collect()}
    assert got == {(a, b): find(k) for k, a, b in rows if a or b}


def test_near_classes_of_ties_and_nothing(spark):
    docs = spark.createDataFrame([(1, 7, 7), (1, 7, 6), (1, -1, 5), (2, -1, 4), (2, -1, 4)], "doc_id long, f1 long, f2 long")
    got = {(r.f1, r.f2): r.class_id for r in simhash.near_classes(docs).collect()}
    assert got == {(7, 7): 1, (7, 6): 1, (-1, 5): 1, (-1, 4): 1}
    assert simhash.near_classes(docs.limit(0)).count() == 0


def test_fingerprints_of_hard_rows(spark):
    rows = [(None, "null b"), (None, "null a"), (3, None), (3, ""), (2, "same"), (2, "same"), (1, "x y z " * 50_000)]
    got = sorted(((r.doc_id is not None, r.doc_id or 0, r.n_chars, r.near_next) for r in simhash.fingerprint_edits(spark.createDataFrame(rows, "doc_id long, text string"), run=2).collect()), key=str)
    assert len(got) == 7 and sorted(x[2] for x in got) == [0, 0, 4, 4, 6, 6, 300_000] and all(0 <= x[3] <= 1 for x in got)


def test_op4_classes_hold_equal_texts_together(spark):
    got = queries.QUERIES["op4_fingerprints"](spark, SF).toPandas()
    docs = spark.read.parquet(f"{SF}/documents.parquet").toPandas().fillna({"text": ""})
    prints = {d: simhash.fingerprint(t) for d, t in zip(docs["doc_id"], docs["text"], strict=True)}
    assert {d: bytes.fromhex(f) for d, f in zip(got["doc_id"], got["fingerprint"], strict=True)} == prints
    words = {d for d, p in prints.items() if any(p)}
    at = {d: int.from_bytes(p) for d, p in prints.items()}
    label = dict(zip(got["doc_id"], got["class_id"], strict=True))
    near = [(a, b) for a in words for b in words if a < b and (at[a] ^ at[b]).bit_count() <= 3]
    assert near and all(label[a] == label[b] for a, b in near) and all(label[d] == d for d in prints if d not in words)
    assert len(set(label.values())) == len(label) - len({b for _, b in near})


def test_token_tree_edits_equal_encoding_anew():
    counts, rng = token_counts.Counts(token_counts.read_ranks()), random.Random(1)
    for text in ("", "it's  we'll  go\n\nx", "Hello world, 12 times! " * 60):
        tree = token_counts.Tree.of(text, counts)
        for _ in range(60):
            text, _ = tree.edit(text, rng.randint(0, len(text)), rng.choice([0, 1, 5, len(text) // 3]), rng.choice(["", "x", " ", "'re", "\n\n", "12", " the end"]), counts)
            tree = token_counts.Tree.from_bytes(tree.to_bytes())
            assert tree.tokens == len(counts.encoding.encode_ordinary(text)) and tree.chars == len(text)


def test_pieces_equal_the_library():
    import sentencepiece

    enc, sp = sentencepieces.Encoder(sentencepieces.read_model()), sentencepiece.SentencePieceProcessor(model_file=sentencepieces.MODEL)
    rng = random.Random(2)
    texts = ["", " ", "  x", "a  ", "\n\t", "日本語 😀", " " * 37 + "x"] + ["".join(rng.choice("abcdefgh é.,'0 \nТ") for _ in range(rng.randrange(80))) for _ in range(300)]
    for t in texts:
        assert enc.encode(t).tolist() == sp.encode(t) and enc.decode(enc.encode(t)) == t


def test_unigram_models_take_the_best_sum():
    model = {"pieces": ["<unk>", "▁", "a", "b", "ab", "▁a", "bb"], "scores": [0.0, -1.5, -2.25, -2.0, -2.5, -3.0, -5.0], "normal": [False] + [True] * 6, "bytes": {}, "unknown": 0, "merges": False}
    enc, score = sentencepieces.Encoder(model), dict(zip(model["pieces"], model["scores"], strict=True))

    def brute(s):
        return max((score[p] + brute(s[len(p) :]) for p in model["pieces"][1:] if s.startswith(p)), default=float("-inf")) if s else 0.0

    for s in ("ab", "abb", "aabbab"):
        assert sum(model["scores"][i] for i in enc.encode(s)) == brute("▁" + s)


def test_chat_layouts(spark):
    records = ['{"messages": [{"role": "user", "content": "a"}, {"role": "assistant", "content": "b"}]}', '{"instruction": "i", "input": "", "output": "o"}', '{"conversations": [{"from": "human", "value": "h"}, {"from": "gpt", "value": "g"}]}', '{"other": 1}', "no json", None]
    got = chat.turns_from_json(spark.createDataFrame(list(enumerate(records)), "conv_id long, record string")).orderBy("conv_id", "turn").collect()
    assert [(r.conv_id, r.role, r.text) for r in got] == [(0, "user", "a"), (0, "assistant", "b"), (1, "user", "i"), (1, "assistant", "o"), (2, "user", "h"), (2, "assistant", "g"), (3, None, None), (4, None, None), (5, None, None)]


def test_chat_round_trip(spark):
    rng = random.Random(7)
    parts = ["###", "#", "\\", "</turn>", " ", "\n", ": ", "h", "e", "x"]
    rows = [(1, k, rng.choice(["user", "assistant", "a:b\n"]), "".join(rng.choice(parts) for _ in range(9))) for k in range(80)] + [(None, None, None, None)]
    turns = chat.turns_from_table(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    for r in chat.format_turns(turns).collect():
        assert chat.parse(r.segment) == (r.role, r.text)
        assert r.segment.count("### ") == 1 and r.segment.count("</turn>") == 1
        assert chat.unescape(r.segment[r.loss_start : r.loss_start + r.loss_len]) == (r.text if r.role == "assistant" else "")


def test_pipeline_stages(spark):
    import corpus_pipeline as p

    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    good = p.quality(spark, docs, SF).cache()
    assert good.columns == docs.columns and good.count() == quality_rules.quality_rules(docs).filter("kept").count()
    one = p.near(spark, p.lines(spark, good, SF), SF)
    assert one.columns == docs.columns and one.select("doc_id").distinct().count() == one.count()
    last = p.run(spark, SF)
    assert {"doc_id", "token_ids", "n_tokens"} <= set(last.columns) and last.filter("n_tokens <> size(token_ids)").count() == 0
    assert last.count() > 0 and len(p.STAGES) == 5 and not out


def test_chat_layouts_with_more_or_less_than_a_mapping(spark):
    records = ['{"id": 7, "messages": [{"role": "user", "content": "a", "name": "n"}, {"role": "assistant", "content": null, "tool_calls": [{"f": 1}]}]}', '{"messages": []}', "[" * 100_000, '{"prompt": "p", "response": {"deep": [1, "x"]}, "source": "s"}', '{"system": "s", "instruction": "i", "input": "x", "output": "o"}', ""]
    got = chat.turns_from_json(spark.createDataFrame([(k, r, "x") for k, r in enumerate(records)], "conv_id long, record string, turn string")).collect()
    assert [(r.conv_id, r.role, r.text) for r in got] == [(0, "user", "a"), (0, "assistant", ""), (1, None, None), (2, None, None), (3, None, None), (4, "system", "s"), (4, "user", "i"), (4, "user", "x"), (4, "assistant", "o"), (5, None, None)]
    assert all(r.layout for r in got if r.conv_id in (0, 1, 3, 4)) and not any(r.layout for r in got if r.conv_id in (2, 5))
    assert chat.turns_from_json(spark.createDataFrame([], "conv_id long, record string")).count() == 0


def test_chat_hard_rows(spark):
    rows = [(1, 1, None, None, "x"), (1, None, "assistant", "", "y"), (1, 1, "assistant", "a" * 300_000, "z"), (1, 1, "assistant", "b", "z"), (1, 1, "assistant", "b", "z"), (None, 2, "user", "u", None)]
    schema = "conv_id long, turn long, role string, text string, segment string"
    got = {r.conv_id: r for r in chat.read_back(chat.format_turns(chat.turns_from_table(spark.createDataFrame(rows, schema)))).collect()}
    assert (got[1].n_turns, got[1].loss_chars, got[None].n_turns, got[None].loss_chars) == (5, 300_002, 1, 0)
    said = "assistant\n\n" + "\n\n" + "assistant\n" + "a" * 300_000 + "\n" + "assistant\nb\n" * 2
    assert got[1].turns_sha256 == hashlib.sha256(said.encode()).hexdigest() and got[1].loss_sha256 == hashlib.sha256(("a" * 300_000 + "bb").encode()).hexdigest()
    assert chat.read_back(chat.format_turns(chat.turns_from_table(spark.createDataFrame([], schema)))).count() == 0
    with pytest.raises(ValueError, match="no mapping"):
        chat.turns_from_table(spark.createDataFrame([], "conv_id long, turn long, said string"))


def test_machine_scores_equal_the_sum_over_pairs():
    rng = np.random.default_rng(3)
    texts = [" ".join(f"w{k}" for k in rng.integers(0, 40, 12)) for _ in range(300)]
    labels = np.array([float("w1 " in t + " " and "w2" in t) for t in texts])
    m = toxicity.Machine.from_bytes(toxicity.train([toxicity.terms_of(t) for t in texts], labels).to_bytes())
    for t in [*texts[:40], "", None, "none of these"]:
        x = [int(np.flatnonzero(m.chosen == b)[0]) for b in toxicity.terms_of(t) if b in m.chosen]
        odds = m.bias + sum(m.weights[i] for i in x) + sum(float(m.factors[i] @ m.factors[j]) for a, i in enumerate(x) for j in x[:a])
        assert m.score(t) == pytest.approx(1 / (1 + np.exp(-odds)))


def test_toxicity_fits_on_one_row_of_an_id(spark):
    docs = spark.createDataFrame([(k % 40, f"bad you {k}" if k % 2 else f"good day {k}") for k in range(400)], "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(40)], "doc_id long, toxic int")
    m = toxicity.Machine.from_bytes(toxicity.fit(docs, labels))
    n = labels.filter(~labelled.held_out(F.col("doc_id"))).count()
    assert len(m.chosen) and 0 < n < 40 and m.score("bad") > 0.5 > m.score("good")


def test_quality_scores_equal_the_discriminant_by_force(spark):
    d = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    stats = textstats.text_stats(docs).selectExpr("doc_id", *[f"{e} as {n}" for n, e in quality_classifier.FEATURES.items()]).toPandas().set_index("doc_id")
    known = labelled.training_labels(labels, "quality").toPandas().set_index("doc_id")["label"]
    x, every = stats.loc[known.index].to_numpy(float), stats.to_numpy(float)
    both = np.concatenate((x, every))
    got = quality_classifier.quality_scores(docs, labels).toPandas().set_index("doc_id")["score"].loc[stats.index]
    scale, model = x.std(axis=0), []
    for k in (0, 1):
        part = (x / scale)[known.to_numpy() == k]
        c = np.cov(part.T, bias=True)
        c = 0.8 * c + 0.2 * max(np.trace(c) / len(c), 1e-3) * np.eye(len(c))
        away = both / scale - part.mean(axis=0)
        model.append(np.log((known == k).mean()) - 0.5 * np.log(np.linalg.det(c)) - 0.5 * np.einsum("ij,jk,ik->i", away, np.linalg.inv(c), away))
    odds = (model[1] - model[0])[len(x) :]
    assert got.to_numpy() == pytest.approx(1 / (1 + np.exp(-odds / quality_classifier.TEMPERATURE)), abs=1e-6)


def test_edits_equal_encoding_anew(spark):
    counts, rng = token_counts.Counts(token_counts.read_ranks()), random.Random(8)
    long = " ".join(f"w{i % 977}x{i % 31}" for i in range(30_000))
    texts = [None, "", "it's  we'll\n\nx 12", long, "a b c", "a b c", "\u00e9\u0301 \U0001f600 " * 20]
    edits = [None, [], *[[(rng.choice([None, 0, 3, 9, 10**6]), rng.choice([None, 0, 2, 50]), rng.choice([None, "", "x ", "'re", "\n\n", "12"])) for _ in range(6)] for _ in range(12)]]
    rows = [(k, t, e, "own", 5) for k, (t, e) in enumerate((t, e) for t in texts for e in edits)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, edits array<struct<at: int, removed: int, added: string>>, n_encoded string, n_tokens int")
    trees = token_counts.token_trees(docs)
    lost = trees.withColumn("tree", F.when(F.col("doc_id") % 3 > 0, F.col("tree")))
    for got in (token_counts.apply_edits(trees), token_counts.apply_edits(lost)):
        found = {r.doc_id: r for r in got.collect()}
        for k, text, es, *_ in rows:
            text = text or ""
            for at, removed, added in es or ():
                at = min(at or 0, len(text))
                text = text[:at] + (added or "") + text[at + (removed or 0) :]
            assert (found[k].text, found[k].n_tokens) == (text, len(counts.encoding.encode_ordinary(text)))
    assert token_counts.apply_edits(trees.limit(0)).count() == 0


def test_op6_equals_encoding_anew(spark):
    counts = token_counts.Counts(token_counts.read_ranks())
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = queries.QUERIES["op6_token_counts"](spark, SF).collect()
    assert {r.doc_id for r in got} == set(texts)
    for r in got:
        text = f"Document {r.doc_id}\n\n" + texts[r.doc_id]
        n = len(texts[r.doc_id])
        text = text[: n // 2] + text[n // 2 + n // 20 :]
        text = text[:n] + texts[r.doc_id][:40] + text[n + 5 :]
        size = lambda t: len(counts.encoding.encode_ordinary(t))
        assert (r.n_tokens_before, r.n_tokens_after, r.edited_sha256) == (size(texts[r.doc_id]), size(text), hashlib.sha256(text.encode()).hexdigest())


def test_decode_with_nulls_and_long_chunks(spark):
    rows = [(1, None), (2, []), (3, [None, 400]), (4, [400, 500])]
    got = {r.id: r.decoded for r in sentencepieces.decode(spark.createDataFrame(rows, "id long, token_ids array<int>")).collect()}
    enc = sentencepieces.Encoder(sentencepieces.read_model())
    assert got == {1: "", 2: "", 3: enc.decode([enc.unknown, 400]), 4: enc.decode([400, 500])}
    assert sentencepieces.decode(spark.createDataFrame([], "token_ids array<int>")).count() == 0
    text = "x" * 5000 + " y"
    assert enc.decode(enc.encode(text)) == text and all(len(c) <= sentencepieces.LONGEST for c in enc.chunks)


def test_models_that_change_texts_are_refused(tmp_path):
    import sentencepiece

    raw = open(sentencepieces.MODEL, "rb").read()
    sp = sentencepiece.SentencePieceProcessor(model_proto=raw)
    assert sp.decode(sp.encode(sentencepieces.PROBE)) == sentencepieces.PROBE
    try:
        from sentencepiece import sentencepiece_model_pb2 as pb
    except ImportError:
        pytest.skip("no reader of model files")
    for change in ("add_dummy_prefix", "remove_extra_whitespaces"):
        model = pb.ModelProto.FromString(raw)
        setattr(model.normalizer_spec, change, not getattr(model.normalizer_spec, change))
        (tmp_path / "other.model").write_bytes(model.SerializeToString())
        with pytest.raises(ValueError, match="normalises"):
            sentencepieces.read_model(str(tmp_path / "other.model"))


def linked_by_force(texts):
    """All pairs of texts that reach the threshold, by a product of the sets' 0/1 matrix with itself."""
    sets = [minhash.shingle_set(t) for t in texts]
    at = {int(h): k for k, h in enumerate(np.unique(np.concatenate(sets)))}
    m = np.zeros((len(sets), len(at)), np.float32)
    for i, s in enumerate(sets):
        m[i, [at[int(h)] for h in s]] = 1
    both, n = m @ m.T, m.sum(axis=1)
    return [(i, j) for i, j in zip(*np.nonzero(100 * both >= 75 * (n[:, None] + n[None, :] - both)), strict=True) if i < j]


@pytest.mark.parametrize(("small_node", "depth"), [(8, 10)])
def test_recall_of_links_at_the_threshold(spark, small_node, depth):
    """Families of which every two texts are alike by 60 to 70 percent, so that nodes hold hundreds of components, with pairs in them at 75 to 80 percent."""
    rng, texts = random.Random(11), []
    for family in range(2):
        common = [f"c{family}x{i}" for i in range(170)]
        for pair in range(150):
            shared, own = [f"p{family}x{pair}x{i}" for i in range(18 + pair % 8)], rng.randrange(24, 30)
            texts += [" ".join(common + shared + [f"o{family}x{pair}x{side}x{i}" for i in range(own)]) for side in (0, 1)]
    want = linked_by_force(texts)
    assert len(want) >= 250
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in minhash.near_dedup(docs, small_node=small_node, depth_limit=depth).collect()}
    found = sum(got[i] == got[j] for i, j in want)
    print("links found", found, "of", len(want), "with", small_node, depth)
    assert found / len(want) >= 0.99
    linked = set(want)
    assert len(set(got.values())) >= len(texts) - len(linked)


def test_texts_of_one_doc_id_stay_apart(spark):
    words = lambda k: " ".join(f"w{k}x{i}" for i in range(60))
    rows = [(1, words(1)), (1, words(2)), (2, words(1) + " more"), (3, words(2) + " more"), (4, words(4)), (4, words(4)), (5, words(4) + " x")]
    got = sorted(map(tuple, minhash.near_dedup(spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, id int")).collect()))
    assert got == [(1, 56, 1, True), (1, 56, 1, True), (2, 57, 1, False), (3, 57, 1, False), (4, 56, 4, True), (4, 56, 4, True), (5, 57, 4, False)]
    rows = [(1, words(1)), (2, words(2)), (2, words(1) + " more"), (3, words(2) + " more"), (3, words(3))]
    got = sorted(map(tuple, minhash.near_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()))
    assert got == [(1, 56, 1, True), (2, 56, 2, True), (2, 57, 1, False), (3, 56, 3, True), (3, 57, 2, False)]


def test_mix_of_repeated_and_missing_ids(spark):
    text = lambda n: " ".join("w" * n)
    rows = [(None, text(9), "a")] * 40 + [(1, text(7), "a")] * 50 + [(1, text(3 + k % 5), "b") for k in range(300)] + [(k, text(k % 9), None) for k in range(200)] + [(5, None, "c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mix(docs).toPandas()
    assert len(got) == len(rows) and (got["taken"] <= 3 * got["size"]).all()
    for _, part in got.groupby("source_size"):
        assert abs(part["taken"].sum() - part["target"].iloc[0]) <= 9
    again = mixing.repeat_to_targets(docs.withColumn("rows", F.lit(1)).withColumn("text_hash", F.lit("x")))
    assert again.columns == ["doc_id", "text", "source", "rows", "text_hash"]
    words = sum(len((r.text or "").split()) for r in again.collect())
    assert words == got["taken"].sum()
    assert mixing.repeat_to_targets(docs.limit(0)).count() == 0


def test_rows_of_one_id_keep_their_own_verdicts(spark):
    """One doc_id and text under two languages: the row that the rules reject goes, its twin stays."""
    good = lambda k: " ".join(f"word{(k * 7 + i) % 400}" for i in range(90))
    odd = lambda k: " ".join(f"#{k}x{i}" for i in range(90 + k % 20))
    rows = [(k, good(k), "en", "a", None) for k in range(600)] + [(5000 + k, odd(k), "de", "a", None) for k in range(200)]
    rows += [(10_000, odd(3), "en", "a", None), (10_000, odd(3), "de", "a", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, kept_1 string")
    verdicts = {r.lang: r.kept for r in quality_rules.quality_rules(docs, keep=("doc_id", "lang")).filter("doc_id = 10000").collect()}
    assert sorted(verdicts.values()) == [False, True]
    kept = quality_rules.keep_good(docs)
    assert {r.lang for r in kept.filter("doc_id = 10000").collect()} == {x for x, ok in verdicts.items() if ok} and kept.columns == docs.columns


def test_op7_equals_the_library(spark):
    """The query's own rows, of all documents, from the library's ids and texts."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=sentencepieces.MODEL)
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = {r.doc_id: (r.n_tokens, r.token_ids_sha256, r.decoded_sha256, r.round_trip) for r in sentencepieces.op7_sentencepieces(spark, SF).collect()}
    ids = {d: sp.encode(t) for d, t in texts.items()}
    assert got == {d: (len(x), sha(" ".join(map(str, x))), sha(sp.decode(x)), sp.decode(x) == texts[d]) for d, x in ids.items()}


def test_op8_equals_the_sum_over_pairs(spark):
    """The query's scores, of all documents, by the machine's definition: a weight each chosen term and a product of factors each pair."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    machine = toxicity.Machine.from_bytes(toxicity.fit(docs, labels))
    got = {r.doc_id: r for r in toxicity.op8_toxicity(spark, SF).collect()}
    for r in docs.collect():
        x = [machine.at[t] for t in toxicity.terms_of(r.text).tolist() if t in machine.at]
        pairs = sum(float(machine.factors[i] @ machine.factors[j]) for k, i in enumerate(x) for j in x[:k])
        score = 1 / (1 + np.exp(-(machine.bias + sum(float(machine.weights[i]) for i in x) + pairs)))
        assert abs(got[r.doc_id].score - score) < 1e-6 and got[r.doc_id].predicted == int(got[r.doc_id].score >= 0.5)
        assert got[r.doc_id].held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
