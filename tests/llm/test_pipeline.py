"""The pipeline's stages against brute force, over documents with planted repeats."""

import glob
import os

import duckdb
import pandas as pd

from tidemark.llm import line_dedup, minhash, mixing, quality_rules, sentencepieces
from tidemark.llm.common import WHITE_SPACE, shared_dir

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, source string"


def near_by_force(rows):
    """The rows that near dedup keeps: all pairs of sets compared, the first of each component by id (null last), md5 of the text."""
    import hashlib

    order = lambda r: (r[0] is None, r[0] or 0, "" if r[1] is None else hashlib.md5(r[1].encode()).hexdigest())
    one = {}
    for r in sorted(rows, key=lambda r: (*order(r), r[2])):
        one.setdefault((r[0], r[1]), r)
    found = [(r, set(minhash.shingle_set(r[1]).tolist())) for r in sorted(one.values(), key=order)]
    label = list(range(len(found)))
    for i, (_, a) in enumerate(found):
        for j, (_, b) in enumerate(found[:i]):
            if a and len(a & b) * 100 >= len(a | b) * 75 and label[i] != label[j]:
                low, high = sorted((label[i], label[j]))
                label = [low if x == high else x for x in label]
    return [r for k, (r, _) in enumerate(found) if label[k] == k]


def test_drop_near_with_repeated_and_missing_ids(spark):
    text = lambda k, n=40: " ".join(f"w{k}x{i}" for i in range(n))
    near = text(1) + " tail"
    rows = [(1, text(1), "a"), (1, text(1), "a"), (1, text(1), "b"), (2, near, "a"), (3, text(3), "a"), (3, text(4), "a"), (4, text(4) + " more", "b")]
    rows += [(None, text(1), "a"), (None, text(5), "a"), (None, text(5), "a"), (None, text(5) + " end", "a"), (None, text(6), "b"), (None, None, "a"), (5, None, "a"), (5, "", "a"), (6, text(7), "a")]
    got = [tuple(r) for r in minhash.drop_near(spark.createDataFrame(rows, DOCS)).collect()]
    want = near_by_force(rows)
    assert sorted(map(str, got)) == sorted(map(str, want))
    unique = [(i, t, s) for i, (_, t, s) in enumerate(rows)]
    got = [tuple(r) for r in minhash.drop_near(spark.createDataFrame(unique, DOCS)).collect()]
    assert sorted(map(str, got)) == sorted(map(str, near_by_force(unique)))


def sql(query, documents):
    con = duckdb.connect()
    con.register("documents", documents)
    return con.sql(query).df()


def lines_by_force(docs):
    """docs without the lines that at least MIN_DOCS documents hold, but in that of the largest id."""
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    key = lambda line: line.strip(WHITE_SPACE).translate(lower)
    held = {}
    for d, text in zip(docs["doc_id"], docs["text"], strict=True):
        for line in (text or "").split("\n"):
            if len(key(line)) >= line_dedup.MIN_CHARS:
                held.setdefault(key(line), set()).add(d)
    goes = lambda d, line: len(held.get(key(line), ())) >= line_dedup.MIN_DOCS and d != max(held[key(line)])
    text = ["\n".join(line for line in (t or "").split("\n") if not goes(d, line)) for d, t in zip(docs["doc_id"], docs["text"], strict=True)]
    return docs.assign(text=text, n_chars=[len(t) for t in text])


def test_five_stages_equal_brute_force(spark, tmp_path):
    import corpus_pipeline as p
    import sentencepiece

    docs = pd.read_parquet(f"{SF}/documents.parquet")[["doc_id", "text", "lang", "source", "n_chars"]]
    good = set(sql(quality_rules.OP9_SQL, docs).query("kept")["doc_id"])
    long = docs[docs["doc_id"].isin(good) & (docs["text"].str.len() > 400)].sort_values("doc_id")
    line = "\nThis planted line is repeated in a number of different documents."
    docs.loc[long.index[:9], "text"] += line
    copies = docs.loc[long.index[9:15]].assign(doc_id=lambda x: x["doc_id"] + 1_000_000, text=lambda x: x["text"] + " and a little more")
    docs = pd.concat([docs, copies], ignore_index=True).assign(n_chars=lambda x: x["text"].fillna("").str.len())
    spark.createDataFrame(docs).write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet").toPandas()
    p.run(spark, str(tmp_path))
    folder = max(glob.glob(f"{shared_dir(spark).removeprefix('file:')}/pipeline-*"), key=os.path.getmtime)
    got = [spark.read.parquet(f"{folder}/{k}").toPandas() for k in range(5)]
    rows = lambda x: sorted(repr((r.doc_id, r.text, r.lang, r.source, r.n_chars)) for r in x.itertuples())

    one = docs[docs["doc_id"].isin(set(sql(quality_rules.OP9_SQL, docs).query("kept")["doc_id"]))]
    assert 0 < len(one) < len(docs) and rows(got[0]) == rows(one)
    two = lines_by_force(one)
    assert (two["text"].to_numpy() != one["text"].to_numpy()).sum() >= line_dedup.MIN_DOCS - 1 and rows(got[1]) == rows(two)
    three = two[two["doc_id"].isin({r[0] for r in near_by_force([(r.doc_id, r.text, "") for r in two.itertuples()])})]
    assert 0 < len(three) < len(two) and rows(got[2]) == rows(three)
    taken = sql(mixing.OP5_SQL, three).set_index("doc_id")["copies"]
    four = three.loc[three.index.repeat(three["doc_id"].map(taken))]
    assert taken.max() > 1 and rows(got[3]) == rows(four)
    sp = sentencepiece.SentencePieceProcessor(model_file=sentencepieces.MODEL)
    five = sorted(repr((r.doc_id, len(sp.encode(r.text)), sp.encode(r.text))) for r in four.itertuples())
    assert sorted(repr((r.doc_id, r.n_tokens, [int(i) for i in r.token_ids])) for r in got[4].itertuples()) == five
    print("rows by stage", len(docs), *map(len, got))


def test_stages_on_hard_rows_and_no_rows(spark):
    """Nulls in any column, empty and very long texts, ties, repeated rows, and columns named as the stages' own."""
    import corpus_pipeline as p

    long = " ".join(f"w{i % 977}x{i % 31}" for i in range(20_000))
    fine = lambda k: " ".join(f"word{k}x{i}" for i in range(80))
    rows = [(1, None, None, None, None, "x"), (2, "", "en", "a", 0, None), (3, " \n\t ", "en", "a", 4, None), (4, long, "en", None, None, None), (4, long, "en", None, None, None), (None, fine(1), "en", "b", 5, None), (None, fine(1), "en", "b", 5, "y"), (5, fine(1), None, "b", 5, None), (6, fine(2), "de", "a", 9, None), (6, fine(3), "de", "a", 9, None)]
    hard = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, text_hash string")
    kept = {"quality rules": 7, "line dedup": 10, "near dedup": 7}
    for k, (name, stage) in enumerate(p.STAGES):
        got = stage(spark, hard, SF)
        last = k == len(p.STAGES) - 1
        assert set(got.columns) == (set(hard.columns) - {"text"} | {"token_ids", "n_tokens"} if last else set(hard.columns))
        n = got.count()
        assert n == kept.get(name, n) and (n > 0) and (not last or n == len(rows))
        assert stage(spark, hard.limit(0), SF).count() == 0
