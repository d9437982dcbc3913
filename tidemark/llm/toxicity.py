"""Operator 8, toxicity: a factorization machine over hashed terms.

Terms are a text's distinct lower-cased words and their beginnings, hashed into
BUCKETS. The machine is fitted on a bounded sample of labelled documents: the
buckets that tell the labels apart are chosen by chi-square, and weights and
factors learned by stochastic gradients, so that pairs of terms (an insult and
whom it is aimed at) count beyond their sum. Scoring is one pass over the
documents without a shuffle.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, documents, lowered_words_of
from .labelled import held_out, training_labels

#: Labelled documents that the machine is fitted on, at most: those of the smallest hash of their id.
SAMPLE = 12_000
BUCKETS, CHOSEN, RANK = 1 << 20, 4096, 8
#: Bytes of a word's beginnings that are terms of their own, for inflected words.
PREFIXES = (4, 5, 6)
EPOCHS, BATCH, RATE, PENALTY, SEED = 12, 128, 0.1, 1e-4, 8
#: Chi-square below which a bucket is not chosen.
LEAST_CHI = 8.0
THRESHOLD = 0.5
#: Words that a worker remembers, and bytes of the longest of them; longer words are looked up anew.
_CACHE, _LONGEST = 200_000, 32
_STRIP = b".,;:!?\"'()[]{}"


def word_terms(word: bytes) -> tuple[int, ...]:
    """Buckets of a word and of its beginnings."""
    word = word.strip(_STRIP)
    parts = [b"w" + word] + [b"p" + word[:k] for k in PREFIXES if len(word) >= k]
    return tuple(xxhash.xxh3_64_intdigest(p) % BUCKETS for p in parts)


def terms_of(text: str | None) -> np.ndarray:
    return np.array(sorted({t for w in set(lowered_words_of(text)) for t in word_terms(w)}), np.int64)


class Machine:
    """bias + sum of weights + sum over pairs of dot products of factors, over the chosen buckets of a text."""

    def __init__(self, chosen: np.ndarray, bias: float, weights: np.ndarray, factors: np.ndarray):
        self.chosen, self.bias, self.weights, self.factors = chosen, bias, weights, factors
        self.at = {int(b): i for i, b in enumerate(chosen)}
        self.known: dict[bytes, tuple[int, ...]] = {}

    def features(self, text: str | None) -> list[int]:
        found: set[int] = set()
        for w in set(lowered_words_of(text)):
            hit = self.known.get(w)
            if hit is None:
                hit = tuple(self.at[t] for t in word_terms(w) if t in self.at)
                if len(w) <= _LONGEST:
                    if len(self.known) >= _CACHE:
                        self.known.clear()
                    self.known[w] = hit
            found.update(hit)
        return sorted(found)

    def score(self, text: str | None) -> float:
        x = self.features(text)
        v = self.factors[x]
        odds = self.bias + self.weights[x].sum() + 0.5 * ((v.sum(0) ** 2).sum() - (v**2).sum())
        return float(1 / (1 + np.exp(-np.clip(odds, -500, 500))))

    def to_bytes(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, chosen=self.chosen, bias=self.bias, weights=self.weights, factors=self.factors)
        return out.getvalue()

    @classmethod
    def from_bytes(cls, blob: bytes) -> Machine:
        x = np.load(io.BytesIO(blob))
        return cls(x["chosen"], float(x["bias"]), x["weights"], x["factors"])


def choose(rows: list[np.ndarray], labels: np.ndarray) -> np.ndarray:
    """The buckets of the largest chi-square between their presence and the label."""
    n, n1 = len(labels), labels.sum()
    if not 0 < n1 < n:
        return np.empty(0, np.int64)
    flat, each = np.concatenate(rows), np.repeat(labels, [len(r) for r in rows])
    ids, inverse, total = np.unique(flat, return_inverse=True, return_counts=True)
    with_1 = np.bincount(inverse, each, len(ids))
    a, b, c, d = with_1, total - with_1, n1 - with_1, n - n1 - total + with_1
    chi = n * (a * d - b * c) ** 2 / np.maximum(total * (n - total) * n1 * (n - n1), 1)
    keep = np.flatnonzero((chi >= LEAST_CHI) & (total >= 2))
    return np.sort(ids[keep[np.lexsort((ids[keep], -chi[keep]))][:CHOSEN]])


def train(rows: list[np.ndarray], labels: np.ndarray) -> Machine:
    """A machine fitted by adaptive stochastic gradients of the logistic loss; the same rows in the same order give the same machine."""
    rng = np.random.Generator(np.random.PCG64(SEED))
    chosen = choose(rows, labels)
    bias = float(np.log((labels.sum() + 1) / (len(labels) - labels.sum() + 2)))
    weights, factors = np.zeros(len(chosen)), rng.normal(0, 0.05, (len(chosen), RANK))
    if not len(chosen):
        return Machine(chosen, bias, weights, factors)
    xs = []
    for r in rows:
        at = np.minimum(np.searchsorted(chosen, r), len(chosen) - 1)
        xs.append(at[chosen[at] == r])
    gw, gv, gb = np.full(len(chosen), 1e-8), np.full((len(chosen), RANK), 1e-8), 1e-8
    for _ in range(EPOCHS):
        order = rng.permutation(len(rows))
        for k in range(0, len(order), BATCH):
            batch = order[k : k + BATCH]
            flat, owner = np.concatenate([xs[i] for i in batch]), np.repeat(np.arange(len(batch)), [len(xs[i]) for i in batch])
            v = factors[flat]
            sums = np.zeros((len(batch), RANK))
            np.add.at(sums, owner, v)
            squares = np.bincount(owner, (v**2).sum(1), len(batch))
            odds = bias + np.bincount(owner, weights[flat], len(batch)) + 0.5 * ((sums**2).sum(1) - squares)
            error = (1 / (1 + np.exp(-np.clip(odds, -50, 50))) - labels[batch]) / len(batch)
            slope = error[owner]
            dw, dv = np.zeros_like(weights), np.zeros_like(factors)
            np.add.at(dw, flat, slope)
            np.add.at(dv, flat, slope[:, None] * (sums[owner] - v))
            touched = np.unique(flat)
            dw[touched] += PENALTY * weights[touched] / len(batch)
            dv[touched] += PENALTY * factors[touched] / len(batch)
            gw[touched] += dw[touched] ** 2
            gv[touched] += dv[touched] ** 2
            gb += error.sum() ** 2
            weights[touched] -= RATE * dw[touched] / np.sqrt(gw[touched])
            factors[touched] -= 0.3 * RATE * dv[touched] / np.sqrt(gv[touched])
            bias -= RATE * error.sum() / np.sqrt(gb)
    return Machine(chosen, float(bias), weights, factors)


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> bytes:
    """The machine's bytes, fitted in one task on at most `sample` labelled documents; of rows that repeat a doc_id one is taken."""
    picked = training_labels(labels, "toxic").orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").join(F.broadcast(picked), "doc_id")

    def terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [terms_of(t).astype(np.int32).tobytes() for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("label"), pa.array(found, pa.binary())], ["doc_id", "label", "terms"])

    def learn(pdf):
        pdf = pdf.sort_values(["doc_id", "terms"])
        made = train([np.frombuffer(x, np.int32).astype(np.int64) for x in pdf["terms"]], pdf["label"].to_numpy(float))
        return pdf.iloc[:1].assign(machine=[made.to_bytes()])[["machine"]]

    each = rows.mapInArrow(terms, "doc_id bigint, label int, terms binary").groupBy("doc_id", "label").agg(F.min("terms").alias("terms"))
    made = each.groupBy().applyInPandas(learn, "machine binary")
    got = cut(made).first()
    return bytes(got["machine"]) if got else train([], np.empty(0)).to_bytes()


def toxicity_scores(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row for each row of docs(doc_id, text, ...): doc_id, held_out, score, predicted.

    score is the machine's probability of label 1 from the words of the whole text alone. Null and
    empty texts have the probability that the bias gives, as have all if no labels can be learned
    from. Rows that repeat are scored alike; other columns are ignored.
    """
    sent = docs.sparkSession.sparkContext.broadcast(fit(docs, labels))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = Machine.from_bytes(sent.value)
        for b in batches:
            scores = [machine.score(t) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(scores, pa.float64())], ["doc_id", "score"])

    scored = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(run, "doc_id bigint, score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_scores(documents(spark, sf_dir), documents(spark, sf_dir, "labels"))
