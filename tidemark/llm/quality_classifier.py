"""Operator 3, quality classifier: regularised quadratic discriminant over transformed document statistics.

Statistics are JVM-side expressions, made once per text. Fitting is one
aggregate of counts, sums and products per class, of which two rows reach the
driver; covariances are shrunk, factored once, and the factors scored as plain
expressions: forward substitution gives the Mahalanobis distance to each class.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, documents
from .labelled import held_out, training_labels
from .textstats import text_stats

#: Transformed whole-text statistics: length and word length steadied for short texts, the symbols' rate
#: saturating, the share of words in repeated windows cubed, so that clean texts with a repeated passage stay clean.
FEATURES = {
    "length": "ln(5e1 + n_words)",
    "word_length": "(1e2 + word_chars) / (2e1 + n_words)",
    "symbols": "1e1 * n_symbols / (1e1 * n_symbols + greatest(n_words, 1))",
    "repeats": "pow(cast(n_repeat_words as double) / greatest(n_words, 1), 3)",
}
NAMES = list(FEATURES)
#: Share of the spherical covariance that each class's own is shrunk towards, and what divides the log-odds, which densities overstate.
SHRINKAGE, TEMPERATURE = 0.2, 4.0
THRESHOLD = 0.3


@dataclass(frozen=True)
class Discriminant:
    """A class: its constant, mean and the inverse of its covariance's Cholesky factor, all over scaled statistics."""

    constant: float
    mean: tuple[float, ...]
    factor: tuple[tuple[float, ...], ...]

    def log_density(self, x: list[Column]) -> Column:
        y: list[Column] = []
        for i, row in enumerate(self.factor):
            rest = x[i] - F.lit(self.mean[i])
            for k in range(i):
                rest = rest - F.lit(row[k]) * y[k]
            y.append(rest / F.lit(row[i]))
        return F.lit(self.constant) - sum((v * v for v in y[1:]), y[0] * y[0]) * F.lit(0.5)


def fit(rows: DataFrame, shrinkage: float = SHRINKAGE) -> tuple[tuple[float, ...], list[Discriminant]] | None:
    """Scales of the statistics and both classes' discriminants from rows(label, statistics); None if a class has no row."""
    d = len(NAMES)
    sums = [F.sum(n) for n in NAMES] + [F.sum(F.col(NAMES[i]) * F.col(NAMES[j])) for i in range(d) for j in range(i + 1)]
    got = {r[0]: np.array(r[1:], float) for r in rows.groupBy("label").agg(F.count("*"), *sums).collect()}
    if set(got) != {0, 1}:
        return None
    parts = {}
    for k, v in got.items():
        second = np.zeros((d, d))
        second[np.tril_indices(d)] = v[1 + d :] / v[0]
        mean = v[1 : 1 + d] / v[0]
        parts[k] = v[0], mean, second + np.tril(second, -1).T - np.outer(mean, mean)
    n = sum(p[0] for p in parts.values())
    centre = sum(p[0] * p[1] for p in parts.values()) / n
    total = sum(p[0] * (p[2] + np.outer(p[1] - centre, p[1] - centre)) for p in parts.values()) / n
    scale = np.sqrt(np.maximum(np.diag(total), 1e-12))
    out = []
    for k in (0, 1):
        m, mean, cov = parts[k]
        cov = cov / np.outer(scale, scale)
        cov = (1 - shrinkage) * cov + shrinkage * max(np.trace(cov) / d, 1e-3) * np.eye(d)
        factor = np.linalg.cholesky(cov)
        constant = np.log(m / n) - np.log(np.diag(factor)).sum()
        out.append(Discriminant(float(constant), tuple((mean / scale).tolist()), tuple(map(tuple, factor.tolist()))))
    return tuple(scale.tolist()), out


def quality_scores(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row for each row of docs(doc_id, text, ...): doc_id, held_out, score, predicted.

    score is the tempered probability of label 1; only whole-text statistics enter it. Null and
    empty texts are scored as texts of no words. If the training labels lack a class, every score
    is 0.5. Other columns are ignored; an empty table gives none.
    """
    stats = text_stats(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text"))
    stats = cut(stats.select("doc_id", *[F.expr(e).alias(n) for n, e in FEATURES.items()]))
    model = fit(stats.join(training_labels(labels, "quality"), "doc_id"))
    if model is None:
        score = F.lit(0.5)
    else:
        scale, (low, high) = model
        x = [F.col(n) / F.lit(s) for n, s in zip(NAMES, scale, strict=True)]
        score = F.lit(1.0) / (F.lit(1.0) + F.exp((low.log_density(x) - high.log_density(x)) / F.lit(TEMPERATURE)))
    scored = stats.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score.alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(documents(spark, sf_dir), documents(spark, sf_dir, "labels"))
