"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Words (lower-cased letters, digits, non-ASCII) give unigrams, bigrams and pairs with one word
between; a text's features are the distinct buckets of their hashes. Each coordinate has its own
rate from its own gradients, and L1 keeps the weights of few buckets, which are broadcast.

Defined results: a null or empty text scores as the bias alone; without usable labels, or with one
class only, the score is the smoothed share of toxic labels; repeated rows score alike; further
columns are ignored. Labels with a null are left out; the larger of two labels of a document counts.
Only the text is an input of a score.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import map_batches, raw_texts, table
from .linear import BITS, SAMPLE_ROWS, dense, fitted, plain_hashes, sampled, sigmoid, word_features

#: Weights' key of the bias.
BIAS = -1
THRESHOLD = 0.3


def features(text: bytes) -> np.ndarray:
    return word_features(plain_hashes(text))


def ftrl(
    rows: list[np.ndarray],
    answers: np.ndarray,
    alpha: float = 1.0,
    beta: float = 1.0,
    l1: float = 6.0,
    l2: float = 0.5,
    epochs: int = 6,
) -> dict[int, float]:
    """Non-zero weights after some passes over the rows (distinct buckets; answers 0 or 1)."""
    share = (answers.sum() + 1.0) / (len(answers) + 2.0)
    bias, bias_n = float(np.log(share / (1 - share))), 0.0
    if answers.min() == answers.max():
        return {BIAS: bias}
    z, n = np.zeros(1 << BITS), np.zeros(1 << BITS)
    for _ in range(epochs):
        for row, answer in zip(rows, answers.tolist(), strict=True):
            zi, ni = z[row], n[row]
            w = -(zi - np.sign(zi) * l1) / ((beta + np.sqrt(ni)) / alpha + l2)
            w[np.abs(zi) <= l1] = 0.0
            g = float(sigmoid(w.sum() + bias)) - answer
            # Feature values are 1, so the gradient is the same for each of the row's coordinates.
            step = (np.sqrt(ni + g * g) - np.sqrt(ni)) / alpha
            z[row] = zi + g - step * w
            n[row] = ni + g * g
            bias_n += g * g
            bias -= alpha / (beta + bias_n**0.5) * g
    kept = np.flatnonzero(np.abs(z) > l1)
    w = -(z[kept] - np.sign(z[kept]) * l1) / ((beta + np.sqrt(n[kept])) / alpha + l2)
    return {BIAS: bias} | dict(zip(kept.tolist(), w.tolist(), strict=True))


def fit_toxicity(
    docs: DataFrame, labels: DataFrame, keep: Column | None = None, rows: int = SAMPLE_ROWS
) -> dict[int, float]:
    """Weights by bucket from labels (doc_id, toxic) for which `keep` holds; bounded by `rows`."""
    toxic = F.when(F.col("toxic").isin(0, 1), F.col("toxic"))
    sample = sampled(docs, labels, toxic, rows, F.lit(True) if keep is None else keep)
    return fitted(sample, features, ftrl) or {BIAS: 0.0}


def score_toxicity(docs: DataFrame, weights: dict[int, float]) -> DataFrame:
    """(doc_id, score): the probability of label 1 for every whole text. No shuffle."""
    model = docs.sparkSession.sparkContext.broadcast((dense(weights), weights.get(BIAS, 0.0)))

    def work(batch: pa.RecordBatch):
        weight, bias = model.value
        sums = [float(weight[features(text)].sum()) for text in raw_texts(batch.column(1))]
        scores = sigmoid(np.array(sums) + bias)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(scores, pa.float64())], ["doc_id", "score"]
        )

    source = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return map_batches(source, work, "doc_id long, score double")


def query(spark: SparkSession, folder: str) -> DataFrame:
    """op7: every document; labels whose crc32(doc_id) mod 4 is 2 are never learnt from."""
    docs = table(spark, folder, "documents")
    held_out = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == 2
    weights = fit_toxicity(docs, table(spark, folder, "labels"), ~held_out)
    return score_toxicity(docs, weights).select(
        "doc_id",
        F.coalesce(held_out, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
