"""Quality: ordinal cumulative-link regression of graded ratings on hashed text.

Grades are whole numbers from 0. P(grade <= k) = sigmoid(t_k - s) with ordered thresholds t_k and one
score s = sum of the weights of the text's features, shared by all grades. Features are hashed words,
hashed word shapes (Aaa., AAA!!, aaa|) and the text's tallies in steps: repeated neighbours, distinct
words, capitals, marks, word length. Predictions are the expected grade and the tail probability
P(grade >= `at_least`), on which documents are selected.

The driver's labels are graded 0 for low quality, 1 for good but toxic, 2 for good.

Defined results: a null or empty text has the feature of an empty text only; without labels every
tail probability is 1 and all documents stay; grades nobody has get no threshold of their own;
repeated rows score alike; further columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from .common import (
    DOCUMENT_SCHEMA,
    PLAIN,
    document_columns,
    map_batches,
    raw_texts,
    table,
    word_hashes,
)
from .linear import BITS, SAMPLE_ROWS, dense, fitted, sampled, sigmoid, to_buckets

#: Thresholds are the weights of keys -1, -2, ... in order.
AT_LEAST = 1
SELECT = 0.2

# Capitals to A, other letters and non-ASCII to a, digits to 0; marks stay as they are.
_SHAPE = bytes(
    0x41
    if 0x41 <= b <= 0x5A
    else 0x61
    if 0x61 <= b <= 0x7A or b >= 0x80
    else 0x30
    if 0x30 <= b <= 0x39
    else b
    for b in range(256)
)
_MARKS = bytes(b for b in range(0x21, 0x7F) if not chr(b).isalnum())


def _short(shape: bytes) -> bytes:
    """A word's shape with runs as one: its first two and its last three characters' classes."""
    return shape[:2] + b"~" + shape[-3:] if len(shape) > 5 else shape


def features(text: bytes) -> np.ndarray:
    """Distinct buckets of one text."""
    raw = text.split()
    if not raw:
        return to_buckets(word_hashes([b"\0empty"]))
    words = word_hashes(raw)
    size = len(raw)
    same = np.count_nonzero(words[1:] == words[:-1]) / size
    apart = len(np.unique(words)) / size
    letters = max(1, len(text) - text.count(b" "))
    capitals = len(text) - len(text.translate(None, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
    marks = len(text) - len(text.translate(None, _MARKS))
    length = size.bit_length()
    tallies = [
        f"\0same{int(same * 10)}",
        f"\0apart{int(apart * 10)},{length}",
        f"\0capitals{int(10 * capitals / letters)}",
        f"\0marks{int(20 * marks / letters)}",
        f"\0long{min(15, letters // size)}",
        f"\0size{length}",
    ]
    shapes = {_short(shape) for shape in text.translate(_SHAPE).split()}
    hashed = [xxh3_64_intdigest(b"\1" + shape) for shape in shapes]
    hashed += [xxh3_64_intdigest(tally) for tally in tallies]
    plain = word_hashes(text.translate(PLAIN).split())
    return np.unique(to_buckets(np.concatenate((plain, np.array(hashed, np.uint64)))))


def _proximal(z, n, alpha: float, beta: float, l1: float, l2: float) -> np.ndarray:
    """Weights that summed gradients z and squared gradients n stand for."""
    w = -(z - np.sign(z) * l1) / ((beta + np.sqrt(n)) / alpha + l2)
    return np.where(np.abs(z) > l1, w, 0.0)


def cumulative_link(
    rows: list[np.ndarray],
    grades: np.ndarray,
    alpha: float = 0.3,
    beta: float = 1.0,
    l1: float = 4.0,
    l2: float = 0.5,
    rate: float = 0.1,
    epochs: int = 5,
) -> dict[int, float]:
    """Weights by bucket, and thresholds under -1, -2, ..., by per-coordinate proximal steps.

    Thresholds are t_0 and t_k = t_(k-1) + exp(d_k), so their order holds throughout. L1 keeps the
    buckets whose summed gradient passes it; words seen in a few texts stay at zero.
    """
    top = int(grades.max())
    if top <= 0 or grades.min() == top:
        return {}
    below = np.array([(grades <= k).mean() for k in range(top)])
    start = np.log((below + 1e-3) / (1 - below + 1e-3))
    base, gaps = start[0], np.log(np.maximum(np.diff(start), 1e-2))
    z, n = np.zeros(1 << BITS), np.zeros(1 << BITS)
    tn = np.full(top, 1.0)
    for _ in range(epochs):
        for row, grade in zip(rows, grades.tolist(), strict=True):
            cuts = base + np.concatenate(([0.0], np.cumsum(np.exp(gaps))))
            zi, ni = z[row], n[row]
            w = _proximal(zi, ni, alpha, beta, l1, l2)
            s = w.sum()
            high = float(sigmoid(cuts[grade] - s)) if grade < top else 1.0
            low = float(sigmoid(cuts[grade - 1] - s)) if grade > 0 else 0.0
            p = max(high - low, 1e-9)
            g = 1.0 - high - low  # of the log-likelihood by -s
            z[row] = zi + g - (np.sqrt(ni + g * g) - np.sqrt(ni)) / alpha * w
            n[row] = ni + g * g
            by_cut = np.zeros(top)
            if grade < top:
                by_cut[grade] += high * (1 - high) / p
            if grade > 0:
                by_cut[grade - 1] -= low * (1 - low) / p
            tails = np.cumsum(by_cut[::-1])[::-1]  # base and each gap move all later cuts
            move = np.concatenate((tails[:1], tails[1:] * np.exp(gaps)))
            tn += move * move
            move = rate * move / np.sqrt(tn)
            base += move[0]
            gaps += move[1:]
    cuts = base + np.concatenate(([0.0], np.cumsum(np.exp(gaps))))
    kept = np.flatnonzero(np.abs(z) > l1)
    w = _proximal(z[kept], n[kept], alpha, beta, l1, l2)
    return {-1 - k: float(cut) for k, cut in enumerate(cuts)} | dict(
        zip(kept.tolist(), w.tolist(), strict=True)
    )


def fit_quality(
    docs: DataFrame, labels: DataFrame, grade: Column, keep: Column | None = None,
    rows: int = SAMPLE_ROWS,
) -> dict[int, float]:
    """The model, from labels' column expression `grade`; bounded by `rows`."""
    sample = sampled(docs, labels, grade, rows, F.lit(True) if keep is None else keep)
    return fitted(sample, features, cumulative_link)


def _predictor(spark: SparkSession, weights: dict[int, float]):
    """A function of texts that gives expected grades and P(grade >= k) for k = 1, 2, ..."""
    cuts = np.array([weights[key] for key in sorted((k for k in weights if k < 0), reverse=True)])
    model = spark.sparkContext.broadcast((dense(weights), cuts))

    def predict(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        weight, cuts = model.value
        sums = np.array([float(weight[features(text)].sum()) for text in texts])
        tails = 1.0 - sigmoid(cuts[None, :] - sums[:, None])
        return tails.sum(axis=1), tails

    return predict


def _tail(tails: np.ndarray, at_least: int) -> np.ndarray:
    known = 1 <= at_least <= tails.shape[1]
    return tails[:, at_least - 1] if known else np.full(len(tails), float(tails.shape[1] == 0))


def grade_quality(docs: DataFrame, weights: dict[int, float], at_least: int = AT_LEAST) -> DataFrame:
    """(doc_id, expected_grade, tail): no shuffle."""
    predict = _predictor(docs.sparkSession, weights)

    def work(batch: pa.RecordBatch):
        expected, tails = predict(raw_texts(batch.column(1)))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(expected), pa.array(_tail(tails, at_least))],
            ["doc_id", "expected_grade", "tail"],
        )

    source = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return map_batches(source, work, "doc_id long, expected_grade double, tail double")


def select_quality(
    docs: DataFrame, weights: dict[int, float], at_least: int = AT_LEAST, least: float = SELECT
) -> DataFrame:
    """documents whose P(grade >= at_least) is `least` or more, unchanged."""
    predict = _predictor(docs.sparkSession, weights)

    def work(batch: pa.RecordBatch):
        _, tails = predict(raw_texts(batch.column(1)))
        yield batch.filter(pa.array(_tail(tails, at_least) >= least))

    return map_batches(document_columns(docs), work, DOCUMENT_SCHEMA)


def graded() -> Column:
    """The grade of a row of labels."""
    return F.when(F.col("quality") == 0, 0).when(F.col("toxic") == 1, 1).when(F.col("quality") == 1, 2)


def query(spark: SparkSession, folder: str) -> DataFrame:
    """op1: every document graded; a quarter of the labels (crc32 mod 4 = 2) is never learnt from."""
    docs = table(spark, folder, "documents")
    held_out = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == 2
    weights = fit_quality(docs, table(spark, folder, "labels"), graded(), ~held_out)
    return grade_quality(docs, weights).select(
        "doc_id",
        F.coalesce(held_out, F.lit(False)).alias("held_out"),
        "expected_grade",
        "tail",
        (F.col("tail") >= SELECT).alias("selected"),
    )
