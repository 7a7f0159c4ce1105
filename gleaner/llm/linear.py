"""What the two linear text models share: hashed features, the training sample, one-task fits.

A model is fitted on a bounded sample of labelled rows (SAMPLE_ROWS, those with the smallest hash of
their doc_id) inside one Spark task; its non-zero weights, at most 2**BITS of them, are broadcast.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import PLAIN, mixed, raw_texts, small_batches, word_hashes

#: The documented bound of a fit: labelled rows it reads, with their texts.
SAMPLE_ROWS = 12_000
#: Features are hashed to this many bits.
BITS = 20
#: A feature must be in at least so many sampled texts; rarer ones cannot pass the L1 threshold.
LEAST_TEXTS = 3

_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))


def to_buckets(hashes: np.ndarray) -> np.ndarray:
    return (mixed(hashes) >> np.uint64(64 - BITS)).astype(np.int32)


def word_features(words: np.ndarray, order: int = 2, skip: int = 1) -> np.ndarray:
    """Buckets of one text's word n-grams up to `order` and of pairs with up to `skip` words between."""
    parts = [words]
    gram = words
    for n in range(2, order + 1):
        gram = gram[:-1] * _A + words[n - 1 :] * _B if len(gram) > 1 else gram[:0]
        parts.append(gram)
    for gap in range(1, skip + 1):
        if len(words) > gap + 1:
            parts.append(words[: -gap - 1] * _A + words[gap + 1 :] * _C + np.uint64(gap))
    return np.unique(to_buckets(np.concatenate(parts)))


def plain_hashes(text: bytes) -> np.ndarray:
    return word_hashes(text.translate(PLAIN).split())


def sampled(docs: DataFrame, labels: DataFrame, grade: Column, rows: int, keep: Column) -> DataFrame:
    """(text, grade) of at most `rows` labelled documents for which `keep` holds.

    A document labelled more than once takes its greatest grade; rows without a grade or id, and
    labels of missing documents, do not count. The sample is the same whatever the partitions.
    """
    graded = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), grade.cast("int").alias("grade"))
        .where(F.col("doc_id").isNotNull() & F.col("grade").isNotNull())
        .where(keep)
        .groupBy("doc_id")
        .agg(F.max("grade").alias("grade"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(rows)
    )
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string"))
    # At most `rows` rows of 12 bytes.
    return texts.join(F.broadcast(graded), "doc_id").select("doc_id", "text", "grade")


def fitted(
    sample: DataFrame,
    features: Callable[[bytes], np.ndarray],
    fit: Callable[[list[np.ndarray], np.ndarray], dict[int, float]],
) -> dict[int, float]:
    """Weights by bucket. Features are made where the texts are; one task then fits on them."""

    def featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [features(text).astype(np.int32).tobytes() for text in raw_texts(batch.column(1))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(made, pa.binary())],
                ["doc_id", "grade", "features"],
            )

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, grades, order = [], [], []
        for batch in batches:
            order += batch.column(0).to_pylist()
            grades += batch.column(1).to_pylist()
            rows += [np.frombuffer(value, np.int32) for value in batch.column(2).to_pylist()]
        by = sorted(range(len(rows)), key=lambda i: (_spread(order[i]), order[i], grades[i]))
        rows, answers = [rows[i] for i in by], np.array([grades[i] for i in by], np.int64)
        weights: dict[int, float] = {}
        if rows:
            counts = np.bincount(np.concatenate(rows), minlength=1 << BITS)
            rows = [row[counts[row] >= LEAST_TEXTS] for row in rows]
            weights = fit(rows, answers)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(list(weights), pa.int32()),
                pa.array(list(weights.values()), pa.float64()),
            ],
            ["bucket", "weight"],
        )

    made = small_batches(sample.select("doc_id", "text", "grade")).mapInArrow(
        featurise, "doc_id long, grade int, features binary"
    )
    # The sample is bounded, so one task may hold its features; featurising stays spread.
    rows = made.repartition(1).mapInArrow(train, "bucket int, weight double").collect()
    return {row["bucket"]: row["weight"] for row in rows}


def _spread(doc_id: int) -> int:
    return int(mixed(np.array([doc_id], np.int64).view(np.uint64))[0])


def dense(weights: dict[int, float]) -> np.ndarray:
    """Weights by bucket as an array of 2**BITS floats: 4 MB, whatever the data."""
    out = np.zeros(1 << BITS, np.float32)
    for bucket, weight in weights.items():
        if bucket >= 0:
            out[bucket] = weight
    return out


def sigmoid(x: np.ndarray | float) -> np.ndarray | float:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -35, 35)))
