"""Substring dedup by seed and extend: repeated runs of words are removed, the first one stays.

Seeds. Every window of WIDTH words holds WIDTH - k + 1 runs of k words; the leftmost of least hash is
the window's anchor (winnowing). Equal windows have equal anchors, so only documents that share an
anchor can share a window. Anchors are a seventh of the words.

Extension. The windows of one anchor follow each other; together they reach as far left and right of
the anchor as it is theirs. Anchors of equal hash meet, and those whose whole reach is equal are one
class: all but the first of a class are repeats over their whole reach. Between the firsts of
different classes of an anchor, reaches differ at an end, so their single windows are compared.
Runs of repeated windows joined together are the maximal repeats.

A window is a repeat if its words also start earlier: in a smaller doc_id, or earlier in the
document. Words that any repeated window covers are removed. Windows are judged on the input.

Defined results: a null or empty text has no words; a text of fewer than WIDTH words stays; a null
doc_id counts as the smallest; rows equal in doc_id and text are one document and get equal rows;
texts that share a doc_id are documents of their own, told apart by a 64-bit hash of the text, and
ordered by start, then by that hash; an empty table gives none; a text of any length is taken whole,
in one task; further columns are ignored.

Scale: anchors (40 bytes) are shuffled once by hash, whole texts once by doc_id and text hash (both
joins reuse that exchange), so that many rows without a doc_id are spread, each with its own places. Before a shuffle each batch keeps one occurrence of a class and knows the others to
be repeats, so a run that a third of the documents share meets with one row a batch, not a document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import (
    blocks,
    identified,
    map_batches,
    mixed,
    raw_texts,
    real_id,
    stage,
    table,
    window_hashes,
    word_hashes,
)

WIDTH = 20
#: Bits of a place that hold the number of windows; the width stays below it.
COUNT_BITS = 20
_COUNT = (1 << COUNT_BITS) - 1
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))


def anchor_size(width: int) -> int:
    return max(1, width * 2 // 5)


def marked(docs: DataFrame) -> DataFrame:
    """(doc_id, mark, text): doc_id and mark, a hash of the text, say which document it is."""
    mark = F.xxhash64(F.coalesce("text", F.lit(""))).alias("mark")
    return identified(docs).select("doc_id", mark, "text")


def places(start: np.ndarray, count: np.ndarray | int) -> np.ndarray:
    """Start and number of windows in one number that sorts by start."""
    return (start.astype(np.int64) << COUNT_BITS) | count


def run_sums(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums out of which the hash of any run of words follows, and the factors for that."""
    powers = np.concatenate(([np.uint64(1)], np.cumprod(np.full(len(words), _BASE, np.uint64))))
    back = np.concatenate(([np.uint64(1)], np.cumprod(np.full(len(words), _INVERSE, np.uint64))))
    sums = np.concatenate(([np.uint64(0)], np.cumsum(words * powers[:-1], dtype=np.uint64)))
    return sums, back


def anchors(words: np.ndarray, bounds: np.ndarray, width: int) -> tuple[np.ndarray, ...]:
    """Of several documents' words: hash, reach's hash, document, first window, windows of each
    anchor. bounds are the documents' first words and the end."""
    size = anchor_size(width)
    count = len(words) - width + 1
    none = np.zeros(0, np.int64)
    if count <= 0:
        return none.view(np.uint64), none.view(np.uint64), none, none, none
    document = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    inside = document[:count] == document[width - 1 :]
    starts = np.flatnonzero(inside)
    grams = window_hashes(words, size)
    span = np.lib.stride_tricks.sliding_window_view(grams, width - size + 1)
    at = starts + span[starts].argmin(axis=1)
    fresh = np.ones(len(starts), bool)
    fresh[1:] = (at[1:] != at[:-1]) | (starts[1:] != starts[:-1] + 1)
    first = np.flatnonzero(fresh)
    windows = np.diff(np.append(first, len(starts)))
    begin, anchor = starts[first], at[first]
    sums, back = run_sums(words)
    reach = (sums[begin + windows + width - 1] - sums[begin]) * back[begin]
    shape = places(anchor - begin, windows).astype(np.uint64)
    reach = mixed(reach + mixed(shape)) | np.uint64(1)
    return grams[anchor], reach, document[begin], begin - bounds[document[begin]], windows


def first_only(keys: list[np.ndarray], place: list[np.ndarray]) -> tuple[np.ndarray, ...]:
    """Among rows of equal keys: which is the first, and which are later ones (repeats)."""
    order = np.lexsort((*place[::-1], *keys))
    same = np.ones(len(order), bool)
    for key in keys:
        same[1:] &= key[order][1:] == key[order][:-1]
    if len(same):
        same[0] = False
    leader = order[np.maximum.accumulate(np.where(same, 0, np.arange(len(order))))]
    equal = np.logical_and.reduce([column[leader] == column[order] for column in place])
    first, later = np.zeros(len(order), bool), np.zeros(len(order), bool)
    first[order] = ~same
    later[order] = ~equal
    return first, later


def _stream(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    split = [text.split() for text in texts]
    bounds = np.concatenate(([0], np.cumsum([len(words) for words in split]))).astype(np.int64)
    return word_hashes([word for words in split for word in words]), bounds


def _occurrences(
    key: np.ndarray, sub: np.ndarray, doc: np.ndarray, at: np.ndarray, mark: np.ndarray
) -> pa.RecordBatch:
    """Rows for the shuffle: firsts of the batch by key; later ones, whose sub-key is 0, anywhere."""
    first, later = first_only([sub, key], [doc, at, mark])
    anywhere = mixed(doc.view(np.uint64) + at.view(np.uint64) + mark.view(np.uint64))
    key = np.where(later, anywhere, key)
    sub = np.where(later, np.uint64(0), sub)
    kept = first | later
    columns = (key.view(np.int64), sub.view(np.int64), doc, at, mark)
    return pa.RecordBatch.from_arrays(
        [pa.array(column[kept]) for column in columns], ["key", "sub", "doc_id", "at", "mark"]
    )


_OCCURRENCE = "key long, sub long, doc_id long, at long, mark long"


def seeds(rows: DataFrame, width: int) -> DataFrame:
    """Anchors of every text: key (anchor), sub (reach), doc_id, at, mark."""

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        ids, marks = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        texts = raw_texts(batch.column(2))
        parts = []
        for start, end in blocks(texts):
            words, bounds = _stream(texts[start:end])
            key, reach, doc, begin, windows = anchors(words, bounds, width)
            parts.append((key, reach, ids[start + doc], places(begin, windows), marks[start + doc]))
        if parts:
            yield _occurrences(*(np.concatenate(column) for column in zip(*parts, strict=True)))

    return map_batches(rows, work, _OCCURRENCE)


def border_windows(rows: DataFrame, width: int) -> DataFrame:
    """Single windows of the listed reaches (doc_id, mark, text, at ARRAY): key, sub are window, anchor."""
    size = anchor_size(width)

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        parts = []
        ids, marks = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        texts = raw_texts(batch.column(2))
        for doc_id, mark, text, listed in zip(ids, marks, texts, batch.column(3), strict=True):
            at = np.array(listed.as_py(), np.int64)
            words = word_hashes(text.split())
            windows = at & _COUNT
            begins = np.repeat(at >> COUNT_BITS, windows)
            begins += np.arange(len(begins)) - np.repeat(np.cumsum(windows) - windows, windows)
            begins = np.unique(begins)
            grams = window_hashes(words, size)
            span = np.lib.stride_tricks.sliding_window_view(grams, width - size + 1)
            parts.append(
                (
                    window_hashes(words, width)[begins],
                    span[begins].min(axis=1) | np.uint64(1),
                    np.full(len(begins), doc_id),
                    places(begins, 1),
                    np.full(len(begins), mark),
                )
            )
        if parts:
            yield _occurrences(*(np.concatenate(column) for column in zip(*parts, strict=True)))

    return map_batches(rows, work, _OCCURRENCE)


def judged(occurrences: DataFrame) -> DataFrame:
    """doc_id, mark, at, repeat: whether an equal occurrence comes earlier; and split: whether the key
    has several sub-keys. Rows that are neither are left out."""
    place = F.struct("doc_id", "at", "mark")
    klass = Window.partitionBy("key", "sub").orderBy("doc_id", "at", "mark")
    key = Window.partitionBy("key")
    found = occurrences.select(
        "doc_id",
        "mark",
        "at",
        ((F.col("sub") == 0) | (F.first(place).over(klass) != place)).alias("repeat"),
        (F.min("sub").over(key) != F.max("sub").over(key)).alias("split"),
    )
    return found.where(F.col("repeat") | F.col("split"))


def _listed(found: DataFrame) -> DataFrame:
    """doc_id and mark with the places of that document: never more than its words."""
    return found.groupBy("doc_id", "mark").agg(F.collect_set("at").alias("at")).hint("shuffle_hash")


def remove_repeats(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """(doc_id, n_words, n_removed, kept, starts, ends): the kept words joined by one space, and the
    maximal repeats as runs of words (first, after the last)."""
    if not 2 <= width <= _COUNT:
        raise ValueError(f"width must be from 2 to {_COUNT} words")
    rows = marked(docs)
    seeded = stage(judged(seeds(rows, width)), "repeats")
    same = ["doc_id", "mark"]
    borders = _listed(seeded.where(~F.col("repeat")))
    windows = judged(border_windows(rows.join(borders, same), width))
    repeats = (
        seeded.where("repeat")
        .select(*same, "at")
        .unionAll(windows.where("repeat").select(*same, "at"))
    )

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        texts = raw_texts(batch.column(1))
        for start, end in blocks(texts):
            out = []
            for text, listed in zip(
                texts[start:end], batch.column(2).slice(start, end - start), strict=True
            ):
                words = text.split()
                covered = np.zeros(len(words) + 1, np.int32)
                if listed.is_valid:
                    at = np.array(listed.as_py(), np.int64)
                    np.add.at(covered, at >> COUNT_BITS, 1)
                    np.add.at(covered, (at >> COUNT_BITS) + (at & _COUNT) + width - 1, -1)
                gone = np.cumsum(covered)[:-1] > 0
                if gone.any():
                    kept = b" ".join([w for w, g in zip(words, gone.tolist(), strict=True) if not g])
                    edges = np.flatnonzero(np.diff(np.concatenate(([0], gone.view(np.int8), [0]))))
                else:
                    kept, edges = b" ".join(words), np.zeros(0, np.int64)
                out.append(
                    (len(words), int(gone.sum()), kept, edges[::2].tolist(), edges[1::2].tolist())
                )
            columns = list(zip(*out, strict=True))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).slice(start, end - start),
                    pa.array(columns[0], pa.int64()),
                    pa.array(columns[1], pa.int64()),
                    pa.array(columns[2], pa.binary()).cast(pa.string()),
                    pa.array(columns[3], pa.list_(pa.int32())),
                    pa.array(columns[4], pa.list_(pa.int32())),
                ],
                ["doc_id", "n_words", "n_removed", "kept", "starts", "ends"],
            )

    done = map_batches(
        rows.join(_listed(repeats), same, "left").select("doc_id", "text", "at"),
        work,
        "doc_id long, n_words long, n_removed long, kept string, starts array<int>, ends array<int>",
    )
    return done.select(real_id(), "n_words", "n_removed", "kept", "starts", "ends")


def query(spark: SparkSession, folder: str) -> DataFrame:
    """op5: every document less its repeated runs of 20 words and more."""
    done = remove_repeats(table(spark, folder, "documents"))
    return done.select(
        "doc_id", "n_words", "n_removed", F.sha2(F.col("kept"), 256).alias("kept_sha256")
    )


ORACLE = r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
windows AS (
  SELECT doc_id, i, array_to_string(w[i : i + 19], ' ') AS key
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM words WHERE len(w) >= 20)),
repeats AS (
  SELECT doc_id, i FROM windows
  QUALIFY row_number() OVER (PARTITION BY key ORDER BY doc_id, i) > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS place FROM repeats),
removed AS (SELECT doc_id, count(*) AS n, list(place) AS places FROM gone GROUP BY doc_id)
SELECT w.doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_removed,
  sha256(CASE WHEN n IS NULL THEN array_to_string(w, ' ') ELSE array_to_string(
    list_filter(w, lambda x, i: NOT list_contains(places, i)), ' ') END) AS kept_sha256
FROM words w LEFT JOIN removed r USING (doc_id)
"""
