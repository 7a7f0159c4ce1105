"""Helpers the operators share: Arrow text blocks, word hashing, staged tables, row identity."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from gleaner.workspace import stage

__all__ = ["BLOCK_BYTES", "NO_ID", "document_columns", "identified", "stage", "table"]

#: Text handled at once inside a task; bounds numpy temporaries whatever the batch size.
BLOCK_BYTES = 1 << 19
#: Documents in an Arrow batch: a tenth of Spark's default, as texts are long.
BATCH_ROWS = 1000
#: Stands for a null doc_id inside an operator, so that joins and orders have a plain key.
NO_ID = -(2**63)

DOCUMENT_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def document_columns(docs: DataFrame) -> DataFrame:
    """The columns of documents, by name and type; further columns are left out."""
    return docs.select(
        F.col("doc_id").cast("long"),
        F.col("text").cast("string"),
        F.col("lang").cast("string"),
        F.col("source").cast("string"),
        F.col("n_chars").cast("long"),
    )


def identified(docs: DataFrame) -> DataFrame:
    """(doc_id, text) with a null doc_id as NO_ID; a null text stays null."""
    return docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc_id"),
        F.col("text").cast("string").alias("text"),
    )


def real_id(column: str = "doc_id") -> Column:
    """Undo `identified`."""
    return F.nullif(F.col(column), F.lit(NO_ID)).alias(column)


# ASCII letters and digits, lower-cased, and non-ASCII bytes are parts of words; all else parts them.
PLAIN = bytes(
    b + 32
    if 0x41 <= b <= 0x5A
    else b
    if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80
    else 0x20
    for b in range(256)
)


def raw_texts(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return [value or b"" for value in column.cast(kind).to_pylist()]


def blocks(texts: list[bytes], limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive texts of about `limit` bytes; a longer text is a range of its own."""
    start, held = 0, 0
    for i, text in enumerate(texts):
        if held and held + len(text) > limit:
            yield start, i
            start, held = i, 0
        held += len(text) + 64
    if start < len(texts):
        yield start, len(texts)


def small_batches(df: DataFrame) -> DataFrame:
    """The frame, with its session's Arrow batches held to BATCH_ROWS rows."""
    conf, key = df.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(conf.get(key)) <= BATCH_ROWS:
        conf.set(key, BATCH_ROWS)
    return df


def map_batches(
    df: DataFrame, work: Callable[[pa.RecordBatch], Iterable[pa.RecordBatch]], schema: str
) -> DataFrame:
    """mapInArrow with a function of one batch; empty batches are passed over."""

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                yield from work(batch)

    return small_batches(df).mapInArrow(run, schema)


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxh3_64_intdigest, words), np.uint64, len(words))


def mixed(values: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    values = values ^ (values >> np.uint64(33))
    values = values * np.uint64(0xFF51AFD7ED558CCD)
    values ^= values >> np.uint64(33)
    values *= np.uint64(0xC4CEB9FE1A85EC53)
    return values ^ (values >> np.uint64(33))


def multipliers(width: int) -> np.ndarray:
    """Odd 64-bit multipliers, one for each place of a window."""
    places = np.arange(1, width + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return mixed(places) | np.uint64(1)


def window_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """Hash of each run of `width` consecutive words (multilinear, then mixed)."""
    count = len(words) - width + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(count, np.uint64)
    for place, factor in enumerate(multipliers(width)):
        total += words[place : place + count] * factor
    return mixed(total)
