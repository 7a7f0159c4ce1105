"""Fill-in-middle transformation by displacement scatter.

Each text is cut into prefix, middle and suffix at two of its code points and written in another
order with a sentinel before each part. The texts of a block stand behind each other in one byte
array. The block's cuts are scanned out of it (code points are counted at their first bytes), and a
difference array holds, at the first byte of every part, by how much the shift from input to output
changes there. Its cumulative sum is every byte's shift: one numpy scatter builds all outputs of the
block. `restore` finds the sentinels in the outputs and gathers the bytes back the same way. Both go
through a block in pieces of PIECE bytes, so that a very long text needs little more than itself.

Cuts, form and order come from a digest of the doc_id (`cut_numbers`), so a rerun gives the same.

Defined results: a null or empty text stays plain and empty; a text that holds a sentinel stays plain,
so an output has each sentinel once and can be undone; a null doc_id is digested as no digits; rows
equal in doc_id and text get equal rows; texts of any length; further columns are ignored; an empty
table gives an empty one. `restore` raises an error on outputs whose sentinels do not fit their form.
No shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import BLOCK_BYTES, map_batches, table

#: Bytes moved at once; bounds the index arrays.
PIECE = 1 << 18
#: Bytes between known counts of code points.
STEP = 1 << 12
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
#: Of a hundred documents: those that stay plain, and of the others those with the suffix first.
PLAIN_SHARE, SUFFIX_FIRST_SHARE = 10, 20
FORMS = ("plain", "psm", "spm")


def cut_numbers(docs: DataFrame) -> DataFrame:
    """(doc_id, text, h1, h2, h3, h4): the numbers that decide a document's cuts and form."""
    digest = F.sha2(F.concat(F.lit("1:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
        digest.alias("digest"),
    )
    numbers = [
        F.conv(F.substring("digest", 8 * i + 1, 8), 16, 10).cast("long").alias(f"h{i + 1}")
        for i in range(4)
    ]
    return rows.select("doc_id", "text", *numbers)


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and bounds of a string column; null is empty."""
    column = column.cast(pa.large_string()).fill_null("")
    _, bounds, data = column.buffers()
    size = len(column)
    bounds = np.frombuffer(bounds, np.int64)[column.offset : column.offset + size + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[bounds[0] : bounds[-1]], bounds - bounds[0]


def text_array(data: np.ndarray, bounds: np.ndarray) -> pa.Array:
    buffers = [None, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(data)]
    return pa.Array.from_buffers(pa.large_string(), len(bounds) - 1, buffers).cast(pa.string())


def row_blocks(bounds: np.ndarray, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about `limit` bytes; a longer text is a range of its own."""
    start, rows = 0, len(bounds) - 1
    while start < rows:
        end = int(np.searchsorted(bounds, bounds[start] + limit, "right")) - 1
        end = min(max(end, start + 1), rows)
        yield start, end
        start = end


class Characters:
    """Code points of a byte array, counted at their first bytes."""

    def __init__(self, data: np.ndarray) -> None:
        self.first = (data & 0xC0) != 0x80
        steps = np.arange(0, len(data), STEP)
        sums = np.add.reduceat(self.first, steps, dtype=np.int64) if len(steps) else steps
        self.before = np.concatenate((np.zeros(1, np.int64), np.cumsum(sums)))

    def count(self, at: int) -> int:
        """Code points that begin before a byte."""
        step = at // STEP
        return int(self.before[step]) + int(np.count_nonzero(self.first[step * STEP : at]))

    def place(self, number: int) -> int:
        """The first byte of a code point; the end of the array for the one after the last."""
        if number == self.before[-1]:
            return len(self.first)
        step = int(np.searchsorted(self.before, number, "right")) - 1
        inside = np.flatnonzero(self.first[step * STEP : (step + 1) * STEP])
        return step * STEP + int(inside[number - self.before[step]])


def sentinels(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where sentinels begin, and their letters."""
    at = np.flatnonzero(data[:-2] == PREFIX[0]) if len(data) > 2 else np.zeros(0, np.int64)
    letter = data[at + 1]
    named = (letter == PREFIX[1]) | (letter == SUFFIX[1]) | (letter == MIDDLE[1])
    at = at[named & (data[at + 2] == PREFIX[2])]
    return at, data[at + 1]


def inside_of(at: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The row of each sentinel, without those that reach over a row's end."""
    row = np.searchsorted(bounds, at, "right") - 1
    whole = at + 3 <= bounds[row + 1]
    return row, whole


def shifts(starts: np.ndarray, shift: np.ndarray, size: int) -> Iterator[tuple[int, int, np.ndarray]]:
    """Pieces (first, after the last, shift of each byte) of parts that begin at ascending places."""
    change = np.diff(shift, prepend=0)
    reached = 0
    for low in range(0, size, PIECE):
        high = min(low + PIECE, size)
        a, b = np.searchsorted(starts, (low, high))
        difference = np.zeros(high - low, np.int64)
        np.add.at(difference, starts[a:b] - low, change[a:b])
        difference[0] += reached
        piece = np.cumsum(difference)
        reached = int(piece[-1])
        yield low, high, piece


def scatter(data: np.ndarray, starts: np.ndarray, shift: np.ndarray, out: np.ndarray) -> None:
    for low, high, piece in shifts(starts, shift, len(data)):
        out[np.arange(low, high) + piece] = data[low:high]


def gather(data: np.ndarray, starts: np.ndarray, shift: np.ndarray, out: np.ndarray) -> None:
    for low, high, piece in shifts(starts, shift, len(out)):
        out[low:high] = data[np.arange(low, high) + piece]


def rearranged(
    data: np.ndarray, bounds: np.ndarray, numbers: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Output bytes and bounds, code points, form (index into FORMS), prefix and middle lengths."""
    rows = len(bounds) - 1
    chars = Characters(data)
    before = [chars.count(int(at)) for at in bounds]
    count = np.diff(np.array(before, np.int64))
    at, _ = sentinels(data)
    row, whole = inside_of(at, bounds)
    plain = (count == 0) | (numbers[:, 2] % 100 >= 100 - PLAIN_SHARE)
    plain[row[whole]] = True
    form = np.where(plain, 0, np.where(numbers[:, 3] % 100 < SUFFIX_FIRST_SHARE, 2, 1))
    cuts = np.sort(numbers[:, :2] % (count + 1)[:, None], axis=1)
    first, second = bounds[:-1].copy(), bounds[:-1].copy()
    for i in np.flatnonzero(~plain).tolist():
        first[i] = chars.place(before[i] + int(cuts[i, 0]))
        second[i] = chars.place(before[i] + int(cuts[i, 1]))
    size = np.diff(bounds)
    ends = np.concatenate((np.zeros(1, np.int64), np.cumsum(size + np.where(plain, 0, 9))))
    begin = ends[:-1]
    prefix, middle, suffix = first - bounds[:-1], second - first, bounds[1:] - second
    # Where the parts go, in the order psm and spm; plain texts have all in their suffix.
    to_prefix = np.where(form == 2, begin + 6 + suffix, begin + 3)
    to_suffix = np.where(form == 2, begin + 3, begin + 6 + prefix)
    to_middle = begin + 9 + prefix + suffix
    to_suffix = np.where(plain, begin, to_suffix)
    starts = np.stack((bounds[:-1], first, second), axis=1).ravel()
    target = np.stack((to_prefix, to_middle, to_suffix), axis=1).ravel()
    out = np.zeros(int(ends[-1]), np.uint8)
    scatter(data, starts, target - starts, out)
    for mark, place in ((PREFIX, to_prefix), (MIDDLE, to_middle), (SUFFIX, to_suffix)):
        for i, byte in enumerate(mark):
            out[place[~plain] - 3 + i] = byte
    return out, ends, count, form, cuts[:, 0], cuts[:, 1] - cuts[:, 0]


def put_back(data: np.ndarray, bounds: np.ndarray, form: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Text bytes and bounds of outputs and their forms."""
    rows = np.flatnonzero(form > 0)
    at, letter = sentinels(data)
    row, whole = inside_of(at, bounds)
    own = whole & (form[row] > 0)
    at, letter, row = at[own], letter[own], row[own]
    places = {}
    for mark in (PREFIX, SUFFIX, MIDDLE):
        here = letter == mark[1]
        if not np.array_equal(row[here], rows):
            raise ValueError("outputs must have each sentinel once")
        places[mark] = np.zeros(len(form), np.int64)
        places[mark][rows] = at[here]
    p, s, m = places[PREFIX], places[SUFFIX], places[MIDDLE]
    ordered = np.where(form == 2, (s == bounds[:-1]) & (s < p) & (p < m), (p == bounds[:-1]) & (p < s) & (s < m))
    if not ordered[rows].all():
        raise ValueError("the sentinels' order does not fit the form")
    moved, end = form > 0, bounds[1:]
    prefix = np.where(moved, np.where(form == 2, m, s) - p - 3, 0)
    middle = np.where(moved, end - m - 3, 0)
    suffix = np.where(moved, np.where(form == 2, p, m) - s - 3, np.diff(bounds))
    ends = np.concatenate((np.zeros(1, np.int64), np.cumsum(prefix + middle + suffix)))
    begin = ends[:-1]
    starts = np.stack((begin, begin + prefix, begin + prefix + middle), axis=1).ravel()
    source = np.stack((p + 3, m + 3, np.where(moved, s + 3, bounds[:-1])), axis=1).ravel()
    out = np.zeros(int(ends[-1]), np.uint8)
    gather(data, starts, source - starts, out)
    return out, ends


_SCHEMA = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"


def fill_in_middle(docs: DataFrame) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output) of every whole text."""

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        data, bounds = text_buffer(batch.column(1))
        numbers = np.stack([batch.column(i).to_numpy() for i in range(2, 6)], axis=1)
        for start, end in row_blocks(bounds):
            low, high = int(bounds[start]), int(bounds[end])
            out, ends, count, form, prefix, middle = rearranged(
                data[low:high], bounds[start : end + 1] - low, numbers[start:end]
            )
            plain = form == 0
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).slice(start, end - start),
                    pa.array(count),
                    pa.array(np.array(FORMS, object)[form], pa.string()),
                    pa.array(prefix, mask=plain),
                    pa.array(middle, mask=plain),
                    text_array(out, ends),
                ],
                ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"],
            )

    return map_batches(cut_numbers(docs), work, _SCHEMA)


def restore(formatted: DataFrame) -> DataFrame:
    """The rows of fill_in_middle with the text that their output and form stand for."""

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        data, bounds = text_buffer(batch.column("output"))
        names = batch.column("form").to_pylist()
        form = np.array([FORMS.index(name) for name in names], np.int64)
        for start, end in row_blocks(bounds):
            low, high = int(bounds[start]), int(bounds[end])
            out, ends = put_back(
                data[low:high], bounds[start : end + 1] - low, form[start:end]
            )
            part = batch.slice(start, end - start)
            yield pa.RecordBatch.from_arrays(
                [*part.columns, text_array(out, ends)], [*part.schema.names, "text"]
            )

    columns = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]
    return map_batches(formatted.select(*columns), work, f"{_SCHEMA}, text string")


def query(spark: SparkSession, folder: str) -> DataFrame:
    """op12: every document's cuts, the digest of its output and of the text rebuilt from that."""
    done = restore(fill_in_middle(table(spark, folder, "documents")))
    return done.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2(F.col("output"), 256).alias("output_sha256"),
        F.sha2(F.col("text"), 256).alias("restored_sha256"),
    )


ORACLE = f"""
WITH digests AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS d
  FROM documents),
numbers AS (
  SELECT doc_id, t, length(t) AS n, ('0x' || d[1:8])::BIGINT AS h1, ('0x' || d[9:16])::BIGINT AS h2,
    ('0x' || d[17:24])::BIGINT AS h3, ('0x' || d[25:32])::BIGINT AS h4 FROM digests),
cuts AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
    CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>')
        OR h3 % 100 >= {100 - PLAIN_SHARE} THEN 'plain'
      WHEN h4 % 100 < {SUFFIX_FIRST_SHARE} THEN 'spm' ELSE 'psm' END AS form
  FROM numbers)
SELECT doc_id, n::BIGINT AS n, form,
  CASE WHEN form <> 'plain' THEN a::BIGINT END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN (b - a)::BIGINT END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t
    WHEN 'psm' THEN '<P>' || substr(t, 1, a) || '<S>' || substr(t, b + 1) || '<M>' || substr(t, a + 1, b - a)
    ELSE '<S>' || substr(t, b + 1) || '<P>' || substr(t, 1, a) || '<M>' || substr(t, a + 1, b - a) END
  ) AS output_sha256,
  sha256(t) AS restored_sha256
FROM cuts
"""
