"""Benchmark decontamination with a generalised suffix automaton of the test items.

The items' words (A-Z lower-cased, runs of letters, digits and non-ASCII characters) go into one
automaton. A document's words are streamed through it: after each word the automaton knows the
longest item substring that ends there. Wherever that length reaches the window (10 words, or the
whole of a shorter item) the words of the window are hit. Runs of hit words are spans; spans of
`max_length` words or fewer stay unless they hold a whole item, all others are cut out of the text,
and a document of which more than `max_coverage` is hit goes.

Streaming starts at the root wherever two neighbouring words never follow each other in an item,
so most text is passed over by one vectorised look-up of word pairs.

Defined results: a null or empty text has no words and no hits; a null item text is no item; an
item with a null id hits but is not listed; repeated items count once; documents that repeat are
judged alike; an empty benchmark hits nothing. Columns besides those named are ignored.

Scale: no shuffle. The benchmark is cut into automata of at most AUTOMATON_WORDS words, which
bounds what is broadcast and built; documents are scanned once for all of them.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import DOCUMENT_SCHEMA, PLAIN, blocks, document_columns, map_batches, raw_texts, table

WINDOW = 10
#: Bounds one automaton: words of items (it has at most twice as many states).
AUTOMATON_WORDS = 100_000
#: Longer items are cut into pieces that overlap by WINDOW - 1 words.
PIECE_WORDS = 20_000
#: Flags of a document's word: it is hit; a whole item ends with it.
HIT, END = np.uint8(1), np.uint8(2)


def words_of(text: bytes) -> list[bytes]:
    return text.translate(PLAIN).split()


@dataclass
class Automaton:
    """Generalised suffix automaton over word numbers, with the items' windows."""

    window: int = WINDOW
    ids: dict[bytes, int] = field(default_factory=dict)
    step: list[dict[int, int]] = field(default_factory=lambda: [{}])
    link: list[int] = field(default_factory=lambda: [-1])
    length: list[int] = field(default_factory=lambda: [0])
    items: dict[tuple[int, ...], set[str]] = field(default_factory=dict)
    pairs: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    shorter: list[int] = field(default_factory=list)
    whole: set[int] = field(default_factory=set)
    above: set[int] = field(default_factory=set)

    def _extend(self, last: int, word: int) -> int:
        if word in self.step[last]:
            known = self.step[last][word]
            if self.length[known] == self.length[last] + 1:
                return known
            return self._clone(last, known, word)
        new = len(self.step)
        self.step.append({})
        self.link.append(0)
        self.length.append(self.length[last] + 1)
        at = last
        while at >= 0 and word not in self.step[at]:
            self.step[at][word] = new
            at = self.link[at]
        if at >= 0:
            known = self.step[at][word]
            if self.length[known] == self.length[at] + 1:
                self.link[new] = known
            else:
                self.link[new] = self._clone(at, known, word)
        return new

    def _clone(self, at: int, known: int, word: int) -> int:
        clone = len(self.step)
        self.step.append(dict(self.step[known]))
        self.link.append(self.link[known])
        self.length.append(self.length[at] + 1)
        self.link[known] = clone
        while at >= 0 and self.step[at].get(word) == known:
            self.step[at][word] = clone
            at = self.link[at]
        return clone

    def add(self, item: str | None, words: list[bytes], whole: bool = True) -> None:
        if not words:
            return
        numbers = [self.ids.setdefault(word, len(self.ids)) for word in words]
        last = 0
        for number in numbers:
            last = self._extend(last, number)
        if whole:
            self.whole.add(last)
        width = min(self.window, len(numbers))
        for i in range(len(numbers) - width + 1):
            self.items.setdefault(tuple(numbers[i : i + width]), set()).add(item)

    def close(self) -> Automaton:
        """Set up the look-ups that need all items."""
        size = len(self.ids) + 1
        found = {a * size + b for a, step in enumerate(self._firsts()) for b in step}
        self.pairs = np.array(sorted(found), np.int64)
        # States with a whole item among their shorter suffixes; links lead to lesser lengths.
        for state in sorted(range(1, len(self.link)), key=self.length.__getitem__):
            if self.link[state] in self.whole or self.link[state] in self.above:
                self.above.add(state)
        self.shorter = sorted({len(key) for key in self.items if len(key) < self.window})
        return self

    def _firsts(self) -> list[Iterable[int]]:
        """For each word, the words that follow it in an item."""
        return [self.step[self.step[0][word]] for word in range(len(self.ids))]

    def least(self) -> int:
        return self.shorter[0] if self.shorter else self.window

    def stream(self, numbers: list[int]) -> tuple[np.ndarray, set[str], int]:
        """Flags, items and longest match of words among which all neighbours are known."""
        hit = np.zeros(len(numbers), np.uint8)
        items: set[str] = set()
        state = length = longest = 0
        for i, number in enumerate(numbers):
            while state and number not in self.step[state]:
                state = self.link[state]
                length = self.length[state]
            if number in self.step[state]:
                state = self.step[state][number]
                length += 1
            longest = max(longest, length)
            for width in (*self.shorter, self.window):
                if length < width:
                    break
                key = tuple(numbers[i - width + 1 : i + 1])
                if key in self.items:
                    hit[i - width + 1 : i + 1] |= HIT
                    items |= self.items[key]
            if state in self.above or (state in self.whole and length == self.length[state]):
                hit[i] |= END
        return hit, items, longest

    def scan(self, documents: list[list[bytes]]) -> dict[int, tuple[np.ndarray, set[str], int]]:
        """Documents with hits: flags of their words, items, longest match."""
        least, size = self.least(), len(self.ids) + 1
        found: dict[int, tuple[np.ndarray, set[str], int]] = {}
        if not self.ids:
            return found
        bounds = np.zeros(len(documents) + 1, np.int64)
        np.cumsum([len(words) + 1 for words in documents], out=bounds[1:])
        get, numbers = self.ids.get, np.full(bounds[-1], -1, np.int64)
        for words, start in zip(documents, bounds[:-1], strict=True):
            numbers[start : start + len(words)] = np.fromiter(
                (get(word, -1) for word in words), np.int64, len(words)
            )
        known = numbers >= 0
        follows = known[:-1] & known[1:]
        where = np.flatnonzero(follows)
        codes = numbers[where] * size + numbers[where + 1]
        at = np.minimum(np.searchsorted(self.pairs, codes), max(len(self.pairs) - 1, 0))
        follows[where] = self.pairs[at] == codes if len(self.pairs) else False
        starts = np.flatnonzero(known & ~np.concatenate(([False], follows)))
        ends = np.flatnonzero(known & ~np.concatenate((follows, [False]))) + 1
        long = ends - starts >= least
        for start, end in zip(starts[long].tolist(), ends[long].tolist(), strict=True):
            hit, items, longest = self.stream(numbers[start:end].tolist())
            if not hit.any():
                continue
            d = int(np.searchsorted(bounds, start, "right")) - 1
            flags, known_items, most = found.get(d) or (
                np.zeros(len(documents[d]), np.uint8),
                set(),
                0,
            )
            flags[start - bounds[d] : end - bounds[d]] |= hit
            found[d] = flags, known_items | items, max(most, longest)
        return found


def pieces(benchmark: DataFrame, size: int = PIECE_WORDS) -> DataFrame:
    """(item, words, n_words, whole): the items' normalised words, long items in overlapping pieces."""

    def work(batch: pa.RecordBatch):
        out: list[tuple[str | None, str, int, bool]] = []
        items = batch.column(0).to_pylist()
        for item, text in zip(items, raw_texts(batch.column(1)), strict=True):
            words = words_of(text)
            for i in range(0, max(len(words) - WINDOW + 1, 1 if words else 0), size):
                part = words[i : i + size + WINDOW - 1]
                out.append((item, b" ".join(part).decode(), len(part), len(part) == len(words)))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([o[0] for o in out], pa.string()),
                pa.array([o[1] for o in out], pa.string()),
                pa.array([o[2] for o in out], pa.int64()),
                pa.array([o[3] for o in out], pa.bool_()),
            ],
            ["item", "words", "n_words", "whole"],
        )

    source = benchmark.select(F.col("item_id").cast("string"), F.col("text").cast("string"))
    return map_batches(source, work, "item string, words string, n_words long, whole boolean").distinct()


def automata(benchmark: DataFrame, limit: int = AUTOMATON_WORDS) -> list:
    """One broadcast automaton for every `limit` words of items (one for an ordinary benchmark)."""
    spark = benchmark.sparkSession
    parts = pieces(benchmark, min(PIECE_WORDS, limit))
    total = parts.agg(F.sum("n_words")).first()[0] or 0
    count = max(1, -(-total // limit))
    part = F.pmod(F.xxhash64("item", "words"), F.lit(count))
    built = []
    for k in range(count):
        automaton = Automaton()
        rows = parts.where(part == k).select("item", "words", "whole").collect()
        for row in sorted(rows, key=lambda r: (r["item"] or "", r["words"])):
            automaton.add(row["item"], row["words"].encode().split(), row["whole"])
        built.append(spark.sparkContext.broadcast(automaton.close()))
    return built


def _judged(texts: list[bytes], built: list):
    """For each text: its words' number, flags (None without hits), items, longest match."""
    for start, end in blocks(texts):
        documents = [words_of(text) for text in texts[start:end]]
        found: dict[int, tuple[np.ndarray, set[str], int]] = {}
        for automaton in built:
            for d, (flags, items, longest) in automaton.value.scan(documents).items():
                old = found.get(d)
                found[d] = (
                    (flags, items, longest)
                    if old is None
                    else (flags | old[0], items | old[1], max(longest, old[2]))
                )
        for d, words in enumerate(documents):
            yield len(words), *found.get(d, (None, set(), 0))


def spans_of(flags: np.ndarray | None) -> list[tuple[int, int]]:
    """Runs of hit words, as (first word, word after the last)."""
    if flags is None:
        return []
    edges = np.flatnonzero(np.diff(np.concatenate(([0], (flags & HIT).view(np.int8), [0]))))
    return list(zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True))


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, n_words, longest, starts, ends, items): what each document shares with the items.

    starts and ends bound the runs of hit words; items are their ids, sorted as strings; longest is
    the longest match in words among the runs that were hit.
    """
    built = automata(benchmark)
    fields = (
        ("n_words", pa.int64()),
        ("longest", pa.int64()),
        ("starts", pa.list_(pa.int32())),
        ("ends", pa.list_(pa.int32())),
        ("items", pa.list_(pa.string())),
    )

    def work(batch: pa.RecordBatch):
        rows = []
        for n_words, flags, items, longest in _judged(raw_texts(batch.column(1)), built):
            spans = spans_of(flags)
            listed = sorted(item for item in items if item is not None)
            rows.append((n_words, longest, [a for a, _ in spans], [b for _, b in spans], listed))
        columns = list(zip(*rows, strict=True))
        arrays = [pa.array(c, kind) for c, (_, kind) in zip(columns, fields, strict=True)]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *arrays], ["doc_id", *(name for name, _ in fields)]
        )

    return map_batches(
        docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")),
        work,
        "doc_id long, n_words long, longest long, starts array<int>, ends array<int>,"
        " items array<string>",
    )


_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_LOWER = {c: c + 32 for c in range(0x41, 0x5B)}


def without_spans(text: str, spans: list[tuple[int, int]]) -> str:
    """The text less everything from each span's first word to its last."""
    places = [m.span() for m in _WORD.finditer(text.translate(_LOWER))]
    kept, at = [], 0
    for first, after in spans:
        kept.append(text[at : places[first][0]])
        at = places[after - 1][1]
    return "".join([*kept, text[at:]])


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, max_length: int = WINDOW - 1, max_coverage: float = 0.8
) -> DataFrame:
    """documents less the spans of over `max_length` hit words or with a whole item in them (of up to
    PIECE_WORDS words), and less documents of which over `max_coverage` of the words are hit.
    Untouched documents stay as they are; n_chars follows."""
    built = automata(benchmark)

    def work(batch: pa.RecordBatch):
        texts = batch.column(1).to_pylist()
        keep = np.ones(batch.num_rows, bool)
        sizes = batch.column(4).to_pylist()
        judged = _judged(raw_texts(batch.column(1)), built)
        for i, (n_words, flags, _, _) in enumerate(judged):
            if flags is None:
                continue
            keep[i] = np.count_nonzero(flags & HIT) <= max_coverage * n_words
            spans = [
                (a, b) for a, b in spans_of(flags) if b - a > max_length or (flags[a:b] & END).any()
            ]
            if spans and keep[i]:
                texts[i] = without_spans(texts[i], spans)
                sizes[i] = len(texts[i])
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pa.array(texts, pa.string()),
                batch.column(2),
                batch.column(3),
                pa.array(sizes, pa.int64()),
            ],
            ["doc_id", "text", "lang", "source", "n_chars"],
        ).filter(pa.array(keep))

    return map_batches(document_columns(docs), work, DOCUMENT_SCHEMA)


def query(spark: SparkSession, folder: str) -> DataFrame:
    """op6: every document against the whole benchmark."""
    found = contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    hit = F.aggregate(
        F.zip_with("starts", "ends", lambda a, b: (b - a).cast("long")),
        F.lit(0).cast("long"),
        lambda total, size: total + size,
    )
    return found.select(
        "doc_id",
        "n_words",
        hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("starts") > 0).alias("contaminated"),
    )


ORACLE = r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
items AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS width,
    array_to_string(w[i : i + least(10, len(w)) - 1], ' ') AS key
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i
        FROM items WHERE len(w) > 0)),
widths AS (SELECT DISTINCT width FROM windows),
places AS (
  SELECT doc_id, width, i, array_to_string(w[i : i + width - 1], ' ') AS key
  FROM (SELECT doc_id, w, width, unnest(range(1, len(w) - width + 2)) AS i
        FROM words, widths WHERE len(w) >= width)),
found AS (
  SELECT p.doc_id, p.i, p.width, v.item_id
  FROM places p JOIN windows v ON p.key = v.key AND p.width = v.width),
hits AS (
  SELECT doc_id, count(DISTINCT place) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + width)) AS place FROM found) GROUP BY doc_id),
listed AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM found) GROUP BY doc_id)
SELECT w.doc_id, len(w.w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
  coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(names, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM words w LEFT JOIN hits USING (doc_id) LEFT JOIN listed USING (doc_id)
"""
