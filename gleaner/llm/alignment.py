"""Cross-tokenizer alignment with external counting of token pairs.

A text with one space in front is encoded by a byte-level merge model (A), and the text itself by a
piece model (B), which adds that space. Places where tokens of both end cut them into groups, and
all A-B occurrences of a group are linked. For each id pair the corpus is counted: how many
documents hold it linked. Each document then gets the sums of its links' counts, and how many of its
links are the best of their A id.

Records and runs. Documents are taken in blocks of BLOCK bytes. A block's records (A id, B id,
document, links) are sorted by pair, A first, dealt into RADICES parts by a mix of the A id, and each
part is written as a run: its arrays, byte plane by byte plane, under zstd. A run already holds one
entry a pair with the number of the block's documents, so a pair that is everywhere costs one entry
a block. Runs are rows of a staged table; Spark shuffles them by (part, slice of blocks).

Merge. A task takes the runs of a part and slice as they stream in, MERGED at a time, and merges
them through a heap of their pieces' last pairs with what it has: one sorted run of pairs and counts.
A second shuffle brings the slices of a part together, merged likewise; as the order is by A id and
an A id is in one part, the greatest count of each A id falls out of it. What a task holds is bounded
by the pairs of a part of the vocabularies, not by the corpus.

Contributions. The counted pairs of a part go out again, once for each slice, ahead of the slice's
runs; every run is looked up in them and its documents' sums leave as one row a run. A last shuffle
by block adds these up beside the documents' own figures.

Defined results: texts that are null, empty, or whose tokens' bytes are not the space and the text
have no tokens, and zeros (the digest column is empty); a row is a document, also if rows repeat or
share a doc_id; a null doc_id stays null; texts of any length are encoded whole, and their links are
made in parts of LINKS; further columns are ignored; an empty table gives an empty one.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import map_batches, raw_texts, small_batches, stage, table
from .pieces import MODEL, MODEL_BYTES, Spelling, decode_table, model_path, read_pieces

#: Text of a block; its documents are at most those of an Arrow batch.
BLOCK = 1 << 21
#: Parts of the A ids.
RADICES = 64
#: Entries of a piece of a run.
PIECE = 1 << 16
#: Runs merged at once.
MERGED = 32
#: Links made at once.
LINKS = 1 << 21

# The byte-level model's word pattern, and the white space it knows.
PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)
SPACES = "".join(
    map(chr, (*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000))
)
#: The encoder's pattern overflows on longer runs of white space; they are one word each anyhow.
LONG_SPACE = re.compile(f"[{SPACES}]{{4000,}}")


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary, as letter -> byte."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [byte for byte in range(256) if byte not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


def read_byte_level(data: bytes) -> dict[bytes, int]:
    """Ids by bytes of a byte-level merge model whose ids rise with the rank of their merges."""
    model = json.loads(data)
    kind, words = model["model"], model.get("pre_tokenizer") or {}
    if kind.get("type") != "BPE" or words.get("type") != "ByteLevel" or not words.get("use_regex"):
        raise ValueError("not a byte-level merge model")
    if model.get("normalizer") or words.get("add_prefix_space") or kind.get("ignore_merges"):
        raise ValueError("a model that changes texts, or does not merge, is not supported")
    letters, vocabulary = byte_letters(), kind["vocab"]
    pairs = [m if isinstance(m, list) else m.split(" ") for m in kind["merges"]]
    order = [vocabulary[a + b] for a, b in pairs]
    if any(a >= b for a, b in zip(order, order[1:], strict=False)):
        raise ValueError("ids must rise with the rank of merges")
    special = {token["content"] for token in model.get("added_tokens", [])}
    return {
        bytes(letters[c] for c in token): i for token, i in vocabulary.items() if token not in special
    }


@dataclass
class TokenizerPair:
    """Both models; the encoders are built once in each process."""

    ranks: dict[bytes, int]
    pieces: bytes
    made: dict = field(default_factory=dict)

    def __post_init__(self) -> None:
        read = read_pieces(self.pieces)
        if max(max(self.ranks.values()) + 1, len(read)) > 1 << 16:
            raise ValueError("vocabularies of over 65,536 ids are not supported")

    def __getstate__(self) -> dict:
        return {"ranks": self.ranks, "pieces": self.pieces, "made": {}}

    def _make(self) -> None:
        import sentencepiece
        import tiktoken

        spelt = [b""] * (max(self.ranks.values()) + 1)
        for token, i in self.ranks.items():
            spelt[i] = token
        # Of pieces without text the bytes can never be those of a text.
        read = read_pieces(self.pieces)
        other = [
            token if kind in (1, 4, 6) else piece.encode()
            for token, (piece, _, kind) in zip(decode_table(read), read, strict=True)
        ]
        self.made = {
            "a": tiktoken.Encoding(
                "byte-level", pat_str=PATTERN, mergeable_ranks=self.ranks, special_tokens={}
            ),
            "b": sentencepiece.SentencePieceProcessor(model_proto=self.pieces),
            "spelt_a": Spelling(spelt),
            "spelt_b": Spelling(other),
            "names": np.array(
                [f"{i}{end}".encode() for i in range(len(spelt)) for end in ",|"]
                + [f"{i}{end}".encode() for i in range(len(other)) for end in ",;"],
                object,
            ),
            "names_b": 2 * len(spelt),
        }

    def __getattr__(self, name: str):
        if name.startswith("_") or name not in (
            "a", "b", "spelt_a", "spelt_b", "names", "names_b"
        ):
            raise AttributeError(name)
        if not self.made:
            self._make()
        return self.made[name]

    def encode_a(self, text: str) -> list[int]:
        if len(text) < 4000 or not LONG_SPACE.search(text):
            return self.a.encode_ordinary(text)
        # A run of white space is a word, without its last character if a word follows.
        ids, at = [], 0
        for run in LONG_SPACE.finditer(text):
            end = run.end() - (run.end() < len(text))
            ids += self.a.encode_ordinary(text[at : run.start()])
            ids += self.a._encode_single_piece(text[run.start() : end])
            at = end
        return ids + self.a.encode_ordinary(text[at:])

    def encode_b(self, texts: list[str]) -> list[list[int]]:
        return self.b.encode(texts, num_threads=1)


def load_pair(spark: SparkSession, path_a: str, path_b: str) -> TokenizerPair:
    """Both models' files, read through Spark; files over MODEL_BYTES are refused."""
    found = []
    for path in (path_a, path_b):
        files = spark.read.format("binaryFile").load(path).where(F.col("length") <= MODEL_BYTES)
        row = files.first()
        if row is None:
            raise ValueError(f"{path}: no model file of at most {MODEL_BYTES} bytes")
        found.append(bytes(row["content"]))
    return TokenizerPair(read_byte_level(found[0]), found[1])


class Aligned:
    """The groups of a block's texts.

    a, b: ids; group_a, group_b: their groups; count_a, count_b: tokens by group; doc: by group.
    """

    def __init__(self, texts: list[bytes], pair: TokenizerPair) -> None:
        strings = [text.decode("utf-8", "replace") for text in texts]
        own = [i for i, s in enumerate(strings) if s]
        lists_a = [pair.encode_a(" " + strings[i]) for i in own]
        lists_b = pair.encode_b([strings[i] for i in own])
        self.texts = len(texts)
        a, sizes_a = _flat(lists_a)
        b, sizes_b = _flat(lists_b)
        wanted = [b" " + texts[i] for i in own]
        good = _spelt_alike(a, sizes_a, pair.spelt_a, wanted)
        good &= _spelt_alike(b, sizes_b, pair.spelt_b, wanted)
        self.a, self.b = a[np.repeat(good, sizes_a)], b[np.repeat(good, sizes_b)]
        documents = np.array(own, np.int64)[good]
        self.n_a, self.n_b = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
        self.n_a[documents], self.n_b[documents] = sizes_a[good], sizes_b[good]
        ends_a = np.cumsum(pair.spelt_a.sizes[self.a])
        ends_b = np.cumsum(pair.spelt_b.sizes[self.b])
        total = int(ends_a[-1]) + 1 if len(ends_a) else 1
        cut = np.zeros(total, bool)
        cut[ends_a] = True
        also = np.zeros(total, bool)
        also[ends_b] = True
        cut &= also
        before = np.cumsum(cut) - cut
        self.group_a, self.group_b = before[ends_a], before[ends_b]
        groups = int(before[-1]) + 1 if len(ends_a) else 0
        self.count_a = np.bincount(self.group_a, minlength=groups)
        self.count_b = np.bincount(self.group_b, minlength=groups)
        first = np.cumsum(self.count_a) - self.count_a
        self.doc = np.repeat(np.arange(len(texts)), self.n_a)[first]

    def groups_text(self, pair: TokenizerPair) -> list[bytes]:
        """`a1,a2|b1;a3|b2,b3` of each text."""
        slots = np.cumsum(self.count_a + self.count_b) - self.count_a - self.count_b
        first_a = np.cumsum(self.count_a) - self.count_a
        first_b = np.cumsum(self.count_b) - self.count_b
        rank_a = np.arange(len(self.a)) - first_a[self.group_a]
        rank_b = np.arange(len(self.b)) - first_b[self.group_b]
        name = np.zeros(len(self.a) + len(self.b), np.int64)
        last_a = rank_a + 1 == self.count_a[self.group_a]
        last_b = rank_b + 1 == self.count_b[self.group_b]
        name[slots[self.group_a] + rank_a] = 2 * self.a + last_a
        name[(slots + self.count_a)[self.group_b] + rank_b] = pair.names_b + 2 * self.b + last_b
        words = pair.names[name].tolist()
        ends = np.cumsum(self.n_a + self.n_b)
        starts = ends - self.n_a - self.n_b
        bounds = zip(starts.tolist(), ends.tolist(), strict=True)
        return [b"".join(words[start:end])[:-1] for start, end in bounds]

    def _links(self) -> Iterator[np.ndarray]:
        """Keys (A id, B id, document) of all links, about LINKS at once."""
        links = self.count_a * self.count_b
        first_a = np.cumsum(self.count_a) - self.count_a
        first_b = np.cumsum(self.count_b) - self.count_b
        ends = np.cumsum(links)
        start = 0
        while start < len(links):
            reached = ends[start - 1] if start else 0
            end = max(start + 1, int(np.searchsorted(ends, reached + LINKS, "right")))
            if links[start] > LINKS:  # one group by itself, some of its A tokens at a time
                own_b = self.b[first_b[start] : first_b[start] + self.count_b[start]]
                step = max(1, LINKS // len(own_b))
                for low in range(0, int(self.count_a[start]), step):
                    high = min(low + step, int(self.count_a[start]))
                    own_a = self.a[first_a[start] + low : first_a[start] + high]
                    key = (own_a[:, None] << 16 | own_b[None, :]).ravel()
                    yield key << 24 | self.doc[start]
                start += 1
                continue
            some = links[start:end]
            group = np.repeat(np.arange(start, end), some)
            place = np.arange(len(group)) - np.repeat(np.cumsum(some) - some, some)
            wide = self.count_b[group]
            row = place // wide
            ids_a = self.a[first_a[group] + row]
            ids_b = self.b[first_b[group] + place - row * wide]
            yield (ids_a << 16 | ids_b) << 24 | self.doc[group]
            start = end

    def records(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Pair, document and number of links, by pair and document."""
        keys, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for part in self._links():
            some, times = np.unique(part, return_counts=True)
            if len(keys):
                some, times = summed(np.concatenate((keys, some)), np.concatenate((counts, times)))
            keys, counts = some, times
        return keys >> 24, keys & 0xFFFFFF, counts


def _flat(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.fromiter(map(len, lists), np.int64, len(lists))
    return np.fromiter(chain.from_iterable(lists), np.int64, int(sizes.sum())), sizes


def _spelt_alike(ids: np.ndarray, sizes: np.ndarray, spelling: Spelling, wanted: list[bytes]):
    """Which texts' ids spell what they should."""
    lengths = np.array([len(w) for w in wanted], np.int64)
    ends = np.concatenate((np.zeros(1, np.int64), np.cumsum(spelling.sizes[ids])))
    last = np.cumsum(sizes)
    good = ends[last] - ends[last - sizes] == lengths
    data = spelling.bytes_of(ids[np.repeat(good, sizes)])
    theirs = np.frombuffer(b"".join(w for w, g in zip(wanted, good.tolist(), strict=True) if g), np.uint8)
    wrong = np.flatnonzero(data != theirs)
    if len(wrong):
        of = np.searchsorted(np.cumsum(lengths[good]), wrong, "right")
        good[np.flatnonzero(good)[np.unique(of)]] = False
    return good


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Equal keys once, in order, with the sum of their counts."""
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else order
    return keys[first], np.add.reduceat(counts, first) if len(keys) else counts


def packed(*arrays: np.ndarray) -> bytes:
    """Arrays of whole numbers from 0, byte plane by byte plane, under zstd."""
    out = [np.array([len(arrays), *map(len, arrays)], np.int64).tobytes()]
    for values in arrays:
        top = int(values.max()) if len(values) else 0
        width = 1 if top < 1 << 8 else 2 if top < 1 << 16 else 4 if top < 1 << 32 else 8
        planes = values.astype(f"<u{width}").view(np.uint8).reshape(-1, width)
        out += [bytes([width]), np.ascontiguousarray(planes.T).tobytes()]
    return zstandard.compress(b"".join(out), 1)


def unpacked(data: bytes) -> list[np.ndarray]:
    data = zstandard.decompress(data)
    count = int(np.frombuffer(data, np.int64, 1)[0])
    sizes = np.frombuffer(data, np.int64, count, 8).tolist()
    at, arrays = 8 * (count + 1), []
    for size in sizes:
        width = data[at]
        planes = np.frombuffer(data, np.uint8, size * width, at + 1).reshape(width, size)
        arrays.append(np.ascontiguousarray(planes.T).view(f"<u{width}").ravel().astype(np.int64))
        at += 1 + size * width
    return arrays


def steps(values: np.ndarray) -> np.ndarray:
    """Ascending numbers as differences."""
    return np.diff(values, prepend=0)


def radix_of(ids: np.ndarray) -> np.ndarray:
    """The part of each A id."""
    return (ids * 0x9E3779B1 >> 16) % RADICES


def blocks_of(texts: list[bytes]) -> Iterator[tuple[int, int]]:
    start, held = 0, 0
    for i, text in enumerate(texts):
        if held and held + len(text) > BLOCK:
            yield start, i
            start, held = i, 0
        held += len(text) + 1
    if start < len(texts):
        yield start, len(texts)


_ENCODED = (
    "block long, radix int, first long, pairs binary, held binary, doc_id long, place int,"
    " n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"
)


def _rows(schema: str, columns: dict[str, pa.Array | list], count: int) -> pa.RecordBatch:
    """A batch in the order of a schema; columns that are not given are null."""
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "string": pa.string()}
    fields = [part.split() for part in schema.split(",")]
    arrays = [
        pa.array(columns[name], kinds[kind]) if name in columns else pa.nulls(count, kinds[kind])
        for name, kind in fields
    ]
    return pa.RecordBatch.from_arrays(arrays, [name for name, _ in fields])


def encoded(docs: DataFrame, pair: TokenizerPair) -> DataFrame:
    """Two kinds of rows: runs (radix, first, pairs, held) and documents (place, figures), by block."""
    model = docs.sparkSession.sparkContext.broadcast(pair)

    def run(batches):
        pair, task, blocks = model.value, TaskContext.get().partitionId(), 0
        for batch in batches:
            texts = raw_texts(batch.column(1))
            for start, end in blocks_of(texts):
                block = task << 32 | blocks
                blocks += 1
                yield from _encoded_block(
                    texts[start:end], batch.column(0).slice(start, end - start), block, pair
                )

    source = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return _streamed(source, run, _ENCODED)


def _streamed(df: DataFrame, run, schema: str) -> DataFrame:
    """mapInArrow over a task's whole stream, in the session's small batches."""
    return small_batches(df).mapInArrow(run, schema)


def _encoded_block(texts: list[bytes], ids: pa.Array, block: int, pair: TokenizerPair):
    found = Aligned(texts, pair)
    groups = np.bincount(found.doc, minlength=len(texts))
    links = np.zeros(len(texts), np.int64)
    np.add.at(links, found.doc, found.count_a * found.count_b)
    digests = [hashlib.sha256(t).hexdigest() if t else "" for t in found.groups_text(pair)]
    yield _rows(
        _ENCODED,
        {
            "block": np.full(len(texts), block), "doc_id": ids, "place": np.arange(len(texts)),
            "n_a": found.n_a, "n_b": found.n_b, "n_groups": groups, "n_links": links,
            "groups_sha256": digests,
        },
        len(texts),
    )
    pairs, documents, times = found.records()
    del found
    radix = radix_of(pairs >> 16)
    order = np.argsort(radix, kind="stable")
    bounds = np.searchsorted(radix[order], np.arange(RADICES + 1))
    for part in range(RADICES):
        own = order[bounds[part] : bounds[part + 1]]
        for low in range(0, len(own), PIECE):
            at = own[low : low + PIECE]
            some, first = np.unique(pairs[at], return_index=True)
            per_pair = np.diff(np.append(first, len(at)))
            yield _rows(
                _ENCODED,
                {
                    "block": [block], "radix": [part], "first": [int(some[0])],
                    "pairs": [packed(steps(some), per_pair)],
                    "held": [packed(documents[at], times[at])],
                },
                1,
            )


def merge_runs(runs: list[list[tuple[np.ndarray, np.ndarray]]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Merge sorted runs, each a list of pieces (keys, counts): pieces of equal keys summed.

    The heap holds the last key of every run's foremost piece. Up to the least of them all foremost
    pieces are complete: these keys are summed and leave, and the piece that ends there is replaced.
    """
    heads = {i: run[0] for i, run in enumerate(runs) if run}
    later = {i: iter(run[1:]) for i, run in enumerate(runs) if run}
    heap = [(int(keys[-1]), i) for i, (keys, _) in heads.items()]
    heapq.heapify(heap)
    while heap:
        limit = heap[0][0]
        keys, counts = [], []
        for i, (own, times) in heads.items():
            cut = int(np.searchsorted(own, limit, "right"))
            if cut:
                keys.append(own[:cut])
                counts.append(times[:cut])
                heads[i] = own[cut:], times[cut:]
        yield summed(np.concatenate(keys), np.concatenate(counts))
        while heap and heap[0][0] == limit:
            _, i = heapq.heappop(heap)
            following = next(later[i], None)
            if following is None:
                del heads[i]
            else:
                heads[i] = following
                heapq.heappush(heap, (int(following[0][-1]), i))


class Counter:
    """The pairs of one part so far, and the runs that wait to be merged with them."""

    def __init__(self) -> None:
        self.keys, self.counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.waiting: list[tuple[np.ndarray, np.ndarray]] = []

    def add(self, data: bytes) -> None:
        differences, counts = unpacked(data)
        self.waiting.append((np.cumsum(differences), counts))
        if len(self.waiting) >= MERGED:
            self.merge()

    def merge(self) -> None:
        runs = [[piece] for piece in self.waiting]
        runs.append(
            [
                (self.keys[low : low + PIECE], self.counts[low : low + PIECE])
                for low in range(0, len(self.keys), PIECE)
            ]
        )
        parts = list(merge_runs(runs))
        if parts:
            self.keys = np.concatenate([keys for keys, _ in parts])
            self.counts = np.concatenate([counts for _, counts in parts])
        self.waiting = []


def _merged(runs: DataFrame, keys: list[str], finish, schema: str) -> DataFrame:
    """Merge all runs of equal keys; finish(key values, pairs, counts) makes the rows."""

    def run(batches):
        at, counter = None, Counter()
        for batch in batches:
            names = list(zip(*(batch.column(k).to_pylist() for k in keys), strict=True))
            data = batch.column("pairs")
            for name, value in zip(names, data, strict=True):
                if name != at:
                    if at is not None:
                        counter.merge()
                        yield from finish(at, counter.keys, counter.counts)
                    at, counter = name, Counter()
                counter.add(value.as_py())
        if at is not None:
            counter.merge()
            yield from finish(at, counter.keys, counter.counts)

    dealt = runs.select(*keys, "pairs").repartition(*keys).sortWithinPartitions(*keys)
    return _streamed(dealt, run, schema)


_SLICED = "radix int, slice long, pairs binary"
_COUNTED = "radix int, first long, pairs binary"


def _slice_rows(at, keys, counts):
    for low in range(0, len(keys), PIECE):
        part = packed(steps(keys[low : low + PIECE]), counts[low : low + PIECE])
        yield _rows(_SLICED, {"radix": [at[0]], "slice": [at[1]], "pairs": [part]}, 1)


def _counted_rows(at, keys, counts):
    """Pairs with their counts, and whether the count is the greatest of the pair's A id."""
    owner = keys >> 16
    first = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
    most = np.repeat(np.maximum.reduceat(counts, first), np.diff(np.append(first, len(keys))))
    best = (counts == most).astype(np.int64)
    for low in range(0, len(keys), PIECE):
        own = slice(low, low + PIECE)
        part = packed(steps(keys[own]), counts[own], best[own])
        yield _rows(_COUNTED, {"radix": [at[0]], "first": [int(keys[low])], "pairs": [part]}, 1)


def counted_pairs(runs: DataFrame) -> DataFrame:
    """(radix, first, pairs): all pairs with counts and marks of the best, in pieces by A id."""
    partial = _merged(runs, ["radix", "slice"], _slice_rows, _SLICED)
    return _merged(partial, ["radix"], _counted_rows, _COUNTED)


_SUMS = "block long, sums binary"


def contributions(runs: DataFrame, counted: DataFrame, slices: int) -> DataFrame:
    """(block, sums): of each run, the sums of its documents."""
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(slices - 1).cast("long")))
    no_block, nothing = F.lit(None).cast("long"), F.lit(None).cast("binary")
    tables = counted.select(
        "radix", every.alias("slice"), no_block.alias("block"), "first", "pairs",
        nothing.alias("held"),
    )
    rows = tables.unionByName(runs.select("radix", "slice", "block", "first", "pairs", "held"))
    kind = F.col("block").isNotNull()
    dealt = rows.repartition("radix", "slice").sortWithinPartitions(
        "radix", "slice", kind, "first"
    )

    def run(batches):
        at, parts, known = None, [], None
        for batch in batches:
            columns = [
                batch.column(name).to_pylist() for name in ("radix", "slice", "block")
            ]
            out = []
            for i, (radix, part, block) in enumerate(zip(*columns, strict=True)):
                if (radix, part) != at:
                    at, parts, known = (radix, part), [], None
                arrays = unpacked(batch.column("pairs")[i].as_py())
                keys = np.cumsum(arrays[0])
                if block is None:
                    parts.append((keys, *arrays[1:]))
                    continue
                if known is None:
                    known = [np.concatenate(column) for column in zip(*parts, strict=True)]
                    parts = []
                place = np.searchsorted(known[0], keys)
                documents, times = unpacked(batch.column("held")[i].as_py())
                count = np.repeat(known[1][place], arrays[1])
                best = np.repeat(known[2][place], arrays[1])
                own, back = np.unique(documents, return_inverse=True)
                total, hits = np.zeros(len(own), np.int64), np.zeros(len(own), np.int64)
                np.add.at(total, back, count * times)
                np.add.at(hits, back, best * times)
                out.append((block, packed(steps(own), total, hits)))
            if out:
                blocks, sums = zip(*out, strict=True)
                yield _rows(_SUMS, {"block": list(blocks), "sums": list(sums)}, len(out))

    return _streamed(dealt, run, _SUMS)


_DONE = (
    "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long,"
    " groups_sha256 string"
)


def _with_sums(rows: DataFrame, sums: DataFrame) -> DataFrame:
    """Documents with what their block's runs contribute."""
    own = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
    documents = rows.where(F.col("radix").isNull()).select("block", "place", *own)
    both = documents.unionByName(sums, allowMissingColumns=True)
    dealt = both.repartition("block").sortWithinPartitions("block", F.col("place").isNotNull())

    def run(batches):
        at, total = None, None
        for batch in batches:
            blocks = batch.column("block").to_pylist()
            places = batch.column("place").to_pylist()
            chosen, found = [], []
            for i, (block, place) in enumerate(zip(blocks, places, strict=True)):
                if block != at:
                    at, total = block, {}
                if place is None:
                    differences, sums_of, hits = unpacked(batch.column("sums")[i].as_py())
                    for k, s, h in zip(
                        np.cumsum(differences).tolist(), sums_of.tolist(), hits.tolist(), strict=True
                    ):
                        old = total.get(k, (0, 0))
                        total[k] = old[0] + h, old[1] + s
                else:
                    chosen.append(i)
                    found.append(total.get(place, (0, 0)))
            if chosen:
                part = batch.select(own).take(pa.array(chosen))
                columns = {name: part.column(name) for name in own}
                columns["n_best"], columns["count_sum"] = map(list, zip(*found, strict=True))
                yield _rows(_DONE, columns, len(chosen))

    return _streamed(dealt, run, _DONE)


def _runs(rows: DataFrame, slices: int) -> DataFrame:
    part = F.pmod(F.xxhash64("block"), F.lit(slices)).alias("slice")
    own = rows.where(F.col("radix").isNotNull())
    return own.select("radix", part, "block", "first", "pairs", "held")


def slices_of(spark: SparkSession) -> int:
    """Slices of a part: some eight (part, slice) groups for each shuffle partition."""
    return -(-8 * int(spark.conf.get("spark.sql.shuffle.partitions")) // RADICES)


def align(docs: DataFrame, pair: TokenizerPair) -> tuple[DataFrame, DataFrame]:
    """The documents' figures, and the counted pairs (see `pair_table`)."""
    slices = slices_of(docs.sparkSession)
    rows = stage(encoded(docs, pair), "aligned")
    runs = _runs(rows, slices)
    counted = stage(counted_pairs(runs), "pairs")
    return _with_sums(rows, contributions(runs, counted, slices)), counted


def pair_table(counted: DataFrame) -> DataFrame:
    """(a, b, documents, best) of every linked id pair."""

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for data in batch.column(0):
            differences, counts, best = unpacked(data.as_py())
            keys = np.cumsum(differences)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys >> 16), pa.array(keys & 0xFFFF), pa.array(counts), pa.array(best > 0)],
                ["a", "b", "documents", "best"],
            )

    return map_batches(counted.select("pairs"), work, "a long, b long, documents long, best boolean")


def aligned_groups(docs: DataFrame, pair: TokenizerPair) -> DataFrame:
    """(doc_id, groups) of every document: `a1,a2|b1;a3|b2,b3`, empty without tokens."""
    model = docs.sparkSession.sparkContext.broadcast(pair)

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        pair, texts = model.value, raw_texts(batch.column(1))
        for start, end in blocks_of(texts):
            groups = Aligned(texts[start:end], pair).groups_text(pair)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(start, end - start), pa.array(groups, pa.binary()).cast(pa.string())],
                ["doc_id", "groups"],
            )

    source = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return map_batches(source, work, "doc_id long, groups string")


MODEL_A = "byte_bpe_50k.json"


def query(spark: SparkSession, folder: str) -> DataFrame:
    """op13: every document's tokens, groups and links under two tokenizers."""
    pair = load_pair(spark, model_path(spark, MODEL_A), model_path(spark, MODEL))
    return align(table(spark, folder, "documents"), pair)[0]
