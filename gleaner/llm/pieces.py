"""SentencePiece encoding and decoding with batched numpy Viterbi.

Text becomes code points (spaces as U+2581, one put in front). It is cut between two characters that
stand side by side in no piece; what lies between the cuts are words. Distinct words of one length
advance together, character by character: every substring that ends there is looked up by its hash
among the sorted hashes of the pieces, each is tried as an arc behind the best path to its start, and
the greatest allowed arc is stored as back pointer.

The vocabulary file holds a merge model: its scores rank merges and are not to be summed. Arcs are
therefore weighted by admission, not by score: an arc may follow another if merging their joined
text gives back just these two pieces. A path all of whose neighbours are so admitted is the merge
encoding, and there is exactly one, so the search gives the library's ids (a test holds it to that).
Whether two pieces may stand side by side is found by undoing their merges from the last to the
first and looking for a better-ranked merge across the border (vectorised over all pairs at once).

A process remembers pairs it has judged (MET_PAIRS of them, by hash) and words it has encoded. Words
of over LONG_WORD characters, unbroken runs, go through the same lattice one by one.

Characters without a piece become byte pieces. Decoding gathers the bytes of all ids of a block out of
the pieces' bytes at once, bytes and spaces restored. `recode` does both in one pass.

Defined results: a null or empty text has no ids and decodes to an empty text; U+2581 in a text
decodes to a space, as in the library; ids outside the vocabulary raise an error; repeated rows
encode alike; a null doc_id stays null; texts of any length are encoded whole, in blocks of texts; an
empty table gives an empty one; further columns are ignored. No shuffle. The model file (at most
MODEL_BYTES; a merge model that leaves texts as they are, others are refused) is read by Spark from a
path the caller gives and broadcast.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import blocks, map_batches, raw_texts, small_batches, table

#: Bounds what is broadcast.
MODEL_BYTES = 64 << 20
#: Words whose ids a process remembers; the store is emptied when full.
KNOWN_WORDS = 1 << 20
#: Pairs of tokens whose verdict a process remembers; a power of two.
MET_PAIRS = 1 << 20
#: Longer words are not batched.
LONG_WORD = 512
#: Texts encoded at once, in bytes.
TEXT_BYTES = 1 << 20
_SPACE = 0x2581
_BASE = np.uint64(0x9E3779B97F4A7C15)
_MASK = (1 << 64) - 1


def _fields(data: bytes):
    """(number, value) of a protocol-buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
        else:
            size = varint() if kind == 2 else {1: 8, 5: 4}[kind]
            yield key >> 3, data[at : at + size]
            at += size


def read_pieces(data: bytes) -> list[tuple[str, float, int]]:
    """(text, score, type) of each piece of a model file; types: 1 normal, 2 unknown, 6 byte."""
    found = []
    for number, value in _fields(data):
        if number == 2 and dict(_fields(value)).get(3, 1) != 2:
            raise ValueError("only merge models are supported")
        changes = dict(_fields(value)) if number == 3 else {}
        if number == 3 and (changes.get(2) or changes.get(4, 1) or not changes.get(3, 1)):
            raise ValueError("a model that changes texts before it encodes them is not supported")
        if number == 1:
            piece = dict(_fields(value))
            score = struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0
            found.append((piece[1].decode(), score, piece.get(3, 1)))
    return found


def _powers(count: int) -> np.ndarray:
    return np.concatenate(([np.uint64(1)], np.cumprod(np.full(count, _BASE, np.uint64))))


def merged(symbols: list[int], joins: dict[tuple[int, int], int], scores) -> tuple[list[int], list]:
    """Merge neighbours, best score first and leftmost among equals; also the merges made."""
    made = []
    symbols = list(symbols)
    while True:
        best, where = None, -1
        for i in range(len(symbols) - 1):
            to = joins.get((symbols[i], symbols[i + 1]))
            if to is not None and (best is None or scores[to] > scores[best]):
                best, where = to, i
        if best is None:
            return symbols, made
        made.append((best, symbols[where], symbols[where + 1]))
        symbols[where : where + 2] = [best]


@dataclass
class Vocabulary:
    """A merge model as arrays. Tokens are the pieces' ids, then characters that are no piece."""

    texts: list[str]  # of the pieces
    token_texts: list[str]
    scores: np.ndarray
    left: np.ndarray
    right: np.ndarray
    odd: np.ndarray  # tokens whose merges do not go from better to worse
    keys: np.ndarray  # hashes of tokens that encode to themselves, sorted
    key_tokens: np.ndarray
    join_keys: np.ndarray
    join_tokens: np.ndarray
    joins: dict[tuple[int, int], int]
    longest: int
    classes: np.ndarray  # of each code point, 0 outside all pieces
    beside: np.ndarray  # by class and class
    bytes_of: np.ndarray  # ids of the byte pieces
    kinds: list[int]
    char_tokens: dict[str, int]
    tried: dict[tuple[int, int], bool]
    encoder: Encoder | None = None  # of this process, kept from task to task
    met_pairs: np.ndarray | None = None
    met_verdicts: np.ndarray | None = None
    by_text: dict[str, int] | None = None

    @classmethod
    def of(cls, pieces: list[tuple[str, float, int]]) -> Vocabulary:
        texts = [text for text, _, _ in pieces]
        kinds = [kind for _, _, kind in pieces]
        tokens = {text: i for i, (text, _, kind) in enumerate(pieces) if kind in (1, 4)}
        normal = list(tokens)
        token_texts = list(texts)
        for char in sorted({c for text in normal for c in text}):
            if char not in tokens:
                tokens[char] = len(token_texts)
                token_texts.append(char)
        scores = np.full(len(token_texts), -np.inf)
        scores[: len(pieces)] = [score for _, score, _ in pieces]
        joins = {
            (tokens[text[:i]], tokens[text[i:]]): tokens[text]
            for text in normal
            for i in range(1, len(text))
            if text[:i] in tokens and text[i:] in tokens
        }
        size = len(token_texts)
        left, right = np.full(size, -1, np.int64), np.full(size, -1, np.int64)
        odd, own = np.zeros(size, bool), []
        ranks = scores.tolist()
        for text, token in tokens.items():
            symbols, made = merged([tokens[c] for c in text], joins, ranks)
            if symbols != [token]:
                continue
            own.append(token)
            if made:
                left[token], right[token] = made[-1][1:]
                order = [ranks[to] for to, _, _ in made]
                odd[token] = any(a <= b for a, b in zip(order, order[1:], strict=False))
        classes = np.zeros(0x110000, np.int16)
        chars = sorted({c for text in normal if len(text) > 1 for c in text})
        classes[[ord(c) for c in chars]] = np.arange(1, len(chars) + 1)
        beside = np.zeros((len(chars) + 1, len(chars) + 1), bool)
        for text in normal:
            for a, b in zip(text, text[1:], strict=False):
                beside[classes[ord(a)], classes[ord(b)]] = True
        hashes = np.array([text_hash(token_texts[t]) for t in own], np.uint64)
        order = np.argsort(hashes)
        keys = np.array([a * size + b for a, b in joins], np.int64)
        by = np.argsort(keys)
        bytes_of = np.full(256, texts.index("<unk>") if "<unk>" in texts else 0, np.int32)
        for i, (text, _, kind) in enumerate(pieces):
            if kind == 6:
                bytes_of[int(text[3:5], 16)] = i
        return cls(
            texts, token_texts, scores, left, right, odd, hashes[order], np.array(own)[order],
            keys[by], np.array(list(joins.values()), np.int64)[by], joins,
            max(len(text) for text in normal), classes, beside, bytes_of, kinds,
            {text: token for text, token in tokens.items() if len(text) == 1}, {},
        )

    def admitted(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """Whether merging the joined texts of two tokens gives back the two; remembered by hash."""
        if self.met_pairs is None:
            self.met_pairs = np.full(MET_PAIRS, -1, np.int64)
            self.met_verdicts = np.zeros(MET_PAIRS, bool)
        pairs = first * len(self.scores) + second
        slots = (pairs.astype(np.uint64) * _BASE >> np.uint64(64 - MET_PAIRS.bit_length() + 1)).astype(np.int64)
        good = self.met_verdicts[slots]
        new = np.flatnonzero(self.met_pairs[slots] != pairs)
        if len(new):
            good[new] = self._judged(first[new], second[new])
            chosen = new[np.unique(slots[new], return_index=True)[1]]  # one pair a slot
            self.met_pairs[slots[chosen]] = pairs[chosen]
            self.met_verdicts[slots[chosen]] = good[chosen]
        return good

    def _judged(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        keys, back = np.unique(first * len(self.scores) + second, return_inverse=True)
        a, b = np.divmod(keys, len(self.scores))
        good = np.ones(len(keys), bool)
        strange = self.odd[a] | self.odd[b]
        for i in np.flatnonzero(strange):
            good[i] = self._tried(int(a[i]), int(b[i]))
        at = np.flatnonzero(~strange)
        a, b = a[at], b[at]
        # Scores of the merges that end the time of a and of b.
        over_a, over_b = np.full(len(at), -np.inf), np.full(len(at), -np.inf)
        while len(at):
            key = a * len(self.scores) + b
            place = np.minimum(np.searchsorted(self.join_keys, key), len(self.join_keys) - 1)
            across = np.where(
                self.join_keys[place] == key, self.scores[self.join_tokens[place]], -np.inf
            )
            broken = (across > over_a) & (across >= over_b) & (across > -np.inf)
            good[at[broken]] = False
            whole_a, whole_b = self.left[a] < 0, self.left[b] < 0
            undo_b = ~whole_b & (whole_a | (self.scores[b] <= self.scores[a]))
            undo_a = ~whole_a & ~undo_b
            over_b = np.where(undo_b, self.scores[b], over_b)
            over_a = np.where(undo_a, self.scores[a], over_a)
            a, b = np.where(undo_a, self.right[a], a), np.where(undo_b, self.left[b], b)
            go = ~broken & (undo_a | undo_b)
            at, a, b, over_a, over_b = at[go], a[go], b[go], over_a[go], over_b[go]
        return good[back]

    def _tried(self, a: int, b: int) -> bool:
        """By merging; at most one entry for each pair of odd tokens that meet."""
        if (a, b) not in self.tried:
            symbols = [self.char_tokens[c] for c in self.token_texts[a] + self.token_texts[b]]
            self.tried[a, b] = merged(symbols, self.joins, self.scores)[0] == [a, b]
            if len(self.tried) > KNOWN_WORDS:
                self.tried = {(a, b): self.tried[a, b]}
        return self.tried[a, b]

    def one_by_one(self, chars: np.ndarray) -> np.ndarray:
        """`viterbi` of one long word."""
        if self.by_text is None:
            self.by_text = {self.token_texts[t]: t for t in self.key_tokens.tolist()}
        word = chars.astype("<u4").tobytes().decode("utf-32-le")
        tokens, lengths, verdicts = [-1], [0], {}
        for end in range(1, len(word) + 1):
            for length in range(min(end, self.longest), 0, -1):
                token = self.by_text.get(word[end - length : end])
                if token is None:
                    continue
                before = tokens[end - length]
                if end > length:
                    if (before, token) not in verdicts:
                        pair = np.array([before]), np.array([token])
                        verdicts[before, token] = bool(self.admitted(*pair)[0])
                    if not verdicts[before, token]:
                        continue
                break
            else:
                token, length = -1, 1
            tokens.append(token)
            lengths.append(length)
        out, place = [], len(word)
        while place:
            out.append(tokens[place])
            place -= lengths[place]
        return np.array(out[::-1])

    def token_at(self, hashes: np.ndarray) -> np.ndarray:
        """Tokens by hash, -1 for none."""
        place = np.minimum(np.searchsorted(self.keys, hashes), len(self.keys) - 1)
        return np.where(self.keys[place] == hashes, self.key_tokens[place], -1)

    def viterbi(self, chars: np.ndarray) -> np.ndarray:
        """Tokens of words of one length (rows of code points), -1 before the first."""
        count, size = chars.shape
        powers = _powers(size)
        sums = np.zeros((count, size + 1), np.uint64)
        np.cumsum(_mixed_char(chars) * powers[:size], axis=1, out=sums[:, 1:])
        inverse = _inverse_powers(size)
        tokens, lengths = np.full((count, size + 1), -1), np.ones((count, size + 1), np.int64)
        for end in range(1, size + 1):
            best = np.zeros(count, np.int64)
            for length in range(1, min(end, self.longest) + 1):
                start = end - length
                found = self.token_at((sums[:, end] - sums[:, start]) * inverse[start])
                rows = np.flatnonzero(found >= 0)
                if start and len(rows):
                    rows = rows[self.admitted(tokens[rows, start], found[rows])]
                best[rows] = length  # the greatest so far
                tokens[rows, end] = found[rows]
            lengths[:, end] = np.maximum(best, 1)
        out, place, filled = np.full((count, size), -1), np.full(count, size), size
        rows = np.arange(count)
        while len(rows):
            filled -= 1
            out[rows, filled] = tokens[rows, place[rows]]
            place[rows] -= lengths[rows, place[rows]]
            rows = rows[place[rows] > 0]
        return out


@lru_cache(64)
def _inverse_powers(size: int) -> np.ndarray:
    inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
    return np.concatenate(([np.uint64(1)], np.cumprod(np.full(size, inverse, np.uint64))))


def _mixed_char(chars: np.ndarray) -> np.ndarray:
    mixed = (chars.astype(np.uint64) + np.uint64(1)) * np.uint64(0xFF51AFD7ED558CCD)
    return (mixed ^ (mixed >> np.uint64(32))) * np.uint64(0xC4CEB9FE1A85EC53)


def text_hash(text: str) -> int:
    chars = np.array([ord(c) for c in text], np.uint32)
    return int((_mixed_char(chars) * _powers(len(chars))[: len(chars)]).sum(dtype=np.uint64))


class Encoder:
    """Encodes texts, remembering words it has met."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.vocabulary = vocabulary
        self._forget()

    def _forget(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.starts, self.counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.int32)

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of several texts, and how many each text has."""
        parts = [
            "▁" + text.decode("utf-8", "replace").replace(" ", "▁") if text else ""
            for text in texts
        ]
        sizes = np.array([len(part) for part in parts], np.int64)
        chars = np.frombuffer("".join(parts).encode("utf-32-le", "replace"), np.uint32)
        if not len(chars):
            return np.zeros(0, np.int32), np.zeros(len(texts), np.int64)
        classes = self.vocabulary.classes[chars]
        starts = np.ones(len(chars), bool)
        starts[1:] = ~self.vocabulary.beside[classes[:-1], classes[1:]]
        firsts = np.concatenate(([0], np.cumsum(sizes)))[:-1]
        starts[firsts[sizes > 0]] = True
        begins = np.flatnonzero(starts)
        ends = np.append(begins[1:], len(chars))
        hashes = self._hashes(chars, begins, ends)
        unique, first, back = np.unique(hashes, return_index=True, return_inverse=True)
        self._learn(chars, unique, begins[first], ends[first])
        place = np.searchsorted(self.keys, unique)[back]
        counts = self.counts[place]
        offsets = np.cumsum(counts) - counts
        ids = self.ids[np.repeat(self.starts[place] - offsets, counts) + np.arange(counts.sum())]
        text_of = np.searchsorted(firsts, begins, "right") - 1
        # Empty texts share their neighbour's first place: the last one of equals has the words.
        return ids, np.bincount(text_of, counts, len(texts)).astype(np.int64)

    @staticmethod
    def _hashes(chars: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hashes of words, made relative to each word's begin; its length is mixed in."""
        sizes = ends - begins
        places = np.arange(len(chars)) - np.repeat(begins, sizes)
        top = int(sizes.max())
        terms = _mixed_char(chars) * _powers(top)[places]
        return np.add.reduceat(terms, begins)

    def _learn(self, chars: np.ndarray, unique: np.ndarray, begins, ends) -> None:
        if len(self.keys) + len(unique) > KNOWN_WORDS:
            self._forget()
        if len(self.keys):
            place = np.minimum(np.searchsorted(self.keys, unique), len(self.keys) - 1)
            fresh = self.keys[place] != unique
            unique, begins, ends = unique[fresh], begins[fresh], ends[fresh]
        if not len(unique):
            return
        sizes = ends - begins
        new_ids, new_counts, order = [], [], []
        for size in np.unique(sizes):
            rows = np.flatnonzero(sizes == size)
            if size > LONG_WORD:
                found = [self.vocabulary.one_by_one(chars[begins[r] : begins[r] + size]) for r in rows]
                counts = np.array([len(tokens) for tokens in found], np.int64)
                ids = self._known(np.concatenate(found))
                new_ids.append(ids[0])
                new_counts.append(np.add.reduceat(ids[1], np.cumsum(counts) - counts))
                order.append(rows)
                continue
            words = chars[begins[rows][:, None] + np.arange(size)]
            tokens = self.vocabulary.viterbi(words) if size > 1 else self._single(words)
            ids, counts = self._spelt(tokens, words)
            new_ids.append(ids)
            new_counts.append(counts)
            order.append(rows)
        rows = np.concatenate(order)
        counts = np.concatenate(new_counts)
        starts = len(self.ids) + np.cumsum(counts) - counts
        keys = np.concatenate((self.keys, unique[rows]))
        by = np.argsort(keys, kind="stable")
        self.keys = keys[by]
        self.starts = np.concatenate((self.starts, starts))[by]
        self.counts = np.concatenate((self.counts, counts))[by]
        self.ids = np.concatenate((self.ids, *new_ids))

    def _known(self, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of tokens, and how many each has: a character that is no piece has its bytes."""
        known = len(self.vocabulary.texts)
        if (tokens < known).all():
            return tokens.astype(np.int32), np.ones(len(tokens), np.int64)
        spelt = [
            [token]
            if token < known
            else self.vocabulary.bytes_of[list(self.vocabulary.token_texts[token].encode())].tolist()
            for token in tokens.tolist()
        ]
        ids = np.array([i for own in spelt for i in own], np.int32)
        return ids, np.array([len(own) for own in spelt], np.int64)

    def _single(self, words: np.ndarray) -> np.ndarray:
        tokens = self.vocabulary.token_at(_mixed_char(words[:, 0]))
        return np.where(tokens < 0, len(self.vocabulary.scores), tokens)[:, None]

    def _spelt(self, tokens: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words' tokens; characters that are no piece become their bytes."""
        known = len(self.vocabulary.texts)
        if (tokens < known).all():
            return tokens[tokens >= 0].astype(np.int32), (tokens >= 0).sum(axis=1)
        ids, counts = [], []
        for row, word in zip(tokens.tolist(), words.tolist(), strict=True):
            own: list[int] = []
            for token in row:
                if token >= known:
                    char = (
                        chr(word[0])
                        if token == len(self.vocabulary.scores)
                        else self.vocabulary.token_texts[token]
                    )
                    own += self.vocabulary.bytes_of[list(char.encode("utf-8", "replace"))].tolist()
                elif token >= 0:
                    own.append(token)
            ids += own
            counts.append(len(own))
        return np.array(ids, np.int32), np.array(counts, np.int64)


def decode_table(pieces: list[tuple[str, float, int]]) -> list[bytes]:
    """What each id stands for; control pieces for nothing."""
    out = []
    for text, _, kind in pieces:
        if kind == 6:
            out.append(bytes([int(text[3:5], 16)]))
        elif kind == 2:
            out.append(" ⁇ ".encode())
        else:
            out.append(b"" if kind == 3 else text.replace("▁", " ").encode())
    return out


class Spelling:
    """The bytes of a vocabulary's ids, one behind the other."""

    def __init__(self, spelt: list[bytes]) -> None:
        self.sizes = np.array([len(s) for s in spelt], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.data = np.frombuffer(b"".join(spelt), np.uint8)

    def bytes_of(self, ids: np.ndarray) -> np.ndarray:
        sizes = self.sizes[ids]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        return self.data[np.repeat(self.starts[ids] - (ends - sizes), sizes) + np.arange(total)]

    def texts(self, ids: np.ndarray, counts: np.ndarray) -> pa.Array:
        """The text of each list of ids, less the space that encoding put in front."""
        if len(ids) and (ids.min() < 0 or ids.max() >= len(self.sizes)):
            raise ValueError("an id is not in the vocabulary")
        data = self.bytes_of(ids)
        ends = np.concatenate((np.zeros(1, np.int64), np.cumsum(self.sizes[ids])))
        last = np.cumsum(counts)
        bounds = np.concatenate((np.zeros(1, np.int64), ends[last]))
        starts = bounds[:-1]
        full = np.flatnonzero(bounds[1:] > starts)
        leading = full[data[starts[full]] == 0x20]
        gone = np.zeros(len(counts), np.int64)
        gone[leading] = 1
        data = np.delete(data, starts[leading])
        bounds[1:] -= np.cumsum(gone)
        buffers = [None, pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(data))]
        spelt = pa.Array.from_buffers(pa.large_binary(), len(counts), buffers)
        try:
            return spelt.cast(pa.large_string()).cast(pa.string())
        except pa.ArrowInvalid:
            return pa.array([t.decode("utf-8", "replace") for t in spelt.to_pylist()], pa.string())


def load_model(spark: SparkSession, path: str) -> list[tuple[str, float, int]]:
    """The pieces of a model file, read through Spark; files over MODEL_BYTES are refused."""
    row = spark.read.format("binaryFile").load(path).where(F.col("length") <= MODEL_BYTES).first()
    if row is None:
        raise ValueError(f"{path}: no model file of at most {MODEL_BYTES} bytes")
    return read_pieces(bytes(row["content"]))


def _lists(ids: np.ndarray, counts: np.ndarray) -> pa.Array:
    offsets = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids, pa.int32()))


def slices(batch: pa.RecordBatch, limit: int = 8 * TEXT_BYTES) -> Iterator[pa.RecordBatch]:
    """Parts of a batch of at most so many bytes, or of one row."""
    if batch.num_rows <= 1 or batch.nbytes <= limit:
        yield batch
        return
    half = batch.num_rows // 2
    yield from slices(batch.slice(0, half), limit)
    yield from slices(batch.slice(half), limit)


def _coded(docs: DataFrame, pieces: list[tuple[str, float, int]], texts: bool) -> DataFrame:
    """(doc_id, ids), with texts also the text that the ids decode to."""
    spark = docs.sparkSession
    model = spark.sparkContext.broadcast((Vocabulary.of(pieces), Spelling(decode_table(pieces))))
    names = ["doc_id", "ids", "text"] if texts else ["doc_id", "ids"]

    def run(batches):
        vocabulary, spelling = model.value
        encoder = vocabulary.encoder = vocabulary.encoder or Encoder(vocabulary)
        for batch in batches:
            for part in slices(batch):
                own = raw_texts(part.column(1))
                for start, end in blocks(own, TEXT_BYTES):
                    ids, counts = encoder.encode(own[start:end])
                    columns = [part.column(0).slice(start, end - start), _lists(ids, counts)]
                    if texts:
                        columns.append(spelling.texts(ids, counts))
                    yield pa.RecordBatch.from_arrays(columns, names)

    source = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    schema = "doc_id long, ids array<int>" + ", text string" * texts
    return small_batches(source).mapInArrow(run, schema)


def encode(docs: DataFrame, pieces: list[tuple[str, float, int]]) -> DataFrame:
    """(doc_id, ids) of every whole text."""
    return _coded(docs, pieces, texts=False)


def recode(docs: DataFrame, pieces: list[tuple[str, float, int]]) -> DataFrame:
    """(doc_id, ids, text): `encode`, and what the ids decode to, in one pass."""
    return _coded(docs, pieces, texts=True)


def decode(encoded: DataFrame, pieces: list[tuple[str, float, int]]) -> DataFrame:
    """(doc_id, ids, text) of encoded rows; null ids have an empty text."""
    model = encoded.sparkSession.sparkContext.broadcast(Spelling(decode_table(pieces)))

    def work(batch: pa.RecordBatch):
        for part in slices(batch):
            lists = part.column(1)
            counts = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            ids = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), lists, model.value.texts(ids, counts.astype(np.int64))],
                ["doc_id", "ids", "text"],
            )

    source = encoded.select(F.col("doc_id").cast("long"), F.col("ids").cast("array<int>"))
    return map_batches(source, work, "doc_id long, ids array<int>, text string")


#: Where the models lie unless the session's TOKENIZERS setting names another folder.
FOLDER, TOKENIZERS = "file:///opt/tokenizers", "spark.gleaner.tokenizers"
MODEL = "piece_bpe_32k.model"


def model_path(spark: SparkSession, name: str = MODEL) -> str:
    return f"{spark.conf.get(TOKENIZERS, FOLDER)}/{name}"


def checked(coded: DataFrame) -> list[Column]:
    """The query's columns: ids, their number, and the digest of what they decode to."""
    return [
        coded["doc_id"],
        coded["ids"],
        F.size(coded["ids"]).cast("long").alias("n_ids"),
        F.sha2(coded["text"], 256).alias("decoded_sha256"),
    ]


def query(spark: SparkSession, folder: str) -> DataFrame:
    """op2: ids of every document, and the digest of the text they decode to."""
    pieces = load_model(spark, model_path(spark))
    coded = recode(table(spark, folder, "documents"), pieces)
    return coded.select(*checked(coded))
