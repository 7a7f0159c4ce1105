"""N-gram Jaccard join by universe partition and pigeonhole, exact.

A document's set holds the hashes of its distinct five-word shingles (A-Z lower-cased, split at ASCII
white space; fewer words are one shingle). Two documents link when 100 |A & B| >= 75 |A | B|.

Universe partition. Sizes fall into bands from 2**b to 2**(b + 1) - 1. A band has a scheme: the hash
universe in `segments` ranges. Linked sets differ in at most H(n) = (n + 4n/3) / 7 shingles, n the
smaller size; if at least H + 1 of its segments are not empty, one of these is the same in both.
With one-deletion neighbourhoods a segment of two or more shingles counts twice, as then segments
that differ by one shingle meet too. A set is indexed under its band's scheme, and under the next
lower one where a partner there can be near enough.

Cost-based allocation. Candidate schemes (coarse with deletions, fine without, every shingle by
itself) are weighed on all sets of a band: the cheapest by index rows that gives each set its H + 1,
with some in reserve, is taken, and only the leading segments that any set needs are indexed.

Frequent keys. A key of more than COMMON sets is common, and nothing is compared for it. A set whose
other keys still make H + 1 finds all its partners by them. The others are indexed again, among
themselves and with every shingle by itself, at the least cost: linked sets of size n differ from each
other's by n / 4 of their own shingles at most, so n / 4 + 1 segments are allocated, those of the
shingles that fewest of these sets have. A passage that many share is then in nobody's allocation
that has a quarter of its own.

Verification. ROUNDS times, each key picks a leader, and the sets of the key that are not yet in its
component are compared with it; then, only where a key's sets are still in different components, its
sets are compared across components. Pairs already in one component add nothing, so a large group of
near copies costs a few comparisons a set, and only sets that miss it meet all of it. A pair is first
held against parities: bit h mod B of a set's parity is the number of its shingles there, odd or even,
so two parities never differ in more bits than the sets do in shingles, and pairs that differ in too
many go: by SHORT_BITS bits as part of the join across components, so that such pairs are not even
made, then by the whole parities. What is left is compared on the whole sets.

Equal sets are one class from the start, so copies cost one row a batch. Results: a document's set
size and the smallest doc_id of its component.

Rows are told apart by a 64-bit hash of their columns, not by doc_id, and links are between classes
of rows with equal sets; only what is returned as a document's component unites rows by doc_id.

Defined results: null and empty texts have size 0 and link with nothing; a null doc_id counts as the
smallest; rows that share a doc_id are one document, whose links are united (`join_near`), or each
its own (`one_of_each`); rows without a doc_id are each their own; further columns are ignored; an
empty table has no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import (
    NO_ID,
    blocks,
    document_columns,
    identified,
    map_batches,
    mixed,
    multipliers,
    raw_texts,
    real_id,
    stage,
    table,
    window_hashes,
    word_hashes,
)
from .components import components, with_edges

SHINGLE = 5
#: A key of more sets is common.
COMMON = 40
#: The low bits of a packed node hold how many of its keys may be common.
RESERVE_BITS = 12
#: Comparisons with a leader before those across components.
ROUNDS = 3
#: Ids up to this number (16 bytes each) are broadcast to pick texts; more are joined by shuffle.
PICK_ROWS = 1_000_000

# Schemes of a band whose largest size is `top`: segments a shingle of the top, and deletions or not.
_OPTIONS = ((0.2, True), (0.4, False), (0.4, True), (0.8, False), (None, False))
_ALL = 1 << 32  # segments when every shingle is by itself


@dataclass(frozen=True)
class Scheme:
    segments: int
    deletions: bool
    leading: int


def segments_of(option: int, band: int) -> int:
    share = _OPTIONS[option][0]
    return _ALL if share is None else max(1, int(np.ceil(share * ((2 << band) - 1))))


def most_apart(size: np.ndarray | int) -> np.ndarray | int:
    """The most shingles by which a set may differ from a linked one of its size or more."""
    return (size + size * 4 // 3) // 7


def band_of(sizes: np.ndarray) -> np.ndarray:
    return np.frexp(sizes.astype(np.float64))[1] - 1


def token_sets(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, ascending within a text, and the texts' sizes."""
    split = [text.lower().split() for text in texts]
    lengths = np.array([len(words) for words in split], np.int64)
    bounds = np.concatenate(([0], np.cumsum(lengths)))
    words = word_hashes([word for own in split for word in own])
    document = np.repeat(np.arange(len(texts)), lengths)
    grams = window_hashes(words, SHINGLE)
    inside = np.flatnonzero(document[: len(grams)] == document[SHINGLE - 1 :])
    short = np.flatnonzero((lengths > 0) & (lengths < SHINGLE))
    factors = multipliers(SHINGLE)
    single = [
        mixed((words[bounds[d] : bounds[d + 1]] * factors[: lengths[d]]).sum(keepdims=True))
        + np.uint64(lengths[d])
        for d in short
    ]
    tokens = np.concatenate([grams[inside], *single])
    document = np.concatenate([document[inside], short])
    order = np.lexsort((tokens, document))
    tokens, document = tokens[order], document[order]
    fresh = np.ones(len(tokens), bool)
    fresh[1:] = (tokens[1:] != tokens[:-1]) | (document[1:] != document[:-1])
    return tokens[fresh], np.bincount(document[fresh], minlength=len(texts)).astype(np.int64)


def digests(tokens: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits of each set."""
    sums = []
    for salt in (np.uint64(0x243F6A8885A308D3), np.uint64(0x13198A2E03707344)):
        running = np.concatenate(([np.uint64(0)], np.cumsum(mixed(tokens ^ salt), dtype=np.uint64)))
        ends = np.cumsum(sizes)
        sums.append(mixed(running[ends] - running[ends - sizes]).view(np.int64))
    return sums[0], sums[1]


def parities(tokens: np.ndarray, sizes: np.ndarray) -> list[bytes]:
    """For each set 2**(band + 1) bits, 64 at least: one to two bits a shingle."""
    out, end = [], 0
    for size, band in zip(sizes.tolist(), band_of(np.maximum(sizes, 1)).tolist(), strict=True):
        bits = 1 << max(6, band + 1)
        start, end = end, end + size
        place = (tokens[start:end] & np.uint64(bits - 1)).astype(np.int64)
        odd = (np.bincount(place, minlength=bits) & 1).astype(np.uint8)
        out.append(np.packbits(odd).tobytes())
    return out


#: Short parities of SHORT_BITS bits, in numbers of 64, that the engine compares by itself.
SHORT_BITS = 256
SHORT = [f"p{i}" for i in range(SHORT_BITS // 64)]


def short_parities(tokens: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """For each set SHORT_BITS bits, as a row of numbers."""
    row = np.repeat(np.arange(len(sizes)), sizes)
    place = row * SHORT_BITS + (tokens & np.uint64(SHORT_BITS - 1)).astype(np.int64)
    odd = (np.bincount(place, minlength=len(sizes) * SHORT_BITS) & 1).astype(np.uint8)
    return np.packbits(odd).view(np.int64).reshape(len(sizes), len(SHORT))


def _not_apart(at_least: int):
    """Whether short parities and sizes leave it open that (size, p0 …) and (x_size, x_p0 …) link."""
    apart = F.lit(0)
    for name in SHORT:
        apart = apart + F.bit_count(F.col(name).bitwiseXOR(F.col(f"x_{name}")))
    both = F.col("size") + F.col("x_size")
    return 100 * (both - apart) >= at_least * (both + apart)


def parity_apart(x: bytes, y: bytes) -> int:
    """In how many bits two parities differ; the longer is folded to the shorter's length."""
    a, b = np.frombuffer(x, np.uint8), np.frombuffer(y, np.uint8)
    while len(a) > len(b):
        a = a[: len(a) // 2] ^ a[len(a) // 2 :]
    while len(b) > len(a):
        b = b[: len(b) // 2] ^ b[len(b) // 2 :]
    return int(np.bitwise_count(a ^ b).sum())


def parts(
    tokens: np.ndarray, document: np.ndarray, segments: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Non-empty segments of sets: where each begins among the tokens, its number, its size.

    segments is each token's number of segments; tokens ascend, so segments are runs."""
    number = ((tokens >> np.uint64(32)) * segments.astype(np.uint64) >> np.uint64(32)).astype(
        np.int64
    )
    fresh = np.ones(len(tokens), bool)
    fresh[1:] = (number[1:] != number[:-1]) | (document[1:] != document[:-1])
    begin = np.flatnonzero(fresh)
    return begin, number[begin], np.diff(np.append(begin, len(tokens)))


def within(values: np.ndarray, document: np.ndarray, count: int) -> np.ndarray:
    """Running sums that start anew at each document."""
    total = np.cumsum(values)
    first = np.searchsorted(document, np.arange(count))
    before = np.concatenate(([0], total))[first]
    return total - before[document]


def weighed(tokens: np.ndarray, sizes: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """For each option and set: the leading segments it needs (-1: it has too few), and the cost.

    The cost of a key is 1, and 2 if it is a single shingle, which most sets may share."""
    count = len(sizes)
    document = np.repeat(np.arange(count), sizes)
    bands = band_of(np.maximum(sizes, 1))
    enough = most_apart(sizes) + 1
    needed, costs = [], []
    for option, (_, deletions) in enumerate(_OPTIONS):
        table = np.array([segments_of(option, b) for b in range(int(bands.max(initial=0)) + 1)])
        begin, number, held = parts(tokens, document, table[bands[document]])
        own = document[begin]
        worth = 1 + (deletions & (held > 1))
        running = within(worth, own, count)
        total = np.bincount(own, worth, count).astype(np.int64)
        target = np.minimum(enough + 4 + sizes // 20, np.maximum(total, enough))
        used = running - worth < target[own]
        keys = 1 + np.where(deletions & (held > 1), held, 0)
        singles = (held == 1) | (deletions & (held == 2))
        costs.append(np.bincount(own, used * (keys + singles), count))
        reach = np.zeros(count, np.int64)
        np.maximum.at(reach, own[used], number[used] + 1)
        needed.append(np.where(total >= enough, reach, -1))
    return needed, costs


def described(rows: DataFrame) -> DataFrame:
    """row, doc_id, n, digests, and for each option what the set needs and costs, of (row, text, doc_id)."""
    options = range(len(_OPTIONS))

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        texts = raw_texts(batch.column(1))
        for start, end in blocks(texts):
            tokens, sizes = token_sets(texts[start:end])
            one, two = digests(tokens, sizes)
            needed, costs = weighed(tokens, sizes)
            short = short_parities(tokens, sizes)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).slice(start, end - start),
                    batch.column(2).slice(start, end - start),
                    pa.array(sizes),
                    pa.array(one),
                    pa.array(two),
                    pa.array(parities(tokens, sizes), pa.binary()),
                    *(pa.array(short[:, i]) for i in range(len(SHORT))),
                    *(pa.array(x) for x in needed),
                    *(pa.array(x.astype(np.float64)) for x in costs),
                ],
                ["row", "doc_id", "n", "d1", "d2", "parity", *SHORT, *(f"need{i}" for i in options), *(f"cost{i}" for i in options)],
            )

    names = [f"{name} long" for name in SHORT]
    names += [f"need{i} long" for i in options] + [f"cost{i} double" for i in options]
    return map_batches(rows, work, ", ".join(["row long, doc_id long, n long, d1 long, d2 long, parity binary", *names]))


def allocated(sets: DataFrame) -> dict[int, Scheme]:
    """The cheapest scheme of each band that serves all its sets: at most 63 rows reach the driver."""
    options = range(len(_OPTIONS))
    totals = (
        sets.where("n > 0")
        .groupBy(F.floor(F.log2("n") + 1e-12).alias("band"))
        .agg(
            *[F.min(f"need{i}").alias(f"least{i}") for i in options],
            *[F.max(f"need{i}").alias(f"most{i}") for i in options],
            *[F.sum(f"cost{i}").alias(f"cost{i}") for i in options],
        )
        .collect()
    )
    schemes = {}
    for row in totals:
        able = [i for i in options if row[f"least{i}"] >= 0]
        best = min(able, key=lambda i: (row[f"cost{i}"], i))
        band = row["band"]
        schemes[band] = Scheme(segments_of(best, band), _OPTIONS[best][1], row[f"most{best}"])
    return schemes


def index_keys(
    tokens: np.ndarray, sizes: np.ndarray, node: np.ndarray, schemes: dict[int, Scheme]
) -> tuple[np.ndarray, np.ndarray]:
    """(key, packed node) of sets: their own band's scheme, and the lower one where it can matter."""
    keys, nodes = [], []
    bands = band_of(np.maximum(sizes, 1))
    ends = np.cumsum(sizes)
    hashed = mixed(tokens)
    for lower in (0, 1):
        top = (2 << np.maximum(bands - 1, 0)) - 1 if lower else sizes
        meets = (sizes > 0) & ((bands > 0) & (3 * sizes <= 4 * top) if lower else True)
        for band in np.unique(bands[meets]).tolist():
            scheme = schemes.get(band - lower)
            if scheme is None:
                continue
            rows = np.flatnonzero(meets & (bands == band))
            own_sizes = sizes[rows]
            own = np.repeat(np.arange(len(rows)), own_sizes)
            start = np.repeat(ends[rows] - own_sizes, own_sizes)
            take = start + np.arange(len(own)) - np.repeat(np.cumsum(own_sizes) - own_sizes, own_sizes)
            own_tokens, own_hashed = tokens[take], hashed[take]
            begin, number, held = parts(
                own_tokens, own, np.full(len(own_tokens), scheme.segments, np.int64)
            )
            running = np.concatenate(([np.uint64(0)], np.cumsum(own_hashed, dtype=np.uint64)))
            subset = running[begin + held] - running[begin]
            used = number < scheme.leading
            begin, number, held, subset = begin[used], number[used], held[used], subset[used]
            place = mixed(number.astype(np.uint64) * np.uint64(64) + np.uint64(band - lower))
            document = own[begin]
            twice = scheme.deletions & (held > 1)
            worth = np.bincount(document, 1 + twice, len(rows)).astype(np.int64)
            largest = (2 << (band - 1)) - 1 if lower else own_sizes * 4 // 3
            reserve = worth - ((own_sizes + largest) // 7 + 1)
            if scheme.deletions:
                reserve = reserve // 2
            packed = (node[rows] >> RESERVE_BITS << RESERVE_BITS) | np.clip(
                reserve, 0, (1 << RESERVE_BITS) - 1
            )
            keys.append(mixed(subset + place))
            nodes.append(packed[document])
            if scheme.deletions and twice.any():
                inner = np.repeat(np.flatnonzero(twice), held[twice])
                offset = np.arange(len(inner)) - np.repeat(
                    np.cumsum(held[twice]) - held[twice], held[twice]
                )
                less = subset[inner] - own_hashed[begin[inner] + offset]
                keys.append(mixed(less + place[inner]))
                nodes.append(packed[document[inner]])
    if not keys:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(keys).view(np.int64), np.concatenate(nodes)


def indexed(rows: DataFrame, schemes: dict[int, Scheme]) -> DataFrame:
    """(key, node) of all sets; equal sets of a batch once. node is the first digest, its low bits
    replaced by the number of its keys that may be common."""

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        texts = raw_texts(batch.column(1))
        met: set[int] = set()
        for start, end in blocks(texts):
            tokens, sizes = token_sets(texts[start:end])
            node, _ = digests(tokens, sizes)
            fresh = np.ones(len(node), bool)
            for i, value in enumerate(node.tolist()):
                fresh[i] = value not in met
                met.add(value)
            tokens, sizes, node = tokens[np.repeat(fresh, sizes)], sizes[fresh], node[fresh]
            key, packed = index_keys(tokens, sizes, node, schemes)
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(packed)], ["key", "node"])

    return map_batches(rows, work, "key long, node long")


def by_shingle(rows: DataFrame) -> DataFrame:
    """(key, node) of sets with every shingle by itself; node is the first digest."""

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        texts = raw_texts(batch.column(1))
        for start, end in blocks(texts):
            tokens, sizes = token_sets(texts[start:end])
            node, _ = digests(tokens, sizes)
            yield pa.RecordBatch.from_arrays(
                [pa.array(mixed(tokens).view(np.int64)), pa.array(np.repeat(node, sizes))],
                ["key", "node"],
            )

    return map_batches(rows, work, "key long, node long")


def needy(groups: DataFrame) -> DataFrame:
    """(node) of sets with more common keys than they have in reserve."""
    return (
        groups.where(F.col("sets") > COMMON)
        .groupBy("node")
        .count()
        .where(F.col("count") > F.col("node").bitwiseAND((1 << RESERVE_BITS) - 1))
        .select("node")
    )


def allotted(shingles: DataFrame) -> DataFrame:
    """(key, rep, size, place) of the n / 4 + 1 shingles of a set that fewest sets have, out of (key,
    rep, size, sets) of the shared ones; those it shares with nobody come first and are not there.

    All sets have their shingles in the same order. Where two sets meet first, the shingles before
    that place are the one's or the other's alone, so the two places bound their difference."""
    own = Window.partitionBy("rep")
    rank = F.row_number().over(own.orderBy("sets", "key"))
    alone = F.col("size") - F.count("*").over(own)
    ranked = shingles.withColumn("place", rank + alone)
    return ranked.where(F.col("place") <= F.floor(F.col("size") / 4) + 1).select(
        "key", "rep", "size", "place"
    )


def picked(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """Some rows: ids (a written table) are broadcast if they are few enough."""
    few = ids.count() <= PICK_ROWS
    return rows.join(F.broadcast(ids) if few else ids, "row")


def shared_keys(index: DataFrame) -> DataFrame:
    """(key, node, sets) of keys that two or more different sets have."""
    order = Window.partitionBy("key").orderBy("node")
    fresh = F.coalesce(F.lag("node").over(order) != F.col("node"), F.lit(True))
    counted = index.withColumn("fresh", fresh).where("fresh")
    return counted.withColumn("sets", F.count("*").over(Window.partitionBy("key"))).where(
        "sets > 1"
    ).select("key", "node", "sets")


def plausible(pairs: DataFrame, classes: DataFrame, at_least: int) -> DataFrame:
    """The pairs (a, b) of classes' rows that sizes and parities do not rule out."""

    def compared(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        columns = [batch.column(i).to_pylist() for i in range(2, 6)]
        keep = [
            # The union is (x + y + apart) / 2, the intersection (x + y - apart) / 2.
            100 * (x + y - (apart := parity_apart(p, q))) >= at_least * (x + y + apart)
            for x, y, p, q in zip(*columns, strict=True)
        ]
        yield batch.select([0, 1]).filter(pa.array(keep))

    a, b = (
        classes.select(
            F.col("rep").alias(name),
            F.col("n").alias(f"n_{name}"),
            F.col("parity").alias(f"parity_{name}"),
        )
        for name in ("a", "b")
    )
    joined = pairs.join(b, "b").join(a, "a")
    return map_batches(
        joined.select("a", "b", "n_a", "n_b", "parity_a", "parity_b"), compared, "a long, b long"
    )


def verified(pairs: DataFrame, rows: DataFrame, at_least: int) -> DataFrame:
    """The pairs (a, b) of rows whose sets link; pairs come once each."""
    ids = stage(
        pairs.select(F.col("a").alias("row")).unionAll(pairs.select("b")).distinct(), "ids"
    )

    def hashed(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        texts = raw_texts(batch.column(1))
        for start, end in blocks(texts):
            tokens, sizes = token_sets(texts[start:end])
            cut = np.split(tokens, np.cumsum(sizes)[:-1])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).slice(start, end - start),
                    pa.array([x.tobytes() for x in cut], pa.binary()),
                ],
                ["row", "tokens"],
            )

    sets = stage(map_batches(picked(rows, ids), hashed, "row long, tokens binary").distinct(), "sets")

    def compared(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        first, second = batch.column(2).to_pylist(), batch.column(3).to_pylist()
        keep = np.zeros(batch.num_rows, bool)
        for i, (x, y) in enumerate(zip(first, second, strict=True)):
            x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
            if len(x) > len(y):
                x, y = y, x
            if not len(x):
                continue
            at = np.minimum(np.searchsorted(y, x), len(y) - 1)
            common = int(np.count_nonzero(y[at] == x))
            keep[i] = 100 * common >= at_least * (len(x) + len(y) - common)
        yield batch.select([0, 1]).filter(pa.array(keep))

    a = sets.select(F.col("row").alias("a"), F.col("tokens").alias("tokens_a"))
    b = sets.select(F.col("row").alias("b"), F.col("tokens").alias("tokens_b"))
    joined = pairs.join(b, "b").join(a, "a").select("a", "b", "tokens_a", "tokens_b")
    return map_batches(joined, compared, "a long, b long")


def linked(rows: DataFrame, at_least: int = 75) -> DataFrame:
    """(row, doc_id, n, component, least) of all rows (row, text, doc_id): the component of the row's
    class and its smallest doc_id. row tells rows apart, and a row without shingles is a component.

    at_least is the similarity in hundredths, from 75 (for which the bounds are made) to 100."""
    if not 75 <= at_least <= 100:
        raise ValueError("at_least must be from 75 to 100")
    sets = stage(described(rows), "sets")
    schemes = allocated(sets)
    classes = stage(
        sets.where("n > 0")
        .groupBy("n", "d1", "d2")
        .agg(
            F.min("row").alias("rep"),
            F.min("doc_id").alias("doc"),
            F.min("parity").alias("parity"),
            *[F.min(name).alias(name) for name in SHORT],
        ),
        "classes",
    )
    known = classes.select(
        F.shiftright("d1", RESERVE_BITS).alias("digest"), "rep", F.col("n").alias("size")
    )
    groups = stage(shared_keys(indexed(rows, schemes)), "groups")
    digest = F.shiftright("node", RESERVE_BITS).alias("digest")
    again = needy(groups).select(digest).join(known, "digest").select(F.col("rep").alias("row"))
    again = stage(again.distinct(), "needy")
    shingles = shared_keys(by_shingle(picked(rows, again))).select("key", digest, "sets")
    members = (
        groups.where(F.col("sets") <= COMMON)
        .select("key", digest)
        .join(known, "digest")
        .select("key", "rep", "size", F.lit(1).cast("long").alias("place"))
        .unionAll(allotted(shingles.join(known, "digest").drop("digest").distinct()))
        .distinct()
    )
    members = stage(members, "members")
    by_key = Window.partitionBy("key")
    tried = labels = None
    for turn in range(ROUNDS + 1):
        placed = members.withColumn("component", F.col("rep"))
        if labels is not None:
            placed = members.join(labels, members["rep"] == labels["node"], "left").select(
                "key", "rep", "size", "place", F.coalesce("component", "rep").alias("component")
            )
        several = placed.withColumn("low", F.min("component").over(by_key)).withColumn(
            "high", F.max("component").over(by_key)
        )
        several = several.where("low != high").select("key", "rep", "size", "place", "component")
        if turn < ROUNDS:
            # First the same leader wherever it can be, then another in each key.
            chosen = F.xxhash64("rep", "key", F.lit(turn)) if turn else F.col("rep")
            order = F.struct(chosen.alias("_"), "rep", "size", "place", "component")
            columns = ["rep", "size", "place", "component"]
            pairs = several.withColumn("l", F.min(order).over(by_key)).select(*columns, "l.*")
            pairs = pairs.toDF(*columns, "_", *[f"x_{c}" for c in columns])
        else:
            # All conditions are part of the join, so pairs that they rule out are never made.
            several = several.join(classes.select("rep", *SHORT), "rep").select(
                "key", "rep", "size", "place", "component", *SHORT
            )
            several = stage(several, "several")
            x = several.toDF("key", *[f"x_{c}" for c in several.columns[1:]])
            pairs = several.join(x, "key").where("rep < x_rep").where(_not_apart(at_least))
        pairs = (
            pairs.where("component != x_component")
            .where(_near_size("size", "x_size"))
            .where("7 * (place + x_place - 2) <= size + x_size")
            .select(F.least("rep", "x_rep").alias("a"), F.greatest("rep", "x_rep").alias("b"))
            .distinct()
        )
        if tried is not None:
            pairs = pairs.join(tried, ["a", "b"], "left_anti")
        pairs = stage(pairs, "pairs")
        tried = pairs if tried is None else tried.unionAll(pairs)
        likely = stage(plausible(pairs, classes, at_least), "likely")
        new = stage(verified(likely, rows, at_least), "links")
        if labels is None or new.limit(1).count():
            labels = with_edges(labels, new)
    own = labels.join(classes.select(F.col("rep").alias("node"), "doc"), "node")
    least = own.groupBy("component").agg(F.min("doc").alias("least"))
    named = labels.join(least, "component").select("node", "component", "least")
    found = sets.select("row", "doc_id", "n", "d1", "d2").join(
        classes.drop("parity", *SHORT), ["n", "d1", "d2"], "left"
    )
    return found.join(named, found["rep"] == named["node"], "left").select(
        "row",
        "doc_id",
        "n",
        F.coalesce("component", "rep", "row").alias("component"),
        F.coalesce("least", "doc", "doc_id").alias("least"),
    )


def join_near(docs: DataFrame, at_least: int = 75) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every document; doc_id and component_id may be NO_ID.

    at_least is as in `linked`."""
    rows = identified(docs).select(F.xxhash64("doc_id", "text").alias("row"), "text", "doc_id")
    found = stage(linked(rows, at_least), "linked")
    # Components that a repeated doc_id unites; those of a null one have the same least already.
    repeated = stage(
        found.where(F.col("doc_id") != NO_ID)
        .groupBy("doc_id")
        .agg(F.min("component").alias("a"), F.max("component").alias("z"))
        .where("a != z")
        .drop("z"),
        "repeated",
    )
    if repeated.limit(1).count():
        meet = found.join(repeated, "doc_id").where(F.col("component") != F.col("a"))
        united = components(meet.select("a", F.col("component").alias("b")).distinct())
        known = found.groupBy("component").agg(F.min("least").alias("least"))
        known = known.join(united.toDF("component", "whole"), "component")
        least = known.groupBy("whole").agg(F.min("least").alias("smallest"))
        least = known.join(least, "whole").select("component", "smallest")
        found = found.join(least, "component", "left").withColumn(
            "least", F.coalesce("smallest", "least")
        )
    return found.select(
        "doc_id", F.col("n").alias("n_shingles"), F.col("least").alias("component_id")
    )


def _near_size(a: str, b: str):
    low, high = F.least(F.col(a), F.col(b)), F.greatest(F.col(a), F.col(b))
    return 3 * high <= 4 * low


def one_of_each(docs: DataFrame) -> DataFrame:
    """documents less all but one row of each component: the one of the smallest doc_id, and of rows
    that repeat it the one of the least hash of its columns. Unlinked texts stay, whatever their
    doc_id, and so do all rows without shingles."""
    source = document_columns(docs)
    doc_id = F.coalesce("doc_id", F.lit(NO_ID)).alias("doc_id")
    others = [F.col(c).isNull() for c in source.columns]
    source = source.withColumn("row", F.xxhash64(*source.columns, *others))
    found = linked(source.select("row", "text", doc_id))
    kept = (
        found.where("n > 0")
        .groupBy("component", "doc_id", "row")
        .agg(F.count("*").alias("copies"))
        .groupBy("component")
        .agg(F.min(F.struct("doc_id", "row", "copies")).alias("_"))
        .select("_.row", "_.copies")
    )
    kept = stage(kept, "kept")
    # Only of rows that are equal in all columns is one to be chosen by shuffle.
    single, several = (kept.where(c).select("row") for c in ("copies = 1", "copies > 1"))
    blank = source.where(~F.coalesce(F.col("text").rlike(r"[^ \t\n\x0B\f\r]"), F.lit(False)))
    stays = picked(source, single).unionByName(blank)
    if several.limit(1).count():
        stays = stays.unionByName(picked(source, several).dropDuplicates(["row"]))
    return stays.drop("row")


def query(spark: SparkSession, folder: str) -> DataFrame:
    """op10: every document's component."""
    found = join_near(table(spark, folder, "documents"))
    return found.select(real_id(), "n_shingles", real_id("component_id"))


ORACLE = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + 4], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i
        FROM words WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * common >= 75 * (x.n + y.n - common)),
reached AS (
  SELECT doc_id AS start_id, doc_id AS end_id FROM sizes
  UNION SELECT start_id, b FROM reached JOIN links ON end_id = a)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles,
  coalesce(c.component_id, d.doc_id) AS component_id
FROM documents d LEFT JOIN sizes USING (doc_id)
LEFT JOIN (SELECT start_id AS doc_id, min(end_id) AS component_id FROM reached GROUP BY start_id) c
  USING (doc_id)
"""
