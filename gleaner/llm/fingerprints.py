"""Document fingerprints: bottom-k sketches of word shingles, in built-in functions only.

A text's shingles are its runs of five words (split at ASCII white space; a shorter text is one
shingle, an empty one has none). A sketch holds the K smallest distinct 48-bit hashes of them,
ascending. Sketches of parts merge into the sketch of the whole; two sketches estimate resemblance,
containment and the numbers of distinct shingles, exactly so up to K shingles.

Defined results: null is an empty text with an empty sketch; two empty sketches resemble each other
by 1, an empty and another one by 0; a null doc_id counts as the smallest; rows that repeat a doc_id
each get their own row, and their text of the greatest hash stands for them as somebody's next
document; further columns are ignored; an empty table has no rows.

Scale: whole texts are shuffled once by doc_id (both joins reuse that exchange) and half of them,
as prefixes, a second time. The order of documents is found on the ids alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import identified, real_id, stage, table

K = 128
SHINGLE = 5
_SPACE = "[\\x20\\x09-\\x0D]+"
_HASHES = float(1 << 48)


def let(value: Column, body) -> Column:
    """body of a value that is evaluated once, whatever the optimiser does."""
    return F.element_at(F.transform(F.array(value), body), 1)


def sketch(text: Column, k: int = K, width: int = SHINGLE) -> Column:
    """ARRAY<BIGINT>: the text's k smallest distinct shingle hashes, ascending."""

    def hashed(words: Column) -> Column:
        last = F.size(words) - width
        shingles = F.transform(
            F.sequence(F.lit(0), F.greatest(last, F.lit(0))),
            lambda i: F.shiftrightunsigned(
                F.xxhash64(*[F.get(words, i + place) for place in range(width)]), 16
            ),
        )
        return F.slice(F.sort_array(F.array_distinct(shingles)), 1, k)

    words = F.array_remove(F.split(F.coalesce(text, F.lit("")), _SPACE), "")
    empty = F.array().cast("array<bigint>")
    return let(words, lambda w: F.when(F.size(w) == 0, empty).otherwise(hashed(w)))


def merge(a: Column, b: Column, k: int = K) -> Column:
    """The sketch of what either of two sketches stands for."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of common shingles among all of both."""

    def shared(both: Column) -> Column:
        common = F.size(F.array_intersect(F.array_intersect(both, a), b))
        return F.when(F.size(both) == 0, 1.0).otherwise(common / F.size(both))

    return let(merge(a, b, k), shared)


def distinct_shingles(a: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles; exact below k."""
    estimate = (k - 1) * F.lit(_HASHES) / (F.element_at(a, -1) + 1)
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise(estimate)


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of a's shingles that b has too."""
    alike = resemblance(a, b, k)
    size_a, size_b = distinct_shingles(a, k), distinct_shingles(b, k)
    common = alike / (alike + 1.0) * (size_a + size_b)
    return F.when(F.size(a) == 0, 1.0).otherwise(F.least(F.lit(1.0), common / size_a))


def merged_by(df: DataFrame, keys: list[str], column: str, k: int = K) -> DataFrame:
    """One sketch for each key, out of any number of sketches.

    Every task keeps the k smallest hashes of a key before the shuffle, so a hot key stays small.
    """
    order = Window.partitionBy(*keys).orderBy("_hash")
    hashes = df.select(*keys, F.explode(column).alias("_hash"))
    least = hashes.withColumn("_rank", F.dense_rank().over(order)).where(F.col("_rank") <= k)
    merged = least.groupBy(*keys).agg(F.sort_array(F.collect_set("_hash")).alias(column))
    empty = df.select(*keys).distinct()
    return empty.join(merged, keys, "left").select(
        *keys, F.coalesce(column, F.array().cast("array<bigint>")).alias(column)
    )


def as_text(a: Column) -> Column:
    """A sketch as a string: twelve hexadecimal digits for each hash."""
    return F.array_join(F.transform(a, lambda h: F.lpad(F.lower(F.hex(h)), 12, "0")), "")


def fingerprints(docs: DataFrame, k: int = K) -> DataFrame:
    """(doc_id, sketch) of every whole text."""
    return docs.select(F.col("doc_id").cast("long"), sketch(F.col("text"), k).alias("sketch"))


def followers(docs: DataFrame) -> DataFrame:
    """(doc_id, next_id, half): each distinct id's next smaller one; the smallest has the greatest.

    half is half the length of the id's text (the longest of several). Ids are put into ranges; only
    the ranges' first ids, at most one for each shuffle partition, meet in one task.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    sized = docs.groupBy("doc_id").agg(
        F.max(F.floor(F.char_length(F.coalesce("text", F.lit(""))) / 2)).cast("int").alias("half")
    )
    ranged = sized.repartitionByRange(parts, F.desc("doc_id")).withColumn(
        "part", F.spark_partition_id()
    )
    ranged = stage(ranged, "followers")
    firsts = ranged.groupBy("part").agg(F.max("doc_id").alias("first_id"))
    everything = Window.partitionBy(F.lit(0))
    firsts = firsts.select(
        "part",
        F.coalesce(
            F.lead("first_id").over(everything.orderBy("part")),
            F.max("first_id").over(everything),
        ).alias("after_id"),
    )
    within = Window.partitionBy("part").orderBy(F.desc("doc_id"))
    return (
        ranged.withColumn("next_id", F.lead("doc_id").over(within))
        .join(F.broadcast(firsts), "part")
        .select("doc_id", F.coalesce("next_id", "after_id").alias("next_id"), "half")
    )


def with_next(docs: DataFrame, k: int = K) -> DataFrame:
    """(doc_id, text, next_text, next_sketch): next_text is as much of the next document's text as
    may be needed to replace the second half of this one's."""
    rows = identified(docs)
    links = stage(followers(rows), "links")
    wanted = links.select(F.col("next_id").alias("doc_id"), F.col("doc_id").alias("for_id"), "half")
    heads = (
        rows.join(wanted.hint("shuffle_hash"), "doc_id")
        .select(
            "for_id",
            F.xxhash64("text").alias("order"),
            F.substring(F.coalesce("text", F.lit("")), F.lit(1), F.col("half")).alias("head"),
            sketch(F.col("text"), k).alias("head_sketch"),
        )
        .groupBy("for_id")
        .agg(F.max_by(F.struct("head", "head_sketch"), "order").alias("next"))
    )
    return rows.join(heads, rows["doc_id"] == heads["for_id"], "left").select(
        rows["doc_id"],
        F.coalesce("text", F.lit("")).alias("text"),
        F.coalesce("next.head", F.lit("")).alias("next_text"),
        F.col("next.head_sketch").alias("next_sketch"),
    )


def query(spark: SparkSession, folder: str) -> DataFrame:
    """op3: sketches of every text, of its edited text, and their likeness."""
    rows = with_next(table(spark, folder, "documents"))
    size = F.char_length("text")
    half = F.floor(size / 2).cast("int")
    edited = F.concat(
        F.substring("text", F.lit(1), size - half), F.substring("next_text", F.lit(1), half)
    )
    made = F.struct(
        sketch(F.col("text")).alias("own"),
        sketch(edited).alias("edited"),
        F.sha2(edited, 256).alias("sha"),
    )
    # One struct, evaluated once for the columns below.
    rows = rows.select(
        "doc_id",
        size.cast("long").alias("n_chars"),
        let(
            made,
            lambda m: F.struct(
                m["sha"].alias("edited_sha256"),
                as_text(m["own"]).alias("fingerprint"),
                as_text(m["edited"]).alias("edited_fingerprint"),
                resemblance(m["own"], m["edited"]).alias("near_edited"),
                resemblance(m["own"], F.col("next_sketch")).alias("near_next"),
                distinct_shingles(m["own"]).alias("distinct_shingles"),
            ),
        ).alias("found"),
    )
    return rows.select(real_id(), "n_chars", "found.*")
