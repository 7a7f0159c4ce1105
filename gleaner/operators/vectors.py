"""Vocabulary selection and TF-IDF weights."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import run_lengths
from ..workspace import stage
from .joins import Dictionary, lookup

# The vocabulary sizes trained by default.
VOCABULARY_SIZES = (1500, 3000, 5000, 7500, 10000)


def with_terms(training: DataFrame, tokens: str = "tokens") -> DataFrame:
    """Replace the token string by ARRAY<STRUCT<token, n>>."""
    return training.withColumn("terms", run_lengths(F.split(F.col(tokens), " "))).drop(tokens)


def row_id(columns: list[str]) -> Column:
    """The same for equal rows, copies: two hashes of 64 bits each, which tell nulls apart."""
    values = [*columns, *[F.col(c).isNull() for c in columns]]
    return F.struct(*[F.xxhash64(F.lit(i), *values).alias(f"h{i}") for i in range(2)])


def term_counts(instances: DataFrame) -> DataFrame:
    """(term, total, df): occurrences and instances per term.

    Terms are already counted within an instance, so its rows are distinct and the document
    frequency is a plain count.
    """
    return (
        instances.select(F.inline("terms"))
        .groupBy(F.col("token").alias("term"))
        .agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("df"))
    )


@dataclass
class TermCounts:
    """Term counts (term, total, df) of a corpus and its number of instances."""

    terms: DataFrame
    instances: int


def count_terms(instances: DataFrame) -> TermCounts:
    """Count a corpus once; the counts are staged, as several passes read them."""
    return TermCounts(stage(term_counts(instances), "terms"), instances.count())


def cuts(counts: TermCounts, sizes: tuple[int, ...]) -> list[tuple[int, int, int]]:
    """(size, cut, terms) of each vocabulary size: the least total of a term that is in it, and how
    many terms that makes (ties with the last are in).

    The cut is read off the histogram of totals: few distinct values, whatever the vocabulary.
    """
    histogram = counts.terms.groupBy("total").agg(F.count(F.lit(1)).alias("terms"))
    # As many rows as there are different totals: about the root of twice the corpus's tokens.
    above = F.sum("terms").over(Window.partitionBy(F.lit(0)).orderBy(F.desc("total")))
    reached = stage(histogram.select("total", "terms", above.alias("above")), "cuts")
    found = []
    for size in sizes:
        row = reached.where(F.col("above") - F.col("terms") < size).agg(
            F.min("total").alias("cut"), F.max("above").alias("terms")
        ).first()
        found.append((size, row["cut"] or 0, row["terms"] or 0))
    return found


def top_terms(counts: TermCounts, size: int) -> DataFrame:
    """The `size` most frequent terms and all ties with the last of them."""
    cut = cuts(counts, (size,))[0][1]
    return counts.terms.where(F.col("total") >= F.lit(cut))


def vocabulary(counts: TermCounts, size: int) -> Dictionary:
    """(term, total, df, idf) of the top terms; the unsmoothed idf is ln(instances / df)."""
    idf = F.log(F.lit(float(counts.instances)) / F.col("df"))
    return Dictionary(top_terms(counts, size).withColumn("idf", idf))


def with_sizes(df: DataFrame, sizes: list[tuple[int, int, int]]) -> DataFrame:
    """Rows with a term's total, once for each vocabulary size the term is in: adds size, terms.

    Vocabularies are nested and idf does not depend on them, so all come out of the largest.
    """
    known = F.array(
        *[
            F.struct(F.lit(size).alias("size"), F.lit(cut).alias("cut"), F.lit(n).alias("terms"))
            for size, cut, n in sizes
        ]
    )
    fitting = F.filter(known, lambda s: s["cut"] <= F.col("total"))
    columns = df.columns
    return df.select("*", F.explode(fitting).alias("_s")).select(*columns, "_s.size", "_s.terms")


def tfidf(
    instances: DataFrame,
    vocab: Dictionary,
    normalize: bool = False,
    sizes: list[tuple[int, int, int]] | None = None,
) -> DataFrame:
    """Rows (…, term, weight) with weight ln(1 + tf) · idf, for terms of the vocabulary.

    With normalize, each instance's weights are scaled to the average Euclidean length of all
    instances. Instances equal in all columns are copies: each keeps its own length. Lengths meet the
    instances, a row each, and not their terms. With sizes
    (not together with normalize) rows come once for each vocabulary size, and carry it.
    """
    others = [c for c in instances.columns if c != "terms"]
    if not normalize:
        rows = instances.select(*others, F.inline("terms")).withColumnRenamed("token", "term")
        joined = lookup(rows, vocab.select("term", "idf", "total"), ["term"], small=vocab.small)
        weight = (F.log1p(F.col("n")) * F.col("idf")).alias("weight")
        if sizes is None:
            return joined.select(*others, "term", weight)
        return with_sizes(joined, sizes).select("size", *others, "term", weight)
    keyed = instances.withColumn("_id", row_id(instances.columns))
    copies = keyed.groupBy("_id").agg(F.count(F.lit(1)).alias("copies"))
    squares = tfidf(keyed.select("_id", "terms"), vocab).groupBy("_id").agg(F.sum(F.pow("weight", F.lit(2))).alias("squares"))
    # The squares of copies add up in one key, and are shared out among them.
    length = F.sqrt(F.coalesce(F.col("squares"), F.lit(0.0)) / F.col("copies"))
    lengths = stage(
        copies.join(squares, "_id", "left").select("_id", "copies", length.alias("_len")), "lengths"
    )
    average = lengths.agg((F.sum(F.col("_len") * F.col("copies")) / F.sum("copies")).alias("a"))
    scale = average.first()["a"] or 0.0
    measured = keyed.join(lengths.select("_id", "_len"), "_id").select(*others, "_len", "terms")
    return tfidf(measured, vocab).select(
        *others,
        "term",
        F.when(F.col("_len") > 0, F.col("weight") * scale / F.col("_len"))
        .otherwise(F.col("weight"))
        .alias("weight"),
    )
