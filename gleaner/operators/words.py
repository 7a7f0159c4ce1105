"""Token counts, bags of words and stop words."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as X
from .joins import Dictionary, lookup

# Stop words up to this many are put into the expression as a hash set.
INLINE_WORDS = 20_000


class StopWords:
    """A stop list; inlined when its measured size allows, otherwise applied as an anti-join."""

    def __init__(self, words: DataFrame, inline_limit: int = INLINE_WORDS):
        self.table = Dictionary(words.select("word").where("word is not null").distinct())
        self.inline = self.table.rows <= inline_limit
        self.words = (
            sorted(r["word"] for r in self.table.df.collect()) if self.inline else None
        )


def drop_stop_words(df: DataFrame, column: str, stop: StopWords, key: list[str]) -> DataFrame:
    """Remove stop words from an ordered token array, keeping order and empty rows.

    `key` identifies equal rows; it is used only when the stop list is too long to inline.
    """
    if stop.inline:
        return df.withColumn(column, X.without_words(F.col(column), stop.words))
    digest = F.sha2(F.to_json(F.struct(*key, column)), 256)
    keyed = df.withColumn("_row", digest)
    words = keyed.select("_row", column).distinct().select(
        "_row", F.posexplode(column).alias("_pos", "word")
    )
    kept = (
        lookup(words, stop.table.df, ["word"], "left_anti", small=stop.table.small)
        .groupBy("_row")
        .agg(F.sort_array(F.collect_list(F.struct("_pos", "word"))).alias("_kept"))
    )
    rest = F.coalesce(F.col("_kept.word"), F.array().cast("array<string>"))
    return (
        keyed.drop(column)
        .join(kept, "_row", "left")
        .withColumn(column, rest)
        .drop("_row", "_kept")
        .select(*df.columns)
    )


def with_token_counts(
    df: DataFrame, text: str, stop: StopWords, key: list[str], out: str = "counts"
) -> DataFrame:
    """Add the multiset of cleaned tokens as ARRAY<STRUCT<token, n>>, counted inside each row."""
    tokens = df.withColumn("_tokens", X.clean_tokens(F.col(text)))
    kept = drop_stop_words(tokens, "_tokens", stop, key)
    return kept.withColumn(out, X.run_lengths(F.col("_tokens"))).drop("_tokens")


def with_bag(df: DataFrame, text: str, stop: StopWords, key: list[str]) -> DataFrame:
    """Add the bag-of-words string; a text without tokens has an empty one."""
    counted = with_token_counts(df, text, stop, key, "_counts")
    return counted.withColumn("bag", X.bag_string(F.col("_counts"))).drop("_counts")


def token_rows(df: DataFrame, counts: str = "counts") -> DataFrame:
    """One row per (document, token).

    The outer form, with its empty rows removed after it, keeps the optimiser from adding a filter
    on the array's size, which would count the tokens a second time.
    """
    others = [c for c in df.columns if c != counts]
    return df.select(*others, F.inline_outer(counts)).where(F.col("token").isNotNull())


def longest_bag(df: DataFrame) -> DataFrame:
    """Per URL the bag with the most bytes, and how many bags there were.

    Ties go to the greater bag, then the greater domain. The maximum combines on the map side, so
    a URL with very many rows sends one row per task through the shuffle.
    """
    return _longest(df, F.count(F.lit(1)))


def merged_bags(df: DataFrame) -> DataFrame:
    """The same of rows (url, domain, bag, occurrences) that are themselves longest bags."""
    return _longest(df, F.sum("occurrences"))


def _longest(df: DataFrame, occurrences: Column) -> DataFrame:
    candidate = F.struct(F.octet_length("bag").alias("size"), F.col("bag"), F.col("domain"))
    return (
        df.groupBy("url")
        .agg(F.max(candidate).alias("_best"), occurrences.alias("occurrences"))
        .select("url", F.col("_best.domain").alias("domain"), F.col("_best.bag").alias("bag"),
                "occurrences")
    )
