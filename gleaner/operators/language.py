"""Language detection by n-gram profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import ngrams as G
from ..functions.text import run_lengths
from ..workspace import stage
from .joins import Dictionary, lookup
from .scoring import (
    ScoreTable, best_class, block_of, block_width, class_index, class_parts, in_slots, line, slots,
)

# Fixed value: added to every n-gram frequency before the logarithm.
SMOOTHING = 0.5 / 10_000
#: Share of the texts whose frequent words are scored whole, and how many rows these may take.
WORD_SAMPLE = 0.05
WORDS = 200_000


def build_profiles(texts: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """Profiles (lang, ngram, cnt, n_words) from labelled text.

    Words are counted per language first, so n-grams are only made of distinct words; the counts
    combine before the shuffle. They are staged, since the totals per n-gram length read them again.
    """
    words = (
        texts.select(F.col(lang).alias("lang"), F.explode(G.language_words(F.col(text))).alias("token"))
        .groupBy("lang", "token")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    windows = words.select("lang", "n", F.explode(G.word_windows(F.col("token"))).alias("_w"))
    counted = (
        windows.select("lang", "n", F.explode(G.window_ngrams(F.col("_w"))).alias("ngram"))
        .where(F.col("ngram").isNotNull())
        .groupBy("lang", "ngram")
        .agg(F.sum("n").alias("cnt"))
    )
    counts = stage(counted, "profiles")
    per_n = (
        counts.groupBy("lang")
        .agg(
            *[
                F.coalesce(F.sum(F.when(F.length("ngram") == n, F.col("cnt"))), F.lit(0)).alias(
                    f"_n{n}"
                )
                for n in range(1, G.MAX_N + 1)
            ]
        )
        .select("lang", F.array(*[f"_n{n}" for n in range(1, G.MAX_N + 1)]).alias("n_words"))
    )
    return counts.join(per_n, "lang").select("lang", "ngram", "cnt", "n_words")


def profile_table(profiles: DataFrame) -> ScoreTable:
    """Log frequencies of n-grams by language, above that of an n-gram the language lacks.

    That one is the same for all languages, so nothing is to be added for a document's total.
    """
    classes = stage(class_index(profiles, "lang"), "languages")
    width = block_width(classes)
    above = F.log(F.sum(F.col("cnt") / F.col("all")) + F.lit(SMOOTHING)) - F.log(F.lit(SMOOTHING))
    logs = (
        profiles.where(F.length("ngram").between(1, G.MAX_N))
        .withColumnsRenamed({"lang": "klass", "ngram": "term"})
        .withColumn("all", F.get("n_words", F.length("term") - 1))
        .join(classes, "klass")
        .groupBy("term", "class_idx")
        .agg(above.alias("above"))
    )
    table = logs.groupBy("term", block_of(width).alias("block")).agg(
        *in_slots(F.col("above"), width, F.max)
    )
    lines = classes.agg(line(F.col("klass"), F.lit(0.0), F.lit(0.0)))
    return ScoreTable(Dictionary(table), ["term"], Dictionary(lines), width)


def _ngram_rows(words: DataFrame, columns: list[str]) -> DataFrame:
    """(columns, term) of the n-grams of (columns, token)."""
    windows = words.select(*columns, F.explode(G.word_windows(F.col("token"))).alias("_w"))
    grams = windows.select(*columns, F.explode(G.window_ngrams(F.col("_w"))).alias("term"))
    return grams.where(F.col("term").isNotNull())


def word_scores(docs: DataFrame, text: str, table: ScoreTable) -> Dictionary | None:
    """(token, block, s0 …): the sums of whole words that are frequent in a share of the texts.

    Which words are in it changes how much work detection is, not what it finds. It holds at most
    WORDS rows; null if the n-grams themselves cannot be broadcast.
    """
    if not table.table.small:
        return None
    blocks = table.table.select("block").distinct().count()
    some = docs.select(text).sample(WORD_SAMPLE, seed=0)
    seen = some.select(F.explode(G.language_words(F.col(text))).alias("token"))
    common = (
        seen.groupBy("token").agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), "token").limit(max(1, WORDS // max(1, blocks))).select("token")
    )
    sums = [F.sum(s).alias(s) for s in slots(table.width)]
    grams = lookup(_ngram_rows(common, ["token"]), table.table.df, ["term"], small=True)
    return Dictionary(grams.groupBy("token", "block").agg(*sums))


def detect_language(
    docs: DataFrame,
    table: ScoreTable,
    key: list[str],
    text: str = "text",
    copies: DataFrame | None = None,
) -> DataFrame:
    """(key, copies, lang) per distinct key; lang is null without any known n-gram.

    Rows with the same key must hold the same text. copies (key, copies) counts the rows of a key;
    it is counted here when not given. A frequent word is looked up whole, with the sum of its
    n-grams, wherever it stands: that costs less than to count the words of a row first. Only the
    others are taken apart. Without frequent words, all are, and are counted first.
    """
    if copies is None:
        copies = docs.groupBy(*key).agg(F.count(F.lit(1)).alias("copies"))
    found = G.language_words(F.col(text))
    whole = word_scores(docs, text, table)
    if whole is None or not whole.small:
        words = docs.select(*key, F.inline(run_lengths(found))).withColumnRenamed("n", "weight")
        weighted = _ngram_rows(words, [*key, "weight"])
        met = lookup(weighted, table.table.df, table.on, small=table.table.small)
        parts = class_parts(met, key, table.width)
        return best_class(parts, key, copies, table).withColumnRenamed("best", "lang")
    names = slots(table.width)
    words = docs.select(*key, F.explode(found).alias("token"))
    known = words.join(F.broadcast(whole.df), "token", "left")
    columns = [*key, "block", *names]
    windows = F.when(F.col("block").isNull(), G.word_windows(F.col("token")))
    cut = known.select(*columns, F.explode_outer(windows).alias("_w"))
    grams = F.when(F.col("_w").isNotNull(), G.window_ngrams(F.col("_w")))
    terms = cut.select(*columns, F.explode_outer(grams).alias("term"))
    single = table.table.df.withColumnsRenamed({c: f"_{c}" for c in ("block", *names)})
    both = terms.join(F.broadcast(single), "term", "left").select(
        *key, F.lit(1.0).alias("weight"), *[F.coalesce(c, f"_{c}").alias(c) for c in ("block", *names)]
    )
    parts = class_parts(both.where(F.col("block").isNotNull()), key, table.width)
    return best_class(parts, key, copies, table).withColumnRenamed("best", "lang")


def language_counts(detected: DataFrame) -> DataFrame:
    """Documents per detected language."""
    return (
        detected.where(F.col("lang").isNotNull())
        .groupBy("lang")
        .agg(F.sum("copies").alias("n"))
    )
