"""Text harvest: pages (url, text) to one bag of words per URL, and language counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.domains import URL_OK, SuffixRules, with_url_outcome
from ..operators.histograms import count_bucket
from ..operators.joins import Dictionary, lookup, semi_join_hot
from ..operators.language import detect_language, language_counts
from ..operators.scoring import ScoreTable
from ..operators.words import StopWords, longest_bag, with_bag
from ..sinks import bag_line, language_line, write_lines
from ..workspace import stage

LANGUAGE = "en"


def whitelisted(pages: DataFrame, whitelist: Dictionary, rules: SuffixRules) -> DataFrame:
    """Pages whose registrable domain is on the whitelist, with that domain."""
    resolved = with_url_outcome(pages, rules, check_prefix=False)
    return lookup(
        resolved, whitelist.df, ["domain"], "left_semi", small=whitelist.small
    ).select(*pages.columns, "domain")


def page_bags(
    pages: DataFrame, whitelist: Dictionary, rules: SuffixRules, stop: StopWords
) -> DataFrame:
    """(…, domain, bag) of whitelisted pages, counted inside each row; the text is dropped."""
    kept = whitelisted(pages, whitelist, rules)
    return with_bag(kept, "text", stop, ["url", "domain"]).drop("text")


def with_text_key(pages: DataFrame) -> DataFrame:
    return pages.withColumn("text_key", F.coalesce(F.md5("text"), F.lit("")))


def prepared_pages(
    pages: DataFrame, whitelist: Dictionary, rules: SuffixRules, stop: StopWords
) -> DataFrame:
    """(url, text_key, url_outcome, domain, bag) of every page: all that is needed of its text but
    its language. The bag is counted inside the row, for whitelisted pages only (else null)."""
    resolved = with_url_outcome(with_text_key(pages), rules, check_prefix=False)
    flagged = whitelist.df.select("domain").distinct().withColumn("_wanted", F.lit(True))
    found = lookup(
        resolved, flagged, ["domain"], "left", small=whitelist.small, payload=["text"]
    )
    kept = found.withColumn("text", F.when(F.col("_wanted"), F.col("text")))
    bags = with_bag(kept, "text", stop, ["url", "domain"])
    bag = F.when(F.col("_wanted"), F.coalesce("bag", F.lit("")))
    return bags.select("url", "text_key", "url_outcome", "domain", bag.alias("bag"))


def detect_pages(
    pages: DataFrame, profiles: ScoreTable, copies: DataFrame | None = None
) -> DataFrame:
    """(text_key, copies, lang) per distinct text."""
    keyed = with_text_key(pages).select("text_key", "text")
    return detect_language(keyed, profiles, ["text_key"], copies=copies)


def harvest_prepared(prepared: DataFrame, detected: DataFrame, language: str = LANGUAGE) -> DataFrame:
    """(url, domain, bag, occurrences): the longest bag of each URL in the wanted language.

    Only bags of whitelisted pages are shuffled, never raw text; of the detected texts only those of
    whitelisted pages meet them. A text copied very often is a hot key, and is spread by its count.
    Both tables are read several times and should be written ones.
    """
    bags = prepared.where(F.col("bag").isNotNull()).select("url", "text_key", "domain", "bag")
    counted = bags.groupBy("text_key").agg(F.count(F.lit(1)).alias("n"))
    wanted = (
        detected.where(F.col("lang") == language)
        .select("text_key")
        .join(counted.select("text_key"), "text_key", "left_semi")
    )
    return longest_bag(semi_join_hot(bags, wanted, "text_key", counted))


def harvest_texts(
    pages: DataFrame,
    detected: DataFrame,
    whitelist: Dictionary,
    rules: SuffixRules,
    stop: StopWords,
    language: str = LANGUAGE,
) -> DataFrame:
    """The longest bags of pages (url, text), whose text is read once."""
    prepared = stage(prepared_pages(pages, whitelist, rules, stop), "prepared")
    return harvest_prepared(prepared, detected, language)


def harvest_labelled_texts(
    pages: DataFrame,
    whitelist: Dictionary,
    rules: SuffixRules,
    stop: StopWords,
    language: str = LANGUAGE,
) -> DataFrame:
    """The same for pages that carry a known `lang`."""
    wanted = pages.where(F.col("lang") == language).select("url", "text")
    return longest_bag(page_bags(wanted, whitelist, rules, stop))


def _named(df: DataFrame, grp: str, name: Column) -> DataFrame:
    return df.select(F.lit(grp).alias("grp"), name.alias("name"), "n")


def harvest_counts(harvested: DataFrame) -> DataFrame:
    """(grp, name, n) of the longest bags: how many, and of URLs that occurred how often."""
    success = harvested.agg(F.count(F.lit(1)).alias("n"))
    buckets = harvested.groupBy(count_bucket(F.col("occurrences")).alias("name")).agg(
        F.count(F.lit(1)).alias("n")
    )
    return (
        _named(success, "parse", F.lit("SUCCESS"))
        .unionByName(_named(buckets, "url_occurrence", F.col("name")))
        .where(F.col("n") > 0)
    )


def text_statistics(
    prepared: DataFrame, detected: DataFrame, harvested: DataFrame, language: str = LANGUAGE
) -> DataFrame:
    """(grp, name, n). URL errors count for pages of the wanted language only."""
    undetected = detected.where(F.col("lang").isNull()).agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("n")
    )
    failed = (
        prepared.where(F.col("url_outcome") != URL_OK)
        .groupBy("text_key", "url_outcome")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    wanted = detected.where(F.col("lang") == language).select("text_key")
    errors = (
        failed.join(wanted, "text_key", "left_semi")
        .groupBy(F.col("url_outcome").alias("name"))
        .agg(F.sum("n").alias("n"))
    )
    return (
        _named(undetected, "parse", F.lit("ERR_LANG_DETECT"))
        .unionByName(_named(errors, "parse", F.col("name")))
        .where(F.col("n") > 0)
        .unionByName(harvest_counts(harvested))
    )


def run_text_harvest(
    spark: SparkSession,
    pages: DataFrame,
    profiles: ScoreTable,
    whitelist: Dictionary,
    rules: SuffixRules,
    stop: StopWords,
    out: str,
    language: str = LANGUAGE,
) -> dict[str, str]:
    """Write bags, language counts and statistics. The text is read twice: for all that its row
    alone gives, and for its language. Both results are written, and the outputs read those."""
    names = ("prepared", "detected", "bags", "bags_tsv", "languages", "languages_tsv", "statistics")
    paths = {name: f"{out}/{name}" for name in names}
    prepared_pages(pages, whitelist, rules, stop).write.parquet(paths["prepared"])
    prepared = spark.read.parquet(paths["prepared"])
    copies = prepared.groupBy("text_key").agg(F.count(F.lit(1)).alias("copies"))
    detect_pages(pages, profiles, copies).write.parquet(paths["detected"])
    detected = spark.read.parquet(paths["detected"])
    harvest_prepared(prepared, detected, language).write.parquet(paths["bags"])
    bags = spark.read.parquet(paths["bags"])
    write_lines(bag_line(bags), paths["bags_tsv"])
    counts = language_counts(detected)
    counts.write.parquet(paths["languages"])
    write_lines(language_line(counts), paths["languages_tsv"])
    text_statistics(prepared, detected, bags, language).write.parquet(paths["statistics"])
    return paths
