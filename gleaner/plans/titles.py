"""Title harvest: pages (url, metadata) to (url, title, keywords, categories) and statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions import metadata as M
from ..functions.text import is_blank
from ..operators.domains import (
    URL_OK,
    SuffixRules,
    with_canonical_host,
    with_url_outcome,
)
from ..operators.histograms import count_bucket, counters, occurrence_histogram
from ..operators.joins import Dictionary, lookup
from ..operators.once import with_once
from ..sinks import write_lines, harvest_line

SUCCESS = "SUCCESS"
# Outcomes decided by the URL and the category index, before any JSON is parsed.
GATE_OUTCOMES = (
    "ERR_URI_MALFORMED",
    "ERR_URI_ILLEGAL",
    "ERR_URI_PARSE",
    "ERR_URI_NO_SUFFIX",
    "PAGE_NO_CATEGORY",
)
# Outcomes that are counted under their own name; the others are counted by
# status class or page type.
PARSE_OUTCOMES = (
    *GATE_OUTCOMES,
    "DATA_NO_JSON",
    "DATA_BAD_JSON",
    "PAGE_NO_TITLE",
    SUCCESS,
)


def with_categories(pages: DataFrame, index: Dictionary, rules: SuffixRules) -> DataFrame:
    """Add the page's categories (null without any) and gate, the outcome so far or null.

    Metadata of pages without categories may become null: nothing reads it.
    """
    hosts = with_canonical_host(with_url_outcome(pages, rules))
    entries = index.df.where(F.size("categories") > 0).select(
        F.col("host").alias("canonical_host"), "categories"
    )
    payload = [c for c in ("metadata",) if c in pages.columns]
    found = lookup(
        hosts, entries, ["canonical_host"], "left", small=index.small, payload=payload
    )
    gate = F.when(F.col("url_outcome") != URL_OK, F.col("url_outcome")).when(
        F.col("categories").isNull(), "PAGE_NO_CATEGORY"
    )
    return found.withColumn("gate", gate)


def with_page(gated: DataFrame) -> DataFrame:
    """Add title, keywords, status class, page type and the final outcome.

    Metadata is parsed once, after the category join, and for rows that passed the gate only.
    """
    json = F.col("metadata")
    wanted = F.when(F.col("gate").isNull() & ~is_blank(json), M.parse_metadata(json))
    parsed = with_once(gated, "_meta", wanted)
    meta = F.col("_meta")
    status, kind = meta["http_result"], meta["content"]["type"]
    outcome = (
        F.when(F.col("gate").isNotNull(), F.col("gate"))
        .when(is_blank(json), "DATA_NO_JSON")
        .when(meta.isNull() | meta[M.BAD].isNotNull(), "DATA_BAD_JSON")
        .when(status.isNull(), "HTTP_UNDEFINED")
        .when(~status.between(200, 299), "HTTP_NOT_2XX")
        .when(kind.isNull() | (kind != M.HTML_TYPE), "PAGE_TYPE")
        .when(M.page_title(meta) == "", "PAGE_NO_TITLE")
        .otherwise(SUCCESS)
    )
    reached_status = ~F.col("outcome").isin(*GATE_OUTCOMES, "DATA_NO_JSON", "DATA_BAD_JSON")
    reached_type = reached_status & ~F.col("outcome").isin("HTTP_UNDEFINED", "HTTP_NOT_2XX")
    return (
        parsed.withColumn("outcome", outcome)
        .withColumn("status_class", F.when(reached_status, M.status_class(status)))
        .withColumn("page_type", F.when(reached_type, F.coalesce(kind, F.lit("undefined"))))
        .withColumn("title", M.page_title(meta))
        .withColumn("keywords", M.page_keywords(meta))
        .drop("_meta", "metadata")
    )


def evaluate_pages(pages: DataFrame, index: Dictionary, rules: SuffixRules) -> DataFrame:
    """Every page with its single terminal outcome."""
    return with_page(with_categories(pages, index, rules))


def harvest_titles(pages: DataFrame, index: Dictionary, rules: SuffixRules) -> DataFrame:
    """(url, title, keywords, categories ARRAY) of the pages that pass everything.

    All narrow: with rules and index broadcast, the job has no shuffle.
    """
    gated = with_categories(pages, index, rules).where(F.col("gate").isNull())
    return harvested_rows(with_page(gated))


def harvested_rows(evaluated: DataFrame) -> DataFrame:
    return evaluated.where(F.col("outcome") == SUCCESS).select(
        "url", "title", "keywords", "categories"
    )


def harvest_tsv(harvested: DataFrame) -> DataFrame:
    """The same rows with categories as one comma-joined string."""
    return harvested.withColumn("categories", F.array_join("categories", ","))


def _counter_pairs() -> list[tuple[str, Column]]:
    outcome = F.col("outcome")
    success = outcome == SUCCESS
    return [
        ("parse", F.when(outcome.isin(*PARSE_OUTCOMES), outcome)),
        ("parse", F.when(success & (F.col("keywords") == ""), F.lit("PAGE_NO_KEYWORDS"))),
        ("http", F.col("status_class")),
        ("page_type", F.col("page_type")),
        ("categories", F.when(success, count_bucket(F.size("categories")))),
    ]


def harvest_statistics(evaluated: DataFrame) -> DataFrame:
    """(grp, name, n): all counters of the run."""
    urls = occurrence_histogram(evaluated.where(F.col("outcome") == SUCCESS))
    return counters(evaluated, _counter_pairs()).unionByName(
        urls.select(F.lit("url_occurrence").alias("grp"), F.col("bucket").alias("name"), "n")
    )


def run_title_harvest(
    spark: SparkSession, pages: DataFrame, index: Dictionary, rules: SuffixRules, out: str
) -> dict[str, str]:
    """Write harvested rows (Parquet and TSV) and statistics, reading the pages once.

    Rows that fail the gate, nearly all of a crawl, are only counted on the way. The rest is
    staged, and every output derives from the staged table.
    """
    gated = with_categories(pages, index, rules)
    seen = Observation("gate")
    counted = gated.observe(
        seen,
        F.count(F.lit(1)).alias("pages"),
        *[F.count(F.when(F.col("gate") == g, 1)).alias(g) for g in GATE_OUTCOMES],
    )
    paths = {name: f"{out}/{name}" for name in ("evaluated", "titles", "titles_tsv", "statistics")}
    with_page(counted.where(F.col("gate").isNull())).drop("gate").write.parquet(paths["evaluated"])
    staged = spark.read.parquet(paths["evaluated"])
    harvested = harvested_rows(staged)
    harvested.write.parquet(paths["titles"])
    write_lines(harvest_line(harvest_tsv(harvested)), paths["titles_tsv"])
    rejected = [("parse", g, seen.get[g]) for g in GATE_OUTCOMES if seen.get[g]]
    gate_counts = spark.createDataFrame(rejected, "grp STRING, name STRING, n BIGINT")
    harvest_statistics(staged).unionByName(gate_counts).coalesce(1).write.parquet(
        paths["statistics"]
    )
    return paths
