"""Stratified train / validate / test split with exact sizes and without sorting the rows.

Rows are ordered within a category by a seeded digest. Only two digests per category matter: the
ones at the ends of the train and validate parts. They are found by a histogram over digest
buckets followed by an exact search inside the one bucket each cut falls into. Every row is then
assigned by comparing its digest with its category's cuts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..workspace import stage
from .joins import Dictionary, lookup

TRAIN_SHARE = 0.8
VALIDATE_SHARE = 0.1
BUCKET_HEX = 4  # 65,536 buckets per category


def per_category(rows: DataFrame, categories: str = "categories") -> DataFrame:
    """One row per (page, category)."""
    return rows.withColumn("category", F.explode(F.split(F.col(categories), ",")))


def category_counts(rows: DataFrame) -> DataFrame:
    return rows.groupBy("category").agg(F.count(F.lit(1)).alias("n"))


def row_digest(seed: str, columns: list[str]) -> Column:
    fields = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]
    return F.md5(F.concat_ws("\t", F.lit(seed), *fields))


def cut_sizes(n: Column) -> tuple[Column, Column]:
    """End positions of the train and validate parts for n rows, as truncated doubles."""
    train = F.floor(n.cast("double") * F.lit(TRAIN_SHARE))
    return train, train + F.floor(n.cast("double") * F.lit(VALIDATE_SHARE))


def _running(partition: list[str], order: str) -> Column:
    window = Window.partitionBy(*partition).orderBy(order)
    return F.sum("n").over(window.rowsBetween(Window.unboundedPreceding, Window.currentRow))


def _find_cuts(keyed: DataFrame) -> DataFrame:
    """(category, digest, n, before, train_end, validate_end) of the rows the cuts fall on.

    `before` is the number of rows of the category ahead of the digest.
    """
    bucket = F.substring("_digest", 1, BUCKET_HEX)
    histogram = keyed.groupBy("category", bucket.alias("_bucket")).agg(
        F.count(F.lit(1)).alias("n")
    )
    # At most 16^BUCKET_HEX rows per category reach this window, whatever the data size.
    total = F.sum("n").over(Window.partitionBy("category"))
    placed = histogram.select(
        "category",
        "_bucket",
        "n",
        total.alias("_total"),
        (_running(["category"], "_bucket") - F.col("n")).alias("_ahead"),
    )
    train_end, validate_end = cut_sizes(F.col("_total"))
    cut_buckets = (
        placed.withColumn("train_end", train_end)
        .withColumn("validate_end", validate_end)
        .where(_holds_cut("train_end") | _holds_cut("validate_end"))
        .drop("n", "_total")
    )
    found = Dictionary(cut_buckets)
    inside = (
        lookup(
            keyed.withColumn("_bucket", bucket),
            found.df,
            ["category", "_bucket"],
            small=found.small,
        )
        .groupBy("category", "_bucket", "_ahead", "train_end", "validate_end", "_digest")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    ahead_inside = _running(["category", "_bucket"], "_digest") - F.col("n")
    return (
        inside.withColumn("_ahead", F.col("_ahead") + ahead_inside)
        .where(_holds_cut("train_end") | _holds_cut("validate_end"))
        .select("category", "_digest", "n", "_ahead", "train_end", "validate_end")
    )


def _holds_cut(end: str) -> Column:
    """The first row after the cut lies in this group (cuts at the very end lie in none)."""
    return (F.col("_ahead") <= F.col(end)) & (F.col(end) < F.col("_ahead") + F.col("n"))


def stratified_split(
    rows: DataFrame, seed: str = "0", columns: tuple[str, ...] = ("url", "title", "keywords")
) -> DataFrame:
    """Add category and split: per category the first 80 % train, the next 10 % validate.

    The rows are read four times but never shuffled or sorted as a whole, so pass a written table
    rather than a long computation. A row with several categories is placed once per category. `columns` and the categories make
    up the digest; rows equal in all of them are interchangeable, and when a cut falls among
    such copies, their numbers on either side are exact.
    """
    keyed = per_category(rows).withColumn("_digest", row_digest(seed, [*columns, "categories"]))
    cuts = Dictionary(_find_cuts(keyed))
    # Train and validate can end on the same digest, so a category has one or two cut rows.
    bounds = cuts.df.groupBy("category").agg(
        F.min(F.when(_holds_cut("train_end"), F.col("_digest"))).alias("_train_cut"),
        F.min(F.when(_holds_cut("validate_end"), F.col("_digest"))).alias("_validate_cut"),
    )
    placed = lookup(keyed, bounds, ["category"], "left", small=cuts.small)
    on_cut = F.coalesce(
        (F.col("_digest") == F.col("_train_cut")) | (F.col("_digest") == F.col("_validate_cut")),
        F.lit(False),
    )
    before = lambda cut: F.col(cut).isNull() | (F.col("_digest") < F.col(cut))
    clear = (
        placed.where(~on_cut)
        .withColumn(
            "split",
            F.when(before("_train_cut"), "train")
            .when(before("_validate_cut"), "validate")
            .otherwise("test"),
        )
        .select(*rows.columns, "category", "split")
    )
    return clear.unionByName(_split_copies(placed.where(on_cut), cuts, rows.columns))


def _split_copies(on_cut: DataFrame, cuts: Dictionary, columns: list[str]) -> DataFrame:
    """Place the copies of each cut row: as many per part as its positions give."""
    grouped = on_cut.groupBy(*columns, "category", "_digest").agg(F.count(F.lit(1)).alias("_n"))
    detail = cuts.df.drop("n")
    start, end = F.col("_ahead"), F.col("_ahead") + F.col("_n")
    train = F.greatest(F.least(end, F.col("train_end")) - start, F.lit(0))
    validate = F.greatest(
        F.least(end, F.col("validate_end")) - F.greatest(start, F.col("train_end")), F.lit(0)
    )
    counted = (
        lookup(grouped, detail, ["category", "_digest"], small=cuts.small)
        .withColumn("_train", train)
        .withColumn("_validate", validate)
        .withColumn("_test", F.col("_n") - F.col("_train") - F.col("_validate"))
    )
    part = F.array(
        *[
            F.struct(F.lit(name).alias("split"), F.col(f"_{name}").alias("times"))
            for name in ("train", "validate", "test")
        ]
    )
    numbered = counted.select(*columns, "category", F.inline(part))
    # Two steps, so that very many copies never sit in one array.
    step = F.lit(10_000).cast("long")
    blocks = numbered.where("times > 0").withColumn(
        "_block", F.explode(F.sequence(F.lit(0).cast("long"), F.expr("(times - 1) div 10000")))
    )
    size = F.least(step, F.col("times") - F.col("_block") * step)
    return blocks.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), size))).select(
        *columns, "category", "split"
    )


def split_by_page(rows: DataFrame, seed: str = "0") -> DataFrame:
    """The same columns as stratified_split, with all rows of a URL in one part.

    Pages are split exactly within each set of categories (a page's least one, if it has several);
    its rows follow. A page of several categories counts in each, so a single category's shares are
    near the nominal ones, not exact.
    """
    categories = F.replace(F.min("categories"), F.lit(","), F.lit(";"))
    pages = rows.groupBy("url").agg(categories.alias("categories"))
    blank = [F.lit("").alias(name) for name in ("title", "keywords")]
    staged = stage(pages.select("url", *blank, "categories"), "pages")
    parts = stratified_split(staged, seed).select(F.col("url").alias("_url"), "split")
    each = per_category(rows)
    return each.join(parts, each["url"].eqNullSafe(parts["_url"])).drop("_url")
