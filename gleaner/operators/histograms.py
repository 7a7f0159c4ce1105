"""Counters and histograms. All are partial aggregations over few groups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Bucket names by count.
COUNT_NAMES = ("ONE", "TWO", "THREE", "FOUR", "FIVE")


def count_bucket(n: Column) -> Column:
    case = F
    for i, name in enumerate(COUNT_NAMES, start=1):
        case = case.when(n == i, name)
    return case.when(n > len(COUNT_NAMES), "MORE")


def occurrences(df: DataFrame, key: str = "url") -> DataFrame:
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))


def occurrence_histogram(df: DataFrame, key: str = "url", weight: str | None = None) -> DataFrame:
    """Number of distinct keys by how often they occur: (bucket, n).

    `weight` names a column with the occurrences already counted per row.
    """
    n = F.sum(weight) if weight else F.count(F.lit(1))
    return (
        df.groupBy(key)
        .agg(n.alias("_n"))
        .groupBy(count_bucket(F.col("_n")).alias("bucket"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def counters(df: DataFrame, pairs: list[tuple[str, Column]]) -> DataFrame:
    """Count (group, name) pairs over all rows in one pass; a null name is not counted."""
    entries = F.array(
        *[F.struct(F.lit(g).alias("grp"), name.alias("name")) for g, name in pairs]
    )
    return (
        df.select(F.explode(F.filter(entries, lambda e: e["name"].isNotNull())).alias("e"))
        .groupBy(F.col("e.grp").alias("grp"), F.col("e.name").alias("name"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
