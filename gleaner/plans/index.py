"""Category index and whitelist from nested interests."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value: the rule that applies to all pages of a host.
DEFAULT_RULE = "__ANY"


def build_index(interests: DataFrame) -> DataFrame:
    """(host, categories) from (host, rules MAP<rule, categories>)."""
    return interests.select(
        "host", F.try_element_at("rules", F.lit(DEFAULT_RULE)).alias("categories")
    )


def sorted_whitelist(index: DataFrame) -> DataFrame:
    return index.select("host").distinct().orderBy("host")
