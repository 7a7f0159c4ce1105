"""Evaluate an expensive expression once per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Like withColumn, but the optimiser cannot copy the expression.

    A filter on a computed column is normally pushed below the projection, which evaluates the
    expression once in the filter and again in the projection. The output of a one-element
    explode is opaque to that rule.
    """
    others = [c for c in df.columns if c != name]
    return df.select(*others, F.explode(F.array(value)).alias(name))
