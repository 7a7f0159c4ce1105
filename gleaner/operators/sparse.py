"""Sparse vectors: terms and classes by dense numbers, an instance's weights as sorted arrays."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..workspace import stage
from .joins import Dictionary, lookup
from .vectors import row_id

#: Copies of a row are made so many at a time, so that no array grows with their number.
COPIES = 1 << 16


def numbered(values: DataFrame, column: str, name: str, start: int = 1) -> DataFrame:
    """Rows with a dense number in the order of a column whose values are distinct.

    Ranges are numbered by themselves, behind the number of rows of the ranges before: no task
    holds all. The table is written on the way, so that ranges stay as they are.
    """
    dealt = stage(
        values.repartitionByRange(column).withColumn("_part", F.spark_partition_id()), "numbered"
    )
    sizes = dealt.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    # A row a range.
    until = F.sum("_n").over(Window.partitionBy(F.lit(0)).orderBy("_part"))
    before = sizes.select("_part", (until - F.col("_n") + F.lit(start - 1)).alias("_before"))
    place = F.row_number().over(Window.partitionBy("_part").orderBy(column))
    found = dealt.withColumn("_at", place).join(F.broadcast(before), "_part")
    return found.select(*values.columns, (F.col("_before") + F.col("_at")).alias(name))


def sparse_vectors(instances: DataFrame, terms: Dictionary) -> DataFrame:
    """(…, indices ARRAY, values ARRAY), a row an instance (…, terms), by terms (term, idf, index).

    Weights are ln(1 + tf) · idf in the order of the index. An instance without a known term has
    empty arrays. Copies are one instance until they are written out again, as many as they were.
    Entries combine before the only shuffle, which carries numbers and weights of known terms, and
    the other columns once an instance.
    """
    others = [c for c in instances.columns if c != "terms"]
    keyed = instances.withColumn("_id", row_id(instances.columns))
    rows = keyed.select("_id", F.inline("terms")).withColumnRenamed("token", "term")
    known = lookup(rows, terms.select("term", "idf", "index"), ["term"], small=terms.small)
    entry = F.struct("index", (F.log1p(F.col("n")) * F.col("idf")).alias("weight"))
    entries = known.select("_id", entry.alias("_entry"))
    copies = keyed.select("_id", F.struct(*others).alias("_of"))
    vectors = (
        entries.unionByName(copies, allowMissingColumns=True)
        .groupBy("_id")
        .agg(
            F.sort_array(F.collect_set("_entry")).alias("_entries"),
            F.count("_of").alias("_copies"),
            F.first("_of", ignorenulls=True).alias("_of"),
        )
        .select("_of.*", "_entries", "_copies")
    )
    rounds = F.explode(F.sequence(F.lit(0), F.floor((F.col("_copies") - 1) / COPIES)))
    times = F.least(F.lit(COPIES), F.col("_copies") - F.col("_round") * COPIES)
    return (
        vectors.withColumn("_round", rounds)
        .withColumn("_copy", F.explode(F.sequence(F.lit(1), times.cast("int"))))
        .select(
            *others,
            F.transform("_entries", lambda e: e["index"]).alias("indices"),
            F.transform("_entries", lambda e: e["weight"]).alias("values"),
        )
    )
