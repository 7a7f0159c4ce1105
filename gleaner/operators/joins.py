"""Dictionary joins: broadcast behind a measured size, salted shuffle join beyond it.

Beyond it, what is broadcast is a Bloom filter of the dictionary's keys, of a fixed size: rows whose
key cannot be in the dictionary do not take part in the shuffle, or leave their payload behind.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..workspace import stage

BROADCAST_ROWS = 2_000_000
BROADCAST_BYTES = 256 * 1024 * 1024
SALTS = 64
#: Bits of the filter and bits set for a key: a hundredth of strange keys pass at 7 million keys.
FILTER_BITS = 1 << 26
FILTER_HASHES = 3


def _value_bytes(field: T.StructField) -> Column:
    col = F.col(f"`{field.name}`")
    if isinstance(field.dataType, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(col), F.lit(0)).cast("long") + 8
    if isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
        text = F.to_json(F.struct(col))
        return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 8
    return F.lit(8).cast("long")


def measure(df: DataFrame) -> tuple[int, int]:
    """(rows, approximate bytes), counted by the executors."""
    size = reduce(lambda a, b: a + b, [_value_bytes(f) for f in df.schema.fields])
    row = df.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(size), F.lit(0)).alias("b")).first()
    return row["n"], row["b"]


def fits_broadcast(
    df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES
) -> bool:
    n, size = measure(df)
    return n <= max_rows and size <= max_bytes


class Dictionary:
    """A lookup table, written once and measured, so every join against it knows its form.

    Nothing of it is held by executors, so nothing needs to be released.
    """

    def __init__(
        self,
        df: DataFrame,
        max_rows: int = BROADCAST_ROWS,
        max_bytes: int = BROADCAST_BYTES,
    ):
        self.df = stage(df, "dictionary")
        self.rows, self.bytes = measure(self.df)
        self.small = self.rows <= max_rows and self.bytes <= max_bytes

    def select(self, *cols) -> DataFrame:
        return self.df.select(*cols)


def _filter_bits(keys: list[str]) -> list[Column]:
    return [
        F.pmod(F.xxhash64(F.lit(i), *keys), F.lit(FILTER_BITS)) for i in range(FILTER_HASHES)
    ]


def key_filter(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row, `words`: the filter's bits, 64 a number. Tasks set them and combine; the array is put
    together out of at most FILTER_BITS / 64 numbers."""
    bit = F.explode(F.array(*_filter_bits(keys))).alias("bit")
    word = F.shiftright("bit", 6).alias("word")
    mask = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("bit").bitwiseAND(63).cast("int"))
    present = df.dropna(subset=keys).select(bit).select(word, mask.alias("mask"))
    every = df.sparkSession.range(FILTER_BITS // 64).select(
        F.col("id").alias("word"), F.lit(0).cast("long").alias("mask")
    )
    words = present.unionByName(every).groupBy("word").agg(F.bit_or("mask").alias("mask"))
    ordered = F.sort_array(F.collect_list(F.struct("word", "mask")))
    return words.agg(F.transform(ordered, lambda e: e["mask"]).alias("words"))


def may_be_in(right: DataFrame, keys: list[str]) -> Column:
    """False for keys that right does not have, and for null ones; true for all it has."""
    words = key_filter(right, keys).scalar()
    found = [F.col(f"`{key}`").isNotNull() for key in keys]
    for bit in _filter_bits(keys):
        word = F.get(words, F.shiftright(bit, 6).cast("int"))
        found.append(F.getbit(word, bit.bitwiseAND(63)) == 1)
    return reduce(lambda a, b: a & b, found)


def lookup(
    left: DataFrame,
    right: DataFrame,
    on: list[str],
    how: str = "inner",
    *,
    small: bool,
    salts: int = SALTS,
    payload: Sequence[str] = (),
) -> DataFrame:
    """Equi-join a large table with a dictionary.

    A dictionary known to be small is broadcast and the large side is not shuffled. Otherwise both
    sides are shuffled on (key, salt): a hot key of the large side spreads over `salts` tasks
    and each dictionary row is copied once per salt. Inner and semi-joins then shuffle only rows that
    pass the dictionary's filter. A left join shuffles all rows, and payload names columns that are
    of use in rows with a match only: in rows that the filter rules out they become null.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"unsupported dictionary join: {how}")
    if small:
        return left.join(F.broadcast(right), on, how)
    if how in ("inner", "left_semi"):
        left = left.where(may_be_in(right, on))
    elif how == "left" and payload:
        left = left.withColumn("_may", may_be_in(right, on))
        left = left.withColumns({c: F.when(F.col("_may"), F.col(c)) for c in payload}).drop("_may")
    salted = left.withColumn("_salt", F.pmod(F.spark_partition_id(), F.lit(salts)))
    copies = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted.join(copies, [*on, "_salt"], how).drop("_salt")


#: Rows of one key that a task may get; a key of more is spread over several.
TASK_ROWS = 1_000_000


def semi_join_hot(
    left: DataFrame, right: DataFrame, key: str, counted: DataFrame, rows: int = TASK_ROWS
) -> DataFrame:
    """Left semi-join of two large tables whose left side may be hot on some keys.

    counted (key, n) has the left rows of a key. A key of more than `rows` rows is spread over
    n / rows tasks, and its right row is copied as often; how many keys that are depends on the
    left table alone, and they are broadcast only behind their measured size.
    """
    parts = F.ceil(F.col("n") / rows).cast("int")
    hot = Dictionary(counted.where(F.col("n") > rows).select(key, parts.alias("_parts")))
    marked = lookup(left, hot.df, [key], "left", small=hot.small)
    salt = F.when(F.col("_parts").isNotNull(), F.pmod(F.monotonically_increasing_id(), "_parts"))
    spread = marked.withColumn("_salt", F.coalesce(salt, F.lit(0))).drop("_parts")
    copies = F.sequence(F.lit(0), F.coalesce(F.col("_parts"), F.lit(1)) - 1)
    copied = lookup(right.select(key), hot.df, [key], "left", small=hot.small).select(
        key, F.explode(F.transform(copies, lambda i: i.cast("long"))).alias("_salt")
    )
    return spread.join(copied, [key, "_salt"], "left_semi").drop("_salt")
