"""Host names in both spellings: with letters beyond ASCII, and with xn-- labels in their place.

Pages, rules and dictionaries may spell a name either way. The tables that pages are looked up in are
given every spelling of their names, so pages need no conversion and no Python: a page's host is
looked up as it is, and the domain found keeps the page's spelling.
"""

from __future__ import annotations

import unicodedata
from itertools import product

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: what marks a converted label.
PREFIX = "xn--"
#: A name of more converted labels is spelt as it is, all in ASCII, and all in letters.
MIXED_LABELS = 6


def label_spellings(label: str) -> tuple[str, str]:
    """A label in ASCII and in letters; twice the same if it has one spelling only."""
    if label.startswith(PREFIX) and label.isascii():
        try:
            letters = label[len(PREFIX) :].encode().decode("punycode")
        except (UnicodeError, ValueError, OverflowError):
            return label, label
        back = PREFIX + letters.encode("punycode", "replace").decode()
        same = letters == unicodedata.normalize("NFKC", letters).lower() and back == label
        fine = same and letters.isprintable() and not letters.isascii()
        return (label, letters) if fine else (label, label)
    if label.isascii() or label.startswith(PREFIX):
        return label, label
    letters = unicodedata.normalize("NFKC", label).lower()
    if letters.isascii() or not letters.isprintable():
        return label, label
    return PREFIX + letters.encode("punycode").decode(), label


def spellings(name: str) -> list[str]:
    """All spellings of a name but its own."""
    labels = [label_spellings(label) for label in name.split(".")]
    if sum(a != b for a, b in labels) > MIXED_LABELS:
        found = {".".join(a for a, _ in labels), ".".join(b for _, b in labels)}
    else:
        found = {".".join(some) for some in product(*[dict.fromkeys(pair) for pair in labels])}
    return sorted(found - {name})


def has_spellings(name: Column) -> Column:
    return F.coalesce(name.rlike(r"[^\x00-\x7F]|(^|\.)xn--"), F.lit(False))


def _spelt(batches):
    for batch in batches:
        names = batch.column(0).to_pylist()
        rows = [(name, other) for name in names for other in spellings(name)]
        if rows:
            own, others = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(own, pa.string()), pa.array(others, pa.string())], ["_own", "_other"]
            )


def other_spellings(df: DataFrame, column: str) -> DataFrame:
    """The rows whose name has other spellings, once for each of these. Only distinct names of that
    kind are converted, few in any table."""
    some = df.where(has_spellings(F.col(column)))
    pairs = some.select(column).distinct().mapInArrow(_spelt, "_own STRING, _other STRING")
    met = some.join(pairs, F.col(column) == F.col("_own"))
    return met.select(*[F.col("_other").alias(c) if c == column else F.col(c) for c in df.columns])


def with_spellings(df: DataFrame, column: str) -> DataFrame:
    """The table with a row for every spelling of its names. What the table itself says of a
    spelling stands; of several rows that come to mean the same name the least one is added."""
    others = [c for c in df.columns if c != column]
    more = other_spellings(df, column).join(df.select(column), column, "left_anti")
    if others:
        least = F.min(F.struct(*others)).alias("_least")
        more = more.groupBy(column).agg(least).select(column, "_least.*")
    return df.unionByName(more.select(*df.columns).distinct())
