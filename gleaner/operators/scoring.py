"""Summed class scores of weighted terms, shared by language detection and naive Bayes.

A class that lacks a term scores it with an absent score of its own. Tables hold only what a class
that has the term scores above that, and only for the blocks of classes it occurs in (of at most
BLOCK slots, and of no more than there are classes); what all absent scores come to is added once a
document, from its weight total. So the work grows with the classes that terms occur in, not with
all there are.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .joins import Dictionary, lookup

BLOCK = 16
SCORE_DIGITS = 6


def slots(width: int) -> list[str]:
    return [f"s{i}" for i in range(width)]


def block_width(classes: DataFrame) -> int:
    """Slots of a block for so many classes."""
    return max(1, min(BLOCK, classes.count()))


def class_index(names: DataFrame, column: str) -> DataFrame:
    """(class_idx, klass) of the distinct names in order; as many rows as there are classes."""
    distinct = names.select(F.col(column).alias("klass")).where("klass is not null").distinct()
    number = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("klass")) - 1
    return distinct.select(number.cast("int").alias("class_idx"), "klass")


@dataclass
class ScoreTable:
    """table: (on, block, s0 …), a row for each term and block in which one of its classes is: how far
    the class's score of the term lies above its absent score, null for a class without the term.
    lines: (per, lines), an array by class_idx of (klass, start, slope): a document that lacks all
    terms of the class scores start + slope · (sum of weight · known)."""

    table: Dictionary
    on: list[str]
    lines: Dictionary
    width: int
    per: list[str] = field(default_factory=list)


def block_of(width: int) -> Column:
    return (F.col("class_idx") / width).cast("int")


def in_slots(value: Column, width: int, combine=F.sum) -> list[Column]:
    """Aggregates s0 …, of a value by the slot of its class; null for classes without a row."""
    slot = F.col("class_idx") % width
    return [combine(F.when(slot == i, value)).alias(s) for i, s in enumerate(slots(width))]


def line(klass: Column, start: Column, slope: Column) -> Column:
    """An aggregate: the lines of a group's classes, in order."""
    one = F.struct("class_idx", klass.alias("klass"), start.alias("start"), slope.alias("slope"))
    return F.sort_array(F.collect_list(one)).alias("lines")


def class_parts(met: DataFrame, keys: list[str], width: int) -> DataFrame:
    """(keys, known, part), a row for each of a document's blocks, from terms that have met their
    scores: (keys, weight, block, s0 …) and, where lines have slopes, known.

    A term's known counts in one of its rows only. Sums combine before the shuffle: what is shuffled
    are a document's class sums, never its terms.
    """
    names = slots(width)
    sums = [F.sum(F.col("weight") * F.col(s)).alias(s) for s in names]
    sloped = "known" in met.columns
    if sloped:
        sums.append(F.sum(F.col("weight") * F.col("known")).alias("known"))
    return met.groupBy(*keys, "block").agg(*sums).select(
        *keys,
        (F.col("known") if sloped else F.lit(0.0)).alias("known"),
        F.struct("block", F.array(*names).alias("sums")).alias("part"),
    )


def class_parts_by_size(
    met: DataFrame, keys: list[str], width: int, sizes: list[tuple[int, int, int]]
) -> DataFrame:
    """(size, keys, known, part): the same for all nested vocabularies (size, cut, terms) at once.

    A term's row carries its total and known. It is looked at once, and its scores are added to the
    sums of every size it is in, side by side; only a document's sums are dealt out to the sizes.
    """
    names = ["known", *slots(width)]
    sums = []
    for i, (_, cut, _) in enumerate(sizes):
        fits = F.col("total") >= cut
        sums += [
            F.sum(F.when(fits, F.col("weight") * F.col(s))).alias(f"_{s}_{i}") for s in names
        ]
    summed = met.groupBy(*keys, "block").agg(*sums)
    each = [
        F.struct(
            F.lit(size).alias("size"),
            F.col(f"_known_{i}").alias("known"),
            F.struct("block", F.array(*[f"_{s}_{i}" for s in names[1:]]).alias("sums")).alias("part"),
        )
        for i, (size, _, _) in enumerate(sizes)
    ]
    dealt = summed.select(*keys, F.explode(F.array(*each)).alias("_s"))
    # A size that none of the document's terms is in has no sum.
    return dealt.select("_s.size", *keys, "_s.known", "_s.part").where(F.col("known").isNotNull())


def best_class(
    parts: DataFrame, keys: list[str], docs: DataFrame, table: ScoreTable, always: bool = False
) -> DataFrame:
    """(keys, copies, best) for each of docs (keys, copies), from the sums of its terms, (keys, known,
    part).

    Copies of a document share their keys, so their sums grow alike and are divided by their number.
    best is null for a document without any known term, unless `always`: then all classes compete,
    with no more than their lines. A class above its line is above it by its slots, so both together
    give the maximum over all classes. Among equal scores the first class wins.
    """
    summed = parts.select(*keys, "known", "part", F.lit(0).cast("long").alias("copies"))
    part = summed.schema["part"].dataType
    every = docs.select(
        *keys, F.lit(0.0).alias("known"), F.lit(None).cast(part).alias("part"),
        F.col("copies").cast("long").alias("copies"),
    )
    # A document has as many parts as there are blocks with a class of its terms.
    found = summed.unionByName(every).groupBy(*keys).agg(
        F.sum("known").alias("known"), F.sum("copies").alias("copies"), F.collect_list("part").alias("parts")
    )
    if table.per:
        found = lookup(found, table.lines.df, table.per, small=table.lines.small)
    else:
        found = found.withColumn("lines", table.lines.select("lines").scalar())

    def candidate(class_idx: Column, own: Column, above: Column) -> Column:
        total = own["start"] + (own["slope"] * F.col("known") + above) / F.col("copies")
        return F.struct(
            F.round(total, SCORE_DIGITS).alias("score"),
            (-class_idx).alias("first"),
            own["klass"].alias("klass"),
        )

    def of_part(p: Column) -> Column:
        def one(v: Column, i: Column) -> Column:
            at = p["block"] * table.width + i
            return candidate(at, F.get("lines", at), F.coalesce(v, F.lit(0.0)))

        return F.array_max(F.transform(p["sums"], one))

    best = F.array_max(F.transform("parts", of_part))
    if always:
        alone = F.transform("lines", lambda own: candidate(own["class_idx"], own, F.lit(0.0)))
        best = F.array_max(F.array(best, F.array_max(alone)))
    return found.select(*keys, "copies", best["klass"].alias("best"))
