"""Multinomial naive Bayes from grouped sums, with cross-validation in the same pass.

The parameters of a fold's model are the overall sums minus the fold's own, so k models cost one
aggregation of the weights instead of k. Vocabularies are nested, so the sums of the largest serve
all sizes, and one scoring pass serves all of them too. Classes are rows; there is no limit to them.

ln((W + 1) / below), the log likelihood of a term of weight W in a class, is ln(W + 1), which no
vocabulary size changes and which is 0 for a term that the class lacks, minus ln(below), which a
document needs once. So only what classes have is tabled, and for a fold only terms that occur in it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..workspace import stage
from .joins import Dictionary, lookup
from .scoring import (
    ScoreTable, best_class, block_of, block_width, class_index, class_parts_by_size, in_slots, line, slots,
)
from .vectors import with_sizes

FOLDS = 10


def with_fold(instances: DataFrame, folds: int = FOLDS, column: str = "url") -> DataFrame:
    """Add a fold from the digest of a column, so copies of a page share their fold."""
    head = F.conv(F.substring(F.md5(F.col(column)), 1, 8), 16, 10).cast("long")
    return instances.withColumn("fold", F.pmod(head, F.lit(folds)).cast("int"))


@dataclass
class ClassSums:
    """weights: (fold, klass, term, total, idf, weight); counts: (fold, klass, n) of instances;
    totals: (size, terms, fold, klass, weight). All are written tables."""

    weights: DataFrame
    counts: DataFrame
    totals: DataFrame
    classes: DataFrame
    width: int
    sizes: list[tuple[int, int, int]]
    folds: int


def class_sums(
    instances: DataFrame, vocab: Dictionary, sizes: list[tuple[int, int, int]], folds: int = FOLDS
) -> ClassSums:
    """Aggregate instances (klass, fold, terms, …) to TF-IDF sums in one pass."""
    rows = instances.select("fold", "klass", F.inline("terms")).withColumnRenamed("token", "term")
    known = vocab.select("term", "idf", "total")
    weights = stage(
        lookup(rows, known, ["term"], small=vocab.small)
        .groupBy("fold", "klass", "term", "total", "idf")
        .agg(F.sum(F.log1p(F.col("n")) * F.col("idf")).alias("weight")),
        "class-sums",
    )
    counts = stage(instances.groupBy("fold", "klass").agg(F.count(F.lit(1)).alias("n")), "counts")
    totals = stage(
        with_sizes(weights, sizes)
        .groupBy("size", "terms", "fold", "klass")
        .agg(F.sum("weight").alias("weight")),
        "totals",
    )
    classes = stage(class_index(counts, "klass"), "classes")
    return ClassSums(weights, counts, totals, classes, block_width(classes), sizes, folds)


def _each_fold(folds: int):
    return F.explode(F.sequence(F.lit(0), F.lit(folds - 1)))


def _log_priors(sums: ClassSums, left_out: bool) -> DataFrame:
    """(class_idx, klass, n, log_prior), with fold: without that fold's instances."""
    n_classes = sums.classes.count()
    by_class = sums.classes.join(sums.counts, "klass", "left").select(
        "class_idx", "klass", F.coalesce("n", F.lit(0)).alias("n"), F.col("fold").alias("of")
    )
    keys = []
    if left_out:
        keys = ["fold"]
        by_class = by_class.withColumn("fold", _each_fold(sums.folds)).withColumn(
            "n", F.when(F.col("of") == F.col("fold"), 0).otherwise(F.col("n"))
        )
    counted = by_class.groupBy(*keys, "class_idx", "klass").agg(F.sum("n").alias("n"))
    everything = counted.groupBy(*keys).agg(F.sum("n").alias("everything"))
    if keys:
        counted = counted.join(everything, keys)
    else:
        counted = counted.withColumn("everything", F.lit(everything.first()["everything"]))
    log_prior = F.log((F.col("n") + 1) / (F.col("everything") + n_classes))
    return counted.select(*keys, "class_idx", "klass", "n", log_prior.alias("log_prior"))


def priors(sums: ClassSums) -> DataFrame:
    """(class_idx, klass, n, log_prior)."""
    return _log_priors(sums, left_out=False)


def _weights_left(df: DataFrame, sums: ClassSums, keys: list[str], left_out: bool) -> DataFrame:
    """Sums of weight over the folds by keys; with fold: over the others."""
    if not left_out:
        return df.groupBy(*keys).agg(F.sum("weight").alias("weight"))
    own = F.map_from_entries(F.collect_list(F.struct("fold", "weight"))).alias("own")
    summed = df.groupBy(*keys).agg(F.sum("weight").alias("every"), own)
    without = F.col("every") - F.coalesce(F.try_element_at("own", F.col("fold")), F.lit(0.0))
    return summed.withColumn("fold", _each_fold(sums.folds)).select(
        "fold", *keys, without.alias("weight")
    )


def _below(sums: ClassSums, left_out: bool) -> DataFrame:
    """(size, fold if left_out, class_idx, klass, below): a class's whole weight and the terms."""
    groups = ["size", "fold"] if left_out else ["size"]
    total = _weights_left(sums.totals, sums, ["size", "terms", "klass"], left_out)
    # A class whose instances have no term of the vocabulary has no sum.
    shapes = F.array(*[F.struct(F.lit(s).alias("size"), F.lit(n).alias("terms")) for s, _, n in sums.sizes])
    every = sums.classes.select("class_idx", "klass", F.explode(shapes).alias("_s")).select(
        "class_idx", "klass", "_s.size", "_s.terms"
    )
    if left_out:
        every = every.withColumn("fold", _each_fold(sums.folds))
    return every.join(
        total.select(*groups, "klass", F.col("weight").alias("sum")), [*groups, "klass"], "left"
    ).select(
        *groups, "class_idx", "klass", (F.coalesce("sum", F.lit(0.0)) + F.col("terms")).alias("below")
    )


TERM = ["term", "total", "idf"]


def _by_block(sums: ClassSums, keys: list[str]) -> DataFrame:
    """(keys, block, s0 …) sums of weight; terms of no class are in block 0."""
    known = sums.weights.join(sums.classes, "klass", "left")
    block = F.coalesce(block_of(sums.width), F.lit(0)).alias("block")
    return known.groupBy(*keys, block).agg(*in_slots(F.col("weight"), sums.width))


def likelihoods(sums: ClassSums) -> DataFrame:
    """(size, token, log_likelihood ARRAY<DOUBLE>) in class_idx order."""
    entry = F.struct("block", F.array(*slots(sums.width)).alias("s"))
    by_term = _by_block(sums, TERM).groupBy("term", "total").agg(
        F.map_from_entries(F.collect_list(entry)).alias("own")
    )
    in_order = F.sort_array(F.collect_list(F.struct("class_idx", "below")))
    below = Dictionary(_below(sums, left_out=False).groupBy("size").agg(in_order.alias("classes")))
    rows = lookup(with_sizes(by_term, sums.sizes), below.df, ["size"], small=below.small)

    def one(c):
        block = F.try_element_at("own", (c["class_idx"] / sums.width).cast("int"))
        weight = F.coalesce(F.get(block, c["class_idx"] % sums.width), F.lit(0.0))
        return F.log((weight + 1.0) / c["below"])

    return rows.select("size", F.col("term").alias("token"), F.transform("classes", one).alias("log_likelihood"))


def _above(sums: ClassSums, left_out: bool) -> DataFrame:
    """(fold if left_out, term, total, idf, block, s0 …): sums of weight; with fold: those of the other
    folds, for the terms that occur in it."""
    names = slots(sums.width)
    if not left_out:
        return _by_block(sums, TERM)
    own = stage(_by_block(sums, ["fold", *TERM]), "blocks")
    every = own.groupBy(*TERM, "block").agg(*[F.sum(s).alias(s) for s in names])
    mine = own.select("fold", "term", "block", *[F.col(s).alias(f"_{s}") for s in names])
    rows = own.select("fold", "term").distinct().join(every, "term")
    rows = rows.join(mine, ["fold", "term", "block"], "left")
    without = [
        F.greatest(F.col(s) - F.coalesce(f"_{s}", F.lit(0.0)), F.col(s) * 0).alias(s) for s in names
    ]
    return rows.select("fold", *TERM, "block", *without)


def _model(sums: ClassSums, left_out: bool) -> ScoreTable:
    """ln(W + 1) times idf, so that scoring multiplies ln(1 + tf) only."""
    fold = ["fold"] if left_out else []
    weights = _above(sums, left_out)
    first = F.col("block") == F.min("block").over(Window.partitionBy(*fold, "term"))
    table = weights.select(
        *fold, "term", "total", "block",
        F.when(first, F.col("idf")).otherwise(0.0).alias("known"),
        *[(F.log1p(s) * F.col("idf")).alias(s) for s in slots(sums.width)],
    )
    per = ["size", *fold]
    starts = _log_priors(sums, left_out).select(*fold, "class_idx", "log_prior")
    lines = _below(sums, left_out).join(starts, [*fold, "class_idx"]).groupBy(*per).agg(
        line(F.col("klass"), F.col("log_prior"), -F.log("below"))
    )
    return ScoreTable(Dictionary(table), [*fold, "term"], Dictionary(lines), sums.width, per)


def _scored(instances: DataFrame, sums: ClassSums, keys: list[str], left_out: bool) -> DataFrame:
    model = _model(sums, left_out)
    rows = instances.select(*keys, F.inline("terms")).select(
        *keys, F.col("token").alias("term"), F.log1p(F.col("n")).alias("weight")
    )
    met = lookup(rows, model.table.df, model.on, small=model.table.small)
    sizes = F.explode(F.array(*[F.lit(s) for s, _, _ in sums.sizes])).alias("size")
    every = instances.select(*keys, F.lit(1).alias("copies"), sizes)
    parts = class_parts_by_size(met, keys, sums.width, sums.sizes)
    best = best_class(parts, ["size", *keys], every, model, always=True)
    return best.withColumnRenamed("best", "prediction")


def predict(instances: DataFrame, sums: ClassSums, keys: list[str]) -> DataFrame:
    """(size, keys, copies, prediction) with the model of all folds. Keys must not be null."""
    return _scored(instances, sums, keys, left_out=False)


def cross_validate(instances: DataFrame, sums: ClassSums, keys: list[str]) -> DataFrame:
    """(size, keys, copies, prediction), each instance scored by the model that left its fold out.

    `keys` must contain fold.
    """
    return _scored(instances, sums, keys, left_out=True)


def confusion(predicted: DataFrame) -> DataFrame:
    return predicted.groupBy("size", "klass", "prediction").agg(F.sum("copies").alias("n"))


def accuracy(matrix: DataFrame) -> DataFrame:
    """(size, instances, correct, accuracy) from a confusion matrix."""
    right = F.coalesce(F.sum(F.when(F.col("klass") == F.col("prediction"), F.col("n"))), F.lit(0))
    return matrix.groupBy("size").agg(F.sum("n").alias("instances"), right.alias("correct")).withColumn(
        "accuracy", F.col("correct") / F.col("instances")
    )


def class_metrics(matrix: DataFrame) -> DataFrame:
    """(size, klass, instances, predicted, correct, precision, recall, f1): every class that occurs
    or is predicted; a share of nothing is 0."""
    same = F.when(F.col("klass") == F.col("prediction"), F.col("n")).otherwise(0)
    by_class = matrix.select(
        "size", "klass", F.col("n").alias("instances"), F.lit(0).alias("predicted"), same.alias("correct")
    ).unionAll(matrix.select("size", "prediction", F.lit(0), "n", F.lit(0)))
    counted = by_class.groupBy("size", "klass").agg(
        *[F.sum(c).alias(c) for c in ("instances", "predicted", "correct")]
    )

    def share(a, b):
        return F.when(b > 0, a / b).otherwise(0.0)

    correct, instances, predicted = (F.col(c) for c in ("correct", "instances", "predicted"))
    return counted.select(
        "size", "klass", "instances", "predicted", "correct",
        share(correct, predicted).alias("precision"),
        share(correct, instances).alias("recall"),
        share(2 * correct, instances + predicted).alias("f1"),
    )
