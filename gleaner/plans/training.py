"""Training rows from harvested rows, and the classifier trained on them."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as X
from ..operators import bayes as B
from ..operators import vectors as V
from ..operators.joins import Dictionary, lookup
from ..operators.once import with_once
from ..operators.sparse import numbered, sparse_vectors
from ..operators.words import StopWords, drop_stop_words
from ..sinks import vector_line, write_lines
from ..workspace import stage

# Fixed value: regions whose titles and keywords have no spaces between words.
UNSEGMENTED_REGIONS = ("zh-CN",)
FIELDS = ["url", "title", "keywords"]

#: From a text to its tokens: ARRAY<STRING>.
Tokenizer = Callable[[Column], Column]


def page_tokens(
    rows: DataFrame,
    stop: StopWords,
    region: str = "en-US",
    tokenizer: Tokenizer | None = None,
) -> DataFrame:
    """Rows (url, title, keywords, categories) with a token string; empty documents dropped.

    tokenizer applies to title and keywords; by default words of ASCII letters and digits. For an
    unsegmented region without one, title and keywords are left whole in the token string, for a
    word segmenter to come. A null field has no tokens.
    """
    whole = tokenizer is None and region in UNSEGMENTED_REGIONS
    tokenised = FIELDS[:1] if whole else FIELDS
    parts = []
    for name in tokenised:
        own = X.training_tokens if name == "url" or tokenizer is None else tokenizer
        parts.append(F.coalesce(own(F.col(name)), F.array().cast("array<string>")))
    filtered = drop_stop_words(
        with_once(rows, "_all", F.concat(*parts)), "_all", stop, rows.columns
    )
    words = F.col("_all")
    if whole:
        fields = [F.coalesce(name, F.lit("")) for name in FIELDS[1:]]
        words = F.concat(words, F.array(*fields))
    text = F.replace(F.array_join(words, " "), F.lit("\\"), F.lit(""))
    return with_once(filtered, "tokens", text).drop("_all").where(F.trim("tokens") != "")


def training_rows(
    rows: DataFrame,
    stop: StopWords,
    region: str = "en-US",
    tokenizer: Tokenizer | None = None,
) -> DataFrame:
    """(url, tokens, klass): one row per page and category."""
    return page_tokens(rows, stop, region, tokenizer).select(
        "url", "tokens", F.explode(F.split("categories", ",")).alias("klass")
    )


def labels(rows: DataFrame) -> DataFrame:
    return rows.select(F.explode(F.split("categories", ",")).alias("label")).distinct()


KEYS = ["url", "klass", "doc"]


@dataclass
class Classifier:
    """Models of one or several vocabulary sizes, out of the sums of the largest."""

    instances: DataFrame
    vocabulary: Dictionary
    sums: B.ClassSums

    def priors(self) -> DataFrame:
        return B.priors(self.sums)

    def likelihoods(self) -> DataFrame:
        return B.likelihoods(self.sums)

    def predict(self, instances: DataFrame | None = None, keys: list[str] | None = None):
        return B.predict(self.instances if instances is None else instances, self.sums, keys or KEYS)

    def cross_validate(self) -> DataFrame:
        return B.cross_validate(self.instances, self.sums, [*KEYS, "fold"])

    def vectors(self) -> DataFrame:
        return V.tfidf(self.instances, self.vocabulary, sizes=self.sums.sizes)


def instances_of(pages: DataFrame, folds: int = B.FOLDS) -> DataFrame:
    """(url, klass, doc, fold, terms) from (url, tokens, categories); doc tells texts apart.

    Terms are counted before a page is repeated per category.
    """
    keyed = pages.select("url", "categories", "tokens", F.md5("tokens").alias("doc"))
    counted = B.with_fold(V.with_terms(keyed), folds)
    return counted.select(
        "url", "doc", "fold", "terms", F.explode(F.split("categories", ",")).alias("klass")
    )


def train_classifier(
    pages: DataFrame,
    sizes: tuple[int, ...] | int = V.VOCABULARY_SIZES,
    folds: int = B.FOLDS,
) -> Classifier:
    """Models of all vocabulary sizes from pages (url, tokens, categories).

    Text is tokenised once, its terms are counted once and summed once, for all sizes.
    """
    sizes = (sizes,) if isinstance(sizes, int) else tuple(sizes)
    instances = stage(instances_of(pages, folds), "instances")
    counts = V.count_terms(instances)
    vocab = V.vocabulary(counts, max(sizes))
    sums = B.class_sums(instances, vocab, V.cuts(counts, sizes), folds)
    return Classifier(instances, vocab, sums)


def export_vectors(instances: DataFrame, vocab: Dictionary, out: str) -> dict[str, str]:
    """Write sparse TF-IDF vectors as lines, with the tables that say which number is what.

    Instances are (url, klass, …, terms) of a written table. Terms and classes are numbered from 1
    in their order; an instance without a class has the number 0.
    """
    spark = instances.sparkSession
    paths = {name: f"{out}/{name}" for name in ("terms", "classes", "vectors")}
    numbered(vocab.select("term", "idf"), "term", "index").write.parquet(paths["terms"])
    classes = instances.select("klass").where(F.col("klass").isNotNull()).distinct()
    numbered(classes, "klass", "number").write.parquet(paths["classes"])
    terms = Dictionary(spark.read.parquet(paths["terms"]))
    numbers = Dictionary(spark.read.parquet(paths["classes"]))
    vectors = sparse_vectors(instances.select("url", "klass", "terms"), terms)
    known = lookup(vectors, numbers.select("klass", "number"), ["klass"], "left", small=numbers.small)
    lines = vector_line(known.fillna(0, ["number"]), "number", "url")
    write_lines(lines, paths["vectors"])
    return paths
