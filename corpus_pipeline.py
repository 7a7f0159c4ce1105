"""Documents to training tokens: five stages, each of which takes on all that the one before kept.

quality          drops documents whose probability of a grade of 1 or more is too small
near_duplicates  keeps one document of each component of shingle-set links
decontamination  cuts spans of benchmark items out of texts, and drops texts made of them
secrets          masks secrets
tokens           encodes the texts; its rows are doc_id, ids, n_ids and the digest of what ids decode to

Each stage is written as Parquet in the shared folder and read again by the next. All but the last
return the columns of documents, by name; further columns are left out, clashing names with them.
Nulls, empty and repeated rows and very long texts are as the operators' modules say; an empty table
goes through all stages and gives an empty one. The tokenizer's folder is the session's
`spark.gleaner.tokenizers`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gleaner.llm import decontaminate, jaccard, pieces, quality, secrets
from gleaner.llm.common import stage, table


def select_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    weights = quality.fit_quality(docs, table(spark, sf_dir, "labels"), quality.graded())
    return quality.select_quality(docs, weights)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.one_of_each(docs)


def cut_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.mask_secrets(docs)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = pieces.load_model(spark, pieces.model_path(spark))
    coded = pieces.recode(docs, model)
    return coded.select(*pieces.checked(coded))


STAGES = [
    ("quality", select_quality),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", cut_benchmark),
    ("secrets", mask_secrets),
    ("tokens", encode_pieces),
]

#: Models, components and encoding are beyond SQL; tests hold the stages to brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), name)
    return docs
