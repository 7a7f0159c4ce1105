"""Readers of the input formats."""

from __future__ import annotations

import json
import zipfile
from dataclasses import dataclass

from py4j.protocol import Py4JError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import WHITESPACE
from ..operators.joins import Dictionary, lookup
from ..workspace import stage
from .sequence import SequenceFileSource, listed_files

TEXT_CLASS = "org.apache.hadoop.io.Text"
SUFFIX_LIST_NAME = "public-suffix-list.txt"
SUFFIX_LIST_OWNER = "org.apache.http.conn.util.PublicSuffixMatcherLoader"
#: Share of the listed files that may be unreadable.
TOLERANCE = 0.5
HARVEST_FIELDS = ("url", "title", "keywords", "categories")


def segment_paths(spark: SparkSession, list_path: str, template: str) -> list[str]:
    """One path pattern per line of a segment list; `{segment}` is replaced by the line."""
    lines = spark.read.text(list_path).where(F.length("value") > 0)
    return [template.format(segment=r["value"]) for r in lines.collect()]


def read_pages(
    spark: SparkSession, paths: list[str], fmt: str, key: str, value: str,
    partitions: int | None = None,
) -> DataFrame:
    """All segments as one (url, <value>) table; fmt is sequence, parquet, orc or json.

    partitions spreads an input that comes in fewer splits than the cluster has cores, by a shuffle.
    """
    if fmt == "sequence":
        pages = read_sequence_files(spark, paths, value)
    else:
        pages = spark.read.format(fmt).load(paths).select(F.col(key).alias("url"), F.col(value))
    return pages.repartition(partitions) if partitions else pages


def _sequence_rows(spark: SparkSession, paths: list[str], **options: str) -> DataFrame:
    spark.dataSource.register(SequenceFileSource)
    reader = spark.read.format("sequencefile").option("paths", json.dumps(paths))
    return reader.options(**options).load()


def read_sequence_files(spark: SparkSession, paths: list[str], value: str) -> DataFrame:
    """(url, <value>) from key/value text SequenceFiles, read in byte ranges as Arrow batches."""
    rows = _sequence_rows(spark, paths)
    return rows.select(F.col("key").alias("url"), F.col("value").alias(value))


def read_sequence_rdd(spark: SparkSession, paths: list[str], value: str) -> DataFrame:
    """The same through Hadoop's own reader, for stores that only that reaches; a row at a time."""
    pairs = spark.sparkContext.sequenceFile(",".join(paths), TEXT_CLASS, TEXT_CLASS)
    return spark.createDataFrame(pairs, f"url STRING, `{value}` STRING", verifySchema=False)


class TooManyUnreadable(RuntimeError):
    """More of the listed files than tolerated cannot be read."""


@dataclass(frozen=True)
class Segments:
    """pages (url, <value>) of the readable files; files (file, rows, error), one row a listed file."""

    pages: DataFrame
    files: DataFrame

    def quarantined(self) -> DataFrame:
        return self.files.where(F.col("error").isNotNull()).select("file", "error")


def read_segments(
    spark: SparkSession, paths: list[str], fmt: str, key: str, value: str, tolerance: float
) -> Segments:
    """All segments as one table, without the files that cannot be read.

    Every listed file is accounted for: its rows, and why it was set aside. A file is taken whole or
    not at all. If more than `tolerance` of the files are unreadable, TooManyUnreadable is raised.

    SequenceFiles tell their errors and are landed, as they are needed more than once. Of columnar
    files those are unreadable from which no row arrives (an empty one counts as such); their count
    needs no column, only the files' footers.
    """
    if fmt == "sequence":
        rows = stage(_sequence_rows(spark, paths, errors="report"), "pages")
        names = [F.col("key").alias("url"), F.col("value").alias(value)]
        good = rows.where(F.col("error").isNull())
        arrived = rows.groupBy("file").agg(
            F.count("key").alias("rows"), F.min("error").alias("error")
        )
        files = stage(_sequence_files(spark, paths).join(arrived, "file", "left"), "files")
    else:
        reader = spark.read.format(fmt).schema(f"`{key}` STRING, `{value}` STRING")
        rows = reader.option("ignoreCorruptFiles", "true").load(paths)
        names = [F.col(key).alias("url"), F.col(value)]
        good = rows.withColumn("file", F.col("_metadata.file_path"))
        arrived = good.groupBy("file").agg(F.count(F.lit(1)).alias("rows"))
        error = F.when(F.col("rows").isNull(), F.lit("no row could be read")).alias("error")
        listed = _listed(spark, paths).join(arrived, "file", "left")
        files = stage(listed.select("file", "rows", error), "files")
    files = files.fillna(0, ["rows"])
    bad, total = files.agg(F.count("error"), F.count(F.lit(1))).first()
    if bad > tolerance * total:
        raise TooManyUnreadable(f"{bad} of {total} files cannot be read")
    if bad:
        aside = Dictionary(files.where(F.col("error").isNotNull()).select("file"))
        good = lookup(good, aside.df, ["file"], "left_anti", small=aside.small)
    return Segments(good.select(*names), files)


def _listed(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(file) of all files at the paths; their contents are not read."""
    return spark.read.format("binaryFile").load(paths).select(F.col("path").alias("file"))


def _sequence_files(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(file) as the SequenceFile source names them, files without records included."""
    listed = [(path,) for pattern in paths for path, _ in listed_files(pattern)]
    return spark.createDataFrame(listed, "file STRING").distinct()


def land_pages(pages: DataFrame, path: str) -> DataFrame:
    """Write pages as Parquet and read them back."""
    pages.write.parquet(path)
    return pages.sparkSession.read.parquet(path)


def _whole_json(spark: SparkSession, path: str, schema: str) -> DataFrame:
    text = spark.read.text(path, wholetext=True)
    return text.select(F.from_json("value", schema, {"mode": "FAILFAST"}).alias("json"))


def _lines(spark: SparkSession, path: str) -> DataFrame:
    line = F.btrim(F.col("value"), F.lit(WHITESPACE)).alias("line")
    return spark.read.text(path).select(line).where(F.col("line") != "")


def _json_parts(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """(json) of a JSON document: a value of `schema`, a map or an array, for each of its lines.

    A document whose entries do not break over lines, however many files it comes in, is read line
    by line by many tasks. Any other is read whole by one.
    """
    array = schema.startswith("array")
    opening, closing = "[]" if array else "{}"
    inner = F.regexp_replace("line", r"^[\[{,]", "")
    inner = F.regexp_replace(inner, r"[\],]$" if array else ",$", "")
    value = F.from_json(F.concat(F.lit(opening), inner, F.lit(closing)), schema)
    rows = _lines(spark, path).select(value.alias("json"))
    parts = F.col("json") if array else F.map_values("json")
    wrong = F.col("json").isNull() | F.exists(parts, lambda v: v.isNull())
    return _whole_json(spark, path, schema) if rows.where(wrong).limit(1).count() else rows


def _json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame | None:
    """The rows of JSON lines; null if a line is no object with all fields of the schema."""
    lines = _lines(spark, path)
    rows = lines.select(F.from_json("line", schema).alias("json")).select("json.*")
    wrong = F.greatest(*[F.col(c).isNull() for c in [*rows.columns, rows.columns[0]]])
    return None if rows.where(wrong).limit(1).count() or not lines.limit(1).count() else rows


def read_category_index(spark: SparkSession, path: str) -> DataFrame:
    """(host, categories) from a JSON object host -> categories, in one or many files, or from JSON
    lines with these fields."""
    rows = _json_lines(spark, path, "host STRING, categories ARRAY<STRING>")
    if rows is not None:
        return rows
    return _json_parts(spark, path, "map<string,array<string>>").select(
        F.explode("json").alias("host", "categories")
    )


def category_index_path(directory: str, region: str = "en-US", variation: str = "") -> str:
    return f"{directory.rstrip('/')}/{region}{'.' + variation if variation else ''}.json"


def read_whitelist(spark: SparkSession, path: str) -> DataFrame:
    """(domain) from a JSON list, in one or many files, or from JSON lines with the field host."""
    rows = _json_lines(spark, path, "host STRING")
    if rows is None:
        rows = _json_parts(spark, path, "array<string>").select(F.explode("json"))
    return rows.toDF("domain").distinct()


def read_labels(spark: SparkSession, path: str) -> DataFrame:
    """(label) from a JSON list."""
    return _json_parts(spark, path, "array<string>").select(F.explode("json").alias("label"))


def read_interests(spark: SparkSession, path: str) -> DataFrame:
    """(host, rules) from a JSON object host -> rule -> categories."""
    return _json_parts(spark, path, "map<string,map<string,array<string>>>").select(
        F.explode("json").alias("host", "rules")
    )


def read_model(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(class_idx, klass, log_prior) and (token, log_likelihood) of a model that write_model wrote."""
    lines = _lines(spark, path)
    head = F.col("line").startswith('{"classes":')
    shape = "classes MAP<STRING, STRING>, logPriors ARRAY<DOUBLE>"
    opened = F.from_json(F.concat("line", F.lit("}}")), shape, {"mode": "FAILFAST"})
    priors = (
        lines.where(head)
        .select(opened.alias("m"))
        .select("m.classes", F.posexplode("m.logPriors").alias("class_idx", "log_prior"))
        .select(
            "class_idx",
            F.element_at("classes", F.col("class_idx").cast("string")).alias("klass"),
            "log_prior",
        )
    )
    entry = F.concat(F.lit("{"), F.regexp_replace("line", "^,", ""), F.lit("}"))
    parsed = F.from_json(entry, "map<string,array<double>>", {"mode": "FAILFAST"})
    terms = lines.where(~head).select(F.explode(parsed).alias("token", "log_likelihood"))
    return priors, terms


def read_words(spark: SparkSession, path: str) -> DataFrame:
    """(word) from one word per line; byte-order mark and line-end characters removed."""
    word = F.regexp_replace(F.col("value"), "^﻿", "")
    return (
        spark.read.text(path)
        .select(F.rtrim(word, F.lit(WHITESPACE)).alias("word"))
        .where(F.col("word") != "")
        .distinct()
    )


def read_profiles(spark: SparkSession, path: str) -> DataFrame:
    """(lang, ngram, cnt, n_words) from one JSON object per language file."""
    schema = "name STRING, n_words ARRAY<BIGINT>, freq MAP<STRING, BIGINT>"
    return (
        spark.read.schema(schema)
        .json(path)
        .select(F.col("name").alias("lang"), "n_words", F.explode("freq").alias("ngram", "cnt"))
        .select("lang", "ngram", "cnt", "n_words")
    )


def _suffix_rules(lines: DataFrame) -> DataFrame:
    rule = F.regexp_extract("value", r"^\s*([^\s/]\S*)", 1)
    return lines.select(rule.alias("rule")).where(F.col("rule") != "").distinct()


def read_suffix_rules(spark: SparkSession, path: str) -> DataFrame:
    """(rule) from a file in the public suffix list format."""
    return _suffix_rules(spark.read.text(path))


def bundled_suffix_rules(spark: SparkSession) -> DataFrame:
    """(rule) from the public suffix list inside Spark's own HTTP client jar."""
    try:
        owner = spark._jvm.java.lang.Class.forName(SUFFIX_LIST_OWNER)
        jar = owner.getProtectionDomain().getCodeSource().getLocation().getPath()
        with zipfile.ZipFile(jar) as files:
            name = next(n for n in files.namelist() if n.endswith(SUFFIX_LIST_NAME))
            text = files.read(name).decode("utf-8")
    except (Py4JError, AttributeError, OSError, StopIteration, zipfile.BadZipFile) as error:
        raise RuntimeError(
            "this Spark brings no public suffix list; name one with --suffix-rules"
        ) from error
    return _suffix_rules(spark.createDataFrame([(t,) for t in text.splitlines()], "value STRING"))


def _harvest_lines(spark: SparkSession, path: str) -> DataFrame:
    line = F.btrim(F.col("value"), F.lit(WHITESPACE))
    return spark.read.text(path).select(line.alias("line"), F.split(line, "\t").alias("_f"))


def read_harvest(spark: SparkSession, path: str) -> DataFrame:
    """(url, title, keywords, categories) from tab-separated lines, compressed or not."""
    rows = _harvest_lines(spark, path).where(F.size("_f") == len(HARVEST_FIELDS))
    return rows.select(*[F.get("_f", F.lit(i)).alias(n) for i, n in enumerate(HARVEST_FIELDS)])


def read_harvest_rejects(spark: SparkSession, path: str) -> DataFrame:
    """(line) of the lines that do not have exactly four fields."""
    return _harvest_lines(spark, path).where(F.size("_f") != len(HARVEST_FIELDS)).select("line")


def read_vectors(spark: SparkSession, path: str) -> DataFrame:
    """(number, indices, values, name) from lines of sparse vectors; name is the comment, or null."""
    line = F.split("value", " ?# ", 2)
    fields = F.filter(F.split(F.get(line, F.lit(0)), " "), lambda f: f != "")
    pairs = F.transform(F.slice("_f", 2, F.greatest(F.size("_f") - 1, F.lit(0))), lambda p: F.split(p, ":"))
    read = spark.read.text(path).select(fields.alias("_f"), F.get(line, F.lit(1)).alias("name"))
    return read.where(F.size("_f") > 0).select(
        F.get("_f", F.lit(0)).cast("long").alias("number"),
        F.transform(pairs, lambda p: p[0].cast("long")).alias("indices"),
        F.transform(pairs, lambda p: p[1].cast("double")).alias("values"),
        "name",
    )
