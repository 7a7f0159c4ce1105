"""Writers of the output formats.

write_labels, write_index, write_whitelist, write_interests and write_model write one JSON document
of any size as ordered part files, each by its own task: put behind each other they are the document,
and a line is an entry. The *_json forms are one JSON value each, built in one task: for readers that
want it in one row. *_entries are JSON lines, one object an entry.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..workspace import stage


def write_lines(lines: DataFrame, path: str, compression: str = "none") -> None:
    lines.write.option("compression", compression).text(path)


def harvest_line(rows: DataFrame) -> DataFrame:
    """url, title, keywords and comma-joined categories, tab separated."""
    return rows.select(F.concat_ws("\t", "url", "title", "keywords", "categories").alias("value"))


def bag_line(bags: DataFrame) -> DataFrame:
    return bags.select(F.concat_ws("\t", "url", "domain", "bag").alias("value"))


def language_line(counts: DataFrame) -> DataFrame:
    key = F.concat(F.lit("0lang:"), F.col("lang"))
    return counts.select(F.concat_ws("\t", key, F.col("n").cast("string")).alias("value"))


def write_key_ordered(lines: DataFrame, key: str, path: str) -> None:
    """Text files with rows in key order inside each file and across files.

    Ranges are cut on (key, row digest, input partition), so a key with very many rows continues
    over several neighbouring files instead of filling one task.
    """
    order = [F.col(key), F.xxhash64("value"), F.col("_part")]
    (
        lines.withColumn("_part", F.spark_partition_id())
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select("value")
        .write.text(path)
    )


def labels_json(labels: DataFrame) -> DataFrame:
    """One row: the JSON list of labels, sorted."""
    return labels.agg(F.to_json(F.sort_array(F.collect_list("label"))).alias("value"))


def write_training(rows: DataFrame, path: str) -> None:
    """Quoted "tokens","klass" rows with backslash escapes."""
    rows.select("tokens", "klass").write.option("quoteAll", True).option("escape", "\\").csv(path)


def vector_line(vectors: DataFrame, number: str, name: str) -> DataFrame:
    """A line a vector (indices, values): class number, index:value pairs, and a name as comment.

    Line ends in a name become spaces; a null name is left out.
    """
    pair = lambda i, v: F.concat_ws(":", i.cast("string"), v.cast("string"))
    comment = F.concat(F.lit("# "), F.regexp_replace(F.col(name).cast("string"), r"[\r\n]", " "))
    pairs = F.zip_with("indices", "values", pair)
    number = F.col(number).cast("string")
    return vectors.select(F.concat_ws(" ", F.array(number), pairs, F.array(comment)).alias("value"))


def write_split(rows: DataFrame, path: str) -> None:
    """Lines under split=train, split=validate and split=test."""
    line = F.concat_ws("\t", "url", "title", "keywords", "categories").alias("value")
    rows.select(line, "split").write.partitionBy("split").text(path)


def model_json(priors: DataFrame, likelihoods: DataFrame) -> DataFrame:
    """One row: {classes, logPriors, logLikelihoods}."""
    by_class = F.sort_array(F.collect_list(F.struct("class_idx", "klass", "log_prior")))
    head = priors.agg(by_class.alias("c")).select(
        F.map_from_entries(
            F.transform("c", lambda e: F.struct(e["class_idx"].cast("string"), e["klass"]))
        ).alias("classes"),
        F.col("c.log_prior").alias("logPriors"),
    )
    entry = F.struct("token", "log_likelihood")
    body = likelihoods.agg(
        F.map_from_entries(F.sort_array(F.collect_list(entry))).alias("logLikelihoods")
    )
    one = F.lit(1).alias("_one")
    both = head.select("*", one).join(body.select("*", one), "_one").drop("_one")
    return both.select(
        F.to_json(F.struct("classes", "logPriors", "logLikelihoods")).alias("value")
    )


def whitelist_json(index: DataFrame) -> DataFrame:
    """One row: the JSON list of hosts, ascending."""
    return index.agg(F.to_json(F.sort_array(F.collect_set("host"))).alias("value"))


def index_json(index: DataFrame) -> DataFrame:
    """One row: the JSON object host -> categories."""
    entry = F.struct("host", "categories")
    return index.agg(
        F.to_json(F.map_from_entries(F.sort_array(F.collect_list(entry)))).alias("value")
    )


def labels_entries(labels: DataFrame) -> DataFrame:
    return labels.select(F.to_json(F.struct("label")).alias("value"))


def index_entries(index: DataFrame) -> DataFrame:
    return index.select(F.to_json(F.struct("host", "categories")).alias("value"))


def whitelist_entries(index: DataFrame) -> DataFrame:
    return index.select("host").distinct().select(F.to_json(F.struct("host")).alias("value"))


def model_entries(likelihoods: DataFrame) -> DataFrame:
    return likelihoods.select(F.to_json(F.struct("*")).alias("value"))


def json_string(text: Column) -> Column:
    quoted = F.to_json(F.array(text))
    return F.substring(quoted, F.lit(2), F.length(quoted) - 2)


def write_document(
    entries: DataFrame, path: str, opening: str, closing: str, compression: str = "none"
) -> None:
    """One JSON document of entries (key, value), in the order of their keys, which are distinct.

    Ranges of keys are written by different tasks. The opening has a line to itself in the first
    file, the closing follows the last entry, and every entry but the first begins with a comma.
    """
    entries = stage(entries.select("key", "value"), "entries")
    least, most = entries.agg(F.min("key"), F.max("key")).first()
    value = F.concat(
        F.when(F.col("key") == least, "").otherwise(","),
        F.col("value"),
        F.when(F.col("key") == most, closing).otherwise(""),
    )
    head = opening if least is not None else opening + closing
    first = entries.sparkSession.createDataFrame([(None, head)], "key STRING, value STRING")
    lines = entries.select("key", value.alias("value")).unionByName(first)
    ordered = lines.repartitionByRange("key").sortWithinPartitions("key").select("value")
    write_lines(ordered, path, compression)


def write_labels(labels: DataFrame, path: str) -> None:
    """The JSON list of labels, sorted."""
    text = labels.select(F.col("label").alias("key"), json_string(F.col("label")).alias("value"))
    write_document(text, path, "[", "]")


def write_whitelist(index: DataFrame, path: str) -> None:
    """The JSON list of hosts, ascending."""
    hosts = index.where(F.col("host").isNotNull()).select("host").distinct()
    text = hosts.select(F.col("host").alias("key"), json_string(F.col("host")).alias("value"))
    write_document(text, path, "[", "]")


def _write_map(rows: DataFrame, key: str, value: str, path: str, opening: str, closing: str) -> None:
    entry = F.concat(json_string(F.col(key)), F.lit(":"), F.to_json(value)).alias("value")
    write_document(rows.select(F.col(key).alias("key"), entry), path, opening, closing)


def write_index(index: DataFrame, path: str) -> None:
    """The JSON object host -> categories."""
    _write_map(index, "host", "categories", path, "{", "}")


def write_interests(interests: DataFrame, path: str) -> None:
    """The JSON object host -> rule -> categories."""
    _write_map(interests, "host", "rules", path, "{", "}")


def write_model(priors: DataFrame, likelihoods: DataFrame, path: str) -> None:
    """{classes, logPriors, logLikelihoods}. Classes make the opening, terms are the entries."""
    by_class = F.sort_array(F.collect_list(F.struct("class_idx", "klass", "log_prior")))
    classes = F.map_from_entries(
        F.transform("c", lambda e: F.struct(e["class_idx"].cast("string"), e["klass"]))
    ).alias("classes")
    head = priors.agg(by_class.alias("c")).select(
        F.to_json(F.struct(classes, F.col("c.log_prior").alias("logPriors")))
    )
    opening = head.first()[0][:-1] + ',"logLikelihoods":{'
    _write_map(likelihoods, "token", "log_likelihood", path, opening, "}}")
