"""Line dedup by levelled sorted runs of line hashes; built-ins only.

A line's key is the line without white space at its ends and with A-Z lower-cased. Keys of LEAST_CHARS
code points and more that an earlier document holds lose their lines; those of the first one stay.

Documents come in batches, in the order of their ids. What earlier batches hold is a set of runs:
tables of key hashes (128 bits), bucketed and sorted by hash, with the smallest doc_id of each key.
A batch is summed to one row a key, bucketed alike, and merge-anti-joined with every run: what is
left is new and becomes a run of level 0. As all of them are bucketed by hash, neither the batch nor
the runs are shuffled for that. Before a batch, a level of FANOUT runs is merged into one run of the
next, so that a batch meets a number of runs that grows with the logarithm of the batches.

Lines go whose key an older run holds, or whose document is not the first of the batch that does.
They are found by a join on the hash of only the keys that repeat, which Spark splits where a key is
hot. Documents are then read again and the lines at these places left out.

Defined results: a null or empty text is one empty line; rows without doc_id count as one document,
before all others; rows that share a doc_id are one document, each with its own text; rows equal in
doc_id and text get equal rows; a text of any length is split in its row; further columns are
ignored; an empty table gives an empty one. Rows that share a doc_id are told apart by 64 bits of
hash of their texts.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.workspace import work_path

from .common import identified, real_id, stage, table

LEAST_CHARS = 10
BATCHES = 6
FANOUT = 3
WHITE = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def key_of(line: Column) -> Column:
    """The line stripped, A-Z in lower case. `lower` does that where all is ASCII, and faster."""
    plain = F.char_length(line) == F.octet_length(line)
    lowered = F.when(plain, F.lower(line)).otherwise(F.translate(line, UPPER, LOWER))
    return F.btrim(lowered, F.lit(WHITE))


def hashed_lines(docs: DataFrame) -> DataFrame:
    """(doc_id, mark, at, h1, h2) of the lines whose keys count; mark tells texts of one id apart."""
    keys = F.transform(
        lines_of(F.col("text")), lambda line, i: F.struct(i.alias("at"), key_of(line).alias("key"))
    )
    long_ones = F.filter(keys, lambda e: F.char_length(e["key"]) >= LEAST_CHARS)
    rows = identified(docs).select(
        "doc_id", F.xxhash64("text").alias("mark"), F.explode(long_ones).alias("line")
    )
    return rows.select(
        "doc_id",
        "mark",
        F.col("line.at").alias("at"),
        F.xxhash64("line.key").alias("h1"),
        F.xxhash64(F.lit(1), "line.key").alias("h2"),
    )


class LineRuns:
    """Runs of line hashes by level, each a table bucketed and sorted by hash.

    `levels` holds the runs' table names. They are external tables in the shared folder: a cluster
    with a lasting catalog keeps them from session to session, and `levels` is all that is needed to
    go on with them.
    """

    def __init__(
        self, spark: SparkSession, levels: list[list[str]] | None = None, fanout: int = FANOUT,
        buckets: int | None = None,
    ) -> None:
        self.spark = spark
        self.levels = [list(level) for level in levels or []]
        self.fanout = fanout
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))

    def _written(self, keys: DataFrame) -> str:
        name = f"gleaner_lines_{uuid.uuid4().hex}"
        (
            keys.write.bucketBy(self.buckets, "h1", "h2")
            .sortBy("h1", "h2")
            .format("parquet")
            .option("path", work_path(self.spark, name))
            .saveAsTable(name)
        )
        return name

    def runs(self) -> list[str]:
        return [name for level in self.levels for name in level]

    def compact(self) -> None:
        """Merge every level that is full into one run of the next."""
        for at in range(len(self.levels)):
            if len(self.levels[at]) < self.fanout:
                continue
            merged = self.spark.table(self.levels[at][0])
            for name in self.levels[at][1:]:
                merged = merged.unionByName(self.spark.table(name))
            if at + 1 == len(self.levels):
                self.levels.append([])
            self.levels[at + 1].append(self._written(merged))
            self._forget(self.levels[at])
            self.levels[at] = []

    def add(self, lines: DataFrame) -> DataFrame:
        """Add a batch of hashed lines; (h1, h2, old, first) of the keys that repeat: whether an
        older run has the key, else the smallest doc_id of the batch that holds it."""
        self.compact()
        keys = lines.groupBy("h1", "h2").agg(
            F.min("doc_id").alias("first"), F.max("doc_id").alias("last")
        )
        batch = self._written(keys)
        fresh = self.spark.table(batch)
        for name in self.runs():
            fresh = fresh.join(self.spark.table(name).hint("merge"), ["h1", "h2"], "left_anti")
        added = self._written(fresh)
        kept = self.spark.table(added)
        older = self.spark.table(batch).join(kept.hint("merge"), ["h1", "h2"], "left_anti")
        within = kept.where(F.col("first") < F.col("last"))
        repeated = older.select("h1", "h2", F.lit(True).alias("old"), "first").unionByName(
            within.select("h1", "h2", F.lit(False).alias("old"), "first")
        )
        found = stage(repeated, "lines-repeated")
        self._forget([batch])
        if not self.levels:
            self.levels.append([])
        self.levels[0].append(added)
        return found

    def _forget(self, names: list[str]) -> None:
        """Out of the catalog; the files are left to the owner of the folder."""
        for name in names:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")

    def close(self) -> None:
        self._forget(self.runs())
        self.levels = []


def repeated_lines(lines: DataFrame, runs: LineRuns) -> DataFrame:
    """(doc_id, mark, at) of a batch's lines that go; the batch becomes a run."""
    gone = lines.join(runs.add(lines), ["h1", "h2"])
    return gone.where(F.col("old") | (F.col("doc_id") > F.col("first"))).select(
        "doc_id", "mark", "at"
    )


def batch_bounds(docs: DataFrame, batches: int) -> list[int]:
    """The last doc_id of all batches but the last one, about equal in rows."""
    shares = [F.lit((i + 1) / batches) for i in range(batches - 1)]
    found = docs.agg(F.percentile_approx("doc_id", F.array(*shares), F.lit(1000))).first()[0]
    return sorted(set(found or []))


def dedup_lines(docs: DataFrame, batches: int = BATCHES) -> DataFrame:
    """(doc_id, n_lines, n_dropped, kept): each text without the lines that earlier ones hold."""
    spark = docs.sparkSession
    bounds = batch_bounds(identified(docs), batches) if batches > 1 else []
    number = F.lit(0)
    for bound in bounds:
        number = number + (F.col("doc_id") > bound).cast("int")
    path = work_path(spark, "lines")
    hashed_lines(docs).withColumn("batch", number).write.partitionBy("batch").parquet(path)
    schema = "doc_id long, mark long, at int, h1 long, h2 long, batch int"
    lines = spark.read.schema(schema).parquet(path)

    runs = LineRuns(spark)
    gone = None
    for batch in range(len(bounds) + 1):
        found = repeated_lines(lines.where(F.col("batch") == batch).drop("batch"), runs)
        found = stage(found, "lines-gone")
        gone = found if gone is None else gone.unionByName(found)
    runs.close()

    places = gone.groupBy("doc_id", "mark").agg(F.collect_set("at").alias("gone"))
    rows = identified(docs).withColumn("mark", F.xxhash64("text"))
    left = rows.join(places, ["doc_id", "mark"], "left").select(
        "doc_id", "gone", "text", lines_of(F.col("text")).alias("lines")
    )
    stay = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), "gone")
    kept = F.array_join(F.transform(stay, lambda i: F.get("lines", i)), "\n")
    return left.select(
        real_id(),
        F.size("lines").cast("long").alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_dropped"),
        F.when(F.col("gone").isNull(), F.coalesce("text", F.lit(""))).otherwise(kept).alias("kept"),
    )


def query(spark: SparkSession, folder: str) -> DataFrame:
    """op11: every document without the lines that documents before it hold."""
    done = dedup_lines(table(spark, folder, "documents"))
    return done.select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept"), 256).alias("kept_sha256")
    )


ORACLE = f"""
WITH docs AS (
  SELECT row_number() OVER () AS row_id, doc_id,
    coalesce(doc_id, -9223372036854775808) AS holder,
    string_split(coalesce(text, ''), chr(10)) AS l
  FROM documents),
lines AS (
  SELECT row_id, doc_id, holder, i, l[i] AS line,
    trim(translate(l[i], '{UPPER}', '{LOWER}'),
      ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS key
  FROM (SELECT *, unnest(range(1, len(l) + 1)) AS i FROM docs)),
firsts AS (
  SELECT key, min(holder) AS first FROM lines WHERE length(key) >= {LEAST_CHARS} GROUP BY key),
judged AS (
  SELECT row_id, doc_id, i, line, coalesce(holder > first, false) AS gone
  FROM lines LEFT JOIN firsts USING (key))
SELECT any_value(doc_id) AS doc_id, count(*)::BIGINT AS n_lines,
  count(*) FILTER (gone)::BIGINT AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM judged GROUP BY row_id
"""
