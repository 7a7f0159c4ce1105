"""Harvests that grow: what new segments gave is merged into a kept state, older ones stay unread.

A state is a folder that holds tables in increments, and a log that says which increment a batch of
segments is in. Reading merges the increments in force; an aggregation that combines before the
shuffle does it, as every table's rows of one key merge in any order. An increment counts once its
row is in the log, which is written last and in one file: a job that was lost half-way leaves
nothing, and is run again under the same batch name. A batch given again replaces what it gave.

`compact` merges the newest increments into one as long as the next older one has fewer than RATIO
times their rows, so a row is rewritten about log(all rows / new rows) times, and a state of many
batches is read from few folders. A batch merged with others can no longer be replaced.

One job at a time writes to a state. Replaced and merged folders are left for the folder's owner.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.domains import SuffixRules
from ..operators.histograms import count_bucket, occurrences
from ..operators.joins import Dictionary
from ..operators.scoring import ScoreTable
from ..operators.words import StopWords, merged_bags
from . import texts, titles

#: An older increment with as many times the rows of those after it is not merged with them.
RATIO = 4
_LOG = "version BIGINT, folder STRING, n_rows BIGINT, batch STRING"


def _summed(df: DataFrame, *key: str) -> DataFrame:
    return df.groupBy(*key).agg(F.sum("n").alias("n"))


@dataclass(frozen=True)
class Table:
    """A table of a state: its columns, and how rows of several increments become one."""

    schema: str
    merge: Callable[[DataFrame], DataFrame]


COUNTERS = Table("grp STRING, name STRING, n BIGINT", lambda df: _summed(df, "grp", "name"))
TITLES = {
    "urls": Table("url STRING, n BIGINT", lambda df: _summed(df, "url")),
    "counters": COUNTERS,
}
TEXTS = {
    "bags": Table("url STRING, domain STRING, bag STRING, occurrences BIGINT", merged_bags),
    "counters": COUNTERS,
    "languages": Table("lang STRING, n BIGINT", lambda df: _summed(df, "lang")),
}


@dataclass(frozen=True)
class Increment:
    folder: str
    version: int
    rows: int
    batches: tuple[str, ...]


class State:
    """The tables of a job in a folder every executor reaches."""

    def __init__(self, spark: SparkSession, path: str, tables: dict[str, Table]):
        self.spark, self.path, self.tables = spark, path.rstrip("/"), tables

    def _log(self) -> DataFrame:
        try:
            return self.spark.read.schema(_LOG).parquet(f"{self.path}/log")
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], _LOG)

    def increments(self) -> list[Increment]:
        """Those in force, the newest first: a row a batch of segments."""
        last = self._log().groupBy("batch").agg(
            F.max(F.struct("version", "folder", "n_rows")).alias("_l")
        )
        found = last.groupBy("_l.folder", "_l.version", "_l.n_rows").agg(
            F.sort_array(F.collect_list("batch")).alias("batches")
        )
        rows = found.orderBy(F.desc("version"), "folder").collect()
        return [Increment(r.folder, r.version, r.n_rows, tuple(r.batches)) for r in rows]

    def _read(self, name: str, increments: list[Increment]) -> DataFrame:
        table = self.tables[name]
        paths = [f"{self.path}/{i.folder}/{name}" for i in increments]
        if not paths:
            return self.spark.createDataFrame([], table.schema)
        return self.spark.read.schema(table.schema).parquet(*paths)

    def table(self, name: str) -> DataFrame:
        """A table as if all batches had been one job's input."""
        return self.tables[name].merge(self._read(name, self.increments()))

    def _written(self, tables: dict[str, DataFrame], batches: tuple[str, ...]) -> None:
        folder, rows = uuid.uuid4().hex, 0
        for name, table in self.tables.items():
            path = f"{self.path}/{folder}/{name}"
            columns = self.spark.createDataFrame([], table.schema).schema
            tables[name].select(*[F.col(c.name).cast(c.dataType) for c in columns]).write.parquet(path)
            rows += self.spark.read.schema(table.schema).parquet(path).count()
        version = max([i.version for i in self.increments()], default=0) + 1
        log = self.spark.createDataFrame([(version, folder, rows, b) for b in batches], _LOG)
        log.coalesce(1).write.mode("append").parquet(f"{self.path}/log")

    def replaceable(self, batch: str) -> None:
        """Raise if the batch is merged with others."""
        for increment in self.increments():
            if batch in increment.batches and len(increment.batches) > 1:
                raise ValueError(f"batch {batch} is merged with others and cannot be replaced")

    def add(self, batch: str, tables: dict[str, DataFrame]) -> None:
        """Put in, or replace, what a batch of segments gave."""
        self.replaceable(batch)
        self._written(tables, (batch,))

    def compact(self, ratio: int = RATIO) -> None:
        """Merge the newest increments, up to one that is so much larger that it is left alone."""
        held: list[Increment] = []
        for increment in self.increments():
            if held and increment.rows >= ratio * sum(i.rows for i in held):
                break
            held.append(increment)
        if len(held) > 1:
            merged = {name: t.merge(self._read(name, held)) for name, t in self.tables.items()}
            self._written(merged, tuple(sorted(b for i in held for b in i.batches)))


def add_titles(
    state: State, batch: str, pages: DataFrame, index: Dictionary, rules: SuffixRules, out: str
) -> dict[str, str]:
    """The title job on new pages, merged into the state. Rows are in OUT, as the job writes them."""
    state.replaceable(batch)
    paths = titles.run_title_harvest(state.spark, pages, index, rules, out)
    harvested = state.spark.read.parquet(paths["titles"])
    counted = state.spark.read.parquet(paths["statistics"]).where(F.col("grp") != "url_occurrence")
    state.add(batch, {"urls": occurrences(harvested), "counters": counted})
    return paths


def title_statistics(state: State) -> DataFrame:
    """(grp, name, n) over all batches: a URL's occurrences are counted across them."""
    buckets = state.table("urls").groupBy(count_bucket(F.col("n")).alias("name")).agg(
        F.count(F.lit(1)).alias("n")
    )
    counted = state.table("counters")
    return counted.unionByName(buckets.select(F.lit("url_occurrence").alias("grp"), "name", "n"))


def add_texts(
    state: State,
    batch: str,
    pages: DataFrame,
    profiles: ScoreTable,
    whitelist: Dictionary,
    rules: SuffixRules,
    stop: StopWords,
    out: str,
    language: str = texts.LANGUAGE,
) -> dict[str, str]:
    """The text job on new pages, merged into the state. All batches take the same language."""
    state.replaceable(batch)
    paths = texts.run_text_harvest(
        state.spark, pages, profiles, whitelist, rules, stop, out, language
    )
    read = {name: state.spark.read.parquet(paths[name]) for name in ("bags", "languages", "statistics")}
    failed = (F.col("grp") == "parse") & (F.col("name") != "SUCCESS")
    counted = read["statistics"].where(failed)
    state.add(batch, {"bags": read["bags"], "languages": read["languages"], "counters": counted})
    return paths


def text_statistics(state: State) -> DataFrame:
    """(grp, name, n) over all batches: success and occurrences are those of the merged bags."""
    return state.table("counters").unionByName(texts.harvest_counts(state.table("bags")))
