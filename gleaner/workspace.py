"""The shared folder for written intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the folder the cluster names in spark.checkpoint.dir.

    A machine-local folder is used only in local mode with the setting unset (tests).
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        base = tempfile.mkdtemp(prefix="gleaner-")
    return f"{base.rstrip('/')}/gleaner-{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate table that several later passes read, and read it back.

    Unlike a cache it survives lost executors and cuts the lineage.
    """
    path = work_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)
