import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rules(spark):
    from gleaner.operators.domains import SuffixRules

    names = ["com", "uk", "co.uk", "ck", "*.ck", "!www.ck", "blog.com", "*.deep.a.uk"]
    return SuffixRules(spark.createDataFrame([(n,) for n in names], "rule STRING"))
