"""The physical plans the jobs rely on at scale."""

import pytest
from pyspark.sql import functions as F

from gleaner.operators.joins import Dictionary
from gleaner.operators.words import StopWords, token_rows, with_bag, with_token_counts
from gleaner.plans import texts as TX
from gleaner.plans import titles as TI
from gleaner.plans import training as TR


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def pages(spark, tmp_path):
    spark.createDataFrame(
        [("http://nba.com/", "{}", "text", "x")], "url STRING, metadata STRING, text STRING, other STRING"
    ).write.parquet(f"{tmp_path}/pages")
    return spark.read.parquet(f"{tmp_path}/pages")


def before_join(plan):
    """Nodes below the last category join on the page side are printed after it."""
    return plan.split("BroadcastHashJoin", 1)


def test_title_harvest_has_no_shuffle_and_one_parse(spark, pages, rules):
    index = Dictionary(spark.createDataFrame([("nba.com", ["A"])], "host STRING, categories ARRAY<STRING>"))
    plan = plan_of(TI.harvest_titles(pages.select("url", "metadata"), index, rules))
    page_side = plan.split("InMemoryRelation")[0]
    assert "Exchange hashpartitioning" not in page_side
    assert "SortMergeJoin" not in plan and "CartesianProduct" not in plan
    above, below = before_join(plan)
    # One for each level of the document.
    assert above.count("from_json") == 4 and "from_json" not in below
    assert "ReadSchema: struct<url:string,metadata:string>" in plan


def test_bags_have_no_shuffle(spark, pages, rules):
    white = Dictionary(spark.createDataFrame([("nba.com",)], "domain STRING"))
    stop = StopWords(spark.createDataFrame([("the",)], "word STRING"))
    plan = plan_of(TX.page_bags(pages.select("url", "text"), white, rules, stop))
    assert "Exchange hashpartitioning" not in plan.split("InMemoryRelation")[0]
    assert plan.count("regexp_extract_all") == 1


def test_tokens_are_made_once(spark, pages):
    stop = StopWords(spark.createDataFrame([("the",)], "word STRING"))
    counts = with_token_counts(pages.select("url", "text"), "text", stop, ["url"])
    assert plan_of(token_rows(counts.drop("text"))).count("regexp_extract_all") == 1
    assert plan_of(with_bag(pages, "text", stop, ["url"]).where("bag <> ''")).count("Exchange") == 0


def test_training_tokens_are_made_once(spark, pages):
    stop = StopWords(spark.createDataFrame([("the",)], "word STRING"))
    rows = pages.select("url", F.col("text").alias("title"), F.col("other").alias("keywords"),
                        F.lit("A").alias("categories"))
    plan = plan_of(TR.training_rows(rows, stop))
    assert plan.count("regexp_extract_all") == 3
    assert "Exchange" not in plan
