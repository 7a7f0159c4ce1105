import pytest
from pyspark.sql import functions as F

from gleaner.operators import joins as J
from gleaner.operators.joins import (
    Dictionary,
    fits_broadcast,
    lookup,
    measure,
    semi_join_hot,
)


@pytest.fixture(scope="module")
def sides(spark):
    left = spark.createDataFrame(
        [("hot", i) for i in range(300)] + [(f"k{i}", i) for i in range(50)] + [(None, 1)],
        "key STRING, v INT",
    )
    right = spark.createDataFrame(
        [("hot", "h")] + [(f"k{i}", str(i)) for i in range(0, 80, 2)], "key STRING, label STRING"
    )
    return left, right


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_equals_broadcast(sides, how):
    left, right = sides
    small = lookup(left, right, ["key"], how, small=True)
    large = lookup(left, right, ["key"], how, small=False)
    assert small.columns == large.columns
    assert sorted(small.collect(), key=str) == sorted(large.collect(), key=str)


def test_other_joins_are_refused(sides):
    with pytest.raises(ValueError):
        lookup(*sides, ["key"], "full", small=True)


def test_measure_and_bounds(sides):
    _, right = sides
    rows, size = measure(right)
    assert rows == 41 and size > 41 * 16
    assert fits_broadcast(right)
    assert not fits_broadcast(right, max_rows=40)
    assert not fits_broadcast(right, max_bytes=100)
    assert not Dictionary(right, max_rows=40).small


def test_semi_join_with_hot_keys(spark, sides):
    left, right = sides
    counted = left.where("key is not null").groupBy("key").agg(F.count("*").alias("n"))
    doubled = right.union(right)
    expected = left.join(right, "key", "left_semi")
    got = semi_join_hot(left, doubled, "key", counted, rows=40)
    assert sorted(got.collect()) == sorted(expected.collect())
    # 300 rows of one key end in several tasks.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = semi_join_hot(left.repartition(8), right, "key", counted, rows=40)
        tasks = joined.where("key = 'hot'").selectExpr("spark_partition_id() p").distinct()
        assert tasks.count() > 1
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_filter_knows_all_keys_and_few_others(spark, monkeypatch):
    monkeypatch.setattr(J, "FILTER_BITS", 1 << 14)
    right = spark.range(1000).selectExpr("concat('k', id) AS key", "id").union(
        spark.createDataFrame([(None, 5)], "key STRING, id LONG"))
    left = spark.range(5000).selectExpr("IF(id = 4999, NULL, concat('k', id)) AS key", "id AS v")
    marked = {r.v: r.m for r in left.select("v", J.may_be_in(right, ["key"]).alias("m")).collect()}
    assert all(marked[v] for v in range(1000)) and marked[4999] is False
    assert sum(marked[v] for v in range(1000, 4999)) < 400
    both = left.select("v", J.may_be_in(right.select("key", "id"), ["key"]).alias("m"))
    assert "BroadcastNestedLoop" not in both._jdf.queryExecution().executedPlan().toString()
    none = right.limit(0)
    assert left.where(J.may_be_in(none, ["key"])).count() == 0


@pytest.mark.parametrize("how", ["inner", "left_semi"])
def test_only_rows_that_pass_the_filter_are_shuffled(spark, monkeypatch, how):
    monkeypatch.setattr(J, "FILTER_BITS", 1 << 16)
    left = spark.range(2000).selectExpr("concat('k', id) AS key", "repeat('x', 100) AS text")
    right = spark.range(10).selectExpr("concat('k', id) AS key", "id AS label")
    seen = left.where(J.may_be_in(right, ["key"])).count()
    assert 10 <= seen < 20
    got = lookup(left, right, ["key"], how, small=False)
    assert got.count() == 10
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "scalar-subquery" in plan


def test_left_join_leaves_payload_behind(spark, monkeypatch):
    monkeypatch.setattr(J, "FILTER_BITS", 1 << 16)
    left = spark.range(2000).selectExpr("concat('k', id) AS key", "id AS v", "'x' AS text")
    right = spark.range(10).selectExpr("concat('k', id) AS key", "id AS label")
    rows = lookup(left, right, ["key"], "left", small=False, payload=["text"]).collect()
    assert len(rows) == 2000
    assert all(r.text == "x" for r in rows if r.label is not None)
    assert 10 <= sum(r.text is not None for r in rows) < 20
    small = lookup(left, right, ["key"], "left", small=True, payload=["text"])
    assert small.where("text IS NULL").count() == 0
