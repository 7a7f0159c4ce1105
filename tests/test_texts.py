import re
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gleaner.functions import text as X
from gleaner.operators.joins import Dictionary
from gleaner.operators.words import StopWords, longest_bag, with_bag
from gleaner.plans import texts as TX


def words(spark, *names, **options):
    return StopWords(spark.createDataFrame([(n,) for n in names], "word STRING"), **options)


def brute_tokens(text):
    out = []
    for run in re.split(r"[^\w']|_", text):
        run = re.sub(r"^[^a-zA-Zé]+|[^a-zA-Zé]+$", "", run)
        if run:
            out.append(run.lower())
    return out


def brute_bag(text, stop=()):
    counts = Counter(t for t in brute_tokens(text) if t not in stop)
    return " ".join(f"{t}:{n}" for t, n in sorted(counts.items(), key=lambda e: e[0].encode()))


def bags(spark, texts, stop):
    df = spark.createDataFrame(list(enumerate(texts)), "id INT, text STRING")
    return [r.bag for r in with_bag(df, "text", stop, ["id"]).orderBy("id").collect()]


def test_tokens(spark):
    got = bags(spark, ["Don't 1up 'tis 2013 café2 x_y don't", "the and", ""], words(spark, "the", "and"))
    assert got == ["café:1 don't:2 tis:1 up:1 x:1 y:1", "", ""]


@settings(max_examples=5, deadline=None)
@given(texts=st.lists(st.text("abBcé'1 _-\n", max_size=60), min_size=30, max_size=60))
def test_bags_match_brute_force(spark, texts):
    assert bags(spark, texts, words(spark, "a", "bb")) == [brute_bag(t, ("a", "bb")) for t in texts]


def test_long_stop_list_is_joined(spark):
    texts = ["a b c a", "b", "", "z a z", "a b c a"]
    inline = bags(spark, texts, words(spark, "a", "b"))
    joined = words(spark, "a", "b", inline_limit=1)
    assert not joined.inline
    assert bags(spark, texts, joined) == inline
    joined.table.small = False
    assert bags(spark, texts, joined) == inline


def test_cleaning_its_own_tokens_changes_nothing(spark):
    df = spark.createDataFrame([("Some words, it's 4 tests' sake x1y",)], "text STRING")
    once = X.clean_tokens(F.col("text"))
    row = df.select(once.alias("a"), X.clean_tokens(F.array_join(once, " ")).alias("b")).first()
    assert row.a == row.b


def test_longest_bag(spark):
    rows = [("u", "d", "a"), ("u", "d", "bb"), ("u", "d", "cc"), ("v", "e", "é"), ("v", "e", "x"),
            ("w", "f", "")]
    df = spark.createDataFrame(rows, "url STRING, domain STRING, bag STRING")
    got = {tuple(r) for r in longest_bag(df).collect()}
    assert got == {("u", "d", "cc", 3), ("v", "e", "é", 2), ("w", "f", "", 1)}


@pytest.fixture
def pages(spark):
    rows = [
        ("http://www.nba.com/1", "the dogs", "en"),
        ("http://www.nba.com/1", "the dogs run and the dogs sleep", "en"),
        ("http://www.nba.com/1", "the dogs run and the dogs sleep", "en"),
        ("http://www.nba.com/1", "sehr viele lange deutsche worte sind hier zu sehen", "de"),
        ("http://nba.com/2", "the", "en"),
        ("http://x.co.uk/", "the cats", "en"),
        ("http://1.2.3.4/", "the cats and dogs", "en"),
        ("http://1.2.3.4/", "und die katzen", "de"),
        ("http://nba.com/3", "123 456", None),
    ]
    return spark.createDataFrame(rows, "url STRING, text STRING, lang STRING")


EXPECTED = {
    ("http://www.nba.com/1", "nba.com", "and:1 dogs:2 run:1 sleep:1", 3),
    ("http://nba.com/2", "nba.com", "", 1),
}


def test_labelled_harvest(spark, pages, rules):
    white = Dictionary(spark.createDataFrame([("nba.com",)], "domain STRING"))
    got = TX.harvest_labelled_texts(pages, white, rules, words(spark, "the"))
    assert {tuple(r) for r in got.collect()} == EXPECTED


def test_text_job(spark, pages, rules, tmp_path):
    from gleaner.operators.language import build_profiles, profile_table

    white = Dictionary(spark.createDataFrame([("nba.com",)], "domain STRING"))
    profiles = profile_table(build_profiles(pages.where("lang is not null")))
    paths = TX.run_text_harvest(
        spark, pages.drop("lang"), profiles, white, rules, words(spark, "the"),
        str(tmp_path / "out"),
    )
    assert {tuple(r) for r in spark.read.parquet(paths["bags"]).collect()} == EXPECTED
    lines = {r.value for r in spark.read.text(paths["languages_tsv"]).collect()}
    assert lines == {"0lang:en\t6", "0lang:de\t2"}
    stats = {(r.grp, r.name): r.n for r in spark.read.parquet(paths["statistics"]).collect()}
    assert stats == {
        ("parse", "ERR_LANG_DETECT"): 1,
        ("parse", "ERR_URI_ILLEGAL"): 1,
        ("parse", "SUCCESS"): 2,
        ("url_occurrence", "THREE"): 1,
        ("url_occurrence", "ONE"): 1,
    }
    assert "http://nba.com/2\tnba.com\t" in {
        r.value for r in spark.read.text(paths["bags_tsv"]).collect()
    }
