import json

import pytest
from pyspark.sql import functions as F

from gleaner.operators.joins import Dictionary
from gleaner.plans import titles as TI


def page(status=200, title="T", kind="html-doc", tags=None, **extra):
    content = {"title": title, "type": kind}
    if tags is not None:
        content["meta_tags"] = tags
    return json.dumps({"http_result": status, "content": content, **extra})


# metadata, outcome, title, keywords
CASES = [
    (None, "DATA_NO_JSON", "", ""),
    ("", "DATA_NO_JSON", "", ""),
    (" ", "DATA_NO_JSON", "", ""),
    ("{}", "HTTP_UNDEFINED", "", ""),
    ('{"http_result":302}', "HTTP_NOT_2XX", "", ""),
    ('{"http_result":200}', "PAGE_TYPE", "", ""),
    ('{"http_result":200, "content": {"title": ""}}', "PAGE_TYPE", "", ""),
    ('{"http_result":200, "content": {"title": " "}}', "PAGE_TYPE", "", ""),
    (page(title="AwesomeTitle"), "SUCCESS", "AwesomeTitle", ""),
    (
        page(title="AwesomeTitle", tags=[{"name": "keywords", "content": "AwesomeKeywords"}]),
        "SUCCESS", "AwesomeTitle", "AwesomeKeywords",
    ),
    ("not json", "DATA_BAD_JSON", "", ""),
    ("5", "DATA_BAD_JSON", "", ""),
    ("[]", "DATA_BAD_JSON", "", ""),
    ('{"http_result":302', "DATA_BAD_JSON", "", ""),
    (page(title=" "), "PAGE_NO_TITLE", "", ""),
    (page(title=None), "PAGE_NO_TITLE", "", ""),
    (page(kind="pdf"), "PAGE_TYPE", "T", ""),
    (page(status=199), "HTTP_NOT_2XX", "T", ""),
    (page(status=299), "SUCCESS", "T", ""),
    (page(status=300), "HTTP_NOT_2XX", "T", ""),
    (page(title=" A \n\t b "), "SUCCESS", "A b", ""),
    (
        page(tags=[{"name": "keywords", "content": "a"}, {"content": " b  c ", "name": "keywords"},
                   {"name": "keywords"}, {"name": "Keywords", "content": "x"}]),
        "SUCCESS", "T", "b c",
    ),
    (page(links=[{"name": "keywords", "content": "no"}]), "SUCCESS", "T", ""),
]


@pytest.fixture(scope="module")
def index(spark):
    entries = [("nba.com", ["Sport", "Ball"]), ("b.com", ["Food"]), ("none.com", [])]
    return Dictionary(spark.createDataFrame(entries, "host STRING, categories ARRAY<STRING>"))


def test_metadata_cases(spark, index, rules):
    rows = [(i, "http://www.nba.com/", c[0]) for i, c in enumerate(CASES)]
    pages = spark.createDataFrame(rows, "id INT, url STRING, metadata STRING")
    got = {r.id: r for r in TI.evaluate_pages(pages, index, rules).collect()}
    for i, (metadata, outcome, title, keywords) in enumerate(CASES):
        assert (got[i].outcome, got[i].title, got[i].keywords) == (outcome, title, keywords), metadata


def crawl(spark):
    rows = [("http://nba.com/1", c[0]) for c in CASES]
    rows += [("http://b.com/", page(tags=[{"name": "keywords", "content": "k"}]))] * 7
    rows += [("http://none.com/", page()), ("http://other.com/", page()), ("nourl", page())]
    rows += [("http://1.2.3.4/", page()), (None, page()), ("http://x.zz/", page())]
    rows += [("http://b.com/s", page(status=s)) for s in (100, 404, 503, None)]
    return spark.createDataFrame(rows, "url STRING, metadata STRING")


STATISTICS = {
    ("parse", "ERR_URI_MALFORMED"): 1, ("parse", "ERR_URI_ILLEGAL"): 1,
    ("parse", "ERR_URI_PARSE"): 1, ("parse", "ERR_URI_NO_SUFFIX"): 1,
    ("parse", "PAGE_NO_CATEGORY"): 2, ("parse", "DATA_NO_JSON"): 3, ("parse", "DATA_BAD_JSON"): 4,
    ("parse", "PAGE_NO_TITLE"): 2, ("parse", "PAGE_NO_KEYWORDS"): 4, ("parse", "SUCCESS"): 13,
    ("http", "INFO_1XX"): 2, ("http", "SUCCESS_2XX"): 19, ("http", "REDIRECTION_3XX"): 2,
    ("http", "ERROR_4XX"): 1, ("http", "ERROR_5XX"): 1, ("http", "UNDEFINED"): 2,
    ("page_type", "html-doc"): 15, ("page_type", "pdf"): 1, ("page_type", "undefined"): 3,
    ("categories", "ONE"): 7, ("categories", "TWO"): 6,
    ("url_occurrence", "MORE"): 2,
}


def statistics(df):
    return {(r.grp, r.name): r.n for r in df.collect()}


def test_statistics(spark, index, rules):
    evaluated = TI.evaluate_pages(crawl(spark), index, rules)
    assert statistics(TI.harvest_statistics(evaluated)) == STATISTICS


def test_every_page_has_one_outcome(spark, index, rules):
    pages = crawl(spark)
    counts = TI.evaluate_pages(pages, index, rules).groupBy("outcome").count().collect()
    assert sum(r["count"] for r in counts) == pages.count()
    assert all(r.outcome for r in counts)


def test_job_writes_what_the_parts_compute(spark, index, rules, tmp_path):
    paths = TI.run_title_harvest(spark, crawl(spark), index, rules, str(tmp_path / "out"))
    assert statistics(spark.read.parquet(paths["statistics"])) == STATISTICS
    lines = sorted(r.value for r in spark.read.text(paths["titles_tsv"]).collect())
    direct = TI.harvest_titles(crawl(spark), index, rules)
    expected = direct.select(
        F.concat_ws("\t", "url", "title", "keywords", F.array_join("categories", ","))
    )
    assert lines == sorted(r[0] for r in expected.collect())
    assert len(lines) == 13


def test_large_index_gives_the_same_rows(spark, index, rules):
    small = sorted(TI.harvest_titles(crawl(spark), index, rules).collect(), key=str)
    index.small = False
    large = sorted(TI.harvest_titles(crawl(spark), index, rules).collect(), key=str)
    index.small = True
    assert small == large
