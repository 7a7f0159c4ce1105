import pytest
from pyspark.sql import functions as F

from gleaner.functions.urls import url_host
from gleaner.operators.domains import SuffixRules, with_canonical_host, with_url_outcome
from gleaner.sources import bundled_suffix_rules

# url, host, domain, outcome, canonical host
CASES = [
    ("http://nba.com/a?b#c", "nba.com", "nba.com", "OK", "nba.com"),
    ("HTTP://NBA.com/", "nba.com", "nba.com", "OK", "nba.com"),
    ("  https://user:pw@nba.com:8080/x ", "nba.com", "nba.com", "OK", "nba.com"),
    ("url:http://nba.com", "nba.com", "nba.com", "OK", "nba.com"),
    ("http://www2.nba.com/x", "www2.nba.com", "nba.com", "OK", "nba.com"),
    ("http://wwwx_1.nba.com", "wwwx_1.nba.com", "nba.com", "OK", "nba.com"),
    ("http://www.health.nba.com/", "www.health.nba.com", "nba.com", "OK", "www.health.nba.com"),
    ("http://m.nba.com/", "m.nba.com", "nba.com", "OK", "m.nba.com"),
    ("http://www.vogue.co.uk/", "www.vogue.co.uk", "vogue.co.uk", "OK", "vogue.co.uk"),
    ("http://a.b.c.ck", "a.b.c.ck", "b.c.ck", "OK", "a.b.c.ck"),
    ("http://www.ck", "www.ck", "www.ck", "OK", "www.ck"),
    ("http://x.www.ck", "x.www.ck", "www.ck", "OK", "x.www.ck"),
    ("http://www.me.blog.com", "www.me.blog.com", "me.blog.com", "OK", "me.blog.com"),
    ("http://p.q.deep.a.uk", "p.q.deep.a.uk", "p.q.deep.a.uk", "OK", "p.q.deep.a.uk"),
    ("http://a_b.com/pa th|", "a_b.com", "a_b.com", "OK", "a_b.com"),
    ("http://bücher.com/", "bücher.com", "bücher.com", "OK", "bücher.com"),
    ("http://nba.com./", "nba.com.", None, "ERR_URI_MALFORMED", None),
    ("http://x.com.x.com/", "x.com.x.com", None, "ERR_URI_MALFORMED", None),
    ("nourl", "", None, "ERR_URI_MALFORMED", None),
    ("", "", None, "ERR_URI_MALFORMED", None),
    ("gopher://nba.com", "nba.com", None, "ERR_URI_MALFORMED", None),
    ("http://nba.com:8o/", "nba.com", None, "ERR_URI_MALFORMED", None),
    ("http://1.2.3.4/", "1.2.3.4", None, "ERR_URI_ILLEGAL", None),
    ("http://[::1]:80/", "[::1]", None, "ERR_URI_ILLEGAL", None),
    ("http://-x.com/", "-x.com", None, "ERR_URI_ILLEGAL", None),
    ("http://x_.com/", "x_.com", None, "ERR_URI_ILLEGAL", None),
    ("http://a..com/", "a..com", None, "ERR_URI_ILLEGAL", None),
    ("http:///path", "", None, "ERR_URI_ILLEGAL", None),
    ("http://a@b@c.com/", "", None, "ERR_URI_ILLEGAL", None),
    ("mailto:me@nba.com", "", None, "ERR_URI_ILLEGAL", None),
    ("http://" + "a" * 64 + ".com", "a" * 64 + ".com", None, "ERR_URI_ILLEGAL", None),
    ("http://co.uk/", "co.uk", None, "ERR_URI_NO_SUFFIX", None),
    ("http://b.ck/", "b.ck", None, "ERR_URI_NO_SUFFIX", None),
    ("http://host.unknown/", "host.unknown", None, "ERR_URI_NO_SUFFIX", None),
    (None, None, None, "ERR_URI_PARSE", None),
]


@pytest.fixture(scope="module")
def urls(spark):
    return spark.createDataFrame([(c[0],) for c in CASES], "url STRING").coalesce(1)


def test_url_outcomes(urls, rules):
    rows = with_canonical_host(with_url_outcome(urls, rules)).collect()
    got = [(r.url, r.host, r.domain, r.url_outcome, r.canonical_host) for r in rows]
    assert got == CASES


def test_prefix_check_is_for_titles_only(urls, rules):
    rows = {r.url: r for r in with_url_outcome(urls, rules, check_prefix=False).collect()}
    assert rows["http://nba.com./"].domain == "nba.com"
    assert rows["http://x.com.x.com/"].domain == "x.com"


def test_salted_rules_give_the_same_rows(urls, rules):
    small = with_url_outcome(urls, rules).collect()
    rules.table.small = False
    large = with_url_outcome(urls, rules).collect()
    assert sorted(small, key=str) == sorted(large, key=str)


def test_url_host(urls):
    got = [r[0] for r in urls.select(url_host(F.col("url"))).collect()]
    assert got == [c[1] for c in CASES]


def test_bundled_rules(spark):
    rules = SuffixRules(bundled_suffix_rules(spark))
    assert rules.table.rows > 5000
    urls = [("http://www.bbc.co.uk/",), ("http://a.b.ck/",), ("http://www.ck/",), ("http://x.com",)]
    rows = with_url_outcome(spark.createDataFrame(urls, "url STRING"), rules).collect()
    domains = {r.url: r.domain for r in rows}
    assert domains == {
        "http://www.bbc.co.uk/": "bbc.co.uk",
        "http://a.b.ck/": "a.b.ck",
        "http://www.ck/": "www.ck",
        "http://x.com": "x.com",
    }
