import pytest

from gleaner.operators import spellings as S
from gleaner.operators.domains import SuffixRules, with_canonical_host, with_url_outcome
from gleaner.operators.joins import Dictionary
from gleaner.plans.titles import with_categories

PAIRS = [("bücher", "xn--bcher-kva"), ("пример", "xn--e1afmkfd"), ("例え", "xn--r8jz45g"),
         ("faß", "xn--fa-hia"), ("рф", "xn--p1ai"), ("公司", "xn--55qx5d")]


@pytest.mark.parametrize("letters,ascii_form", PAIRS)
def test_labels_both_ways(letters, ascii_form):
    assert S.label_spellings(letters) == S.label_spellings(ascii_form) == (ascii_form, letters)


def test_labels_that_have_one_spelling():
    for label in ("plain", "xn--", "xn--a", "xn--bcher-KVA", "xn---", "xn--99999999999", "", "*", "xn--bücher", "a b",
                  "xn--bcher-kv!", "a\x80b", "ａｂｃ"):
        assert S.label_spellings(label) == (label, label)


def test_names_mix_spellings():
    assert S.spellings("www.bücher.рф") == sorted(
        ["www.xn--bcher-kva.рф", "www.bücher.xn--p1ai", "www.xn--bcher-kva.xn--p1ai"])
    assert S.spellings("www.plain.com") == []
    long = ".".join(["рф"] * 9)
    assert S.spellings(long) == [".".join(["xn--p1ai"] * 9)]


def test_tables_get_all_spellings(spark):
    rows = [("bücher.de", ["A"]), ("xn--bcher-kva.de", ["B"]), ("xn--p1ai", ["C"]), ("x.com", ["D"]), (None, ["E"]),
            ("пример.рф", ["G"]), ("xn--e1afmkfd.рф", ["F"])]
    df = spark.createDataFrame(rows, "host STRING, categories ARRAY<STRING>")
    got = {(r.host, tuple(r.categories)) for r in S.with_spellings(df, "host").collect()}
    assert got == {(h, tuple(c)) for h, c in rows} | {
        ("рф", ("C",)), ("пример.xn--p1ai", ("F",)), ("xn--e1afmkfd.xn--p1ai", ("F",))}
    names = df.select("host")
    assert S.with_spellings(names, "host").count() == 10
    assert S.with_spellings(df.limit(0), "host").count() == 0


@pytest.fixture(scope="module")
def idn_rules(spark):
    names = ["com", "рф", "xn--55qx5d.cn", "cn", "*.बार", "!www.xn--l1b6a9b7k"]
    other = S.label_spellings("बार")[0]
    names = [n.replace("xn--l1b6a9b7k", other) for n in names]
    return SuffixRules(spark.createDataFrame([(n,) for n in names], "rule STRING")), other


def test_rules_match_either_spelling(spark, idn_rules):
    rules, other = idn_rules
    wanted = {
        "http://www.bücher.рф/": "bücher.рф",
        "http://www.bücher.xn--p1ai/": "bücher.xn--p1ai",
        "http://www.xn--bcher-kva.рф/": "xn--bcher-kva.рф",
        "http://a.b.公司.cn": "b.公司.cn",
        "http://a.b.xn--55qx5d.cn": "b.xn--55qx5d.cn",
        "http://y.बार": None,
        "http://z.x.y.बार": "x.y.बार",
        f"http://z.x.y.{other}": f"x.y.{other}",
        "http://a.www.बार": "www.बार",
        f"http://a.www.{other}": f"www.{other}",
        "http://公司.cn": None,
    }
    urls = spark.createDataFrame([(u,) for u in wanted], "url STRING")
    got = {r.url: r.domain for r in with_url_outcome(urls, rules, check_prefix=False).collect()}
    assert got == wanted


def test_categories_meet_either_spelling(spark, idn_rules):
    rules, _ = idn_rules
    index = spark.createDataFrame(
        [("bücher.рф", ["A"]), ("xn--e1afmkfd.com", ["B"])], "host STRING, categories ARRAY<STRING>")
    urls = ["http://www.bücher.рф", "http://www.xn--bcher-kva.xn--p1ai", "http://xn--bcher-kva.рф",
            "http://www.пример.com", "http://xn--e1afmkfd.com", "http://other.com"]
    pages = spark.createDataFrame([(u,) for u in urls], "url STRING")
    found = with_categories(pages, Dictionary(S.with_spellings(index, "host")), rules)
    got = {r.url: r.categories for r in found.collect()}
    assert [got[u] for u in urls] == [["A"], ["A"], ["A"], ["B"], ["B"], None]
    plan = with_canonical_host(with_url_outcome(pages, rules))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
