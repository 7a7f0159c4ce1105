import bz2
import json
import os

import pytest
from pyspark.sql import functions as F

from gleaner import sinks, sources
from gleaner.plans import index as I


def write(path, text, encoding="utf-8"):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(text.encode(encoding))
    return str(path)


def test_category_index(spark, tmp_path):
    path = write(tmp_path / "en-US.40.json", json.dumps({"a.com": ["X"], "b.com": ["X", "Y"]}, indent=1))
    assert path == sources.category_index_path(str(tmp_path), "en-US", "40")
    rows = {(r.host, tuple(r.categories)) for r in sources.read_category_index(spark, path).collect()}
    assert rows == {("a.com", ("X",)), ("b.com", ("X", "Y"))}
    assert sources.category_index_path("d/", "zh-CN") == "d/zh-CN.json"


def test_broken_index_fails_the_job(spark, tmp_path):
    with pytest.raises(Exception):
        sources.read_category_index(spark, write(tmp_path / "x.json", "{broken")).collect()


def test_words_strip_mark_and_line_ends(spark, tmp_path):
    path = write(tmp_path / "w.txt", "﻿aber\r\nals\r\n\r\nals \n")
    assert sorted(r.word for r in sources.read_words(spark, path).collect()) == ["aber", "als"]


def test_whitelist(spark, tmp_path):
    path = write(tmp_path / "w.json", '["b.com",\n "a.com", "b.com"]')
    assert sorted(r.domain for r in sources.read_whitelist(spark, path).collect()) == ["a.com", "b.com"]


def test_profiles(spark, tmp_path):
    for name in ("en", "de"):
        write(tmp_path / "p" / name, json.dumps({"freq": {"a": 2, " a": 1}, "n_words": [2, 1, 0], "name": name}))
    rows = sources.read_profiles(spark, str(tmp_path / "p")).collect()
    assert {(r.lang, r.ngram, r.cnt, tuple(r.n_words)) for r in rows} == {
        (n, g, c, (2, 1, 0)) for n in ("en", "de") for g, c in (("a", 2), (" a", 1))
    }


def test_suffix_rules(spark, tmp_path):
    path = write(tmp_path / "s.dat", "// comment\n\ncom\n*.ck\n!www.ck  // note\n")
    assert sorted(r.rule for r in sources.read_suffix_rules(spark, path).collect()) == [
        "!www.ck", "*.ck", "com",
    ]


def test_harvest_file(spark, tmp_path):
    lines = ["u\tt\tk\tA,B", " v\tt\t\tC \r", "short\tt\tA", "a\tb\tc\td\te", "w\tt\tk\t"]
    path = tmp_path / "h.tsv.bz2"
    path.write_bytes(bz2.compress("\n".join(lines).encode()))
    good = {tuple(r) for r in sources.read_harvest(spark, str(path)).collect()}
    assert good == {("u", "t", "k", "A,B"), ("v", "t", "", "C")}
    bad = {r.line for r in sources.read_harvest_rejects(spark, str(path)).collect()}
    assert bad == {"short\tt\tA", "a\tb\tc\td\te", "w\tt\tk"}


def test_segments(spark, tmp_path):
    listing = write(tmp_path / "list", "1\n2\n")
    for segment in "12":
        spark.sparkContext.parallelize([(f"http://{segment}", f"text {segment}")], 1).saveAsSequenceFile(
            f"{tmp_path}/segment/{segment}/textData-0"
        )
    paths = sources.segment_paths(spark, listing, f"{tmp_path}/segment/{{segment}}/textData-*")
    pages = sources.read_pages(spark, paths, "sequence", "url", "text")
    assert {tuple(r) for r in pages.collect()} == {("http://1", "text 1"), ("http://2", "text 2")}
    landed = sources.land_pages(pages, f"{tmp_path}/landed")
    again = sources.read_pages(spark, [f"{tmp_path}/landed"], "parquet", "url", "text")
    assert sorted(landed.collect()) == sorted(again.collect()) == sorted(pages.collect())


def test_training_file_is_quoted(spark, tmp_path):
    df = spark.createDataFrame([('a "q" b', "X,Y")], "tokens STRING, klass STRING")
    sinks.write_training(df, f"{tmp_path}/t")
    assert [r.value for r in spark.read.text(f"{tmp_path}/t").collect()] == ['"a \\"q\\" b","X,Y"']


def test_split_folders(spark, tmp_path):
    df = spark.createDataFrame(
        [("u", "t", "k", "A", "train"), ("v", "t", "", "A", "test")],
        "url STRING, title STRING, keywords STRING, categories STRING, split STRING",
    )
    sinks.write_split(df, f"{tmp_path}/s")
    assert [r.value for r in spark.read.text(f"{tmp_path}/s/split=test").collect()] == ["v\tt\t\tA"]


def test_key_order_with_a_hot_key(spark, tmp_path):
    rows = [("hot", f"hot {i}") for i in range(4000)] + [(f"k{i}", f"k{i}") for i in range(100)]
    df = spark.createDataFrame(rows, "url STRING, value STRING")
    # Small ranges would otherwise be merged into one file.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    sinks.write_key_ordered(df, "url", f"{tmp_path}/o")
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    read = spark.read.text(f"{tmp_path}/o").select("value", F.input_file_name().alias("f"))
    files = {}
    for r in read.collect():
        files.setdefault(r.f, []).append(r.value.split()[0])
    assert sum(map(len, files.values())) == len(rows)
    assert all(keys == sorted(keys) for keys in files.values())
    assert sum("hot" in keys for keys in files.values()) > 1


def test_index_documents(spark, tmp_path):
    nested = write(tmp_path / "i.json", json.dumps(
        {"b.com": {"__ANY": ["X", "Y"], "p": ["Z"]}, "a.com": {"__ANY": ["X"]}}))
    index = I.build_index(sources.read_interests(spark, nested))
    assert json.loads(sinks.index_json(index).first()[0]) == {"a.com": ["X"], "b.com": ["X", "Y"]}
    assert json.loads(sinks.whitelist_json(index).first()[0]) == ["a.com", "b.com"]
    assert [r.host for r in I.sorted_whitelist(index).collect()] == ["a.com", "b.com"]


def test_model_document(spark):
    priors = spark.createDataFrame([(1, "b", -2.0), (0, "a", -1.0)],
                                   "class_idx INT, klass STRING, log_prior DOUBLE")
    terms = spark.createDataFrame([("t", [-3.0, -4.0])], "token STRING, log_likelihood ARRAY<DOUBLE>")
    assert json.loads(sinks.model_json(priors, terms).first()[0]) == {
        "classes": {"0": "a", "1": "b"}, "logPriors": [-1.0, -2.0],
        "logLikelihoods": {"t": [-3.0, -4.0]},
    }


def test_entries_have_no_limit(spark):
    index = spark.range(3).selectExpr("concat('h', id) AS host", "array('X') AS categories")
    assert {json.loads(r[0])["host"] for r in sinks.index_entries(index).collect()} == {"h0", "h1", "h2"}
    assert sinks.whitelist_entries(index.union(index)).count() == 3
    labels = spark.createDataFrame([("a",)], "label STRING")
    assert sinks.labels_entries(labels).first()[0] == '{"label":"a"}'


def whole(spark, path):
    """The part files, in the order of their names, as one text."""
    files = sorted(f for f in os.listdir(path) if f.startswith("part-"))
    return "".join(open(os.path.join(path, f), encoding="utf-8").read() for f in files), len(files)


def test_documents_of_several_files(spark, tmp_path):
    rows = [(f"h{i}.com", ["X", f'q"{i}\\']) for i in range(500)] + [("é,{}[].com", [])]
    index = spark.createDataFrame(rows, "host STRING, categories ARRAY<STRING>").repartition(5)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sinks.write_index(index, f"{tmp_path}/index")
        sinks.write_whitelist(index.union(index), f"{tmp_path}/white")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    text, files = whole(spark, f"{tmp_path}/index")
    assert files > 1 and json.loads(text) == dict(rows)
    assert list(json.loads(text)) == sorted(h for h, _ in rows)
    back = {(r.host, tuple(r.categories)) for r in sources.read_category_index(spark, f"{tmp_path}/index").collect()}
    assert back == {(h, tuple(c)) for h, c in rows}
    assert json.loads(whole(spark, f"{tmp_path}/white")[0]) == sorted(h for h, _ in rows)
    assert sources.read_whitelist(spark, f"{tmp_path}/white").count() == 501
    nested = index.selectExpr("host", "map('__ANY', categories, 'p', array('Z')) AS rules")
    sinks.write_interests(nested, f"{tmp_path}/nested")
    read = sources.read_interests(spark, f"{tmp_path}/nested").collect()
    assert {r.host: r.rules for r in read} == {h: {"__ANY": c, "p": ["Z"]} for h, c in rows}


def test_empty_and_single_documents(spark, tmp_path):
    index = spark.createDataFrame([("a.com", ["X"])], "host STRING, categories ARRAY<STRING>")
    for name, rows in (("none", index.limit(0)), ("one", index)):
        sinks.write_index(rows, f"{tmp_path}/{name}")
        assert json.loads(whole(spark, f"{tmp_path}/{name}")[0]) == {r.host: r.categories for r in rows.collect()}
        assert sources.read_category_index(spark, f"{tmp_path}/{name}").count() == rows.count()
        sinks.write_labels(rows.selectExpr("host AS label"), f"{tmp_path}/{name}-labels")
        assert sources.read_labels(spark, f"{tmp_path}/{name}-labels").count() == rows.count()


def test_other_forms_of_an_index(spark, tmp_path):
    want = {"a.com": ["X"], "b.com": ["X", "Y"]}
    forms = {"one line": json.dumps(want), "indented": json.dumps(want, indent=2),
             "an entry a line": '{"a.com": ["X"],\n"b.com": ["X", "Y"]}\n',
             "lines": "".join(json.dumps({"host": h, "categories": c}) + "\n" for h, c in want.items())}
    for name, text in forms.items():
        path = write(tmp_path / f"{name}.json", text)
        assert {r.host: r.categories for r in sources.read_category_index(spark, path).collect()} == want, name
    for name, text in (("a", '["b.com", "a.com"]'), ("b", '["b.com",\n"a.com"\n]'), ("c", '{"host":"b.com"}\n{"host":"a.com"}')):
        path = write(tmp_path / f"white-{name}.json", text)
        assert {r.domain for r in sources.read_whitelist(spark, path).collect()} == {"a.com", "b.com"}, name


def test_model_of_several_files(spark, tmp_path):
    priors = spark.createDataFrame([(1, "b", -2.0), (0, 'a"', -1.0)], "class_idx INT, klass STRING, log_prior DOUBLE")
    terms = [(f"t{i}", [-float(i), -4.5]) for i in range(300)]
    rows = spark.createDataFrame(terms, "token STRING, log_likelihood ARRAY<DOUBLE>")
    sinks.write_model(priors, rows, f"{tmp_path}/m")
    document = json.loads(whole(spark, f"{tmp_path}/m")[0])
    assert document == {"classes": {"0": 'a"', "1": "b"}, "logPriors": [-1.0, -2.0], "logLikelihoods": dict(terms)}
    classes, back = sources.read_model(spark, f"{tmp_path}/m")
    assert sorted(map(tuple, classes.collect())) == [(0, 'a"', -1.0), (1, "b", -2.0)]
    assert {r.token: r.log_likelihood for r in back.collect()} == dict(terms)
