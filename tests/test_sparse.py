import math
import random

from pyspark.sql import functions as F

from gleaner import sources
from gleaner.operators import sparse as SP
from gleaner.operators import vectors as V
from gleaner.plans import training as TR

SCHEMA = "url STRING, klass STRING, terms ARRAY<STRUCT<token: STRING, n: BIGINT>>"


def test_numbers_are_dense_and_in_order(spark):
    words = [f"w{i:03}" for i in range(300)] + [None]
    random.Random(1).shuffle(words)
    df = spark.createDataFrame([(w, i) for i, w in enumerate(words)], "w STRING, x INT").repartition(7)
    got = {r.w: r.no for r in SP.numbered(df, "w", "no").collect()}
    order = sorted(words, key=lambda w: (w is not None, w or ""))
    assert got == {w: i + 1 for i, w in enumerate(order)}
    assert SP.numbered(df.limit(0), "w", "no", 0).count() == 0


def given(spark):
    rng = random.Random(2)
    rows = []
    for i in range(40):
        tokens = rng.sample("abcdefgh", rng.randint(0, 5))
        rows.append((f"http://u{i} # {i}", rng.choice("PQ"), [(t, rng.randint(1, 4)) for t in tokens]))
    rows += [rows[0]] * 3 + [(None, None, [("a", 1)]), ("none", "P", []), ("unknown", "P", [("zz", 1)])]
    rows.append(("line\nend", "Q", [("b", 2)]))
    return rows, spark.createDataFrame(rows, SCHEMA).repartition(3)


def test_vectors_through_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(SP, "COPIES", 2)  # copies are written in rounds
    rows, df = given(spark)
    df.write.parquet(str(tmp_path / "in"))
    instances = spark.read.parquet(str(tmp_path / "in"))
    one_letter = F.filter("terms", lambda t: F.length(t["token"]) == 1)
    counts = V.count_terms(instances.withColumn("terms", one_letter))
    vocab = V.vocabulary(counts, 100)
    idf = {r.term: r.idf for r in vocab.df.collect()}
    paths = TR.export_vectors(instances, vocab, str(tmp_path / "out"))
    terms = {r["index"]: r.term for r in spark.read.parquet(paths["terms"]).collect()}
    classes = {r.number: r.klass for r in spark.read.parquet(paths["classes"]).collect()}
    assert [terms[i + 1] for i in range(len(terms))] == sorted(idf)
    got = []
    for r in sources.read_vectors(spark, paths["vectors"]).collect():
        assert list(r["indices"]) == sorted(set(r["indices"]))
        weights = {terms[i]: round(v, 9) for i, v in zip(r["indices"], r["values"], strict=True)}
        got.append((r["name"], classes.get(r["number"]), sorted(weights.items())))
    want = [
        (url and url.replace("\n", " "), klass,
         sorted((t, round(math.log1p(n) * idf[t], 9)) for t, n in terms_ if t in idf))
        for url, klass, terms_ in rows
    ]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_a_dictionary_that_is_not_broadcast_gives_the_same(spark):
    _, df = given(spark)
    terms = SP.Dictionary(spark.createDataFrame([(t, 1.0 + i, i + 1) for i, t in enumerate("abcd")],
                                                "term STRING, idf DOUBLE, index BIGINT"))
    rows = lambda: sorted(map(repr, SP.sparse_vectors(df, terms).collect()))
    small = rows()
    terms.small = False
    assert rows() == small


def test_no_instances(spark, tmp_path):
    _, df = given(spark)
    df.limit(0).write.parquet(str(tmp_path / "in"))
    instances = spark.read.parquet(str(tmp_path / "in"))
    paths = TR.export_vectors(instances, V.vocabulary(V.count_terms(instances), 5), str(tmp_path / "out"))
    assert sources.read_vectors(spark, paths["vectors"]).count() == 0


def test_unknown_terms_are_not_grouped(spark):
    _, df = given(spark)
    terms = SP.Dictionary(spark.createDataFrame([("a", 1.0, 1)], "term STRING, idf DOUBLE, index BIGINT"))
    plan = SP.sparse_vectors(df, terms)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join Inner" in plan and "LeftOuter" not in plan
