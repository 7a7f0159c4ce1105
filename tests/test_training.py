import re
from collections import Counter, defaultdict
from math import log

import pytest
from pyspark.sql import functions as F

from gleaner.functions import text as X
from gleaner.operators import bayes as B
from gleaner.operators import vectors as V
from gleaner.operators.words import StopWords
from gleaner.plans import training as TR

SCHEMA = "url STRING, title STRING, keywords STRING, categories STRING"


@pytest.fixture
def stop(spark):
    return StopWords(spark.createDataFrame([("http",), ("with",)], "word STRING"))


def brute_tokens(text):
    lowered = "".join(c.lower() if c.isascii() else c for c in text)
    tokens = re.sub("[^a-z0-9 ]+", " ", lowered).split()
    return [t for t in tokens if t not in ("http", "with") and re.search("[a-z]", t) and len(t) > 3]


def test_training_tokens(spark, stop):
    rows = [
        ("http://x.com/Abc-Long99_word", "With 12345 a1b2 Kelvin caféteria", "k\\ey word", "A,B"),
        ("http://x.y/", "1 2", "", "A"),
        ("http://digits.com/" + "9" * 20_000, "t", "", "C"),
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    got = [(r.url, r.tokens, r.klass) for r in TR.training_rows(df, stop).collect()]
    expected = []
    for url, title, keywords, categories in rows:
        tokens = " ".join(brute_tokens(url) + brute_tokens(title) + brute_tokens(keywords))
        expected += [(url, tokens, c) for c in categories.split(",") if tokens]
    assert got == expected
    assert got[0][1] == "long99 word a1b2 elvin teria word"


def test_raw_region_keeps_titles(spark, stop):
    df = spark.createDataFrame([("http://long.cn/", "标\\题 x", "键", "A")], SCHEMA)
    assert TR.training_rows(df, stop, "zh-CN").first().tokens == "long 标题 x 键"


def test_labels(spark):
    df = spark.createDataFrame([("u", "t", "k", "A,B"), ("u", "t", "k", "B")], SCHEMA)
    assert {r.label for r in TR.labels(df).collect()} == {"A", "B"}


# A small corpus with copies of a document, a page of two classes and one without known terms.
DOCS = (
    [(f"u{i}", f"apple pear fruit{i % 3} sweet", "food") for i in range(12)]
    + [(f"v{i}", f"ball goal team{i % 4} sweet ball", "sport") for i in range(9)]
    + [("copy", "apple ball team1", "sport,food")] * 4
    + [("odd", "zebra", "food")]
    + [(f"w{i}", f"train plane hotel{i} goal", "travel") for i in range(5)]
)
SIZE = 6


def brute_instances():
    return [(u, t.split(), k) for u, t, c in DOCS for k in c.split(",")]


def brute_vocabulary(size=SIZE):
    rows = brute_instances()
    total = Counter(t for _, ts, _ in rows for t in ts)
    df = Counter(t for _, ts, _ in rows for t in set(ts))
    cut = sorted(total.values(), reverse=True)[:size][-1]
    return {t: log(len(rows) / df[t]) for t in total if total[t] >= cut}


def brute_weights(tokens, idf):
    return {t: log(1 + n) * idf[t] for t, n in Counter(tokens).items() if t in idf}


def brute_fit(rows, idf, classes):
    counts = Counter(k for _, _, k in rows)
    sums = defaultdict(Counter)
    for _, tokens, k in rows:
        for t, w in brute_weights(tokens, idf).items():
            sums[k][t] += w
    prior = {k: log((counts[k] + 1) / (len(rows) + len(classes))) for k in classes}
    like = {
        k: {t: log((sums[k][t] + 1) / (sum(sums[k].values()) + len(idf))) for t in idf}
        for k in classes
    }
    return prior, like


def brute_predict(tokens, idf, model):
    prior, like = model
    scores = {
        k: round(prior[k] + sum(w * like[k][t] for t, w in brute_weights(tokens, idf).items()), 6)
        for k in prior
    }
    return min(scores, key=lambda k: (-scores[k], k))


@pytest.fixture(scope="module")
def classifier(spark):
    pages = spark.createDataFrame(DOCS, "url STRING, tokens STRING, categories STRING")
    return TR.train_classifier(pages, SIZE, folds=3)


def test_vocabulary_keeps_ties(classifier):
    got = {r.term: r.idf for r in classifier.vocabulary.df.collect()}
    assert got == pytest.approx(brute_vocabulary())
    assert len(got) >= SIZE


def test_tfidf(classifier):
    rows = V.tfidf(classifier.instances.select("url", "klass", "terms"), classifier.vocabulary)
    got = Counter((r.url, r.klass, r.term, round(r.weight, 9)) for r in rows.collect())
    idf = brute_vocabulary()
    assert got == Counter(
        (u, k, t, round(w, 9)) for u, ts, k in brute_instances()
        for t, w in brute_weights(ts, idf).items()
    )


def test_model(classifier):
    classes = sorted({k for _, _, k in brute_instances()})
    idf = brute_vocabulary()
    prior, like = brute_fit(brute_instances(), idf, classes)
    got = classifier.priors().orderBy("class_idx").collect()
    assert [r.klass for r in got] == classes
    assert [r.log_prior for r in got] == pytest.approx([prior[k] for k in classes])
    table = {r.token: list(r.log_likelihood) for r in classifier.likelihoods().collect()}
    assert set(table) == set(idf)
    for term, values in table.items():
        assert values == pytest.approx([like[k][term] for k in classes])


def test_predictions(classifier):
    classes = sorted({k for _, _, k in brute_instances()})
    idf = brute_vocabulary()
    model = brute_fit(brute_instances(), idf, classes)
    got = Counter()
    for r in classifier.predict().collect():
        got[(r.url, r.klass, r.prediction)] += r.copies
    assert got == Counter(
        (u, k, brute_predict(ts, idf, model)) for u, ts, k in brute_instances()
    )


def test_cross_validation_equals_refitting(classifier):
    folds = {r.url: r.fold for r in classifier.instances.select("url", "fold").collect()}
    classes = sorted({k for _, _, k in brute_instances()})
    idf = brute_vocabulary()
    expected = Counter()
    for fold in set(folds.values()):
        rest = [r for r in brute_instances() if folds[r[0]] != fold]
        model = brute_fit(rest, idf, classes)
        for u, ts, k in brute_instances():
            if folds[u] == fold:
                expected[(u, k, fold, brute_predict(ts, idf, model))] += 1
    got = Counter()
    predicted = classifier.cross_validate()
    for r in predicted.collect():
        got[(r.url, r.klass, r.fold, r.prediction)] += r.copies
    assert got == expected
    summary = B.accuracy(B.confusion(predicted)).first()
    assert summary.instances == len(brute_instances())
    assert summary.correct == sum(n for (_, k, _, p), n in expected.items() if k == p)


def test_counts_agree_with_the_ml_library(spark, classifier):
    """With plain counts as weights the parameters are those of the built-in estimator."""
    from pyspark.ml.classification import NaiveBayes
    from pyspark.ml.feature import CountVectorizer, StringIndexer

    training = spark.createDataFrame(
        [(ts, k) for _, ts, k in brute_instances()], "words ARRAY<STRING>, klass STRING"
    )
    counted = CountVectorizer(inputCol="words", outputCol="features").fit(training)
    indexed = StringIndexer(inputCol="klass", outputCol="label", stringOrderType="alphabetAsc")
    rows = counted.transform(indexed.fit(training).transform(training))
    theirs = NaiveBayes(modelType="multinomial", smoothing=1.0).fit(rows)
    assert list(theirs.pi) == pytest.approx(
        [r.log_prior for r in classifier.priors().orderBy("class_idx").collect()]
    )


def test_sizes_share_one_pass(spark, classifier):
    pages = spark.createDataFrame(DOCS, "url STRING, tokens STRING, categories STRING")
    both = TR.train_classifier(pages, (3, SIZE), folds=3)
    alone = {3: TR.train_classifier(pages, 3, folds=3), SIZE: classifier}
    for size, model in alone.items():
        for name in ("likelihoods", "predict", "cross_validate", "vectors"):
            got = getattr(both, name)().where(F.col("size") == size)
            assert sorted(map(str, got.collect())) == sorted(map(str, getattr(model, name)().collect()))


def test_three_thousand_classes(spark):
    pages = spark.createDataFrame(
        [(f"u{i}", f"common word{i % 3000}", f"c{i % 3000:04}") for i in range(6000)],
        "url STRING, tokens STRING, categories STRING",
    )
    model = TR.train_classifier(pages, 4000, folds=2)
    assert model.priors().count() == 3000
    assert B.accuracy(B.confusion(model.predict())).first().accuracy == 1.0
    assert len(model.likelihoods().first().log_likelihood) == 3000


def test_class_metrics(spark):
    matrix = spark.createDataFrame(
        [(5, "a", "a", 6), (5, "a", "b", 2), (5, "b", "a", 3), (5, "c", "c", 0)],
        "size INT, klass STRING, prediction STRING, n BIGINT",
    )
    got = {r.klass: (r.precision, r.recall, r.f1) for r in B.class_metrics(matrix).collect()}
    assert got["a"] == pytest.approx((6 / 9, 6 / 8, 12 / 17))
    assert got["b"] == (0.0, 0.0, 0.0) and got["c"] == (0.0, 0.0, 0.0)


def test_null_fields_do_not_lose_a_document(spark, stop):
    df = spark.createDataFrame([("http://long.com/", None, "keyword", "A")], SCHEMA)
    assert TR.training_rows(df, stop).first().tokens == "long keyword"
    assert TR.training_rows(df, stop, "zh-CN").first().tokens == "long  keyword"


def test_tokenizer_of_unsegmented_text(spark, stop):
    df = spark.createDataFrame([("http://long.cn/", "汉字词典x 标 word", "键", "A")], SCHEMA)
    got = TR.training_rows(df, stop, "zh-CN", X.han_bigrams).first().tokens
    assert got == "long 汉字 字词 词典 标 word 键"


def test_normalized_lengths(spark, classifier):
    """Copies of an instance keep the length of one."""
    instances = classifier.instances.select("url", "klass", "terms")
    rows = V.tfidf(instances, classifier.vocabulary, normalize=True).collect()
    copies = Counter((r.url, r.klass, r.term) for r in rows)
    squares = defaultdict(float)
    for r in rows:
        squares[r.url, r.klass] += r.weight**2 / copies[r.url, r.klass, r.term]
    lengths = [v**0.5 for v in squares.values()]
    assert copies["copy", "food", "apple"] == 4
    assert max(lengths) == pytest.approx(min(lengths))


def test_training_tokens_of_nothing(spark):
    rows = [("Ab1c 9999 ABCD", ["ab1c", "abcd"]), ("a b", []), ("", []), (None, None)]
    df = spark.createDataFrame([r[:1] for r in rows], "t STRING").coalesce(1)
    assert [r[0] for r in df.select(X.training_tokens(F.col("t"))).collect()] == [r[1] for r in rows]


def test_run_lengths(spark):
    rows = [["b", "a", "b"], [], ["a"], None, ["c"] * 5 + ["a", "b"]]
    df = spark.createDataFrame([(r,) for r in rows], "t ARRAY<STRING>").coalesce(1)
    got = [r[0] if r[0] is None else [tuple(p) for p in r[0]] for r in df.select(X.run_lengths(F.col("t"))).collect()]
    assert got == [None if r is None else sorted(Counter(r).items()) for r in rows]


def test_sizes_are_summed_side_by_side(spark):
    from gleaner.operators import scoring as SC

    rows = [
        (doc, float(t + 1), t % 2, total, 0.5 * t, None if t == 1 else 1.0 * t, 2.0 * t)
        for doc in range(3) for t, total in enumerate((9, 5, 5, 2, 1))
    ] + [(7, 1.0, 0, 1, 1.0, 1.0, 1.0)]
    met = spark.createDataFrame(
        rows, "doc INT, weight DOUBLE, block INT, total BIGINT, known DOUBLE, s0 DOUBLE, s1 DOUBLE")
    sizes = [(1, 9, 1), (3, 5, 3), (4, 2, 4)]
    want = SC.class_parts(V.with_sizes(met, sizes).drop("terms"), ["size", "doc"], 2)
    got = SC.class_parts_by_size(met, ["doc"], 2, sizes)
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.select(*got.columns).collect()))
    # A term's row meets the sums once, not once a size.
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate") < plan.index("Aggregate") and plan.count("Generate") == 1


def test_rows_differ_in_which_field_is_null(spark):
    rows = [("a", None, [("t", 1)]), (None, "a", [("t", 1)]), ("a", None, []), ("a", None, None),
            (None, "a", [("t", 1)]), ("a", None, [("t", 2)])]
    df = spark.createDataFrame(rows, "url STRING, klass STRING, terms ARRAY<STRUCT<token: STRING, n: BIGINT>>")
    assert df.select(V.row_id(df.columns).alias("i")).distinct().count() == 5


def test_lengths_meet_instances_not_their_terms(spark):
    df = spark.createDataFrame([("u", "A", [("t", 1), ("v", 2)]), ("w", "B", [("t", 3)])],
                               "url STRING, klass STRING, terms ARRAY<STRUCT<token: STRING, n: BIGINT>>")
    rows = V.tfidf(df, V.vocabulary(V.count_terms(df), 10), normalize=True)
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    # The terms are taken apart above the join with the lengths.
    assert plan.index("Generate inline") < plan.index("_id#") and "to_json" not in plan
