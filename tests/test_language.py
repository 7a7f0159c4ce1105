import unicodedata
from collections import Counter, defaultdict
from math import log

import pytest
from pyspark.sql import functions as F

from gleaner.functions import ngrams as G
from gleaner.operators import language as L


def brute_words(text):
    word = ""
    for c in text + " ":
        if unicodedata.category(c)[0] in "LM":
            word += c
        elif word:
            yield word
            word = ""


def brute_grams(text):
    grams = Counter()
    for word in brute_words(text):
        padded = f" {word} "
        for n in (1, 2, 3):
            for i in range(len(padded) - n + 1):
                gram = padded[i : i + n]
                before = padded[max(i + n - 2, 0) : i + n]
                if gram == " " or (len(before) == 2 and before.isupper() and " " not in before):
                    continue
                grams[gram] += 1
    return grams


TEXTS = [
    (1, "The cat sat on the mat with NASA and a dog.", "en"),
    (2, "Die Katze saß auf der Matte mit dem Hund, a b.", "de"),
    (3, "And the dogs ran over THE hill", "en"),
    (4, "Und der Hund lief über den Hügel", "de"),
]


@pytest.fixture(scope="module")
def texts(spark):
    return spark.createDataFrame(TEXTS, "id INT, text STRING, lang STRING")


def brute_profiles():
    out = defaultdict(Counter)
    for _, text, lang in TEXTS:
        out[lang] += brute_grams(text)
    return out


def test_profiles(texts):
    rows = L.build_profiles(texts).collect()
    expected = brute_profiles()
    assert {(r.lang, r.ngram): r.cnt for r in rows} == {
        (lang, g): n for lang, grams in expected.items() for g, n in grams.items()
    }
    for r in rows:
        totals = [sum(n for g, n in expected[r.lang].items() if len(g) == k) for k in (1, 2, 3)]
        assert list(r.n_words) == totals


def test_detection_matches_brute_force(spark, texts):
    profiles = brute_profiles()
    totals = {
        (lang, k): sum(n for g, n in grams.items() if len(g) == k)
        for lang, grams in profiles.items()
        for k in (1, 2, 3)
    }
    known = set().union(*profiles.values())

    def detect(text):
        scores = {}
        for lang in sorted(profiles):
            found = [
                n * log(profiles[lang][g] / totals[lang, len(g)] + 0.5 / 10_000)
                for g, n in brute_grams(text).items()
                if g in known
            ]
            if not found:
                return None
            scores[lang] = round(sum(found), 6)
        return min(scores, key=lambda s: (-scores[s], s))

    unseen = ["the hill and the cat", "der Hügel und die Katze", "12 34 !", "", "жжж", "NASA",
              "das cat und the Katze on dem mat", "a", "The cat sat", "The cat sat"]
    docs = spark.createDataFrame(list(enumerate(unseen)), "id INT, text STRING")
    table = L.profile_table(L.build_profiles(texts))
    got = {r.id: r.lang for r in L.detect_language(docs, table, ["id"]).collect()}
    assert got == {i: detect(t) for i, t in enumerate(unseen)}


def test_copies_are_counted_and_do_not_change_the_language(spark, texts):
    docs = spark.createDataFrame([("the hill",)] * 5 + [("der Hund",)] * 2, "text STRING")
    table = L.profile_table(L.build_profiles(texts))
    found = L.detect_language(docs, table, ["text"])
    assert {(r.text, r.copies, r.lang) for r in found.collect()} == {
        ("the hill", 5, "en"), ("der Hund", 2, "de"),
    }
    assert {(r.lang, r.n) for r in L.language_counts(found).collect()} == {("en", 5), ("de", 2)}


def test_large_profile_table_gives_the_same_languages(texts):
    table = L.profile_table(L.build_profiles(texts))
    small = sorted(L.detect_language(texts, table, ["id"]).collect())
    table.table.small = False
    assert sorted(L.detect_language(texts, table, ["id"]).collect()) == small


def test_scripts_are_folded(spark):
    df = spark.createDataFrame([("ひらカナ한글 abc",)], "text STRING")
    assert df.select(G.fold_scripts(F.col("text"))).first()[0] == "ああアア가가 abc"


def test_long_word(spark):
    df = spark.createDataFrame([("x" * 50_000,)], "w STRING")
    assert df.select(F.size(G.word_windows(F.col("w")))).first()[0] == 50_001


def test_ranges_hold_all_folded_characters(spark):
    points = spark.range(0x110000).where("id not between 55296 and 57343 and id > 0")
    # Spelt out in UTF-32, as chr() knows Latin-1 only.
    char = F.decode(F.unhex(F.lpad(F.hex("id"), 8, "0")), "UTF-32").alias("c")
    chars = points.select(char)
    script = "[" + "".join(G.FOLDED_SCRIPTS) + "]"
    folded = chars.where(F.col("c").rlike(script))
    assert folded.count() > 10_000
    assert folded.where(~F.col("c").rlike(G._NEAR_FOLDED)).count() == 0
    assert folded.where(G.fold_scripts(F.col("c")).isin("あ", "ア", "가", "ㄅ")).count() == folded.count()


def test_frequent_words_are_not_counted_in_their_row(texts):
    table = L.profile_table(L.build_profiles(texts))
    plan = L.detect_language(texts, table, ["id"])._jdf.queryExecution().optimizedPlan().toString()
    assert "sort_array" not in plan
