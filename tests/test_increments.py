import random
from collections import Counter

import pytest

from gleaner.plans import increments as IN

BAGS = "url STRING, domain STRING, bag STRING, occurrences BIGINT"
COUNTS = "grp STRING, name STRING, n BIGINT"


def given(spark, bags, counts=(), languages=()):
    return {
        "bags": spark.createDataFrame(list(bags), BAGS),
        "counters": spark.createDataFrame(list(counts), COUNTS),
        "languages": spark.createDataFrame(list(languages), "lang STRING, n BIGINT"),
    }


def rows(df, *columns):
    return sorted(map(tuple, df.select(*columns).collect()))


def brute_bags(bags):
    best, n = {}, Counter()
    for url, domain, bag, count in bags:
        best[url] = max(best.get(url, (-1, "", "")), (len(bag.encode()), bag, domain))
        n[url] += count
    return sorted((url, b[2], b[1], n[url]) for url, b in best.items())


def test_merged_batches_are_one_harvest(spark, tmp_path):
    rng = random.Random(3)
    state = IN.State(spark, str(tmp_path / "s"), IN.TEXTS)
    every, counts = [], Counter()
    for b in range(6):
        bags = [(f"u{u}", f"d{rng.randrange(2)}", rng.choice(["a:1", "é:1", "b:1", "a:1 b:2", ""]),
                 rng.randint(1, 4)) for u in rng.sample(range(12), 7)]
        errors = [("parse", rng.choice("XY"), rng.randint(1, 5))]
        counts.update({errors[0][:2]: errors[0][2]})
        state.add(f"b{b}", given(spark, bags, errors, [("en", b)]))
        every += bags
        if b in (2, 4):
            before = rows(state.table("bags"), "url", "domain", "bag", "occurrences")
            state.compact()
            assert rows(state.table("bags"), "url", "domain", "bag", "occurrences") == before
    assert rows(state.table("bags"), "url", "domain", "bag", "occurrences") == brute_bags(every)
    assert rows(state.table("languages"), "lang", "n") == [("en", 15)]
    found = {(g, n): k for g, n, k in rows(IN.text_statistics(state), "grp", "name", "n")}
    assert {k: v for k, v in found.items() if k[1] in "XY"} == dict(counts)
    assert found["parse", "SUCCESS"] == len({b[0] for b in every})


def test_a_batch_given_again_replaces_itself(spark, tmp_path):
    state = IN.State(spark, str(tmp_path / "s"), IN.TEXTS)
    state.add("a", given(spark, [("u", "d", "x:1", 1)]))
    state.add("b", given(spark, [("u", "d", "y:1 z:1", 5)]))
    state.add("a", given(spark, [("u", "d", "xx:1", 2), ("v", "d", "x:1", 1)]))
    assert rows(state.table("bags"), "url", "bag", "occurrences") == [("u", "y:1 z:1", 7), ("v", "x:1", 1)]
    # Another session sees the same.
    again = IN.State(spark, str(tmp_path / "s") + "/", IN.TEXTS)
    again.compact()
    assert [i.batches for i in state.increments()] == [("a", "b")]
    with pytest.raises(ValueError, match="merged"):
        state.add("b", given(spark, []))
    assert rows(state.table("bags"), "url", "occurrences") == [("u", 7), ("v", 1)]


def test_an_increment_without_its_log_row_does_not_count(spark, tmp_path):
    state = IN.State(spark, str(tmp_path / "s"), IN.TEXTS)
    state.add("a", given(spark, [("u", "d", "x:1", 1)]))
    given(spark, [("u", "d", "x:1", 1)])["bags"].write.parquet(str(tmp_path / "s/lost/bags"))
    assert rows(state.table("bags"), "url", "occurrences") == [("u", 1)]


def test_large_increments_are_left_alone(spark, tmp_path):
    state = IN.State(spark, str(tmp_path / "s"), IN.TEXTS)
    state.add("large", given(spark, [(f"u{i}", "d", "x:1", 1) for i in range(100)]))
    for b in ("p", "q"):
        state.add(b, given(spark, [(f"{b}{i}", "d", "x:1", 1) for i in range(5)]))
    state.compact()
    assert [i.batches for i in state.increments()] == [("p", "q"), ("large",)]
    assert state.table("bags").count() == 110


def test_empty_states_and_batches(spark, tmp_path):
    state = IN.State(spark, str(tmp_path / "s"), IN.TITLES)
    state.compact()
    assert state.increments() == [] and IN.title_statistics(state).count() == 0
    none = {"urls": spark.createDataFrame([], "url STRING, n BIGINT"),
            "counters": spark.createDataFrame([], COUNTS)}
    state.add("a", none)
    state.add("b", none | {"urls": spark.createDataFrame([("u", 2), (None, 1)], "url STRING, n BIGINT")})
    state.compact()
    assert rows(IN.title_statistics(state), "name", "n") == [("ONE", 1), ("TWO", 1)]
