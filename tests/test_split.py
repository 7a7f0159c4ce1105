import hashlib
from collections import Counter, defaultdict

import pytest

from gleaner.operators import split as S


def brute_split(rows, seed):
    groups = defaultdict(list)
    for row in rows:
        for category in row[3].split(","):
            digest = hashlib.md5("\t".join([seed, *row]).encode()).hexdigest()
            groups[category].append((digest, row))
    out = Counter()
    for category, members in groups.items():
        members.sort()
        train, validate = int(0.8 * len(members)), int(0.1 * len(members))
        for i, (_, row) in enumerate(members):
            part = "train" if i < train else "validate" if i < train + validate else "test"
            out[(*row, category, part)] += 1
    return out


def rows_of(n, copies=0, categories="a"):
    rows = [(f"u{i}", f"t{i}", "k", categories) for i in range(n)]
    return rows + [("same", "t", "k", categories)] * copies


@pytest.mark.parametrize(
    "rows",
    [
        rows_of(13),
        rows_of(1),
        rows_of(5),
        rows_of(200) + rows_of(77, categories="b,a"),
        rows_of(20, copies=300),
        rows_of(0, copies=50),
        [r for c in "abcdefgh" for r in rows_of(10, copies=7, categories=c)],
    ],
)
@pytest.mark.parametrize("bucket_hex", [1, 4])
def test_split_matches_brute_force(spark, rows, bucket_hex, monkeypatch):
    monkeypatch.setattr(S, "BUCKET_HEX", bucket_hex)
    df = spark.createDataFrame(rows, "url STRING, title STRING, keywords STRING, categories STRING")
    got = Counter(tuple(r) for r in S.stratified_split(df, seed="3").collect())
    assert got == brute_split(rows, "3")


def test_many_copies_come_out_in_blocks(spark):
    df = spark.range(45_000).selectExpr("'u' url", "'t' title", "'k' keywords", "'a' categories")
    counts = S.stratified_split(df).groupBy("split").count().collect()
    assert {r.split: r["count"] for r in counts} == {
        "train": 36_000, "validate": 4_500, "test": 4_500,
    }
