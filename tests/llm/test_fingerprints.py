import hashlib
import random

import pytest
from pyspark.sql import functions as F

from gleaner.llm import fingerprints as P


def shingles(text):
    words = (text or "").split()
    return {tuple(words[i : i + 5]) for i in range(max(len(words) - 4, 1))} if words else set()


def near(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def test_estimates_and_merging(spark):
    rng = random.Random(2)
    line = lambda n: " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))
    common = line(900)
    rows = [(1, f"{common} {line(300)}", common), (2, line(40), line(20)), (3, "", None), (4, "a", "a")]
    df = spark.createDataFrame(rows, "id int, x string, y string")
    a, b = P.sketch(F.col("x")), P.sketch(F.col("y"))
    got = df.select(
        "id", "x", "y", P.resemblance(a, b).alias("near"), P.containment(b, a).alias("inside"),
        P.distinct_shingles(a).alias("n"),
    ).collect()
    for r in got:
        x, y = shingles(r.x), shingles(r.y)
        assert r.near == pytest.approx(near(x, y), abs=0.13)
        assert r.n == pytest.approx(len(x), rel=0.25)
        if y:
            assert r.inside == pytest.approx(len(x & y) / len(y), abs=0.2)
    parts = spark.createDataFrame([(i % 2, line(30)) for i in range(60)] + [(0, "")], "k int, t string")
    sketches = parts.select("k", P.sketch(F.col("t")).alias("s"))
    merged = {r.k: r.s for r in P.merged_by(sketches, ["k"], "s").collect()}
    for k in (0, 1):
        every = sorted({h for r in sketches.where(f"k = {k}").collect() for h in r.s})
        assert merged[k] == every[: P.K]


def test_next_documents(documents, nothing):
    docs = [(5, "e " * 9), (3, "c d"), (9, "i j k l m n"), (None, "none at all"), (7, None), (1, "ß€")]
    frame = documents(docs)
    order = sorted(docs, key=lambda d: -(d[0] if d[0] is not None else -(2**63)))
    following = dict(zip([d[0] for d in order], [d[1] for d in order[1:] + order[:1]], strict=True))
    rows = P.with_next(frame).collect()
    assert len(rows) == len(docs)
    for r in rows:
        own = None if r.doc_id == -(2**63) else r.doc_id
        wanted = (following[own] or "")[: len(r.text) // 2]
        assert r.next_text == wanted
    assert P.with_next(nothing).count() == 0
    alone = P.with_next(documents([(1, "a b c d"), (1, "a b c d")])).collect()
    assert [r.next_text for r in alone] == ["a b", "a b"]


def test_equal_texts_have_equal_fingerprints(edges):
    rows = P.fingerprints(edges).collect()
    assert len(rows) == 9
    assert len({tuple(r.sketch) for r in rows if r.doc_id == 4}) == 1
    assert hashlib.sha256(b"").hexdigest() == edges.select(F.sha2(F.lit(""), 256)).first()[0]
