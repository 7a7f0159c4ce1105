import hashlib
import random

import duckdb
import pytest

from gleaner.llm import lines as L

WHITE = " \t\n\x0b\x0c\r"


def key(line):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line).strip(WHITE)


def brute(rows):
    """(doc_id, n_lines, n_dropped, kept) of (doc_id, text) rows."""
    place = lambda doc_id: -(2**63) if doc_id is None else doc_id
    first = {}
    for doc_id, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= L.LEAST_CHARS:
                first[key(line)] = min(first.get(key(line), 2**63), place(doc_id))
    out = []
    for doc_id, text in rows:
        split = (text or "").split("\n")
        kept = [x for x in split if first.get(key(x), 2**63) >= place(doc_id)]
        out.append((doc_id, len(split), len(split) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def random_rows(seed, n=120):
    rng = random.Random(seed)
    pool = ["short", "a longer line here", "A LONGER line here  ", "\t a longer line here", "É longer LINE here",
            "é longer line here", "exactly10!", "ninechars", "", "  ", "ſtrange Kelvin K line", "strange kelvin k line",
            "x\x0by vertical tab \x0c", "  no-break space kept"]
    pool += [f"common line number {i}" for i in range(30)]
    rows = []
    for i in range(n):
        doc_id = None if rng.random() < 0.1 else rng.randint(0, n // 2)
        rows.append((doc_id, "\n".join(rng.choice(pool) for _ in range(rng.randint(0, 8)))))
    return rows


@pytest.mark.parametrize("batches", [1, 2, 7])
def test_against_brute_force(documents, batches):
    rows = random_rows(batches)
    assert found(L.dedup_lines(documents(rows), batches)) == brute(rows)


def test_against_sql(spark, documents, tmp_path):
    path = str(tmp_path / "documents.parquet")
    documents(random_rows(5), extra=False).write.parquet(path)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{path}/*.parquet'")
    theirs = sorted(con.execute(L.ORACLE).fetchall(), key=str)
    assert found(L.query(spark, str(tmp_path))) == theirs


def test_edges(edges, edge_rows, nothing, documents):
    assert L.dedup_lines(nothing).count() == 0
    assert found(L.dedup_lines(edges)) == brute(edge_rows)
    long_one = [(1, "same line of text\n" * 50_000), (2, "same line of text\nown line of text")]
    assert found(L.dedup_lines(documents(long_one))) == brute(long_one)


def test_rows_without_id_are_one_document(documents):
    rows = [(None, f"a line that all of them share\nown line number {i}") for i in range(200)]
    rows += [(7, "a line that all of them share\nlast of all lines")]
    assert found(L.dedup_lines(documents(rows))) == brute(rows)


def test_runs_are_levelled_and_carry_on(spark, documents):
    """Batch after batch through one set of runs: a key is new once, and full levels are merged."""
    runs = L.LineRuns(spark, fanout=2, buckets=3)
    seen, depth = set(), []
    for batch in range(6):
        rows = [(batch * 10 + i, f"line {(batch * 7 + i) % 20:04d} of the batches") for i in range(10)]
        lines = L.hashed_lines(documents(rows))
        gone = {r.doc_id for r in L.repeated_lines(lines, runs).collect()}
        assert gone == {doc_id for doc_id, text in rows if text in seen}
        seen |= {text for _, text in rows}
        depth.append([len(level) for level in runs.levels])
        again = L.LineRuns(spark, runs.levels, fanout=2, buckets=3)
        assert again.runs() == runs.runs()
    assert depth == [[1], [2], [1, 1], [2, 1], [1, 0, 1], [2, 0, 1]]
    assert sum(spark.table(name).count() for name in runs.runs()) == len(seen)
    runs.close()


def test_runs_are_not_shuffled(spark, documents):
    runs = L.LineRuns(spark, buckets=int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = [(i, f"line {i:05d} of the documents") for i in range(50)]
    L.repeated_lines(L.hashed_lines(documents(rows)), runs).count()
    name = runs.runs()[0]
    met = spark.table(name).join(spark.table(name).hint("merge"), ["h1", "h2"], "left_anti")
    plan = met._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    runs.close()


def test_digest(spark, tmp_path, documents):
    path = str(tmp_path / "documents.parquet")
    documents([(1, "the same line\nx"), (2, "THE same line\ny")], extra=False).write.parquet(path)
    got = {r.doc_id: r.kept_sha256 for r in L.query(spark, str(tmp_path)).collect()}
    assert got[2] == hashlib.sha256(b"y").hexdigest()
