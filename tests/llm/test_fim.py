import hashlib
import random

import duckdb
import numpy as np
import pytest

from gleaner.llm import fim as M


def brute(doc_id, text):
    """(doc_id, n, form, prefix_chars, middle_chars, output, text)"""
    text = text or ""
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[i : i + 8], 16) for i in range(0, 32, 8))
    n = len(text)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not text or any(mark in text for mark in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return doc_id, n, "plain", None, None, text, text
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h4 % 100 < 20:
        return doc_id, n, "spm", a, b - a, f"<S>{suffix}<P>{prefix}<M>{middle}", text
    return doc_id, n, "psm", a, b - a, f"<P>{prefix}<S>{suffix}<M>{middle}", text


def random_rows(seed, n=300):
    rng = random.Random(seed)
    parts = ["<", "P", "S", "M", ">", "<P", "S>", "a", "é", "😀", "ß", " ", "\n", "\x00", "word "]
    rows = [(i, "".join(rng.choice(parts) for _ in range(rng.randint(0, 12)))) for i in range(n)]
    rows += [(n + i, text) for i, text in enumerate(("<P>", "x<S>", "<M>y", "<", "<P", ">", "<<S", "S>"))]
    return rows


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("piece", [1, 7, M.PIECE])
def test_scatter_and_gather_in_pieces(piece, monkeypatch):
    monkeypatch.setattr(M, "PIECE", piece)
    monkeypatch.setattr(M, "STEP", 4)
    rows = random_rows(3, 60)
    texts = [text.encode() for _, text in rows]
    bounds = np.concatenate(([0], np.cumsum([len(t) for t in texts]))).astype(np.int64)
    numbers = np.array([[int(hashlib.sha256(f"1:{i}".encode()).hexdigest()[8 * k : 8 * k + 8], 16)
                         for k in range(4)] for i, _ in rows])
    out, ends, count, form, prefix, middle = M.rearranged(np.frombuffer(b"".join(texts), np.uint8), bounds, numbers)
    back, again = M.put_back(out, ends, form)
    for k, (doc_id, text) in enumerate(rows):
        wanted = brute(doc_id, text)
        assert out[ends[k] : ends[k + 1]].tobytes().decode() == wanted[5]
        assert (count[k], M.FORMS[form[k]]) == wanted[1:3]
        assert form[k] == 0 or (prefix[k], middle[k]) == wanted[3:5]
        assert back[again[k] : again[k + 1]].tobytes().decode() == text


def test_against_brute_force(documents):
    rows = random_rows(1)
    done = M.restore(M.fill_in_middle(documents(rows)))
    assert found(done) == sorted((brute(*row) for row in rows), key=str)
    assert {r[2] for r in done.collect()} == set(M.FORMS)


def test_edges(edges, edge_rows, nothing, documents):
    assert M.restore(M.fill_in_middle(nothing)).count() == 0
    assert found(M.restore(M.fill_in_middle(edges))) == sorted((brute(*r) for r in edge_rows), key=str)
    long_one = [(i, "é😀x" * 400_000) for i in range(3)] + [(None, "no id"), (9, None)]
    done = M.restore(M.fill_in_middle(documents(long_one)))
    assert found(done) == sorted((brute(*r) for r in long_one), key=str)


def test_outputs_that_do_not_fit_are_refused():
    data = np.frombuffer(b"<S>a<P>b<M>c", np.uint8)
    with pytest.raises(ValueError):
        M.put_back(data, np.array([0, len(data)]), np.array([1]))
    with pytest.raises(ValueError):
        M.put_back(data[:8], np.array([0, 8]), np.array([2]))
    out, _ = M.put_back(data, np.array([0, len(data)]), np.array([2]))
    assert out.tobytes() == b"bca"


def test_against_sql(spark, documents, tmp_path):
    path = str(tmp_path / "documents.parquet")
    rows = [r for r in random_rows(8) if "\x00" not in r[1]] + [(None, "a text without id"), (5, None)]
    documents(rows, extra=False).write.parquet(path)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{path}/*.parquet'")
    theirs = sorted(con.execute(M.ORACLE).fetchall(), key=str)
    assert found(M.query(spark, str(tmp_path))) == theirs
