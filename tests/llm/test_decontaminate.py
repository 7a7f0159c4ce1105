import random
import re

import pytest

from gleaner.llm import decontaminate as D

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items):
    windows = {}
    for item, text in items:
        w = words(text)
        size = min(10, len(w))
        for i in range(len(w) - size + 1 if w else 0):
            windows.setdefault(tuple(w[i : i + size]), set()).add(item)
    out = []
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for size in {len(k) for k in windows}:
            for i in range(len(w) - size + 1):
                if (key := tuple(w[i : i + size])) in windows:
                    hit |= set(range(i, i + size))
                    found |= {str(x) for x in windows[key] if x is not None}
        out.append((doc, len(w), len(hit), sorted(found)))
    return sorted(out, key=str)


@pytest.mark.parametrize("limit", [100_000, 40])
def test_against_brute_force(spark, documents, monkeypatch, limit):
    rng = random.Random(3)
    monkeypatch.setattr(D, "automata", lambda b, limit=limit, f=D.automata: f(b, limit))
    vocabulary = [f"w{i}" for i in range(6)] + ["É", "Wörter"]
    line = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(i, line(rng.choice([3, 8, 12, 30]))) for i in range(12)]
    items += [(20, None), (21, ""), (None, line(14)), items[0]]
    docs = [(i, line(rng.randint(0, 60))) for i in range(60)] + [(90, None), (91, items[3][1])]
    docs.append((92, f"{line(5)}, {items[3][1].upper()}! {line(5)}"))
    table = spark.createDataFrame(items, "item_id long, text string")
    got = [
        (r.doc_id, r.n_words, sum(b - a for a, b in zip(r.starts, r.ends)), r["items"])
        for r in D.contamination(documents(docs), table).collect()
    ]
    assert sorted(got, key=str) == brute(docs, items)


def test_spans_go_and_clean_documents_stay(spark, documents, edges, nothing):
    item = " ".join(f"t{i}" for i in range(12))
    table = spark.createDataFrame([(1, item)], "item_id long, text string")
    clean = " ".join(f"c{i}" for i in range(30))
    docs = documents([(1, clean), (2, f"Before, {clean}. {item.upper()} after"), (3, item), (4, None)])
    got = {r.doc_id: r.text for r in D.decontaminate(docs, table).collect()}
    assert got == {1: clean, 2: f"Before, {clean}.  after", 4: None}
    assert D.decontaminate(edges, table).count() == 9
    assert D.contamination(nothing, table).count() == 0
    empty = table.limit(0)
    assert all(not r.starts for r in D.contamination(docs, empty).collect())


def test_whole_items_go_however_short(spark, documents):
    long = " ".join(f"t{i}" for i in range(14))
    items = [(1, "What is two"), (2, "lone"), (3, long), (4, f"more {' '.join(f't{i}' for i in range(11))}")]
    table = spark.createDataFrame(items, "item_id long, text string")
    clean = " ".join(f"c{i}" for i in range(30))
    part = " ".join(f"t{i}" for i in range(1, 13))
    docs = [(1, f"{clean} what IS two? {clean}"), (2, f"{clean} is two what lone, {clean}")]
    docs += [(3, f"{clean} {long} {clean} {part} {clean}"), (4, f"{clean} two is what {clean}")]
    got = {r.doc_id: r.text for r in D.decontaminate(documents(docs), table).collect()}
    assert got[1] == f"{clean} ? {clean}" and got[2] == f"{clean} is two what , {clean}"
    assert got[3] == f"{clean}  {clean}  {clean}" and got[4] == docs[3][1]
    got = {r.doc_id: r.text for r in D.decontaminate(documents(docs), table, max_length=20).collect()}
    assert got[1] == f"{clean} ? {clean}" and got[3] == f"{clean}  {clean} {part} {clean}"
