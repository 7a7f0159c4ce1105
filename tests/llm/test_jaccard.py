import random

import numpy as np
import pytest

from gleaner.llm import jaccard as J


def shingles(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(len(words) - 4, 1))} if words else set()


def brute(docs):
    sets = [(d, shingles(t)) for d, t in docs]
    label = {d: d for d, _ in sets}

    def root(d):
        while label[d] != d:
            d = label[d]
        return d

    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            if x and y and 100 * len(x & y) >= 75 * len(x | y):
                low, high = sorted((root(a), root(b)))
                label[high] = low
    return sorted((d, len(s), root(d)) for d, s in sets)


def edited(rng, text, rate):
    words = text.split()
    return " ".join(f"e{rng.randrange(10**6)}" if rng.random() < rate else w for w in words)


@pytest.mark.parametrize(("seed", "common"), [(1, 40), (2, 3), (3, 1)])
def test_against_brute_force(documents, monkeypatch, seed, common):
    monkeypatch.setattr(J, "COMMON", common)
    rng = random.Random(seed)
    line = lambda n: " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))
    shared = [line(25), line(60)]
    docs = []
    for i in range(60):
        base = " ".join([line(rng.choice([1, 2, 5, 6, 9, 30, 90, 200])), rng.choice([*shared, "", ""])])
        docs.append((len(docs), base))
        for _ in range(rng.choice([0, 0, 1, 3])):
            docs.append((len(docs), edited(rng, base, rng.choice([0.0, 0.01, 0.02, 0.04, 0.06]))))
    chain = line(120)
    for _ in range(15):  # each near the next, the ends far apart
        chain = edited(rng, chain, 0.02)
        docs.append((len(docs), chain))
    docs += [(1000 + i, "Equal text in some rows") for i in range(9)]
    docs += [(2000, "a b"), (2001, "A B"), (2002, None), (2003, ""), (2004, " ".join("ab" * 50))]
    rng.shuffle(docs)
    got = J.join_near(documents(docs)).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == brute(docs)


def test_parities_bound_the_difference():
    rng = np.random.default_rng(1)
    for _ in range(300):
        both = rng.integers(0, 2**63, rng.integers(1, 300)).astype(np.uint64)
        x = np.unique(np.append(both, rng.integers(0, 2**63, rng.integers(0, 60)).astype(np.uint64)))
        y = np.unique(np.append(both, rng.integers(0, 2**63, rng.integers(0, 400)).astype(np.uint64)))
        p = J.parities(np.concatenate((x, y)), np.array([len(x), len(y)]))
        assert J.parity_apart(*p) <= len(np.setxor1d(x, y))


def test_edges(edges, nothing, documents):
    assert J.join_near(nothing).count() == 0
    assert J.join_near(edges).count() == 9
    kept = J.one_of_each(documents([(3, "x y"), (1, "X y"), (1, "X y"), (2, None), (None, "other")]))
    assert sorted([r.doc_id for r in kept.collect()], key=str) == [1, 2, None]


def kept(documents, rows):
    return sorted(((r.doc_id, r.text) for r in J.one_of_each(documents(rows)).collect()), key=str)


def test_unlike_texts_of_one_doc_id_stay(documents):
    one, two, three = ("alpha beta gamma", "other words here", "a third text")
    assert kept(documents, [(None, one), (None, two), (None, three), (None, "")]) == sorted(
        [(None, one), (None, two), (None, three), (None, "")], key=str
    )
    assert kept(documents, [(None, one), (None, two), (5, one)]) == [(None, one), (None, two)]
    assert kept(documents, [(1, one), (5, one), (5, two)]) == [(1, one), (5, two)]
    assert kept(documents, [(7, one), (7, one), (7, None), (7, None), (7, " \n")]) == sorted(
        [(7, one), (7, None), (7, None), (7, " \n")], key=str
    )


def test_repeated_and_null_ids_lose_no_class(documents):
    rng = random.Random(7)
    line = lambda n: " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))
    rows = []
    for _ in range(40):
        base = line(rng.choice([3, 20, 80]))
        for _ in range(rng.choice([1, 1, 2, 4])):
            rows.append((rng.choice([None, *range(15)]), edited(rng, base, rng.choice([0, 0.02]))))
    sets = [(i, t) for i, (_, t) in enumerate(rows)]
    root = {i: c for i, _, c in brute(sets)}
    got = J.one_of_each(documents(rows)).collect()
    groups = {}
    for i, (d, t) in enumerate(rows):
        groups.setdefault(root[i], []).append((-1 if d is None else d, t))
    left = {}
    for r in got:
        d = -1 if r.doc_id is None else r.doc_id
        own = [g for g, members in groups.items() if (d, r.text) in members]
        assert len(own) == 1 and d == min(groups[own[0]])[0]
        left[own[0]] = left.get(own[0], 0) + 1
    assert left == dict.fromkeys(groups, 1)


def test_rows_of_one_doc_id_have_one_component(documents):
    rows = [(1, "t one"), (5, "t one"), (5, "t two"), (9, "t two"), (5, None), (8, "t three")]
    got = J.join_near(documents(rows)).collect()
    assert {r.doc_id: r.component_id for r in got} == {1: 1, 5: 1, 9: 1, 8: 8}
    assert all(r.component_id == (8 if r.doc_id == 8 else 1) for r in got)


def test_short_parities_never_differ_more_than_the_sets():
    rng = np.random.default_rng(5)
    for _ in range(200):
        sets = [np.unique(rng.integers(0, 400, rng.integers(0, 300)).astype(np.uint64)) for _ in range(2)]
        sizes = np.array([len(x) for x in sets])
        short = J.short_parities(np.concatenate(sets), sizes)
        apart = int(np.bitwise_count((short[0] ^ short[1]).view(np.uint64)).sum())
        assert apart <= len(np.setxor1d(*sets))
        assert (len(np.setxor1d(*sets)) - apart) % 2 == 0
