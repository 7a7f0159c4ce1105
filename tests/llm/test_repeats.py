import random

import pytest

from gleaner.llm import repeats as R


def brute(docs, width):
    seen, out = {}, []
    order = sorted(docs, key=lambda d: (d[0] is not None, d[0] or 0))
    for doc, text in order:
        words = (text or "").encode().split()
        for i in range(len(words) - width + 1):
            seen.setdefault(tuple(words[i : i + width]), (doc, i))
    for doc, text in order:
        words = (text or "").encode().split()
        gone = set()
        for i in range(len(words) - width + 1):
            if seen[tuple(words[i : i + width])] != (doc, i):
                gone |= set(range(i, i + width))
        kept = b" ".join(w for i, w in enumerate(words) if i not in gone).decode()
        out.append((doc, len(words), len(gone), kept))
    return sorted(out, key=str)


@pytest.mark.parametrize("width", [20, 5, 40])
def test_against_brute_force(documents, width):
    rng = random.Random(width)
    line = lambda n, v=2000: " ".join(f"w{rng.randrange(v)}" for _ in range(n))
    passages = [line(rng.randint(width - 2, 70)) for _ in range(6)]
    docs = []
    for i in range(80):
        parts = [line(rng.randint(0, 30)) for _ in range(3)]
        for _ in range(rng.randint(0, 3)):
            parts.insert(rng.randrange(len(parts)), rng.choice(passages))
        docs.append((i, " ".join(parts)))
    docs += [(100 + i, docs[3][1]) for i in range(30)]  # copies
    docs += [(200, line(120, 2)), (201, "same " * 90), (202, line(150, 3)), (None, docs[5][1])]
    docs += [(203, None), (204, ""), (205, "few words")]
    found = R.remove_repeats(documents(docs), width).collect()
    assert sorted([(r.doc_id, r.n_words, r.n_removed, r.kept) for r in found], key=str) == brute(docs, width)
    for r in found:
        assert sum(b - a for a, b in zip(r.starts, r.ends)) == r.n_removed
        assert all(b - a >= width for a, b in zip(r.starts, r.ends))


def test_edges(documents, edges, nothing):
    assert R.remove_repeats(nothing).count() == 0
    got = R.remove_repeats(edges).collect()
    assert len(got) == 9
    long = next(r for r in got if r.doc_id == 5)
    assert long.n_words == 60_000 and long.n_removed == 59_999
    text = " ".join(f"w{i}" for i in range(40))
    twice = R.remove_repeats(documents([(7, text), (7, text)])).collect()
    assert [r.n_removed for r in twice] == [0, 0]  # one document, given twice


def test_texts_without_an_id_are_documents_of_their_own(documents):
    """Each row carries its own places only: the first stays whole, all others lose the passage."""
    passage = " ".join(f"p{i}" for i in range(25))
    docs = [(None, f"{' '.join(f'x{n}y{i}' for i in range(n % 7))} {passage} z{n}") for n in range(600)]
    docs += [(9, f"{passage} nine"), (9, f"other words {passage}")]
    got = R.remove_repeats(documents(docs)).collect()
    assert len(got) == len(docs)
    whole = [r for r in got if r.n_removed == 0]
    assert len(whole) == 1 and whole[0].doc_id is None and whole[0].starts == []
    for r in got:
        if r.n_removed:
            assert r.n_removed == 25 and "p0" not in r.kept.split()
