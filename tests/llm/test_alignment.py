import hashlib
import random
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from gleaner.llm import alignment as G
from gleaner.llm import pieces

FOLDER = pieces.FOLDER.removeprefix("file://")


@pytest.fixture(scope="module")
def pair(spark):
    return G.load_pair(spark, pieces.model_path(spark, G.MODEL_A), pieces.model_path(spark))


@pytest.fixture(scope="module")
def models():
    a = Tokenizer.from_file(f"{FOLDER}/{G.MODEL_A}")
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=f"{FOLDER}/{pieces.MODEL}")


def groups_of(text, models):
    """[([A ids], [B ids])], token by token."""
    if not text:
        return []
    a, b = models
    letters = G.byte_letters()
    name = {i: t for t, i in a.get_vocab().items()}
    ids_a = a.encode(" " + text, add_special_tokens=False).ids
    ids_b = b.encode(text)
    spelt_a = [bytes(letters[c] for c in name[i]) for i in ids_a]
    spelt_b = []
    for i in ids_b:
        piece = b.id_to_piece(i)
        spelt_b.append(bytes([int(piece[3:5], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode())
    whole = (" " + text).encode()
    if b"".join(spelt_a) != whole or b"".join(spelt_b) != whole:
        return []
    out, at_a, at_b, i, j, own_a, own_b = [], 0, 0, 0, 0, [], []
    while i < len(ids_a) or j < len(ids_b):
        if at_a <= at_b:
            at_a += len(spelt_a[i])
            own_a.append(ids_a[i])
            i += 1
        else:
            at_b += len(spelt_b[j])
            own_b.append(ids_b[j])
            j += 1
        if at_a == at_b:
            out.append((own_a, own_b))
            own_a, own_b = [], []
    return out


def brute(rows, models):
    found = [groups_of(text, models) for _, text in rows]
    links = [Counter((x, y) for a, b in groups for x in a for y in b) for groups in found]
    documents = Counter(p for counted in links for p in counted)
    most = {}
    for (x, _), n in documents.items():
        most[x] = max(n, most.get(x, 0))
    out = []
    for (doc_id, _), groups, counted in zip(rows, found, links, strict=True):
        name = ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in groups)
        out.append((
            doc_id, sum(len(a) for a, _ in groups), sum(len(b) for _, b in groups), len(groups),
            sum(counted.values()), sum(n for p, n in counted.items() if documents[p] == most[p[0]]),
            sum(n * documents[p] for p, n in counted.items()),
            hashlib.sha256(name.encode()).hexdigest() if name else "",
        ))
    pairs = {(x, y, n, n == most[x]) for (x, y), n in documents.items()}
    return sorted(out, key=str), pairs


def random_rows(seed, n=80):
    rng = random.Random(seed)
    parts = ["the ", "language", " models", "\n\n", "  ", "     ", "é", "ç", "😀", "<|endoftext|>", "<s>", "▁", "日本語",
             "12345", "don't", "...", "\t", "\x00", "a", "aaaaaaaa", "Donaudampf", " ", " \n ", " "]
    return [(i, "".join(rng.choice(parts) for _ in range(rng.randint(0, 25)))) for i in range(n)]


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_against_brute_force(documents, pair, models):
    rows = random_rows(1) + [(5, "the same row"), (5, "the same row"), (None, "no id"), (None, None)]
    done, counted = G.align(documents(rows), pair)
    wanted, pairs = brute(rows, models)
    assert found(done) == wanted
    assert {tuple(r) for r in G.pair_table(counted).collect()} == pairs


def test_in_small_parts(documents, pair, models, monkeypatch):
    """Many blocks, pieces, slices and merges give the same."""
    work = G._encoded_block

    def in_threes(texts, ids, block, pair):
        for i in range(0, len(texts), 3):
            yield from work(texts[i : i + 3], ids.slice(i, 3), block * 1000 + i, pair)

    monkeypatch.setattr(G, "_encoded_block", in_threes)
    monkeypatch.setattr(G, "slices_of", lambda spark: 3)
    rows = random_rows(2, 60)
    done, counted = G.align(documents(rows), pair)
    wanted, pairs = brute(rows, models)
    assert found(done) == wanted
    assert {tuple(r) for r in G.pair_table(counted).collect()} == pairs


def test_edges(edges, edge_rows, nothing, pair, models):
    assert G.align(nothing, pair)[0].count() == 0
    assert found(G.align(edges, pair)[0]) == brute(edge_rows, models)[0]


def test_groups(documents, pair, models):
    rows = random_rows(4, 20) + [(99, None)]
    got = {r.doc_id: r.groups for r in G.aligned_groups(documents(rows), pair).collect()}
    for doc_id, text in rows:
        groups = groups_of(text, models)
        assert got[doc_id] == ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in groups)


@pytest.mark.parametrize("end", ["", "x", " x"])
def test_long_white_space(pair, models, end):
    for run in (" " * 9000, "\n \t" * 3000, "　" * 5000):
        text = " word" + run + end
        assert pair.encode_a(text) == models[0].encode(text, add_special_tokens=False).ids


def test_links_in_parts(pair, monkeypatch):
    texts = [text.encode() for _, text in random_rows(6, 40)]
    whole = G.Aligned(texts, pair).records()
    for size in (1, 2, 5):
        monkeypatch.setattr(G, "LINKS", size)
        for mine, theirs in zip(G.Aligned(texts, pair).records(), whole, strict=True):
            assert np.array_equal(mine, theirs)


def test_merge_of_runs():
    rng = np.random.default_rng(3)
    for _ in range(200):
        runs, wanted = [], Counter()
        for _ in range(rng.integers(0, 6)):
            keys = np.unique(rng.integers(0, 40, rng.integers(0, 20)))
            counts = rng.integers(1, 9, len(keys))
            wanted.update(dict(zip(keys.tolist(), counts.tolist(), strict=True)))
            cuts = sorted(rng.integers(0, len(keys) + 1, 3))
            bounds = list(zip([0, *cuts], [*cuts, len(keys)], strict=True))
            runs.append([(keys[a:b], counts[a:b]) for a, b in bounds if a < b])
        parts = list(G.merge_runs(runs))
        merged = [(k, c) for keys, counts in parts for k, c in zip(keys.tolist(), counts.tolist(), strict=True)]
        assert merged == sorted(wanted.items())


def test_packing():
    for top in (0, 255, 256, 70_000, 1 << 40):
        values = [np.array([], np.int64), np.array([0, top, 3, top], np.int64)]
        back = G.unpacked(G.packed(*values))
        assert all(np.array_equal(a, b) for a, b in zip(values, back, strict=True))


def test_models_that_do_not_fit():
    with pytest.raises(ValueError):
        G.read_byte_level(b'{"model": {"type": "WordPiece"}, "pre_tokenizer": null}')
