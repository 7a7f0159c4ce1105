import random
import time

import numpy as np
import pytest
import sentencepiece

from gleaner.llm import pieces as P

PATH = "/opt/tokenizers/" + P.MODEL


@pytest.fixture(scope="module")
def model(spark):
    return P.load_model(spark, P.model_path(spark))


def test_ids_are_the_librarys(model):
    library = sentencepiece.SentencePieceProcessor(model_file=PATH)
    encoder = P.Encoder(P.Vocabulary.of(model))
    rng = random.Random(5)
    alphabet = "abcdefghij the ing returns  é ñ ß 日本語の 😀\n\t\x00--==//**123.,!" + "".join(map(chr, range(33, 127)))
    texts = ["", " ", "   ", "a", " a ", "=" * 70, " " * 40, "x" * 300]
    texts += ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 120))) for _ in range(1500)]
    check(encoder, library, model, texts)


def check(encoder, library, model, texts):
    ids, counts = encoder.encode([t.encode() for t in texts])
    back = P.Spelling(P.decode_table(model)).texts(ids, counts).to_pylist()
    at = 0
    for text, count, own in zip(texts, counts.tolist(), back, strict=True):
        mine, at = ids[at : at + count].tolist(), at + count
        assert mine == library.encode(text), text
        assert own == text


def test_few_remembered_pairs_and_words(model, monkeypatch):
    """Pairs that share a slot, and a store of words that is emptied, change nothing."""
    monkeypatch.setattr(P, "MET_PAIRS", 16)
    monkeypatch.setattr(P, "KNOWN_WORDS", 50)
    library = sentencepiece.SentencePieceProcessor(model_file=PATH)
    encoder = P.Encoder(P.Vocabulary.of(model))
    rng = random.Random(6)
    for _ in range(4):
        texts = ["".join(rng.choice("aeiou nstr the ing") for _ in range(rng.randint(0, 60))) for _ in range(60)]
        check(encoder, library, model, texts)


def test_long_unbroken_runs(model):
    library = sentencepiece.SentencePieceProcessor(model_file=PATH)
    encoder = P.Encoder(P.Vocabulary.of(model))
    rng = random.Random(7)
    texts = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(n)) for n in (500, 513, 700, 9000)]
    texts += ["=" * 5000, "x" * 3000 + " y", "é" * 2000, "ab" * 4000]
    check(encoder, library, model, texts)
    start = time.process_time()
    encoder.encode(["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(100_000)).encode()])
    assert time.process_time() - start < 10


def test_one_pass_gives_the_same(model, documents):
    rows = documents([(i, f"some text {i} é \n  " * (i % 7)) for i in range(50)] + [(None, None)])
    once = sorted(tuple(r) for r in P.recode(rows, model).fillna(-1).collect())
    assert once == sorted(tuple(r) for r in P.decode(P.encode(rows, model), model).fillna(-1).collect())


def test_decoding_odd_ids(spark, model):
    own = [t for t, _, _ in model].index("a")
    rows = [(1, None), (2, []), (3, [0x61 + 3]), (4, [0xFF + 3, own]), (5, [1, 2, own])]
    got = {r.doc_id: r.text for r in P.decode(spark.createDataFrame(rows, "doc_id long, ids array<int>"), model).collect()}
    assert got == {1: "", 2: "", 3: "a", 4: "�a", 5: "a"}
    with pytest.raises(ValueError):
        P.Spelling([b"a"]).texts(np.array([1]), np.array([1]))


def test_other_models_are_refused():
    with pytest.raises(ValueError):
        P.read_pieces(bytes([0x12, 2, 0x18, 1]))  # a trainer of another type
    with pytest.raises(ValueError):
        P.read_pieces(bytes([0x1A, 0]))  # a normaliser that removes spaces


def test_edges(model, edges, nothing):
    assert P.encode(nothing, model).count() == 0
    assert P.recode(nothing, model).count() == 0
    rows = P.recode(edges, model).collect()
    assert len(rows) == 9
    by = {(r.doc_id, r.text): r.ids for r in rows}
    assert by[(1, "")] == [] and (6, "ß€😀 \x00 x") in by and len(by[(4, "word")]) > 0
