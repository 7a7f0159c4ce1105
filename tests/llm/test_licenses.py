from gleaner.llm import licenses as L

FILL = " ".join(f"filler{i}" for i in range(300))


def test_templates_are_found_and_clean_texts_are_not(spark, documents, edges, nothing):
    texts = dict(L.NOTICES)
    docs = [(i, f"{FILL[: 40 * i]} {text.upper()} {FILL}") for i, text in enumerate(texts.values())]
    docs += [(100, FILL), (101, "licensed under the sea and the sky"), (102, None)]
    docs += [(103, texts["MIT"]), (103, texts["MIT"]), (104, f"{texts['MIT']} {FILL} {texts['MIT']}")]
    got = {(r.doc_id, r.license): r for r in L.find_licenses(documents(docs)).collect()}
    for i, name in enumerate(texts):
        assert got[i, name].containment == 1.0
    assert {d for d, _ in got} == {*range(len(texts)), 103, 104}
    assert got[104, "MIT"].first_word == 0
    assert L.find_licenses(edges).count() == 0 and L.find_licenses(nothing).count() == 0


def test_partial_and_given_templates(spark, documents):
    words = [f"term{i}" for i in range(40)]
    templates = spark.createDataFrame(
        [("own", " ".join(words)), (None, "no name"), ("empty", ""), ("tiny", "Two Words")],
        "license string, text string",
    )
    changed = [*words[:35], *["other"] * 5]
    half = words[:20]
    docs = documents([(1, " ".join(changed)), (2, " ".join(half)), (3, "x two, words y"), (4, "two words")])
    got = {(r.doc_id, r.license): round(r.containment, 3) for r in L.find_licenses(docs, templates).collect()}
    assert got == {(1, "own"): round(31 / 36, 3), (4, "tiny"): 1.0}
    assert L.find_licenses(docs, templates.limit(0)).count() == 0


def test_many_templates_by_a_join_of_shingles(spark, documents, edges, nothing, monkeypatch):
    # 300,000 words of templates, of several length classes.
    templates = spark.range(150).selectExpr(
        "concat('own', id) AS license",
        "array_join(transform(sequence(1, 1800 + 3 * id), i -> concat('w', xxhash64(id, i))), ' ') AS text",
    )
    texts = {r.license: r.text for r in templates.where("license IN ('own0', 'own77', 'own149')").collect()}
    docs = [(i, f"{FILL} {text} {FILL}") for i, text in enumerate(texts.values())]
    docs += [(None, texts["own77"]), (8, texts["own0"][: len(texts["own0"]) // 2]), (9, FILL), (9, None)]
    got = {(r.doc_id, r.license, r.containment) for r in L.find_licenses(documents(docs), templates).collect()}
    assert got == {(i, name, 1.0) for i, name in enumerate(texts)} | {(None, "own77", 1.0)}

    few = documents([(1, L.NOTICES[7][1]), (1, L.NOTICES[7][1]), (2, f"{FILL} {L.NOTICES[0][1]}"), (3, FILL)])
    inline = sorted(L.find_licenses(few).collect())
    monkeypatch.setattr(L, "INLINE", 0)
    assert sorted(L.find_licenses(few).collect()) == inline and len(inline) == 2
    assert L.find_licenses(edges).count() == 0 and L.find_licenses(nothing).count() == 0
