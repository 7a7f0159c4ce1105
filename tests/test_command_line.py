import json

from gleaner.__main__ import main


def put(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)
    return str(path)


def lines(spark, path):
    return sorted(r[0] for r in spark.read.text(str(path)).collect())


def test_all_jobs_chain(spark, tmp_path):
    out = lambda name: str(tmp_path / name)
    interests = {f"h{i}.com": {"__ANY": ["Sport" if i % 2 else "Food"]} for i in range(4)}
    main(["index", "--interests", put(tmp_path / "i.json", json.dumps(interests)),
          "--documents", "--out", out("index")], spark)
    assert json.loads(lines(spark, tmp_path / "index/whitelist")[0]) == sorted(interests)

    put(tmp_path / "cats/en-US.x.json", lines(spark, tmp_path / "index/index")[0])
    listing = put(tmp_path / "list", "s1\n")
    meta = lambda i: json.dumps({"http_result": 200, "content": {
        "title": f"{'ball goal' if i % 2 else 'apple soup'} number{i % 3}", "type": "html-doc"}})
    pages = [(f"http://www.h{i % 4}.com/{i}", meta(i), "the ball and the goal") for i in range(40)]
    spark.createDataFrame(pages, "url STRING, metadata STRING, text STRING").write.parquet(
        out("seg/s1"))
    common = ["--segments", listing, "--template", out("seg") + "/{segment}", "--format", "parquet"]
    main(["titles", *common, "--index-dir", out("cats"), "--variation", "x", "--out", out("t")],
         spark)
    main(["titles", *common, "--index", out("index/index_entries"), "--out", out("t2")], spark)
    harvest = str(tmp_path / "t/titles_tsv")
    assert lines(spark, tmp_path / "t2/titles_tsv") == lines(spark, harvest)
    assert len(lines(spark, harvest)) == 40

    stop = put(tmp_path / "stop.txt", "the\nhttp\n")
    put(tmp_path / "profiles/en", json.dumps(
        {"name": "en", "freq": {"t": 5, "th": 3, "the": 3}, "n_words": [5, 3, 3]}))
    put(tmp_path / "profiles/de", json.dumps(
        {"name": "de", "freq": {"t": 1, "ei": 9}, "n_words": [1, 9, 1]}))
    white = put(tmp_path / "white.json", json.dumps(["h1.com"]))
    main(["texts", *common, "--profiles", out("profiles"), "--whitelist", white,
          "--stop-words", stop, "--out", out("x")], spark)
    assert lines(spark, tmp_path / "x/bags_tsv")[0] == "http://www.h1.com/1\th1.com\tand:1 ball:1 goal:1"
    assert lines(spark, tmp_path / "x/languages_tsv") == ["0lang:en\t40"]

    grown = ["--state", out("state")]
    for part in (1, 2):
        half = spark.read.parquet(out("seg/s1")).where(f"hash(url) % 2 {'=' if part == 1 else '<>'} 0")
        half.write.parquet(out(f"half/s{part}"))
        common = ["--segments", put(tmp_path / f"list{part}", f"s{part}\n"), "--template",
                  out("half") + "/{segment}", "--format", "parquet"]
        main(["texts", *common, "--profiles", out("profiles"), "--whitelist", white, "--stop-words",
              stop, *grown, "--out", out(f"g{part}")], spark)
        main(["titles", *common, "--index", out("index/index_entries"), "--state", out("state_t"),
              "--out", out(f"gt{part}")], spark)
    for name in ("bags_tsv", "languages_tsv"):
        assert lines(spark, tmp_path / f"g2/all_{name}") == lines(spark, tmp_path / f"x/{name}")
    rows = lambda path: sorted(map(tuple, spark.read.parquet(out(path)).select("grp", "name", "n").collect()))
    assert rows("g2/all_statistics") == rows("x/statistics")
    assert rows("gt2/all_statistics") == rows("t/statistics")

    assert len(lines(spark, tmp_path / "index/index_entries")) == 4
    main(["training", "--harvest", harvest, "--stop-words", stop, "--documents", "--out", out("tr")],
         spark)
    assert '"apple soup number0","Food"' in lines(spark, tmp_path / "tr/training")
    assert lines(spark, tmp_path / "tr/labels") == ['["Food","Sport"]']

    main(["classifier", "--harvest", harvest, "--stop-words", stop, "--sizes", "3", "5",
          "--folds", "4", "--documents", "--out", out("m")], spark)
    model = json.loads(lines(spark, tmp_path / "m/w5/model_json")[0])
    assert model["classes"] == {"0": "Food", "1": "Sport"}
    confusion = spark.read.parquet(out("m/confusion")).where("size = 5")
    matrix = {(r.klass, r.prediction): r.n for r in confusion.collect()}
    assert matrix == {("Food", "Food"): 20, ("Sport", "Sport"): 20}
    assert {r.f1 for r in spark.read.parquet(out("m/class_metrics")).where("size = 5").collect()} == {1.0}

    main(["split", "--harvest", harvest, "--seed", "1", "--out", out("s")], spark)
    sizes = {r.split: r["count"] for r in spark.read.text(out("s")).groupBy("split").count().collect()}
    assert sizes == {"train": 32, "validate": 4, "test": 4}
    main(["split", "--harvest", harvest, "--by-page", "--out", out("p")], spark)
    assert spark.read.text(out("p")).count() == 40
