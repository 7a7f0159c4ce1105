import gzip
import json
import random

import pyarrow as pa
import pytest

from gleaner import sources
from gleaner.sources import sequence as S

TEXT = "org.apache.hadoop.io.Text"
FORMAT = "org.apache.hadoop.mapred.SequenceFileOutputFormat"
CODEC = "org.apache.hadoop.io.compress."


def pages(n=3000, seed=1):
    rng = random.Random(seed)
    words = ["page", "éè", "😀", "\n", "\t", "x" * 300, "", "日本"]
    return [(f"http://h{i}.com/é", " ".join(rng.choices(words, k=rng.randint(0, 12)))) for i in range(n)]


def write(spark, path, rows, kind="NONE", codec="DefaultCodec", files=1):
    conf = {"mapreduce.output.fileoutputformat.compress": str(kind != "NONE").lower(),
            "mapreduce.output.fileoutputformat.compress.type": kind,
            "mapreduce.output.fileoutputformat.compress.codec": CODEC + codec,
            "io.seqfile.compress.blocksize": "20000"}
    spark.sparkContext.parallelize(rows, files).saveAsHadoopFile(
        path, FORMAT, keyClass=TEXT, valueClass=TEXT, conf=conf)
    return path


def read(spark, path, **options):
    spark.dataSource.register(S.SequenceFileSource)
    return spark.read.format("sequencefile").options(**options).load(path)


def parts(path):
    return [f for f, _ in S.listed_files(path)]


@pytest.mark.parametrize("kind,codec", [
    ("NONE", "DefaultCodec"), ("RECORD", "DefaultCodec"), ("BLOCK", "DefaultCodec"),
    ("BLOCK", "GzipCodec"), ("RECORD", "BZip2Codec"), ("BLOCK", "BZip2Codec"),
    ("BLOCK", "SnappyCodec"),
])
def test_every_record_once_whatever_the_ranges(spark, tmp_path, kind, codec):
    """Several ranges a file, uncompressed and compressed by record and by block."""
    rows = pages()
    path = write(spark, f"{tmp_path}/s", rows, kind, codec, files=2)
    for split in (1 << 27, 50_000, 7_001):
        got = read(spark, path, splitBytes=split)
        assert sorted((r.key, r.value) for r in got.collect()) == sorted(rows)
        assert got.where("error IS NOT NULL").count() == 0
    sizes = [size for _, size in S.listed_files(path)]
    reader = S.SequenceFileReader({"path": path, "splitBytes": "7001"})
    assert len(reader.partitions()) == sum(-(-size // 7001) for size in sizes) > 4


def test_every_cut_of_a_small_file(spark, tmp_path):
    """All pairs of neighbouring ranges give each record once."""
    rows = [(f"k{i}", "v" * (i * 37 % 3000)) for i in range(60)]
    path = parts(write(spark, f"{tmp_path}/s", rows))[0]
    files, local = S.filesystem(path)
    with files.open_input_file(local) as file:
        size = file.size()
        header = S.read_header(S.Window(file, 0))
        for cut in range(1, size, 97):
            got = []
            for start, end in ((0, cut), (cut, size)):
                window = S.Window(file, 0 if start <= header.end else start)
                got += [k.decode() for k, _ in S.read_range(window, header, start, end)]
            assert got == [k for k, _ in rows]


def test_odd_bytes_and_empty_files(spark, tmp_path):
    bad = b"\xff\xfe broken"
    jvm = spark._jvm
    conf = spark._jsc.hadoopConfiguration()
    kind = jvm.java.lang.Class.forName(TEXT)
    opened = jvm.org.apache.hadoop.io.SequenceFile.createWriter(
        jvm.org.apache.hadoop.fs.FileSystem.getLocal(conf), conf, jvm.org.apache.hadoop.fs.Path(f"{tmp_path}/odd"),
        kind, kind)
    text = jvm.org.apache.hadoop.io.Text
    opened.append(text(bytearray(bad)), text("fine"))
    opened.close()
    assert [tuple(r)[:2] for r in read(spark, f"{tmp_path}/odd").collect()] == [("�� broken", "fine")]
    write(spark, f"{tmp_path}/none", [])
    assert read(spark, f"{tmp_path}/none").count() == 0


def test_patterns(spark, tmp_path):
    for segment in "12":
        write(spark, f"{tmp_path}/segment/{segment}/metadata-0", [(segment, "m")])
        write(spark, f"{tmp_path}/segment/{segment}/text-0", [(segment, "t")])
    got = read(spark, f"file:{tmp_path}/segment/*/metadata*")
    assert sorted((r.key, r.value) for r in got.collect()) == [("1", "m"), ("2", "m")]
    assert all(r.file.startswith(f"file:{tmp_path}/segment/") for r in got.collect())
    with pytest.raises(FileNotFoundError):
        S.listed_files(f"{tmp_path}/segment/*/nothing*")


def test_plan_has_no_row_at_a_time_python(spark, tmp_path):
    path = write(spark, f"{tmp_path}/s", pages(10))
    plan = sources.read_sequence_files(spark, [path], "text")._jdf.queryExecution().executedPlan().toString()
    assert "ExistingRDD" not in plan and "BatchScan" in plan


def broken(tmp_path, source, name, cut=None, change=None):
    with open(source, "rb") as file:
        data = bytearray(file.read())
    if cut is not None:
        data = data[: int(len(data) * cut)]
    if change is not None:
        data[change] ^= 0xFF
    target = tmp_path / name
    target.write_bytes(bytes(data))
    return str(target)


@pytest.mark.parametrize("kind", ["NONE", "RECORD", "BLOCK"])
def test_broken_files_are_reported(spark, tmp_path, kind):
    good = parts(write(spark, f"{tmp_path}/s", pages(1000), kind))[0]
    cases = [broken(tmp_path, good, "cut", cut=0.61), broken(tmp_path, good, "head", cut=0.0),
             broken(tmp_path, good, "magic", change=0), broken(tmp_path, good, "version", change=3)]
    for path in cases:
        with pytest.raises(Exception):
            read(spark, path).collect()
        told = read(spark, path, errors="report").where("error IS NOT NULL").collect()
        assert len(told) == 1 and told[0].file == path and told[0].key is None
    text = tmp_path / "plain.gz"
    text.write_bytes(gzip.compress(b"no sequence file"))
    assert read(spark, str(text), errors="report").where("error IS NOT NULL").count() == 1


def segments(spark, tmp_path, bad):
    """Four files of 50 pages, the first `bad` of them cut."""
    for i in range(4):
        rows = [(f"http://{i}/{k}", "value " * 400) for k in range(50)]
        source = parts(write(spark, f"{tmp_path}/raw{i}", rows))[0]
        broken(tmp_path, source, f"seg-{i}", cut=0.5 if i < bad else None)
    return [f"{tmp_path}/seg-*"]


def test_unreadable_segments_are_set_aside(spark, tmp_path):
    read = sources.read_segments(spark, segments(spark, tmp_path, 1), "sequence", "url", "text", 0.5)
    assert {r.url.split("/")[2] for r in read.pages.collect()} == {"1", "2", "3"}
    assert read.pages.count() == 150 and read.pages.columns == ["url", "text"]
    told = {r.file.rpartition("/")[2]: (r.rows, r.error is None) for r in read.files.collect()}
    assert told.pop("seg-0")[1] is False
    assert told == {f"seg-{i}": (50, True) for i in (1, 2, 3)}
    assert [r.file.rpartition("/")[2] for r in read.quarantined().collect()] == ["seg-0"]


def test_too_many_unreadable_segments_end_the_job(spark, tmp_path):
    paths = segments(spark, tmp_path, 3)
    with pytest.raises(sources.TooManyUnreadable, match="3 of 4"):
        sources.read_segments(spark, paths, "sequence", "url", "text", 0.5)
    assert sources.read_segments(spark, paths, "sequence", "url", "text", 0.75).pages.count() == 50


def test_columnar_segments(spark, tmp_path):
    for i in range(3):
        spark.createDataFrame([(f"u{i}{k}", "m") for k in range(5)], "address STRING, meta STRING").coalesce(
            1).write.parquet(f"{tmp_path}/p{i}")
    victim = next(p for p, _ in S.listed_files(f"{tmp_path}/p1"))
    broken(tmp_path, victim, "p1cut.parquet", cut=0.5)
    paths = [f"{tmp_path}/p0", f"{tmp_path}/p2", f"{tmp_path}/p1cut.parquet"]
    read = sources.read_segments(spark, paths, "parquet", "address", "meta", 0.5)
    assert {r.address[:2] for r in read.pages.toDF("address", "meta").collect()} == {"u0", "u2"}
    assert read.pages.columns == ["url", "meta"]
    assert [r.file.rpartition("/")[2] for r in read.quarantined().collect()] == ["p1cut.parquet"]
    with pytest.raises(sources.TooManyUnreadable):
        sources.read_segments(spark, paths, "parquet", "address", "meta", 0.1)


def test_job_writes_what_it_set_aside(spark, tmp_path):
    from gleaner.__main__ import main

    meta = json.dumps({"http_result": 200, "content": {"title": "a title", "type": "html-doc"}})
    for i in range(2):
        rows = [(f"http://www.h{i}.com/{k}", meta) for k in range(200)]
        source = parts(write(spark, f"{tmp_path}/raw{i}", rows))[0]
        broken(tmp_path, source, f"seg-{i}", cut=0.4 if i else None)
    (tmp_path / "list").write_text("0\n1\n")
    (tmp_path / "cats").mkdir()
    (tmp_path / "cats/en-US.json").write_text(json.dumps({"h0.com": ["A"], "h1.com": ["B"]}))
    main(["titles", "--segments", f"{tmp_path}/list", "--template", f"{tmp_path}/seg-{{segment}}",
          "--index-dir", f"{tmp_path}/cats", "--out", f"{tmp_path}/out"], spark)
    assert spark.read.text(f"{tmp_path}/out/titles_tsv").count() == 200
    aside = spark.read.parquet(f"{tmp_path}/out/unreadable").collect()
    assert [r.file.rpartition("/")[2] for r in aside] == ["seg-1"]


def test_all_copies_of_a_segment_break_off(spark, tmp_path):
    from checks import views as VW

    # Equal records, so that two thirds of some files end with a record.
    rows = spark.sparkContext.parallelize(range(1200), 1).map(lambda i: (f"k{i:04}", "v" * 11))
    sizes = [1, 2, 3, 5, 8, 13, 21, 34, 55, 89, 144]
    for n in sizes:
        rows.filter(lambda r, n=n: int(r[0][1:]) < n).saveAsSequenceFile(f"{tmp_path}/in{n}")
    rows.repartition(6).saveAsSequenceFile(f"{tmp_path}/in0")
    for n in [0, *sizes]:
        VW.broken_copies(spark, f"{tmp_path}/in{n}", f"{tmp_path}/out/f{n}-")
    files = sources.read_segments(spark, [f"{tmp_path}/out"], "sequence", "url", "v", 1.0).files.collect()
    assert len(files) == len(sizes) + 6
    assert all(r.error is not None for r in files)
    for size in range(200, 260):  # whatever the place of the cut
        path = S.listed_files(f"{tmp_path}/in13")[0][0]
        with open(path.removeprefix("file:"), "rb") as file:
            data = file.read()
        cut = VW._cut(pa.BufferReader(data), size)
        head = S.read_header(S.Window(pa.BufferReader(data), 0))
        with pytest.raises(S.UnreadableFile):
            window = S.Window(pa.BufferReader(data[:cut]), 0)
            list(S.read_range(window, S.read_header(window) if cut < head.end else head, 0, cut))
