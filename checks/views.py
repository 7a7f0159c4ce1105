"""Job inputs that Spark derives from the given tables, whole tables throughout."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.functions.urls import url_host
from gleaner.operators.domains import SuffixRules
from gleaner.operators.joins import Dictionary
from gleaner.operators.spellings import with_spellings
from gleaner.operators.words import StopWords
from gleaner.sources import sequence

SUFFIX_RULES = (
    "com", "net", "org", "example.com", "example.net", "example.org", "uk", "*.uk", "!city.uk",
)
STOP_WORDS = ("the", "and", "of", "is", "on", "in", "to")
TRAINING_STOP_WORDS = ("http", "https", "example", "page", "that", "with")


def table(spark: SparkSession, sf: str, name: str, *columns: str) -> DataFrame:
    """A given table. They come as single small files of one split, so rows are spread over cores."""
    df = spark.read.parquet(f"{sf}/{name}.parquet").select(*columns)
    cores = spark.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() > cores else df.repartition(cores)


def number(col: Column) -> Column:
    """A number from a text, equal in both engines."""
    return F.conv(F.substring(F.md5(col), 1, 6), 16, 10).cast("long")


def suffix_rules(spark: SparkSession) -> SuffixRules:
    return SuffixRules(spark.createDataFrame([(r,) for r in SUFFIX_RULES], "rule STRING"))


def stop_words(spark: SparkSession, words: tuple[str, ...] = STOP_WORDS) -> StopWords:
    return StopWords(spark.createDataFrame([(w,) for w in words], "word STRING"))


def crawled_url() -> Column:
    """The page's URL, varied by page so that every URL outcome occurs."""
    url, key = F.col("url"), F.col("page_id") % 37
    path = F.regexp_replace(url, "^[a-z]+://[^/]*", "")
    return (
        F.when(key == 1, F.concat(F.lit("nourl"), path))
        .when(key == 2, F.concat(F.lit("http://10.2.3.4"), path))
        .when(key == 3, F.regexp_replace(url, r"^([a-z]+://[^/]*)", "$1."))
        .when(key == 4, F.concat(F.lit("http://-x.example.com"), path))
        .when(key == 5, F.concat(F.lit("http://example.org"), path))
        .when(key == 6, F.concat(F.lit("gopher://a.example.com"), path))
        .when(key == 7, F.concat(F.lit("http://www.a.b.uk"), path))
        .when(key == 8, F.concat(F.lit("http://www.city.uk"), path))
        .when(key == 9, F.regexp_replace(url, "^[a-z]+://", "HTTP://user@WWW2."))
        .when(key == 10, F.regexp_replace(url, r"^([a-z]+://[^/]*)", "$1:8080"))
        .when(key == 11, F.regexp_replace(url, r"^([a-z]+://[^/]*)", "$1:80x"))
        .when(key == 12, F.regexp_replace(url, "^[a-z]+://", "http://www.m."))
        .otherwise(url)
    )


def crawl(spark: SparkSession, sf: str) -> DataFrame:
    """(page_id, crawl, url, metadata): one or two crawl records per page, every outcome occurs."""
    pid = F.col("page_id")
    status = (
        F.when(pid % 10 == 9, 404).when(pid % 10 == 8, 302).when(pid % 50 == 7, 503)
        .when(pid % 50 == 16, None).when(pid % 50 == 27, 150).otherwise(200)
    )
    kind = F.when(pid % 13 == 5, "pdf").when(pid % 13 != 6, "html-doc")
    title = F.when(pid % 11 == 4, "  ").otherwise(
        F.concat(F.regexp_extract("html", "<title>([^<]*)</title>", 1), F.lit("  v"), "crawl")
    )
    keywords = F.when(pid % 3 != 0, F.concat(F.lit(" kw"), pid % 7, F.lit(",  k"), pid % 5,
                                             F.lit(" ")))
    tag = lambda name, content: F.struct(name.alias("name"), content.alias("content"))
    tags = F.array(
        tag(F.lit("description"), F.lit("d")),
        tag(F.lit("keywords"), F.lit("old")),
        tag(F.lit("keywords"), keywords),
    )
    document = F.to_json(
        F.struct(
            F.col("status").alias("http_result"),
            F.struct(
                F.col("title"), F.col("kind").alias("type"),
                F.when(pid % 3 != 0, tags).otherwise(F.slice(tags, 1, 1)).alias("meta_tags"),
            ).alias("content"),
        )
    )
    # Tags of another shape have no keywords, and a status may be written as a decimal.
    shape = F.when(pid % 24 == 3, '"meta_tags":{}').when(pid % 24 == 6, '"meta_tags":["x",[1]]').when(
        pid % 24 == 9, '"meta_tags":[{"name":{"a":[1]},"content":{"b":2}}]'
    )
    document = F.coalesce(
        F.regexp_replace(document, F.lit(r'"meta_tags":\[.*\]'), shape), document
    )
    document = F.when(
        pid % 8 == 0, F.regexp_replace(document, r'"http_result":(\d+)', '"http_result":$1.0')
    ).otherwise(document)
    # Crawled once to seven times.
    copies = F.sequence(F.lit(1), F.when(pid % 4 == 0, 2 + pid % 6).otherwise(1).cast("int"))
    return (
        table(spark, sf, "pages", "page_id", "url", "html")
        .withColumn("crawl", F.explode(copies))
        .withColumn("status", status)
        .withColumn("kind", kind)
        .withColumn("title", title)
        .select(
            "page_id",
            "crawl",
            crawled_url().alias("url"),
            F.when(pid % 17 == 3, " ").when(pid % 19 == 4, '{"http_result":').otherwise(document)
            .alias("metadata"),
        )
    )


# Labels and suffixes in both spellings; rules and whitelist have one or mix them.
SPELT_LABELS = (("bücher", "xn--bcher-kva"), ("пример", "xn--e1afmkfd"), ("例え", "xn--r8jz45g"))
SPELT_SUFFIXES = (("рф", "xn--p1ai"), ("公司.cn", "xn--55qx5d.cn"))
SPELT_RULES = ("рф", "cn", "xn--55qx5d.cn")
SPELT_WHITELIST = ("bücher.xn--p1ai", "xn--e1afmkfd.xn--55qx5d.cn")


def spelt_pages(spark: SparkSession, sf: str) -> DataFrame:
    """(page_id, url): every page under a host in one of the spellings of its label and suffix."""
    pid = F.col("page_id")

    def pick(pairs, kind, spelling):
        flat = F.array(*[F.lit(name) for pair in pairs for name in pair])
        return F.get(flat, (2 * (kind % len(pairs)) + spelling % 2).cast("int"))

    label = pick(SPELT_LABELS, pid, F.floor(pid / 3))
    suffix = pick(SPELT_SUFFIXES, F.floor(pid / 6), F.floor(pid / 12))
    url = F.concat(F.lit("http://www."), label, F.lit("."), suffix, F.lit("/"), pid)
    return table(spark, sf, "pages", "page_id").select("page_id", url.alias("url"))


def spelt_whitelist(spark: SparkSession) -> Dictionary:
    names = spark.createDataFrame([(name,) for name in SPELT_WHITELIST], "domain STRING")
    return Dictionary(with_spellings(names, "domain"))


def _cut(file, size: int) -> int:
    """Two thirds of a file of records, or a byte less if a record ends there: the rest would be a
    shorter file that does not break off."""
    window, end = sequence.Window(file, 0), size * 2 // 3
    at = sequence.read_header(window).end
    while at < end:
        record = int.from_bytes(window.take(at, 4), "big", signed=True)
        at += 4 + sequence.SYNC_SIZE if record == -1 else 8 + record
    return end - (at == end)


def broken_copies(spark: SparkSession, folder: str, prefix: str) -> None:
    """The first two thirds of each of a folder's data files, at the prefix and a number; a task a file."""
    listed = sequence.listed_files(folder)

    def copied(batches):
        for batch in batches:
            for i in batch.column("id").to_pylist():
                source, size = listed[i]
                files, local = sequence.filesystem(source)
                to, target = sequence.filesystem(f"{prefix}{i}")
                to.create_dir(target.rpartition("/")[0], recursive=True)
                with files.open_input_file(local) as file, to.open_output_stream(target) as out:
                    left = _cut(file, size)
                    file.seek(0)
                    while left and (data := file.read(min(left, 1 << 20))):
                        out.write(data)
                        left -= len(data)
            yield batch

    spark.range(0, len(listed), 1, len(listed)).mapInArrow(copied, "id long").collect()


def hosts(spark: SparkSession, sf: str) -> DataFrame:
    """Distinct hosts of the pages without a leading www label, and a number for each."""
    host = F.regexp_replace(url_host(F.col("url")), r"^www[a-z0-9_]*\.", "")
    return table(spark, sf, "pages", "url").select(host.alias("host")).distinct().withColumn(
        "num", number(F.col("host"))
    )


def category_index(spark: SparkSession, sf: str) -> DataFrame:
    """(host, categories): one host in five is missing, some have two categories."""
    nation = spark.read.parquet(f"{sf}/nation.parquet")
    region = spark.read.parquet(f"{sf}/region.parquet")
    names = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    known = hosts(spark, sf).where(F.col("num") % 5 != 0).withColumn(
        "n_nationkey", (F.col("num") % 25).cast("int")
    )
    second = F.when(F.col("num") % 4 == 0, F.col("r_name"))
    return known.join(names, "n_nationkey").select(
        "host", F.filter(F.array("n_name", second), lambda c: c.isNotNull()).alias("categories")
    )


def index_dictionary(spark: SparkSession, sf: str) -> Dictionary:
    return Dictionary(category_index(spark, sf))


def interests(spark: SparkSession, sf: str) -> DataFrame:
    """(host, rules): nested interests with a default rule and a path rule."""
    return category_index(spark, sf).select(
        "host",
        F.create_map(
            F.lit("__ANY"), F.col("categories"),
            F.lit("path"), F.slice("categories", 1, 1),
        ).alias("rules"),
    )


def texts(spark: SparkSession, sf: str) -> DataFrame:
    """(url, text, lang): several documents per URL."""
    www = F.when(F.col("doc_id") % 3 == 0, "www.").otherwise("")
    url = F.concat(
        F.lit("http://"), www, "source", F.lit(".example.com/p/"),
        (F.col("doc_id") % 60).cast("string"),
    )
    return table(spark, sf, "documents", "doc_id", "source", "text", "lang").select(
        url.alias("url"), "text", "lang"
    )


def texts_with_errors(spark: SparkSession, sf: str) -> DataFrame:
    """(url, text): some URLs are bad in each way, some texts have no letters."""
    doc = F.col("doc_id")
    bad = (
        F.when(doc % 41 == 0, "nourl/p")
        .when(doc % 41 == 1, "http://10.2.3.4/p")
        .when(doc % 41 == 2, "http://example.org/p")
    )
    www = F.when(doc % 3 == 0, "www.").otherwise("")
    url = F.concat(
        F.lit("http://"), www, "source", F.lit(".example.com/p/"), (doc % 60).cast("string")
    )
    return table(spark, sf, "documents", "doc_id", "source", "text").select(
        F.coalesce(bad, url).alias("url"),
        F.when(doc % 43 == 0, "12 34 --").otherwise(F.col("text")).alias("text"),
    )


def whitelist(spark: SparkSession, sf: str) -> Dictionary:
    """Domains of the sources whose number is even."""
    source = table(spark, sf, "documents", "source").distinct()
    domain = F.concat("source", F.lit(".example.com"))
    return Dictionary(
        source.where(number(F.col("source")) % 2 == 0).select(domain.alias("domain"))
    )


def corpus(spark: SparkSession, sf: str) -> DataFrame:
    """(url, title, keywords, categories): documents as harvested rows.

    The language is the first category, a judged quality the second.
    """
    docs = table(spark, sf, "documents", "doc_id", "text", "lang", "source")
    judged = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "quality")
    url = F.concat(F.lit("http://"), "source", F.lit(".example.com/"), F.col("doc_id"))
    kind = F.when(F.col("quality") == 1, ",good").when(F.col("quality") == 0, ",poor").otherwise("")
    return docs.join(judged, "doc_id", "left").select(
        url.alias("url"),
        F.col("text").alias("title"),
        F.col("source").alias("keywords"),
        F.concat("lang", kind).alias("categories"),
    )
