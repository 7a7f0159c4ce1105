"""Registered queries: (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner import sinks, sources
from gleaner.functions import metadata as M
from gleaner.functions import text as X
from gleaner.functions import urls as U
from gleaner.operators import bayes as B
from gleaner.operators import domains as D
from gleaner.operators import histograms as H
from gleaner.operators import language as L
from gleaner.operators import split as S
from gleaner.operators import vectors as V
from gleaner.operators import words as W
from gleaner.plans import increments as IN
from gleaner.plans import index as I
from gleaner.plans import texts as TX
from gleaner.plans import titles as TI
from gleaner.plans import training as TR
from gleaner.workspace import stage, work_path

from . import views as VW

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

VOCABULARY = 1500
SIZES = (1500, 3000, 5000, 7500, 10000)
DIGITS = 6


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


# URLs -----------------------------------------------------------------------------------------


def _urls(spark: SparkSession, sf: str) -> DataFrame:
    return VW.crawl(spark, sf).select("page_id", "crawl", "url")


@query
def url_host(spark, sf):
    return _urls(spark, sf).select("page_id", "crawl", U.url_host(F.col("url")).alias("host"))


@query
def registrable_domain(spark, sf):
    resolved = D.with_url_outcome(_urls(spark, sf), VW.suffix_rules(spark), check_prefix=False)
    return resolved.select("page_id", "crawl", "domain")


@query
def url_outcome(spark, sf):
    resolved = D.with_url_outcome(_urls(spark, sf), VW.suffix_rules(spark))
    return resolved.select("page_id", "crawl", "url_outcome")


@query
def canonical_host(spark, sf):
    resolved = D.with_url_outcome(_urls(spark, sf), VW.suffix_rules(spark))
    return D.with_canonical_host(resolved).select("page_id", "crawl", "canonical_host")


def _spelt(spark, sf) -> tuple[DataFrame, D.SuffixRules]:
    rules = spark.createDataFrame([(r,) for r in VW.SPELT_RULES], "rule STRING")
    return VW.spelt_pages(spark, sf), D.SuffixRules(rules)


@query
def spelt_domains(spark, sf):
    """Domains of hosts with letters beyond ASCII, spelt either way, by rules spelt one way."""
    pages, rules = _spelt(spark, sf)
    return D.with_url_outcome(pages, rules).select("page_id", "domain")


@query
def spelt_whitelisted(spark, sf):
    """Pages of whitelisted domains, whichever way page and whitelist spell them."""
    pages, rules = _spelt(spark, sf)
    return TX.whitelisted(pages, VW.spelt_whitelist(spark), rules).select("page_id", "domain")


# Title harvest --------------------------------------------------------------------------------


def _evaluated(spark, sf) -> DataFrame:
    return TI.evaluate_pages(
        VW.crawl(spark, sf), VW.index_dictionary(spark, sf), VW.suffix_rules(spark)
    )


def _harvested(spark, sf) -> DataFrame:
    pages = VW.crawl(spark, sf).select("url", "metadata")
    return TI.harvest_tsv(
        TI.harvest_titles(pages, VW.index_dictionary(spark, sf), VW.suffix_rules(spark))
    )


@query
def page_fields(spark, sf):
    meta = M.parse_metadata(F.col("metadata"))
    parsed = VW.crawl(spark, sf).withColumn("_m", F.explode(F.array(meta)))
    m = F.col("_m")
    return parsed.where(~X.is_blank(F.col("metadata")) & m[M.BAD].isNull()).select(
        "page_id", "crawl", m["http_result"].alias("status"), m["content"]["type"].alias("kind"),
        M.page_title(m).alias("title"), M.page_keywords(m).alias("keywords"),
    )


@query
def page_outcomes(spark, sf):
    return _evaluated(spark, sf).select("page_id", "crawl", "outcome")


@query
def page_categories(spark, sf):
    found = TI.with_categories(
        _urls(spark, sf), VW.index_dictionary(spark, sf), VW.suffix_rules(spark)
    )
    return found.where(F.col("categories").isNotNull()).select(
        "page_id", "crawl", F.array_join("categories", ",").alias("categories")
    )


@query
def harvest_titles(spark, sf):
    return _harvested(spark, sf)


@query
def harvest_tsv(spark, sf):
    return sinks.harvest_line(_harvested(spark, sf))


@query
def status_classes(spark, sf):
    reached = _evaluated(spark, sf).where(F.col("status_class").isNotNull())
    return reached.groupBy("status_class").agg(F.count(F.lit(1)).alias("n"))


@query
def page_types(spark, sf):
    reached = _evaluated(spark, sf).where(F.col("page_type").isNotNull())
    return reached.groupBy("page_type").agg(F.count(F.lit(1)).alias("n"))


@query
def category_histogram(spark, sf):
    n = F.size(F.split("categories", ","))
    return _harvested(spark, sf).groupBy(H.count_bucket(n).alias("bucket")).agg(
        F.count(F.lit(1)).alias("n")
    )


@query
def url_occurrences(spark, sf):
    return H.occurrence_histogram(_harvested(spark, sf))


@query
def harvest_stats(spark, sf):
    return TI.harvest_statistics(_evaluated(spark, sf))


@query
def title_job_files(spark, sf):
    """The whole job with its files: rows read back from the TSV it wrote."""
    paths = TI.run_title_harvest(
        spark, VW.crawl(spark, sf).select("url", "metadata"), VW.index_dictionary(spark, sf),
        VW.suffix_rules(spark), work_path(spark, "titles"),
    )
    return sources.read_harvest(spark, paths["titles_tsv"])


@query
def title_job_statistics(spark, sf):
    """The whole job with its files: the statistics it wrote."""
    paths = TI.run_title_harvest(
        spark, VW.crawl(spark, sf).select("url", "metadata"), VW.index_dictionary(spark, sf),
        VW.suffix_rules(spark), work_path(spark, "titles"),
    )
    return spark.read.parquet(paths["statistics"])


# Text harvest ---------------------------------------------------------------------------------


@query
def clean_tokens(spark, sf):
    tokens = X.clean_tokens(F.col("text"))
    return VW.table(spark, sf, "documents", "doc_id", "text").select(
        "doc_id", F.size(tokens).cast("long").alias("n_tokens"),
        F.md5(F.array_join(tokens, " ")).alias("tokens_md5"),
    )


@query
def token_counts(spark, sf):
    docs = VW.table(spark, sf, "documents", "doc_id", "text")
    counted = W.with_token_counts(docs, "text", VW.stop_words(spark), ["doc_id"])
    return W.token_rows(counted.drop("text"))


@query
def bag_of_words(spark, sf):
    docs = VW.table(spark, sf, "documents", "doc_id", "text")
    return W.with_bag(docs, "text", VW.stop_words(spark), ["doc_id"]).select("doc_id", "bag")


@query
def whitelisted_texts(spark, sf):
    docs = VW.texts(spark, sf)
    kept = TX.whitelisted(docs, VW.whitelist(spark, sf), VW.suffix_rules(spark))
    return kept.groupBy("url", "domain").agg(F.count(F.lit(1)).alias("n"))


def _labelled_harvest(spark, sf) -> DataFrame:
    return TX.harvest_labelled_texts(
        VW.texts(spark, sf), VW.whitelist(spark, sf), VW.suffix_rules(spark), VW.stop_words(spark)
    )


@query
def harvest_texts(spark, sf):
    return _labelled_harvest(spark, sf)


@query
def harvest_texts_tsv(spark, sf):
    return sinks.bag_line(_labelled_harvest(spark, sf))


@query
def longest_text(spark, sf):
    docs = VW.texts(spark, sf).withColumn("domain", F.lit("any"))
    bags = W.with_bag(docs, "text", VW.stop_words(spark), ["url"])
    return W.longest_bag(bags).select("url", "bag", "occurrences")


@query
def text_occurrences(spark, sf):
    return _labelled_harvest(spark, sf).groupBy(
        H.count_bucket(F.col("occurrences")).alias("bucket")
    ).agg(F.count(F.lit(1)).alias("n"))


def _profiles(spark, sf):
    return L.build_profiles(VW.table(spark, sf, "documents", "text", "lang"))


@query
def language_profiles(spark, sf):
    return _profiles(spark, sf).select("lang", "ngram", "cnt")


@query
def detect_language(spark, sf):
    docs = VW.table(spark, sf, "documents", "doc_id", "text")
    return L.detect_language(docs, L.profile_table(_profiles(spark, sf)), ["doc_id"]).select(
        "doc_id", "lang"
    )


def _detected(spark, sf):
    table = L.profile_table(_profiles(spark, sf))
    return stage(TX.detect_pages(VW.texts(spark, sf).select("url", "text"), table), "detected")


@query
def language_counts(spark, sf):
    return L.language_counts(_detected(spark, sf))


@query
def harvest_detected_texts(spark, sf):
    return TX.harvest_texts(
        VW.texts(spark, sf).select("url", "text"), _detected(spark, sf), VW.whitelist(spark, sf),
        VW.suffix_rules(spark), VW.stop_words(spark),
    )


@query
def text_job_statistics(spark, sf):
    """The whole job with its files: the statistics it wrote."""
    paths = TX.run_text_harvest(
        spark, VW.texts_with_errors(spark, sf), L.profile_table(_profiles(spark, sf)),
        VW.whitelist(spark, sf), VW.suffix_rules(spark), VW.stop_words(spark),
        work_path(spark, "texts"),
    )
    return spark.read.parquet(paths["statistics"])


# Harvests that grow ---------------------------------------------------------------------------

BATCHES = 3


def _batches(pages: DataFrame, *columns: str):
    """The rows in batches, so that rows of one URL are in several: number and rows."""
    dealt = pages.withColumn("_b", F.pmod(F.xxhash64(*columns), F.lit(BATCHES)))
    for b in range(BATCHES):
        yield b, dealt.where(F.col("_b") == b).select(*columns)


@query
def growing_title_statistics(spark, sf):
    """Statistics of a title harvest that came in three batches, one of them given twice."""
    state = IN.State(spark, work_path(spark, "state"), IN.TITLES)
    index, rules = VW.index_dictionary(spark, sf), VW.suffix_rules(spark)
    for b, pages in _batches(VW.crawl(spark, sf), "url", "metadata"):
        for _ in range(2 if b == 1 else 1):
            IN.add_titles(state, f"b{b}", pages, index, rules, work_path(spark, "titles"))
    state.compact()
    return IN.title_statistics(state)


def _growing_texts(spark, sf, pages: DataFrame) -> IN.State:
    state = IN.State(spark, work_path(spark, "state"), IN.TEXTS)
    profiles = L.profile_table(_profiles(spark, sf))
    white, rules, stop = VW.whitelist(spark, sf), VW.suffix_rules(spark), VW.stop_words(spark)
    for b, batch in _batches(pages, "url", "text"):
        out = work_path(spark, "texts")
        IN.add_texts(state, f"b{b}", batch, profiles, white, rules, stop, out)
        if b == 1:
            state.compact()
    return state


@query
def growing_texts(spark, sf):
    """The longest bags of a text harvest that came in three batches."""
    return _growing_texts(spark, sf, VW.texts(spark, sf)).table("bags")


@query
def growing_text_statistics(spark, sf):
    """Statistics of a text harvest that came in three batches."""
    state = _growing_texts(spark, sf, VW.texts_with_errors(spark, sf))
    return IN.text_statistics(state)


# Training -------------------------------------------------------------------------------------


def _stop(spark):
    return VW.stop_words(spark, VW.TRAINING_STOP_WORDS)


def _training(spark, sf) -> DataFrame:
    """(url, tokens, categories, …) of the documents."""
    return TR.page_tokens(VW.corpus(spark, sf), _stop(spark))


@query
def training_rows(spark, sf):
    return TR.training_rows(_harvested(spark, sf), _stop(spark))


@query
def training_rows_corpus(spark, sf):
    rows = TR.training_rows(VW.corpus(spark, sf), _stop(spark))
    return rows.select("url", F.md5("tokens").alias("tokens_md5"), "klass")


@query
def training_rows_raw(spark, sf):
    return TR.training_rows(_harvested(spark, sf), _stop(spark), region="zh-CN")


@query
def labels(spark, sf):
    return TR.labels(_harvested(spark, sf))


@query
def labels_json(spark, sf):
    """The list of labels through its JSON document."""
    path = work_path(spark, "labels")
    sinks.write_labels(TR.labels(_harvested(spark, sf)), path)
    return sources.read_labels(spark, path)


@query
def category_docs(spark, sf):
    return S.category_counts(S.per_category(VW.corpus(spark, sf)))


@query
def stratified_split(spark, sf):
    rows = stage(VW.corpus(spark, sf), "corpus")
    return S.stratified_split(rows, seed="7").select("url", "category", "split")


@query
def stratified_split_sizes(spark, sf):
    """Rows with very many exact copies: only the language is left of each document."""
    rows = VW.corpus(spark, sf).select(
        F.lit("u").alias("url"), F.lit("t").alias("title"), "keywords",
        F.substring_index("categories", ",", 1).alias("categories"),
    )
    return S.stratified_split(rows).groupBy("category", "split").agg(
        F.count(F.lit(1)).alias("n")
    )


def _instances(spark, sf) -> DataFrame:
    return TR.instances_of(_training(spark, sf))


def _instances_with_copies(spark, sf) -> DataFrame:
    """Every third page is crawled twice."""
    crawled = F.explode(F.sequence(F.lit(1), F.when(VW.number(F.col("url")) % 3 == 0, 2).otherwise(1)))
    return _instances(spark, sf).withColumn("crawl", crawled).drop("crawl")


@query
def vocabulary_topw(spark, sf):
    return V.top_terms(V.count_terms(_instances(spark, sf)), VOCABULARY)


@query
def tfidf(spark, sf):
    instances = stage(_instances(spark, sf), "instances").select("url", "klass", "terms")
    rows = V.tfidf(instances, V.vocabulary(V.count_terms(instances), VOCABULARY))
    return rows.withColumn("weight", F.round("weight", DIGITS))


@query
def sparse_vectors(spark, sf):
    """The weights through lines of sparse vectors, terms and classes by number."""
    instances = stage(_instances(spark, sf), "instances")
    vocab = V.vocabulary(V.count_terms(instances), VOCABULARY)
    paths = TR.export_vectors(instances, vocab, work_path(spark, "sparse"))
    read = sources.read_vectors(spark, paths["vectors"]).select(
        F.col("name").alias("url"), "number", F.inline(F.arrays_zip("indices", "values"))
    )
    terms = spark.read.parquet(paths["terms"]).select(F.col("index").alias("indices"), "term")
    named = read.join(terms, "indices").join(spark.read.parquet(paths["classes"]), "number")
    return named.select("url", "klass", "term", F.round("values", DIGITS).alias("weight"))


@query
def tfidf_normalized(spark, sf):
    copied = stage(_instances_with_copies(spark, sf), "instances")
    instances = copied.select("url", "klass", "terms")
    rows = V.tfidf(instances, V.vocabulary(V.count_terms(instances), VOCABULARY), normalize=True)
    return rows.withColumn("weight", F.round("weight", DIGITS))


def _classifier(spark, sf) -> TR.Classifier:
    return TR.train_classifier(_training(spark, sf), VOCABULARY)


@query
def nb_priors(spark, sf):
    return _classifier(spark, sf).priors().withColumn("log_prior", F.round("log_prior", DIGITS))


@query
def nb_likelihoods(spark, sf):
    model = _classifier(spark, sf)
    return model.likelihoods().select(
        F.col("token").alias("term"), F.posexplode("log_likelihood").alias("class_idx", "ll")
    ).withColumn("ll", F.round("ll", DIGITS))


def _every_copy(scored: DataFrame) -> DataFrame:
    return scored.withColumn("_", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))


@query
def nb_predict(spark, sf):
    return _every_copy(_classifier(spark, sf).predict()).select("url", "klass", "prediction")


@query
def nb_cross_validation(spark, sf):
    return _every_copy(_classifier(spark, sf).cross_validate()).select(
        "url", "klass", "fold", "prediction"
    )


@query
def nb_confusion(spark, sf):
    return B.confusion(_classifier(spark, sf).cross_validate()).drop("size")


@query
def nb_accuracy(spark, sf):
    matrix = B.confusion(_classifier(spark, sf).cross_validate())
    return B.accuracy(matrix).withColumn("accuracy", F.round("accuracy", DIGITS)).drop("size")


@query
def nb_class_metrics(spark, sf):
    matrix = B.confusion(_classifier(spark, sf).cross_validate())
    rounded = [F.round(c, DIGITS).alias(c) for c in ("precision", "recall", "f1")]
    return B.class_metrics(matrix).select("klass", "instances", "predicted", "correct", *rounded)


@query
def nb_vocabulary_sweep(spark, sf):
    """Cross-validated hits for all vocabulary sizes in one pass."""
    model = TR.train_classifier(_training(spark, sf), SIZES)
    return B.accuracy(B.confusion(model.cross_validate())).drop("accuracy")


@query
def nb_model_json(spark, sf):
    """The exported JSON document, read back as rows."""
    model = _classifier(spark, sf)
    path = work_path(spark, "model")
    sinks.write_model(model.priors(), model.likelihoods(), path)
    classes, terms = sources.read_model(spark, path)
    cells = terms.select(
        F.col("token").alias("term"), F.posexplode("log_likelihood").alias("class_idx", "ll")
    )
    return cells.join(classes, "class_idx").select(
        "term", "klass", F.round("log_prior", DIGITS).alias("log_prior"),
        F.round("ll", DIGITS).alias("ll"),
    )


# Index ----------------------------------------------------------------------------------------


@query
def build_index(spark, sf):
    built = I.build_index(VW.interests(spark, sf))
    return built.select("host", F.array_join("categories", ",").alias("categories"))


@query
def whitelist_sorted(spark, sf):
    return I.sorted_whitelist(I.build_index(VW.interests(spark, sf)))


@query
def index_files(spark, sf):
    """Nested interests and the built index, each through its JSON document of several files."""
    path = work_path(spark, "interests")
    sinks.write_interests(VW.interests(spark, sf), path)
    built = I.build_index(sources.read_interests(spark, path))
    out = work_path(spark, "index")
    sinks.write_index(built, out)
    return sources.read_category_index(spark, out).select(
        "host", F.array_join("categories", ",").alias("categories")
    )


@query
def whitelist_files(spark, sf):
    path = work_path(spark, "whitelist")
    sinks.write_whitelist(VW.category_index(spark, sf), path)
    return sources.read_whitelist(spark, path)


# Files ----------------------------------------------------------------------------------------


@query
def harvest_file_scan(spark, sf):
    """Harvested rows through a compressed tab-separated file."""
    path = work_path(spark, "tsv")
    sinks.write_lines(sinks.harvest_line(_harvested(spark, sf)), path, "bzip2")
    return sources.read_harvest(spark, path)


@query
def harvest_file_rejects(spark, sf):
    """Lines with a field missing are set aside: the rows without keywords, field left out."""
    path = work_path(spark, "tsv")
    fields = [F.when(F.col(c) != "", F.col(c)) for c in sources.HARVEST_FIELDS]
    lines = _harvested(spark, sf).select(F.concat_ws("\t", *fields).alias("value"))
    sinks.write_lines(lines, path, "bzip2")
    return sources.read_harvest_rejects(spark, path)


def _segments(spark, pages: DataFrame) -> str:
    """A list of segments 7 and 8 and their files; all pages are in them. Segment 9 is not listed."""
    base = work_path(spark, "segments")
    unlisted = pages.where(F.col("page_id") % 5 == 0)
    for rows, segment in (
        (pages.where(F.col("page_id") % 2 == 1), "7"),
        (pages.where(F.col("page_id") % 2 == 0), "8"),
        (unlisted, "9"),
    ):
        pairs = rows.select("url", "metadata").rdd.map(tuple)
        pairs.saveAsSequenceFile(f"{base}/segment/{segment}/metadata")
    sinks.write_lines(spark.createDataFrame([("7",), ("8",)], "value STRING"), f"{base}/list")
    return base


@query
def sequence_file_scan(spark, sf):
    """Page metadata through key/value SequenceFiles, each read in several byte ranges."""
    base = _segments(spark, stage(VW.crawl(spark, sf), "crawl"))
    paths = sources.segment_paths(spark, f"{base}/list", base + "/segment/{segment}/metadata*")
    read = sources.read_pages(spark, paths, "sequence", "url", "metadata")
    parsed = read.withColumn("_m", F.explode(F.array(M.parse_metadata(F.col("metadata")))))
    m = F.col("_m")
    return parsed.where(~X.is_blank(F.col("metadata")) & m[M.BAD].isNull()).select(
        "url", m["http_result"].alias("status"), M.page_title(m).alias("title"),
        M.page_keywords(m).alias("keywords"),
    )


def _damaged(spark, sf) -> sources.Segments:
    """The listed segments and a segment of all pages whose files, as many as a listed segment has,
    all break off."""
    pages = stage(VW.crawl(spark, sf), "crawl")
    base = _segments(spark, pages)
    pages.select("url", "metadata").rdd.map(tuple).saveAsSequenceFile(f"{base}/whole")
    VW.broken_copies(spark, f"{base}/whole", f"{base}/segment/broken/metadata-")
    paths = [f"{base}/segment/{s}/metadata*" for s in ("7", "8", "broken")]
    return sources.read_segments(spark, paths, "sequence", "url", "metadata", 0.5)


@query
def segment_pages(spark, sf):
    """The pages of all segments but the unreadable one."""
    blank = F.count(F.when(X.is_blank(F.col("metadata")), 1)).alias("blank")
    return _damaged(spark, sf).pages.groupBy("url").agg(F.count(F.lit(1)).alias("n"), blank)


@query
def segment_files(spark, sf):
    """What the listed segments gave: pages, and whether they are set aside."""
    segment = F.regexp_extract("file", "/segment/([^/]+)/", 1).alias("segment")
    rows = F.sum(F.when(F.col("error").isNull(), F.col("rows")))
    return _damaged(spark, sf).files.groupBy(segment).agg(
        F.coalesce(rows, F.lit(0)).alias("pages"),
        F.max(F.col("error").isNotNull()).alias("unreadable"),
    )


@query
def stop_list_file(spark, sf):
    """Bags with a stop list read from a file with a byte-order mark and other line ends."""
    path = work_path(spark, "stop")
    lines = [(("\ufeff" if i == 0 else "") + word + " \r",) for i, word in enumerate(VW.STOP_WORDS)]
    sinks.write_lines(spark.createDataFrame(lines, "value STRING").coalesce(1), path)
    stop = W.StopWords(sources.read_words(spark, path))
    docs = VW.table(spark, sf, "documents", "doc_id", "text")
    return W.with_bag(docs, "text", stop, ["doc_id"]).select("doc_id", "bag")


@query
def profile_files(spark, sf):
    """Detection with profiles read from JSON files, one object a language."""
    path = work_path(spark, "profiles")
    entry = F.map_from_entries(F.collect_list(F.struct("ngram", "cnt"))).alias("freq")
    files = _profiles(spark, sf).groupBy(F.col("lang").alias("name"), "n_words").agg(entry)
    files.select("name", "n_words", "freq").write.json(path)
    docs = VW.table(spark, sf, "documents", "doc_id", "text")
    table = L.profile_table(sources.read_profiles(spark, path))
    return L.detect_language(docs, table, ["doc_id"]).select("doc_id", "lang")


@query
def language_count_file(spark, sf):
    """The lines of the language-count file."""
    path = work_path(spark, "languages")
    sinks.write_lines(sinks.language_line(L.language_counts(_detected(spark, sf))), path)
    return spark.read.text(path)


@query
def training_terms_bigrams(spark, sf):
    """Training rows of titles that end in Han characters, as overlapping pairs."""
    doc = F.substring_index("url", "/", -1).cast("long")
    wide = [
        F.element_at(F.array(*[F.lit(chr(first + i)) for i in range(n)]), (doc % n + 1).cast("int"))
        for first, n in ((26376, 7), (26085, 1), (26412, 5))
    ]
    rows = VW.corpus(spark, sf).withColumn("title", F.concat("title", F.lit(" "), *wide, F.lit("word")))
    done = TR.training_rows(rows, _stop(spark), "zh-CN", X.han_bigrams)
    return done.select("url", F.md5("tokens").alias("tokens_md5"), "klass")


@query
def split_by_page(spark, sf):
    rows = stage(VW.corpus(spark, sf), "corpus")
    return S.split_by_page(rows, seed="7").select("url", "category", "split")


@query
def training_file(spark, sf):
    """Training rows through the quoted file."""
    path = work_path(spark, "training")
    sinks.write_training(TR.training_rows(_harvested(spark, sf), _stop(spark)), path)
    return (
        spark.read.option("escape", "\\").schema("tokens STRING, klass STRING").csv(path)
    )


@query
def split_files(spark, sf):
    """Lines per part, read from the split's folders."""
    path = work_path(spark, "split")
    rows = stage(_harvested(spark, sf), "harvested")
    sinks.write_split(S.stratified_split(rows, seed="7"), path)
    return spark.read.text(path).select("value", F.col("split").cast("string").alias("split"))


@query
def key_ordered_file(spark, sf):
    """Harvested lines through files in key order."""
    path = work_path(spark, "ordered")
    line = F.concat_ws("\t", *sources.HARVEST_FIELDS).alias("value")
    sinks.write_key_ordered(_harvested(spark, sf).select("url", line), "url", path)
    return spark.read.text(path)
