"""Command line: spark-submit … gleaner/__main__.py <job> …, or python -m gleaner <job> …"""

from __future__ import annotations

import argparse
import os

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from gleaner import sinks, sources
from gleaner.functions import text
from gleaner.operators import bayes, language, split, vectors
from gleaner.operators.domains import SuffixRules
from gleaner.operators.joins import Dictionary
from gleaner.operators.spellings import with_spellings
from gleaner.operators.words import StopWords
from gleaner.plans import increments, index, texts, titles, training
from gleaner.session import build_session
from gleaner.workspace import stage


TOKENIZERS = {"words": text.training_tokens, "han-bigrams": text.han_bigrams}


def _pages(spark: SparkSession, args, value: str):
    paths = sources.segment_paths(spark, args.segments, args.template)
    read = sources.read_segments(spark, paths, args.format, args.key, value, args.tolerance)
    read.quarantined().write.parquet(f"{args.out}/unreadable")
    return read.pages.repartition(args.partitions) if args.partitions else read.pages


def _rules(spark: SparkSession, args) -> SuffixRules:
    path = args.suffix_rules
    rules = sources.read_suffix_rules(spark, path) if path else sources.bundled_suffix_rules(spark)
    return SuffixRules(rules)


def _stop_words(spark: SparkSession, args) -> StopWords:
    return StopWords(sources.read_words(spark, args.stop_words))


def _batch(args) -> str:
    return args.batch or os.path.basename(args.segments)


def run_titles(spark: SparkSession, args) -> None:
    path = args.index or sources.category_index_path(args.index_dir, args.region, args.variation)
    categories = Dictionary(with_spellings(sources.read_category_index(spark, path), "host"))
    pages = _pages(spark, args, args.value or "metadata").toDF("url", "metadata")
    if not args.state:
        titles.run_title_harvest(spark, pages, categories, _rules(spark, args), args.out)
        return
    state = increments.State(spark, args.state, increments.TITLES)
    increments.add_titles(state, _batch(args), pages, categories, _rules(spark, args), args.out)
    state.compact()
    increments.title_statistics(state).write.parquet(f"{args.out}/all_statistics")


def run_texts(spark: SparkSession, args) -> None:
    pages = _pages(spark, args, args.value or "text").toDF("url", "text")
    profiles = language.profile_table(sources.read_profiles(spark, args.profiles))
    white = Dictionary(with_spellings(sources.read_whitelist(spark, args.whitelist), "domain"))
    given = (pages, profiles, white, _rules(spark, args), _stop_words(spark, args), args.out)
    if not args.state:
        texts.run_text_harvest(spark, *given, args.language)
        return
    state = increments.State(spark, args.state, increments.TEXTS)
    increments.add_texts(state, _batch(args), *given, args.language)
    state.compact()
    sinks.write_lines(sinks.bag_line(state.table("bags")), f"{args.out}/all_bags_tsv")
    sinks.write_lines(sinks.language_line(state.table("languages")), f"{args.out}/all_languages_tsv")
    increments.text_statistics(state).write.parquet(f"{args.out}/all_statistics")


def _tokenizer(args):
    return TOKENIZERS[args.tokenizer] if args.tokenizer else None


def run_training(spark: SparkSession, args) -> None:
    rows = sources.read_harvest(spark, args.harvest)
    training_rows = training.training_rows(
        rows, _stop_words(spark, args), args.region, _tokenizer(args)
    )
    sinks.write_training(training_rows, f"{args.out}/training")
    training.labels(rows).write.parquet(f"{args.out}/labels_table")
    labels = spark.read.parquet(f"{args.out}/labels_table")
    sinks.write_lines(sinks.labels_entries(labels), f"{args.out}/labels_entries")
    sinks.write_lines(
        sources.read_harvest_rejects(spark, args.harvest).toDF("value"), f"{args.out}/rejects"
    )
    if args.documents:
        sinks.write_lines(sinks.labels_json(labels), f"{args.out}/labels")


def run_classifier(spark: SparkSession, args) -> None:
    rows = sources.read_harvest(spark, args.harvest)
    pages = training.page_tokens(rows, _stop_words(spark, args), args.region, _tokenizer(args))
    model = training.train_classifier(pages, tuple(args.sizes), args.folds)

    def written(df, name: str):
        df.write.parquet(f"{args.out}/{name}")
        return spark.read.parquet(f"{args.out}/{name}")

    priors = written(model.priors(), "priors")
    likelihoods = written(model.likelihoods(), "likelihoods")
    sinks.write_lines(sinks.model_entries(likelihoods), f"{args.out}/model_entries")
    matrix = written(bayes.confusion(model.cross_validate()), "confusion")
    written(bayes.accuracy(matrix), "accuracy")
    written(bayes.class_metrics(matrix), "class_metrics")
    written(model.vectors(), "vectors")
    training.export_vectors(model.instances, model.vocabulary, f"{args.out}/sparse")
    if args.documents:
        for size in args.sizes:
            document = sinks.model_json(priors, likelihoods.where(F.col("size") == size))
            sinks.write_lines(document, f"{args.out}/w{size}/model_json")


def run_split(spark: SparkSession, args) -> None:
    rows = stage(sources.read_harvest(spark, args.harvest), "harvest")
    parts = split.split_by_page if args.by_page else split.stratified_split
    sinks.write_split(parts(rows, args.seed), args.out)


def run_index(spark: SparkSession, args) -> None:
    built = index.build_index(sources.read_interests(spark, args.interests))
    built.where(F.col("categories").isNotNull()).write.parquet(f"{args.out}/index_table")
    usable = spark.read.parquet(f"{args.out}/index_table")
    sinks.write_lines(sinks.index_entries(usable), f"{args.out}/index_entries")
    sinks.write_lines(sinks.whitelist_entries(usable), f"{args.out}/whitelist_entries")
    if args.documents:
        sinks.write_lines(sinks.index_json(usable), f"{args.out}/index")
        sinks.write_lines(sinks.whitelist_json(usable), f"{args.out}/whitelist")


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="gleaner")
    jobs = top.add_subparsers(required=True)

    def job(name, run):
        sub = jobs.add_parser(name)
        sub.set_defaults(run=run)
        sub.add_argument("--out", required=True)
        return sub

    def documents(sub):
        sub.add_argument(
            "--documents", action="store_true",
            help="also as one JSON value each, which one task builds and readers hold whole",
        )

    for name, run in (("titles", run_titles), ("texts", run_texts)):
        sub = job(name, run)
        sub.add_argument("--segments", required=True, help="file with one segment id per line")
        sub.add_argument("--template", required=True, help="path pattern with {segment}")
        sub.add_argument("--format", default="sequence")
        sub.add_argument("--key", default="url")
        sub.add_argument("--partitions", type=int, help="spread an input of few splits")
        sub.add_argument(
            "--tolerance", type=float, default=sources.TOLERANCE,
            help="share of the files that may be unreadable; they are listed in OUT/unreadable",
        )
        sub.add_argument(
            "--state",
            help="folder of a state that these segments are merged into; what all batches give"
            " together is in OUT/all_*",
        )
        sub.add_argument("--batch", help="name of these segments there (default: the list's name)")
        sub.add_argument("--value", help="value column of a columnar input")
        sub.add_argument("--suffix-rules", help="default: the list shipped with Spark")
        if name == "titles":
            where = sub.add_mutually_exclusive_group(required=True)
            where.add_argument("--index-dir", help="folder of REGION[.VARIATION].json")
            where.add_argument("--index", help="an index, also as the index job writes it")
            sub.add_argument("--region", "--region-code", default="en-US")
            sub.add_argument("--variation", default="")
        else:
            for option in ("--profiles", "--whitelist", "--stop-words"):
                sub.add_argument(option, required=True)
            sub.add_argument("--language", default=texts.LANGUAGE)
    for name, run in (("training", run_training), ("classifier", run_classifier)):
        sub = job(name, run)
        sub.add_argument("--harvest", required=True)
        sub.add_argument("--stop-words", required=True)
        sub.add_argument("--region", default="en-US")
        sub.add_argument("--tokenizer", choices=sorted(TOKENIZERS))
        documents(sub)
        if name == "classifier":
            sub.add_argument("--sizes", type=int, nargs="+", default=list(vectors.VOCABULARY_SIZES))
            sub.add_argument("--folds", type=int, default=bayes.FOLDS)
    sub = job("split", run_split)
    sub.add_argument("--harvest", required=True)
    sub.add_argument("--seed", default="0")
    sub.add_argument("--by-page", action="store_true", help="keep a page's rows in one part")
    sub = job("index", run_index)
    sub.add_argument("--interests", required=True)
    documents(sub)
    return top


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    args = parser().parse_args(argv)
    args.run(spark or build_session(), args)


if __name__ == "__main__":
    main()
