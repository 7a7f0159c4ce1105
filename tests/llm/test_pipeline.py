import corpus_pipeline
import pytest

from checks.compare import database
from gleaner.llm import queries
from gleaner.llm import jaccard, quality

SF = "/root/testdata/sf0.001"


def test_names_and_stages():
    import __spark_entry__ as entry

    names = [n for n in entry.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 11))
    assert "pipeline" in entry.queries() and set(queries.ORACLE) <= set(queries.QUERIES)
    assert [n for n, _ in corpus_pipeline.STAGES][1] == "near_duplicates"


def test_stages_take_on_what_the_one_before_kept(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, kept = docs.columns, docs.count()
    for name, step in corpus_pipeline.STAGES:
        before = {r.doc_id for r in docs.select("doc_id").collect()}
        docs = step(spark, docs, SF)
        after = {r.doc_id for r in docs.select("doc_id").collect()}
        assert after <= before
        if name != "tokens":
            assert docs.columns == columns
        if name in ("secrets", "tokens"):
            assert after == before
    assert 0.5 * kept < docs.count() <= kept


def test_near_duplicates_keep_the_least_of_each_component(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    found = jaccard.join_near(docs).toPandas()
    kept = {r.doc_id for r in jaccard.one_of_each(docs).collect()}
    assert kept == set(found.component_id)


def test_toxic_or_good_documents_pass_quality(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    model = quality.fit_quality(docs, labels, quality.graded())
    kept = quality.select_quality(docs, model).join(labels, "doc_id").toPandas()
    clean = labels.where("quality = 1 AND toxic = 0").count()
    assert ((kept.quality == 1) & (kept.toxic == 0)).sum() > 0.995 * clean


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_against_sql(spark, name):
    from checks.compare import rows_of

    ours = queries.QUERIES[name](spark, SF).toPandas()
    theirs = database(SF).sql(queries.ORACLE[name]).df()
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert rows_of(ours) == rows_of(theirs)
