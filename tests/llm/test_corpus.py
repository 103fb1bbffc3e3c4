"""The pipeline and the registration of its queries."""

from pyspark.sql import functions as F

import corpus_pipeline
import __spark_entry__ as entry


def test_every_operator_is_registered():
    names = entry.queries()
    assert all(sum(n.startswith(f"op{i}_") for n in names) == 1 for i in range(1, 14)) and "pipeline" in names


def test_pipeline(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = corpus_pipeline.run(spark, sf).collect()
    ids = [r.doc_id for r in rows]
    assert 0 < len(ids) == len(set(ids)) <= docs.count()
    assert all(r.n_tokens == len(r.ids) for r in rows)


def test_stages_keep_columns_and_odd_rows(spark):
    sf = "/root/testdata/sf0.001"
    odd = spark.createDataFrame([(None, "a null key with words enough", "en", "s", 5), (900, None, "en", None, None), (901, "", None, "s", 0), (902, "x", "en", "s", 1), (902, "x", "en", "s", 1)], "doc_id long, text string, lang string, source string, n_chars long")
    docs = spark.read.parquet(f"{sf}/documents.parquet").unionByName(odd)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf)
        assert out.columns == docs.columns, name
        assert out.count() > 0
    empty = docs.limit(0)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, sf).count() == 0


def test_stages_keep_columns_that_clash_with_their_own(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(60)
    names = ("score", "rejected", "lang_pred", "own_score", "own_row", "__row", "row", "doc")
    wide = docs.select("*", *(F.concat(F.lit(f"{n} of "), F.col("doc_id").cast("string")).alias(n) for n in names))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, wide, sf)
        assert out.columns == wide.columns, name
        assert all(r[n] == f"{n} of {r.doc_id}" for r in out.collect() for n in names), name


def test_leaks_of_null_and_shared_ids(spark):
    sf = "/root/testdata/sf0.001"
    item = spark.read.parquet(f"{sf}/benchmark.parquet").where("length(text) > 60").first()["text"]
    rows = [(None, item), (7, item), (7, "a clean text of another kind"), (8, "clean as well")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = corpus_pipeline.benchmark_leaks(spark, docs, sf).collect()
    assert sorted(r.text for r in out) == ["a clean text of another kind", "clean as well"]


def test_queries_equal_their_sql(spark):
    import oracle
    from voltaria.llm import queries

    con = oracle.connect("/root/testdata/sf0.001")
    for name, sql in queries.ORACLES.items():
        assert oracle.compare(queries.QUERIES[name](spark, "/root/testdata/sf0.001"), con, sql) == [], name
