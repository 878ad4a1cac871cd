import corpus_pipeline as C
from pyspark.sql import functions as F

from acreage.llm.decontam import leaks
from acreage.llm.minhash_join import near_duplicates

FOLDER = "/root/testdata/sf0.001"


def test_stages_keep_the_columns_and_take_effect(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    odd = spark.createDataFrame([(9001, None, None, None, None), (9002, "", "en", "s", 0), (9003, "123 456", "en", "s", 7)], docs.schema)
    extra = ["doc", "dedup", "_predicted_language", "rest", "lang_pred", "a.b"]
    docs = docs.unionByName(odd).withColumns({c: F.lit(f"extra {c}") for c in extra})
    ids = {r.doc_id for r in docs.select("doc_id").collect()}
    for name, apply in C.STAGES:
        docs = C.stage(apply(spark, docs, FOLDER), name)
        if name != C.STAGES[-1][0]:
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars", *extra], name
            assert [r.asDict() for r in docs.select(*[f"`{c}`" for c in extra]).distinct().collect()] == [
                {c: f"extra {c}" for c in extra}], name
        left = {r.doc_id for r in docs.select("doc_id").collect()}
        assert left <= ids
        if name == "language_id":
            assert ids - left == {9001, 9002, 9003}
        if name == "near_dedup":
            assert near_duplicates(docs).where("not first").count() == 0
        if name == "decontamination":
            assert leaks(docs, spark.read.parquet(f"{FOLDER}/benchmark.parquet")).count() == 0
        ids = left
    assert docs.where(F.size("pieces") != F.col("n_pieces")).count() == 0
    assert len(ids) > 150


def test_empty_documents(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(0)
    for name, apply in C.STAGES:
        docs = C.stage(apply(spark, docs, FOLDER), name)
    assert docs.count() == 0


def test_queries_are_registered():
    import __spark_entry__ as E

    names = list(E.queries())
    assert {n.split("_")[0] for n in names if n.startswith("op")} == {f"op{i}" for i in range(1, 14)} and "pipeline" in names
    assert set(E.oracle_sql()) <= set(names)


def test_a_line_that_repeats_between_differing_neighbours_goes(spark):
    rows = [(i, f"first of {i}\nall rights reserved\nlast of {i}", "en", "s", 0) for i in range(5)]
    docs = spark.createDataFrame(rows, spark.read.parquet(f"{FOLDER}/documents.parquet").schema)
    left = {r.doc_id: r.text for r in C.lines(spark, docs, FOLDER).collect()}
    assert left == {0: rows[0][1], **{i: f"first of {i}\nlast of {i}" for i in range(1, 5)}}
