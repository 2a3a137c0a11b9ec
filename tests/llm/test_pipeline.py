from pyspark.sql import functions as F

import corpus_pipeline
from contrail.llm import decontamination, langid
from tests.llm.test_jaccard import least_of_groups


def test_stages_on_their_own_inputs(spark, sf_dir):
    """Each stage against brute force over what the stage before kept."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, kept = docs.columns, []
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = stage(spark, docs, sf_dir).cache()
        kept.append((name, before, docs))
        assert name == "packing" or docs.columns == columns
    by = {name: (a, b) for name, a, b in kept}
    a, b = by["language_id"]
    letters = {r.doc_id for r in a.collect() if r.text and any(map(str.isalpha, r.text))}
    assert {r.doc_id for r in b.collect()} <= letters and b.count() >= 0.99 * len(letters)
    a, b = by["line_dedup"]
    assert a.count() == b.count() and b.where("n_chars <> char_length(text)").count() == 0
    a, b = by["near_duplicates"]
    assert {r.doc_id for r in b.collect()} == least_of_groups([(r.doc_id, r.text) for r in a.select("doc_id", "text").collect()])
    a, b = by["decontamination"]
    bench = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    bad = {r.doc_id for r in decontamination.scan(a, bench).where(decontamination.contaminated()).collect()}
    assert bad and {r.doc_id for r in b.collect()} == {r.doc_id for r in a.collect()} - bad
    a, b = by["packing"]
    assert b.groupBy("doc_id").agg(F.sum("length").alias("n"), F.max("doc_tokens").alias("m")).where("n <> m").count() == 0
    assert b.select("doc_id").distinct().count() == a.count()


def test_stages_on_odd_rows(spark, odd_docs, no_docs, tmp_path):
    bench = spark.createDataFrame([(1, "copyright notice alpha"), (None, None)], "item_id long, text string")
    bench.write.parquet(str(tmp_path / "benchmark.parquet"))
    for start in (odd_docs.select("doc_id", "text", "lang", "source", "n_chars", "label", "key"), no_docs):
        docs = start
        for _, stage in corpus_pipeline.STAGES[:4]:
            docs = stage(spark, docs, str(tmp_path)).cache()
            assert docs.columns == start.columns
        assert corpus_pipeline.STAGES[4][1](spark, docs, str(tmp_path)).count() >= docs.count()


def test_held_out_rows(spark):
    rows = spark.range(100).withColumnRenamed("id", "doc_id").withColumn("h", langid.held_out())
    assert 0 < rows.where("h").count() < 60
