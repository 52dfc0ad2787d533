"""The pipeline's stages keep their promises on a small table, and queries pass empty tables."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as spec
import corpus_pipeline
from docsieve.llm import queries

FOLDER = "/root/testdata/sf0.001"


def test_all_queries_are_registered():
    names = [n for n in spec.queries() if n.startswith("op")] + ["pipeline"]
    assert sorted(int(n[2:].split("_")[0]) for n in names[:-1]) == list(range(1, 14))
    assert set(names) <= set(spec.queries())


def test_pipeline_runs_stage_by_stage(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, before = docs.columns, {r["doc_id"]: r for r in docs.collect()}
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, FOLDER)
        path = str(tmp_path / name)
        out.write.parquet(path)
        out = spark.read.parquet(path)
        if number < 4:
            assert out.columns == columns
            assert {r["doc_id"] for r in out.select("doc_id").collect()} <= set(before)
            assert out.where(F.col("n_chars") != F.char_length("text")).count() == 0
        docs = out
    assert {"doc_id", "start", "length", "sequence_id", "offset"} <= set(docs.columns)
    assert docs.count() > 50


@pytest.mark.parametrize("name", [n for n in queries.QUERIES if n not in ("op1_warc", "op10_html")])
def test_queries_pass_an_empty_table(spark, tmp_path, name):
    spark.read.parquet(f"{FOLDER}/documents.parquet").limit(0).write.parquet(str(tmp_path / "documents.parquet"))
    assert spec.queries()[name](spark, str(tmp_path)).count() == 0
