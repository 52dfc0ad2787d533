"""Counts packed in a row per document against the long tables."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from docsieve.operators import forest, grams, lsa, neighbors
from docsieve.operators import vectorize as V
from docsieve.operators.grams import unpacked
from docsieve.plans.jobs import CorpusJobs

WORDS = V.VectorizerSettings(max_df=1.0, ngram_range=(1, 2))
CHARACTERS = V.VectorizerSettings(max_df=1.0, max_features=60, ngram_range=(3, 5), analyzer="char_wb")
TEXTS = [
    ("a", "hello world hello  wörld x"), ("b", None), ("c", ""), ("d", "the cat sat on the cat sat the"),
    ("e", "a 😀b word"), ("f", "solo"), ("a", "hello other world"), (None, "null id words words"), (None, "more words"),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(TEXTS, "doc_id string, text string")


@pytest.mark.parametrize("settings", [WORDS, CHARACTERS, V.VectorizerSettings(max_df=1.0, ngram_range=(2, 3))])
def test_batches_count_as_long_tables(docs, settings):
    counts = V.term_counts(docs, settings)
    fitted, packed = V.fit_packed(docs, settings)
    want = V.vocabulary(counts, len(TEXTS), settings).collect()
    assert sorted(map(tuple, V.text_vocabulary(docs, len(TEXTS), settings).collect())) == sorted(map(tuple, want))
    terms = [row["term"] for row in fitted.orderBy("term_id").collect()]
    rows = packed.table.collect()
    assert len(rows) == len(TEXTS)
    got = [(str(r["doc_id"]), terms[t], int(c)) for r in rows for t, c in zip(*unpacked(r["n"], r["data"]), strict=True)]
    assert sorted(got) == sorted((str(r["doc_id"]), r["term"], r["tf"]) for r in V.bag_of_words(counts, fitted, settings).collect())


def test_long_batches_are_counted_in_pieces(spark, monkeypatch):
    texts = [" ".join(f"w{(i * j) % 991}" for j in range(9_000 + i)) for i in range(1, 41)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").coalesce(1)
    fitted, packed = V.fit_packed(docs, V.VectorizerSettings(max_df=1.0, ngram_range=(1, 1)))
    total = {row["term"]: row["total_tf"] for row in fitted.collect()}
    every = [word for text in texts for word in text.split()]
    assert len(every) > grams.PIECE_WORDS and total == dict(pd.Series(every).value_counts())
    assert packed.table.count() == len(texts) == packed.table.where("n > 0").select("doc_id").distinct().count()
    monkeypatch.setattr(grams, "PIECE_WORDS", 4)
    lists = [["a"] * n if n is not None else None for n in (3, 1, 2, 9, 0, None, 4, 0)]
    batch = pa.RecordBatch.from_arrays([pa.array(lists, pa.list_(pa.string()))], ["words"])
    pieces = [piece.column(0).to_pylist() for piece in grams._pieces(batch, 0)]
    assert [[len(words or []) for words in piece] for piece in pieces] == [[3, 1], [2], [9], [0, 0, 4, 0]]
    assert [words for piece in pieces for words in piece] == lists


def test_vectors_and_projection_follow_the_long_weights(docs):
    _, weights = V.fit_transform(docs, CHARACTERS)
    _, packed = V.fit_packed(docs, CHARACTERS)

    def lists(table):
        return sorted((str(r["doc_id"]), [round(float(x), 9) for x in r["features"]]) for r in table.collect())

    once = docs.where("text IS NULL OR text <> 'hello other world'")
    tables = V.packed_vectors(V.fit_packed(once, CHARACTERS)[1], 60), V.sparse_vectors(V.fit_transform(once, CHARACTERS)[1], 60, docs=once)
    dense = [
        sorted((str(r["doc_id"]), list(r["features"].indices), [round(x, 9) for x in r["features"].values]) for r in table.collect())
        for table in tables
    ]
    assert dense[0] == dense[1]
    long = lsa.project(weights, lsa.fit_projection(weights, 3, tolerance=1e-10, terms=len(packed.idf)), docs=docs)
    short = lsa.project(packed, lsa.fit_projection(packed, 3, tolerance=1e-10))
    for (name, left), (other, right) in zip(lists(long), lists(short), strict=True):
        assert name == other and np.allclose(left, right, atol=1e-6)


def test_rows_of_one_id_have_one_vector(docs):
    _, packed = V.fit_packed(docs, CHARACTERS)
    rows = {}
    for row in V.packed_vectors(packed, 60).collect():
        rows.setdefault(row["doc_id"], []).append(row["features"])
    assert len(rows["a"]) == 2 and rows["a"][0] == rows["a"][1] and rows["a"][0].numNonzeros() > 0
    assert len(rows[None]) == 2 and all(vector.numNonzeros() == 0 for vector in rows[None])


def test_sparse_forest_scores_packed_counts_as_weights(docs):
    known = docs.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    _, weights = V.fit_transform(known, CHARACTERS)
    _, packed = V.fit_packed(known, CHARACTERS)
    dense = known.select("doc_id", F.array(F.length(F.coalesce("text", F.lit(""))).cast("double")).alias("features"))
    scores = [
        {r["doc_id"]: r["score"] for r in forest.sparse_isolation_forest(w, dense, len(packed.idf), trees=20).collect()}
        for w in (weights, packed)
    ]
    assert scores[0].keys() == scores[1].keys() == {"a", "b", "c", "d", "e", "f"}
    assert all(scores[0][name] == pytest.approx(scores[1][name], abs=1e-9) for name in scores[0])


def test_parts_follow_the_bytes_and_not_the_shuffle_width(spark, docs, monkeypatch):
    _, packed = V.fit_packed(docs.where("text <> ''").crossJoin(spark.range(40)).drop("id"), CHARACTERS)
    monkeypatch.setattr(lsa, "BLOCK", 1)
    spark.conf.set("spark.sql.shuffle.partitions", "200")
    try:
        _, parts = lsa._parted(packed.table, "doc_id", 280)
        assert parts <= 2 * spark.sparkContext.defaultParallelism
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_pairs_held_follow_the_queries(monkeypatch):
    rng = np.random.default_rng(3)
    rows = pd.DataFrame({"rep": np.arange(3000), "v": list(rng.normal(size=(3000, 3)))})
    data = rows.assign(ids=[[i, i + 10_000] for i in rows["rep"]], chunk=np.repeat(np.arange(6), 500))
    asked = rows.iloc[:200].assign(bound=np.inf, wanted=[np.packbits([True] * 6).tobytes()] * 200)
    whole = neighbors._nearest_kernel(5, 1.0)(asked, data)
    assert len(neighbors._near_pairs(asked, data, 5, 1.0)[0]) == 200 * 3
    monkeypatch.setattr(neighbors, "KEPT_PAIRS", 700)
    cut = neighbors._nearest_kernel(5, 1.0)(asked, data)
    pd.testing.assert_frame_equal(whole, cut)
    gap = np.linalg.norm(np.vstack(rows["v"])[:200, None] - np.vstack(rows["v"])[None], axis=2)
    gap[np.arange(200), np.arange(200)] = np.inf
    assert np.allclose(np.sort(gap, axis=1)[:, :3].repeat(2, axis=1)[:, :5].ravel(), cut["distance"])


def test_compressed_term_matrix_has_the_same_lines(spark, docs, tmp_path):
    articles = docs.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    lines = []
    for name, compression in (("plain", None), ("small", "gzip")):
        path = str(tmp_path / name)
        CorpusJobs(articles).export_bag_of_words(path, compression=compression)
        lines.append([row["value"] for row in spark.read.text(path).collect()])
        assert any(part.suffix == ".gz" for part in (tmp_path / name).glob("part-*")) == (compression == "gzip")
    assert sorted(lines[0]) == sorted(lines[1]) and len(lines[0]) == 7
