import numpy as np
from pyspark.sql import functions as F

from docsieve.operators import skipgram
from docsieve.operators.encode import word_vector_mean


def topics(spark, rows=240):
    """Texts of two topics without a common word, in turn, with a word of their own each."""
    draw = np.random.default_rng(1)
    made = [(i, " ".join([f"{'ab'[i % 2]}{n}" for n in draw.integers(0, 12, 60)] + [f"own{i}"])) for i in range(rows)]
    return spark.createDataFrame(made, "doc_id long, clustering_text string")


def test_word_vectors_never_reach_the_driver(spark, monkeypatch):
    from pyspark.ml.feature import Word2Vec

    def refuse(*args):
        raise AssertionError("MLlib holds the vocabulary and its vectors on the driver")

    monkeypatch.setattr(Word2Vec, "fit", refuse)
    assert word_vector_mean(topics(spark, 20)).count() == 20


def test_topics_part_and_runs_repeat_in_many_pieces(spark):
    docs = topics(spark)
    first, again = (
        {r[0]: np.array(r[1]) for r in skipgram.word_vector_means(x, 32, 7, "doc_id", "clustering_text", 16_000).collect()}
        for x in (docs, docs.repartition(7))
    )
    assert sorted(first) == list(range(240)) and all(np.allclose(first[i], again[i], atol=1e-9) for i in first)
    units = np.array([first[i] / np.linalg.norm(first[i]) for i in range(240)])
    likeness = units @ units.T
    assert likeness[::2, ::2].min() > likeness[::2, 1::2].max()


def test_empty_null_single_and_repeated_rows(spark):
    rows = [(1, ""), (2, None), (None, "x x y"), (3, "x x y"), (3, "x x y"), (4, " x  alone"), (2**60 + 1, "alone2")]
    found = word_vector_mean(spark.createDataFrame(rows, "doc_id long, clustering_text string"), 8).collect()
    assert sorted((r["doc_id"] or 0) for r in found) == [0, 1, 2, 3, 3, 4, 2**60 + 1]
    by = {r["doc_id"]: np.array(r["features"]) for r in found}
    assert not by[1].any() and not by[2].any() and not by[2**60 + 1].any() and by[3].any() and np.allclose(by[None], by[3])
    assert word_vector_mean(spark.createDataFrame([], "doc_id long, clustering_text string")).count() == 0


def test_many_pairs_of_one_word_do_not_overshoot():
    vectors = skipgram._first_vectors(["spam", "egg"], 16, 42)
    skipgram._train(np.array(([0] * 50 + [1]) * 400, np.int32), np.zeros(51 * 400, int), vectors, [42, 0])
    assert np.isfinite(vectors).all() and np.abs(vectors).max() < 10


def test_each_word_is_averaged_over_its_pieces(spark):
    docs = topics(spark, 40).where(F.col("doc_id") < 40)
    one = skipgram.word_vector_means(docs, 8, 3, "doc_id", "clustering_text").collect()
    many = skipgram.word_vector_means(docs, 8, 3, "doc_id", "clustering_text", 1).collect()
    assert len(one) == len(many) == 40 and all(np.isfinite(r["features"]).all() for r in many)
