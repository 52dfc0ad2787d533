import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from docsieve.functions.lists import char_wb_ngrams, count_items, longest_run, word_ngrams
from docsieve.operators import vectorize as V
from docsieve.operators.lsa import fit_projection, project


def docs_of(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def weights_of(table):
    return {(r["doc_id"], r["term"]): r["weight"] for r in table.collect()}


def test_list_helpers(spark):
    df = spark.createDataFrame([(["b", "a", "b", "b"],), ([],)], "w array<string>")
    rows = df.select(
        count_items(F.col("w")).alias("c"), longest_run(F.col("w")).alias("r"), word_ngrams(F.col("w"), 1, 2).alias("g")
    ).collect()
    assert [(e["term"], e["tf"]) for e in rows[0]["c"]] == [("a", 1), ("b", 3)]
    assert rows[0]["r"] == 2 and rows[1]["r"] == 0 and rows[1]["c"] == [] and rows[1]["g"] == []
    assert rows[0]["g"] == ["b", "a", "b", "b", "b a", "a b", "b b"]


def test_char_grams(spark):
    def plain(word):
        padded, found = f" {word} ", []
        for n in range(3, 6):
            found.append(padded[:n])
            found += [padded[i : i + n] for i in range(1, len(padded) - n + 1)]
            if n >= len(padded):
                break
        return found

    words = ["a", "ab", "abc", "abcdefg", "é!"]
    df = spark.createDataFrame([(words,)], "w array<string>")
    got = df.select(char_wb_ngrams(F.col("w"), 3, 5).alias("g")).first()["g"]
    assert Counter(got) == Counter(g for w in words for g in plain(w))


def test_one_letter_tokens_are_dropped(spark):
    counts = V.term_counts(docs_of(spark, ["a b cd"]), V.VectorizerSettings(ngram_range=(1, 2)))
    assert [r["term"] for r in counts.collect()] == ["cd"]


def test_tfidf_values(spark):
    texts = ["harbour storm", "harbour calm harbour"]
    settings = V.VectorizerSettings(max_df=1.0, ngram_range=(1, 1))
    model, table = V.fit_transform(docs_of(spark, texts), settings)
    idf = {"harbour": 1.0, "storm": math.log(3 / 2) + 1, "calm": math.log(3 / 2) + 1}
    raw = [{"harbour": 1.0, "storm": idf["storm"]}, {"harbour": 1 + math.log(2), "calm": idf["calm"]}]
    want = {}
    for i, row in enumerate(raw):
        length = math.sqrt(sum(v * v for v in row.values()))
        want.update({(i, t): v / length for t, v in row.items()})
    assert weights_of(table) == pytest.approx(want)
    assert weights_of(model.transform(docs_of(spark, texts))) == pytest.approx(want)
    assert [r["term"] for r in model.feature_names().collect()] == ["calm", "harbour", "storm"]


def test_bounds_and_cap(spark):
    texts = ["x1 y1 zz", "x1 y1", "x1 qq"]
    counts = V.term_counts(docs_of(spark, texts), V.VectorizerSettings(ngram_range=(1, 1)))

    def kept(**options):
        return [r["term"] for r in V.vocabulary(counts, 3, V.VectorizerSettings(**options)).orderBy("term_id").collect()]

    assert kept(max_df=1.0) == ["qq", "x1", "y1", "zz"]
    assert kept(max_df=0.95) == ["qq", "y1", "zz"]
    assert kept(max_df=1) == ["qq", "zz"]
    assert kept(max_df=1.0, min_df=2) == ["x1", "y1"]
    assert kept(max_df=1.0, max_features=3) == ["qq", "x1", "y1"]
    assert kept(max_df=1.0, max_features=None) == ["qq", "x1", "y1", "zz"]


def test_bow_and_names(spark):
    model, table = V.fit_transform(
        docs_of(spark, ["valve leak", "valve noise"]), V.VectorizerSettings(model="bow", max_df=1.0)
    )
    assert {(r["doc_id"], r["term"]): r["tf"] for r in table.collect()}[(0, "valve")] == 1
    assert "valve" in {r["term"] for r in model.feature_names().collect()}


def test_alias_and_unknown_model():
    assert V.VectorizerSettings(model="tfidf_svd_dense").model == "tfidf_lsa_dense"
    with pytest.raises(ValueError):
        V.VectorizerSettings(model="word2vec")
    with pytest.raises(ValueError):
        V.VectorizerSettings(analyzer="char")


def test_dense_model(spark):
    texts = ["orchard apple harvest", "violin string concert", "glacier ice survey"]
    settings = V.VectorizerSettings(model="tfidf_svd_dense", max_df=1.0, dense_dimension=4)
    model, table = V.fit_transform(docs_of(spark, texts), settings)
    rows = table.collect()
    assert len(rows) == 3 and all(len(r["features"]) <= 4 for r in rows)
    assert model.feature_names().count() == 0
    fresh = model.transform(docs_of(spark, ["violin violin", "unseen words"])).orderBy("doc_id").collect()
    assert np.abs(fresh[0]["features"]).sum() > 0 and np.abs(fresh[1]["features"]).sum() == 0


def test_projection_matches_numpy(spark):
    rng = np.random.default_rng(3)
    dense = (rng.random((60, 4)) * [9, 5, 2, 1]) @ rng.random((4, 40)) + 0.001 * rng.random((60, 40))
    rows = [(i, j, float(dense[i, j])) for i in range(60) for j in range(40)]
    weights = spark.createDataFrame(rows, "doc_id long, term_id long, weight double")
    results = []
    for parts in (1, 5, 40):
        fitted = fit_projection(weights.repartition(parts, "doc_id"), 4)
        results.append(fitted)
        assert fitted.singular_values == pytest.approx(np.linalg.svd(dense, compute_uv=False)[:4], rel=1e-6)
        assert fitted.matrix().T @ fitted.matrix() == pytest.approx(np.eye(4), abs=1e-9)
    assert results[0].matrix() == pytest.approx(results[2].matrix(), abs=1e-4)
    got = {r["doc_id"]: r["features"] for r in project(weights, results[0]).collect()}
    assert np.array([got[i] for i in range(60)]) == pytest.approx(dense @ results[0].matrix(), abs=1e-9)


def test_sparse_vectors_and_blocks(spark):
    docs = docs_of(spark, ["aa bb", "", "aa"])
    model, table = V.fit_transform(docs, V.VectorizerSettings(max_df=1.0, ngram_range=(1, 1)))
    vectors = {r["doc_id"]: r["features"] for r in V.sparse_vectors(table, 2, docs=docs).collect()}
    assert vectors[1].numNonzeros() == 0 and vectors[2].toArray().tolist() == [1.0, 0.0]
    left = spark.createDataFrame([(0, [1.0, 2.0])], "doc_id long, features array<double>")
    both = V.concat_blocks(left, left)
    assert both.first()["features"] == [1.0, 2.0, 1.0, 2.0]
    assert V.last_columns(both, 3).first()["features"] == [2.0, 1.0, 2.0]


def test_popularity_and_preview(spark):
    docs = docs_of(spark, ["bb aa bb", "aa cc", "bb"])
    counts = V.term_counts(docs, V.VectorizerSettings(ngram_range=(1, 1)))
    ranked = V.term_popularity(counts).orderBy("term_rank").collect()
    assert [(r["term"], r["total_tf"], r["term_rank"]) for r in ranked] == [("bb", 3, 1), ("aa", 2, 2), ("cc", 1, 3)]
    vocab = V.vocabulary(counts, 3, V.VectorizerSettings(max_df=1.0))
    preview = V.bow_preview(docs, counts, vocab, 2, 2)
    assert preview.columns == ["doc_id", "bb", "aa"]
    assert {tuple(r) for r in preview.collect()} == {(0, 2, 1), (1, 0, 1)}
