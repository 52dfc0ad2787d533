import numpy as np
import pytest

from docsieve.functions.patterns import STRUCTURAL_FEATURES
from docsieve.operators import anomaly, forest, stats
from docsieve.operators.encode import encode_documents, word_vector_mean
from docsieve.operators.neighbors import knn_scores, lof_scores
from docsieve.operators.normalize import text_views
from docsieve.operators.structural import feature_vector, structural_features
from docsieve.operators.vectorize import VectorizerSettings


def frame(spark, vectors, parts=3):
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(vectors)]
    return spark.createDataFrame(rows, "doc_id long, features array<double>").repartition(parts)


def scores_of(table):
    return {r["doc_id"]: r["score"] for r in table.collect()}


def planted(rows=600):
    vectors = np.random.default_rng(3).normal(size=(rows, 4))
    vectors[[7, 77]] = [[12, 12, 12, 12], [-15, 10, -9, 8]]
    return vectors


def test_average_path():
    assert forest.average_path(1) == 0 and forest.average_path(2) == 1
    assert forest.average_path(256) == pytest.approx(10.244771, abs=1e-5)


def test_forest_finds_planted_rows_whatever_the_partitioning(spark):
    vectors = planted()
    found = [scores_of(forest.isolation_forest(frame(spark, vectors, p))) for p in (1, 4, 16)]
    assert found[0] == found[1] == found[2]
    assert set(sorted(found[0], key=found[0].get)[:2]) == {7, 77}
    assert all(-1 <= s < 0 for s in found[0].values()) and len(found[0]) == 600
    other = scores_of(forest.isolation_forest(frame(spark, vectors), seed=1))
    assert other != found[0]


def test_forest_edge_tables(spark):
    assert len(scores_of(forest.isolation_forest(frame(spark, np.ones((5, 2)))))) == 5
    assert len(scores_of(forest.isolation_forest(frame(spark, np.ones((1, 2)))))) == 1
    with pytest.raises(ValueError):
        forest.fit_forest(frame(spark, np.ones((2, 2))).where("false"))


def test_sparse_forest_agrees_with_dense(spark):
    """The same trees come out when the terms are given sparse or dense."""
    rng = np.random.default_rng(5)
    terms = np.where(rng.random((200, 6)) < 0.4, rng.random((200, 6)), 0.0)
    terms[:, 0] += 0.1
    block = rng.normal(size=(200, 2))
    rows = [(i, j, float(terms[i, j])) for i in range(200) for j in range(6) if terms[i, j]]
    weights = spark.createDataFrame(rows, "doc_id long, term_id long, weight double")
    sparse = scores_of(forest.sparse_isolation_forest(weights, frame(spark, block), 6))
    dense = scores_of(forest.isolation_forest(frame(spark, np.hstack([terms, block]))))
    assert sparse == pytest.approx(dense)


def test_detectors_flag_planted_rows(spark):
    vectors = planted(200)
    points = frame(spark, vectors)
    for detect in (anomaly.detect_forest, anomaly.detect_lof):
        flagged = {r["doc_id"] for r in detect(points, 0.02).where("is_anomaly").collect()}
        assert {7, 77} <= flagged and len(flagged) <= 6, detect.__name__
    parts = [scores_of(t) for t in (forest.isolation_forest(points), lof_scores(points, 20), knn_scores(points, 5))]
    ranks = [{i: place / 199 for place, i in enumerate(sorted(p, key=lambda i: (p[i], i)))} for p in parts]
    ensemble = anomaly.detect_ensemble(points, 0.02)
    assert scores_of(ensemble) == pytest.approx({i: sum(r[i] for r in ranks) / 3 for i in range(200)})
    assert ensemble.where("is_anomaly").count() == 4
    lonely = np.vstack([np.abs(vectors[:50]) + [5, 0, 0, 0], [[-9.0, 0, 0, 0]]])
    flagged = anomaly.detect_knn(frame(spark, lonely), 0.02, 3).where("is_anomaly")
    assert 50 in {r["doc_id"] for r in flagged.collect()}


def test_ensemble_works_out_each_score_once(spark, monkeypatch):
    scored = spark.sparkContext.accumulator(0)

    def counted(points, *_, **__):
        def run(batches):
            for batch in batches:
                scored.add(len(batch))
                yield batch[["doc_id"]].assign(score=batch["doc_id"] * -1.0)

        return points.mapInPandas(run, "doc_id long, score double")

    for name in ("isolation_forest", "lof_scores", "knn_scores"):
        monkeypatch.setattr(anomaly, name, counted)
    found = anomaly.detect_ensemble(frame(spark, planted(100)), 0.02)
    assert scores_of(found) == pytest.approx({i: (99 - i) / 99 for i in range(100)})
    assert scored.value == 3 * 100


def test_standardized(spark):
    got = anomaly.standardized(frame(spark, [[1, 5], [3, 5], [5, 5]]))
    rows = [r["features"] for r in got.orderBy("doc_id").collect()]
    assert rows == [pytest.approx([-1, 0]), pytest.approx([0, 0]), pytest.approx([1, 0])]


TEXTS = [f"report number {w} about engines and pumps in plant {w}" for w in "one two three four five six seven eight".split()]


def corpus(spark):
    rows = list(enumerate([*TEXTS * 5, "{{{{ ### @@@ 11 22 33 <<>> ||| ~~~"]))
    return text_views(spark.createDataFrame(rows, "doc_id long, text string").repartition(4))


@pytest.mark.parametrize("detect", ["lsa_detection", "lsa_hybrid_detection", "sparse_hybrid_detection"])
def test_text_detectors(spark, detect):
    settings = VectorizerSettings(
        model="tfidf_lsa_dense", max_features=500, max_df=1.0, ngram_range=(3, 5), analyzer="char_wb", dense_dimension=5
    )
    table = getattr(anomaly, detect)(corpus(spark), settings)
    scores = scores_of(table)
    assert len(scores) == 41 and table.where("is_anomaly").count() >= 1
    if detect != "lsa_detection":
        assert min(scores, key=scores.get) == 40


def test_structural_points(spark):
    rows = anomaly.structural_points(corpus(spark), scale=True).collect()
    assert len(rows) == 41 and len(rows[0]["features"]) == len(STRUCTURAL_FEATURES)


def test_encoders(spark):
    def load():
        return lambda texts: np.array([[len(t), t.count("e")] for t in texts])

    docs = spark.createDataFrame([(i, "e" * i) for i in range(150)], "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: r["features"] for r in encode_documents(docs, load, 16).collect()}
    assert got == {i: [float(i), float(i)] for i in range(150)}
    vectors = word_vector_mean(corpus(spark), 8).collect()
    assert len(vectors) == 41 and len(vectors[0]["features"]) == 8


def test_feature_export_joins_every_measure_with_score_and_mask(spark):
    rows = [(i, " ".join(f"plank{(i * j) % (3 + i % 5)}" for j in range(4 + i % 7))) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    scored = structural_features(docs).cache()
    found = anomaly.detect_forest(feature_vector(scored, STRUCTURAL_FEATURES).select("doc_id", "features"), 0.1)
    exported = stats.feature_export(scored, found, STRUCTURAL_FEATURES)
    measures = {r["doc_id"]: r.asDict() for r in scored.collect()}
    scores = {r["doc_id"]: (r["score"], r["is_anomaly"]) for r in found.collect()}
    got = exported.collect()
    assert sorted(r["doc_id"] for r in got) == list(range(40))
    for row in got:
        assert all(row[name] == pytest.approx(measures[row["doc_id"]][name]) for name in STRUCTURAL_FEATURES)
        assert (-row["if_score"], row["is_anomaly"]) == scores[row["doc_id"]]
