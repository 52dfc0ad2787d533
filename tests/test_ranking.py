import numpy as np
import pytest
from pyspark.sql import functions as F

from docsieve.operators import anomaly, compare, ranking, stats
from docsieve.operators.lookup import attach_text, top_with_snippets


def scores_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id string, score double, is_anomaly boolean")


def test_fixed_count_and_mask(spark):
    scores = scores_of(spark, [("A", -0.1, False), ("B", -0.4, True), ("C", -0.3, False), ("D", -0.2, True)])
    rows = ranking.anomaly_output(scores, 3).orderBy("anomaly").collect()
    assert [tuple(r) for r in rows] == [(1, "B"), (2, "C"), (3, "D")]
    masked = scores_of(spark, [("A", -0.3, False), ("B", -0.1, True), ("C", -0.2, False)])
    assert [tuple(r) for r in ranking.anomaly_output(masked, None).collect()] == [(1, "B")]
    assert ranking.anomaly_output(masked, 0).count() == 0
    assert ranking.anomaly_output(masked.where("false"), None).columns == ["anomaly", "doc_id"]
    assert ranking.anomaly_output(masked, 99).count() == 3


def test_candidates_and_snippets(spark):
    scores = scores_of(spark, [("DOC_001", -0.10, False), ("DOC_002", -0.42, True), ("DOC_003", -0.21, True)])
    table = ranking.candidate_table(scores, mask_col="is_anomaly")
    assert table.where("anomaly_rank = 1").first()["doc_id"] == "DOC_002"
    docs = spark.createDataFrame(
        [("DOC_001", "notes on pruning an orchard"), ("DOC_002", "win $$$\ncut off <table>")],
        "doc_id string, text string",
    )
    rows = top_with_snippets(table, docs, 2).orderBy("anomaly_rank").collect()
    assert [r["doc_id"] for r in rows] == ["DOC_002", "DOC_003"]
    assert rows[0]["snippet"] == "win $$$ cut off <table>" and rows[1]["snippet"] == ""


def test_attach_text(spark):
    table = spark.createDataFrame([("DOC_002", -0.5), ("DOC_009", -0.2)], "doc_id string, score double")
    docs = spark.createDataFrame(
        [("DOC_002", "first", 0), ("DOC_002", "last of two", 1), ("DOC_001", "x", 2)],
        "doc_id string, text string, row_seq long",
    )
    got = {r["doc_id"]: r["text"] for r in attach_text(table, docs).collect()}
    assert got == {"DOC_002": "last of two", "DOC_009": ""}
    with pytest.raises(KeyError):
        attach_text(table.drop("doc_id"), docs)


@pytest.mark.parametrize("parts", [1, 4, 16])
def test_global_rank_with_heavy_ties(spark, parts):
    """A third of the rows share one score; ranks stay whole and ordered by id."""
    rows = [(i, 0.5 if i % 3 == 0 else (i * 37 % 1000) / 1000) for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, score double").repartition(parts)
    got = {r["doc_id"]: r["r"] for r in ranking.global_rank(df, ["score", "doc_id"], "r").collect()}
    order = sorted(rows, key=lambda row: (row[1], row[0]))
    assert got == {row[0]: place for place, row in enumerate(order, start=1)}
    assert ranking.global_rank(df.where("false"), ["score"], "r").count() == 0


@pytest.mark.parametrize("rows", [1, 2, 7, 2500, 30000])
def test_exact_quantiles(spark, rows):
    rng = np.random.default_rng(rows)
    values = np.where(rng.random(rows) < 0.33, 0.25, rng.random(rows))
    other = rng.integers(0, 5, rows).astype(float)
    df = spark.createDataFrame(list(zip(values.tolist(), other.tolist(), strict=True)), "a double, b double")
    points = [0.0, 0.02, 0.05, 0.25, 0.5, 0.75, 0.95, 1.0]
    got = ranking.exact_quantiles(df, ["a", "b"], points)
    assert got["a"] == pytest.approx(np.quantile(values, points), abs=1e-12)
    assert got["b"] == pytest.approx(np.quantile(other, points), abs=1e-12)


def test_quantiles_skip_nulls(spark):
    df = spark.createDataFrame([(None,), (1.0,), (3.0,)], "a double")
    assert ranking.quantile(df, "a", 0.5) == 2.0
    assert ranking.quantile(df.where("a is null"), "a", 0.5) is None


def test_masks(spark):
    rows = [(i, float(i)) for i in range(101)]
    df = spark.createDataFrame(rows, "doc_id long, score double")
    assert anomaly.contamination_mask(df, 0.05).where("is_anomaly").count() == 5
    assert anomaly.ensemble_mask(df, 0.05).where("is_anomaly").count() == 6
    negative = df.withColumn("score", -F.col("score"))
    assert anomaly.distance_mask(negative, 0.05).where("is_anomaly").count() == 6
    assert anomaly.threshold_score(df, 0.025).first()["threshold"] == 2.0


def test_threshold_score_is_an_order_statistic(spark):
    for n in (1, 2, 7, 101, 30000):
        # Rising values with ties, in scattered order.
        df = spark.range(n).select(F.col("id").alias("doc_id"), F.floor(F.col("id") * 7919 % n / 3).cast("double").alias("score"))
        ordered = sorted(float(i * 7919 % n // 3) for i in range(n))
        for share in (0.0, 0.025, 0.5, 0.999):
            assert anomaly.threshold_score(df, share).first()["threshold"] == ordered[int(n * share)]
        assert anomaly.threshold_score(df, 1.0).count() == 0


def test_rank_average(spark):
    a = spark.createDataFrame([("x", 1.0), ("y", 2.0), ("z", 3.0)], "doc_id string, score double")
    b = spark.createDataFrame([("x", 9.0), ("y", 1.0), ("z", 5.0)], "doc_id string, score double")
    got = {r["doc_id"]: r["score"] for r in anomaly.rank_average([a, b]).collect()}
    assert got == pytest.approx({"x": 0.5, "y": 0.25, "z": 0.75})
    single = anomaly.rank_average([a.limit(1)]).first()
    assert single["score"] == 0.0


def test_overlap_and_spearman(spark):
    rng = np.random.default_rng(5)
    a, b = rng.integers(0, 9, 200), rng.integers(0, 9, 200)
    left = spark.createDataFrame([(i, float(x)) for i, x in enumerate(a)], "doc_id long, score double")
    right = spark.createDataFrame([(i, float(x)) for i, x in enumerate(b)], "doc_id long, score double")

    def top(values, k):
        return {i for i, _ in sorted(enumerate(values), key=lambda e: (e[1], e[0]))[:k]}

    got = {r["sets"]: tuple(r)[1:] for r in compare.overlap_sets({"a": left, "b": right, "c": left}, 20).collect()}
    shared = len(top(a, 20) & top(b, 20))
    assert got["a&b"] == (shared, 40 - shared) and got["a&c"] == (20, 20) and got["a&b&c"] == (shared, 40 - shared)
    curve = {r["top_k"]: r["overlap_count"] for r in compare.overlap_curve(left, right).collect()}
    assert curve == {k: len(top(a, k) & top(b, k)) for k in (10, 25, 50, 75, 100)}

    def average_rank(values):
        return np.array([(values < v).sum() + ((values == v).sum() + 1) / 2 for v in values])

    want = np.corrcoef(average_rank(a), average_rank(b))[0, 1]
    assert compare.spearman(left, right).first()[0] == pytest.approx(want)


def test_cosine_spread(spark):
    rng = np.random.default_rng(2)
    vectors = rng.normal(size=(20, 4))
    vectors[3] = 0
    lengths = np.linalg.norm(vectors, axis=1)
    units = vectors / np.where(lengths > 0, lengths, 1)[:, None]
    cosines = 1 - units @ units.T
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "doc_id long, features array<double>")
    want = cosines[np.triu_indices(20, 1)].mean()
    assert compare.set_cosine_spread(df).first()[0] == pytest.approx(want, abs=1e-4)


def test_random_baseline_ignores_partitioning(spark):
    df = spark.range(500).withColumnRenamed("id", "doc_id")
    picks = [sorted(r[0] for r in compare.random_baseline(df.repartition(p)).collect()) for p in (1, 4, 16)]
    assert picks[0] == picks[1] == picks[2] and len(picks[0]) == 50


def test_precision_and_profile(spark):
    features = spark.createDataFrame(
        [(i, 0.5 if i < 5 else 0.9, 0.4 if i < 8 else 0.7) for i in range(10)],
        "doc_id long, bigram_type_token_ratio double, compression_ratio double",
    )
    scores = features.select("doc_id", F.col("doc_id").cast("double").alias("score"))
    row = compare.structural_precision({"m": scores}, features, 10).first()
    assert row["structural_precision"] == 0.5
    profile = compare.detector_profile({"m": scores}, features, ["compression_ratio"], 8)
    assert {r["detector"]: r[1] for r in profile.collect()} == {"m": 0.4, "baseline": 0.46}


def test_statistics(spark):
    rng = np.random.default_rng(0)
    data = np.column_stack([rng.normal(size=400), rng.normal(size=400), np.zeros(400)])
    data[:, 1] = data[:, 0] * 0.9 + 0.1 * data[:, 1]
    df = spark.createDataFrame([tuple(map(float, r)) for r in data], "a double, b double, c double")
    row = stats.describe_features(df, ["a"]).first()
    assert row["std"] == pytest.approx(data[:, 0].std(ddof=1)) and row["p5"] == pytest.approx(np.quantile(data[:, 0], 0.05))
    counts, edges = np.histogram(data[:, 0], 50)
    got = stats.histogram(df, "a", 50).orderBy("bin").collect()
    assert [r["count"] for r in got] == counts.tolist() and got[-1]["bin_end"] == pytest.approx(edges[-1])
    assert sum(r["count"] for r in stats.histogram(df, "c", 10).collect()) == 400
    matrix = stats.pearson_matrix(df, ["a", "b", "c"])
    assert matrix.where("feature_a = 'a' and feature_b = 'c'").first()["correlation"] is None
    strong = stats.strong_pairs(matrix, ["a", "b", "c"]).collect()
    assert [(r["feature_a"], r["feature_b"]) for r in strong] == [("b", "a")]
    assert strong[0]["correlation"] == pytest.approx(np.corrcoef(data[:, 0], data[:, 1])[0, 1])
    assert stats.tail(df, "a", 0.05).count() == 20
    flagged = df.withColumn("flag", F.col("a") > 0)
    means = {r["feature"]: r for r in stats.flag_separation(flagged, ["a", "c"], "flag").collect()}
    assert means["a"]["flagged_mean"] == pytest.approx(data[data[:, 0] > 0, 0].mean())
    assert means["c"]["ratio"] == 0.0


def test_best_rows(spark):
    rows = spark.createDataFrame(
        [("a", 2, 0.1), ("a", 3, 0.4), ("b", 2, None), ("b", 4, 0.4)], "method string, k int, s double"
    )
    best = {r["method"]: r["k"] for r in ranking.best_per_group(rows, "method", "s", ["k"]).collect()}
    assert best == {"a": 3, "b": 4}
    assert ranking.global_best(rows, "s", ["method"]).first()["method"] == "a"


def test_extremes_and_side_by_side(spark):
    docs = spark.createDataFrame([(i, f"text\n{i}") for i in range(4)], "doc_id long, text string")
    features = spark.createDataFrame([(i, float(3 - i), float(i % 2)) for i in range(4)], "doc_id long, f double, g double")
    got = {r["feature"]: (r["doc_id"], r["snippet"]) for r in ranking.extreme_documents(features, ["f", "g"], docs).collect()}
    assert got == {"f": (3, "text 3"), "g": (0, "text 0")}
    assert [r["doc_id"] for r in ranking.lowest_with_text(features, "f", docs, 2).orderBy("f").collect()] == [3, 2]
    left = features.select("doc_id", F.col("f").alias("score"))
    right = features.select("doc_id", F.col("g").alias("score"))
    rows = ranking.side_by_side(left, right, docs, 2).orderBy("rank").collect()
    assert [(r["left_doc_id"], r["right_doc_id"]) for r in rows] == [(3, 0), (2, 2)]
