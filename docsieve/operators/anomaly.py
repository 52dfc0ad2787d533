"""Detectors: scores with masks, the rank ensemble, and ready feature choices."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docsieve.functions.patterns import STRUCTURAL_FEATURES
from docsieve.operators.forest import isolation_forest, sparse_isolation_forest
from docsieve.operators.lsa import fit_projection, project
from docsieve.operators.neighbors import knn_scores, lof_scores
from docsieve.operators.ranking import order_statistic, quantile, rank_normalized
from docsieve.operators.structural import feature_vector, structural_features
from docsieve.operators.vectorize import (
    VectorizerSettings,
    concat_blocks,
    fit_packed,
)
from docsieve.session import settle

# The character-gram settings of the text-based detectors.
CHARACTER_SETTINGS = VectorizerSettings(
    model="tfidf_lsa_dense", max_features=30000, min_df=1, max_df=1.0, ngram_range=(3, 5), analyzer="char_wb"
)


def contamination_mask(scores: DataFrame, share: float) -> DataFrame:
    """``is_anomaly``: score strictly below the lower quantile."""
    return scores.withColumn("is_anomaly", F.col("score") < F.lit(quantile(scores, "score", share)))


def ensemble_mask(scores: DataFrame, share: float) -> DataFrame:
    """``is_anomaly``: score at or below the lower quantile."""
    return scores.withColumn("is_anomaly", F.col("score") <= F.lit(quantile(scores, "score", share)))


def distance_mask(scores: DataFrame, share: float) -> DataFrame:
    """``is_anomaly`` for negated distances: distance at or above its upper quantile."""
    distances = scores.withColumn("_distance", -F.col("score"))
    limit = quantile(distances, "_distance", 1.0 - share)
    return distances.withColumn("is_anomaly", F.col("_distance") >= F.lit(limit)).drop("_distance")


def threshold_score(scores: DataFrame, share: float = 0.025) -> DataFrame:
    """One row ``(threshold)``: the score at position ``floor(n * share)`` in ascending order; none beyond the last."""
    value = order_statistic(scores, "score", share)
    return scores.sparkSession.createDataFrame([] if value is None else [(value,)], "threshold double")


def rank_average(tables: Sequence[DataFrame], id_col: str = "doc_id") -> DataFrame:
    """``(id, score)``: mean of the normalised ranks of several score tables."""
    ranked = [rank_normalized(table, id_col, "score", f"_r{i}") for i, table in enumerate(tables)]
    joined = reduce(lambda left, right: left.join(right, id_col), ranked)
    mean = reduce(lambda a, b: a + b, [F.col(f"_r{i}") for i in range(len(ranked))]) / len(ranked)
    return joined.select(id_col, mean.alias("score"))


def detect_forest(points: DataFrame, share: float = 0.02, seed: int = 42, id_col: str = "doc_id") -> DataFrame:
    return contamination_mask(settle(isolation_forest(points, id_col, seed=seed)), share)


def detect_lof(points: DataFrame, share: float = 0.02, neighbors: int = 20, id_col: str = "doc_id") -> DataFrame:
    return contamination_mask(settle(lof_scores(points, neighbors, id_col)), share)


def detect_knn(points: DataFrame, share: float = 0.02, neighbors: int = 5, id_col: str = "doc_id") -> DataFrame:
    return distance_mask(settle(knn_scores(points, neighbors, id_col)), share)


def detect_ensemble(
    points: DataFrame,
    share: float = 0.02,
    lof_neighbors: int = 20,
    knn_neighbors: int = 5,
    seed: int = 42,
    id_col: str = "doc_id",
) -> DataFrame:
    """Rank average of forest, outlier factor and neighbour distance."""
    # Settled, because ranking reads its scores three times: for their number, a sample of them and their order.
    tables = [
        settle(isolation_forest(points, id_col, seed=seed)),
        settle(lof_scores(points, lof_neighbors, id_col)),
        settle(knn_scores(points, knn_neighbors, id_col)),
    ]
    return ensemble_mask(settle(rank_average(tables, id_col)), share)


def standardized(points: DataFrame, vector_col: str = "features") -> DataFrame:
    """Vectors with zero mean and unit deviation per dimension; constant dimensions become 0."""
    from pyspark.ml.feature import StandardScaler
    from pyspark.ml.functions import array_to_vector, vector_to_array

    shaped = points.withColumn("_v", array_to_vector(vector_col))
    scaler = StandardScaler(inputCol="_v", outputCol="_s", withMean=True, withStd=True).fit(shaped)
    return scaler.transform(shaped).withColumn(vector_col, vector_to_array("_s")).drop("_v", "_s")


def structural_points(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", scale: bool = False
) -> DataFrame:
    """``(id, features)`` of all structural measures, unscaled unless asked."""
    features = structural_features(docs, id_col, text_col)
    points = feature_vector(features, STRUCTURAL_FEATURES).select(id_col, "features")
    return standardized(points) if scale else points


def lsa_points(
    docs: DataFrame,
    settings: VectorizerSettings = CHARACTER_SETTINGS,
    id_col: str = "doc_id",
    text_col: str = "anomaly_text",
) -> DataFrame:
    """``(id, features)``: character-gram TF-IDF in the latent space."""
    _, counts = fit_packed(docs, settings, id_col, text_col)
    return project(counts, fit_projection(counts, settings.dense_dimension, settings.seed, id_col), id_col)


def lsa_detection(
    docs: DataFrame,
    settings: VectorizerSettings = CHARACTER_SETTINGS,
    share: float = 0.02,
    id_col: str = "doc_id",
    text_col: str = "anomaly_text",
) -> DataFrame:
    """Isolation forest on the latent space alone."""
    return detect_forest(settle(lsa_points(docs, settings, id_col, text_col)), share, settings.seed, id_col)


def lsa_hybrid_detection(
    docs: DataFrame,
    settings: VectorizerSettings = CHARACTER_SETTINGS,
    share: float = 0.02,
    id_col: str = "doc_id",
    text_col: str = "anomaly_text",
    raw_col: str = "text",
) -> DataFrame:
    """Isolation forest on the latent space and the structural measures together."""
    latent = lsa_points(docs, settings, id_col, text_col)
    both = concat_blocks(latent, structural_points(docs, id_col, raw_col), id_col=id_col)
    return detect_forest(settle(both), share, settings.seed, id_col)


def sparse_hybrid_detection(
    docs: DataFrame,
    settings: VectorizerSettings = CHARACTER_SETTINGS,
    share: float = 0.02,
    id_col: str = "doc_id",
    text_col: str = "anomaly_text",
    raw_col: str = "text",
) -> DataFrame:
    """Isolation forest on the sparse weights and the structural measures together."""
    _, counts = fit_packed(docs, settings, id_col, text_col)
    scores = sparse_isolation_forest(
        counts, settle(structural_points(docs, id_col, raw_col)), len(counts.idf), id_col, seed=settings.seed
    )
    return contamination_mask(settle(scores), share)
