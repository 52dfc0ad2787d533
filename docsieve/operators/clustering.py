"""K-means, agglomerative and graph clustering, and the choice of the cluster count."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docsieve.operators.hierarchy import MergeTree
from docsieve.operators.neighbors import Search, nearest_neighbors
from docsieve.operators.silhouette import silhouette, silhouette_runs
from docsieve.operators.spectral import NeighborGraph, spectral_embedding
from docsieve.session import settle

# Cluster counts tried when none is given.
CANDIDATE_COUNTS = (4, 6, 8, 10)

# Rows of one partition in k-means; the number of partitions sets its first draw, so it follows from the table alone.
ROWS_PER_PARTITION = 100_000
LEAST_PARTITIONS = 8


@dataclass(frozen=True)
class Clustering:
    """Labels ``(id, label)`` and the number of clusters asked for."""

    labels: DataFrame
    cluster_count: int
    centers: list[np.ndarray] | None = None


def _as_vectors(points: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """MLlib vectors in an order that depends neither on how the input was split nor on the session's settings."""
    partitions = max(LEAST_PARTITIONS, -(-points.count() // ROWS_PER_PARTITION))
    column = F.col(vector_col)
    if isinstance(points.schema[vector_col].dataType, T.ArrayType):
        column = array_to_vector(column.cast("array<double>"))
    return (
        points.select(id_col, column.alias("_v"))
        .repartition(partitions, id_col)
        .sortWithinPartitions(id_col)
    )


def kmeans(
    points: DataFrame,
    k: int,
    seed: int = 42,
    id_col: str = "doc_id",
    vector_col: str = "features",
    max_iter: int = 300,
) -> Clustering:
    """MLlib k-means on dense arrays or sparse vectors."""
    vectors = _as_vectors(points, id_col, vector_col).persist()
    try:
        if k <= 1:
            return Clustering(points.select(id_col, F.lit(0).alias("label")), 1)
        model = KMeans(k=k, seed=seed, maxIter=max_iter, tol=1e-4, featuresCol="_v", predictionCol="label").fit(vectors)
        return Clustering(
            settle(model.transform(vectors).select(id_col, "label")), k, [np.asarray(c) for c in model.clusterCenters()]
        )
    finally:
        vectors.unpersist()


def kmeans_embeddings(
    embeddings: DataFrame, k: int = 8, seed: int = 42, id_col: str = "doc_id", vector_col: str = "features"
) -> Clustering:
    """K-means with a fixed count on dense embeddings."""
    return kmeans(embeddings, k, seed, id_col, vector_col)


def usable_counts(candidates: Sequence[int], rows: int) -> list[int]:
    return [k for k in candidates if 2 <= k < rows]


def choose_clustering(
    points: DataFrame,
    cluster: Callable[[int], Clustering],
    candidates: Sequence[int] = CANDIDATE_COUNTS,
    id_col: str = "doc_id",
    vector_col: str = "features",
    metric: str = "euclidean",
) -> Clustering:
    """The candidate with the highest silhouette; the first one wins a tie.

    The winning fit is returned as it is.  Fits with a single label are skipped,
    and without usable candidates two clusters are made (one for a single row).
    ``metric`` is the silhouette's; see :func:`docsieve.operators.silhouette.silhouette`
    for the one that stays linear in the number of rows.
    """
    points = points.select(id_col, vector_col)
    rows = points.count()
    usable = usable_counts(candidates, rows)
    if not usable:
        return cluster(2 if rows >= 2 else 1)
    fitted = {k: cluster(k) for k in usable}
    if metric == "euclidean":
        scores = silhouette_runs(points, {k: found.labels for k, found in fitted.items()}, id_col, vector_col)
    else:
        several = {k: found for k, found in fitted.items() if found.labels.select("label").distinct().count() > 1}
        scores = {k: silhouette(points.join(found.labels, id_col), "label", id_col, vector_col, metric) for k, found in several.items()}
    best, best_score = fitted[usable[0]], -1.0
    for k in usable:
        score = scores.get(k)
        if score is not None and score > best_score:
            best, best_score = fitted[k], score
    return best


def cluster_kmeans(
    points: DataFrame,
    preferred: int | None = None,
    candidates: Sequence[int] = CANDIDATE_COUNTS,
    seed: int = 42,
    id_col: str = "doc_id",
    vector_col: str = "features",
    metric: str = "euclidean",
) -> Clustering:
    """K-means with a given count, or with the count chosen by silhouette."""
    if preferred:
        return kmeans(points, preferred, seed, id_col, vector_col)
    return choose_clustering(
        points, lambda k: kmeans(points, k, seed, id_col, vector_col), candidates, id_col, vector_col, metric
    )


class Agglomerative:
    """The exact Ward or average-cosine tree of the rows, built once and cut at any count; see ``MergeTree``."""

    def __init__(
        self,
        points: DataFrame,
        linkage: str = "ward",
        id_col: str = "doc_id",
        vector_col: str = "features",
        finish: int | None = None,
    ) -> None:
        self.tree = MergeTree(points, linkage, id_col, vector_col, finish)

    def cut(self, k: int) -> Clustering:
        return Clustering(self.tree.cut(k), k)

    def cuts(self, counts: Sequence[int]) -> dict[int, Clustering]:
        """All counts from one pass over the rows."""
        rows = settle(self.tree.cuts(counts))
        return {k: Clustering(rows.where(F.col("k") == k).drop("k"), k) for k in counts}


def cluster_agglomerative(
    points: DataFrame,
    preferred: int | None = None,
    candidates: Sequence[int] = CANDIDATE_COUNTS,
    linkage: str = "ward",
    id_col: str = "doc_id",
    vector_col: str = "features",
    metric: str = "euclidean",
) -> Clustering:
    """Agglomerative clustering with a given count or the best silhouette."""
    tree = Agglomerative(points, linkage, id_col, vector_col)
    if preferred:
        return tree.cut(preferred)
    return choose_clustering(points, tree.cut, candidates, id_col, vector_col, metric)


def spectral(
    points: DataFrame,
    k: int,
    neighbors: int = 6,
    seed: int = 42,
    id_col: str = "doc_id",
    vector_col: str = "features",
    search: Search = nearest_neighbors,
    graph: NeighborGraph | None = None,
) -> Clustering:
    """K-means on the spectral embedding of the neighbour graph in ``k`` dimensions; ``graph`` as for ``spectral_embedding``."""
    embedded = settle(spectral_embedding(points, k, neighbors, seed, id_col, vector_col, search, graph))
    return Clustering(kmeans(embedded, k, seed, id_col, "features").labels, k)


def cluster_output(points: DataFrame, labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``(id, label)``, with ``row_seq`` when the documents carry it."""
    extra = [name for name in ("row_seq",) if name in points.columns]
    return points.select(id_col, *extra).join(labels, id_col).select(id_col, "label", *extra)
