"""The four jobs: topic labels, ranked anomalies, term matrix, and both in one run."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from docsieve.functions.cleaning import ANOMALY_SETTINGS, CLUSTERING_SETTINGS, CleaningSettings
from docsieve.functions.patterns import STRUCTURAL_FEATURES
from docsieve.operators.anomaly import detect_ensemble, detect_forest
from docsieve.operators.clustering import (
    Clustering,
    cluster_agglomerative,
    cluster_kmeans,
    cluster_output,
    kmeans_embeddings,
)
from docsieve.operators.lsa import fit_projection, project
from docsieve.operators.normalize import text_views
from docsieve.operators.ranking import anomaly_output
from docsieve.operators.structural import feature_vector, structural_features
from docsieve.operators.vectorize import (
    VectorizerSettings,
    fit_packed,
    fit_transform,
    packed_vectors,
    sparse_vectors,
    term_counts,
    term_popularity,
    text_vocabulary,
    with_vocabulary,
)
from docsieve.session import settle, stored
from docsieve.sources.buckets import BucketCache
from docsieve.sources.cache import load_cache, save_cache
from docsieve.sources.tables import write_anomalies, write_clusters
from docsieve.sources.termmatrix import write_term_matrix

# Settings of the topic job.
TOPIC_SETTINGS = VectorizerSettings(model="tfidf", max_features=20000, min_df=1, max_df=0.92, ngram_range=(1, 2))
AGGLOMERATIVE_DIMENSION = 100
EMBEDDING_CLUSTERS = 8
ANOMALY_ROWS = 50

CACHED = ("views", "vocabulary", "weights", "structural")


@dataclass
class CorpusJobs:
    """Jobs over one article table ``(doc_id, text[, row_seq])``.

    Each feature set is built when a job first needs it, kept for the next job,
    and, with ``cache_folder``, kept for the next run on the same texts.
    """

    docs: DataFrame
    preferred_clusters: int | None = None
    contamination: float = 0.02
    seed: int = 42
    anomaly_rows: int | None = ANOMALY_ROWS
    cache_folder: str | None = None
    settings: VectorizerSettings = TOPIC_SETTINGS
    clustering_view: CleaningSettings = CLUSTERING_SETTINGS
    anomaly_view: CleaningSettings = ANOMALY_SETTINGS
    silhouette_metric: str = "euclidean"
    _features: dict[str, DataFrame] = field(default_factory=dict, init=False, repr=False)

    def _fingerprint_text(self) -> str:
        return repr((self.settings, self.clustering_view, self.anomaly_view))

    def load_features(self) -> bool:
        """Take the features from the cache folder when they fit texts and settings."""
        found = load_cache(
            self.docs.sparkSession, self.cache_folder, CACHED, self.docs, self._fingerprint_text()
        )
        if found is None:
            return False
        self._features.update(found)
        return True

    def prepare(self) -> None:
        """Build or load every feature set, and store it when there is a cache folder."""
        if self.load_features():
            return
        for name in CACHED:
            self.features(name)
        save_cache(
            self.cache_folder, {name: self._features[name] for name in CACHED}, self.docs, self._fingerprint_text()
        )

    def features(self, name: str) -> DataFrame:
        """One feature table by name: views, vocabulary, weights or structural."""
        if name not in self._features:
            self._features[name] = getattr(self, f"_build_{name}")()
        return self._features[name]

    def _by_bucket(self, name: str, compute: Callable[[DataFrame], DataFrame]) -> DataFrame:
        """A table of one row per document; with a cache folder only changed buckets of ids are computed."""
        return BucketCache(f"{self.cache_folder}/buckets").rows(name, self.docs, compute, self._fingerprint_text())

    def _build_views(self) -> DataFrame:
        def views(docs: DataFrame) -> DataFrame:
            return text_views(docs, "text", self.clustering_view, self.anomaly_view)

        # Without a cache not written: a job reads one of the views, once.
        return self._by_bucket("views", views) if self.cache_folder else views(self.docs)

    def _build_vocabulary(self) -> DataFrame:
        model, weights = fit_transform(self.features("views"), self.settings, text_col="clustering_text")
        self._features["weights"] = settle(weights)
        return model.fitted

    def _build_weights(self) -> DataFrame:
        self.features("vocabulary")
        return self._features["weights"]

    def _build_structural(self) -> DataFrame:
        return self._by_bucket("structural", structural_features) if self.cache_folder else settle(structural_features(self.docs))

    def cluster(
        self, method: str = "kmeans", embeddings: DataFrame | None = None, path: str | None = None
    ) -> DataFrame:
        """``(doc_id, label)`` by k-means or agglomerative clustering of TF-IDF, or of given embeddings."""
        if embeddings is not None:
            found = kmeans_embeddings(embeddings, EMBEDDING_CLUSTERS, self.seed)
        elif method == "kmeans":
            points = self._topic_points()
            found = cluster_kmeans(
                points, self.preferred_clusters, seed=self.seed, metric=self.silhouette_metric
            )
        elif method == "agglomerative":
            found = self._agglomerative()
        else:
            raise ValueError(f"Unknown method '{method}'; use kmeans or agglomerative.")
        labels = cluster_output(self.docs, found.labels)
        if path:
            write_clusters(labels, path)
        return labels.select("doc_id", "label")

    def _topic_points(self) -> DataFrame:
        """The documents' TF-IDF vectors; long weights only where a cache or another job has them."""
        if "weights" in self._features or self.cache_folder or self.settings.max_features is None:
            width = self.features("vocabulary").count()
            return sparse_vectors(self.features("weights"), max(width, 1), docs=self.docs)
        _, counts = fit_packed(self.features("views"), self.settings, text_col="clustering_text")
        return packed_vectors(counts, max(len(counts.idf), 1))

    def _agglomerative(self) -> Clustering:
        weights = self.features("weights")
        projection = fit_projection(
            weights, AGGLOMERATIVE_DIMENSION, self.seed, terms=self.features("vocabulary").count()
        )
        points = settle(project(weights, projection, docs=self.docs))
        return cluster_agglomerative(points, self.preferred_clusters, metric=self.silhouette_metric)

    def anomalies(self, use_ensemble: bool = False, path: str | None = None) -> DataFrame:
        """``(anomaly, doc_id)`` by isolation forest or by the three-detector ensemble."""
        points = feature_vector(self.features("structural"), STRUCTURAL_FEATURES).select("doc_id", "features")
        detect = detect_ensemble if use_ensemble else detect_forest
        ranked = anomaly_output(detect(points, self.contamination, seed=self.seed), self.anomaly_rows)
        if path:
            write_anomalies(ranked, path)
        return ranked

    def export_bag_of_words(self, path: str, compression: str | None = None) -> DataFrame:
        """Write the term matrix and return ``(output_csv_path, document_count, term_count)``.

        Nearly all cells are zeros, so ``compression`` (as ``gzip``) makes the files many times smaller.
        """
        settings = VectorizerSettings(
            model="bow", max_features=self.settings.max_features, min_df=1, max_df=1.0, ngram_range=(1, 1)
        )
        total = self.docs.count()
        counts = term_counts(self.features("views"), settings, text_col="clustering_text")
        vocab = settle(text_vocabulary(self.features("views"), total, settings, "clustering_text"))
        kept = stored(with_vocabulary(counts, vocab.select("term"), settings))
        ranking = settle(term_popularity(kept))
        write_term_matrix(self.docs, kept, ranking, path, compression=compression)
        return self.docs.sparkSession.createDataFrame(
            [(path, total, ranking.count())], "output_csv_path string, document_count long, term_count long"
        )

    def run(
        self,
        method: str = "kmeans",
        use_ensemble: bool = False,
        embeddings: DataFrame | None = None,
        clusters_path: str | None = None,
        anomalies_path: str | None = None,
    ) -> tuple[DataFrame, DataFrame]:
        """Topic labels and ranked anomalies over one feature set."""
        return (
            self.cluster(method, embeddings, clusters_path),
            self.anomalies(use_ensemble, anomalies_path),
        )

