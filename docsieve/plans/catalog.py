"""Every operator as a named query over the test tables: ``name -> f(spark, folder)``."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace
from functools import cache, partial

import numpy as np
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docsieve.functions.cleaning import ANOMALY_SETTINGS, CLUSTERING_SETTINGS, normalize
from docsieve.functions.patterns import STRUCTURAL_FEATURES
from docsieve.operators import anomaly, clustering, compare, descent, evaluation, neighbors, ranking, silhouette, stats
from docsieve.operators import vectorize as V
from docsieve.operators.encode import encode_documents, word_vector_mean
from docsieve.operators.forest import isolation_forest
from docsieve.operators.lookup import attach_text, top_with_snippets
from docsieve.operators.lsa import fit_projection, project
from docsieve.operators.normalize import document_tokens, normalize_with_lexicon, text_views, view_preview
from docsieve.operators.spectral import neighbor_nodes
from docsieve.operators.structural import NATIVE_FEATURES, feature_vector, structural_features
from docsieve.plans.jobs import TOPIC_SETTINGS, CorpusJobs
from docsieve.session import settle, shared_folder
from docsieve.sources import articles as article_source
from docsieve.sources.articles import as_articles, spread
from docsieve.sources.tables import load_embeddings
from docsieve.sources.termmatrix import matrix_lines

Query = Callable[[SparkSession, str], DataFrame]

UNIGRAMS = V.VectorizerSettings(model="bow", max_features=20000, min_df=1, max_df=1.0, ngram_range=(1, 1))
PREVIEW_TERMS = V.VectorizerSettings(model="bow", max_features=20000, min_df=2, max_df=0.95, ngram_range=(1, 1))
CHARACTER_TERMS = V.VectorizerSettings(model="bow", max_features=30000, max_df=1.0, ngram_range=(3, 5), analyzer="char_wb")
# Latent dimensions before Ward and average linkage, cluster counts of the method sweeps.
WARD_DIMENSION, AVERAGE_DIMENSION = 100, 128
SWEEP_COUNTS = tuple(range(2, 11))
# Rows of a cell or piece in the queries that show that the cut changes no result.
SMALL_PIECE = 16

# ---- inputs ---------------------------------------------------------------


def table(spark: SparkSession, folder: str, name: str, key: str) -> DataFrame:
    """A test table, spread over the cores when the file gives too few splits."""
    return spread(spark.read.parquet(f"{folder}/{name}.parquet"), key)


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents", "doc_id")


def embeddings(spark: SparkSession, folder: str) -> DataFrame:
    """``(vec_id, features, label)``."""
    stored = table(spark, folder, "embeddings", "vec_id")
    return stored.select("vec_id", F.col("embedding").cast("array<double>").alias("features"), "label")


def clustering_texts(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder)
    return docs.withColumn("clustering_text", normalize(F.coalesce("text", F.lit("")), CLUSTERING_SETTINGS))


def anomaly_texts(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder)
    return docs.withColumn("anomaly_text", normalize(F.coalesce("text", F.lit("")), ANOMALY_SETTINGS))


def features(spark: SparkSession, folder: str, names: tuple[str, ...] = NATIVE_FEATURES) -> DataFrame:
    return structural_features(documents(spark, folder), features=names)


def points(spark: SparkSession, folder: str, names: tuple[str, ...] = NATIVE_FEATURES) -> DataFrame:
    exact = rounded(features(spark, folder, names), *names, digits=9)
    return feature_vector(exact, names).select("doc_id", "features")


def feature_score(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One structural measure taken as an anomaly score ``(doc_id, score)``."""
    return features(spark, folder, (name,)).select("doc_id", F.round(name, 9).alias("score"))


def three_scores(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """Three rankings from one settled pass over the documents."""
    names = ("bigram_type_token_ratio", "lexical_entropy", "average_token_length")
    base = settle(features(spark, folder, names))
    return {
        short: base.select("doc_id", F.round(name, 9).alias("score"))
        for short, name in zip(("bigram", "entropy", "length"), names, strict=True)
    }


def topic_weights(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """TF-IDF weights of the clustering view and the documents they belong to."""
    docs = clustering_texts(spark, folder)
    return V.fit_transform(docs, TOPIC_SETTINGS, text_col="clustering_text")[1], docs


def rounded(df: DataFrame, *names: str, digits: int = 6) -> DataFrame:
    return df.withColumns({name: F.round(name, digits) for name in names})


# ---- text views -----------------------------------------------------------


def load_articles(spark: SparkSession, folder: str) -> DataFrame:
    return article_source.load_articles(spark, f"{folder}/documents.parquet", "doc_id", "text")


def articles(spark: SparkSession, folder: str) -> DataFrame:
    return as_articles(documents(spark, folder))


def load_embedding_table(spark: SparkSession, folder: str) -> DataFrame:
    found = load_embeddings(spark, f"{folder}/embeddings.parquet", "vec_id", "embedding")
    total = F.aggregate("features", F.lit(0.0), lambda acc, x: acc + x)
    return found.select("vec_id", F.size("features").alias("dimensions"), F.round(total, 4).alias("component_sum"))


def clustering_view(spark: SparkSession, folder: str) -> DataFrame:
    return clustering_texts(spark, folder).select("doc_id", "clustering_text")


def anomaly_view(spark: SparkSession, folder: str) -> DataFrame:
    return anomaly_texts(spark, folder).select("doc_id", "anomaly_text")


def strip_html_view(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages", "page_id")
    return text_views(pages, "html").select("page_id", "clustering_text", "anomaly_text")


def conversation_views(spark: SparkSession, folder: str) -> DataFrame:
    turns = table(spark, folder, "conversations", "conv_id")
    return text_views(turns).select("conv_id", "turn", "clustering_text", "anomaly_text")


def normalization_preview(spark: SparkSession, folder: str) -> DataFrame:
    return view_preview(documents(spark, folder), 5)


def lemma_view(spark: SparkSession, folder: str) -> DataFrame:
    """The clustering view by a lemma table: every word of a benchmark item becomes its first four letters."""
    items = document_tokens(table(spark, folder, "benchmark", "item_id"), CLUSTERING_SETTINGS, "item_id")
    lexicon = items.select("token", F.substring("token", 1, 4).alias("lemma"))
    found = normalize_with_lexicon(documents(spark, folder), CLUSTERING_SETTINGS, lexicon)
    return found.select("doc_id", "normalized_text")


def stemmed_view(spark: SparkSession, folder: str) -> DataFrame:
    """The clustering view with Porter stems."""
    found = normalize_with_lexicon(documents(spark, folder), replace(CLUSTERING_SETTINGS, use_stemming_fallback=True))
    return found.select("doc_id", "normalized_text")


def corpus_summary(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(stats.corpus_summary(documents(spark, folder)), "average_character_count", "average_word_count")


def corpus_summary_pages(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages", "page_id")
    return rounded(stats.corpus_summary(pages, "html"), "average_character_count", "average_word_count")


def normalization_compare(spark: SparkSession, folder: str) -> DataFrame:
    effect = stats.normalization_effect(clustering_texts(spark, folder), "text", "clustering_text")
    return rounded(effect, "token_reduction_ratio")


# ---- structural measures --------------------------------------------------


def structural_features_16(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(features(spark, folder), *NATIVE_FEATURES)


def structural_features_pages(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages", "page_id")
    return rounded(structural_features(pages, "page_id", "html", NATIVE_FEATURES), *NATIVE_FEATURES)


def compression_ratio(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(features(spark, folder, ("compression_ratio",)), "compression_ratio")


def structural_features_all(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(features(spark, folder, STRUCTURAL_FEATURES), *STRUCTURAL_FEATURES)


def feature_describe(spark: SparkSession, folder: str) -> DataFrame:
    described = stats.describe_features(settle(features(spark, folder)), NATIVE_FEATURES)
    return rounded(described, "mean", "std", "min", "p5", "p25", "median", "p75", "p95", "max")


def feature_histogram(spark: SparkSession, folder: str) -> DataFrame:
    scored = settle(features(spark, folder, ("type_token_ratio",)))
    return rounded(stats.histogram(scored, "type_token_ratio", 50), "bin_start", "bin_end")


def feature_tails(spark: SparkSession, folder: str) -> DataFrame:
    names = ("bigram_type_token_ratio", "type_token_ratio", "lexical_entropy")
    scored = settle(features(spark, folder, names))
    return rounded(stats.tail_counts(scored, dict.fromkeys(names, 0.5)), "lower_quantile")


def feature_tail_rows(spark: SparkSession, folder: str) -> DataFrame:
    scored = settle(features(spark, folder, ("bigram_type_token_ratio",)))
    return rounded(stats.tail(scored, "bigram_type_token_ratio", 0.05), "bigram_type_token_ratio")


def feature_corr(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(stats.pearson_matrix(settle(features(spark, folder)), NATIVE_FEATURES), "correlation")


def strong_pairs(spark: SparkSession, folder: str) -> DataFrame:
    matrix = stats.pearson_matrix(settle(features(spark, folder)), NATIVE_FEATURES)
    return rounded(stats.strong_pairs(matrix, NATIVE_FEATURES, 0.8), "correlation")


def extreme_docs(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder)
    lowest = ranking.extreme_documents(rounded(features(spark, folder), *NATIVE_FEATURES, digits=9), NATIVE_FEATURES, docs)
    return rounded(lowest, "value")


def lowest_5(spark: SparkSession, folder: str) -> DataFrame:
    scored = rounded(features(spark, folder, ("type_token_ratio",)), "type_token_ratio", digits=9)
    found = ranking.lowest_with_text(scored, "type_token_ratio", documents(spark, folder), 5, 400)
    return rounded(found, "type_token_ratio")


def separation_table(spark: SparkSession, folder: str) -> DataFrame:
    flags = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", F.col("toxic").alias("flag"))
    flagged = features(spark, folder).join(flags, "doc_id")
    separated = stats.flag_separation(flagged, NATIVE_FEATURES, "flag")
    return rounded(rounded(separated, "ratio", digits=3), "flagged_mean", "normal_mean")


# ---- terms ----------------------------------------------------------------


def vocabulary(spark: SparkSession, folder: str) -> DataFrame:
    docs = clustering_texts(spark, folder)
    counts = V.term_counts(docs, TOPIC_SETTINGS, text_col="clustering_text")
    return V.vocabulary(counts, docs.count(), TOPIC_SETTINGS)


def feature_names(spark: SparkSession, folder: str) -> DataFrame:
    return V.fit(clustering_texts(spark, folder), TOPIC_SETTINGS, text_col="clustering_text").feature_names()


def bag_of_words(spark: SparkSession, folder: str) -> DataFrame:
    docs = clustering_texts(spark, folder)
    counts = V.term_counts(docs, UNIGRAMS, text_col="clustering_text")
    return V.bag_of_words(counts, V.vocabulary(counts, docs.count(), UNIGRAMS), UNIGRAMS)


def term_popularity(spark: SparkSession, folder: str) -> DataFrame:
    return V.term_popularity(V.term_counts(clustering_texts(spark, folder), UNIGRAMS, text_col="clustering_text"))


def bow_preview(spark: SparkSession, folder: str) -> DataFrame:
    docs = settle(clustering_texts(spark, folder).select("doc_id", "clustering_text"))
    counts = V.term_counts(docs, PREVIEW_TERMS, text_col="clustering_text")
    vocab = V.vocabulary(counts, docs.count(), PREVIEW_TERMS)
    preview = V.bow_preview(docs, counts, vocab, 20, 12)
    names = [name for name in preview.columns if name != "doc_id"]
    cells = F.array(*[F.struct(F.lit(n).alias("term"), F.col(f"`{n}`").cast("bigint").alias("tf")) for n in names])
    return preview.select("doc_id", F.inline(cells))


def word_bigrams(spark: SparkSession, folder: str) -> DataFrame:
    settings = V.VectorizerSettings(model="bow", max_features=None, max_df=1.0, ngram_range=(2, 2))
    counts = V.term_counts(clustering_texts(spark, folder), settings, text_col="clustering_text")
    return counts.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("total_tf"))


def char_wb_ngrams(spark: SparkSession, folder: str) -> DataFrame:
    docs = anomaly_texts(spark, folder)
    return V.text_vocabulary(docs, docs.count(), CHARACTER_TERMS, text_col="anomaly_text")


def tfidf(spark: SparkSession, folder: str) -> DataFrame:
    weights, _ = topic_weights(spark, folder)
    return rounded(weights.select("doc_id", "term", "weight"), "weight")


def tfidf_transform_new(spark: SparkSession, folder: str) -> DataFrame:
    model = V.fit(clustering_texts(spark, folder), TOPIC_SETTINGS, text_col="clustering_text")
    fresh = text_views(table(spark, folder, "benchmark", "item_id"))
    weights = model.transform(fresh, "item_id", "clustering_text")
    return rounded(weights.select("item_id", "term", "weight"), "weight")


def term_matrix_lines(spark: SparkSession, folder: str) -> DataFrame:
    docs = settle(clustering_texts(spark, folder).select("doc_id", "clustering_text"))
    counts = V.term_counts(docs, UNIGRAMS, text_col="clustering_text")
    ranked = V.term_popularity(V.bag_of_words(counts, V.vocabulary(counts, docs.count(), UNIGRAMS), UNIGRAMS))
    return matrix_lines(docs, counts, ranked).select("doc_id", F.col("value").alias("line"))


def concat_and_slice(spark: SparkSession, folder: str) -> DataFrame:
    stored = embeddings(spark, folder).select("vec_id", "features")
    tail = V.last_columns(stored, 8)
    both = V.concat_blocks(stored, tail, id_col="vec_id")
    total = F.aggregate("features", F.lit(0.0), lambda acc, x: acc + x)
    return both.select("vec_id", F.size("features").alias("dimensions"), F.round(total, 4).alias("component_sum"))


# ---- neighbours and scores ------------------------------------------------


def knn_cosine(spark: SparkSession, folder: str) -> DataFrame:
    found = neighbors.nearest_neighbors(embeddings(spark, folder), 5, "cosine", "vec_id")
    return rounded(found, "distance")


def knn_euclidean(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(neighbors.nearest_neighbors(points(spark, folder), 5, "euclidean"), "distance")


def knn_score(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(neighbors.knn_scores(embeddings(spark, folder), 5, "vec_id"), "score")


def lof_score(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(neighbors.lof_scores(points(spark, folder), 20), "score")


def knn_cosine_cells(spark: SparkSession, folder: str) -> DataFrame:
    found = neighbors.nearest_neighbors(embeddings(spark, folder), 5, "cosine", "vec_id", cell_rows=SMALL_PIECE)
    return rounded(found, "distance")


def knn_euclidean_cells(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(neighbors.nearest_neighbors(points(spark, folder), 5, "euclidean", cell_rows=SMALL_PIECE), "distance")


in_small_cells = partial(neighbors.nearest_neighbors, cell_rows=SMALL_PIECE)


def knn_score_cells(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(neighbors.knn_scores(embeddings(spark, folder), 5, "vec_id", search=in_small_cells), "score")


def lof_score_cells(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(neighbors.lof_scores(points(spark, folder), 20, search=in_small_cells), "score")


def affinity_graph_cells(spark: SparkSession, folder: str) -> DataFrame:
    return neighbors.affinity_graph(embeddings(spark, folder), 6, "vec_id", search=in_small_cells)


def neighbor_graph(spark: SparkSession, folder: str) -> DataFrame:
    """The approximate neighbour lists of all embeddings."""
    return rounded(descent.graph_neighbors(embeddings(spark, folder), 5, "cosine", "vec_id"), "distance")


def neighbor_graph_recall(spark: SparkSession, folder: str) -> DataFrame:
    """How many exact neighbours the approximate lists hold, for the ids divisible by 100 against all rows."""
    base = embeddings(spark, folder)
    exact = descent.searched_neighbors(base, base.where("vec_id % 100 = 0"), 5, "cosine", "vec_id")
    return descent.neighbor_recall(descent.graph_neighbors(base, 5, "cosine", "vec_id"), exact, "vec_id")


def lof_score_graph(spark: SparkSession, folder: str) -> DataFrame:
    """Outlier factors over approximate neighbour lists."""
    return rounded(neighbors.lof_scores(points(spark, folder), 20, search=descent.graph_neighbors), "score")


def lof_detection(spark: SparkSession, folder: str) -> DataFrame:
    return anomaly.detect_lof(points(spark, folder)).select("doc_id", "is_anomaly")


def knn_detection(spark: SparkSession, folder: str) -> DataFrame:
    return anomaly.detect_knn(embeddings(spark, folder), id_col="vec_id").select("vec_id", "is_anomaly")


def affinity_graph(spark: SparkSession, folder: str) -> DataFrame:
    return neighbors.affinity_graph(embeddings(spark, folder), 6, "vec_id")


def upper_quantile_mask(spark: SparkSession, folder: str) -> DataFrame:
    scores = settle(rounded(neighbors.knn_scores(embeddings(spark, folder), 5, "vec_id"), "score", digits=9))
    return rounded(anomaly.distance_mask(scores, 0.05), "score")


def rank_normalized(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(ranking.rank_normalized(feature_score(spark, folder, "lexical_entropy")), "rank_score")


def rank_average(spark: SparkSession, folder: str) -> DataFrame:
    base = settle(points(spark, folder))
    tables = [
        rounded(neighbors.knn_scores(base, 5), "score", digits=9),
        rounded(neighbors.lof_scores(base, 20), "score", digits=6),
        feature_score(spark, folder, "bigram_type_token_ratio"),
    ]
    return rounded(anomaly.rank_average(tables), "score")


def contamination_mask(spark: SparkSession, folder: str) -> DataFrame:
    scores = settle(feature_score(spark, folder, "lexical_entropy"))
    return rounded(anomaly.contamination_mask(scores, 0.02), "score")


def ensemble_mask(spark: SparkSession, folder: str) -> DataFrame:
    scores = settle(rounded(anomaly.rank_average(list(three_scores(spark, folder).values())), "score", digits=9))
    return rounded(anomaly.ensemble_mask(scores, 0.02), "score")


def threshold_score(spark: SparkSession, folder: str) -> DataFrame:
    scores = settle(feature_score(spark, folder, "bigram_type_token_ratio"))
    return rounded(anomaly.threshold_score(scores, 0.025), "threshold")


# ---- rankings -------------------------------------------------------------


def anomaly_top_k(spark: SparkSession, folder: str) -> DataFrame:
    return ranking.anomaly_output(feature_score(spark, folder, "bigram_type_token_ratio"), 50)


def anomaly_by_mask(spark: SparkSession, folder: str) -> DataFrame:
    scores = settle(feature_score(spark, folder, "bigram_type_token_ratio"))
    return ranking.anomaly_output(anomaly.contamination_mask(scores, 0.1), None)


def candidate_table(spark: SparkSession, folder: str) -> DataFrame:
    scores = settle(feature_score(spark, folder, "type_token_ratio"))
    masked = anomaly.contamination_mask(scores, 0.02)
    return rounded(ranking.candidate_table(masked, mask_col="is_anomaly"), "score")


def top_k_snippets(spark: SparkSession, folder: str) -> DataFrame:
    lowest = feature_score(spark, folder, "type_token_ratio").orderBy("score", "doc_id").limit(10)
    ranked = ranking.candidate_table(lowest)
    return rounded(top_with_snippets(ranked, documents(spark, folder), 10), "score")


def attach_texts(spark: SparkSession, folder: str) -> DataFrame:
    flags = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "quality")
    return attach_text(flags, documents(spark, folder))


def side_by_side(spark: SparkSession, folder: str) -> DataFrame:
    scores = three_scores(spark, folder)
    found = ranking.side_by_side(scores["bigram"], scores["entropy"], documents(spark, folder), 10)
    return rounded(found, "left_score", "right_score")


def overlap_sets(spark: SparkSession, folder: str) -> DataFrame:
    return compare.overlap_sets(three_scores(spark, folder), 50)


def overlap_curve(spark: SparkSession, folder: str) -> DataFrame:
    scores = three_scores(spark, folder)
    return compare.overlap_curve(scores["bigram"], scores["entropy"])


def spearman(spark: SparkSession, folder: str) -> DataFrame:
    scores = three_scores(spark, folder)
    left = anomaly.contamination_mask(scores["bigram"], 0.02)
    right = anomaly.contamination_mask(scores["length"], 0.02)
    return rounded(compare.spearman(left, right), "spearman_score_correlation")


def detector_profile(spark: SparkSession, folder: str) -> DataFrame:
    names = ("bigram_type_token_ratio", "repeated_token_ratio")
    return compare.detector_profile(three_scores(spark, folder), features(spark, folder, names), names)


def structural_precision(spark: SparkSession, folder: str) -> DataFrame:
    names = ("bigram_type_token_ratio", "compression_ratio")
    return compare.structural_precision(three_scores(spark, folder), features(spark, folder, names))


def set_cosine_spread(spark: SparkSession, folder: str) -> DataFrame:
    chosen = ranking.top_k(feature_score(spark, folder, "bigram_type_token_ratio"), 50).select("doc_id")
    return compare.set_cosine_spread(points(spark, folder).join(F.broadcast(chosen), "doc_id"))


def random_baseline(spark: SparkSession, folder: str) -> DataFrame:
    return compare.random_baseline(documents(spark, folder), 50)


# ---- clusterings with given labels ---------------------------------------


def silhouette_euclidean(spark: SparkSession, folder: str) -> DataFrame:
    value = silhouette.silhouette(embeddings(spark, folder), "label", "vec_id")
    return spark.createDataFrame([(round(value, 6),)], "silhouette double")


def silhouette_pieces(spark: SparkSession, folder: str) -> DataFrame:
    value = silhouette.silhouette(embeddings(spark, folder), "label", "vec_id", block_rows=SMALL_PIECE)
    return spark.createDataFrame([(round(value, 6),)], "silhouette double")


def silhouette_squared(spark: SparkSession, folder: str) -> DataFrame:
    value = silhouette.silhouette(embeddings(spark, folder), "label", "vec_id", metric="squared_euclidean")
    return spark.createDataFrame([(round(value, 6),)], "silhouette double")


def silhouette_by_cluster(spark: SparkSession, folder: str) -> DataFrame:
    rows = silhouette.silhouette_rows(embeddings(spark, folder), "label", "vec_id")
    mean = F.sum(F.col("weight") * F.col("silhouette")) / F.sum("weight")
    return rows.groupBy("label").agg(F.round(mean, 6).alias("silhouette"))


def cluster_sizes(spark: SparkSession, folder: str) -> DataFrame:
    return evaluation.cluster_sizes(embeddings(spark, folder))


def label_metrics(spark: SparkSession, folder: str) -> DataFrame:
    """Metric rows of clusterings derived from the stored label and from the id."""
    stored = settle(embeddings(spark, folder))

    def by_label(k: int) -> clustering.Clustering:
        return clustering.Clustering(stored.select("vec_id", (F.col("label") % k).cast("int").alias("label")), k)

    def by_id(k: int) -> clustering.Clustering:
        return clustering.Clustering(stored.select("vec_id", (F.col("vec_id") % k).cast("int").alias("label")), k)

    methods = {"by_id": by_id, "by_label": by_label}
    rows = evaluation.method_sweep(stored, methods, SWEEP_COUNTS, 260, id_col="vec_id")[0]
    return settle(rounded(rows, "silhouette_score"))


def metric_rows(spark: SparkSession, folder: str) -> DataFrame:
    return label_metrics(spark, folder)


def size_filter(spark: SparkSession, folder: str) -> DataFrame:
    return evaluation.size_filter(label_metrics(spark, folder), 240).select("method", "cluster_count", "max_cluster_size")


def violating_runs(spark: SparkSession, folder: str) -> DataFrame:
    return evaluation.violating_runs(label_metrics(spark, folder), 240).select("method", "cluster_count", "max_cluster_size")


def best_per_group(spark: SparkSession, folder: str) -> DataFrame:
    best = ranking.best_per_group(metric_rows(spark, folder), "method", "silhouette_score", ["cluster_count"])
    return best.select("method", "cluster_count", "silhouette_score")


def global_best(spark: SparkSession, folder: str) -> DataFrame:
    fitting = evaluation.size_filter(metric_rows(spark, folder), 1300)
    best = ranking.global_best(fitting, "silhouette_score", ["method", "cluster_count"])
    return best.select("method", "cluster_count", "silhouette_score")


def wide_labels(spark: SparkSession, folder: str) -> DataFrame:
    stored = embeddings(spark, folder)
    runs = {
        f"by_label_k{k}": stored.select("vec_id", (F.col("label") % k).cast("int").alias("label")) for k in (2, 5)
    }
    return evaluation.wide_labels(stored, runs, "vec_id")


def nearest_to_centroid(spark: SparkSession, folder: str) -> DataFrame:
    stored = embeddings(spark, folder)
    found = evaluation.representative_documents(stored.drop("label"), stored.select("vec_id", "label"), top=1, id_col="vec_id")
    return rounded(found, "distance_to_centroid")


def cluster_top_terms(spark: SparkSession, folder: str) -> DataFrame:
    weights, docs = topic_weights(spark, folder)
    found = evaluation.cluster_top_terms(weights, docs.select("doc_id", F.col("lang").alias("label")), 12)
    return rounded(found, "weight")


def cluster_top_terms_no_noise(spark: SparkSession, folder: str) -> DataFrame:
    """Terms in at least a fifth of the benchmark items count as noise; the topic is the language code."""
    weights, docs = topic_weights(spark, folder)
    items = text_views(table(spark, folder, "benchmark", "item_id"))
    counts = V.term_counts(items, UNIGRAMS, "item_id", "clustering_text")
    noise = counts.groupBy("term").agg(F.count(F.lit(1)).alias("df")).where(F.col("df") >= items.count() * 0.2)
    labels = docs.select("doc_id", F.col("lang").alias("label"))
    topics = docs.select(F.col("lang").alias("label")).distinct().withColumn("topic", F.upper("label"))
    return rounded(evaluation.cluster_top_terms(weights, labels, 8, noise, topics), "weight")


def representative_docs(spark: SparkSession, folder: str) -> DataFrame:
    weights, docs = topic_weights(spark, folder)
    labels = docs.select("doc_id", F.col("lang").alias("label"))
    found = evaluation.sparse_representatives(settle(weights), labels, documents(spark, folder), 5)
    return rounded(found, "distance_to_centroid")


# ---- fitted models --------------------------------------------------------


def isolation_forest_scores(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(isolation_forest(settle(points(spark, folder, STRUCTURAL_FEATURES))), "score")


def structural_detection(spark: SparkSession, folder: str) -> DataFrame:
    found = anomaly.detect_forest(settle(anomaly.structural_points(documents(spark, folder))))
    return ranking.anomaly_output(found, 50)


def ensemble_detection(spark: SparkSession, folder: str) -> DataFrame:
    found = anomaly.detect_ensemble(settle(anomaly.structural_points(documents(spark, folder))))
    return ranking.anomaly_output(found, 50)


def feature_export(spark: SparkSession, folder: str) -> DataFrame:
    scored = settle(features(spark, folder, STRUCTURAL_FEATURES))
    vectors = feature_vector(scored, STRUCTURAL_FEATURES).select("doc_id", "features")
    return stats.feature_export(scored, anomaly.detect_forest(vectors), STRUCTURAL_FEATURES)


def latent_points(spark: SparkSession, folder: str, dimension: int) -> DataFrame:
    """Word TF-IDF of the clustering view in the latent space."""
    _, counts = V.fit_packed(clustering_texts(spark, folder), TOPIC_SETTINGS, text_col="clustering_text")
    return project(counts, fit_projection(counts, dimension))


def lsa(spark: SparkSession, folder: str) -> DataFrame:
    return latent_points(spark, folder, WARD_DIMENSION)


def lsa_detection(spark: SparkSession, folder: str) -> DataFrame:
    return anomaly.lsa_detection(anomaly_texts(spark, folder))


def lsa_hybrid_detection(spark: SparkSession, folder: str) -> DataFrame:
    return anomaly.lsa_hybrid_detection(anomaly_texts(spark, folder))


def sparse_hybrid_detection(spark: SparkSession, folder: str) -> DataFrame:
    return anomaly.sparse_hybrid_detection(anomaly_texts(spark, folder))


def kmeans(spark: SparkSession, folder: str) -> DataFrame:
    weights, docs = topic_weights(spark, folder)
    vectors = V.sparse_vectors(weights, TOPIC_SETTINGS.max_features, docs=docs)
    return clustering.cluster_kmeans(vectors, 8).labels


def kmeans_embeddings(spark: SparkSession, folder: str) -> DataFrame:
    return clustering.kmeans_embeddings(embeddings(spark, folder), 8, id_col="vec_id").labels


def center_top_terms(spark: SparkSession, folder: str) -> DataFrame:
    docs = clustering_texts(spark, folder)
    fitted, counts = V.fit_packed(docs, TOPIC_SETTINGS, text_col="clustering_text")
    vectors = V.packed_vectors(counts, TOPIC_SETTINGS.max_features)
    return evaluation.center_top_terms(spark, clustering.kmeans(vectors, 8), fitted, 15)


def choose_k(spark: SparkSession, folder: str) -> DataFrame:
    return clustering.cluster_kmeans(embeddings(spark, folder), None, id_col="vec_id").labels


def choose_k_tfidf(spark: SparkSession, folder: str) -> DataFrame:
    weights, docs = topic_weights(spark, folder)
    vectors = V.sparse_vectors(weights, TOPIC_SETTINGS.max_features, docs=docs)
    return clustering.cluster_kmeans(vectors, None).labels


def label_means(spark: SparkSession, folder: str, linkage: str) -> DataFrame:
    """The means of the embeddings' labels, merged down to three groups."""
    mean = vector_to_array(Summarizer.mean(array_to_vector("features")))
    means = embeddings(spark, folder).groupBy(F.col("label").cast("bigint").alias("topic")).agg(mean.alias("_mean"))
    exact = means.select("topic", F.transform("_mean", lambda x: F.round(x, 6)).alias("features"))
    return clustering.Agglomerative(settle(exact), linkage, id_col="topic").cut(3).labels


def ward_label_means(spark: SparkSession, folder: str) -> DataFrame:
    return label_means(spark, folder, "ward")


def average_label_means(spark: SparkSession, folder: str) -> DataFrame:
    return label_means(spark, folder, "average")


def ward(spark: SparkSession, folder: str) -> DataFrame:
    return clustering.cluster_agglomerative(settle(latent_points(spark, folder, WARD_DIMENSION)), 8).labels


def average_linkage(spark: SparkSession, folder: str) -> DataFrame:
    return clustering.cluster_agglomerative(settle(latent_points(spark, folder, AVERAGE_DIMENSION)), 8, linkage="average").labels


def spectral(spark: SparkSession, folder: str) -> DataFrame:
    return clustering.spectral(embeddings(spark, folder), 5, id_col="vec_id").labels


def embedding_sweep(spark: SparkSession, folder: str) -> DataFrame:
    """K-means and Ward on the embeddings."""
    base = settle(embeddings(spark, folder).select("vec_id", "features"))
    merged = clustering.Agglomerative(base, "ward", id_col="vec_id").cuts(SWEEP_COUNTS)
    methods = {"kmeans": lambda k: clustering.kmeans(base, k, id_col="vec_id"), "agglomerative": merged.__getitem__}
    return evaluation.method_sweep(base, methods, SWEEP_COUNTS, id_col="vec_id")[0]


def topic_sweep(spark: SparkSession, folder: str) -> DataFrame:
    """K-means on the sparse TF-IDF vectors, average linkage on their latent space; both scored where they were fitted."""
    weights, docs = topic_weights(spark, folder)
    weights = settle(weights)
    sparse = settle(V.sparse_vectors(weights, TOPIC_SETTINGS.max_features, docs=docs))
    latent = settle(project(weights, fit_projection(weights, AVERAGE_DIMENSION), docs=docs))
    merged = clustering.Agglomerative(latent, "average").cuts(SWEEP_COUNTS)
    by_means = evaluation.method_sweep(sparse, {"kmeans": lambda k: clustering.kmeans(sparse, k)}, SWEEP_COUNTS)[0]
    return by_means.unionByName(evaluation.method_sweep(latent, {"agglomerative": merged.__getitem__}, SWEEP_COUNTS)[0])


def method_sweep(spark: SparkSession, folder: str) -> DataFrame:
    """K-means, average linkage and spectral clustering of the embeddings."""
    base = settle(embeddings(spark, folder).select("vec_id", "features"))
    merged = clustering.Agglomerative(base, "average", id_col="vec_id").cuts(SWEEP_COUNTS)
    # Made when the first run asks for it, because a run may fail but not the sweep.
    graph = cache(lambda: neighbor_nodes(base, id_col="vec_id"))
    methods = {
        "kmeans": lambda k: clustering.kmeans(base, k, id_col="vec_id"),
        "agglomerative": merged.__getitem__,
        "spectral": lambda k: clustering.spectral(base, k, id_col="vec_id", graph=graph()),
    }
    return evaluation.method_sweep(base, methods, SWEEP_COUNTS, id_col="vec_id")[0]


def approach_comparison(spark: SparkSession, folder: str) -> DataFrame:
    tables = {"embeddings": embedding_sweep(spark, folder), "tfidf": topic_sweep(spark, folder)}
    return evaluation.approach_comparison(spark, tables)


def encode_with_model(spark: SparkSession, folder: str) -> DataFrame:
    """The encoder hook with a small stand-in model: shares of each letter."""

    def load():
        letters = "abcdefghijklmnopqrstuvwxyz"

        def encode(texts):
            return np.array([[text.lower().count(c) / max(len(text), 1) for c in letters] for text in texts])

        return encode

    return encode_documents(documents(spark, folder), load)


def encode_word_vectors(spark: SparkSession, folder: str) -> DataFrame:
    return word_vector_mean(clustering_texts(spark, folder))


# ---- jobs -----------------------------------------------------------------


def job_topics(spark: SparkSession, folder: str) -> DataFrame:
    return CorpusJobs(articles(spark, folder), preferred_clusters=8).cluster("kmeans")


def job_topics_embeddings(spark: SparkSession, folder: str) -> DataFrame:
    """Topics of the documents that have a stored embedding of their number."""
    stored = embeddings(spark, folder).select(F.col("vec_id").cast("string").alias("doc_id"), "features")
    return CorpusJobs(articles(spark, folder)).cluster(embeddings=stored)


def job_topics_agglomerative(spark: SparkSession, folder: str) -> DataFrame:
    return CorpusJobs(articles(spark, folder), preferred_clusters=8).cluster("agglomerative")


def job_anomalies(spark: SparkSession, folder: str) -> DataFrame:
    return CorpusJobs(articles(spark, folder)).anomalies()


def job_anomalies_ensemble(spark: SparkSession, folder: str) -> DataFrame:
    return CorpusJobs(articles(spark, folder)).anomalies(use_ensemble=True)


def job_bag_of_words(spark: SparkSession, folder: str) -> DataFrame:
    """The term matrix as the job writes it to the shared folder, read back line by line."""
    path = f"{shared_folder(spark)}/docsieve-terms/{uuid.uuid4().hex}"
    CorpusJobs(articles(spark, folder)).export_bag_of_words(path, compression="gzip")
    return spark.read.text(path).select(F.col("value").alias("line"))


def flagship(spark: SparkSession, folder: str) -> DataFrame:
    """The 50 structurally oddest documents with score, rank and snippet."""
    docs = documents(spark, folder)
    scores = isolation_forest(settle(anomaly.structural_points(docs)))
    top = ranking.top_k(scores, 50, rank_col="anomaly_rank")
    return top_with_snippets(top, docs, 50).orderBy("anomaly_rank")


CHECKED = (
    load_articles, load_embedding_table, clustering_view, anomaly_view, strip_html_view, conversation_views,
    normalization_preview, corpus_summary, corpus_summary_pages, normalization_compare, structural_features_16,
    structural_features_pages, feature_describe, feature_histogram, feature_tails, feature_tail_rows, feature_corr,
    strong_pairs, extreme_docs, lowest_5, separation_table, vocabulary, bag_of_words, term_popularity, bow_preview,
    word_bigrams, char_wb_ngrams, tfidf, tfidf_transform_new, term_matrix_lines, concat_and_slice, knn_cosine,
    knn_euclidean, knn_score, lof_score, affinity_graph, upper_quantile_mask, rank_normalized, rank_average,
    contamination_mask, ensemble_mask, threshold_score, anomaly_top_k, anomaly_by_mask, candidate_table,
    top_k_snippets, attach_texts, side_by_side, overlap_sets, overlap_curve, spearman, detector_profile,
    set_cosine_spread, silhouette_euclidean, silhouette_squared, silhouette_by_cluster, cluster_sizes, metric_rows,
    size_filter, violating_runs, best_per_group, global_best, wide_labels, nearest_to_centroid, cluster_top_terms,
    cluster_top_terms_no_noise, representative_docs, lemma_view, feature_names, knn_cosine_cells, knn_euclidean_cells,
    knn_score_cells, lof_score_cells, affinity_graph_cells, lof_detection, knn_detection, silhouette_pieces,
    ward_label_means, average_label_means, random_baseline, job_bag_of_words,
)

UNCHECKED = (
    compression_ratio, structural_features_all, structural_precision, isolation_forest_scores,
    structural_detection, ensemble_detection, feature_export, lsa, lsa_detection, lsa_hybrid_detection,
    sparse_hybrid_detection, kmeans, kmeans_embeddings, center_top_terms, choose_k, ward, average_linkage, spectral,
    method_sweep, approach_comparison, encode_with_model, encode_word_vectors, job_topics, job_topics_agglomerative,
    job_anomalies, choose_k_tfidf, job_topics_embeddings, job_anomalies_ensemble, neighbor_graph,
    neighbor_graph_recall, lof_score_graph, stemmed_view,
)


def all_queries() -> dict[str, Query]:
    return {query.__name__: query for query in (*CHECKED, *UNCHECKED)}
