"""Tables that describe and compare clusterings."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from docsieve.functions.cleaning import snippet
from docsieve.operators.clustering import Clustering
from docsieve.operators.lookup import attach_text
from docsieve.operators.silhouette import silhouette, silhouette_runs
from docsieve.session import broadcast_if_small

# Sums differ in their last bits with the order of addition; ranks ignore those.
TIE_DIGITS = 12

METRIC_SCHEMA = (
    "method string, cluster_count int, silhouette_score double, max_cluster_size long, size_constraint_ok boolean, error string"
)


def cluster_sizes(labels: DataFrame, label_col: str = "label") -> DataFrame:
    """``(label, size, max_size)`` per cluster."""
    sizes = labels.groupBy(label_col).agg(F.count(F.lit(1)).alias("size"))
    largest = sizes.agg(F.max("size")).first()[0]
    return sizes.withColumn("max_size", F.lit(largest).cast("bigint"))


def method_sweep(
    points: DataFrame,
    methods: Mapping[str, Callable[[int], Clustering]],
    counts: Sequence[int] = tuple(range(2, 11)),
    max_size: int = 1300,
    inclusive: bool = False,
    id_col: str = "doc_id",
    vector_col: str = "features",
    metric: str = "euclidean",
    tolerated: Sequence[str] = ("spectral",),
) -> tuple[DataFrame, dict[tuple[str, int], DataFrame]]:
    """One metric row per method and count, and the labels of each run.

    All Euclidean scores come from one pass over the distances.  A run of a ``tolerated`` method that fails becomes a
    row without a score and with the error text; other methods raise.  A run with one label has no score.
    """
    points = points.select(id_col, vector_col)
    labels, failed = {}, {}
    for k in counts:
        for name, run in methods.items():
            try:
                labels[(name, k)] = run(k).labels
            except Exception as problem:  # noqa: BLE001  (reported for the methods named, raised for others)
                if name not in tolerated:
                    raise
                failed[(name, k)] = str(problem).splitlines()[0]
    if metric == "euclidean":
        scores = silhouette_runs(points, labels, id_col, vector_col) if labels else {}
    else:
        scores = {key: silhouette(points.join(found, id_col), "label", id_col, vector_col, metric) for key, found in labels.items()}
    largest_of = {}
    if labels:
        tagged = [found.select(F.lit(name).alias("method"), F.lit(k).alias("k"), "label") for (name, k), found in labels.items()]
        sizes = reduce(DataFrame.unionByName, tagged).groupBy("method", "k", "label").count()
        # One row per run.
        largest_of = {(r["method"], r["k"]): r["n"] for r in sizes.groupBy("method", "k").agg(F.max("count").alias("n")).collect()}
    rows = []
    for k in counts:
        for name in methods:
            key = (name, k)
            if key in failed:
                rows.append((name, k, None, None, False, failed[key]))
                continue
            largest = largest_of[key]
            fits = largest <= max_size if inclusive else largest < max_size
            rows.append((name, k, scores[key], largest, fits, None if scores[key] is not None else "one label only"))
    return points.sparkSession.createDataFrame(rows, METRIC_SCHEMA), labels


def size_filter(metrics: DataFrame, max_size: int = 1300, inclusive: bool = False) -> DataFrame:
    """Scored runs whose largest cluster is under the bound (or at it, when inclusive)."""
    fits = F.col("max_cluster_size") <= max_size if inclusive else F.col("max_cluster_size") < max_size
    return metrics.where(fits & F.col("silhouette_score").isNotNull())


def violating_runs(metrics: DataFrame, max_size: int = 1300, inclusive: bool = False) -> DataFrame:
    """Runs whose largest cluster breaks the bound, largest first."""
    breaks = F.col("max_cluster_size") > max_size if inclusive else F.col("max_cluster_size") >= max_size
    return metrics.where(breaks).orderBy(F.desc("max_cluster_size"), "method", "cluster_count")


def approach_comparison(spark: SparkSession, tables: Mapping[str, DataFrame]) -> DataFrame:
    """Metric tables of several feature spaces under one another, best score first."""
    parts = [table.select(F.lit(name).alias("approach"), *table.columns) for name, table in tables.items()]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result.orderBy(F.desc_nulls_last("silhouette_score"), "approach", "method", "cluster_count")


def wide_labels(docs: DataFrame, runs: Mapping[str, DataFrame], id_col: str = "doc_id") -> DataFrame:
    """One label column per named run, e.g. ``kmeans_k8``."""
    table = docs.select(id_col)
    for name, labels in runs.items():
        table = table.join(labels.select(id_col, F.col("label").alias(name)), id_col, "left")
    return table


def cluster_top_terms(
    weights: DataFrame,
    labels: DataFrame,
    top: int = 12,
    noise: DataFrame | None = None,
    topics: DataFrame | None = None,
    id_col: str = "doc_id",
    label_col: str = "label",
) -> DataFrame:
    """``(label[, topic], term_rank, term, weight)``: highest mean weight per cluster, ties by term.

    The mean is over all documents of the cluster, those without the term too.
    ``noise`` is a table of terms to leave out and ``topics`` one of
    ``(label, topic)`` names.
    """
    sizes = labels.groupBy(label_col).agg(F.count(F.lit(1)).alias("_size"))
    sums = (
        weights.select(id_col, "term", "weight")
        .join(labels.select(id_col, label_col), id_col)
        .groupBy(label_col, "term")
        .agg(F.sum("weight").alias("_sum"))
    )
    if noise is not None:
        sums = sums.join(noise.select("term").distinct(), "term", "left_anti")
    means = sums.join(sizes, label_col).withColumn("weight", F.col("_sum") / F.col("_size"))
    order = Window.partitionBy(label_col).orderBy(F.desc(F.round("weight", TIE_DIGITS)), "term")
    ranked = means.withColumn("term_rank", F.row_number().over(order)).where(F.col("term_rank") <= top)
    shown = [label_col, "term_rank", "term", "weight"]
    if topics is not None:
        ranked = ranked.join(topics.select(label_col, "topic"), label_col, "left")
        shown.insert(1, "topic")
    return ranked.select(*shown)


def center_top_terms(
    spark: SparkSession, clustering: Clustering, vocab: DataFrame, top: int = 15
) -> DataFrame:
    """``(label, term_rank, term, weight)`` from fitted k-means centres over vocabulary terms."""
    rows = []
    for label, center in enumerate(clustering.centers or []):
        order = sorted(range(len(center)), key=lambda i: (-center[i], i))[:top]
        rows += [(label, rank, int(i), float(center[i])) for rank, i in enumerate(order, start=1)]
    table = spark.createDataFrame(rows, "label int, term_rank int, term_id long, weight double")
    return vocab.select("term_id", "term").join(F.broadcast(table), "term_id").select("label", "term_rank", "term", "weight")


def _dot(left: Column, right: Column) -> Column:
    return F.aggregate(F.zip_with(left, right, lambda a, b: a * b), F.lit(0.0), lambda acc, x: acc + x)


def cosine_distance(left: Column, right: Column) -> Column:
    """1 minus the cosine; 1 when either vector is zero."""
    lengths = F.sqrt(_dot(left, left)) * F.sqrt(_dot(right, right))
    return F.when(lengths > 0, 1.0 - _dot(left, right) / lengths).otherwise(F.lit(1.0))


def representative_documents(
    points: DataFrame,
    labels: DataFrame,
    docs: DataFrame | None = None,
    top: int = 5,
    length: int = 220,
    id_col: str = "doc_id",
    vector_col: str = "features",
    label_col: str = "label",
    text_col: str = "text",
) -> DataFrame:
    """The documents nearest to each cluster mean by cosine distance, with snippets if ``docs`` is given.

    The means are one row per cluster and go to every task if their bytes are few,
    so the vectors are not shuffled by label.
    """
    labelled = points.select(id_col, F.col(vector_col).cast("array<double>").alias("_v")).join(
        labels.select(id_col, label_col), id_col
    )
    means = labelled.groupBy(label_col).agg(vector_to_array(Summarizer.mean(array_to_vector("_v"))).alias("_mean"))
    scored = labelled.join(broadcast_if_small(means, 8 * F.size("_mean") + 64), label_col).withColumn(
        "distance_to_centroid", cosine_distance(F.col("_v"), F.col("_mean"))
    )
    order = Window.partitionBy(label_col).orderBy(F.round("distance_to_centroid", TIE_DIGITS), id_col)
    nearest = (
        scored.select(label_col, id_col, "distance_to_centroid")
        .withColumn("representative_rank", F.row_number().over(order))
        .where(F.col("representative_rank") <= top)
    )
    shown = [label_col, "representative_rank", id_col, "distance_to_centroid"]
    if docs is None:
        return nearest.select(*shown)
    joined = attach_text(nearest, docs, id_col, text_col, out_col="_raw")
    return joined.select(*shown, snippet(F.col("_raw"), length).alias("snippet"))


def sparse_representatives(
    weights: DataFrame,
    labels: DataFrame,
    docs: DataFrame | None = None,
    top: int = 5,
    length: int = 220,
    id_col: str = "doc_id",
    label_col: str = "label",
    text_col: str = "text",
) -> DataFrame:
    """The same over long-form weights of unit row length, without making them dense.

    The means have a row for each term of a cluster and go to every task if their bytes are few, so the weights are
    shuffled by document once and not by label and term.
    """
    labelled = weights.select(id_col, "term", "weight").join(labels.select(id_col, label_col), id_col)
    sizes = labels.groupBy(label_col).agg(F.count(F.lit(1)).alias("_size"))
    means = (
        labelled.groupBy(label_col, "term")
        .agg(F.sum("weight").alias("_sum"))
        .join(sizes, label_col)
        .select(label_col, "term", (F.col("_sum") / F.col("_size")).alias("_mean"))
    )
    means = broadcast_if_small(means, 96 + F.length("term"))
    lengths = means.groupBy(label_col).agg(F.sqrt(F.sum(F.col("_mean") * F.col("_mean"))).alias("_length"))
    dots = labelled.join(means, [label_col, "term"]).groupBy(id_col).agg(F.sum(F.col("weight") * F.col("_mean")).alias("_dot"))
    scored = (
        labels.select(id_col, label_col)
        .join(lengths, label_col)
        .join(dots, id_col, "left")
        .withColumn("distance_to_centroid", 1.0 - F.coalesce("_dot", F.lit(0.0)) / F.col("_length"))
    )
    order = Window.partitionBy(label_col).orderBy(F.round("distance_to_centroid", TIE_DIGITS), id_col)
    nearest = (
        scored.select(label_col, id_col, "distance_to_centroid")
        .withColumn("representative_rank", F.row_number().over(order))
        .where(F.col("representative_rank") <= top)
    )
    shown = [label_col, "representative_rank", id_col, "distance_to_centroid"]
    if docs is None:
        return nearest.select(*shown)
    joined = attach_text(nearest, docs, id_col, text_col, out_col="_raw")
    return joined.select(*shown, snippet(F.col("_raw"), length).alias("snippet"))
