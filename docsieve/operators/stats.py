"""Corpus and feature statistics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.stat import Correlation
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docsieve.functions import patterns as P
from docsieve.functions.structural import count_matches
from docsieve.operators.ranking import exact_quantiles, quantile, unpivot

# The percentiles of the describe table and their column names.
DESCRIBE_POINTS = ((0.05, "p5"), (0.25, "p25"), (0.5, "median"), (0.75, "p75"), (0.95, "p95"))


def corpus_summary(docs: DataFrame, text_col: str = "text", symbol_share: float = 0.15) -> DataFrame:
    """One row: document count, mean lengths, documents with tags, symbol-heavy documents."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    characters = F.length(text)
    symbols = count_matches(text, P.SYMBOL) / F.greatest(characters, F.lit(1))
    return docs.agg(
        F.count(F.lit(1)).alias("document_count"),
        F.coalesce(F.avg(characters), F.lit(0.0)).alias("average_character_count"),
        F.coalesce(F.avg(count_matches(text, P.WORD_TOKEN)), F.lit(0.0)).alias("average_word_count"),
        F.count_if(text.rlike(P.HTML_TAG)).alias("html_like_document_count"),
        F.count_if(symbols > symbol_share).alias("symbol_heavy_document_count"),
    )


def normalization_effect(docs: DataFrame, raw_col: str, normalized_col: str) -> DataFrame:
    """Token totals before and after normalisation and the share removed."""
    raw = count_matches(F.lower(F.coalesce(F.col(raw_col), F.lit(""))), P.WORD_TOKEN)
    kept = count_matches(F.coalesce(F.col(normalized_col), F.lit("")), P.NON_SPACE_RUN)
    totals = docs.agg(
        F.coalesce(F.sum(raw), F.lit(0)).cast("double").alias("raw"),
        F.coalesce(F.sum(kept), F.lit(0)).cast("double").alias("kept"),
    )
    some = F.col("raw") > 0
    return totals.select(
        F.col("raw").alias("raw_token_count"),
        F.when(some, F.col("kept")).otherwise(F.lit(0.0)).alias("normalized_token_count"),
        F.when(some, 1.0 - F.col("kept") / F.col("raw")).otherwise(F.lit(0.0)).alias("token_reduction_ratio"),
    )


def describe_features(features: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per feature: mean, sample deviation, extremes and percentiles."""
    quantiles = exact_quantiles(features, columns, [p for p, _ in DESCRIBE_POINTS])
    points = features.sparkSession.createDataFrame(
        [(c, *quantiles[c]) for c in columns],
        "feature string, " + ", ".join(f"{name} double" for _, name in DESCRIBE_POINTS),
    )
    moments = (
        unpivot(features, columns)
        .groupBy("feature")
        .agg(
            F.avg("value").alias("mean"),
            F.stddev_samp("value").alias("std"),
            F.min("value").alias("min"),
            F.max("value").alias("max"),
        )
    )
    return moments.join(F.broadcast(points), "feature").select(
        "feature", "mean", "std", "min", *[name for _, name in DESCRIBE_POINTS], "max"
    )


def histogram(features: DataFrame, column: str, bins: int = 50) -> DataFrame:
    """Equal-width bins ``(bin, bin_start, bin_end, count)``, empty ones included; the last is closed."""
    low, high = features.agg(F.min(column).cast("double"), F.max(column).cast("double")).first()
    spark = features.sparkSession
    if low is None:
        return spark.createDataFrame([], "bin int, bin_start double, bin_end double, count long")
    if low == high:
        low, high = low - 0.5, high + 0.5
    width = (high - low) / bins
    place = F.least(F.floor((F.col(column) - low) / width), F.lit(bins - 1)).cast("int")
    counts = features.where(F.col(column).isNotNull()).groupBy(place.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    edges = spark.range(bins).select(
        F.col("id").cast("int").alias("bin"),
        (F.lit(low) + F.col("id") * F.lit(width)).alias("bin_start"),
        (F.lit(low) + (F.col("id") + 1) * F.lit(width)).alias("bin_end"),
    )
    return edges.join(F.broadcast(counts), "bin", "left").select(
        "bin", "bin_start", "bin_end", F.coalesce("count", F.lit(0)).alias("count")
    )


def tail(features: DataFrame, column: str, share: float = 0.05) -> DataFrame:
    """The rows at or below the given lower quantile of one feature."""
    return features.where(F.col(column) <= F.lit(quantile(features, column, share)))


def tail_counts(features: DataFrame, thresholds: dict[str, float], share: float = 0.05) -> DataFrame:
    """Per feature: its lower quantile, rows at or below it, rows under the fixed threshold."""
    columns = list(thresholds)
    lower = exact_quantiles(features, columns, [share])
    rows = [
        F.struct(
            F.lit(c).alias("feature"),
            F.lit(lower[c][0]).alias("lower_quantile"),
            F.count_if(F.col(c) <= F.lit(lower[c][0])).alias("at_or_below_quantile"),
            F.lit(float(thresholds[c])).alias("threshold"),
            F.count_if(F.col(c) < F.lit(float(thresholds[c]))).alias("below_threshold"),
        )
        for c in columns
    ]
    return features.agg(F.array(*rows).alias("rows")).select(F.inline("rows"))


def pearson_matrix(features: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(feature_a, feature_b, correlation)`` for all pairs; null where a feature is constant.

    The sums are taken in one distributed pass; only the small matrix reaches
    the driver.
    """
    spread = features.agg(*[(F.max(c) > F.min(c)).alias(c) for c in columns]).first()
    assembled = VectorAssembler(inputCols=list(columns), outputCol="_v", handleInvalid="skip").transform(
        features.select(*[F.col(c).cast("double").alias(c) for c in columns])
    )
    matrix = Correlation.corr(assembled, "_v").first()[0].toArray()
    rows = [
        (a, b, float(matrix[i, j]) if spread[a] and spread[b] else None)
        for i, a in enumerate(columns)
        for j, b in enumerate(columns)
    ]
    return features.sparkSession.createDataFrame(rows, "feature_a string, feature_b string, correlation double")


def strong_pairs(matrix: DataFrame, columns: Sequence[str], threshold: float = 0.8) -> DataFrame:
    """Pairs below the diagonal with a correlation beyond the threshold, strongest first."""
    places = F.create_map(*[part for i, c in enumerate(columns) for part in (F.lit(c), F.lit(i))])
    return (
        matrix.where(F.col("correlation").isNotNull() & ~F.isnan("correlation"))
        .where(F.abs("correlation") > threshold)
        .where(places[F.col("feature_a")] > places[F.col("feature_b")])
        .orderBy(F.desc(F.abs("correlation")), "feature_a", "feature_b")
    )


def flag_separation(features: DataFrame, columns: Sequence[str], flag_col: str) -> DataFrame:
    """Mean of each feature for flagged and for other rows, and their ratio, greatest first."""
    flagged = F.col(flag_col).cast("boolean")
    means = (
        unpivot(features.withColumn("_flag", flagged), columns, ["_flag"])
        .groupBy("feature")
        .agg(
            F.avg(F.when(F.col("_flag"), F.col("value"))).alias("flagged_mean"),
            F.avg(F.when(~F.col("_flag"), F.col("value"))).alias("normal_mean"),
        )
    )
    return means.withColumn("ratio", F.col("flagged_mean") / (F.col("normal_mean") + F.lit(1e-9))).orderBy(
        F.desc("ratio"), "feature"
    )


def feature_export(features: DataFrame, scores: DataFrame, columns: Sequence[str], id_col: str = "doc_id") -> DataFrame:
    """Features beside the forest score and flag; the score is negated, higher meaning odder."""
    return features.join(scores.select(id_col, "score", "is_anomaly"), id_col).select(
        id_col, *columns, (-F.col("score")).alias("if_score"), "is_anomaly"
    )
