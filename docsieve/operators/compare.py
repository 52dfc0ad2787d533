"""Comparing rankings and detectors."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from itertools import combinations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docsieve.operators.ranking import global_rank, top_k

# Limits under which a document counts as structurally odd.
BIGRAM_LIMIT = 0.70
COMPRESSION_LIMIT = 0.55

# List lengths of the overlap curve.
CURVE_LENGTHS = (10, 25, 50, 75, 100)


def overlap_sets(rankings: Mapping[str, DataFrame], k: int = 50, id_col: str = "doc_id") -> DataFrame:
    """``(sets, overlap, union_size)`` for every combination of two or more rankings.

    Each ranking contributes its k lowest scores; one grouping by id gives the
    membership flags from which all counts follow.
    """
    names = list(rankings)
    tops = [
        top_k(scores.select(id_col, "score"), k, id_col).select(id_col, F.lit(name).alias("_name"))
        for name, scores in rankings.items()
    ]
    member = (
        reduce(DataFrame.unionByName, tops)
        .groupBy(id_col)
        .agg(*[F.max(F.col("_name") == name).alias(name) for name in names])
    )
    rows = []
    for size in range(2, len(names) + 1):
        for group in combinations(names, size):
            every = reduce(lambda a, b: a & b, [F.col(name) for name in group])
            some = reduce(lambda a, b: a | b, [F.col(name) for name in group])
            rows.append(
                F.struct(
                    F.lit("&".join(group)).alias("sets"),
                    F.count_if(every).alias("overlap"),
                    F.count_if(some).alias("union_size"),
                )
            )
    return member.agg(F.array(*rows).alias("rows")).select(F.inline("rows"))


def overlap_curve(
    left: DataFrame, right: DataFrame, lengths: Sequence[int] = CURVE_LENGTHS, id_col: str = "doc_id"
) -> DataFrame:
    """``(top_k, overlap_count)``: shared documents among the first k of two rankings."""
    longest = max(lengths)
    both = (
        top_k(left.select(id_col, "score"), longest, id_col, rank_col="r1")
        .select(id_col, "r1")
        .join(top_k(right.select(id_col, "score"), longest, id_col, rank_col="r2").select(id_col, "r2"), id_col)
        .select(F.greatest("r1", "r2").alias("worst"))
    )
    rows = [
        F.struct(F.lit(k).alias("top_k"), F.count_if(F.col("worst") <= k).alias("overlap_count")) for k in lengths
    ]
    return both.agg(F.array(*rows).alias("rows")).select(F.inline("rows"))


def average_ranks(scores: DataFrame, id_col: str, score_col: str, out_col: str) -> DataFrame:
    """Ranks from 1; equal scores share the mean of their ranks."""
    ranked = global_rank(scores.select(id_col, score_col), [score_col, id_col], "_rank")
    ties = (
        ranked.groupBy(score_col)
        .agg(F.count(F.lit(1)).alias("_n"), F.avg("_rank").alias("_mean"))
        .where("_n > 1")
        .select(F.col(score_col).alias("_tied"), "_mean")
    )
    # One row per tied score on the right, so adaptive execution may split a
    # score that many rows share.
    joined = ranked.join(ties, ranked[score_col] == ties["_tied"], "left")
    return joined.select(id_col, F.coalesce("_mean", F.col("_rank").cast("double")).alias(out_col))


def spearman(left: DataFrame, right: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """One row: rank correlation of two score tables and, with masks, both flagged counts."""
    ranks = average_ranks(left, id_col, "score", "r1").join(average_ranks(right, id_col, "score", "r2"), id_col)
    flagged = {
        f"{name}_predicted_anomaly_count": F.lit(table.where("is_anomaly").count()).cast("bigint")
        for name, table in (("left", left), ("right", right))
        if "is_anomaly" in table.columns
    }
    return ranks.agg(F.corr("r1", "r2").alias("spearman_score_correlation")).withColumns(flagged)


def set_cosine_spread(points: DataFrame, vector_col: str = "features", digits: int = 4) -> DataFrame:
    """One row ``(mean_internal_cosine_distance)`` over all pairs of the set.

    The mean over pairs follows from the length of the sum of the unit vectors,
    so no pairs are formed.
    """
    squares = F.aggregate(vector_col, F.lit(0.0), lambda acc, x: acc + x * x)
    length = F.col("_length")
    units = points.withColumn("_length", F.sqrt(squares)).select(
        F.transform(F.col(vector_col), lambda x: x / F.when(length > 0, length).otherwise(F.lit(1.0))).alias("u"),
        (length > 0).cast("long").alias("_some"),
    )
    totals = units.agg(
        vector_to_array(Summarizer.sum(array_to_vector("u"))).alias("s"),
        F.count(F.lit(1)).alias("m"),
        F.sum("_some").alias("some"),
    )
    squared = F.aggregate("s", F.lit(0.0), lambda acc, x: acc + x * x)
    pairs = F.col("m") * (F.col("m") - 1)
    return totals.select(
        F.when(pairs > 0, F.round(1.0 - (squared - F.col("some")) / pairs, digits)).alias("mean_internal_cosine_distance")
    )


def random_baseline(docs: DataFrame, rows: int = 50, seed: int = 42, id_col: str = "doc_id") -> DataFrame:
    """A fixed-size sample, the smallest MD5 of seed and id; the same whatever the partitioning."""
    draw = F.md5(F.concat_ws(":", F.lit(seed), F.col(id_col).cast("string")))
    return docs.select(id_col).orderBy(draw, id_col).limit(rows)


def detector_profile(
    detectors: Mapping[str, DataFrame],
    features: DataFrame,
    columns: Sequence[str],
    k: int = 50,
    id_col: str = "doc_id",
    baseline: str | None = "baseline",
) -> DataFrame:
    """Mean of the named features over each detector's top k; the baseline row is over all documents."""
    tops = [
        top_k(scores.select(id_col, "score"), k, id_col).select(id_col, F.lit(name).alias("detector"))
        for name, scores in detectors.items()
    ]
    chosen = reduce(DataFrame.unionByName, tops)
    means = [F.round(F.avg(c), 3).alias(f"mean_{c}") for c in columns]
    # At most detectors * k rows.
    profile = features.join(F.broadcast(chosen), id_col).groupBy("detector").agg(*means)
    if baseline:
        profile = profile.unionByName(features.agg(*means).withColumn("detector", F.lit(baseline)))
    return profile.select("detector", *[f"mean_{c}" for c in columns])


def structural_precision(
    detectors: Mapping[str, DataFrame], features: DataFrame, k: int = 50, id_col: str = "doc_id"
) -> DataFrame:
    """Per detector the share of its top k under both structural limits, and the two means."""
    tops = [
        top_k(scores.select(id_col, "score"), k, id_col).select(id_col, F.lit(name).alias("method"))
        for name, scores in detectors.items()
    ]
    chosen = reduce(DataFrame.unionByName, tops)
    odd = (F.col("bigram_type_token_ratio") < BIGRAM_LIMIT) & (F.col("compression_ratio") < COMPRESSION_LIMIT)
    return (
        features.join(F.broadcast(chosen), id_col)
        .groupBy("method")
        .agg(
            F.round(F.avg(odd.cast("double")), 3).alias("structural_precision"),
            F.round(F.avg("bigram_type_token_ratio"), 3).alias("mean_bigram_ttr"),
            F.round(F.avg("compression_ratio"), 3).alias("mean_compression_ratio"),
        )
    )
