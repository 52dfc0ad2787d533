"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docsieve.session import stored

#: A word: a run of characters other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"

#: Rows that one task numbers in ``running_total``.
ROWS_PER_BUCKET = 20_000


def word_count(text: Column) -> Column:
    """Words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def bucket_bits(rows: int, per_bucket: int = ROWS_PER_BUCKET) -> int:
    """Leading hash bits that cut ``rows`` rows into buckets of about ``per_bucket``."""
    return max(1, math.ceil(math.log2(max(2, rows / per_bucket))))


def first_at_least(edges: Column, value: Column) -> Column:
    """Place of the first of the sorted edges that is at least ``value`` (else the last), by binary search."""
    steps = F.sequence(F.lit(1), F.lit(17))
    start = F.struct(F.lit(0).alias("low"), (F.size(edges) - 1).alias("high"))

    def halve(span: Column, _: Column) -> Column:
        middle = F.floor((span["low"] + span["high"]) / 2).cast("int")
        fits = F.get(edges, middle) >= value
        return F.struct(
            F.when(fits, span["low"]).otherwise(F.least(middle + 1, span["high"])).alias("low"),
            F.when(fits, middle).otherwise(span["high"]).alias("high"),
        )

    return F.aggregate(steps, start, halve)["high"]


def running_total(
    df: DataFrame,
    group: Sequence[str],
    hash_col: str,
    ties: Sequence[str],
    value: Column,
    name: str,
    bits: int,
) -> DataFrame:
    """Add ``name``: the sum of ``value`` over the rows of the group that come before.

    Rows are ordered by the 64-bit hash ``hash_col`` (as unsigned number), then
    by ``ties``.  The leading ``bits`` of the hash cut every group into buckets,
    each summed in its own task; bucket totals are added up from a table of one
    row per bucket.  No task holds a whole group.  Rows equal in all of these
    columns are interchangeable.
    """
    bucket, amount, before = "__bucket", "__amount", "__before"
    tagged = df.withColumns({bucket: F.shiftrightunsigned(hash_col, 64 - bits), amount: value})
    # The sign bit flipped, a signed comparison orders like an unsigned one.
    order = [F.col(hash_col).bitwiseXOR(F.lit(-(2**63))), *[F.col(c) for c in ties]]
    inside = Window.partitionBy(*group, bucket).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    within = tagged.withColumn(name, F.coalesce(F.sum(amount).over(inside), F.lit(0)))
    totals = tagged.groupBy(*group, bucket).agg(F.sum(amount).alias(amount))
    earlier = Window.partitionBy(*group).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *[F.col(c).alias(f"__of_{c}") for c in group],
        F.col(bucket).alias(f"__of{bucket}"),
        F.coalesce(F.sum(amount).over(earlier), F.lit(0)).alias(before),
    )
    same = F.col(bucket) == F.col(f"__of{bucket}")
    for c in group:
        same &= F.col(c).eqNullSafe(F.col(f"__of_{c}"))
    joined = within.join(offsets, same)
    return joined.withColumn(name, (F.col(name) + F.col(before)).cast("long")).select(*df.columns, name)


def connected_components(links: DataFrame, left: str = "a", right: str = "b", rounds: int = 60) -> DataFrame:
    """``(node, component)``: each linked node with the smallest node it reaches.

    Large-star and small-star rounds: every node passes its smallest neighbour
    to the others, so a star or chain shrinks by powers, and a hub's neighbours
    are grouped by partial aggregation only.  Each round is stored, so a lost
    executor costs at most one round.  Raises when ``rounds`` do not settle it.
    """
    pairs = links.select(F.greatest(left, right).alias("v"), F.least(left, right).alias("u"))
    edges = stored(pairs.where("v <> u").distinct())
    previous = None
    for _ in range(rounds):
        # Large star: neighbours greater than a node move to the node's smallest neighbour.
        both = edges.select(F.col("v").alias("n"), F.col("u").alias("m")).unionByName(
            edges.select(F.col("u").alias("n"), F.col("v").alias("m"))
        )
        least = both.groupBy("n").agg(F.least(F.min("m"), F.col("n")).alias("low"))
        large = (
            both.where("m > n").join(least, "n").select(F.col("m").alias("v"), F.col("low").alias("u")).where("v <> u").distinct()
        )
        # Small star: smaller neighbours and the node itself move to the smallest one.
        low = large.groupBy("v").agg(F.min("u").alias("low"))
        moved = large.join(low, "v").select(F.col("u").alias("v"), F.col("low").alias("u")).where("v <> u")
        edges = stored(moved.unionByName(low.select("v", F.col("low").alias("u"))).distinct())
        total = edges.agg(
            F.count("*").alias("edges"),
            F.coalesce(F.sum(F.xxhash64("v", "u").cast("decimal(38,0)")), F.lit(0)).alias("sum"),
        ).first()
        state = (total["edges"], total["sum"])
        if state == previous:
            return edges.select(F.col("v").alias("node"), F.col("u").alias("component")).unionByName(
                edges.select(F.col("u").alias("node"), F.col("u").alias("component")).distinct()
            )
        previous = state
    raise RuntimeError(f"components did not settle in {rounds} rounds")
