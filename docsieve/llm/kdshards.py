"""K-d tree sharding: recursive weighted splits along the widest metadata dimension."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docsieve.llm.common import bucket_bits, first_at_least, running_total
from docsieve.session import stored


@dataclass(frozen=True)
class Node:
    """A part of the tree: the shards ``first`` to ``first + leaves``, or a cut into two such parts."""

    first: int
    leaves: int
    dimension: str | None = None
    cut: int | None = None
    low: Node | None = None
    high: Node | None = None


def _assign(nodes: dict[int, Node]) -> Column:
    """The open part a row falls into, from the cuts made so far."""

    def walk(node: Node) -> Column:
        if node.dimension is None:
            return F.lit(node.first)
        return F.when(F.col(node.dimension) <= F.lit(node.cut), walk(node.low)).otherwise(walk(node.high))

    # A tree without cuts names a column, so that joins by part keep a key.
    return F.col("root") if nodes[0].dimension is None else walk(nodes[0])


def fit_tree(points: DataFrame, dimensions: Sequence[str], weight: str, leaves: int, edges: int = 1000) -> Node:
    """Cut the points into ``leaves`` parts of near equal weight.

    ``dimensions`` are long columns, ``root`` is 0 in every row.  Every level takes two passes, each an
    aggregation over all points: one finds each part's extent per dimension and
    ``edges`` quantiles, the other sums the weights between the quantiles of the
    widest dimension (its extent against that of the whole table).  The part is
    cut at the quantile whose weight below is nearest to its lower leaves'
    share, the weighted median where the leaves are even.  The driver holds
    ``leaves`` cuts and the quantiles of one level.
    """
    tree = {0: Node(0, leaves)}
    probabilities = [i / edges for i in range(edges + 1)]
    whole: dict[str, float] = {}

    def put(node: Node, first: int, new: Node) -> Node:
        if node.dimension is None:
            return new if node.first == first else node
        low, high = node.low, node.high
        if first < high.first:
            low = put(low, first, new)
        else:
            high = put(high, first, new)
        return Node(node.first, node.leaves, node.dimension, node.cut, low, high)

    def open_parts(node: Node) -> list[Node]:
        if node.dimension is None:
            return [node] if node.leaves > 1 else []
        return open_parts(node.low) + open_parts(node.high)

    while parts := open_parts(tree[0]):
        wanted = [part.first for part in parts]
        tagged = points.withColumn("__part", _assign(tree)).where(F.col("__part").isin(wanted))
        measures = []
        for d in dimensions:
            measures += [
                F.min(d).alias(f"min_{d}"),
                F.max(d).alias(f"max_{d}"),
                F.percentile_approx(d, probabilities, 10 * edges).alias(f"edges_{d}"),
            ]
        found = {row["__part"]: row for row in tagged.groupBy("__part").agg(*measures).collect()}
        if not whole and found:
            row = next(iter(found.values()))
            whole = {d: max(1, row[f"max_{d}"] - row[f"min_{d}"]) for d in dimensions}
        chosen = {}
        for part in parts:
            row = found.get(part.first)
            if row is not None:
                widest = max(dimensions, key=lambda d, row=row: (row[f"max_{d}"] - row[f"min_{d}"]) / whole[d])
                chosen[part.first] = (widest, sorted(set(row[f"edges_{widest}"])))
        sums: dict[int, dict[int, int]] = {}
        if chosen:
            spark = points.sparkSession
            table = spark.createDataFrame(
                [(k, d, e) for k, (d, e) in chosen.items()], "part int, dimension string, edges array<bigint>"
            )
            value = F.coalesce(*[F.when(F.col("dimension") == d, F.col(d)) for d in dimensions])
            place = first_at_least(F.col("edges"), value)
            # The table is bounded: leaves x edges numbers.
            binned = tagged.join(F.broadcast(table), F.col("__part") == F.col("part")).withColumn("bin", place)
            for row in binned.groupBy("part", "bin").agg(F.sum(weight).alias("w")).collect():
                sums.setdefault(row["part"], {})[row["bin"]] = row["w"]
        for part in parts:
            lower = part.leaves // 2
            low, high = Node(part.first, lower), Node(part.first + lower, part.leaves - lower)
            dimension, cut = dimensions[0], 0
            if part.first in chosen:
                dimension, marks = chosen[part.first]
                weights = sums[part.first]
                goal, below, best = sum(weights.values()) * lower / part.leaves, 0, None
                for i, mark in enumerate(marks):
                    below += weights.get(i, 0)
                    if best is None or abs(below - goal) < best[0]:
                        best = (abs(below - goal), mark)
                cut = best[1]
            tree[0] = put(tree[0], part.first, Node(part.first, part.leaves, dimension, cut, low, high))
    return tree[0]


def spread_ties(value: Column, *keys: Column) -> Column:
    """A 28-bit value with 24 bits of a hash below it: rows of equal value can be told apart and cut.

    Quantiles are kept as doubles, which hold such numbers exactly.
    """
    low = F.shiftrightunsigned(F.xxhash64(*keys), 40)
    return F.shiftleft(value.cast("long"), 24).bitwiseOR(low)


def kd_shards(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    shards: int = 40,
    target_bytes: int | None = None,
    overhead: int = 16,
    edges: int = 1000,
) -> DataFrame:
    """Put every document into a shard of near equal bytes; one row per document.

    The metadata dimensions are the logarithm of the text's bytes and its CRC-32,
    so that a shard holds texts of like length and equal texts stay together
    unless a cut has to pass through them; there a hash of the id decides.  With
    ``target_bytes`` the number of shards follows from all bytes instead.

    Returns ``(id, size, text_crc32, shard, slot)``; ``size`` is the UTF-8 bytes
    plus ``overhead``, ``slot`` runs from 0 in each shard without gaps, in the
    order of a hash.  Null texts count as empty; rows equal in id and text are
    interchangeable; an empty table gives no rows; with fewer documents than
    shards some shards stay empty.
    """
    size = F.coalesce(F.octet_length(F.col(text_col)), F.lit(0)).cast("long") + overhead
    crc = F.crc32(F.coalesce(F.col(text_col), F.lit("")))
    chosen = docs.select(F.col(id_col).alias("id"), size.alias("size"), crc.alias("text_crc32"))
    length = F.floor(F.log2(F.col("size").cast("double")) * (1 << 22))
    points = stored(
        chosen.withColumns(
            {
                "by_length": spread_ties(length, F.col("text_crc32"), F.col("id")),
                "by_crc": spread_ties(F.shiftrightunsigned("text_crc32", 4), F.col("text_crc32"), F.col("id")),
                "order": F.xxhash64("id", "text_crc32"),
                "root": F.lit(0),
            }
        )
    )
    total = points.agg(F.count("*").alias("rows"), F.coalesce(F.sum("size"), F.lit(0)).alias("bytes")).first()
    if target_bytes is not None:
        shards = max(1, round(total["bytes"] / target_bytes))
    tree = fit_tree(points, ["by_length", "by_crc"], "size", shards, edges)
    placed = points.withColumn("shard", _assign({0: tree}))
    numbered = running_total(
        placed, ["shard"], "order", ["id", "text_crc32", "size"], F.lit(1), "slot", bucket_bits(total["rows"] // shards + 1)
    )
    return numbered.select("id", "size", "text_crc32", "shard", "slot")
