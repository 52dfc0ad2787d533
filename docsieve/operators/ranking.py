"""Global ranks, exact quantiles and ranked tables without a single-task sort."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from docsieve.operators.lookup import attach_text
from docsieve.session import settle, shuffle_width

# Accuracy of the quantile sketch that brackets an exact order statistic.
SKETCH_ACCURACY = 10_000


def global_rank(df: DataFrame, order: Sequence[str | Column], rank_col: str, start: int = 1) -> DataFrame:
    """Append the position of each row in the total order ``order``.

    The rows are range-partitioned and sorted; the partition number and the
    place inside it come from ``monotonically_increasing_id``.  The result is
    checkpointed, so both stay fixed, and each partition is moved up by the
    sizes of those before it (one number per partition).  A unique last key in
    ``order`` lets rows with equal scores spread over partitions.
    """
    spark = df.sparkSession
    keys = [F.col(key) if isinstance(key, str) else key for key in order]
    placed = settle(
        df.repartitionByRange(shuffle_width(spark), *keys)
        .sortWithinPartitions(*keys)
        .withColumn("_place", F.monotonically_increasing_id())
    )
    part = F.shiftright(F.col("_place"), 33)
    sizes = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_size")).orderBy("_part").collect()
    offsets, seen = [], start
    for row in sizes:
        offsets.append((row["_part"], seen))
        seen += row["_size"]
    if not offsets:
        return placed.select(*df.columns, F.lit(0).cast("bigint").alias(rank_col))
    table = spark.createDataFrame(offsets, "_part long, _offset long")
    inside = F.col("_place").bitwiseAND(F.lit((1 << 33) - 1))
    return (
        placed.withColumn("_part", part)
        .join(F.broadcast(table), "_part")
        .select(*df.columns, (F.col("_offset") + inside).alias(rank_col))
    )


def exact_quantiles(df: DataFrame, columns: Sequence[str], probabilities: Sequence[float]) -> dict[str, list[float | None]]:
    """Linearly interpolated quantiles of several columns, exact at any size."""
    return _exact_values(df, columns, probabilities, lambda p, n: p * (n - 1))


def order_statistic(df: DataFrame, column: str, share: float) -> float | None:
    """The value at position ``floor(n * share)`` from 0 in ascending order, None beyond the last; nulls do not count."""
    return _exact_values(df, [column], [share], lambda p, n: float(int(n * p)))[column][0]


def _exact_values(
    df: DataFrame, columns: Sequence[str], probabilities: Sequence[float], position: Callable[[float, int], float]
) -> dict[str, list[float | None]]:
    """Values at the positions that ``position`` gives for each probability and number of rows.

    A position may differ by one from the quantile's.  One pass brackets every
    wanted order statistic with a quantile sketch; a second pass counts the rows
    below each bracket and groups the equal values inside it.  Only those few
    distinct values are then put in order, so no task holds a column.
    """
    probabilities = list(probabilities)
    slack = 2.0 / SKETCH_ACCURACY
    lows = [max(0.0, p - slack) for p in probabilities]
    highs = [min(1.0, p + slack) for p in probabilities]
    sketch = df.agg(
        *[F.count(c).alias(f"n_{i}") for i, c in enumerate(columns)],
        *[F.min(c).cast("double").alias(f"min_{i}") for i, c in enumerate(columns)],
        *[F.max(c).cast("double").alias(f"max_{i}") for i, c in enumerate(columns)],
        *[
            F.percentile_approx(F.col(c).cast("double"), lows + highs, SKETCH_ACCURACY).alias(f"q_{i}")
            for i, c in enumerate(columns)
        ],
    ).first()
    brackets = []
    for i, _ in enumerate(columns):
        n = sketch[f"n_{i}"]
        for j, p in enumerate(probabilities):
            if n == 0:
                continue
            below, above = sketch[f"q_{i}"][j], sketch[f"q_{i}"][len(probabilities) + j]
            # Very small tables: the neighbours of a position may lie outside the bracket.
            if n * slack < 4:
                steps = 4.0 / n
                below = sketch[f"min_{i}"] if p - steps <= 0 else below
                above = sketch[f"max_{i}"] if p + steps >= 1 else above
            brackets.append((i, j, position(p, n), below, above))
    result: dict[str, list[float | None]] = {c: [None] * len(probabilities) for c in columns}
    found = _resolve(df, columns, brackets)
    missed = [b for b in brackets if (b[0], b[1]) not in found]
    if missed:
        wide = [(i, j, pos, sketch[f"min_{i}"], sketch[f"max_{i}"]) for i, j, pos, _, _ in missed]
        found.update(_resolve(df, columns, wide))
    for (i, j), value in found.items():
        result[columns[i]][j] = value
    return result


def _resolve(df: DataFrame, columns: Sequence[str], brackets: list[tuple]) -> dict[tuple[int, int], float]:
    """Values at the wanted positions, for the brackets that hold both neighbours."""
    if not brackets:
        return {}
    cells = [
        F.struct(
            F.lit(i).alias("c"),
            F.lit(j).alias("p"),
            F.col(columns[i]).cast("double").alias("v"),
            F.lit(float(low)).alias("low"),
            F.lit(float(high)).alias("high"),
        )
        for i, j, _, low, high in brackets
    ]
    # Rows below a bracket collapse to one group each, so only counts are shuffled.
    grouped = (
        df.select(F.explode(F.array(*cells)).alias("cell"))
        .select("cell.*")
        .where("v is not null and v <= high")
        .groupBy("c", "p", F.when(F.col("v") >= F.col("low"), F.col("v")).alias("v"))
        .agg(F.count(F.lit(1)).alias("cnt"))
    )
    running = Window.partitionBy("c", "p").orderBy(F.col("v").asc_nulls_first())
    cumulative = grouped.withColumn("upto", F.sum("cnt").over(running))
    positions = df.sparkSession.createDataFrame(
        [(i, j, int(pos), min(int(pos) + 1, int(-(-pos // 1)) if pos > int(pos) else int(pos))) for i, j, pos, _, _ in brackets],
        "c int, p int, first long, second long",
    )
    upto, cnt = F.col("upto"), F.col("cnt")
    holds = lambda place: (F.col(place) >= upto - cnt) & (F.col(place) < upto) & F.col("v").isNotNull()
    rows = (
        cumulative.join(F.broadcast(positions), ["c", "p"])
        .groupBy("c", "p")
        .agg(
            F.max(F.when(holds("first"), F.col("v"))).alias("a"),
            F.max(F.when(holds("second"), F.col("v"))).alias("b"),
        )
        .collect()
    )
    spots = {(i, j): pos for i, j, pos, _, _ in brackets}
    found = {}
    for row in rows:
        if row["a"] is None or row["b"] is None:
            continue
        pos = spots[(row["c"], row["p"])]
        found[(row["c"], row["p"])] = row["a"] + (row["b"] - row["a"]) * (pos - int(pos))
    return found


def quantile(df: DataFrame, column: str, probability: float) -> float | None:
    """One exact quantile of one column."""
    return exact_quantiles(df, [column], [probability])[column][0]


def candidate_table(scores: DataFrame, id_col: str = "doc_id", mask_col: str | None = None) -> DataFrame:
    """``(id, score[, predicted_anomaly], anomaly_rank)``: lowest score first, ties by id."""
    columns = [F.col(id_col), F.col("score")]
    if mask_col:
        columns.append(F.col(mask_col).alias("predicted_anomaly"))
    return global_rank(scores.select(*columns), ["score", id_col], "anomaly_rank")


def anomaly_output(
    scores: DataFrame, count: int | None = 50, id_col: str = "doc_id", mask_col: str = "is_anomaly"
) -> DataFrame:
    """``(anomaly, id)``: the ``count`` lowest scores, or all flagged rows when ``count`` is None."""
    if count is None:
        flagged = scores.where(F.col(mask_col)).select(id_col, "score")
        return global_rank(flagged, ["score", id_col], "anomaly").select("anomaly", id_col)
    return top_k(scores, max(0, count), id_col, rank_col="anomaly").select("anomaly", id_col)


def top_k(scores: DataFrame, k: int, id_col: str = "doc_id", score_col: str = "score", rank_col: str = "rank") -> DataFrame:
    """The ``k`` lowest scores with their rank; only k rows leave the top-k step."""
    lowest = scores.orderBy(score_col, id_col).limit(k)
    place = F.row_number().over(Window.orderBy(score_col, id_col))
    return lowest.withColumn(rank_col, place.cast("bigint"))


def rank_normalized(scores: DataFrame, id_col: str = "doc_id", score_col: str = "score", out_col: str = "rank_score") -> DataFrame:
    """Rank 0..n-1 (lowest score first) divided by n-1."""
    total = scores.count()
    ranked = global_rank(scores.select(id_col, score_col), [score_col, id_col], "_rank", start=0)
    return ranked.select(id_col, (F.col("_rank") / F.lit(float(max(total - 1, 1)))).alias(out_col))


def best_per_group(rows: DataFrame, group_col: str, value_col: str, tie_cols: Sequence[str] = ()) -> DataFrame:
    """The row with the highest value in each group; rows without a value never win."""
    order = Window.partitionBy(group_col).orderBy(F.desc(value_col), *tie_cols)
    return (
        rows.where(F.col(value_col).isNotNull())
        .withColumn("_place", F.row_number().over(order))
        .where("_place = 1")
        .drop("_place")
    )


def global_best(rows: DataFrame, value_col: str, tie_cols: Sequence[str] = ()) -> DataFrame:
    """The single row with the highest value."""
    return rows.where(F.col(value_col).isNotNull()).orderBy(F.desc(value_col), *tie_cols).limit(1)


def lowest_with_text(
    features: DataFrame, feature: str, docs: DataFrame, n: int = 5, length: int = 400, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The ``n`` lowest documents by one feature, with a snippet."""
    from docsieve.functions.cleaning import snippet

    lowest = features.select(id_col, feature).orderBy(feature, id_col).limit(n)
    joined = attach_text(lowest, docs, id_col, text_col)
    return joined.select(id_col, feature, snippet(F.col(text_col), length).alias("snippet"))


def unpivot(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = (), name_col: str = "feature", value_col: str = "value") -> DataFrame:
    """One row per kept columns and named column."""
    cells = F.array(*[F.struct(F.lit(c).alias(name_col), F.col(c).cast("double").alias(value_col)) for c in columns])
    return df.select(*keep, F.inline(cells))


def extreme_documents(
    features: DataFrame, columns: Sequence[str], docs: DataFrame, length: int = 200, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """For each feature the document with the lowest value, ties by id."""
    from docsieve.functions.cleaning import snippet

    longer = unpivot(features, columns, [id_col])
    lowest = longer.groupBy("feature").agg(F.min(F.struct("value", id_col)).alias("_low"))
    lowest = lowest.select("feature", F.col(f"_low.{id_col}").alias(id_col), F.col("_low.value").alias("value"))
    joined = attach_text(lowest, docs, id_col, text_col)
    return joined.select("feature", id_col, "value", snippet(F.col(text_col), length).alias("snippet"))


def side_by_side(
    left: DataFrame, right: DataFrame, docs: DataFrame, k: int = 10, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Two rankings beside each other by rank, with texts; inputs are ``(id, score)``."""
    parts = []
    for side, scores in (("left", left), ("right", right)):
        ranked = attach_text(top_k(scores.select(id_col, "score"), k, id_col), docs, id_col, text_col)
        parts.append(
            ranked.select(
                "rank",
                F.col(id_col).alias(f"{side}_{id_col}"),
                F.col("score").alias(f"{side}_score"),
                F.col(text_col).alias(f"{side}_text"),
            )
        )
    return parts[0].join(parts[1], "rank")
