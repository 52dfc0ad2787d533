"""Mean silhouette of a labelled table."""

from __future__ import annotations

from collections.abc import Hashable, Iterator, Mapping
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docsieve.operators.blocks import (
    BLOCK_ROWS,
    block_join,
    distance_sums,
    matrix,
    slices,
    sparse_distance_sums,
    travel_rows,
)
from docsieve.session import settle

# Sparse pieces are laid out as terms by rows inside a task, so they are smaller.
SPARSE_BLOCK_ROWS = 512
# Sums per label that are added up together.
BUCKET_SUMS = 32_768
# Every task holds one mean per cluster.
MAX_CLUSTERS = 1000


def _center_distances(batch: pd.DataFrame, centers: np.ndarray) -> np.ndarray:
    """Distance of each row to each cluster mean."""
    if "ids" not in batch:
        return np.vstack([np.sqrt(((matrix(batch["v"]) - c) ** 2).sum(1)) for c in centers]).T
    norms = (centers**2).sum(1)
    squared = [
        values @ values - 2.0 * (centers[:, ids] @ values) + norms
        for ids, values in zip(batch["ids"], batch["v"], strict=True)
    ]
    return np.sqrt(np.maximum(np.array(squared), 0.0))


def _distance_sums(queries: pd.DataFrame, data: pd.DataFrame, rows: int) -> np.ndarray:
    """For each query the sum of its distances to the data rows, copies counted, ``rows`` at a time."""
    weight = data["weight"].to_numpy(dtype="float64")[:, None]
    if "ids" not in data:
        return distance_sums(matrix(queries["v"]), matrix(data["v"]), weight, rows)[:, 0]
    return sparse_distance_sums(queries, data, weight, rows)[:, 0]


def silhouette(
    points: DataFrame,
    label_col: str = "label",
    id_col: str = "doc_id",
    vector_col: str = "features",
    metric: str = "euclidean",
    block_rows: int | None = None,
) -> float:
    """Mean silhouette over all rows; rows alone in their cluster count as 0.

    ``euclidean`` is the exact mean of all distances.  Its work grows with the
    square of the distinct vectors inside the clusters that are compared, which
    no rewriting avoids; ``squared_euclidean`` and ``cosine`` follow from
    per-cluster sums and stay linear, so use those for very large tables.
    """
    if metric == "euclidean":
        rows = silhouette_rows(points, label_col, id_col, vector_col, block_rows)
        total = rows.agg(F.sum(F.col("weight") * F.col("silhouette")).alias("s"), F.sum("weight").alias("n")).first()
        return float(total["s"] / total["n"])
    names = {"squared_euclidean": "squaredEuclidean", "cosine": "cosine"}
    if metric not in names:
        raise ValueError(f"Unsupported metric '{metric}'.")
    column = F.col(vector_col)
    if isinstance(points.schema[vector_col].dataType, T.ArrayType):
        column = array_to_vector(column.cast("array<double>"))
    shaped = points.select(F.col(label_col).cast("int").alias("prediction"), column.alias("features"))
    return float(ClusteringEvaluator(distanceMeasure=names[metric]).evaluate(shaped))


def silhouette_rows(
    points: DataFrame,
    label_col: str = "label",
    id_col: str = "doc_id",
    vector_col: str = "features",
    block_rows: int | None = None,
) -> DataFrame:
    """``(label, rep, silhouette, weight)`` per distinct vector and cluster; weight counts its copies.

    A row needs the distances to its own cluster and to the cluster with the
    smallest mean distance.  That mean lies between the distance to the centroid
    and the root mean squared distance, both known from per-cluster sums, so
    clusters that cannot be the nearest are never visited.  What is visited
    travels in large loads, is worked on ``block_rows`` rows at a time, and only
    sums leave a task.
    """
    sparse = not isinstance(points.schema[vector_col].dataType, T.ArrayType)
    parts = {"v": F.col(vector_col).cast("array<double>")} if not sparse else {
        "v": F.unwrap_udt(F.col(vector_col))["values"],
        "ids": F.coalesce(
            F.unwrap_udt(F.col(vector_col))["indices"],
            F.sequence(F.lit(0), F.size(F.unwrap_udt(F.col(vector_col))["values"]) - 1),
        ),
    }
    vector_fields = list(parts)
    labelled = points.select(
        F.col(label_col).alias("label"), F.col(id_col).alias("id"), *[c.alias(name) for name, c in parts.items()]
    )
    grouped = settle(
        labelled.groupBy("label", *vector_fields).agg(F.count(F.lit(1)).alias("weight"), F.min("id").alias("rep"))
    )
    rep_type = points.schema[id_col].dataType.simpleString()
    label_type = points.schema[label_col].dataType.simpleString()
    as_vector = F.col(vector_col) if sparse else array_to_vector(F.col(vector_col).cast("array<double>"))
    summary = Summarizer.metrics("mean", "normL2").summary(as_vector)
    totals = points.groupBy(F.col(label_col).alias("label")).agg(F.count(F.lit(1)).alias("n"), summary.alias("m"))
    # One row per cluster, and no more than the bound.
    stats = totals.orderBy("label").limit(MAX_CLUSTERS + 1).collect()
    if not 2 <= len(stats) <= MAX_CLUSTERS:
        raise ValueError(f"The silhouette needs 2 to {MAX_CLUSTERS} clusters.")
    labels = [row["label"] for row in stats]
    number = {label: place for place, label in enumerate(labels)}
    sizes = np.array([row["n"] for row in stats], dtype="float64")
    centers = np.array([row["m"]["mean"].toArray() for row in stats])
    squares = np.array([(row["m"]["normL2"].toArray() ** 2).sum() for row in stats])
    variance = np.maximum(squares / sizes - (centers**2).sum(1), 0.0)

    def choose(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in slices(batches, len(labels)):
            own = batch["label"].map(number).to_numpy()
            every = np.arange(len(batch))
            to_center = _center_distances(batch, centers)
            upper = np.sqrt(to_center**2 + variance[None, :])
            upper[every, own] = np.inf
            wanted = to_center <= upper.min(1)[:, None] * (1 + 1e-9) + 1e-9
            wanted[every, own] = True
            cells = np.split(np.nonzero(wanted)[1].astype("int32"), np.cumsum(wanted.sum(1))[:-1])
            yield pd.DataFrame(
                {
                    "rep": batch["rep"].to_numpy(),
                    "own": own.astype("int32"),
                    "weight": batch["weight"].to_numpy(),
                    **{name: batch[name].to_numpy() for name in vector_fields},
                    "cells": cells,
                }
            )

    rows = block_rows or (SPARSE_BLOCK_ROWS if sparse else BLOCK_ROWS)

    def add_up(queries: pd.DataFrame, data: pd.DataFrame) -> pd.DataFrame:
        if queries.empty or data.empty:
            return pd.DataFrame({"rep": [], "own": [], "weight": [], "cell": [], "total": []})
        return pd.DataFrame(
            {
                "rep": queries["rep"],
                "own": queries["own"],
                "weight": queries["weight"],
                "cell": queries["cell"],
                "total": _distance_sums(queries, data, rows),
            }
        )

    vector_types = {"v": "v array<double>", "ids": "ids array<int>"}
    visits = grouped.select("rep", "label", "weight", *vector_fields).mapInPandas(
        choose,
        f"rep {rep_type}, own int, weight long, {', '.join(vector_types[name] for name in vector_fields)}, cells array<int>",
    )
    lookup = points.sparkSession.createDataFrame(
        [(label, number[label], float(sizes[number[label]])) for label in labels], f"label {label_type}, cell int, n double"
    )
    data = grouped.join(F.broadcast(lookup), "label").select("cell", "rep", *vector_fields, "weight")
    sums = (
        block_join(
            settle(visits).withColumn("cell", F.explode("cells")).drop("cells"),
            data,
            "rep",
            "rep",
            add_up,
            f"rep {rep_type}, own int, weight long, cell int, total double",
            _load_rows(grouped, sparse),
        )
        .groupBy("rep", "own", "weight", "cell")
        .agg(F.sum("total").alias("total"))
        .join(F.broadcast(lookup.select("cell", "n")), "cell")
    )
    inside = F.col("cell") == F.col("own")
    means_by_row = sums.groupBy("rep", "own", "weight").agg(
        F.max(F.when(inside, F.col("total") / F.greatest(F.col("n") - 1, F.lit(1.0)))).alias("a"),
        F.max(F.when(inside, F.col("n"))).alias("size"),
        F.min(F.when(~inside, F.col("total") / F.col("n"))).alias("b"),
    )
    value = F.when((F.col("size") <= 1) | (F.greatest("a", "b") == 0), F.lit(0.0)).otherwise(
        (F.col("b") - F.col("a")) / F.greatest("a", "b")
    )
    scored = means_by_row.join(F.broadcast(lookup.select(F.col("cell").alias("own"), "label")), "own")
    return scored.select("label", "rep", value.alias("silhouette"), "weight")


def _load_rows(rows: DataFrame, sparse: bool) -> int:
    """Rows of one side that travel together, by the entries that the rows have."""
    found = rows.agg(F.count(F.lit(1)).alias("n"), F.avg(F.size("v")).alias("entries")).first()
    # An entry of a sparse row has its place beside it, and frequent ones are laid out once more.
    return travel_rows(found["n"], (found["entries"] or 1.0) * (3.0 if sparse else 1.0))


def _label_sums(width: int, rows: int):
    """For each query row the sums of its distances to the data rows of every label of every run."""

    def run(queries: pd.DataFrame, data: pd.DataFrame) -> pd.DataFrame:
        if queries.empty or data.empty:
            return pd.DataFrame({"id": [], "sums": []})
        member = np.zeros((len(data), width))
        member[np.arange(len(data))[:, None], matrix(data["labels"])] = 1.0
        if "ids" in data:
            sums = sparse_distance_sums(queries, data, member, rows, "id")
        else:
            sums = distance_sums(matrix(queries["v"]), matrix(data["v"]), member, rows)
        return pd.DataFrame({"id": queries["id"], "sums": list(sums)})

    return run


def _added(rows: pd.DataFrame) -> pd.DataFrame:
    """``(id, sums)``: the sums of each id in one bucket, added."""
    codes, names = pd.factorize(rows["id"], use_na_sentinel=False)
    order = np.argsort(codes, kind="stable")
    first = np.searchsorted(codes[order], np.arange(len(names)))
    return pd.DataFrame({"id": names, "sums": list(np.add.reduceat(matrix(rows["sums"])[order], first, axis=0))})


def silhouette_runs(
    points: DataFrame,
    runs: Mapping[Hashable, DataFrame],
    id_col: str = "doc_id",
    vector_col: str = "features",
    block_rows: int | None = None,
) -> dict[Hashable, float | None]:
    """The exact Euclidean silhouettes of many labelings ``(id, label)`` of the same rows, by one pass over the distances.

    Rows travel in large loads and are worked on ``block_rows`` at a time.  Every distance is worked out once, and its sums per label of all runs come from one product, so dozens of runs
    cost about as much as one.  A run with fewer than two labels, or as many as rows, has None.  The driver holds
    one number per label of every run.
    """
    sparse = not isinstance(points.schema[vector_col].dataType, T.ArrayType)
    vector = F.unwrap_udt(F.col(vector_col))
    parts = [vector["values"].alias("v"), F.coalesce(vector["indices"], F.sequence(F.lit(0), F.size(vector["values"]) - 1)).alias("ids")]
    fields = parts if sparse else [F.col(vector_col).cast("array<double>").alias("v")]
    names = list(runs)
    long = reduce(
        DataFrame.unionByName,
        [runs[name].select(F.col(id_col).alias("id"), F.lit(at).alias("run"), F.col("label").cast("bigint").alias("label")) for at, name in enumerate(names)],
    )
    long = settle(long)
    found = long.groupBy("run", "label").agg(F.count(F.lit(1)).alias("n")).orderBy("run", "label").collect()
    number = points.sparkSession.createDataFrame(
        [(row["run"], row["label"], at) for at, row in enumerate(found)], "run int, label bigint, number int"
    )
    of_run, sizes = np.array([row["run"] for row in found]), np.array([row["n"] for row in found], dtype="float64")
    numbered = long.join(F.broadcast(number), ["run", "label"]).groupBy("id")
    labels = numbered.agg(F.transform(F.array_sort(F.collect_list(F.struct("run", "number"))), lambda x: x["number"]).alias("labels"))
    rows = settle(points.select(F.col(id_col).alias("id"), *fields).join(labels, "id").withColumn("cell", F.lit(0)))
    id_type = rows.schema["id"].dataType.simpleString()
    shape, work = f"id {id_type}, sums array<double>", _label_sums(len(found), block_rows or (SPARSE_BLOCK_ROWS if sparse else BLOCK_ROWS))
    load = _load_rows(rows, sparse)
    pieces = block_join(rows, rows, "id", "id", work, shape, load)
    # A bucket's sums come from every load, so it has the fewer ids the more loads there are.
    total = max(1, rows.count())
    buckets = max(1, -(-total * -(-total // load) // BUCKET_SUMS))
    sums = pieces.groupBy(F.pmod(F.xxhash64("id"), F.lit(buckets)).alias("_bucket")).applyInPandas(_added, shape)

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if batch.empty:
                continue
            totals, own = matrix(batch["sums"]), matrix(batch["labels"])
            for run in range(len(names)):
                columns = np.nonzero(of_run == run)[0]
                mine = own[:, run]
                inside = totals[np.arange(len(batch)), mine] / np.maximum(sizes[mine] - 1, 1)
                means = totals[:, columns] / sizes[columns]
                means[np.arange(len(batch)), mine - columns[0]] = np.inf
                outside = means.min(1)
                largest = np.maximum(inside, outside)
                with np.errstate(divide="ignore", invalid="ignore"):
                    values = np.where((sizes[mine] <= 1) | (largest == 0) | ~np.isfinite(outside), 0.0, (outside - inside) / largest)
                yield pd.DataFrame({"run": [run], "total": [values.sum()], "n": [len(batch)]})

    scored = sums.join(rows.select("id", "labels"), "id").mapInPandas(score, "run int, total double, n bigint")
    means = {r["run"]: r["s"] for r in scored.groupBy("run").agg((F.sum("total") / F.sum("n")).alias("s")).collect()}
    result: dict[Hashable, float | None] = {}
    for at, name in enumerate(names):
        clusters, count = int((of_run == at).sum()), sizes[of_run == at].sum()
        result[name] = means.get(at) if 2 <= clusters < count else None
    return result
