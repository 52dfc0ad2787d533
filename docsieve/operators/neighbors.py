"""Exact nearest neighbours by partitioning the space around pivots."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from docsieve.operators.blocks import PRODUCT_COLUMNS, PRODUCT_DOUBLES, Products, block_join, gap_lengths, matrix, slices, travel_rows
from docsieve.session import settle

# Upper bound on the pivots every task holds.
MAX_PIVOTS = 4096
# Distinct vectors per cell while the number of pivots is below its bound.
CELL_ROWS = 512
# Pairs of a query and a near row that a task holds before it drops those that nearer ones overtook.
KEPT_PAIRS = 2_000_000
# Rounding allowance of the pruning bounds, relative to the size of the vectors.
SLACK = 1e-6


def _copies(points: DataFrame, k: int) -> DataFrame:
    """One row per distinct vector with its ``k + 1`` smallest ids.

    Neighbours are ordered by distance and id, so the other copies of a vector
    can never be among the nearest.  The rank filter runs before the shuffle,
    so each task sends at most ``k + 1`` rows of a group of copies.
    """
    first = Window.partitionBy("v").orderBy("id")
    return (
        points.withColumn("_n", F.row_number().over(first))
        .where(F.col("_n") <= k + 1)
        .groupBy("v")
        .agg(F.sort_array(F.collect_list("id")).alias("ids"))
        .select(F.get("ids", 0).alias("rep"), "v", "ids")
    )


def _pivot_distances(block: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    squared = (block**2).sum(1)[:, None] + (pivots**2).sum(1)[None, :] - 2.0 * block @ pivots.T
    return np.sqrt(np.maximum(squared, 0.0))


def _assign(reps: DataFrame, pivots: np.ndarray, k: int, id_type: str) -> DataFrame:
    """Append the nearest pivot, the distance to it and a first bound on the k-th neighbour."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in slices(batches, len(pivots)):
            distances = _pivot_distances(matrix(batch["v"]), pivots)
            cell = distances.argmin(1)
            # The pivots are data points: k + 1 of them hold k others for sure.
            bound = np.partition(distances, k, axis=1)[:, k] if pivots.shape[0] > k else np.full(len(batch), np.inf)
            yield batch.assign(cell=cell.astype("int32"), reach=distances[np.arange(len(batch)), cell], bound=bound)

    return reps.mapInPandas(
        run, f"rep {id_type}, v array<double>, ids array<{id_type}>, cell int, reach double, bound double"
    )


def _split(cells: np.ndarray, pivots: np.ndarray, sizes: np.ndarray, rows: int) -> list[np.ndarray]:
    """Cells put together up to about ``rows`` rows, those around near pivots first."""
    if len(cells) <= 1 or sizes[cells].sum() <= rows:
        return [cells]
    here = pivots[cells]
    cells = cells[np.argsort(here[:, np.ptp(here, axis=0).argmax()], kind="stable")]
    reached = np.cumsum(sizes[cells])
    middle = int(np.clip(np.searchsorted(reached, reached[-1] / 2), 1, len(cells) - 1))
    return [*_split(cells[:middle], pivots, sizes, rows), *_split(cells[middle:], pivots, sizes, rows)]


@dataclass(frozen=True)
class Loads:
    """Cells in the order of their loads and of the chunks inside these, and where chunks and loads begin.

    A load travels to a task as a whole and a chunk is searched as a whole, so a query goes once to each load,
    with one bit for every chunk in it that holds a cell it must look into.
    """

    order: np.ndarray
    chunks: np.ndarray
    loads: np.ndarray

    @classmethod
    def of(cls, pivots: np.ndarray, sizes: np.ndarray, rows: int, chunk_rows: int) -> Loads:
        parts = [_split(load, pivots, sizes, min(rows, chunk_rows)) for load in _split(np.arange(len(pivots)), pivots, sizes, rows)]
        lengths = [len(chunk) for load in parts for chunk in load]
        return cls(
            np.concatenate([chunk for load in parts for chunk in load]),
            np.concatenate([[0], np.cumsum(lengths)[:-1]]).astype(int),
            np.concatenate([[0], np.cumsum([len(load) for load in parts])]).astype(int),
        )

    def places(self, spark: SparkSession) -> DataFrame:
        """``(cell, load, chunk, wanted)``: the chunk counts from its load's first, and ``wanted`` has its bit alone."""
        chunk = np.searchsorted(self.chunks, np.arange(len(self.order)), side="right") - 1
        load = np.searchsorted(self.loads, chunk, side="right") - 1
        rows = []
        for cell, c, at in zip(self.order.tolist(), (chunk - self.loads[load]).tolist(), load.tolist(), strict=True):
            bits = np.arange(self.loads[at + 1] - self.loads[at]) == c
            rows.append((cell, at, c, bytearray(np.packbits(bits).tobytes())))
        return spark.createDataFrame(rows, "cell int, load int, chunk int, wanted binary")

    def sent(self, wanted: np.ndarray) -> tuple[list, list]:
        """For each row of cells wanted its loads and, for each of them, the bits of the chunks."""
        bits = np.logical_or.reduceat(wanted[:, self.order], self.chunks, axis=1)
        loads: list = [[] for _ in range(len(bits))]
        chunks: list = [[] for _ in range(len(bits))]
        for at in range(len(self.loads) - 1):
            mine = bits[:, self.loads[at] : self.loads[at + 1]]
            packed = np.packbits(mine, axis=1)
            for row in np.nonzero(mine.any(1))[0]:
                loads[row].append(at)
                chunks[row].append(packed[row].tobytes())
        return loads, chunks

    def own(self, wanted: np.ndarray, cell: np.ndarray) -> None:
        """Leave out the whole chunk of each row's own cell, which is searched first."""
        place = np.empty(len(self.order), int)
        place[self.order] = np.searchsorted(self.chunks, np.arange(len(self.order)), side="right") - 1
        wanted &= place[None, :] != place[cell][:, None]


def _visits(
    queries: DataFrame, pivots: np.ndarray, radius: np.ndarray, loads: Loads, scale: float, id_type: str
) -> DataFrame:
    """The loads that can still hold a neighbour of each query, one row per query, with the chunks to look into.

    A cell is skipped only if every vector in it must be farther than the bound
    already reached: by the triangle inequality around its pivot, and by the
    plane half way between its pivot and the query's own.
    """
    between = _pivot_distances(pivots, pivots)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in slices(batches, len(pivots)):
            distances = _pivot_distances(matrix(batch["v"]), pivots)
            own = batch["cell"].to_numpy()
            nearest = distances[np.arange(len(batch)), own][:, None]
            ball = distances - radius[None, :]
            with np.errstate(divide="ignore", invalid="ignore"):
                plane = (distances**2 - nearest**2) / (2.0 * between[own])
            lower = np.fmax(ball, np.nan_to_num(plane, nan=0.0, posinf=0.0, neginf=0.0))
            wanted = lower <= batch["bound"].to_numpy()[:, None] + SLACK * scale
            wanted &= radius[None, :] >= 0
            loads.own(wanted, own)
            some = wanted.any(1)
            chosen = batch[some]
            if chosen.empty:
                continue
            where, chunks = loads.sent(wanted[some])
            yield pd.DataFrame(
                {
                    "rep": chosen["rep"].to_numpy(),
                    "v": chosen["v"].to_numpy(),
                    "bound": chosen["bound"].to_numpy(),
                    "load": where,
                    "wanted": chunks,
                }
            )

    return queries.select("rep", "v", "cell", "bound").mapInPandas(
        run, f"rep {id_type}, v array<double>, bound double, load array<int>, wanted array<binary>"
    )


def _closest(who: np.ndarray, place: np.ndarray, far: np.ndarray, sizes: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each query's pairs, in order, those needed for k ids: row i stands for ``sizes[i]`` ids, and equally far rows stay."""
    order = np.lexsort((far, who))
    who, place, far = who[order], place[order], far[order]
    count = sizes[place]
    before = np.cumsum(count) - count
    first = np.searchsorted(who, who)
    inside = before - before[first] < k
    # The last row inside sets how far the others may be.
    ends = np.flatnonzero(inside & np.append(~inside[1:] | (who[1:] != who[:-1]), True))
    cutoff = far[ends][np.searchsorted(who[ends], who)]
    keep = inside | (far <= cutoff)
    return who[keep], place[keep], far[keep]


def _near_pairs(queries: pd.DataFrame, data: pd.DataFrame, k: int, scale: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(query, row, distance)`` of all that can be among the k nearest; ``data`` is in order of chunks.

    Products say which pairs can be near enough, and these alone are measured by differences.
    """
    left, right = matrix(queries["v"]), matrix(data["v"])
    products = Products(left, right)
    farthest = queries["bound"].to_numpy() + SLACK * scale
    limit = farthest**2 * (1 + 1e-12) + products.error
    # Rows of the same id are no neighbours; ids can repeat.
    named = [side[["rep"]].assign(at=np.arange(len(side))) for side in (queries, data)]
    same = named[0].merge(named[1], on="rep").sort_values("at_y")
    if same["rep"].dtype == float:
        same = same.dropna()
    asked, itself = same["at_x"].to_numpy(), same["at_y"].to_numpy()
    chunk = data["chunk"].to_numpy()
    bits = [np.unpackbits(np.frombuffer(w, np.uint8)) for w in queries["wanted"]]
    bits = np.vstack(bits).astype(bool)
    sizes = data["ids"].map(len).to_numpy()
    found, held, most = [], 0, KEPT_PAIRS
    starts = np.unique(chunk, return_index=True)
    for number, low, high in zip(*starts, [*starts[1][1:], len(chunk)], strict=True):
        asking = np.nonzero(bits[:, number])[0]
        for first in range(low, high, PRODUCT_COLUMNS * 2):
            last = min(high, first + PRODUCT_COLUMNS * 2)
            step = max(1, PRODUCT_DOUBLES // (last - first))
            here = slice(*np.searchsorted(itself, [first, last]))
            for start in range(0, len(asking), step):
                rows = asking[start : start + step]
                squared = products.tile(rows, slice(first, last))
                at = np.minimum(np.searchsorted(rows, asked[here]), len(rows) - 1)
                mine = rows[at] == asked[here]
                squared[at[mine], itself[here][mine] - first] = np.inf
                hit = squared <= limit[rows, None]
                if last - first > k and hit.sum() > 2 * k * len(rows):
                    kth = np.partition(squared, k - 1, axis=1)[:, k - 1]
                    limit[rows] = np.minimum(limit[rows], np.maximum(kth, 0.0) + 2.0 * products.error[rows])
                    hit = squared <= limit[rows, None]
                i, j = np.nonzero(hit & np.isfinite(squared) if mine.any() else hit)
                if len(i):
                    far = np.sqrt(gap_lengths(left[rows[i]], right[first + j]))
                    use = far <= farthest[rows[i]]
                    found.append((rows[i][use], first + j[use], far[use]))
                    held += int(use.sum())
                if held > most:
                    # What k nearer ids have overtaken goes, so the pairs held follow the queries and not the pairs met.
                    found = [_closest(*(np.concatenate(part) for part in zip(*found, strict=True)), sizes, k)]
                    held = len(found[0][0])
                    most = max(KEPT_PAIRS, 2 * held)
    if not found:
        return np.empty(0, int), np.empty(0, int), np.empty(0)
    return _closest(*(np.concatenate(part) for part in zip(*found, strict=True)), sizes, k)


def _nearest_kernel(k: int, scale: float):
    """The k nearest ids of each query inside one load, nothing beyond its bound."""

    def run(queries: pd.DataFrame, data: pd.DataFrame) -> pd.DataFrame:
        none = pd.DataFrame({"rep": [], "neighbor": [], "distance": []})
        if not len(queries) or not len(data):
            return none
        data = data.sort_values("chunk", kind="stable", ignore_index=True)
        who, place, far = _near_pairs(queries, data, k, scale)
        if not len(who):
            return none
        sizes = data["ids"].map(len).to_numpy()
        first = np.cumsum(sizes) - sizes
        members = np.concatenate(data["ids"].to_numpy())
        counts = sizes[place]
        places = np.repeat(first[place] - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())
        who, far, ids = np.repeat(who, counts), np.repeat(far, counts), members[places]
        if ids.dtype == object:
            ids = ids.astype(str)
        order = np.lexsort((ids, far, who))
        who, ids, far = who[order], ids[order], far[order]
        keep = np.arange(len(who)) - np.searchsorted(who, who) < k
        return pd.DataFrame({"rep": queries["rep"].to_numpy()[who[keep]], "neighbor": ids[keep], "distance": far[keep]})

    return run


def _euclidean_lists(reps: DataFrame, total: int, k: int, id_type: str, cell_rows: int) -> DataFrame:
    """``(rep, near)``: the k nearest ``struct(distance, id)`` among the other distinct vectors."""
    schema = f"rep {id_type}, neighbor {id_type}, distance double"
    wanted = int(min(MAX_PIVOTS, max(1, total // cell_rows)))
    picked = reps.orderBy(F.xxhash64("rep"), "rep").limit(wanted).select("v").collect()
    pivots = np.array([row["v"] for row in picked], dtype="float64")
    assigned = settle(_assign(reps, pivots, k, id_type))
    radius, sizes = np.full(len(pivots), -1.0), np.zeros(len(pivots))
    for row in assigned.groupBy("cell").agg(F.max("reach").alias("r"), F.count(F.lit(1)).alias("n")).collect():
        radius[row["cell"]], sizes[row["cell"]] = row["r"], row["n"]
    scale = float(np.abs(pivots).max(initial=0.0) * np.sqrt(pivots.shape[1]) + radius.max(initial=0.0))
    kernel = _nearest_kernel(k, scale)
    rows = travel_rows(total, pivots.shape[1])
    loads = Loads.of(pivots, sizes, rows, CELL_ROWS)
    # One row per pivot.
    placed = assigned.join(F.broadcast(loads.places(reps.sparkSession)), "cell").drop("cell").withColumnRenamed("load", "cell")
    data = placed.select("rep", "v", "ids", "cell", "chunk")
    closest = Window.partitionBy("rep").orderBy("distance", "neighbor")

    def cut(found: DataFrame) -> DataFrame:
        return found.withColumn("_n", F.row_number().over(closest)).where(F.col("_n") <= k).drop("_n")

    near = cut(block_join(placed.select("rep", "v", "bound", "wanted", "cell"), data, "rep", "rep", kernel, schema, rows))
    if len(loads.chunks) > 1:
        near = settle(near)
        tighter = near.groupBy("rep").agg(F.max("distance").alias("_far"), F.count(F.lit(1)).alias("_n"))
        narrowed = assigned.join(tighter, "rep", "left").withColumn(
            "bound", F.when(F.col("_n") >= k, F.least("bound", "_far")).otherwise(F.col("bound"))
        )
        visits = settle(_visits(narrowed, pivots, radius, loads, scale, id_type))
        visits = visits.select("rep", "v", "bound", F.explode(F.arrays_zip("load", "wanted")).alias("_at"))
        visits = visits.select("rep", "v", "bound", F.col("_at.load").alias("cell"), F.col("_at.wanted").alias("wanted"))
        near = cut(near.unionByName(block_join(visits, data, "rep", "rep", kernel, schema, rows)))
    return near.groupBy("rep").agg(
        F.sort_array(F.collect_list(F.struct("distance", F.col("neighbor").alias("id")))).alias("near")
    )


def nearest_neighbors(
    points: DataFrame,
    k: int,
    metric: str = "euclidean",
    id_col: str = "doc_id",
    vector_col: str = "features",
    cell_rows: int | None = None,
    lists: Callable[[DataFrame, int, int, str], DataFrame] | None = None,
) -> DataFrame:
    """``(id, neighbor_id, distance, neighbor_rank)``: the k nearest other rows, ties by id.

    Exact for ``euclidean`` and ``cosine``.  Copies of a vector are worked on
    once; the distinct vectors are split into cells around pivots taken from
    the data, so dense regions get more cells; each vector first searches its
    own cell and then only the cells that its distance bound cannot rule out.
    Cells travel in large loads, so a vector is sent once to each load and not
    to each cell.  A zero vector has cosine distance 1 to everything.  ``cell_rows`` sets the
    aimed cell size, ``CELL_ROWS`` if not given.  ``lists`` replaces the search
    among the distinct vectors, given these, their number, k and the id's type.
    """
    if metric not in ("euclidean", "cosine"):
        raise ValueError(f"Unsupported metric '{metric}'; use euclidean or cosine.")
    id_type = points.schema[id_col].dataType.simpleString()
    base = points.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    zeros = None
    if metric == "cosine":
        length = F.sqrt(F.aggregate("v", F.lit(0.0), lambda acc, x: acc + x * x))
        scaled = base.withColumn("_len", length).withColumn(
            "v", F.transform("v", lambda x: x / F.when(F.col("_len") > 0, F.col("_len")).otherwise(F.lit(1.0)))
        )
        scaled = settle(scaled)
        zeros = scaled.where("_len = 0").select("id")
        base = scaled.where("_len > 0").select("id", "v")
    else:
        base = settle(base)
    zero_ids = [row["id"] for row in zeros.orderBy("id").limit(k + 1).collect()] if zeros is not None else []
    base_rows = base.count()
    total_rows = base_rows + (zeros.count() if zero_ids else 0)
    if total_rows <= k:
        raise ValueError(f"{k} neighbours need more than {k} rows, found {total_rows}.")
    reps = settle(_copies(base, k))
    distinct = reps.count()
    groups = reps.select("rep", "v", "ids")
    if distinct:
        if lists is None:
            near = _euclidean_lists(groups, distinct, k, id_type, cell_rows or CELL_ROWS)
        else:
            near = lists(groups, distinct, k, id_type)
        groups = groups.join(near, "rep", "left")
    else:
        groups = groups.withColumn("near", F.lit(None).cast(f"array<struct<distance:double,id:{id_type}>>"))
    if distinct == base_rows:
        joined = groups.withColumn("id", F.col("rep"))
    else:
        # A group of copies has one row on this side, so adaptive execution may
        # split the many rows of a large group on the other side.
        joined = base.join(groups, "v")
    own = F.transform(
        F.filter("ids", lambda other: other != F.col("id")),
        lambda other: F.struct(F.lit(0.0).alias("distance"), other.alias("id")),
    )
    none = F.expr(f"cast(array() as array<struct<distance:double,id:{id_type}>>)")
    merged = F.concat(own, F.coalesce("near", none))
    if metric == "cosine":
        # For unit vectors the squared distance is twice the cosine distance.
        merged = F.transform(
            merged, lambda e: F.struct((e["distance"] * e["distance"] / 2.0).alias("distance"), e["id"].alias("id"))
        )
        if zero_ids:
            merged = F.concat(
                merged,
                F.array(*[F.struct(F.lit(1.0).alias("distance"), F.lit(i).cast(id_type).alias("id")) for i in zero_ids]),
            )
    result = joined.select("id", F.slice(F.sort_array(merged), 1, k).alias("best"))
    if zero_ids:
        result = result.unionByName(_zero_rows(zeros, base, zero_ids, k, id_type))
    return result.select(F.col("id").alias(id_col), F.posexplode_outer("best").alias("_place", "_entry")).select(
        id_col,
        F.col("_entry.id").alias("neighbor_id"),
        F.col("_entry.distance").alias("distance"),
        (F.col("_place") + 1).cast("int").alias("neighbor_rank"),
    )


def _zero_rows(zeros: DataFrame, others: DataFrame, zero_ids: list, k: int, id_type: str) -> DataFrame:
    """Zero vectors are at distance 1 from every row, so the smallest ids win."""
    first = sorted({*zero_ids, *[row["id"] for row in others.orderBy("id").limit(k + 1).collect()]})[: k + 1]
    every = F.array(*[F.struct(F.lit(1.0).alias("distance"), F.lit(i).cast(id_type).alias("id")) for i in first])
    best = F.slice(F.filter(every, lambda e: e["id"] != F.col("id")), 1, k)
    return zeros.select("id", best.alias("best"))


#: ``nearest_neighbors``, or an approximate search with the same first arguments and result.
Search = Callable[[DataFrame, int, str, str, str], DataFrame]


def knn_scores(
    points: DataFrame, k: int = 5, id_col: str = "doc_id", vector_col: str = "features", search: Search = nearest_neighbors
) -> DataFrame:
    """``(id, score)``: minus the mean cosine distance to the k nearest others that ``search`` finds."""
    near = search(points, k, "cosine", id_col, vector_col)
    return near.groupBy(id_col).agg((-F.avg("distance")).alias("score"))


def lof_scores(
    points: DataFrame, k: int = 20, id_col: str = "doc_id", vector_col: str = "features", search: Search = nearest_neighbors
) -> DataFrame:
    """``(id, score)``: negative local outlier factor over Euclidean neighbours.

    ``k`` is lowered to one less than the number of rows when there are fewer.
    """
    k = max(1, min(k, points.count() - 1))
    near = settle(search(points, k, "euclidean", id_col, vector_col))
    reach = near.groupBy(id_col).agg(F.max("distance").alias("k_distance"))
    density = (
        near.join(reach.withColumnRenamed(id_col, "neighbor_id"), "neighbor_id")
        .groupBy(id_col)
        .agg((1.0 / (F.avg(F.greatest("k_distance", "distance")) + 1e-10)).alias("density"))
    )
    around = (
        near.join(density.withColumnRenamed(id_col, "neighbor_id"), "neighbor_id")
        .groupBy(id_col)
        .agg(F.avg("density").alias("around"))
    )
    return around.join(density, id_col).select(id_col, (-F.col("around") / F.col("density")).alias("score"))


def affinity_graph(
    points: DataFrame, k: int = 6, id_col: str = "doc_id", vector_col: str = "features", search: Search = nearest_neighbors
) -> DataFrame:
    """``(src, dst, weight)``: the k-neighbour graph averaged with its reverse, both directions.

    As in the usual connectivity graph with the point itself counted, each row
    has itself and its ``k - 1`` nearest others as neighbours.
    """
    ids = points.select(F.col(id_col).alias("src"), F.col(id_col).alias("dst"))
    edges = (
        search(points, k - 1, "euclidean", id_col, vector_col)
        .select(F.col(id_col).alias("src"), F.col("neighbor_id").alias("dst"))
        .unionByName(ids)
    )
    both = edges.unionByName(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
    return both.groupBy("src", "dst").agg((F.count(F.lit(1)) * 0.5).alias("weight"))
