"""Joining query rows to the cells they must look into, in pieces of bounded size."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Rows of one side that one task holds at a time.
BLOCK_ROWS = 4096
# Doubles in one distance tile (32 MB).
TILE_DOUBLES = 4_000_000
# Bytes of the vectors of one side that travel to a task together, and the least number of such loads of a table.
TRAVEL_BYTES, LOADS = 16 << 20, 16
# Doubles of a table of products that stays close to its core, and columns of it.
PRODUCT_DOUBLES, PRODUCT_COLUMNS = 131_072, 512
# Squared distances under this share of the squared lengths are taken from differences instead of products.
CLOSE = 1e-5
# Share of the rows from which on a sparse term is multiplied as a dense column.
OFTEN = 0.06


def travel_rows(total: int, width: float) -> int:
    """Rows of one side that travel together: rows are sent once for every load of the other side, so loads are large."""
    return int(min(max(1, TRAVEL_BYTES // (8 * max(1.0, width))), max(BLOCK_ROWS // 8, -(-total // LOADS))))


def block_join(
    queries: DataFrame,
    data: DataFrame,
    query_key: str,
    data_key: str,
    kernel: Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame],
    schema: str,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Run ``kernel`` on every pair of a data piece and a query piece with the same ``cell``.

    Each cell is cut by a hash of the row key into pieces of about
    ``block_rows`` rows on either side, so a cell that holds most of the rows
    becomes many small tasks instead of one large one.  The number of cells is
    bounded by the caller; only their counts reach the driver.
    """
    sides = data.select("cell", F.lit(1).alias("_d"), F.lit(0).alias("_q")).unionAll(
        queries.select("cell", F.lit(0).alias("_d"), F.lit(1).alias("_q"))
    )
    counts = sides.groupBy("cell").agg(F.sum("_d").alias("_d"), F.sum("_q").alias("_q")).where("_d > 0 and _q > 0")
    rows = [
        (row["cell"], -(-row["_d"] // block_rows), -(-row["_q"] // block_rows)) for row in counts.collect()
    ]
    if not rows:
        return data.sparkSession.createDataFrame([], schema)
    # One row per cell, and the caller bounds the cells.
    plan = F.broadcast(data.sparkSession.createDataFrame(rows, "cell int, _pieces int, _slices int"))
    keys = ["cell", "_piece", "_slice"]
    # Aliases give the data side its own column ids when both sides are one table.
    data_side = (
        data.select(*[F.col(name).alias(name) for name in data.columns])
        .join(plan, "cell")
        .withColumn("_piece", F.pmod(F.xxhash64(data_key), F.col("_pieces")).cast("int"))
        .withColumn("_slice", F.explode(F.sequence(F.lit(0), F.col("_slices") - 1)))
        .drop("_pieces", "_slices")
    )
    query_side = (
        queries.join(plan, "cell")
        .withColumn("_slice", F.pmod(F.xxhash64(query_key), F.col("_slices")).cast("int"))
        .withColumn("_piece", F.explode(F.sequence(F.lit(0), F.col("_pieces") - 1)))
        .drop("_pieces", "_slices")
    )

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        return kernel(left, right)

    return query_side.groupBy(*keys).cogroup(data_side.groupBy(*keys)).applyInPandas(run, schema)


def slices(batches: Iterator[pd.DataFrame], width: int) -> Iterator[pd.DataFrame]:
    """Cut batches so that rows times ``width`` doubles stay within one tile."""
    step = max(1, TILE_DOUBLES // max(1, width))
    for batch in batches:
        for start in range(0, len(batch), step):
            yield batch.iloc[start : start + step]


def matrix(column: pd.Series) -> np.ndarray:
    """A column of equal-length lists as a 2-d array."""
    return np.vstack(column.to_numpy()) if len(column) else np.empty((0, 0))


def distance_tiles(left: np.ndarray, right: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Yield ``(start, distances)`` for slices of ``left`` rows against all of ``right``.

    Distances come from differences, not from a product expansion, so nearly
    equal vectors lose no digits.
    """
    step = max(1, TILE_DOUBLES // max(1, right.shape[0] * right.shape[1]))
    for start in range(0, left.shape[0], step):
        gap = left[start : start + step, None, :] - right[None, :, :]
        yield start, np.sqrt(np.einsum("ijk,ijk->ij", gap, gap))


def gap_lengths(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The squared distances of rows pairwise, by differences."""
    found = np.empty(len(left))
    step = max(1, TILE_DOUBLES // max(1, left.shape[1]))
    for start in range(0, len(left), step):
        gap = left[start : start + step] - right[start : start + step]
        found[start : start + step] = np.einsum("ij,ij->i", gap, gap)
    return found


class Products:
    """Squared distances between two sets of rows by matrix products, which are many times faster than differences.

    One product gives ``|x|^2 - 2 x y + |y|^2``; vectors are taken from the mean of the right ones, so that
    their lengths say how many digits are lost.  ``error`` bounds what a left row's distances can be off.
    """

    def __init__(self, left: np.ndarray, right: np.ndarray) -> None:
        middle = right.mean(0)
        a, b = left - middle, right - middle
        self.squares = np.einsum("ij,ij->i", a, a)
        lengths = np.einsum("ij,ij->i", b, b)
        ones = np.ones((max(len(a), len(b)), 1))
        self.left = np.hstack([-2.0 * a, self.squares[:, None], ones[: len(a)]])
        self.right = np.hstack([b, ones[: len(b)], lengths[:, None]])
        self.error = 4.0 * np.finfo(float).eps * (left.shape[1] + 8) * (self.squares + lengths.max(initial=0.0))

    def tile(self, rows: np.ndarray | slice, columns: slice) -> np.ndarray:
        return self.left[rows] @ self.right[columns].T


def distance_sums(left: np.ndarray, right: np.ndarray, member: np.ndarray, columns: int = PRODUCT_COLUMNS) -> np.ndarray:
    """The distances between two sets of rows times ``member``, a column for each group of right rows; ``columns`` right rows at a time."""
    products = Products(left, right)
    sums = np.zeros((len(left), member.shape[1]))
    step = max(1, PRODUCT_DOUBLES // min(columns, len(right)))
    least = (CLOSE * products.squares + products.error)[:, None]
    for low in range(0, len(right), columns):
        part = slice(low, low + columns)
        for start in range(0, len(left), step):
            rows = slice(start, start + step)
            squared = products.tile(rows, part)
            close = squared < least[rows]
            if close.any():
                i, j = np.nonzero(close)
                squared[i, j] = gap_lengths(left[start + i], right[low + j])
            sums[rows] += np.sqrt(squared, out=squared) @ member[part]
    return sums


class SparseProducts:
    """Squared distances between two sets of sparse rows.

    Terms of many rows are laid out densely and multiplied; a rare term adds only to the pairs that share it.
    """

    def __init__(self, left: pd.DataFrame, right: pd.DataFrame) -> None:
        sides = [self._entries(left), self._entries(right)]
        terms, found = np.unique(np.concatenate([side[1] for side in sides]), return_inverse=True)
        found = np.split(found, [len(sides[0][1])])
        shares = [np.bincount(at, minlength=len(terms)) / rows for at, rows in zip(found, (len(left), len(right)), strict=True)]
        often = shares[0] * shares[1] > OFTEN**2
        column = np.cumsum(often) - 1
        self.dense, self.rare, self.squares = [], [], []
        for (owner, _, values), at, rows in zip(sides, found, (len(left), len(right)), strict=True):
            use = often[at]
            table = np.zeros((rows, int(often.sum())))
            table[owner[use], column[at[use]]] = values[use]
            self.dense.append(table)
            self.rare.append((owner[~use], at[~use], values[~use]))
            self.squares.append(np.bincount(owner, values**2, minlength=rows))

    @staticmethod
    def _entries(rows: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        owner = np.repeat(np.arange(len(rows)), rows["ids"].map(len).to_numpy())
        return owner, np.concatenate(rows["ids"].to_numpy()).astype(np.int64), np.concatenate(rows["v"].to_numpy())

    def _shared(self, rows: slice, columns: slice, shape: tuple[int, int]) -> np.ndarray:
        """The products of rare terms, for some rows of either side."""
        total = np.zeros(shape[0] * shape[1])
        parts = []
        for (owner, at, values), part in zip(self.rare, (rows, columns), strict=True):
            low, high = np.searchsorted(owner, [part.start, part.stop])
            parts.append((owner[low:high] - part.start, at[low:high], values[low:high]))
        (left, left_at, left_values), (right, right_at, right_values) = parts
        order = np.argsort(right_at, kind="stable")
        right, right_at, right_values = right[order], right_at[order], right_values[order]
        first = np.searchsorted(right_at, left_at)
        counts = np.searchsorted(right_at, left_at, side="right") - first
        ends = np.cumsum(counts)
        start = 0
        while start < len(counts):
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + TILE_DOUBLES // 4, side="right")))
            n = counts[start:stop]
            place = np.repeat(first[start:stop] - np.cumsum(n) + n, n) + np.arange(n.sum())
            pair = np.repeat(left[start:stop], n) * shape[1] + right[place]
            total += np.bincount(pair, np.repeat(left_values[start:stop], n) * right_values[place], minlength=len(total))
            start = stop
        return total.reshape(shape)

    def tile(self, rows: slice, columns: slice) -> np.ndarray:
        inner = self.dense[0][rows] @ self.dense[1][columns].T
        inner += self._shared(rows, columns, inner.shape)
        return np.maximum(self.squares[0][rows, None] + self.squares[1][columns] - 2.0 * inner, 0.0)


def sparse_distance_sums(left: pd.DataFrame, right: pd.DataFrame, member: np.ndarray, rows: int, name: str | None = None) -> np.ndarray:
    """As ``distance_sums``, for rows ``(ids, v)``, ``rows`` of either side at a time; rows of one ``name`` are at distance 0."""
    products = SparseProducts(left, right)
    sums = np.zeros((len(left), member.shape[1]))
    both = pd.factorize(pd.concat([left[name], right[name]]))[0] if name else np.arange(len(left) + len(right))
    names, others = both[: len(left)], both[len(left) :]
    for low in range(0, len(right), rows):
        columns = slice(low, min(len(right), low + rows))
        for start in range(0, len(left), rows):
            part = slice(start, min(len(left), start + rows))
            squared = products.tile(part, columns)
            squared[names[part, None] == others[columns]] = 0.0
            sums[part] += np.sqrt(squared, out=squared) @ member[columns]
    return sums
