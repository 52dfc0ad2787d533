"""Tall matrices in blocks of rows, their QR by a reduction tree, and leading eigenvectors by block Lanczos.

A tall matrix is a table ``(block, data)``: block number and the bytes of its
rows as doubles.  Only matrices of columns by columns reach the driver.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docsieve.session import stored

#: Rows of a block, and partial results that one task adds up.
BLOCK = 1024
FAN_IN = 32
TALL = "block int, data binary"


@dataclass(frozen=True)
class Tall:
    """A table of blocks, its columns and its rows."""

    table: DataFrame
    width: int
    rows: int

    @property
    def blocks(self) -> int:
        return -(-self.rows // BLOCK)

    def mapped(self, function: Callable[[np.ndarray], np.ndarray], width: int) -> Tall:
        """``function`` of the rows of each block, with ``width`` columns."""
        before = self.width

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                data = [np.ascontiguousarray(function(np.frombuffer(d).reshape(-1, before))).tobytes() for d in batch["data"]]
                yield pd.DataFrame({"block": batch["block"], "data": data})

        return Tall(self.table.mapInPandas(run, TALL), width, self.rows)

    def stored(self) -> Tall:
        return Tall(stored(self.table), self.width, self.rows)

    def beside(self, other: DataFrame, width: int) -> Tall:
        """The columns of this matrix and of the blocks ``other``."""
        before = self.width

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                pairs = zip(batch["data"], batch["other"], strict=True)
                data = [np.hstack([np.frombuffer(a).reshape(-1, before), np.frombuffer(b).reshape(-1, width)]).tobytes() for a, b in pairs]
                yield pd.DataFrame({"block": batch["block"], "data": data})

        joined = self.table.join(other.select("block", F.col("data").alias("other")), "block")
        return Tall(joined.mapInPandas(run, TALL), before + width, self.rows)

    def reduced(self, part: Callable[[np.ndarray], np.ndarray], join: Callable[[list[np.ndarray]], np.ndarray], width: int) -> np.ndarray:
        """``part`` of every block, joined ``FAN_IN`` at a time until one matrix of ``width`` columns is left."""
        before = self.width

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                data = [np.ascontiguousarray(part(np.frombuffer(d).reshape(-1, before))).tobytes() for d in batch["data"]]
                yield pd.DataFrame({"block": batch["block"], "data": data})

        def together(rows: pd.DataFrame) -> pd.DataFrame:
            rows = rows.sort_values("block")
            joined = join([np.frombuffer(d).reshape(-1, width) for d in rows["data"]])
            return pd.DataFrame({"block": [int(rows["block"].iloc[0]) // FAN_IN], "data": [np.ascontiguousarray(joined).tobytes()]})

        pieces, left = self.table.mapInPandas(run, TALL), self.blocks
        while True:
            pieces = pieces.groupBy(F.floor(F.col("block") / FAN_IN).alias("_group")).applyInPandas(together, TALL)
            if left <= FAN_IN:
                break
            left = -(-left // FAN_IN)
        (row,) = pieces.collect()
        return np.frombuffer(row["data"]).reshape(-1, width).copy()

    def summed(self, part: Callable[[np.ndarray], np.ndarray], width: int) -> np.ndarray:
        """The sum of ``part`` over all blocks."""
        return self.reduced(part, lambda pieces: np.sum(pieces, axis=0), width)

    def triangle(self, part: Callable[[np.ndarray], np.ndarray], width: int) -> np.ndarray:
        """``R`` of the QR of ``part`` of the rows: blocks are reduced to triangles, and stacked triangles to one."""
        return self.reduced(
            lambda rows: np.linalg.qr(part(rows), mode="r"), lambda pieces: np.linalg.qr(np.vstack(pieces), mode="r"), width
        )


@dataclass(frozen=True)
class Held:
    """A tall matrix that one task holds, with the same steps as ``Tall``."""

    data: np.ndarray

    @property
    def width(self) -> int:
        return self.data.shape[1]

    def mapped(self, function: Callable[[np.ndarray], np.ndarray], width: int) -> Held:
        return Held(np.ascontiguousarray(function(self.data)))

    def stored(self) -> Held:
        return self

    def beside(self, other: np.ndarray, width: int) -> Held:
        return Held(np.hstack([self.data, other]))

    def summed(self, part: Callable[[np.ndarray], np.ndarray], width: int) -> np.ndarray:
        return part(self.data)

    def triangle(self, part: Callable[[np.ndarray], np.ndarray], width: int) -> np.ndarray:
        return np.linalg.qr(part(self.data), mode="r")


def random_held(rows: int, width: int, seed: int, size: int = BLOCK) -> Held:
    """The matrix of ``random_tall`` in one piece, drawn by blocks of ``size`` rows."""
    starts = range(0, rows, size)
    return Held(np.vstack([np.random.default_rng([seed, at // size]).standard_normal((min(size, rows - at), width)) for at in starts]))


def random_tall(spark: SparkSession, rows: int, width: int, seed: int) -> Tall:
    """A matrix of normal draws that depend on the seed and the block alone."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            data = [
                np.random.default_rng([seed, block]).standard_normal((min(BLOCK, rows - block * BLOCK), width)).tobytes()
                for block in batch["block"]
            ]
            yield pd.DataFrame({"block": batch["block"], "data": data})

    blocks = spark.range(-(-rows // BLOCK)).select(F.col("id").cast("int").alias("block"))
    return Tall(blocks.mapInPandas(run, TALL), width, rows)


def _divisor(upper: np.ndarray, scale: float) -> tuple[np.ndarray, np.ndarray]:
    """``(D, L)``: A D has orthonormal columns and A = (A D) L, for A with the triangle ``upper``.

    Directions below rounding, measured against ``scale`` or the largest, are left out.
    """
    _, values, turned = np.linalg.svd(upper, full_matrices=False)
    keep = values > 1e-12 * max(scale, values.max(initial=0.0)) if values.max(initial=0.0) > 0 else np.zeros(len(values), bool)
    return turned[keep].T / values[keep], values[keep, None] * turned[keep]


@dataclass(frozen=True)
class Leading:
    """Eigenvalues from the largest down, their vectors, and the residuals relative to the largest value."""

    values: np.ndarray
    vectors: Tall | Held
    residuals: np.ndarray


#: Steps before a new start.
DEPTH = 8


def leading_eigenvectors(
    operator: Callable[[Tall], DataFrame] | Callable[[Held], np.ndarray], start: Tall | Held, wanted: int, tolerance: float = 1e-6, depth: int = DEPTH, restarts: int = 8
) -> Leading:
    """The ``wanted`` largest eigenvalues of a symmetric operator on tall matrices, and their vectors.

    Block Lanczos with full reorthogonalisation: every step applies the operator to the newest columns of the basis and
    makes what comes out orthogonal to all of it, twice, by triangles from a reduction tree.  The residual of a Ritz
    vector follows from its part in the newest columns and the triangle that leads out of the basis.  It stops when
    all wanted residuals are under ``tolerance`` times the largest value, or when the basis closes; after ``depth``
    steps it starts again from the Ritz vectors.  ``residuals`` says how far it came.
    """
    for _ in range(2):
        divide, _ = _divisor(start.triangle(lambda rows: rows, start.width), 0.0)
        start = start.mapped(lambda rows, by=divide: rows @ by, divide.shape[1]).stored()
    largest = 0.0
    for attempt in range(restarts):
        basis, width, small = start, start.width, np.zeros((0, 0))
        for step in range(depth):
            columns = basis.width
            newest = basis.mapped(lambda rows, at=columns - width: rows[:, at:], width)
            wide = basis.beside(operator(newest), width).stored()
            inner = wide.summed(lambda rows, c=columns: rows[:, :c].T @ rows[:, c:], width)
            grown = np.zeros((columns, columns))
            grown[: small.shape[0], : small.shape[0]] = small
            grown[:, columns - width :] = inner
            grown[columns - width :, :] = inner.T
            small = (grown + grown.T) / 2
            values, vectors = np.linalg.eigh(small)
            values, vectors = values[::-1], vectors[:, ::-1]
            largest = max(largest, float(np.abs(values).max()))

            def rest(rows: np.ndarray, c: int = columns, by: np.ndarray = inner) -> np.ndarray:
                return rows[:, c:] - rows[:, :c] @ by

            divide, lead = _divisor(wide.triangle(rest, width), largest)
            residuals = np.linalg.norm(lead @ vectors[columns - width :], axis=0)
            settled = columns >= wanted and (residuals[:wanted] <= tolerance * max(largest, 1e-300)).all()
            added = len(lead)
            if settled or not added or step == depth - 1:
                break

            def first(rows: np.ndarray, by: np.ndarray = divide, rest: Callable = rest) -> np.ndarray:
                return rest(rows) @ by

            again = wide.summed(lambda rows, c=columns, f=first: rows[:, :c].T @ f(rows), added)

            def second(rows: np.ndarray, c: int = columns, by: np.ndarray = again, first: Callable = first) -> np.ndarray:
                return first(rows) - rows[:, :c] @ by

            divide, _ = _divisor(wide.triangle(second, added), 0.0)
            added = divide.shape[1]
            # Not written again: what the last table holds makes the new columns wherever the basis is read.
            basis = wide.mapped(lambda rows, c=columns, f=second, by=divide: np.hstack([rows[:, :c], f(rows) @ by]), columns + added)
            width = added
        last = settled or not added or attempt == restarts - 1
        keep = min(columns, wanted if last else start.width)
        ritz = basis.mapped(lambda rows, by=np.ascontiguousarray(vectors[:, :keep]): rows @ by, keep).stored()
        if last:
            break
        start = ritz
    return Leading(values[:keep].copy(), ritz, residuals[:keep] / max(largest, 1e-300))


def start_width(wanted: int, spare: int = 10) -> int:
    """Columns of a starting block: a few more than wanted."""
    return wanted + spare
