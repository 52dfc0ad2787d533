"""Latent semantic projection: a distributed truncated SVD of the TF-IDF table."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docsieve.operators.grams import PackedCounts, unit_rows
from docsieve.operators.tall import BLOCK, FAN_IN, Tall, leading_eigenvectors, random_tall, start_width
from docsieve.session import settle, shuffle_width

#: Relative residual at which the singular vectors count as settled; the error of the values goes with its square.
TOLERANCE = 5e-3
# Documents laid out at a time as a dense matrix over the terms they use, and documents of one part at most, about.
DENSE_ROWS, PART_ROWS = 64, 50_000
#: Bytes of the packed counts of one part, about; the matrix goes once to each part, so parts are several times as large as it.
PART_BYTES, LEAST_PART_BYTES, MATRIX_TIMES = 192 << 20, 32 << 20, 3


@dataclass(frozen=True)
class Projection:
    """Right singular vectors as a tall matrix of terms by dimensions, singular values and relative residuals."""

    vectors: Tall
    singular_values: np.ndarray
    residuals: np.ndarray

    @property
    def dimension(self) -> int:
        return len(self.singular_values)

    def matrix(self) -> np.ndarray:
        """The vectors on the driver, for a look at small ones."""
        rows = self.vectors.table.orderBy("block").collect()
        return np.vstack([np.frombuffer(r["data"]).reshape(-1, self.dimension) for r in rows])


def pack_rows(weights: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``(id, ids, values)``: the non-zero entries of each document in term order.

    A document has at most as many entries as the vocabulary has terms.
    """
    entries = F.sort_array(F.collect_list(F.struct("term_id", "weight")))
    return (
        weights.groupBy(id_col)
        .agg(entries.alias("_entries"))
        .select(
            id_col,
            F.transform("_entries", lambda e: e["term_id"]).alias("ids"),
            F.transform("_entries", lambda e: e["weight"]).alias("values"),
        )
    )


Blocks = Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]


def _laid_out(rows: int, lengths: np.ndarray, ids: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    used = np.zeros(int(ids.max(initial=-1)) + 1, bool)
    used[ids] = True
    terms = np.flatnonzero(used)
    dense = np.zeros((rows, len(terms)))
    dense[np.repeat(np.arange(rows), lengths), (np.cumsum(used) - 1)[ids]] = values
    return terms, dense


def _dense_blocks(rows: pa.Table, id_col: str, idf: np.ndarray | None) -> Blocks:
    """``(places, terms, matrix)`` of a few documents at a time; documents without terms are zero rows.

    Packed counts are weighed here, and an id that several rows have is one document at the first of them.
    """
    if idf is not None:
        columns = [rows.column(name).combine_chunks() for name in (id_col, "n", "data")]
        for places, lengths, terms, weights in unit_rows(*columns, idf, DENSE_ROWS):
            yield places, *_laid_out(len(places), lengths, terms, weights)
        return
    at = 0
    for batch in rows.to_batches():
        for start in range(0, batch.num_rows, DENSE_ROWS):
            part = batch.slice(start, DENSE_ROWS)
            ids, values = part.column("ids"), part.column("values")
            lengths = pc.fill_null(pc.list_value_length(ids), 0).to_numpy(zero_copy_only=False)
            flat = ids.flatten().to_numpy(zero_copy_only=False), values.flatten().to_numpy(zero_copy_only=False)
            yield np.arange(at, at + part.num_rows), *_laid_out(part.num_rows, lengths, *flat)
            at += part.num_rows


def _with_matrix(parted: DataFrame, parts: int, matrix: Tall, work: Callable[[pa.Table, np.ndarray], pa.Table], schema: str) -> DataFrame:
    """``work`` on every part of the rows and the whole matrix, whose blocks are sent once to each part.

    A matrix has a row per vocabulary term, which is capped, so a task's share is bounded.
    """
    every, width = F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"), matrix.width

    def run(rows: pa.Table, blocks: pa.Table) -> pa.Table:
        order = np.argsort(blocks.column("block").to_numpy())
        data = blocks.column("data").to_pylist()
        return work(rows, np.vstack([np.frombuffer(data[at]).reshape(-1, width) for at in order]))

    sent = matrix.table.select(every, "block", "data").repartition(parts, "part")
    return parted.groupBy("part").cogroup(sent.groupBy("part")).applyInArrow(run, schema)


def gram_operator(parted: DataFrame, parts: int, id_col: str = "doc_id", idf: np.ndarray | None = None) -> Callable[[Tall], DataFrame]:
    """``X -> A' A X`` for the packed rows A in parts; X is a tall matrix over the terms, the result its blocks."""
    pieces = "block int, part int, data binary"

    def apply(matrix: Tall) -> DataFrame:
        def multiply(rows: pa.Table, right: np.ndarray) -> pa.Table:
            total = np.zeros_like(right)
            for _, terms, dense in _dense_blocks(rows, id_col, idf):
                total[terms] += dense.T @ (dense @ right[terms])
            part = rows.column("part")[0].as_py() if rows.num_rows else -1
            starts = range(0, len(total), BLOCK) if rows.num_rows else []
            data = [total[at : at + BLOCK].tobytes() for at in starts]
            columns = [pa.array(range(len(data)), pa.int32()), pa.array([part] * len(data), pa.int32()), pa.array(data, pa.binary())]
            return pa.table(columns, ["block", "part", "data"])

        def add(group: pd.DataFrame) -> pd.DataFrame:
            total = sum(np.frombuffer(data) for data in group["data"])
            return pd.DataFrame({"block": group["block"][:1], "part": group["part"][:1] // FAN_IN, "data": [total.tobytes()]})

        found, left = _with_matrix(parted, parts, matrix, multiply, pieces), parts
        while True:
            found = found.groupBy("block", F.floor(F.col("part") / FAN_IN).alias("_group")).applyInPandas(add, pieces)
            if left <= FAN_IN:
                return found.select("block", "data")
            left = -(-left // FAN_IN)

    return apply


def part_bytes(matrix_bytes: int) -> int:
    """Bytes of a part: a task holds it twice beside copies of the matrix, so a small matrix has small parts."""
    return min(PART_BYTES, max(LEAST_PART_BYTES, MATRIX_TIMES * matrix_bytes))


def _parted(packed: DataFrame, id_col: str, rows: int, matrix_bytes: int = PART_BYTES) -> tuple[DataFrame, int]:
    """The packed rows dealt to parts by id, and the number of parts."""
    if "data" in packed.columns:
        size = packed.agg(F.sum(F.length("data") + 16)).first()[0] or 0
        parts = max(1, -(-size // part_bytes(matrix_bytes)), min(2 * packed.sparkSession.sparkContext.defaultParallelism, -(-rows // BLOCK)))
    else:
        parts = max(1, -(-rows // PART_ROWS), min(shuffle_width(packed.sparkSession), -(-rows // BLOCK)))
    part = F.pmod(F.xxhash64(id_col), F.lit(parts)).cast("int")
    return packed.withColumn("part", part).repartition(parts, "part"), parts


def fit_projection(
    weights: DataFrame | PackedCounts, dimension: int, seed: int = 42, id_col: str = "doc_id", terms: int | None = None, tolerance: float = TOLERANCE
) -> Projection:
    """Leading right singular vectors of the (uncentred) weight table.

    Block Lanczos on ``A'A`` from a random block, until the residuals of all wanted vectors are under ``tolerance``
    times the largest eigenvalue.  The basis stays in blocks of terms; the driver sees matrices of dimensions by
    dimensions.  A table of lower rank has fewer dimensions.  The largest loading of each component is made positive.
    """
    if isinstance(weights, PackedCounts):
        packed, idf = weights.table.where("n > 0"), weights.idf
        rows, total = packed.count(), terms or len(idf)
    else:
        packed, idf = settle(pack_rows(weights, id_col)), None
        about = packed.agg(F.max(F.array_max("ids")).alias("top"), F.count(F.lit(1)).alias("n")).first()
        rows, total = about["n"], terms or (0 if about["top"] is None else int(about["top"]) + 1)
    if total == 0:
        raise ValueError("No terms are left to project.")
    kept = min(dimension, max(1, total - 1))
    columns = min(total, start_width(kept))
    parted, parts = _parted(packed, id_col, rows, 8 * total * columns)
    # The rows stay dealt out through all passes; a lost part is dealt again from the settled table.
    parted = parted.select("part", *(c for c in packed.columns if c != "part" and (idf is not None or c != id_col))).persist(StorageLevel.DISK_ONLY)
    try:
        start = random_tall(packed.sparkSession, total, columns, seed)
        found = leading_eigenvectors(gram_operator(parted, parts, id_col, idf), start, kept, tolerance)
    finally:
        parted.unpersist()
    width = found.vectors.width

    def largest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for data in batch["data"]:
                rows = np.frombuffer(data).reshape(-1, width)
                at = np.abs(rows).argmax(0)
                yield pd.DataFrame({"column": np.arange(width), "value": rows[at, np.arange(width)]})

    loadings = found.vectors.table.mapInPandas(largest, "column int, value double")
    top = loadings.groupBy("column").agg(F.max_by("value", F.struct(F.abs("value"), "value")).alias("value")).orderBy("column").collect()
    signs = np.array([-1.0 if r["value"] < 0 else 1.0 for r in top])
    vectors = found.vectors.mapped(lambda rows: rows * signs, width).stored()
    return Projection(vectors, np.sqrt(np.maximum(found.values, 0.0)), found.residuals)


def project(
    weights: DataFrame | PackedCounts, projection: Projection, id_col: str = "doc_id", docs: DataFrame | None = None
) -> DataFrame:
    """``(id, features)``: documents in the projected space; no terms gives a zero vector.

    Packed counts hold a row for every document of their own, so ``docs`` is not looked at.
    """
    if isinstance(weights, PackedCounts):
        packed, idf = weights.table, weights.idf
    else:
        packed, idf = pack_rows(weights, id_col), None
        if docs is not None:
            packed = docs.select(id_col).join(packed, id_col, "left")
        packed = settle(packed)
    width = projection.dimension
    id_type = packed.schema[id_col].dataType.simpleString()

    def work(rows: pa.Table, components: np.ndarray) -> pa.Table:
        vectors = np.zeros((rows.num_rows, width))
        for places, terms, dense in _dense_blocks(rows, id_col, idf):
            # Terms beyond the fitted ones have no loadings.
            known = terms < len(components)
            vectors[places] = dense[:, known] @ components[terms[known]]
        if idf is not None:
            # The rows of one id have one vector, and those without an id none.
            ids = rows.column(id_col).combine_chunks()
            codes = pc.dictionary_encode(ids, null_encoding="encode").indices.to_numpy()
            _, first, code = np.unique(codes, return_index=True, return_inverse=True)
            vectors = vectors[first[code]] if len(first) < len(codes) else vectors
            vectors[pc.is_null(ids).to_numpy(zero_copy_only=False)] = 0.0
        ends = np.arange(rows.num_rows + 1, dtype=np.int32) * width
        lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(vectors.ravel()))
        ids = rows.column(id_col).combine_chunks()
        return pa.table([ids, lists], [id_col, "features"])

    parted, parts = _parted(packed, id_col, packed.count(), 8 * projection.vectors.rows * width)
    return _with_matrix(parted, parts, projection.vectors, work, f"`{id_col}` {id_type}, features array<double>")
