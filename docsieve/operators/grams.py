"""Counting the n-grams of whole texts in Arrow batches, with one number for each distinct word and gram of a batch.

Spark cuts the texts into words, groups the totals and joins the rows; a task sees one Arrow batch at a time.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Occurrences of grams that are sorted at a time; a longer text is taken as a whole.
SORTED_GRAMS = 2_000_000
#: Words that a task counts at a time, a longer text as a whole, and rows that it hands on together: an Arrow batch has up to
#: 10,000 texts of any length, and counting takes many times the bytes of their words.
PIECE_WORDS, PIECE_ROWS = 1 << 18, 1 << 16
CODEC = "zstd"


def _runs(sizes: np.ndarray) -> np.ndarray:
    """``0, 1, ..`` for each size, end to end."""
    ends = np.cumsum(sizes)
    return np.arange(int(ends[-1]) if len(ends) else 0) - np.repeat(ends - sizes, sizes)


def _sorted_counts(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys in order and the sums of their counts."""
    if not len(keys):
        return keys, counts
    bits = int(counts.max()).bit_length()
    if int(keys.max()).bit_length() + bits < 63:
        # Key and count in one number sort several times faster than an order of the keys.
        packed = np.sort((keys << bits) | counts)
        keys, counts = packed >> bits, packed & ((1 << bits) - 1)
    else:
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[starts], np.add.reduceat(counts, starts)


@dataclass
class Grams:
    """Occurrences of numbered items in the texts of a batch, in text order, and the grams each item stands for."""

    texts: int
    owner: np.ndarray
    item: np.ndarray
    times: np.ndarray
    first: np.ndarray
    size: np.ndarray
    grams: np.ndarray
    names: pa.Array

    def known(self, terms: pa.Array) -> Grams:
        """Only the grams of a list, numbered by their places in it."""
        place = pc.fill_null(pc.index_in(self.names, value_set=terms), -1).to_numpy(zero_copy_only=False).astype(np.int64)
        found = place[self.grams]
        use = found >= 0
        before = np.concatenate([[0], np.cumsum(use)])
        first, last = before[self.first], before[self.first + self.size]
        return Grams(self.texts, self.owner, self.item, self.times, first, last - first, found[use], terms)

    def counted(self) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
        """``(from, to, text, gram, count)`` for some texts at a time, in order of text and gram."""
        sizes = self.size[self.item]
        every = np.cumsum(np.bincount(self.owner, sizes, self.texts)) if len(self.owner) else np.zeros(self.texts)
        start, width = 0, max(1, len(self.names))
        while start < self.texts:
            reached = every[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(every, reached + SORTED_GRAMS, side="right")))
            here = slice(*np.searchsorted(self.owner, [start, stop]))
            size, item = sizes[here], self.item[here]
            grams = self.grams[np.repeat(self.first[item], size) + _runs(size)]
            keys, counts = _sorted_counts(np.repeat(self.owner[here] - start, size) * width + grams, np.repeat(self.times[here], size))
            yield start, stop, start + keys // width, keys % width, counts
            start = stop


def _character_grams(words: pa.Array, low: int, high: int) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """``(sizes, grams, names)`` of the padded words, as ``lists.char_wb_ngrams`` makes them."""
    found: list[str] = []
    sizes = np.zeros(len(words), np.int64)
    for at, word in enumerate(words.to_pylist()):
        padded, before = f" {word} ", len(found)
        for n in range(low, high + 1):
            if n == low or n <= len(padded):
                found += [padded[i : i + n] for i in range(max(len(padded) - n, 0) + 1)]
        sizes[at] = len(found) - before
    coded = pa.array(found, pa.large_string()).dictionary_encode()
    return sizes, coded.indices.to_numpy().astype(np.int64), coded.dictionary


def grams_of(words: pa.ListArray, low: int, high: int, analyzer: str) -> Grams:
    """The grams of a batch of texts, given as lists of words."""
    texts = len(words)
    lengths = pc.fill_null(pc.list_value_length(words), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    coded = words.flatten().cast(pa.large_string()).dictionary_encode()
    item, names = coded.indices.to_numpy().astype(np.int64), coded.dictionary
    owner = np.repeat(np.arange(texts), lengths)
    if analyzer == "char_wb":
        keys, times = _sorted_counts(owner * max(1, len(names)) + item, np.ones(len(item), np.int64))
        owner, item = keys // max(1, len(names)), keys % max(1, len(names))
        size, grams, names = _character_grams(names, low, high)
        return Grams(texts, owner, item, times, np.cumsum(size) - size, size, grams, names)
    ends = np.repeat(np.cumsum(lengths), lengths)
    words_of, own, shown, owners, items, total = names, item, names, [], [], 0
    for n in range(1, high + 1):
        if n > 1:
            # A gram is the one before it and one more word of the same text.
            more = np.flatnonzero(np.arange(len(own)) + n <= ends[: len(own)])
            pairs = own[more] * len(words_of) + item[more + n - 1]
            distinct, codes = np.unique(pairs, return_inverse=True)
            own = np.full(len(own), -1, np.int64)
            own[more] = codes
            shown = pc.binary_join_element_wise(
                shown.take(pa.array(distinct // len(words_of))), words_of.take(pa.array(distinct % len(words_of))), pa.scalar(" ", pa.large_string())
            ) if len(distinct) else shown.slice(0, 0)
        if n >= low:
            some = np.flatnonzero(own >= 0)
            owners.append(owner[some])
            items.append((own[some] + total, shown))
            total += len(shown)
    owner, item = np.concatenate(owners), np.concatenate([codes for codes, _ in items])
    order = np.argsort(owner, kind="stable")
    names = pa.concat_arrays([shown for _, shown in items])
    every = np.arange(total)
    return Grams(texts, owner[order], item[order], np.ones(len(item), np.int64), every, np.ones(total, np.int64), every, names)


def _pieces(batch: pa.RecordBatch, column: int) -> Iterator[pa.RecordBatch]:
    """The rows of a batch in pieces of at most ``PIECE_WORDS`` words, by the lists of words in a column; a longer text alone."""
    reached = np.cumsum(pc.fill_null(pc.list_value_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < len(reached):
        before = reached[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(reached, before + PIECE_WORDS, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def term_totals(docs: DataFrame, words: Column, low: int, high: int, analyzer: str) -> DataFrame:
    """``(term, df, total_tf)`` over all texts; a piece of a batch gives one row per distinct term of its texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in (piece for batch in batches for piece in _pieces(batch, 0)):
            found = grams_of(piece.column(0), low, high, analyzer)
            df, total = np.zeros(len(found.names), np.int64), np.zeros(len(found.names), np.int64)
            for _, _, _, gram, counts in found.counted():
                df += np.bincount(gram, minlength=len(df))
                total += np.bincount(gram, counts, len(df)).astype(np.int64)
            columns = [found.names.cast(pa.string()), pa.array(df), pa.array(total)]
            counted = pa.RecordBatch.from_arrays(columns, ["term", "df", "total_tf"])
            for start in range(0, counted.num_rows, PIECE_ROWS):
                yield counted.slice(start, PIECE_ROWS)

    rows = docs.select(words.alias("_words")).mapInArrow(count, "term string, df bigint, total_tf bigint")
    return rows.groupBy("term").agg(F.sum("df").alias("df"), F.sum("total_tf").alias("total_tf"))


@dataclass(frozen=True)
class PackedCounts:
    """``(id, n, data)``, a row per document with its distinct terms and counts in few bytes, and the terms' factors.

    The terms are at most ``max_features``, so their list fits a task.  Without factors ``data`` holds weights as they are.
    """

    table: DataFrame
    idf: np.ndarray | None


def packed_counts(docs: DataFrame, words: Column, low: int, high: int, analyzer: str, terms: list[str], idf: np.ndarray, id_col: str) -> PackedCounts:
    """The counts of the listed terms, term number i being the i-th, without a shuffle."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        listed = pa.array(terms, pa.large_string())
        for piece in (piece for batch in batches for piece in _pieces(batch, 1)):
            numbers, data = [], []
            for start, stop, text, gram, counts in grams_of(piece.column(1), low, high, analyzer).known(listed).counted():
                places = np.searchsorted(text, np.arange(start, stop + 1))
                steps = np.diff(gram, prepend=0)
                heads = places[:-1][places[:-1] < places[1:]]
                steps[heads] = gram[heads]
                steps, counts = steps.astype(np.int32), counts.astype(np.int32)
                for low_at, high_at in zip(places[:-1].tolist(), places[1:].tolist(), strict=True):
                    numbers.append(high_at - low_at)
                    raw = steps[low_at:high_at].tobytes() + counts[low_at:high_at].tobytes()
                    data.append(pa.compress(raw, CODEC, asbytes=True) if raw else b"")
            columns = [piece.column(0), pa.array(numbers, pa.int32()), pa.array(data, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, [id_col, "n", "data"])

    rows = docs.select(id_col, words.alias("_words")).mapInArrow(count, f"`{id_col}` {id_type}, n int, data binary")
    return PackedCounts(rows, idf)


def packed_weights(weights: DataFrame, id_col: str = "doc_id") -> PackedCounts:
    """The rows ``(id, term_id, weight)`` of each id in one row."""
    entries = F.sort_array(F.collect_list(F.struct("term_id", "weight"))).alias("_e")
    lists = weights.groupBy(id_col).agg(entries).select(id_col, "_e.term_id", "_e.weight")
    id_type = weights.schema[id_col].dataType.simpleString()

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)
            data = [np.array(t, np.int64).tobytes() + np.array(w, np.float64).tobytes() for t, w in pairs]
            numbers = pa.array([len(d) // 16 for d in data], pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column(0), numbers, pa.array(data, pa.binary())], [id_col, "n", "data"])

    return PackedCounts(lists.mapInArrow(pack, f"`{id_col}` {id_type}, n int, data binary"), None)


def unpacked(n: int, data: bytes, counts: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """``(term numbers, counts)`` of one document, or its weights instead of the counts."""
    if not counts:
        return np.frombuffer(data, np.int64, n), np.frombuffer(data, np.float64, n, 8 * n)
    if not n:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    raw = np.frombuffer(pa.decompress(data, 8 * n, CODEC, asbytes=True), np.int32)
    return np.cumsum(raw[:n], dtype=np.int64), raw[n:].astype(np.int64)


def unit_rows(ids: pa.Array, numbers: pa.Array, data: pa.Array, idf: np.ndarray | None, rows: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """``(places, lengths, terms, weights)`` for ``rows`` ids at a time: ``places`` are the first rows of the ids.

    Rows of one id, or of none, are one row of unit length with all their entries, of equal terms the largest last.
    """
    codes = pc.dictionary_encode(ids, null_encoding="encode").indices.to_numpy().astype(np.int64)
    order = np.argsort(codes, kind="stable")
    starts = np.flatnonzero(np.diff(codes[order], prepend=-1)) if len(codes) else np.empty(0, np.int64)
    ends = np.append(starts[1:], len(codes))
    for at in range(0, len(starts), rows):
        first, last = starts[at : at + rows], ends[at : at + rows]
        mine = order[first[0] : last[-1]]
        take = pa.array(mine)
        numbers_here = numbers.take(take).to_pylist()
        found = [unpacked(n, d, idf is not None) for n, d in zip(numbers_here, data.take(take).to_pylist(), strict=True)]
        terms, weights = (np.concatenate(part) for part in zip(*found, strict=True))
        owner = np.repeat(np.repeat(np.arange(len(first)), last - first), numbers_here)
        if idf is not None:
            weights = (1.0 + np.log(weights)) * idf[terms]
            weights /= np.sqrt(np.bincount(owner, weights * weights, len(first)))[owner]
        if len(mine) > len(first):
            placed = np.lexsort((weights, terms, owner))
            terms, weights = terms[placed], weights[placed]
        yield order[first], np.bincount(owner, minlength=len(first)), terms, weights
