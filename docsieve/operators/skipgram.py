"""Word vectors by skip-grams, trained in pieces of the table and averaged by word."""

from __future__ import annotations

from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docsieve.session import stored

#: Bytes of text that one task trains on.
PIECE_BYTES = 16 << 20
#: Words to either side at most, words of a sentence at most, and the first rate of the steps.
WINDOW, SENTENCE, RATE = 5, 1000, 0.025
#: Other words drawn against each pair; positions that one step works through, and the draws they share.
NEGATIVES, STEP, DRAWS = 5, 128, 32


def _first_vectors(words: list[str], dimension: int, seed: int) -> np.ndarray:
    """Small vectors that follow from the word and the seed alone, so all pieces start from the same ones."""
    hashes = np.array([int.from_bytes(blake2b(w.encode(), digest_size=8, salt=seed.to_bytes(8, "little")).digest(), "little") for w in words], np.uint64)
    x = hashes[:, None] + np.arange(1, dimension + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    x ^= x >> np.uint64(31)
    return ((x >> np.uint64(11)) / 2.0**53 - 0.5).astype(np.float32) / np.float32(dimension)


def _train(tokens: np.ndarray, sentences: np.ndarray, vectors: np.ndarray, seed: list[int]) -> None:
    """One pass of skip-grams with negative draws over the word numbers ``tokens``; ``vectors`` change in place.

    A step takes all pairs of ``STEP`` positions as one matrix.  The steps of a word are cut where its many pairs in the
    matrix would make it overshoot, by a bound of their curvature.
    """
    draw = np.random.default_rng(seed)
    outer = np.zeros_like(vectors)
    shares = np.cumsum(np.bincount(tokens, minlength=len(vectors)) ** 0.75)
    windows = draw.integers(1, WINDOW + 1, len(tokens))
    for start in range(0, len(tokens), STEP):
        low, high = max(0, start - WINDOW), min(len(tokens), start + STEP + WINDOW)
        # Rows are the words that read, columns the middle words of this step and the draws.
        read, middle = tokens[low:high], tokens[start : start + STEP]
        far = np.abs(np.arange(low, high)[:, None] - np.arange(start, start + len(middle)))
        met = (far > 0) & (far <= windows[start : start + STEP]) & (sentences[low:high, None] == sentences[start : start + STEP])
        drawn = np.searchsorted(shares, draw.random(DRAWS) * shares[-1], side="right").clip(max=len(vectors) - 1)
        pairs = np.zeros((len(read), len(middle) + DRAWS), np.float32)
        pairs[:, : len(middle)] = met
        weights = pairs.copy()
        weights[:, len(middle) :] = met.sum(1, keepdims=True) * np.float32(NEGATIVES / DRAWS)
        written = np.concatenate([middle, drawn])
        left, right = vectors[read], outer[written]
        slope = pairs - weights / (1 + np.exp(-np.clip(left @ right.T, -30, 30)))
        rate = np.float32(RATE * max(1e-4, 1 - start / len(tokens)))
        bends = weights @ (right**2).sum(1) / 4, weights.T @ (left**2).sum(1) / 4
        for table, rows, change, bend in ((vectors, read, slope @ right, bends[0]), (outer, written, slope.T @ left, bends[1])):
            order = np.argsort(rows, kind="stable")
            names, first = np.unique(rows[order], return_index=True)
            step = rate / np.maximum(1, 2 * rate * np.add.reduceat(bend[order], first))
            table[names] += step[:, None] * np.add.reduceat(change[order], first, axis=0)


def _split(text: str) -> list[str]:
    return [word for word in text.split(" ") if word]


def word_vector_means(docs: DataFrame, dimension: int, seed: int, id_col: str, text_col: str, piece_bytes: int = PIECE_BYTES) -> DataFrame:
    """``(id, features)``: the sum of the vectors of a text's words over the number of its words, single words counting as zero.

    Vectors are trained on the words that the table holds twice or more.  Texts go to pieces of about ``piece_bytes``;
    a piece trains the words it holds from first vectors that all pieces share, and a word's vector is the mean of those
    of its pieces.  No task holds more than a piece and its words, and the driver holds none.
    """
    id_type = docs.schema[id_col].dataType.simpleString()
    words = stored(docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("words")))
    size = words.agg(F.sum(F.octet_length("words"))).first()[0] or 0
    pieces = max(1, -(-int(size) // piece_bytes))
    dealt = words.withColumn("piece", F.pmod(F.xxhash64("id", "words"), F.lit(pieces)).cast("int"))
    each = dealt.select("piece", F.explode(F.split("words", " ")).alias("word")).where("word <> ''")
    # A word that comes once lies in one piece.
    single = each.groupBy("word").agg(F.count("*").alias("n"), F.min("piece").alias("piece")).where("n = 1").select("piece", "word")

    def train(texts: pa.Table, single: pa.Table) -> pa.Table:
        once = set(single["word"].to_pylist())
        numbers: dict[str, int] = {}
        tokens, sentences, count = [], [], 0
        # The order follows from the texts, so that a run repeats the last.
        for text in sorted(texts["words"].to_pylist(), key=lambda t: blake2b(t.encode(), digest_size=8).digest()):
            found = np.array([numbers.setdefault(w, len(numbers)) for w in _split(text) if w not in once], np.int32)
            tokens.append(found)
            sentences.append(count + np.arange(len(found)) // SENTENCE)
            count += -(-len(found) // SENTENCE)
        names = list(numbers)
        vectors = _first_vectors(names, dimension, seed) if names else np.zeros((0, dimension), np.float32)
        where = texts["piece"][0].as_py()
        if names:
            _train(np.concatenate(tokens), np.concatenate(sentences), vectors, [seed, where])
        return pa.table({"piece": pa.array([where] * len(names), pa.int32()), "word": pa.array(names, pa.string()), "v": pa.array([v.tobytes() for v in vectors], pa.binary())})

    def average(rows: pa.Table) -> pa.Table:
        parts = np.frombuffer(b"".join(rows["v"].to_pylist()), np.float32).reshape(len(rows), dimension)
        word = rows["word"].combine_chunks().dictionary_encode().indices.to_numpy()
        order = np.lexsort([rows["piece"].to_numpy(), word])
        _, first, size = np.unique(word[order], return_index=True, return_counts=True)
        mean = (np.add.reduceat(parts[order].astype(np.float64), first, axis=0) / size[:, None]).astype(np.float32)
        return rows.set_column(rows.column_names.index("v"), "v", pa.array([mean[at].tobytes() for at in word], pa.binary())).select(["piece", "word", "v"])

    def means(texts: pa.Table, known: pa.Table) -> pa.Table:
        numbers = {word: at for at, word in enumerate(known["word"].to_pylist())}
        vectors = np.frombuffer(b"".join(known["v"].to_pylist()), np.float32).reshape(-1, dimension)
        features = np.zeros((len(texts), dimension))
        for row, text in enumerate(texts["words"].to_pylist()):
            found = _split(text)
            at = [numbers[w] for w in found if w in numbers]
            if at:
                features[row] = vectors[at].sum(0, dtype=np.float64) / len(found)
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(texts) + 1, dtype=np.int32) * dimension), pa.array(features.ravel()))
        return pa.table({"id": texts["id"], "features": lists})

    entry = "piece int, word string, v binary"
    trained = dealt.groupBy("piece").cogroup(single.groupBy("piece")).applyInArrow(train, entry)
    # Buckets hold about as many words as a piece.
    known = trained.groupBy(F.pmod(F.xxhash64("word"), F.lit(pieces)).alias("_bucket")).applyInArrow(average, entry)
    found = dealt.groupBy("piece").cogroup(known.groupBy("piece")).applyInArrow(means, f"id {id_type}, features array<double>")
    return found.withColumnRenamed("id", id_col)
