"""Dense document vectors from a user's model."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docsieve.operators.skipgram import word_vector_means

Encoder = Callable[[Sequence[str]], np.ndarray]


def encode_documents(
    docs: DataFrame,
    load_encoder: Callable[[], Encoder],
    batch_size: int = 64,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``(id, features)``: the raw texts through a model that each task loads once.

    ``load_encoder`` returns a function from a list of texts to a 2-d array.
    """
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = None
        for batch in batches:
            encode = encode or load_encoder()
            for start in range(0, len(batch), batch_size):
                part = batch.iloc[start : start + batch_size]
                vectors = np.asarray(encode(part["_text"].tolist()), dtype="float64")
                yield pd.DataFrame({id_col: part[id_col].to_numpy(), "features": list(vectors)})

    texts = docs.select(id_col, F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    return texts.mapInPandas(run, f"`{id_col}` {id_type}, features array<double>")


def word_vector_mean(
    docs: DataFrame, dimension: int = 64, seed: int = 42, id_col: str = "doc_id", text_col: str = "clustering_text"
) -> DataFrame:
    """``(id, features)``: mean of word vectors trained on the table itself, when no model is at hand.

    Training runs in pieces of the table; texts without words have a zero vector.
    """
    return word_vector_means(docs, dimension, seed, id_col, text_col)
