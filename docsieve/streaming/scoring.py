"""Scoring a stream of new documents with what was fitted on a batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from docsieve.functions.patterns import STRUCTURAL_FEATURES
from docsieve.operators.forest import Forest, forest_scores
from docsieve.operators.normalize import text_views
from docsieve.operators.structural import feature_vector, structural_features
from docsieve.operators.vectorize import FittedVectorizer


def stream_views(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Both text views of arriving documents; stateless."""
    return text_views(docs, text_col)


def stream_scores(docs: DataFrame, forest: Forest, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, score)`` of arriving documents against a fitted forest; stateless."""
    points = feature_vector(structural_features(docs, id_col, text_col), STRUCTURAL_FEATURES)
    return forest_scores(points, forest, id_col)


def stream_weights(
    docs: DataFrame,
    model: FittedVectorizer,
    write: Callable[[DataFrame, int], None],
    checkpoint: str,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> StreamingQuery:
    """Weights of arriving documents against a fitted vocabulary, one micro-batch at a time.

    The row length needs all terms of a document, so each micro-batch is scored
    as a batch; ``write`` gets the weights and the batch number and should
    replace that batch's output when it is retried.
    """

    def score(batch: DataFrame, number: int) -> None:
        write(model.transform(batch, id_col, text_col), number)

    return docs.writeStream.option("checkpointLocation", checkpoint).foreachBatch(score).start()
