"""The structural feature table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docsieve.functions.lists import count_items
from docsieve.functions.patterns import STRUCTURAL_FEATURES
from docsieve.functions.structural import compression_ratio, structural_columns, word_tokens

NATIVE_FEATURES = tuple(name for name in STRUCTURAL_FEATURES if name != "compression_ratio")


def structural_features(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", features: Sequence[str] = STRUCTURAL_FEATURES
) -> DataFrame:
    """``id_col`` plus the named measures, one row per document, without a shuffle."""
    unknown = set(features) - set(STRUCTURAL_FEATURES)
    if unknown:
        raise ValueError(f"Unknown structural features: {sorted(unknown)}")
    text = F.coalesce(F.col(text_col), F.lit(""))
    staged = docs.select(id_col, text.alias("_text"))
    if "compression_ratio" in features:
        # Before the term lists are made, so only ids and texts pass the Python step.
        staged = staged.withColumn("_gzip", compression_ratio(F.col("_text")))
    staged = staged.withColumn("_tokens", word_tokens(F.col("_text")))
    staged = staged.withColumn("_counts", count_items(F.col("_tokens")))
    native = structural_columns(F.col("_text"), F.col("_tokens"), F.col("_counts"))
    native["compression_ratio"] = F.col("_gzip")
    return staged.select(id_col, *[native[name].alias(name) for name in features])


def feature_vector(df: DataFrame, features: Sequence[str], out_col: str = "features") -> DataFrame:
    """Append the named columns as one ``array<double>``."""
    return df.withColumn(out_col, F.array(*[F.col(name).cast("double") for name in features]))
