"""The seventeen structural measures of a raw text."""

from __future__ import annotations

import gzip

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from docsieve.functions import patterns as P
from docsieve.functions.lists import bind, longest_run, word_ngrams


def count_matches(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern))


def word_tokens(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(P.WORD_TOKEN), F.lit(0))


def _ratio(part: Column, whole: Column) -> Column:
    return part.cast("double") / whole


def _repeated(counts: Column, total: Column) -> Column:
    repeats = F.aggregate(
        F.filter(counts, lambda entry: entry["tf"] > 1),
        F.lit(0),
        lambda acc, entry: acc + entry["tf"],
    )
    return F.when(total > 0, _ratio(repeats, total)).otherwise(F.lit(0.0))


def _entropy(counts: Column, total: Column) -> Column:
    epsilon = F.lit(P.ENTROPY_EPSILON)
    spread = F.aggregate(
        counts,
        F.lit(0.0),
        lambda acc, entry: acc - (entry["tf"] / total) * F.log(entry["tf"] / total + epsilon),
    )
    ceiling = F.log(F.size(counts) + epsilon)
    return F.when((total > 0) & (ceiling > 0), spread / ceiling).otherwise(F.lit(0.0))


def _bigram_variety(tokens: Column) -> Column:
    return F.when(
        F.size(tokens) >= 2,
        bind(
            word_ngrams(tokens, 2, 2),
            lambda pairs: F.size(F.array_distinct(pairs)).cast("double") / F.size(pairs),
        ),
    ).otherwise(F.lit(1.0))


@F.pandas_udf(DoubleType())
def compression_ratio(texts: pd.Series) -> pd.Series:
    """Gzip level-6 bytes over UTF-8 bytes; 1.0 for an empty text.

    The only Python step of this group: Spark SQL has no compression function.
    """

    def one(text: str | None) -> float:
        data = (text or "").encode("utf-8")
        return len(gzip.compress(data, compresslevel=6)) / len(data) if data else 1.0

    return texts.map(one).astype("float64")


def structural_columns(text: Column, tokens: Column, counts: Column) -> dict[str, Column]:
    """The sixteen measures that Spark computes itself, keyed by name.

    ``tokens`` are the lowercased word tokens and ``counts`` their
    ``array<struct<term, tf>>``; both should be plain columns so that they are
    computed once.
    """
    characters = F.greatest(F.length(text), F.lit(1))
    token_total = F.size(tokens)
    token_count = F.greatest(token_total, F.lit(1))
    letters = F.aggregate(counts, F.lit(0), lambda acc, entry: acc + F.length(entry["term"]) * entry["tf"])
    return {
        "char_count": characters.cast("double"),
        "token_count": token_count.cast("double"),
        "average_token_length": _ratio(letters, token_count),
        "type_token_ratio": _ratio(F.size(counts), token_count),
        "repeated_token_ratio": _repeated(counts, token_total),
        "max_token_run": longest_run(tokens).cast("double"),
        "lexical_entropy": _entropy(counts, token_total),
        "uppercase_ratio": _ratio(count_matches(text, P.UPPERCASE), characters),
        "digit_ratio": _ratio(count_matches(text, P.DIGIT), characters),
        "punctuation_ratio": _ratio(count_matches(text, P.PUNCTUATION), characters),
        "url_count": count_matches(F.lower(text), P.URL).cast("double"),
        "email_count": count_matches(text, P.EMAIL).cast("double"),
        "html_tag_count": count_matches(text, P.HTML_TAG).cast("double"),
        "mixed_alnum_token_ratio": _ratio(count_matches(text, P.MIXED_TOKEN), token_count),
        "placeholder_token_ratio": _ratio(count_matches(text, P.PLACEHOLDER), token_count),
        "bigram_type_token_ratio": _bigram_variety(tokens),
    }
