"""Terms, vocabulary, bag-of-words and TF-IDF in long form ``(id, term, ...)``."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from docsieve.functions import patterns as P
from docsieve.functions.lists import char_wb_ngrams, count_items, word_ngrams
from docsieve.operators.grams import PackedCounts, packed_counts, term_totals, unit_rows
from docsieve.session import broadcast_if_small, settle, stored

# Model names and their aliases.
MODELS = ("tfidf", "bow", "tfidf_lsa_dense")
MODEL_ALIASES = {"tfidf_svd_dense": "tfidf_lsa_dense"}


def model_name(name: str) -> str:
    """Resolve an alias; unknown names raise ``ValueError``."""
    resolved = MODEL_ALIASES.get(name, name)
    if resolved not in MODELS:
        raise ValueError(f"Unsupported model '{name}'; use one of {', '.join((*MODELS, *MODEL_ALIASES))}.")
    return resolved


@dataclass(frozen=True)
class VectorizerSettings:
    """How texts become terms and which terms are kept.

    ``min_df`` and ``max_df`` are document counts when they are ints and shares
    of all documents when they are floats, so ``max_df=1.0`` keeps everything.
    """

    model: str = "tfidf"
    max_features: int | None = 15000
    min_df: int | float = 1
    max_df: int | float = 0.95
    ngram_range: tuple[int, int] = (1, 2)
    analyzer: str = "word"
    dense_dimension: int = 256
    seed: int = 42

    def __post_init__(self) -> None:
        object.__setattr__(self, "model", model_name(self.model))
        if self.analyzer not in ("word", "char_wb"):
            raise ValueError(f"Unsupported analyzer '{self.analyzer}'; use word or char_wb.")


def terms(text: Column, settings: VectorizerSettings) -> Column:
    """The list of terms of one text; word terms have two letters or more."""
    low, high = settings.ngram_range
    if settings.analyzer == "char_wb":
        return char_wb_ngrams(words_of(text, settings), low, high)
    return word_ngrams(words_of(text, settings), low, high)


def words_of(text: Column, settings: VectorizerSettings) -> Column:
    """The words of one text that terms are made of; none for a missing text."""
    run = P.NON_SPACE_RUN if settings.analyzer == "char_wb" else P.VECTOR_TOKEN
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(run), F.lit(0))


def term_counts(
    docs: DataFrame, settings: VectorizerSettings, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``(id, term, tf)``, counted inside each document's own row without a shuffle.

    The outer form of ``inline`` keeps the optimiser from putting a filter on
    the size of the list below the scan, which would count every text twice.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    counted = docs.select(id_col, count_items(terms(text, settings)).alias("_counts"))
    rows = counted.select(id_col, F.inline_outer("_counts")).where(F.col("term").isNotNull())
    return rows.select(id_col, "term", F.col("tf").cast("bigint").alias("tf"))


def vocabulary(counts: DataFrame, document_count: int, settings: VectorizerSettings) -> DataFrame:
    """``(term, term_id, df, total_tf)``: the kept terms, numbered alphabetically.

    Document frequency bounds come first, then the ``max_features`` terms with
    the highest total count (ties by term).
    """
    totals = counts.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("total_tf"))
    return _kept_terms(totals, document_count, settings)


def text_vocabulary(
    docs: DataFrame, document_count: int, settings: VectorizerSettings, text_col: str = "text"
) -> DataFrame:
    """``vocabulary`` of whole texts; their counts are added up in batches, so only totals are shuffled."""
    totals = term_totals(docs, words_of(F.col(text_col), settings), *settings.ngram_range, settings.analyzer)
    return _kept_terms(totals, document_count, settings)


def _kept_terms(totals: DataFrame, document_count: int, settings: VectorizerSettings) -> DataFrame:
    low, high = (
        bound if isinstance(bound, int) else bound * document_count for bound in (settings.min_df, settings.max_df)
    )
    kept = totals.where((F.col("df") >= F.lit(float(low))) & (F.col("df") <= F.lit(float(high))))
    if settings.max_features is None:
        from docsieve.operators.ranking import global_rank

        return global_rank(kept, ["term"], "_place").select(
            "term", (F.col("_place") - 1).alias("term_id"), "df", "total_tf"
        )
    # At most max_features rows pass the top-k, so one task can number them.
    top = kept.orderBy(F.desc("total_tf"), F.asc("term")).limit(settings.max_features)
    return top.select(
        "term", (F.row_number().over(Window.orderBy("term")) - 1).cast("bigint").alias("term_id"), "df", "total_tf"
    )


def with_vocabulary(counts: DataFrame, vocab: DataFrame, settings: VectorizerSettings) -> DataFrame:
    """Keep the vocabulary's terms.

    A vocabulary of few bytes is broadcast, which leaves the large count table
    where it is; a larger one is joined by shuffle and adaptive execution splits
    the frequent terms.
    """
    return counts.join(broadcast_if_small(vocab, 96 + F.length("term")), "term")


def bag_of_words(counts: DataFrame, vocab: DataFrame, settings: VectorizerSettings, id_col: str = "doc_id") -> DataFrame:
    """``(id, term, term_id, tf)``."""
    return with_vocabulary(counts, vocab, settings).select(id_col, "term", "term_id", "tf")


def idf(df: Column, document_count: int) -> Column:
    """Smoothed inverse document frequency."""
    return F.log(F.lit(1.0 + document_count) / (F.lit(1.0) + df)) + F.lit(1.0)


def fit_idf(vocab: DataFrame, document_count: int) -> DataFrame:
    """The fitted model as a table: ``(term, term_id, df, total_tf, idf)``."""
    return vocab.withColumn("idf", idf(F.col("df"), document_count))


def tfidf(counts: DataFrame, fitted: DataFrame, settings: VectorizerSettings, id_col: str = "doc_id") -> DataFrame:
    """``(id, term, term_id, tf, weight)`` with sublinear counts and unit row length.

    The window shuffles by document once; later per-document groupings reuse
    that partitioning.
    """
    raw = with_vocabulary(counts, fitted, settings).withColumn(
        "_raw", (F.lit(1.0) + F.log(F.col("tf"))) * F.col("idf")
    )
    length = F.sqrt(F.sum(F.col("_raw") * F.col("_raw")).over(Window.partitionBy(id_col)))
    return raw.select(id_col, "term", "term_id", "tf", (F.col("_raw") / length).alias("weight"))


@dataclass
class FittedVectorizer:
    """A vocabulary with document frequencies, kept as a table."""

    settings: VectorizerSettings
    document_count: int
    fitted: DataFrame
    projection: object | None = field(default=None)

    def transform(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
        """Weights of new texts against the fitted vocabulary."""
        counts = term_counts(docs, self.settings, id_col, text_col)
        if self.settings.model == "bow":
            return bag_of_words(counts, self.fitted, self.settings, id_col)
        weights = tfidf(counts, self.fitted, self.settings, id_col)
        if self.settings.model == "tfidf":
            return weights
        from docsieve.operators.lsa import project

        return project(weights, self.projection, id_col, docs)

    def feature_names(self) -> DataFrame:
        """The vocabulary in id order; empty for the dense model."""
        names = self.fitted.select("term_id", "term")
        return names.limit(0) if self.settings.model == "tfidf_lsa_dense" else names.orderBy("term_id")

    def save(self, path: str) -> None:
        self.fitted.withColumn("document_count", F.lit(self.document_count)).write.mode("overwrite").parquet(path)


def fit_packed(
    docs: DataFrame, settings: VectorizerSettings, id_col: str = "doc_id", text_col: str = "text"
) -> tuple[DataFrame, PackedCounts]:
    """The fitted terms and the counts of all texts, a row of few bytes for each document, written once.

    ``settings.max_features`` bounds the terms, which every task holds.
    """
    total = docs.count()
    fitted = settle(fit_idf(text_vocabulary(docs, total, settings, text_col), total))
    rows = fitted.select("term", "idf").orderBy("term_id").collect()
    terms, factors = [row["term"] for row in rows], np.array([row["idf"] for row in rows], dtype="float64")
    words = words_of(F.col(text_col), settings)
    packed = packed_counts(docs, words, *settings.ngram_range, settings.analyzer, terms, factors, id_col)
    return fitted, PackedCounts(stored(packed.table), factors)


def _fit(
    docs: DataFrame, counts: DataFrame, settings: VectorizerSettings, id_col: str, text_col: str
) -> tuple[FittedVectorizer, DataFrame]:
    total = docs.count()
    fitted = settle(fit_idf(text_vocabulary(docs, total, settings, text_col), total))
    model = FittedVectorizer(settings, total, fitted)
    if settings.model == "bow":
        return model, bag_of_words(counts, fitted, settings, id_col)
    weights = tfidf(counts, fitted, settings, id_col)
    if settings.model == "tfidf_lsa_dense":
        from docsieve.operators.lsa import fit_projection

        weights = settle(weights)
        model.projection = fit_projection(weights, settings.dense_dimension, settings.seed, id_col)
    return model, weights


def fit(docs: DataFrame, settings: VectorizerSettings, id_col: str = "doc_id", text_col: str = "text") -> FittedVectorizer:
    """Fit the vocabulary; the dense model also fits its projection."""
    return _fit(docs, term_counts(docs, settings, id_col, text_col), settings, id_col, text_col)[0]


def fit_transform(
    docs: DataFrame, settings: VectorizerSettings, id_col: str = "doc_id", text_col: str = "text"
) -> tuple[FittedVectorizer, DataFrame]:
    """Fit and transform the same texts.

    The terms are counted in each pass: a second reading of the texts costs less
    than writing all their counts, most of which the vocabulary leaves out.
    """
    counts = term_counts(docs, settings, id_col, text_col)
    model, table = _fit(docs, counts, settings, id_col, text_col)
    if settings.model == "tfidf_lsa_dense":
        from docsieve.operators.lsa import project

        table = project(table, model.projection, id_col, docs)
    return model, table


def term_popularity(counts: DataFrame) -> DataFrame:
    """``(term, total_tf, term_rank)``: most frequent first, ties by term."""
    from docsieve.operators.ranking import global_rank

    totals = counts.groupBy("term").agg(F.sum("tf").alias("total_tf"))
    return global_rank(totals, [F.desc("total_tf"), F.asc("term")], "term_rank")


def bow_preview(
    docs: DataFrame, counts: DataFrame, vocab: DataFrame, top_terms: int = 20, rows: int = 12, id_col: str = "doc_id"
) -> DataFrame:
    """Counts of the most frequent terms in the first documents, one row per term."""
    ranked = vocab.orderBy(F.desc("total_tf"), F.asc("term")).limit(top_terms).select("term", "total_tf")
    first = docs.select(id_col).orderBy(id_col).limit(rows)
    grid = first.join(F.broadcast(counts.join(F.broadcast(first), id_col, "left_semi")), id_col, "left")
    names = [row["term"] for row in ranked.orderBy(F.desc("total_tf"), "term").collect()]
    return grid.groupBy(id_col).agg(
        *[F.coalesce(F.sum(F.when(F.col("term") == name, F.col("tf"))), F.lit(0)).alias(name) for name in names]
    )


def sparse_vectors(weights: DataFrame, width: int, id_col: str = "doc_id", docs: DataFrame | None = None) -> DataFrame:
    """``(id, features)`` as MLlib sparse vectors; documents without terms are zero vectors.

    The vectors' stored form is put together in SQL, written once and read back
    as vectors, so that no Python runs for each row.
    """
    entry = F.sort_array(F.collect_list(F.struct("term_id", "weight")))
    packed = weights.groupBy(id_col).agg(entry.alias("_entries"))
    if docs is not None:
        packed = docs.select(id_col).join(packed, id_col, "left")
    entries = F.coalesce("_entries", F.lit(None).cast(T.ArrayType(T.StructType([
        T.StructField("term_id", T.LongType()), T.StructField("weight", T.DoubleType())
    ]))))
    ids = F.coalesce(F.transform(entries, lambda e: e["term_id"].cast("int")), F.expr("cast(array() as array<int>)"))
    values = F.coalesce(F.transform(entries, lambda e: e["weight"]), F.expr("cast(array() as array<double>)"))
    return _stored_vectors(packed.select(id_col, ids.alias("ids"), values.alias("values")), width, id_col)


def _stored_vectors(lists: DataFrame, width: int, id_col: str) -> DataFrame:
    # Fixed value: 0 marks a sparse vector.
    kind = F.lit(0).cast("tinyint").alias("type")
    vector = F.struct(kind, F.lit(width).cast("int").alias("size"), F.col("ids").alias("indices"), "values")
    from pyspark.ml.linalg import VectorUDT

    schema = T.StructType([lists.schema[id_col], T.StructField("features", VectorUDT())])
    return stored(lists.select(id_col, vector.alias("features")), schema)


#: Bytes of packed counts that one task turns into vectors, about, and rows of them at a time.
VECTOR_BYTES, VECTOR_ROWS = 16 << 20, 1024


def packed_vectors(counts: PackedCounts, width: int, id_col: str = "doc_id") -> DataFrame:
    """``sparse_vectors`` of packed counts, a row for each of theirs; rows of one id have one vector, those without an id a zero one.

    Of a term that several rows of one id have the largest weight counts, as a vector has a place once.
    """
    table, idf = counts.table, counts.idf
    id_type = table.schema[id_col].dataType.simpleString()

    def lists(rows: pa.Table) -> pa.Table:
        named = [rows.filter(rows.column(id_col).is_valid()).column(name).combine_chunks() for name in (id_col, "n", "data")]
        ids, values, firsts = [], [], []
        for places, lengths, terms, weights in unit_rows(*named, idf, VECTOR_ROWS):
            owner = np.repeat(np.arange(len(lengths)), lengths)
            last = np.append((terms[1:] != terms[:-1]) | (owner[1:] != owner[:-1]), True)[: len(terms)]
            terms, weights, lengths = terms[last], weights[last], np.bincount(owner[last], minlength=len(lengths))
            ends = pa.array(np.concatenate([[0], np.cumsum(lengths)]), pa.int32())
            ids.append(pa.ListArray.from_arrays(ends, pa.array(terms, pa.int32())))
            values.append(pa.ListArray.from_arrays(ends, pa.array(weights, pa.float64())))
            firsts.append(named[0].take(pa.array(places)))
        if not firsts:
            return pa.table({id_col: rows.column(id_col).slice(0, 0), "ids": pa.array([], pa.list_(pa.int32())), "values": pa.array([], pa.list_(pa.float64()))})
        known = pa.concat_arrays(firsts)
        at = pc.index_in(named[0], value_set=known)
        return pa.table([known.take(at), pa.concat_arrays(ids).take(at), pa.concat_arrays(values).take(at)], [id_col, "ids", "values"])

    size = table.agg(F.sum(F.length("data"))).first()[0] or 0
    parts = max(2 * table.sparkSession.sparkContext.defaultParallelism, -(-size // VECTOR_BYTES))
    dealt = table.groupBy(F.pmod(F.xxhash64(id_col), F.lit(parts)))
    made = dealt.applyInArrow(lists, f"`{id_col}` {id_type}, ids array<int>, values array<double>")
    bare = [F.expr(f"cast(array() as array<{kind}>)").alias(name) for name, kind in (("ids", "int"), ("values", "double"))]
    return _stored_vectors(made.unionAll(table.where(F.col(id_col).isNull()).select(id_col, *bare)), width, id_col)


def concat_blocks(*blocks: DataFrame, id_col: str = "doc_id", vector_col: str = "features") -> DataFrame:
    """Join dense blocks by id and put their vectors end to end."""
    joined = blocks[0].withColumnRenamed(vector_col, "_block0")
    for place, block in enumerate(blocks[1:], start=1):
        joined = joined.join(block.withColumnRenamed(vector_col, f"_block{place}"), id_col)
    return joined.select(id_col, F.concat(*[f"_block{i}" for i in range(len(blocks))]).alias(vector_col))


def last_columns(vectors: DataFrame, width: int, vector_col: str = "features") -> DataFrame:
    """Keep the last ``width`` entries of a dense vector column."""
    return vectors.withColumn(vector_col, F.slice(vector_col, F.size(vector_col) - width + 1, width))
