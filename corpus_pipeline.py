"""A corpus pipeline: quality rules, line dedup, near-duplicate removal, source mixing, packing.

Every stage takes documents with nulls in any column, empty and very long texts, rows that repeat, an empty table and
further columns of any name, which it hands on; the last returns pieces instead of documents.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docsieve.llm.linededup import drop_repeated_lines
from docsieve.llm.mixing import mix_sources, mixed_documents
from docsieve.llm.packing import pack_sequences
from docsieve.llm.quality import kept_documents
from docsieve.llm.queries import tokenizer_file
from docsieve.llm.simhash import first_of_groups
from docsieve.session import shared_folder, ship_package


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the divergence from their language reject go.

    Null and empty texts fail the base rules.  A null language is held against the nearest one; where no document has a
    language the base rules alone decide.  Rows that repeat are judged alike.
    """
    ship_package(spark)
    return kept_documents(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines go that repeat earlier ones three in a row; a document of which only blanks are left goes.

    Earlier is by id, then by a hash of the text, then by line.  Null, empty and short texts stay as they are; rows equal
    in id and text are one document and lose the same lines.
    """
    ship_package(spark)
    left = drop_repeated_lines(docs, removed_col="__removed")
    emptied = (F.col("__removed") > 0) & (F.length(F.regexp_replace("text", r"[\x20\x09-\x0D]+", "")) == 0)
    count = F.when(F.col("__removed") > 0, F.char_length("text")).otherwise(F.col("n_chars"))
    return left.where(~emptied).withColumn("n_chars", count.cast(docs.schema["n_chars"].dataType)).select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked fingerprints stays.

    It is the one of smallest id, then smallest text hash, null ids last.  Null, empty and blank texts are one group; rows
    equal in id and text leave one.
    """
    ship_package(spark)
    return first_of_groups(docs, words=4, most_bits=4)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The words that the mix takes of each document, a row for each pass over it.

    A null source is a source of its own; texts without words are never taken, and those the mix leaves out go.
    """
    ship_package(spark)
    return mixed_documents(docs, mix_sources(docs))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of at most 4,096 tokens; a text without tokens is its end mark alone."""
    ship_package(spark)
    packed = pack_sequences(docs, tokenizer_file("word_bpe_49k.json"), window=4096, end_id=2)
    return packed.withColumnRenamed("id", "doc_id")


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("mixing", mixing),
    ("packing", packing),
]

#: SQL cannot hash by XXH64 or tokenize, so the stages are tested one by one.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``, each written as Parquet and read by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    root = f"{shared_folder(spark)}/docsieve-pipeline/{uuid.uuid4().hex}"
    for number, (name, stage) in enumerate(STAGES):
        path = f"{root}/{number}_{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
