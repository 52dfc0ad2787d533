"""Reading the article table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docsieve.sources.csvranges import read_csv_ranges

# Column names looked for, in this order.
ID_NAMES = ("doc_id", "document_id")
TEXT_NAMES = ("text", "content", "article", "document", "body")


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists in whatever file system its scheme names."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jvm_path)


def pick_columns(columns: Sequence[str], id_col: str | None = None, text_col: str | None = None) -> tuple[str, str]:
    """Find the id and the text column by name, ignoring case, then by position.

    The text column is never the id column: when no name fits, the first other
    column is taken.
    """
    if id_col and text_col:
        return id_col, text_col
    by_name = {name.lower(): name for name in columns}
    found_id = id_col or next((by_name[name] for name in ID_NAMES if name in by_name), columns[0])
    found_text = text_col or next((by_name[name] for name in TEXT_NAMES if name in by_name), None)
    if found_text is None:
        found_text = next((name for name in columns if name != found_id), None)
    if found_text is None:
        raise ValueError("No text column found in the input table.")
    return found_id, found_text


def as_articles(table: DataFrame, id_col: str | None = None, text_col: str | None = None) -> DataFrame:
    """``doc_id`` as string and ``text`` with nulls as empty strings."""
    found_id, found_text = pick_columns(table.columns, id_col, text_col)
    kept = [F.col("row_seq")] if "row_seq" in table.columns else []
    return table.select(
        F.col(f"`{found_id}`").cast("string").alias("doc_id"),
        F.coalesce(F.col(f"`{found_text}`").cast("string"), F.lit("")).alias("text"),
        *kept,
    )


def load_articles(
    spark: SparkSession,
    path: str,
    id_col: str | None = None,
    text_col: str | None = None,
    with_row_seq: bool = False,
) -> DataFrame:
    """Read articles from CSV (by file ending) or Parquet.

    ``with_row_seq`` adds a number that grows in source order, so results can be
    written back in that order.  Ids are always read as text, so ``001`` stays
    ``001``.  CSV files are read in byte ranges by many tasks, line breaks inside
    quotes included; one that is compressed, or has quotes in unquoted fields, is
    read by one task.
    """
    if not path_exists(spark, path):
        raise FileNotFoundError(f"Input was not found: {path}")
    table = None
    if path.lower().endswith((".csv", ".csv.gz")):
        table = read_csv_ranges(spark, path, with_row_seq) if path.lower().endswith(".csv") else None
        if table is None:
            table = spark.read.csv(path, header=True, multiLine=True, escape='"', quote='"')
    else:
        table = spark.read.parquet(path)
    if with_row_seq and "row_seq" not in table.columns:
        table = table.withColumn("row_seq", F.monotonically_increasing_id())
    return as_articles(table, id_col, text_col)


def spread(table: DataFrame, key: str, partitions: int | None = None) -> DataFrame:
    """Hash-spread a table that was read in fewer partitions than there are cores.

    A table that already has enough partitions is returned untouched, so large
    inputs pay no shuffle.
    """
    wanted = partitions or table.sparkSession.sparkContext.defaultParallelism
    return table if table.rdd.getNumPartitions() >= wanted else table.repartition(wanted, key)
