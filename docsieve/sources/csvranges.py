"""CSV files with line breaks inside quotes, read in byte ranges by many tasks."""

from __future__ import annotations

import csv
import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docsieve.session import broadcast_if_small

#: Bits of a row's number for its place in its file.
ROW_BITS = 40
#: Stands for a quoted stretch when records are looked through for stray quotes.
MARK = "\x01"


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """``(file, start, line, value, quotes, before, even, odd)``: the lines of every byte range, in order.

    ``before`` counts the quotes of the range before the line; ``even`` and ``odd`` count the records that start in the
    range up to it, this line included, if an even or odd number of quotes lies before the range.
    """
    text = spark.read.option("lineSep", "\n").text(path)
    found = text.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("line"),
        "value",
    )
    names = ["quotes", "before", "even", "odd"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # What the ranges of this task have had so far: quotes, and records started under either parity.
        seen: dict[tuple[str, int], tuple[int, int, int]] = {}
        for batch in batches:
            quotes = pc.count_substring(pc.fill_null(batch.column(3), ""), '"').to_numpy(zero_copy_only=False).astype(np.int64)
            starts = batch.column(1).to_numpy(zero_copy_only=False)
            files = batch.column(0).dictionary_encode()
            codes = files.indices.to_numpy(zero_copy_only=False)
            edges = np.nonzero(np.append(True, (np.diff(starts) != 0) | (np.diff(codes) != 0)))[0] if len(starts) else np.zeros(0, int)
            columns = np.zeros((3, len(quotes)), np.int64)
            for low, high in zip(edges, np.append(edges[1:], len(starts)), strict=True):
                key = (files.dictionary[int(codes[low])].as_py(), int(starts[low]))
                had, even, odd = seen.get(key, (0, 0, 0))
                total = np.cumsum(quotes[low:high])
                before = had + total - quotes[low:high]
                columns[0, low:high] = before
                columns[1, low:high] = even + np.cumsum(before % 2 == 0)
                columns[2, low:high] = odd + np.cumsum(before % 2 == 1)
                seen[key] = (had + int(total[-1]), int(columns[1, high - 1]), int(columns[2, high - 1]))
            extra = [pa.array(quotes), *[pa.array(c) for c in columns]]
            yield pa.RecordBatch.from_arrays([*batch.columns, *extra], ["file", "start", "line", "value", *names])

    return found.mapInArrow(run, "file string, start bigint, line bigint, value string, " + ", ".join(f"{n} bigint" for n in names))


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """``(file, number, record, crlf)``: the records of CSV files, numbered from 1 in each, and whether CR LF ends them.

    A line feed inside quotes does not end a record.  Each byte range counts its quotes and, for either parity of the
    quotes before it, the records that start in it; sums over the ranges of a file then tell which parity holds and
    which number a range's first record has.  Records of one line stay where they are; only the lines of others
    are put together.  Quotes inside a field are doubled.
    """
    lines = _lines(spark, path)
    ranges = lines.groupBy("file", "start").agg(
        F.sum("quotes").alias("quotes"), F.max("even").alias("even"), F.max("odd").alias("odd")
    )
    # One row per byte range.
    earlier = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    parity = ranges.withColumn("parity", F.coalesce(F.sum("quotes").over(earlier), F.lit(0)) % 2)
    begun = F.when(F.col("parity") == 0, F.col("even")).otherwise(F.col("odd"))
    placed = parity.withColumn("first", F.coalesce(F.sum(begun).over(earlier), F.lit(0))).select(
        F.col("file").alias("of_file"), F.col("start").alias("of_start"), "parity", "first"
    )
    joined = lines.join(broadcast_if_small(placed, 256), (F.col("file") == F.col("of_file")) & (F.col("start") == F.col("of_start")))
    inside = (F.col("before") + F.col("parity")) % 2 == 1
    numbered = joined.select(
        "file",
        "line",
        (F.col("first") + F.when(F.col("parity") == 0, F.col("even")).otherwise(F.col("odd"))).alias("number"),
        "value",
        (~inside & (F.col("quotes") % 2 == 0)).alias("whole"),
    )
    whole = numbered.where("whole").select("file", "number", F.col("value").alias("record"))
    parts = F.array_sort(F.collect_list(F.struct("line", "value")))
    together = numbered.where("not whole").groupBy("file", "number").agg(F.array_join(F.transform(parts, lambda p: p["value"]), "\n").alias("record"))
    ended = F.regexp_replace("record", "\r\\z", "")
    first = F.when(F.col("number") == 1, F.regexp_replace(ended, "^﻿", "")).otherwise(ended)
    crlf = F.col("record").endswith("\r").alias("crlf")
    return whole.unionByName(together).select("file", "number", first.alias("record"), crlf)


def has_stray_quotes(records: DataFrame) -> bool:
    """Whether a record has quotes that neither open, close nor double, so that counting them misleads."""
    plain = F.regexp_replace("record", '"[^"]*"', MARK)
    odd = plain.rlike(f'"|[^,{MARK}]{MARK}|{MARK}[^,{MARK}]') | F.col("record").contains(MARK)
    return not records.where(odd).limit(1).isEmpty()


def read_csv_ranges(spark: SparkSession, path: str, with_row_seq: bool = False) -> DataFrame | None:
    """The table of CSV files with a header each, or None if stray quotes make their records uncertain.

    ``with_row_seq`` adds ``row_seq``, which rises in source order: by file name and place in the file.  Blank lines are
    skipped; short records end in nulls.
    """
    records = csv_records(spark, path).where("record <> ''")
    if has_stray_quotes(records):
        return None
    # One row per file; a file's first record is its header.
    heads = records.groupBy("file").agg(F.min(F.struct("number", "record", "crlf")).alias("head")).orderBy("file").collect()
    if not heads:
        return None
    names = next(csv.reader(io.StringIO(heads[0]["head"]["record"], newline="")))
    fields = ", ".join(f"c{i} string" for i in range(len(names)))
    options = {"quote": '"', "escape": '"', "multiLine": "true"}
    first = spark.createDataFrame(
        [(r["file"], r["head"]["number"], i, r["head"]["crlf"]) for i, r in enumerate(heads)],
        "of_file string, header bigint, place bigint, breaks boolean",
    )
    body = records.join(F.broadcast(first), F.col("file") == F.col("of_file")).where(F.col("number") > F.col("header"))
    # A file whose records end in CR LF has its own line breaks inside quotes too, and they read as line feeds.
    record = F.when(F.col("breaks"), F.replace("record", F.lit("\r\n"), F.lit("\n"))).otherwise(F.col("record"))
    parsed = body.select(F.from_csv(record, fields, options).alias("r"), (F.shiftleft("place", ROW_BITS) + F.col("number")).alias("row_seq"))
    kept = [F.col("r")[f"c{i}"].alias(name if name else f"_c{i}") for i, name in enumerate(names)]
    return parsed.select(*kept, *(["row_seq"] if with_row_seq else []))
