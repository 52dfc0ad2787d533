"""Line deduplication by overlapping three-line windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Lines of a window.
WINDOW = 3


def _windows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(id, key, first, last, window)``: each run of three lines with a word, by its line numbers and MD5."""
    lines = F.split(F.col(f"`{text_col}`"), "\n")
    numbered = F.transform(lines, lambda line, i: F.struct(i.alias("at"), F.trim(line).alias("line")))
    filled = docs.select(
        F.col(f"`{id_col}`").alias("id"),
        F.xxhash64(F.col(f"`{text_col}`")).alias("key"),
        F.filter(numbered, lambda n: F.length(n["line"]) > 0).alias("lines"),
    ).where(F.size("lines") >= WINDOW)

    def window(i: Column) -> Column:
        text = F.concat_ws("\n", *[F.get("lines", i + j)["line"] for j in range(WINDOW)])
        return F.struct(
            F.get("lines", i)["at"].alias("first"),
            F.get("lines", i + WINDOW - 1)["at"].alias("last"),
            F.unhex(F.md5(text)).alias("window"),
        )

    found = F.transform(F.sequence(F.lit(0), F.size("lines") - WINDOW), window)
    return filled.select("id", "key", F.explode(found).alias("w")).select("id", "key", "w.*")


def repeated_spans(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, key, spans)``: the line spans that repeat an earlier window, merged.

    Windows are compared over all documents by MD5.  The first occurrence, by id,
    text hash and line, stays; every later one covers its lines, and covered lines
    that touch or overlap are one span ``(first, last)``.  A window that a third
    of the documents share is reduced to one row before the shuffle; its later
    occurrences are joined by window, where adaptive execution splits a hot one.
    """
    windows = _windows(docs, id_col, text_col)
    place = F.struct("id", "key", "first")
    repeated = (
        windows.groupBy("window").agg(F.min(place).alias("earliest"), F.count("*").alias("n")).where("n > 1").drop("n")
    )
    later = windows.join(repeated, "window").where(~place.eqNullSafe(F.col("earliest")))
    ordered = F.array_sort(F.collect_set(F.struct("first", "last")))

    def merge(done: Column, span: Column) -> Column:
        end = F.get(done, F.size(done) - 1)
        grown = F.struct(end["first"].alias("first"), F.greatest(end["last"], span["last"]).alias("last"))
        return F.when((F.size(done) > 0) & (span["first"] <= end["last"] + 1), F.concat(F.slice(done, 1, F.size(done) - 1), F.array(grown))).otherwise(
            F.concat(done, F.array(span))
        )

    nothing = F.array().cast("array<struct<first:int,last:int>>")
    return later.groupBy("id", "key").agg(ordered.alias("covered")).select("id", "key", F.aggregate("covered", nothing, merge).alias("spans"))


def drop_repeated_lines(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", removed_col: str = "removed_lines"
) -> DataFrame:
    """The documents without lines that repeat earlier ones three in a row, and ``removed_col``, their number.

    Lines end at a line feed and are compared without the spaces around them;
    blank ones take no part, and go where they lie between removed lines.  Texts
    with fewer than three such lines, null and empty ones stay as they are.  Rows
    equal in id and text are one document and keep their lines or lose them
    together; of windows at equal places the smaller text hash comes first.  All
    columns are kept, whatever their names; an empty table gives no rows; long
    texts are taken whole.
    """
    spans = repeated_spans(docs, id_col=id_col, text_col=text_col).select(
        F.col("id").alias("__span_id"), F.col("key").alias("__span_key"), F.col("spans").alias("__spans")
    )
    # The row is boxed, so that its columns may have any names.
    boxed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"))
    row = F.col("__row")
    text = row[text_col]
    same = row[id_col].eqNullSafe(F.col("__span_id")) & (F.xxhash64(text) == F.col("__span_key"))
    joined = boxed.join(spans, same, "left")
    lines = F.split(text, "\n")
    # Spans are apart and in order, so the lines left are the slices between them.
    after = F.concat(F.array(F.lit(0)), F.transform("__spans", lambda s: s["last"] + 1))
    until = F.concat(F.transform("__spans", lambda s: s["first"]), F.array(F.size(lines)))
    gaps = F.zip_with(after, until, lambda low, high: F.struct(low.alias("low"), high.alias("high")))

    def kept(lines: Column) -> Column:
        return F.flatten(F.transform(gaps, lambda gap: F.slice(lines, gap["low"] + 1, gap["high"] - gap["low"])))

    # An array of one element is a name for the list of lines.
    left = F.flatten(F.transform(F.array(lines), kept))
    gone = F.aggregate("__spans", F.lit(0), lambda total, s: total + s["last"] - s["first"] + 1)
    columns = [
        F.when(F.col("__spans").isNull(), text).otherwise(F.array_join(left, "\n")).alias(c) if c == text_col else row[c].alias(c)
        for c in docs.columns
        if c != removed_col
    ]
    return joined.select(*columns, F.coalesce(gone, F.lit(0)).alias(removed_col))
