"""Near-duplicate documents by SimHash and pigeonhole blocks."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docsieve.llm.common import connected_components
from docsieve.session import stored

BITS = 64
#: Seed of the shingles' XXH64.
SEED = 42
#: Members of a block that all others are first compared with.
PIVOTS = 3
#: Shingles whose bits are counted at a time.
STEP = 1 << 16


def fingerprint(text: str | None, words: int = 4) -> int:
    """The SimHash of a text as a signed 64-bit number; 0 without words."""
    import numpy as np
    import xxhash

    found = (text or "").encode().lower().split()
    if not found:
        return 0
    joined = b" ".join(found)
    lengths = np.fromiter(map(len, found), np.int64, len(found))
    starts = np.cumsum(lengths + 1) - lengths - 1
    ends = starts + lengths
    if len(found) > words:
        starts, ends = starts[: 1 - words] if words > 1 else starts, ends[words - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    digest = xxhash.xxh64_intdigest
    counts = np.zeros(BITS, np.int64)
    for at in range(0, len(starts), STEP):
        spans = zip(starts[at : at + STEP].tolist(), ends[at : at + STEP].tolist(), strict=True)
        hashes = np.array([digest(joined[a:b], SEED) for a, b in spans], np.uint64)
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * counts > len(starts)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", words: int = 4) -> DataFrame:
    """``(id, key, fp)``: the id, a hash of the text and the SimHash of every document."""
    chosen = docs.select(
        F.col(f"`{id_col}`").alias("id"), F.xxhash64(F.col(f"`{text_col}`")).alias("key"), F.col(f"`{text_col}`").alias("text")
    )
    schema = chosen.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [fingerprint(text.as_py(), words) for text in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(values, pa.int64())], ["id", "key", "fp"])

    return chosen.mapInArrow(run, f"id {schema['id'].dataType.simpleString()}, key bigint, fp bigint")


def block_keys(fp: Column, most_bits: int) -> Column:
    """The block keys of a fingerprint.

    Cut into ``most_bits + 2`` blocks, two fingerprints that differ in at most
    ``most_bits`` bits agree in two of them, so each pair of blocks gives a key.
    """
    blocks = most_bits + 2
    edges = [round(i * BITS / blocks) for i in range(blocks + 1)]
    parts = [
        F.shiftrightunsigned(fp, edges[i]).bitwiseAND(F.lit((1 << (edges[i + 1] - edges[i])) - 1)) for i in range(blocks)
    ]
    widths = [edges[i + 1] - edges[i] for i in range(blocks)]
    keys = []
    for number, (i, j) in enumerate(combinations(range(blocks), 2)):
        pair = F.shiftleft(parts[i], widths[j]).bitwiseOR(parts[j])
        keys.append(F.lit(number << 48).bitwiseOR(pair))
    return F.array(*keys)


def _apart(a: str, b: str) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b)))


def linked_fingerprints(found: DataFrame, most_bits: int = 4) -> DataFrame:
    """``(fp, group)``: every distinct fingerprint with a name of its group of linked ones.

    Two passes, so that a block of thousands of near copies never becomes all its
    pairs.  First each member is compared with ``PIVOTS`` members of its blocks,
    and what that links is joined into groups.  Then, in every block that still
    holds several groups, the members outside its largest group are compared with
    all members of other groups: any link not yet known has such an end.
    """
    distinct = stored(found.select("fp").distinct())
    members = distinct.select("fp", F.explode(block_keys(F.col("fp"), most_bits)).alias("block"))
    pivots = [F.min(F.struct(F.xxhash64(F.lit(i), "fp"), "fp"))["fp"] for i in range(PIVOTS)]
    shared = members.groupBy("block").agg(F.count("*").alias("n"), F.array(*pivots).alias("pivots")).where("n > 1")
    near = members.join(shared.drop("n"), "block").select("fp", F.explode("pivots").alias("pivot"))
    links = stored(near.where((F.col("fp") != F.col("pivot")) & (_apart("fp", "pivot") <= most_bits)).distinct())
    grouped = connected_components(links, "fp", "pivot")

    labelled = stored(
        distinct.join(grouped, F.col("fp") == F.col("node"), "left").select("fp", F.coalesce("component", "fp").alias("label"))
    )
    members = labelled.select("fp", "label", F.explode(block_keys(F.col("fp"), most_bits)).alias("block"))
    mixed = (
        members.groupBy("block", "label")
        .agg(F.count("*").alias("n"))
        .groupBy("block")
        .agg(F.max(F.struct("n", "label"))["label"].alias("largest"), F.count("*").alias("labels"))
        .where("labels > 1")
        .drop("labels")
    )
    inside = members.join(mixed, "block")
    smaller = inside.where("label <> largest").select("block", F.col("fp").alias("a"), F.col("label").alias("a_label"))
    others = inside.select("block", "largest", F.col("fp").alias("b"), F.col("label").alias("b_label"))
    crossing = smaller.join(others, "block").where(
        (F.col("a_label") != F.col("b_label"))
        & ((F.col("b_label") == F.col("largest")) | (F.col("a") < F.col("b")))
        & (_apart("a", "b") <= most_bits)
    )
    merged = connected_components(crossing.select("a_label", "b_label").distinct(), "a_label", "b_label")
    return labelled.join(merged, F.col("label") == F.col("node"), "left").select("fp", F.coalesce("component", "label").alias("group"))


def simhash_groups(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", words: int = 4, most_bits: int = 4
) -> DataFrame:
    """Group documents whose fingerprints are linked; one row per document.

    A-Z are lower-cased, words are runs without ASCII white space, shingles are
    ``words`` words joined by a space, repeats included; fewer words make one
    shingle.  A bit of the fingerprint is set where over half of the shingles'
    XXH64 have it.  Fingerprints at most ``most_bits`` bits apart are linked, and
    links pass on.  Returns ``(id, key, fp, group, component_id)``: ``group``
    is a fingerprint that names the group, ``component_id`` its smallest id, null
    only where all are.  Null, empty and blank
    texts have fingerprint 0, linked like any other.  An empty table gives no
    rows; rows that repeat are returned as often; other columns are ignored.
    """
    found = stored(fingerprints(docs, id_col=id_col, text_col=text_col, words=words))
    groups = stored(linked_fingerprints(found, most_bits))
    # The smallest id of a fingerprint first, so that a group's join and grouping see each text's copies once.
    least = found.groupBy("fp").agg(F.min("id").alias("least"))
    named = least.join(groups, "fp").groupBy("group").agg(F.min("least").alias("component_id"))
    of_fp = groups.join(named, "group").select("fp", "group", "component_id")
    return found.join(of_fp, "fp").select("id", "key", "fp", "group", "component_id")


def first_of_groups(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", words: int = 4, most_bits: int = 4) -> DataFrame:
    """The documents that stay when one of each group does: the smallest id, then the smallest text hash.

    Rows equal in id and text are one document and leave one row.  All columns are kept.
    """
    groups = simhash_groups(docs, id_col=id_col, text_col=text_col, words=words, most_bits=most_bits)
    order = F.struct(F.col("id").isNull().alias("missing"), F.col("id").alias("id"), F.col("key").alias("key"))
    chosen = groups.groupBy("group").agg(F.min(order).alias("first"))
    keep = chosen.select(F.col("first.id").alias("__keep_id"), F.col("first.key").alias("__keep_key"))
    # The row is boxed, so that its columns may have any names.
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row")
    marked = docs.select(row, F.col(f"`{id_col}`").alias("__id"), F.xxhash64(F.col(f"`{text_col}`")).alias("__key"))
    kept = marked.join(keep, F.col("__id").eqNullSafe(F.col("__keep_id")) & (F.col("__key") == F.col("__keep_key")))
    return kept.dropDuplicates(["__id", "__key"]).select(*[F.col("__row")[c].alias(c) for c in docs.columns])
