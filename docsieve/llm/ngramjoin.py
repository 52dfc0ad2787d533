"""Documents with nearly equal sets of word n-grams, by a blocked sparse product of the incidence matrix."""

from __future__ import annotations

import math
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docsieve.llm.common import connected_components
from docsieve.session import broadcast_if_small, stored

#: N-grams of the documents of one block, and the least that a document counts, which bounds a block's documents to 2,000 or so.
BLOCK_GRAMS, LEAST_WEIGHT = 400_000, 200
#: Pairs left between blocks that one task multiplies, about.
PAIRS = 20_000
#: Columns of the product that are multiplied at a time.
COLUMNS = 8192
#: Words of which a worker remembers the hash.
REMEMBERED = 1 << 20


def _mixed(x):
    import numpy as np

    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def gram_set(text: bytes | None, words: int, known: dict[bytes, int]):
    """The sorted distinct hashes of a text's n-grams; ``known`` remembers the hashes of words.

    A-Z are lower-cased and words are runs without ASCII white space.  Fewer than
    ``words`` words are one n-gram, none give an empty set.
    """
    import numpy as np
    import xxhash

    found = (text or b"").lower().split()
    if not found:
        return np.zeros(0, np.uint64)
    if len(known) > REMEMBERED:
        known.clear()
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((known.get(w) or known.setdefault(w, digest(w)) for w in found), np.uint64, len(found))
    length = min(words, len(found))
    grams = np.full(len(found) - length + 1, length, np.uint64)
    for at in range(length):
        grams = _mixed(grams * np.uint64(0x9E3779B97F4A7C15) + hashes[at : at + len(grams)])
    return np.unique(grams)


def _least_partner(n: Column, percent: int) -> Column:
    """The fewest n-grams that a set of ``n`` shares with any linked one; also the smallest linked size."""
    return F.ceil(n * percent / F.lit(100)).cast("long")


def _needed(a: Column, b: Column, percent: int) -> Column:
    """The fewest shared n-grams at which sets of ``a`` and ``b`` are linked."""
    return F.floor(((a + b) * percent + (99 + percent)) / F.lit(100 + percent)).cast("long")


#: Sizes from which one and two leading hash bits are 0 in the n-grams first looked at: a half or a quarter of them.
CUTS = (64, 128)
#: Steps of the size ratio that linked sets may have in one cell of sizes.
CELL_STEPS = 6


def _cut(n: Column) -> Column:
    return F.when(n < CUTS[0], 0).when(n < CUTS[1], 1).otherwise(2)


def _within(gram: Column, bits: Column) -> Column:
    """Whether the leading ``bits`` bits of a hash, up to two, are 0."""
    mask = F.when(bits == 0, 0).when(bits == 1, 2).otherwise(3)
    return F.shiftrightunsigned(gram, 62).bitwiseAND(mask) == 0


def _cells(n: Column, percent: int) -> Column:
    """The cells of sizes that a set of ``n`` is looked for in: its own, and the next where a linked set may lie there."""
    # A little wider than the ratio, so that rounding never parts sizes at the limit.
    place = F.log(n) / F.lit(CELL_STEPS * (math.log(100 / percent) + 1e-3))
    own = F.floor(place).cast("int")
    low, high = place - own < 1 / CELL_STEPS, place - own > 1 - 1 / CELL_STEPS
    return F.when(low, F.array(own, own - 1)).when(high, F.array(own, own + 1)).otherwise(F.array(own))


def sketches(docs: DataFrame, *, id_col: str, text_col: str, words: int) -> DataFrame:
    """``(id, key, n, digest, few)`` of every row: text hash, set size, digest of the set, and the n-grams first sent on."""
    chosen = docs.select(
        F.col(f"`{id_col}`").alias("id"), F.xxhash64(F.col(f"`{text_col}`")).alias("key"), F.col(f"`{text_col}`").cast("binary").alias("text")
    )
    kind = chosen.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np
        import xxhash

        known: dict[bytes, int] = {}
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                sizes, digests, few = [], [], []
                for text in part.column(2):
                    grams = gram_set(text.as_py(), words, known)
                    n = len(grams)
                    sizes.append(n)
                    digests.append(xxhash.xxh3_128_digest(grams.tobytes()))
                    bits = sum(n >= cut for cut in CUTS)
                    few.append(grams[: np.searchsorted(grams, np.uint64(1 << (64 - bits)))] if bits else grams)
                offsets = np.concatenate(([0], np.cumsum([len(x) for x in few]))).astype(np.int32)
                flat = np.concatenate(few).view(np.int64)
                listed = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))
                columns = [part.column(0), part.column(1), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), listed]
                yield pa.RecordBatch.from_arrays(columns, ["id", "key", "n", "digest", "few"])

    return chosen.mapInArrow(run, f"id {kind}, key bigint, n bigint, digest binary, few array<bigint>")


def whole_sets(docs: DataFrame, wanted: DataFrame, *, id_col: str, text_col: str, words: int) -> DataFrame:
    """``(set, n, grams)`` of the wanted sets ``(set, id, key)``, read again from one document of each."""
    named = broadcast_if_small(wanted.select("set", F.col("id").alias("__id"), F.col("key").alias("__key")))
    texts = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    same = F.col("id").eqNullSafe(F.col("__id")) & (F.xxhash64("text") == F.col("__key"))
    chosen = texts.join(named, same).select("set", F.col("text").cast("binary").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, int] = {}
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                part = batch.slice(at, 200)
                sets = [gram_set(text.as_py(), words, known).view("int64") for text in part.column(1)]
                columns = [part.column(0), pa.array([len(x) for x in sets], pa.int64()), pa.array(sets, pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays(columns, ["set", "n", "grams"])

    sets = stored(chosen.mapInArrow(run, "set bigint, n bigint, grams array<bigint>"))
    # Rows equal in id and text give a set more than once.
    repeated = sets.groupBy("set").count().where("count > 1").limit(1).count()
    return stored(sets.dropDuplicates(["set"])) if repeated else sets


def _without_lonely(sets: DataFrame, rows: DataFrame, percent: int) -> DataFrame:
    """The ``(mark, n, looked, ...)`` of which few enough n-grams are in no other set of about their size.

    A linked set has nearly the size and ``percent`` of the n-grams.  ``rows`` is ``(mark, n, grams, bits)`` of every row;
    equal sets have equal marks, and ``looked`` n-grams of a set, those whose leading ``bits`` are 0, count against it.  Of a
    set looked for in two cells an n-gram must be alone in both; with a and b alone in either, at least a + b - looked are.
    """
    inside = _within(F.col("gram"), F.col("bits")).alias("inside")
    placed = rows.select("mark", "bits", "grams", F.explode(_cells(F.col("n"), percent)).alias("cell"))
    entries = placed.select("mark", "bits", "cell", F.explode("grams").alias("gram"))
    entries = entries.select(F.xxhash64("gram", "cell").alias("key"), "mark", inside)
    marks = entries.groupBy("key").agg(F.min("mark").alias("mark"), F.max("mark").alias("other"), F.max("inside").alias("inside"))
    alone = marks.where("mark = other AND inside").groupBy("mark").agg(F.count("*").alias("alone"))
    counted = sets.join(alone, "mark", "left")
    lonely = F.coalesce("alone", F.lit(0)) - (F.size(_cells(F.col("n"), percent)) - 1) * F.col("looked")
    return counted.where(lonely <= F.col("n") - _least_partner(F.col("n"), percent)).drop("alone")


def rare_columns(sets: DataFrame, percent: int) -> DataFrame:
    """``(gram, set, n, place)``: of every set the rarest n-grams, as many as hold at least one of any overlap that links it.

    N-grams are ordered by how many sets hold them, then by hash; ``place`` counts from 1.  Those in one set only come
    first and are left out.
    """
    entries = sets.select("set", "n", F.explode("grams").alias("gram"))
    counts = entries.groupBy("gram").agg(F.count("*").alias("c"))
    shared = entries.join(counts.where("c > 1"), "gram")
    ordered = shared.groupBy("set", "n").agg(F.array_sort(F.collect_list(F.struct("c", "gram"))).alias("ordered"))
    lonely = F.col("n") - F.size("ordered")
    # Of n - least + 1 places the lonely ones take the first.
    places = (F.col("n") - _least_partner(F.col("n"), percent) + 1 - lonely).cast("int")
    rare = ordered.where(places > 0).select("set", "n", lonely.alias("lonely"), F.posexplode(F.slice("ordered.gram", F.lit(1), places)).alias("at", "gram"))
    return rare.select("gram", "set", "n", (F.col("lonely") + F.col("at") + 1).alias("place"))


def _forest(key, rows: pd.DataFrame, percent: int) -> pd.DataFrame:
    """Links that connect what the products of a task's blocks connect."""
    found = [link for _, part in rows.groupby("block", sort=False) for link in _block_links(part, percent)]
    return pd.DataFrame(found, columns=["a", "b"]).astype("int64")


def _block_links(rows: pd.DataFrame, percent: int) -> list[tuple]:
    """Links that connect what the product of a block with itself, or of the two sides of a pair of blocks, connects.

    Counts of shared n-grams are accumulated over the columns, a slice at a time; a pair is discarded as soon as what
    is left of both cannot lift it to the overlap that its sizes ask for.
    """
    import numpy as np

    names, sides, sizes = rows["set"].to_numpy(), rows["side"].to_numpy(), rows["n"].to_numpy()
    count = len(rows)
    lengths = np.array([len(x) for x in rows["grams"]])
    flat = np.concatenate(rows["grams"].to_numpy())
    of_row = np.repeat(np.arange(count), lengths)
    _, column, held = np.unique(flat, return_inverse=True, return_counts=True)
    use = held[column] > 1
    of_row, column = of_row[use], column[use]
    order = np.argsort(column, kind="stable")
    of_row, column = of_row[order], column[order]
    column = np.cumsum(np.concatenate(([0], np.diff(column) > 0))) if len(column) else column
    needed = -(-percent * (sizes[:, None] + sizes[None, :]) // (100 + percent))
    alive = (sides[:, None] != sides[None, :]) if (sides != sides[0]).any() else ~np.eye(count, dtype=bool)
    overlap = np.zeros((count, count), np.float32 if sizes.max() < 1 << 24 else np.float64)
    left = np.bincount(of_row, minlength=count)
    width = int(column[-1]) + 1 if len(column) else 0
    for low in range(0, width, COLUMNS):
        alive &= overlap + np.minimum(left[:, None], left[None, :]) >= needed
        active = np.nonzero(alive.any(axis=1))[0]
        if not len(active):
            break
        begin, end = np.searchsorted(column, [low, low + COLUMNS])
        place = np.full(count, -1)
        place[active] = np.arange(len(active))
        keep = place[of_row[begin:end]] >= 0
        slab = np.zeros((len(active), min(COLUMNS, width - low)), overlap.dtype)
        slab[place[of_row[begin:end][keep]], column[begin:end][keep] - low] = 1
        overlap[np.ix_(active, active)] += slab @ slab.T
        left = left - np.bincount(of_row[begin:end], minlength=count)
    linked = alive & (overlap >= needed)
    seen, found = np.zeros(count, bool), []
    for start in np.nonzero(linked.any(axis=1))[0]:
        if seen[start]:
            continue
        reached = np.zeros(count, bool)
        reached[start] = True
        front = reached
        while front.any():
            front = linked[front].any(axis=0) & ~reached
            reached |= front
        seen |= reached
        found += [(names[start], names[other]) for other in np.nonzero(reached)[0] if other != start]
    return found


def _product(rows: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links ``(a, b)`` of the blocks, or parts of two blocks, in every task's rows ``(task, block, side, set)``."""
    filled = rows.join(sets.select("set", "n", "grams"), "set")
    return filled.groupBy("task").applyInPandas(lambda key, part: _forest(key, part, percent), "a bigint, b bigint")


def _blocks(columns: DataFrame) -> DataFrame:
    """``(set, block, task)``: sets that share a column are one block as far as its size allows; small ones share a task.

    A set's home is the least number that a column of it holds.  The sets of a home are a block; homes that outgrow one
    are cut by hash, with the set that names the home in every piece.  So a block's n-grams are bounded whatever the groups.
    """
    pulled = columns.join(columns.groupBy("gram").agg(F.min("set").alias("first")), "gram")
    homes = stored(pulled.groupBy("set", "n").agg(F.min("first").alias("home")))
    weighed = homes.groupBy("home").agg(F.sum(F.greatest("n", F.lit(LEAST_WEIGHT))).alias("weight"))
    total = weighed.agg(F.sum("weight")).first()[0] or 0
    tasks = max(1, -(-int(total) // BLOCK_GRAMS))
    weighed = weighed.select("home", F.ceil(F.col("weight") / BLOCK_GRAMS).alias("pieces"))
    rows = homes.join(weighed, "home").select("home", "pieces", "set", F.pmod(F.xxhash64("set"), "pieces").alias("piece"))
    named = weighed.where("pieces > 1").select(
        "home", "pieces", F.col("home").alias("set"), F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("pieces") - 1)).alias("piece")
    )
    block = F.xxhash64("home", "piece")
    task = F.when(F.col("pieces") > 1, block).otherwise(F.pmod(F.xxhash64("home"), F.lit(tasks)))
    return rows.unionByName(named).select("set", block.alias("block"), task.alias("task")).distinct()


def crossing_pairs(columns: DataFrame, labels: DataFrame, percent: int) -> DataFrame:
    """``(a, block_a, b, block_b)``: pairs of different labels and blocks that their sizes and a column do not rule out.

    Columns are joined within bands of size, of which a linked pair is at most one apart.  In every column the sets
    outside its largest label meet those of other labels.  At the first column that a linked pair shares, what comes after
    it in the smaller remainder must reach the overlap that the sizes ask for.
    """
    # A little wider than the ratio, so that rounding never parts sizes at the limit.
    band = F.floor(F.log("n") / F.lit(math.log(100 / percent) + 1e-3)).cast("int")
    rows = columns.join(labels, "set").withColumn("band", band)
    held = rows.groupBy("gram", "label").agg(F.count("*").alias("c")).groupBy("gram")
    mixed = held.agg(F.max(F.struct("c", "label"))["label"].alias("largest"), F.count("*").alias("labels")).where("labels > 1")
    rows = rows.join(mixed.select("gram", "largest"), "gram")
    near = F.explode(F.array(F.col("band") - 1, F.col("band"), F.col("band") + 1)).alias("band")

    def side(name: str) -> list[Column]:
        return [F.col(c).alias(f"{c}_{name}") for c in ("set", "n", "label", "block", "place")]

    small = rows.where("label <> largest").select("gram", near, *side("a"))
    other = rows.select("gram", "band", "largest", *side("b"))
    sized = F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * percent
    once = (F.col("label_b") == F.col("largest")) | (F.col("set_a") < F.col("set_b"))
    apart = (F.col("label_a") != F.col("label_b")) & (F.col("block_a") != F.col("block_b"))
    reach = 1 + F.least(F.col("n_a") - F.col("place_a"), F.col("n_b") - F.col("place_b")) >= _needed(F.col("n_a"), F.col("n_b"), percent)
    met = small.join(other, ["gram", "band"]).where(apart & sized & once & reach)
    return met.select(F.col("set_a").alias("a"), "block_a", F.col("set_b").alias("b"), "block_b").distinct()


def linked_sets(sets: DataFrame, percent: int) -> DataFrame:
    """``(set, label)``: the linked ones of stored sets ``(set, n, grams)``, each with a name of its group.

    First every block of sets with rare n-grams in common is multiplied with itself; what is linked gets one label.
    Then only pairs of different labels and blocks are left, and the parts of blocks that hold such pairs are multiplied.
    Large groups of near copies thus never become all their pairs, and no link between labels is lost.
    """
    columns = rare_columns(sets, percent)
    shared = columns.groupBy("gram").agg(F.count("*").alias("c")).where("c > 1").select("gram")
    columns = stored(columns.join(shared, "gram"))
    blocks = stored(_blocks(columns))
    links = stored(_product(blocks.withColumn("side", F.lit(0)), sets, percent))
    found = connected_components(links, "a", "b")
    # The set that names a large home is in several blocks; any one of them will do.
    placed = blocks.groupBy("set").agg(F.min("block").alias("block"))
    labels = stored(
        placed.join(found, F.col("set") == F.col("node"), "left").select("set", "block", F.coalesce("component", "set").alias("label"))
    )
    pairs = stored(crossing_pairs(columns, labels, percent))
    count = pairs.count()
    tasks = max(1, -(-count // PAIRS))
    turned = F.col("block_a") > F.col("block_b")
    sides = [("a", "b", 0), ("b", "a", 1)]
    each = F.explode(
        F.array(*[F.struct(F.lit(side).alias("side"), F.when(turned, F.col(y)).otherwise(F.col(x)).alias("set")) for x, y, side in sides])
    )
    both = F.xxhash64(F.least("block_a", "block_b"), F.greatest("block_a", "block_b"))
    ends = pairs.select(both.alias("block"), each.alias("end"))
    parts = ends.select(F.pmod("block", F.lit(tasks)).alias("task"), "block", "end.side", "end.set").distinct()
    more = stored(_product(parts, sets, percent))
    relabelled = more
    for end in ("a", "b"):
        relabelled = relabelled.join(labels.select(F.col("set").alias(end), F.col("label").alias(f"label_{end}")), end)
    merged = connected_components(relabelled.select("label_a", "label_b"), "label_a", "label_b")
    return labels.join(merged, F.col("label") == F.col("node"), "left").select("set", F.coalesce("component", "label").alias("label"))


def ngram_groups(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", words: int = 3, percent: int = 90
) -> DataFrame:
    """Group documents by the Jaccard similarity of their sets of ``words``-word n-grams; one row per document.

    Returns ``(id, n, component_id)``: the size of the set and the smallest id that links reach, the document's own
    included.  Two documents are linked when their sets share at least ``percent`` percent of their union.  A text
    of fewer words is one n-gram.  Null, empty and blank texts have an empty set and are linked with nothing; rows
    that repeat are returned as often; ids may be null and then count only where a group has no other; an empty
    table gives no rows; other columns are ignored.  N-grams are compared by 64-bit hashes.

    Equal sets are one row of the matrix.  A set goes on only if few enough of its n-grams are in no other set, first by
    those with small hashes, then by all, and among sets of about its size; the rest is ``linked_sets``.
    """
    if not 0 < percent <= 100:
        raise ValueError("percent must be over 0 and at most 100")
    found = stored(sketches(docs, id_col=id_col, text_col=text_col, words=words))
    order = F.struct(F.col("id").isNull().alias("none"), F.col("id").alias("id"), F.col("key").alias("key"))
    distinct = found.where("n > 0").groupBy("digest", "n").agg(F.min(order).alias("first"))
    mark = F.xxhash64("digest").alias("mark")
    classes = stored(distinct.select(F.monotonically_increasing_id().alias("set"), "digest", mark, "n", "first.id", "first.key"))

    # What a set sends on must hold what any linked one looks at, so only the share of the largest such size counts.
    bits = _cut(F.floor(F.col("n") * 100 / F.lit(percent)))
    rows = found.where("n > 0").select(mark, "n", F.col("few").alias("grams"), bits.alias("bits"))
    looked = F.size(F.filter("grams", lambda gram: _within(gram, F.col("bits")))).alias("looked")
    sized = rows.select("mark", looked).dropDuplicates(["mark"])
    likely = _without_lonely(classes.select("set", "mark", "id", "key", "n").join(sized, "mark"), rows, percent)
    sets = whole_sets(docs, likely, id_col=id_col, text_col=text_col, words=words)
    whole = sets.select(F.col("set").alias("mark"), "n", "grams", F.lit(0).alias("bits"))
    again = _without_lonely(whole.select("mark", "n", F.col("n").alias("looked")), whole, percent).select(F.col("mark").alias("set"))
    left = stored(sets.join(broadcast_if_small(again), "set", "left_semi"))
    labels = linked_sets(left, percent)

    named = classes.join(labels, "set", "left").select("digest", "id", F.coalesce("label", "set").alias("label"))
    named = stored(named)
    least = named.groupBy("label").agg(F.min("id").alias("component_id"))
    of_set = named.join(least, "label").select("digest", "component_id")
    joined = found.select("id", "n", "digest").join(of_set, "digest", "left")
    return joined.select("id", "n", F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id")).alias("component_id"))
