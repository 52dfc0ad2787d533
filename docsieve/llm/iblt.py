"""Document fingerprints: invertible Bloom lookup sketches of paragraph digests.

A text's paragraphs, lines or runs of words of long lines, are hashed to 64-bit digests, each put into three cells, one
of each third of a table.  A cell holds the number of its digests, their XOR and
the XOR of a check value.  The cell-wise difference of two tables holds only the
digests that one of the texts lacks; a cell with one digest left gives it away,
and taking it out of its other cells frees further ones (peeling).  Tables start
as wide as both texts together may need; where peeling gets stuck all the same,
both are built again four times wider.

Tables are rows ``(row, side or pair, cell)``, so that building, subtracting and
peeling are hash aggregations.  A text's digests travel as one array and are
spread out where they arrive; all steps of one attempt then share one shuffle.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docsieve.llm.common import first_at_least
from docsieve.session import broadcast_if_small, stored

#: Cells in a third of a fingerprint's table, and of the smallest compared one; a retry is four times wider, LEVELS times at most.
SLOTS = 8
LEVELS = 9
#: Digests of pairs that one task takes, about.
DIGESTS_PER_TASK = 400_000
#: Bits of a digest that choose its cell in a third, so a third has 2 ** 21 cells at most.
PLACE_BITS = 21
#: Times that one attempt peels each third.
SWEEPS = 2
#: Seed of the check values.
CHECK_SEED = 7
CHECK_SQL = f"xxhash64(key, {CHECK_SEED}) & 4294967295"
#: Words end at white space and at the marks of scripts that use none; a run has one cut in RUN_WORDS words on average,
#: and none before word LEAST_RUN of its line.
WORD_ENDS = r"(?<=[\s\u3001\u3002\uFF0C\uFF01\uFF1B\uFF1F])"
RUN_WORDS = 8
LEAST_RUN = 4
#: Documents that one task orders, and the most ranges they are dealt to.
DOCS_PER_RANGE = 5_000
MOST_RANGES = 50_000


def _runs(line: Column) -> Column:
    """A line cut after words whose hash with the word before says so, from word ``LEAST_RUN`` on.

    A cut depends on the two words before it alone, so an edit moves no cuts but its own.
    """
    words = F.split(line, WORD_ENDS)

    def runs(words: Column) -> Column:
        # Filtering the places by an index of the same list keeps the work linear.
        places = F.sequence(F.lit(1), F.size(words))

        def is_cut(i: Column) -> Column:
            chosen = F.pmod(F.xxhash64(F.trim(F.get(words, i - 2)), F.trim(F.get(words, i - 1))), F.lit(RUN_WORDS)) == 0
            return (i == F.size(words)) | ((i >= LEAST_RUN) & chosen)

        def cut(ends: Column) -> Column:
            def run(end: Column, j: Column) -> Column:
                start = F.when(j > 0, F.get(ends, j - 1)).otherwise(0)
                return F.trim(F.array_join(F.slice(words, start + 1, end - start), ""))

            return F.transform(ends, run)

        # An array of one element is a name for the list of cuts.
        return F.flatten(F.transform(F.array(F.filter(places, is_cut)), cut))

    return F.flatten(F.transform(F.array(words), runs))


def paragraph_digests(text: Column, separator: str = r"\n") -> Column:
    """The distinct digests of a text's paragraphs, trimmed; blank ones are left out.

    Paragraphs are its lines, and of lines of more than ``LEAST_RUN`` words their ``_runs``.
    """
    lines = F.split(F.coalesce(text, F.lit("")), separator)
    parts = F.flatten(F.transform(lines, lambda line: _runs(F.trim(line))))
    return F.array_distinct(F.transform(F.filter(parts, lambda p: F.length(p) > 0), lambda p: F.xxhash64(p)))


def _cell(key: Column, third: int, width: Column) -> Column:
    """The cell of a digest in a third of a table whose thirds have ``width`` cells, a power of two."""
    return F.shiftrightunsigned(key, PLACE_BITS * third).bitwiseAND(width - 1) + third * width


def sketches(digests: DataFrame, by: Sequence[str], width: Column, sign: Column) -> DataFrame:
    """Tables of ``(*by, key)`` rows, distinct by table and sign: ``(*by, cell, n, key, check)``.

    Digests of sign -1 are taken away, so a table of both signs is the difference of two.
    """
    spread = digests.withColumns({"sign": sign.cast("long"), "cell": F.explode(F.array(*[_cell(F.col("key"), t, width) for t in range(3)]))})
    return spread.groupBy(*by, "cell").agg(
        F.sum("sign").alias("n"), F.expr("bit_xor(key)").alias("key"), F.expr(f"bit_xor({CHECK_SQL})").alias("check")
    )


def peel(table: DataFrame, by: Sequence[str], width: Column, keep_digests: bool = True) -> DataFrame:
    """Peel differences ``(*by, cell, n, key, check)``.

    Returns the same columns and ``digest``: recovered digests are rows of cell
    -1 with their ``digest`` and n 1 (left) or -1 (right); rows of other cells
    are what stayed stuck.  Without ``keep_digests`` those of one side are one
    row, with n their number or its negative.  The cells of one third are peeled
    at a time, so a digest that stands alone in two of its cells is found once.
    """
    zero = F.lit(0).cast("long")
    names = ["cell", "digest", "n", "key", "check"]

    def row(*values: Column) -> Column:
        return F.struct(*[v.cast("long").alias(name) for v, name in zip(values, names, strict=True)])

    state = table.withColumn("digest", zero)
    for third in list(range(3)) * SWEEPS:
        lone = (
            (F.col("cell") >= third * width)
            & (F.col("cell") < (third + 1) * width)
            & (F.abs("n") == 1)
            & (F.col("check") == F.expr(CHECK_SQL))
        )
        others = [t for t in range(3) if t != third]
        freed = F.array(
            row(F.lit(-1), F.col("key") if keep_digests else F.col("n"), F.col("n"), zero, zero),
            *[row(_cell(F.col("key"), t, width), zero, -F.col("n"), F.col("key"), F.col("check")) for t in others],
        )
        same = F.array(row(*[F.col(name) for name in names]))
        moved = state.select(*by, F.explode(F.when(lone, freed).otherwise(same)).alias("r")).select(*by, "r.*")
        state = (
            moved.groupBy(*by, "cell", "digest")
            .agg(F.sum("n").alias("n"), F.expr("bit_xor(key)").alias("key"), F.expr("bit_xor(check)").alias("check"))
            .where("cell < 0 or n <> 0 or key <> 0 or check <> 0")
        )
    return state


def likeness(left_count: Column, right_count: Column, differing: Column) -> Column:
    """Jaccard likeness of two sets from their sizes and the number of members only one has."""
    every = left_count + right_count
    return F.when(every == 0, 1.0).otherwise((every - differing) / (every + differing))


def with_next_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", own: Column | None = None) -> DataFrame:
    """``(id, text, next_text)``: each text beside that of the next larger id, the last beside the first.

    With ``own``, a column made of ``text``, also ``own`` and ``next_own``.

    Ids are integers; rows of equal id follow each other by a hash of the text,
    null ids come last, null texts are empty.  Quantiles of the ids cut the table
    into ranges; a range is ordered in one task, and its last row takes the first
    text of the next range from a table with one row per range.
    """
    base = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    base = base.withColumns({"at": F.coalesce("id", F.lit(2**63 - 1)), "key": F.xxhash64("text")})
    names = ["text"] if own is None else ["text", "own"]
    rows = docs.count()
    ranges = max(1, min(MOST_RANGES, math.ceil(rows / DOCS_PER_RANGE)))
    marks = base.agg(F.percentile_approx("at", [i / ranges for i in range(1, ranges + 1)], 10 * ranges).alias("marks")).first()
    text = ",".join(str(mark) for mark in sorted(set(marks["marks"] or [0])))
    made = base if own is None else base.withColumn("own", own)
    dealt_to = first_at_least(F.split(F.lit(text), ",").cast("array<bigint>"), F.col("at"))
    dealt = made.withColumn("range", dealt_to)

    firsts = base.withColumn("range", dealt_to).groupBy("range").agg(F.min(F.struct("at", "key")).alias("head"))
    # One row per range, at most MOST_RANGES.
    around = Window.orderBy("range")
    beginning = F.first("head").over(around.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    heads = firsts.select("range", F.coalesce(F.lead("head").over(around), beginning).alias("head"))
    same = (F.col("d.at") == F.col("h.head.at")) & (F.col("d.key") == F.col("h.head.key"))
    chosen = base.alias("d").join(F.broadcast(heads.alias("h")), same).select(F.col("h.range").alias("of_range"), F.col("d.text").alias("text"))
    chosen = chosen if own is None else chosen.withColumn("own", own)
    head_texts = chosen.groupBy("of_range").agg(*[F.first(c).alias(f"head_{c}") for c in names])
    order = Window.partitionBy("range").orderBy("at", "key")
    ordered = dealt.withColumns({f"following_{c}": F.lead(c).over(order) for c in names})
    return ordered.join(head_texts, F.col("range") == F.col("of_range"), "left").select(
        "id", *names, *[F.coalesce(f"following_{c}", f"head_{c}").alias(f"next_{c}") for c in names]
    )


def compare_pairs(pairs: DataFrame, keep_digests: bool = True) -> DataFrame:
    """What only one text of a pair has: ``(row, pair, only_left, only_right)``, digests or without ``keep_digests`` their numbers.

    ``pairs`` has ``(row, pair, left, right)``, the last two arrays of distinct
    digests; ``row`` and ``pair`` name it.  A third of a pair's table has at
    least as many cells as the pair has digests, up to the limit.  Pairs that
    stay stuck are tried again with tables four times wider; after the widest
    the arrays themselves are compared.
    """
    by, named = ["row", "pair", "width"], ["row", "pair"]
    members = F.size("left") + F.size("right")
    fitting = F.pow(F.lit(2), F.least(F.ceil(F.log2(F.greatest(members, F.lit(SLOTS)))), F.lit(PLACE_BITS))).cast("long")
    todo, done = pairs.withColumn("first", fitting), None
    for level in range(LEVELS + 1):
        width = F.least(F.col("first") * 4**level, F.lit(1 << PLACE_BITS).cast("long"))
        total = todo.agg(F.sum(members)).first()[0] or 0
        dealt = todo.withColumn("width", width).repartition(max(1, math.ceil(total / DIGESTS_PER_TASK)), "row")
        signed = [F.struct(F.lit(sign).alias("sign"), F.col(side).alias("keys")) for sign, side in ((1, "left"), (-1, "right"))]
        sides = dealt.select(*by, F.explode(F.array(*signed)).alias("side"))
        keys = sides.select(*by, F.col("side.sign").alias("sign"), F.explode("side.keys").alias("key"))
        difference = sketches(keys, by, F.col("width"), F.col("sign")).where("n <> 0 or key <> 0 or check <> 0")
        peeled = peel(difference, by, F.col("width"), keep_digests)
        left, right = [(F.col("cell") < 0) & (F.col("n") * sign > 0) for sign in (1, -1)]
        if keep_digests:
            only = [F.collect_list(F.when(side, F.col("digest"))) for side in (left, right)]
        else:
            only = [F.coalesce(F.sum(F.when(side, F.abs("n"))), F.lit(0)) for side in (left, right)]
        result = stored(
            peeled.groupBy(*by).agg(F.max(F.col("cell") >= 0).alias("stuck"), only[0].alias("only_left"), only[1].alias("only_right")).drop("width")
        )
        good = result.where("not stuck").drop("stuck")
        done = good if done is None else done.unionByName(good)
        failed = broadcast_if_small(result.where("stuck").select(*named))
        if failed.isEmpty():
            return done
        # The arrays stay where they are while the pairs to try again are few.
        todo = todo.join(failed, named, "left_semi")
    exact = [F.array_except("left", "right"), F.array_except("right", "left")]
    exact = exact if keep_digests else [F.size(x).cast("long") for x in exact]
    return done.unionByName(todo.select(*named, exact[0].alias("only_left"), exact[1].alias("only_right")))


def compare_with_edits(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", separator: str = r"\n", keep_digests: bool = True
) -> DataFrame:
    """Fingerprint every text, an edited version of it and the next text, and compare them.

    The edited version replaces the last half of the code points (rounded down)
    by the first as many of the next document.  Returns ``(id, n_chars,
    edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next,
    edited_out, edited_in)``: likeness is that of the sets of paragraph digests (lines, and runs of words of long ones),
    from the digests the sketches give back; ``edited_out`` and ``edited_in`` are
    the digests that the edit removed and added, left out without ``keep_digests``.  A fingerprint lists the cells in
    use of the smallest table, ``cell.n.key.check`` in hexadecimal.  A text without
    paragraphs has an empty table and is like another such text (1) and unlike any
    other (0).  Null texts are empty; a single document is its own next; an empty
    table gives no rows; rows that repeat follow each other and are returned as
    often; other columns are ignored; long texts are taken whole.
    """
    digests = paragraph_digests(F.col("text"), separator)
    pairs = with_next_text(docs, id_col, text_col, digests).withColumn("n_chars", F.char_length("text").cast("long"))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    edited = F.concat(F.left("text", (F.col("n_chars") - half).cast("int")), F.left("next_text", half))
    base = stored(
        pairs.withColumn("edited", edited).select(
            F.monotonically_increasing_id().alias("row"),
            "id",
            "n_chars",
            F.sha2("edited", 256).alias("edited_sha256"),
            "own",
            paragraph_digests(F.col("edited"), separator).alias("changed"),
            F.col("next_own").alias("other"),
        )
    )
    both = [("edit", "changed"), ("next", "other")]
    to_compare = base.select(
        "row",
        F.col("own").alias("left"),
        F.explode(F.array(*[F.struct(F.lit(name).alias("pair"), F.col(c).alias("right")) for name, c in both])).alias("p"),
    ).select("row", "p.pair", "left", "p.right")
    differing = compare_pairs(to_compare, keep_digests)

    total = base.agg(F.sum(F.size("own") + F.size("changed"))).first()[0] or 0
    sides = base.repartition(max(1, math.ceil(total / DIGESTS_PER_TASK)), "row").select(
        "row", F.explode(F.array(*[F.struct(F.lit(c).alias("side"), F.col(c).alias("keys")) for c in ("own", "changed")])).alias("s")
    )
    tables = sketches(sides.select("row", "s.side", F.explode("s.keys").alias("key")), ["row", "side"], F.lit(SLOTS).cast("long"), F.lit(1))
    shown = F.concat_ws(".", F.lpad(F.hex("cell"), 2, "0"), F.hex("n"), F.hex("key"), F.hex("check"))
    texts = tables.groupBy("row").agg(
        *[
            F.array_join(F.sort_array(F.collect_list(F.when(F.col("side") == c, shown))), " ").alias(name)
            for c, name in (("own", "fingerprint"), ("changed", "edited_fingerprint"))
        ]
    )

    nothing = F.array().cast("array<bigint>") if keep_digests else F.lit(0).cast("long")

    def of(pair: str, column: str) -> Column:
        return F.coalesce(F.max(F.when(F.col("pair") == pair, F.col(column))), nothing).alias(f"{pair}_{column}")

    wide = differing.groupBy("row").agg(*[of(pair, c) for pair in ("edit", "next") for c in ("only_left", "only_right")])
    sizes = base.select("row", "id", "n_chars", "edited_sha256", *[F.size(c).alias(c) for c in ("own", "changed", "other")])
    found = sizes.join(texts, "row", "left").join(wide, "row", "left")

    def apart(pair: str) -> Column:
        ends = [F.col(f"{pair}_only_{side}") for side in ("left", "right")]
        return F.coalesce(F.size(ends[0]) + F.size(ends[1]) if keep_digests else ends[0] + ends[1], F.lit(0))

    recovered = [F.coalesce(f"edit_only_{side}", nothing).alias(name) for side, name in (("left", "edited_out"), ("right", "edited_in"))]
    return found.select(
        "id",
        "n_chars",
        "edited_sha256",
        F.coalesce("fingerprint", F.lit("")).alias("fingerprint"),
        F.coalesce("edited_fingerprint", F.lit("")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("changed"), apart("edit")).alias("near_edited"),
        likeness(F.col("own"), F.col("other"), apart("next")).alias("near_next"),
        *(recovered if keep_digests else []),
    )
