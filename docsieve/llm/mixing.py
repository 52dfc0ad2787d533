"""Mixing sources to target weights by Sainte-Laguë apportionment of equal-token blocks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docsieve.llm.common import bucket_bits, running_total, word_count
from docsieve.session import stored


#: Words of a block at most, and blocks of the smallest source at least: a source misses its target by a block or two.
MOST_BLOCK_WORDS, LEAST_BLOCKS = 32, 50


def source_targets(
    sizes: DataFrame, weights: Sequence[float] = (3.0, 1.0, 2.0), share: float = 1.5, most: float = 2.0
) -> DataFrame:
    """``(source, source_size, target)`` from ``(source, size)`` rows.

    Sources in code-point order, null last, take ``weights`` in turn and share
    ``share`` times all sizes by weight.  A target stops at ``most`` times its
    source's size; the excess is shared again by weight until none is above.
    That fixed point has a closed form: in order of cap per weight, a source is
    capped when its cap is at most what its weight would get of the budget the
    earlier ones leave.  The table has one row per source.
    """
    if most < share:
        raise ValueError("the sources cannot fill the share: most must be at least share")
    totals = sizes.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (place % len(weights) + 1).cast("int"))
    ranked = totals.withColumn("weight", weight).withColumn("cap", most * F.col("source_size"))
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    order = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    spread = (
        ranked.withColumn("budget", share * F.sum("source_size").over(everything))
        .withColumn("cap_before", F.coalesce(F.sum("cap").over(earlier), F.lit(0.0)))
        .withColumn("weight_left", F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(earlier), F.lit(0.0)))
        .withColumn("level", (F.col("budget") - F.col("cap_before")) / F.col("weight_left"))
        .withColumn("capped", F.col("cap") <= F.col("weight") * F.col("level"))
    )
    level = F.min(F.when(~F.col("capped"), F.struct(F.col("cap") / F.col("weight"), "level"))).over(everything)["level"]
    target = F.when(F.col("capped"), F.col("cap")).otherwise(F.col("weight") * F.col("open_level"))
    return spread.withColumn("open_level", level).select("source", "source_size", target.cast("double").alias("target"))


def apportion(targets: DataFrame, block_words: int, shards: int, most: int = 2) -> DataFrame:
    """Integer block quotas per source and shard by highest quotients.

    Shard j holds the seats after those of the shards before it, in the order
    of the quotients ``target / (2 seats + 1)``.  The method is monotone in the
    number of seats, so a shard's quotas are the differences of two cumulative
    apportionments.  For a cumulative number of seats ``n`` every source starts
    at its rounded share, which takes all quotients above one divisor; the
    surplus or lack ``d`` over all sources is settled among the ``d`` nearest
    quotients of each.  A source has at most ``most`` seats per block.  Returns
    ``(source, shard, quota, quota_before)``; sources times shards rows.
    """
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    sources = (
        targets.withColumn("blocks", F.ceil(F.col("source_size") / block_words))
        .withColumn("all", F.sum("target").over(everything))
        .withColumn("seats", F.least(F.round(F.col("all") / block_words), most * F.sum("blocks").over(everything)).cast("long"))
        .withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
        .withColumn("upto", F.floor(F.col("seats") * (F.col("shard") + 1) / shards))
    )
    shard = Window.partitionBy("shard")
    limit = most * F.col("blocks")
    started = (
        sources.withColumn("share", F.when(F.col("all") > 0, F.col("target") * F.col("upto") / F.col("all")).otherwise(0.0))
        .withColumn("base", F.least(F.floor(F.col("share") + 0.5), limit).cast("long"))
        .withColumn("missing", F.col("upto") - F.sum("base").over(shard))
    )
    step = F.abs("missing")
    first = F.greatest(F.lit(0), F.col("base") - step)
    last = F.least(limit, F.col("base") + step) - 1
    near = started.withColumn("seat", F.explode(F.when(last >= first, F.sequence(first, last)).otherwise(F.array().cast("array<bigint>"))))
    fixed = F.greatest(F.lit(0), F.col("base") - F.abs("missing"))
    # Of the seats near the edge, the shard still has those that the untouched ones leave.
    taken_for_sure = started.groupBy("shard").agg(F.sum(fixed).alias("sure"))
    quotient = F.col("target") / (2 * F.col("seat") + 1)
    ranked = near.join(taken_for_sure, "shard").withColumn(
        "rank", F.row_number().over(shard.orderBy(quotient.desc(), F.col("source").asc_nulls_last(), "seat"))
    )
    won = ranked.where(F.col("rank") <= F.col("upto") - F.col("sure")).groupBy("shard", "source").agg(F.count("*").alias("won"))
    found = started.withColumn("fixed", fixed).alias("s").join(
        won.alias("w"), (F.col("s.shard") == F.col("w.shard")) & F.col("s.source").eqNullSafe(F.col("w.source")), "left"
    )
    total = found.select(
        "s.source", "s.shard", (F.col("fixed") + F.coalesce("won", F.lit(0))).cast("long").alias("upto_here")
    )
    before = F.coalesce(F.lag("upto_here").over(Window.partitionBy("source").orderBy("shard")), F.lit(0))
    return total.withColumn("quota_before", before).select(
        "source", "shard", (F.col("upto_here") - F.col("quota_before")).alias("quota"), "quota_before"
    )


def mix_sources(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: Sequence[float] = (3.0, 1.0, 2.0),
    share: float = 1.5,
    most: int = 2,
    block_words: int | None = None,
    shards: int = 16,
    seed: int = 42,
) -> DataFrame:
    """Choose the words a mix takes of every document; one row per document.

    Each source's documents are put in a seeded order and their words form one
    stream, cut into blocks of ``block_words`` words (the last may be shorter); if not
    given, of ``MOST_BLOCK_WORDS`` or so many fewer that the smallest source has ``LEAST_BLOCKS``.
    ``apportion`` gives every shard an integer number of the source's blocks.
    The seats of a source, in shard order, take its blocks from a seeded first
    block on, around the stream and again, so that runs of blocks keep
    documents whole and a block is taken at most ``most`` times.

    Returns ``(id, text_key, size, source, source_size, target, taken, runs)``:
    ``runs`` lists ``(pass, shard, start, length)``, the words ``start`` to
    ``start + length`` of the document that the shard takes in that pass.
    ``text_key`` is the XXH64 of the text.  Null texts have no words; rows equal
    in id, source and text are interchangeable; a null source is a source of its
    own, the last; an empty table gives no rows.  Other columns are ignored.
    """
    base = stored(
        docs.select(
            F.col(id_col).alias("id"),
            F.xxhash64(F.col(text_col)).alias("text_key"),
            word_count(F.col(text_col)).alias("size"),
            F.col(source_col).alias("source"),
        )
    )
    targets = stored(source_targets(base, weights, share, most))
    if block_words is None:
        smallest = targets.where("source_size > 0").agg(F.min("source_size")).first()[0] or 1
        block_words = max(1, min(MOST_BLOCK_WORDS, smallest // LEAST_BLOCKS))
    quotas = apportion(targets, block_words, shards, most)
    per_source = quotas.groupBy("source").agg(
        F.array_sort(F.collect_list(F.struct("shard", F.col("quota_before").alias("low"), (F.col("quota_before") + F.col("quota")).alias("high")))).alias("seats")
    )
    plan = targets.alias("t").join(per_source.alias("q"), F.col("t.source").eqNullSafe(F.col("q.source"))).select(
        F.col("t.source").alias("plan_source"),
        "source_size",
        "target",
        "seats",
        F.ceil(F.col("source_size") / block_words).alias("blocks"),
        F.pmod(F.xxhash64(F.lit(seed), "t.source"), F.greatest(F.lit(1), F.ceil(F.col("source_size") / block_words))).alias("first_block"),
    )
    hashed = base.withColumn("order", F.xxhash64(F.lit(seed), "id", "text_key"))
    streamed = running_total(hashed, ["source"], "order", ["id", "text_key", "size"], F.col("size"), "start", bucket_bits(base.count()))
    # One row per source: sent to all tasks only while Spark's own measured size allows it.
    joined = streamed.join(plan, F.col("source").eqNullSafe(F.col("plan_source")))
    block = F.lit(block_words)
    origin = F.col("first_block") * block
    end = F.col("start") + F.col("size")

    def runs(turn: int, wrapped: bool) -> Column:
        # A pass takes places from the first block on: up to the stream's end, then (wrapped) from its start.
        left = F.col("blocks") - F.col("first_block")

        def run(seat: Column) -> Column:
            low = F.greatest(seat["low"] - F.lit(turn) * F.col("blocks"), F.lit(0))
            high = F.least(seat["high"] - F.lit(turn) * F.col("blocks"), F.col("blocks"))
            if wrapped:
                a, b = F.greatest(low - left, F.lit(0)) * block, (high - left) * block
            else:
                a, b = origin + low * block, origin + F.least(high, left) * block
            a, b = F.greatest(a, F.col("start")), F.least(b, end)
            return F.struct(
                F.lit(turn).alias("pass"),
                seat["shard"].alias("shard"),
                (a - F.col("start")).cast("long").alias("start"),
                F.greatest(b - a, F.lit(0)).cast("long").alias("length"),
            )

        return F.transform("seats", run)

    found = F.concat(*[runs(turn, wrapped) for turn in range(most) for wrapped in (False, True)])
    kept = F.filter(found, lambda run: run["length"] > 0)
    taken = F.aggregate("runs", F.lit(0).cast("long"), lambda total, run: total + run["length"])
    return joined.withColumn("runs", kept).select(
        "id", "text_key", "size", "source", "source_size", "target", taken.alias("taken"), "runs"
    )


def cut_words(text: Column, start: Column, length: Column) -> Column:
    """Words ``start`` to ``start + length`` of a text, with the white space between them as it was."""
    pieces = F.split(F.regexp_replace(text, r"^[\x20\x09-\x0D]+", ""), r"(?<=[\x20\x09-\x0D])(?=[^\x20\x09-\x0D])")
    cut = F.array_join(F.slice(pieces, (start + 1).cast("int"), length.cast("int")), "")
    return F.regexp_replace(cut, r"[\x20\x09-\x0D]+$", "")


def mixed_documents(
    docs: DataFrame,
    runs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    count_col: str = "n_chars",
) -> DataFrame:
    """The documents as the mix reads them, with the columns of ``docs``.

    One row for each pass and run of words; runs that adjoin across shards are
    one.  A document taken whole keeps its text unchanged; of one taken in part
    the text holds the words taken, and ``count_col``, if there is one, their
    characters.  Documents the mix does not take are left out.  Rows equal in
    id, source and text all get the runs of the one of which most is taken.
    """
    ordered = F.array_sort(F.transform("runs", lambda r: F.struct(r["pass"], r["start"], r["length"])))

    def merge(done: Column, run: Column) -> Column:
        last = F.get(done, F.size(done) - 1)
        adjoins = (F.size(done) > 0) & (last["pass"] == run["pass"]) & (last["start"] + last["length"] == run["start"])
        grown = F.struct(run["pass"].alias("pass"), last["start"].alias("start"), (last["length"] + run["length"]).alias("length"))
        shorter = F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0)))
        return F.when(adjoins, F.concat(shorter, F.array(grown))).otherwise(F.concat(done, F.array(run)))

    merged = F.aggregate(ordered, F.array().cast("array<struct<pass:int,start:bigint,length:bigint>>"), merge)
    chosen = (
        runs.groupBy(F.col("id").alias("__id"), F.col("text_key").alias("__key"), F.col("source").alias("__source"))
        .agg(F.max(F.struct("taken", "size", merged.alias("merged"))).alias("__plan"))
        .where(F.col("__plan")["taken"] > 0)
    )
    # The row is boxed, so that its columns may have any names.
    boxed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"))
    row = F.col("__row")
    matched = boxed.join(
        chosen,
        row[id_col].eqNullSafe(F.col("__id")) & (F.xxhash64(row[text_col]) == F.col("__key")) & row[source_col].eqNullSafe(F.col("__source")),
    )
    each = matched.withColumn("__run", F.explode(F.col("__plan")["merged"]))
    whole = (F.col("__run")["start"] == 0) & (F.col("__run")["length"] == F.col("__plan")["size"])
    text = F.when(whole, row[text_col]).otherwise(cut_words(row[text_col], F.col("__run")["start"], F.col("__run")["length"]))
    cut = each.withColumn("__text", text)
    out = []
    for c in docs.columns:
        if c == text_col:
            out.append(F.col("__text").alias(c))
        elif c == count_col:
            out.append(F.when(whole, row[c]).otherwise(F.char_length("__text")).cast(docs.schema[c].dataType).alias(c))
        else:
            out.append(row[c].alias(c))
    return cut.select(*out)
