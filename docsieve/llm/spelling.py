"""Spelling variants of words by a dictionary of trie-node pairs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docsieve.session import stored

#: A run of letters.
RUN = "[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Affixes longer than this stand for themselves by digest and length, so a long word's affixes stay linear in memory.
PLAIN_AFFIX = 40


def _by_shuffle(table: DataFrame) -> DataFrame:
    """``table`` as a side of a join that never goes to the driver: Spark takes an exploded table for as small as the words it comes from."""
    return table.hint("merge")


def ascii_lower(word: Column) -> Column:
    """A-Z in lower case, all else as it is; the cheaper function where both agree."""
    return F.when(word.rlike("[^\\x00-\\x7F]"), F.translate(word, UPPER, LOWER)).otherwise(F.lower(word))


def noisy_words(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    every: int = 97,
    least_length: int = 5,
    least_count: int = 3,
) -> DataFrame:
    """``(word, n)``: the corpus's words with planted slips, and how often each occurs.

    A run is lower-cased (A-Z only).  Where ``every`` divides the CRC-32 of ``<id>:<run>``, the run loses the
    code point at that number modulo its length.  Results of at least ``least_length`` code points and
    ``least_count`` occurrences stay.  Runs of a row without an id lose nothing; null and empty texts have none.
    """
    found = F.explode(F.regexp_extract_all(F.col(f"`{text_col}`"), F.lit(RUN), F.lit(0)))
    runs = docs.select(F.col(f"`{id_col}`").cast("string").alias("id"), found.alias("run"))
    # A slip only shortens a run, so short ones cannot matter.
    runs = runs.where(F.char_length("run") >= least_length).select("id", ascii_lower(F.col("run")).alias("run"))
    mark = F.crc32(F.concat(F.col("id"), F.lit(":"), F.col("run")).cast("binary"))
    at = F.pmod(F.col("mark"), F.char_length("run")).cast("int")
    cut = F.concat(F.col("run").substr(F.lit(1), at), F.col("run").substr(at + 2, F.char_length("run")))
    word = F.when(F.pmod("mark", F.lit(every)) == 0, cut).otherwise(F.col("run"))
    kept = runs.withColumn("mark", mark).select(word.alias("word")).where(F.char_length("word") >= least_length)
    return kept.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least_count)


def _affix_nodes(words: DataFrame, affix: Column, name: str) -> DataFrame:
    """``(k, name)``: the trie nodes of a word's affixes of 1, 2, ... code points.

    The distinct affixes are the nodes of the trie; they are numbered where they lie, and the root is 0.
    """
    length = F.char_length("word")
    rows = words.select("k", "word", F.explode(F.sequence(F.lit(1), length)).alias("i")).select("k", "i", affix.alias("affix"))
    short = F.when(F.col("i") <= PLAIN_AFFIX, F.col("affix")).otherwise(F.concat(F.md5(F.col("affix").cast("binary")), F.lit(":"), F.col("i")))
    rows = rows.select("k", "i", short.alias("affix"))
    nodes = stored(rows.select("affix").distinct().select("affix", (F.monotonically_increasing_id() + 1).alias("node")))
    listed = rows.join(_by_shuffle(nodes), "affix").groupBy("k").agg(F.array_sort(F.collect_list(F.struct("i", "node"))).alias("nodes"))
    return listed.select("k", F.concat(F.array(F.lit(0).cast("long")), F.col("nodes.node")).alias(name))


def near_words(words: DataFrame) -> DataFrame:
    """``(k, n, near, near_n)``: for numbered words ``(k, word, n)``, all others one code point away, both ways.

    Forward and reversed tries share a node exactly where words share a prefix or suffix.  A word without the
    code point at i is the pair (prefix node i, suffix node after i); the same pair of another word means a
    replaced code point, and the pair that a whole word has at a place between two code points means an inserted
    one.  A pair is shared by at most one word for each letter of the alphabet, and a code point of a run of
    equal ones is skipped at the run's first place only, so every link is found once.
    """
    word, length = F.col("word"), F.char_length("word")
    heads = _affix_nodes(words, word.substr(F.lit(1), F.col("i")), "heads")
    tails = _affix_nodes(words, word.substr(length - F.col("i") + 1, F.col("i")), "tails")
    root = F.array(F.lit(0).cast("bigint"))
    placed = words.join(_by_shuffle(heads), "k", "left").join(_by_shuffle(tails), "k", "left")
    # The empty word has the roots only.
    nodes = stored(placed.withColumns({side: F.coalesce(side, root) for side in ("heads", "tails")}))

    def entries(last: Column, tail: Column, first: Column) -> DataFrame:
        placed = nodes.where(last >= 0).select("k", "n", "word", "heads", "tails", F.explode(F.sequence(F.lit(0), last)).alias("i"))
        return placed.select(
            F.get("heads", F.col("i")).alias("head"), F.get("tails", tail).alias("tail"), "k", "n", first.alias("first")
        )

    i = F.col("i")
    fresh = (i == 0) | (word.substr(i + 1, F.lit(1)) != word.substr(i, F.lit(1)))
    skipped = entries(length - 1, length - 1 - i, fresh)
    whole = entries(length, length - i, F.lit(True))
    pair = ["head", "tail"]
    other = skipped.select(*pair, F.col("k").alias("near"), F.col("n").alias("near_n"))
    replaced = skipped.join(_by_shuffle(other), pair).where("k <> near").select("k", "n", "near", "near_n")
    shorter = whole.select(*pair, F.col("k").alias("near"), F.col("n").alias("near_n"))
    inserted = skipped.where("first").join(_by_shuffle(shorter), pair).select("k", "n", "near", "near_n")
    both = F.explode(
        F.array(
            F.struct("k", "n", "near", "near_n"),
            F.struct(F.col("near").alias("k"), F.col("near_n").alias("n"), F.col("k").alias("near"), F.col("n").alias("near_n")),
        )
    )
    return replaced.unionByName(inserted.select(both.alias("link")).select("link.*"))


def last_forms(forms: DataFrame) -> DataFrame:
    """``(k, root)``: from each ``k`` along ``form`` to the word without one, by doubling the steps.

    Counts at least double from a word to its form, so no chain is longer than 63 steps and six rounds settle it.
    """
    steps = stored(forms.select("k", F.coalesce("form", "k").alias("root")))
    while True:
        ahead = steps.select(F.col("k").alias("root"), F.col("root").alias("next"))
        further = stored(steps.join(_by_shuffle(ahead), "root").select("k", F.col("next").alias("root"), (F.col("next") != F.col("root")).alias("moved")))
        if not further.where("moved").limit(1).count():
            return further.select("k", "root")
        steps = further.select("k", "root")


def spelling_variants(words: DataFrame, *, word_col: str = "word", count_col: str = "n", times: int = 2) -> DataFrame:
    """``(word, n, n_near, form, form_n, root)`` of a table of distinct words and their counts.

    Two words are near when exactly one code point is inserted, deleted or replaced.  ``form`` is the near word
    of largest count, ties to the smallest in code-point order, if that count is at least ``times`` the word's own;
    else null, like ``form_n``.  ``root`` is where the forms lead, the word itself without one.  Null words are
    left out, counts of a repeated word are added up, an empty table gives no rows, other columns are ignored.
    ``times`` must be over 1, so that forms lead nowhere twice.
    """
    if times <= 1:
        raise ValueError("times must be over 1")
    counted = words.select(F.col(f"`{word_col}`").alias("word"), F.col(f"`{count_col}`").cast("long").alias("n"))
    counted = counted.where("word IS NOT NULL AND n > 0").groupBy("word").agg(F.sum("n").alias("n"))
    # Numbers rise with the words, so they break ties.
    numbered = stored(counted.orderBy("word").select(F.monotonically_increasing_id().alias("k"), "word", "n"))
    best = F.max(F.struct(F.col("near_n").alias("n"), (-F.col("near")).alias("last")))
    linked = near_words(numbered).groupBy("k", "n").agg(F.count("*").alias("n_near"), best.alias("best"))
    strong = F.col("best.n") >= times * F.col("n")
    forms = stored(
        linked.select("k", "n_near", F.when(strong, -F.col("best.last")).alias("form"), F.when(strong, F.col("best.n")).alias("form_n"))
    )
    roots = last_forms(numbered.select("k").join(_by_shuffle(forms.select("k", "form")), "k", "left"))
    spelled = numbered.select(F.col("k").alias("named"), F.col("word").alias("spelling"))
    found = numbered.join(_by_shuffle(forms), "k", "left").join(_by_shuffle(roots), "k")
    found = found.join(_by_shuffle(spelled.select(F.col("named").alias("form"), F.col("spelling").alias("form_word"))), "form", "left")
    found = found.join(_by_shuffle(spelled.select(F.col("named").alias("root"), F.col("spelling").alias("root_word"))), "root")
    return found.select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.col("form_word").alias("form"),
        "form_n",
        F.col("root_word").alias("root"),
    )
