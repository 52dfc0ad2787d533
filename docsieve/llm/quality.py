"""Quality rules: how far a document's histograms diverge from its language's."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docsieve.session import stored

#: Character classes: lower and upper case, digits, white space, sentence punctuation, other marks, all else.
CLASSES = ("lower", "upper", "digit", "space", "stop", "mark", "other")
#: Fixed values of the base measures.
SYMBOLS = "#*$%&|<>"
STOPS = ".,;:!?'\"()-"
#: Words of one task kept apart before they are passed on.
HELD_WORDS = 200_000
#: References that a task keeps unpacked.
HELD_REFERENCES = 1_000


@dataclass(frozen=True)
class QualitySettings:
    """Lengths below which a measure does not count, and the distances above which a document goes.

    ``common_words`` of every language make its word histogram, all other words
    are one more bin.  The fewer characters or words a text has, the further its
    histogram strays by chance, and so does the reference of a small language: by
    the root of one over the text's number plus one over the reference's, so that
    many ``class_spread`` and ``word_spread`` are allowed on top of the distances,
    and texts under a guard are not measured at all.
    """

    least_words: int = 50
    most_repeat_percent: int = 50
    common_words: int = 100
    class_guard: int = 200
    class_distance: float = 0.16
    class_spread: float = 2.0
    word_guard: int = 50
    word_distance: float = 0.17
    word_spread: float = 3.4


@dataclass(frozen=True)
class Reference:
    """A language's histograms, both adding up to 1, and what they were counted from."""

    words: dict[str, int]
    word_shares: list[float]
    class_shares: list[float] = field(default_factory=list)
    n_words: int = 0
    n_chars: int = 0


def _class_table():
    """The class of every code point below 0x3000."""
    import numpy as np

    table = np.full(0x3000, CLASSES.index("other"), np.uint8)
    for code in range(0x3000):
        char = chr(code)
        if char.islower():
            table[code] = CLASSES.index("lower")
        elif char.isupper():
            table[code] = CLASSES.index("upper")
        elif char.isdigit():
            table[code] = CLASSES.index("digit")
        elif char.isspace():
            table[code] = CLASSES.index("space")
        elif char in STOPS:
            table[code] = CLASSES.index("stop")
        elif not char.isalnum() and char.isprintable():
            table[code] = CLASSES.index("mark")
    return table


_tables: list = []


def class_counts(text: str):
    """How many characters of each class a text has."""
    import numpy as np

    if not _tables:
        _tables.append(_class_table())
    table, codes = _tables[0], np.frombuffer(text.encode("utf-32-le"), np.uint32)
    return np.bincount(table[np.minimum(codes, 0x2FFF)], minlength=len(CLASSES))


def base_measures(text: str) -> tuple[int, int, int, int, int]:
    """``(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words)``."""
    encoded = text.encode()
    words = encoded.split()
    blanks = sum(text.count(c) for c in " \t\n\x0b\x0c\r")
    symbols = sum(text.count(c) for c in SYMBOLS)
    duplicates = 0
    if b"\n" in encoded:
        lines = [line for line in encoded.split(b"\n") if line.strip()]
        duplicates = len(lines) - len(set(lines))
    windows = list(zip(words, words[1:], words[2:], strict=False))
    repeated = 0
    if len(set(windows)) < len(windows):
        times = Counter(windows)
        covered = bytearray(len(words))
        for i, window in enumerate(windows):
            if times[window] > 1:
                covered[i : i + 3] = b"\x01\x01\x01"
        repeated = sum(covered)
    return len(words), len(text) - blanks, symbols, duplicates, repeated


def distance(p, q) -> float:
    """Jensen-Shannon distance of two histograms that add up to 1: the root of the divergence in bits, 0 to 1."""
    import numpy as np

    p, q = np.asarray(p, float), np.asarray(q, float)
    middle = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        left = np.where(p > 0, p * np.log2(p / middle), 0.0).sum()
        right = np.where(q > 0, q * np.log2(q / middle), 0.0).sum()
    return float(np.sqrt(max(0.0, (left + right) / 2)))


def _text_and_language(docs: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    return docs.select(F.col(f"`{text_col}`").alias("text"), F.col(f"`{lang_col}`").cast("string").alias("lang"))


def language_counts(docs: DataFrame, *, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``(lang, kind, name, n)``: how often each word and character class occurs in each language, over all documents.

    Tasks add up what they read before anything is shuffled, and pass on what
    they hold whenever that is ``HELD_WORDS`` words.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str | None, Counter] = {}
        classes: dict[str | None, list[int]] = {}

        def passed_on() -> Iterator[pa.RecordBatch]:
            rows = [(lang, "word", word, n) for lang, words in held.items() for word, n in words.items()]
            rows += [(lang, "class", name, int(n)) for lang, ns in classes.items() for name, n in zip(CLASSES, ns, strict=True)]
            held.clear()
            classes.clear()
            kinds = (pa.string(), pa.string(), pa.string(), pa.int64())
            if rows:
                columns = [pa.array(list(c), k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, ["lang", "kind", "name", "n"])

        for batch in batches:
            for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if text:
                    held.setdefault(lang, Counter()).update(text.lower().split())
                    classes[lang] = class_counts(text) + classes.get(lang, 0)
            if sum(map(len, held.values())) > HELD_WORDS:
                yield from passed_on()
        yield from passed_on()

    raw = _text_and_language(docs, text_col, lang_col).mapInArrow(count, "lang string, kind string, name string, n bigint")
    marks = "".join("\\" + c for c in SYMBOLS + STOPS)
    word = F.regexp_replace("name", f"^[{marks}]+|[{marks}]+$", "")
    named = raw.withColumn("name", F.when(F.col("kind") == "word", word).otherwise(F.col("name"))).where("name <> ''")
    return named.groupBy("lang", "kind", "name").agg(F.sum("n").alias("n"))


def language_references(docs: DataFrame, settings: QualitySettings, *, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``(lang, n_words, n_chars, words, word_shares, class_shares)``: the reference of every language with words.

    ``words`` are the ``common_words`` most frequent ones; all others share the last
    of ``word_shares``.  Documents without a language have one together (null).
    """
    counts = stored(language_counts(docs, text_col=text_col, lang_col=lang_col))
    words = counts.where("kind = 'word'")
    most = Window.partitionBy("lang").orderBy(F.desc("n"), "name")
    top = words.withColumn("rank", F.row_number().over(most)).where(F.col("rank") <= settings.common_words)
    listed = top.groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("rank", "name", "n"))).alias("top"))
    sizes = words.groupBy("lang").agg(F.sum("n").alias("n_words"))
    per_class = [F.sum(F.when(F.col("name") == c, F.col("n")).otherwise(0)) / F.sum("n") for c in CLASSES]
    classes = counts.where("kind = 'class'").groupBy("lang").agg(F.sum("n").alias("n_chars"), F.array(*per_class).alias("class_shares"))
    for other in (sizes, classes):
        named = other.withColumnRenamed("lang", "other_lang")
        listed = listed.join(named, F.col("lang").eqNullSafe(F.col("other_lang"))).drop("other_lang")
    shares = F.transform("top", lambda w: w["n"] / F.col("n_words"))
    listed = listed.withColumns({"words": F.col("top")["name"], "shares": shares})
    rest = F.greatest(F.lit(0.0), 1 - F.aggregate("shares", F.lit(0.0), lambda total, x: total + x))
    return stored(
        listed.select("lang", "n_words", "n_chars", "words", F.concat("shares", F.array(rest)).alias("word_shares"), "class_shares")
    )


def named_words(text: str) -> Counter:
    """How often each word of a text occurs, in lower case and without marks around it."""
    names: Counter = Counter()
    for word, n in Counter(text.lower().split()).items():
        name = word.strip(SYMBOLS + STOPS)
        if name:
            names[name] += n
    return names


def nearest_languages(docs: DataFrame, references: DataFrame, *, text_col: str = "text") -> DataFrame:
    """``(key, near_lang)``: the language whose common words are nearest to each text, by the MD5 of the text.

    The divergence from every language is added up from the words that the text
    shares with it, so no task needs all languages: a bin that the text lacks adds
    half its share, and words outside the common ones are one more bin.  Of equally
    near ones the first by name counts; texts that share no word with any take the
    language with the largest rest.
    """
    text = F.col(f"`{text_col}`")
    texts = docs.where(text.isNotNull()).select(F.md5(text).alias("key"), text.alias("text")).dropDuplicates(["key"])

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, value in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                names = named_words(value.as_py())
                total = sum(names.values())
                columns = [[key] * len(names), list(names), [n / total for n in names.values()]]
                kinds = (pa.string(), pa.string(), pa.float64())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["key", "name", "p"])

    shares = texts.mapInArrow(spread, "key string, name string, p double")
    known = references.select("lang", F.element_at("word_shares", -1).alias("rest"), F.explode(F.arrays_zip("words", F.slice("word_shares", F.lit(1), F.size("words")).alias("q"))).alias("w"))
    known = known.select("lang", "rest", F.col("w.words").alias("name"), F.col("w.q").alias("q"))

    def term(p: Column, q: Column) -> Column:
        return sum(F.when(x > 0, x * F.log2(2 * x / (p + q))).otherwise(0.0) for x in (p, q)) / 2

    p, q = F.col("p"), F.col("q")
    added = shares.join(known, "name").groupBy("key", "lang").agg(
        F.sum(term(p, q)).alias("shared"), F.sum(p).alias("p"), F.sum(q).alias("q"), F.first("rest").alias("rest")
    )
    left = F.greatest(F.lit(0.0), 1 - p)
    far = F.col("shared") + F.greatest(F.lit(0.0), 1 - F.col("rest") - q) / 2 + term(left, F.col("rest"))
    near = added.groupBy("key").agg(F.min(F.struct(far.alias("far"), "lang"))["lang"].alias("near"))
    widest = references.agg(F.min(F.struct(-F.element_at("word_shares", -1), "lang"))["lang"].alias("widest"))
    found = texts.select("key").join(near, "key", "left").crossJoin(F.broadcast(widest))
    return found.select("key", F.coalesce("near", "widest").alias("near_lang"))


def with_references(docs: DataFrame, settings: QualitySettings, *, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The documents and, as the last column, the row of ``language_references`` that each is held against.

    That of its language, however small, or where the language is null that of
    the nearest language.  If no document has a language there is none, and the
    distances are left out: those to a mix of languages would reject clean texts.
    """
    name = "__reference"
    while name in docs.columns:
        name += "_"
    references = language_references(docs, settings, text_col=text_col, lang_col=lang_col).where("lang is not null")
    packed = references.select(F.col("lang").alias("__lang"), F.struct(*references.columns).alias(name))
    # The row is boxed, so that its columns may have any names.
    boxed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"))
    lang = F.col("__row")[lang_col].cast("string")
    shown = [*[F.col("__row")[c].alias(c) for c in docs.columns], F.col(name)]
    if references.isEmpty():
        return boxed.join(packed, lang == F.col("__lang"), "left").select(*shown)
    unnamed = docs.where(F.col(f"`{lang_col}`").isNull())
    if unnamed.isEmpty():
        return boxed.join(packed, lang == F.col("__lang"), "left").select(*shown)
    named = boxed.where(lang.isNotNull()).join(packed, lang == F.col("__lang"), "left").select(*shown)
    near = nearest_languages(unnamed, references, text_col=text_col)
    matched = boxed.where(lang.isNull()).join(near, F.md5(F.col("__row")[text_col]) == F.col("key"), "left")
    return named.unionByName(matched.join(packed, F.col("near_lang") == F.col("__lang"), "left").select(*shown))


def _references_of(batch: pa.RecordBatch, at: int, seen: dict[str | None, Reference]) -> Iterator[Reference | None]:
    """The reference of each row; ``seen`` keeps those of the languages met so far."""
    packed = batch.column(at)
    langs, valid = packed.field("lang").to_pylist(), packed.is_valid().to_pylist()
    for i, lang in enumerate(langs):
        if not valid[i]:
            yield None
            continue
        if lang not in seen:
            if len(seen) >= HELD_REFERENCES:
                seen.clear()
            row = packed[i].as_py()
            places = {word: place for place, word in enumerate(row["words"])}
            seen[lang] = Reference(places, row["word_shares"], row["class_shares"], row["n_words"], row["n_chars"])
        yield seen[lang]


def divergences(text: str, n_words: int, reference: Reference) -> tuple[float, float]:
    """The distances of a text's character classes and common words from a reference."""
    counts = class_counts(text)
    by_class = distance(counts / counts.sum(), reference.class_shares)
    bins = [0] * len(reference.word_shares)
    place, total = reference.words, 0
    for name, n in named_words(text).items():
        bins[place.get(name, -1)] += n
        total += n
    if not total:
        return by_class, 1.0
    return by_class, distance([n / total for n in bins], reference.word_shares)


MEASURES = (
    "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, "
    "class_divergence double, word_divergence double, base_failed boolean, kept boolean"
)


def judge(text: str | None, reference: Reference | None, settings: QualitySettings) -> tuple:
    """The values of ``MEASURES`` for one document."""
    text = text or ""
    measures = base_measures(text)
    n_words, repeated = measures[0], measures[4]
    failed = n_words < settings.least_words or 100 * repeated > settings.most_repeat_percent * n_words
    by_class = by_word = None
    if n_words and reference is not None:
        by_class, by_word = divergences(text, n_words, reference)
    far = False
    if by_class is not None and len(text) >= settings.class_guard:
        far = by_class > settings.class_distance + settings.class_spread * math.sqrt(1 / len(text) + 1 / reference.n_chars)
    if by_word is not None and n_words >= settings.word_guard:
        far = far or by_word > settings.word_distance + settings.word_spread * math.sqrt(1 / n_words + 1 / reference.n_words)
    return (*measures, by_class, by_word, failed, not failed and not far)


def judged(docs: DataFrame, settings: QualitySettings | None = None, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``(id, *MEASURES)`` of every document.

    The base rules reject documents under ``least_words`` words and those of which
    more than ``most_repeat_percent`` % of the words lie in repeated three-word
    windows.  The others are kept unless the histogram of their character classes
    or of their language's common words is further than the settings allow from
    that of all documents of the language, by Jensen-Shannon distance; a measure
    counts only for texts as long as its guard, and the allowance falls with the
    root of the length.  Null texts are empty and fail.  Every language has its own
    reference; null ones are held against the nearest of all languages, and where no
    document has a language the base rules alone decide.  Rows that repeat
    are returned as often; an empty table gives no rows; other columns are ignored.
    """
    settings = settings or QualitySettings()
    base = docs.select(
        F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"), F.col(f"`{lang_col}`").cast("string").alias("lang")
    )
    chosen = with_references(base, settings)
    names = ["id", *[part.split()[0] for part in MEASURES.split(", ")]]
    kinds = [{"bigint": pa.int64(), "double": pa.float64(), "boolean": pa.bool_()}[part.split()[1]] for part in MEASURES.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str | None, Reference] = {}
        for batch in batches:
            rows = [
                judge(text.as_py(), reference, settings)
                for text, reference in zip(batch.column(1), _references_of(batch, 3, seen), strict=True)
            ]
            columns = zip(*rows, strict=True) if rows else [()] * len(kinds)
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)]], names)

    return chosen.mapInArrow(run, f"id {chosen.schema['id'].dataType.simpleString()}, {MEASURES}")


def kept_documents(docs: DataFrame, settings: QualitySettings | None = None, *, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The documents that ``judged`` keeps, with all their columns."""
    settings = settings or QualitySettings()
    at_text, width, schema = docs.columns.index(text_col), len(docs.columns), docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str | None, Reference] = {}
        for batch in batches:
            keep = [
                judge(text.as_py(), reference, settings)[-1]
                for text, reference in zip(batch.column(at_text), _references_of(batch, width, seen), strict=True)
            ]
            yield batch.select(list(range(width))).filter(pa.array(keep, pa.bool_()))

    return with_references(docs, settings, text_col=text_col, lang_col=lang_col).mapInArrow(run, schema)
