"""Expressions over a list column that stay inside one row, so they never shuffle."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it many times inside ``body``.

    Spark re-evaluates an expression for every element when a lambda refers to
    it from outside; a lambda variable is read from its slot instead.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def count_items(items: Column) -> Column:
    """``array<struct<term, tf>>`` of the distinct items, sorted by term.

    Sorting brings equal items together; each run start is kept and its length
    is the distance to the next start.
    """

    def runs(ordered: Column) -> Column:
        starts = F.filter(
            F.sequence(F.lit(1), F.size(ordered)),
            lambda i: (i == 1) | (F.get(ordered, i - 1) != F.get(ordered, i - 2)),
        )
        return bind(
            starts,
            lambda begin: F.transform(
                begin,
                lambda start, nth: F.struct(
                    F.get(ordered, start - 1).alias("term"),
                    (F.coalesce(F.get(begin, nth + 1), F.size(ordered) + 1) - start).alias("tf"),
                ),
            ),
        )

    def counted(ordered: Column) -> Column:
        return F.when(F.size(ordered) > 0, runs(ordered)).otherwise(
            F.expr("cast(array() as array<struct<term:string,tf:int>>)")
        )

    return bind(F.sort_array(items), counted)


def _joined(words: list[Column]) -> Column:
    parts = [part for word in words for part in (F.lit(" "), word)]
    return F.concat(*parts[1:])


def word_ngrams(words: Column, smallest: int, largest: int) -> Column:
    """All n-grams of ``smallest..largest`` neighbouring words, joined by one space."""

    def of_size(bound: Column, n: int) -> Column:
        if n == 1:
            return bound
        places = F.when(F.size(bound) >= n, F.sequence(F.lit(1), F.size(bound) - (n - 1))).otherwise(
            F.expr("cast(array() as array<int>)")
        )
        return F.transform(places, lambda i: _joined([F.get(bound, i + (j - 1)) for j in range(n)]))

    def grams(bound: Column) -> Column:
        return F.concat(*[of_size(bound, n) for n in range(smallest, largest + 1)])

    return grams(words) if (smallest, largest) == (1, 1) else bind(words, grams)


def char_wb_ngrams(words: Column, smallest: int, largest: int) -> Column:
    """Character n-grams inside words padded by one space on each side.

    A padded word shorter than n gives one gram, the whole padded word, and the
    larger sizes are skipped for it.
    """

    def of_word(word: Column) -> Column:
        def of_padded(padded: Column) -> Column:
            sizes = F.filter(
                F.sequence(F.lit(smallest), F.lit(largest)),
                lambda n: (n == smallest) | (n <= F.length(padded)),
            )
            return F.flatten(
                F.transform(
                    sizes,
                    lambda n: F.transform(
                        F.sequence(F.lit(1), F.greatest(F.length(padded) - n, F.lit(0)) + 1),
                        lambda i: F.substring(padded, i, n),
                    ),
                )
            )

        return bind(F.concat(F.lit(" "), word, F.lit(" ")), of_padded)

    return F.flatten(F.transform(words, of_word))


def longest_run(items: Column) -> Column:
    """Length of the longest run of equal neighbours; 0 for an empty list."""

    def measure(bound: Column) -> Column:
        starts = F.filter(
            F.sequence(F.lit(1), F.size(bound)),
            lambda i: (i == 1) | (F.get(bound, i - 1) != F.get(bound, i - 2)),
        )
        return bind(
            starts,
            lambda begin: F.array_max(
                F.transform(
                    begin, lambda start, nth: F.coalesce(F.get(begin, nth + 1), F.size(bound) + 1) - start
                )
            ),
        )

    return bind(items, lambda bound: F.when(F.size(bound) > 0, measure(bound)).otherwise(F.lit(0)))
