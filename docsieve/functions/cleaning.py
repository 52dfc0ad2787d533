"""Text normalisation as one column expression."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from docsieve.functions import patterns as P


@dataclass(frozen=True)
class CleaningSettings:
    """Switches of the normalisation steps, in the order the steps run."""

    remove_html_tags: bool = True
    remove_urls: bool = True
    remove_emails: bool = True
    remove_digits: bool = True
    remove_non_alphanumeric: bool = True
    preserve_structure_markers: bool = False
    use_lemmatization: bool = True
    use_stemming_fallback: bool = False
    extra_stop_words: frozenset[str] = frozenset()
    stop_words: tuple[str, ...] = P.ENGLISH_STOP_WORDS


CLUSTERING_SETTINGS = CleaningSettings(extra_stop_words=frozenset(P.WEB_STOP_WORDS))
ANOMALY_SETTINGS = CleaningSettings(
    remove_html_tags=False,
    remove_urls=False,
    remove_emails=False,
    remove_digits=False,
    remove_non_alphanumeric=False,
    preserve_structure_markers=True,
    use_lemmatization=False,
)


def expand_contractions(text: Column) -> Column:
    for short, long in P.CONTRACTIONS:
        text = F.replace(text, F.lit(short), F.lit(long))
    return text


def scrub(text: Column, settings: CleaningSettings) -> Column:
    """Lowercase, expand contractions and blank out what the switches name."""
    text = expand_contractions(F.lower(text))
    removals = [
        (settings.remove_html_tags, P.HTML_TAG),
        (settings.remove_urls, P.URL),
        (settings.remove_emails, P.EMAIL),
        (settings.remove_digits, P.DIGIT_TOKEN),
        (settings.remove_non_alphanumeric and not settings.preserve_structure_markers, P.NOT_LETTER),
    ]
    for wanted, pattern in removals:
        if wanted:
            text = F.regexp_replace(text, pattern, " ")
    return text


def clean_tokens(text: Column, settings: CleaningSettings) -> Column:
    """Word tokens, then symbol tokens when kept, without stop words; no morphology."""
    scrubbed = scrub(text, settings)
    tokens = F.regexp_extract_all(scrubbed, F.lit(P.LETTER_TOKEN), F.lit(0))
    if settings.preserve_structure_markers:
        tokens = F.concat(tokens, F.regexp_extract_all(scrubbed, F.lit(P.SYMBOL), F.lit(0)))
    stop_words = sorted(set(settings.stop_words) | settings.extra_stop_words)
    return F.filter(tokens, lambda token: ~token.isin(stop_words)) if stop_words else tokens


def strip_plural(token: Column) -> Column:
    """The plural rule used when no lemma table is given; symbols pass unchanged."""
    ies = token.endswith("ies") & (F.length(token) > 4)
    s = token.endswith("s") & ~token.endswith("ss") & (F.length(token) > 3)
    return (
        F.when(ies, F.concat(F.substring(token, F.lit(1), F.length(token) - 3), F.lit("y")))
        .when(s, F.substring(token, F.lit(1), F.length(token) - 1))
        .otherwise(token)
    )


def normalize(text: Column, settings: CleaningSettings) -> Column:
    """One normalised text value, with the built-in plural rule as morphology.

    Lemma tables and stemmers, the fallback too, need a join and live in
    :func:`docsieve.operators.normalize.normalize_with_lexicon`.
    """
    if settings.use_stemming_fallback:
        raise ValueError("Stems need a join; use normalize_with_lexicon or text_views.")
    tokens = clean_tokens(text, settings)
    if settings.use_lemmatization:
        tokens = F.transform(tokens, strip_plural)
    return F.array_join(F.filter(tokens, lambda token: token != ""), " ")


def snippet(text: Column, length: int) -> Column:
    """The first ``length`` characters on one line."""
    return F.replace(F.substring(text, 1, length), F.lit("\n"), F.lit(" "))
