"""Cleaning, language, tokens: ``Column -> Column``, all inside the JVM."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import patterns as P


def clean_comment(text: Column) -> Column:
    """Comment text without tags, links, mentions, titles, emoji and symbols.

    Every run of characters outside letters, digits and basic punctuation (so
    also of blanks) becomes one blank; null becomes the empty string.
    """
    raw = F.coalesce(text.cast("string"), F.lit(""))
    kept = F.when(raw.contains("["), F.regexp_replace(raw, P.BRACKETED, "")).otherwise(raw)
    noisy = kept.rlike(P.NOISE_SYMBOLS)
    for mark in P.NOISE_MARKS:
        noisy = kept.contains(mark) | noisy
    kept = F.when(noisy, F.regexp_replace(kept, P.NOISE, "")).otherwise(kept)
    return F.trim(F.regexp_replace(kept, P.NOT_KEPT, " "))


def normalize_space(text: Column) -> Column:
    """Zero-width blanks dropped, every blank run one space, ends trimmed."""
    shown = F.replace(F.coalesce(text.cast("string"), F.lit("")), F.lit("\u200b"), F.lit(""))
    return F.trim(F.regexp_replace(shown, f"[{P.SPACE}]+", " "))


def cjk_count(text: Column) -> Column:
    return F.length(F.regexp_replace(text, f"[^{P.CJK}]+", ""))


def latin_letter_count(text: Column) -> Column:
    """Letters that stand in Latin words of two letters or more."""
    return F.length(text) - F.length(F.regexp_replace(text, P.LATIN_WORD, ""))


def has_cjk(text: Column) -> Column:
    return text.rlike(f"[{P.CJK}]")


def detect_language(text: Column) -> Column:
    """``zh``, ``en`` or ``other`` by the amounts of CJK and Latin characters.

    Exact counts are taken only of texts with two CJK characters; the tests
    before and after stop at the first characters that decide.
    """
    text = F.coalesce(text, F.lit(""))
    mostly_cjk = cjk_count(text) >= latin_letter_count(text) * F.lit(0.3)
    return (
        F.when(text.rlike(P.TWO_CJK) & mostly_cjk, "zh")
        .when(text.rlike(P.EIGHT_LATIN_LETTERS) & text.rlike(P.TWO_LATIN_WORDS), "en")
        .otherwise("other")
    )


def detect_language_simple(text: Column) -> Column:
    """``zh`` on any CJK character, ``en`` on plain ASCII prose, else ``other``."""
    text = F.coalesce(text, F.lit(""))
    return F.when(has_cjk(text), "zh").when(text.rlike(P.PLAIN_ENGLISH), "en").otherwise("other")


def english_tokens(text: Column, stopwords: Iterable[str]) -> Column:
    """Lower-case words of three letters or more that are not stop words.

    Order and repeats stay, as later counts need them.
    """
    words = F.regexp_extract_all(F.lower(text), F.lit(P.ENGLISH_TOKEN), F.lit(0))
    stop = sorted(set(stopwords))
    return F.filter(words, lambda w: ~w.isin(stop)) if stop else words


def lexicon_words(text: Column) -> Column:
    """All Latin words of a text, lower case, in order."""
    return F.regexp_extract_all(F.lower(text), F.lit(P.LEXICON_WORD), F.lit(0))


def distinct_words(text: Column) -> Column:
    return F.array_distinct(lexicon_words(text))


def vector_terms(tokens: Column) -> Column:
    """Tokens joined and split again on word characters, for the term vectors.

    Words with an apostrophe or a hyphen fall apart here.
    """
    joined = F.lower(F.array_join(tokens, " "))
    return F.regexp_extract_all(joined, F.lit(f"[{P.WORD}]+"), F.lit(0))


def stored_tokens(value: Column) -> Column:
    """Token list read back from CSV text: a list literal, else blank-split text.

    Null and single literals (a number, a quoted text) give null, so that the
    row is left out. The text is parsed as data and never evaluated.
    """
    parsed = F.from_json(value, "array<string>")
    single = value.rlike(
        r"""^\s*(?:[-+]?\d+(?:\.\d*)?|'[^']*'|"[^"]*"|True|False|None)\s*$"""
    )
    split = F.filter(F.split(value, f"[{P.SPACE}]+"), lambda w: w != "")
    return (
        F.when(value.isNull() | single, F.lit(None))
        .when(value.rlike(r"^\s*\[") & parsed.isNotNull(), parsed)
        .otherwise(split)
    )


def keep_tagged(pairs: Column, tags: Iterable[str]) -> Column:
    """Of ``array<struct<word,tag>>`` keep entries whose tag starts with one of ``tags``."""
    shortest = [t for t in tags if not any(t != u and t.startswith(u) for u in tags)]
    pattern = "^(?:" + "|".join(P.quote(t) for t in sorted(set(shortest))) + ")"
    return F.filter(pairs, lambda p: p["tag"].rlike(pattern))
