"""Sentiment scores and labels as column expressions."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed_values as V
from .text import detect_language


def clip_unit(score: Column) -> Column:
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), score))


def lexicon_hits(words: Column, lexicon: Iterable[str]) -> Column:
    """Distinct lexicon words among the words of a row (the intersection has no repeats)."""
    return F.size(F.array_intersect(words, F.array(*[F.lit(w) for w in sorted(set(lexicon))])))


def contains_any(text: Column, words: Iterable[str]) -> Column:
    """The text contains one of the words; for short lists (each is one byte search)."""
    found = F.lit(False)
    for word in dict.fromkeys(words):
        found = found | text.contains(word)
    return found


def lexicon_polarity(words: Column, lexicon: Mapping[str, float]) -> Column:
    """Mean polarity of the lexicon words among the words of a row, 0 without any."""
    values = F.create_map(*[F.lit(x) for word, value in sorted(lexicon.items()) for x in (word, float(value))])
    hits = F.filter(words, lambda w: w.isin(sorted(lexicon)))
    mean = F.aggregate(
        F.transform(hits, lambda w: values[w]),
        F.struct(F.lit(0.0).alias("sum"), F.lit(0).alias("n")),
        lambda acc, x: F.struct((acc["sum"] + x).alias("sum"), (acc["n"] + 1).alias("n")),
        lambda acc: F.when(acc["n"] > 0, acc["sum"] / acc["n"]).otherwise(0.0),
    )
    return F.coalesce(mean, F.lit(0.0))


def english_score(
    words: Column,
    polarity: Column,
    positive: Iterable[str] = V.POSITIVE_EN,
    negative: Iterable[str] = V.NEGATIVE_EN,
) -> Column:
    """Polarity on a 0..1 scale, moved up and then down by lexicon hits."""
    base = F.coalesce((polarity + 1) / 2, F.lit(0.5))
    up = F.least(F.lit(0.2), lexicon_hits(words, positive) * F.lit(0.06))
    down = F.least(F.lit(0.25), lexicon_hits(words, negative) * F.lit(0.06))
    raised = F.when(up > 0, F.least(F.lit(1.0), base + up)).otherwise(base)
    lowered = F.when(down > 0, F.greatest(F.lit(0.0), raised - down)).otherwise(raised)
    return clip_unit(lowered)


def substring_score(
    text: Column,
    base: Column,
    positive: Iterable[str] = V.POSITIVE_ZH,
    negative: Iterable[str] = V.NEGATIVE_ZH,
    negations: Iterable[str] = V.NEGATIONS_ZH,
) -> Column:
    """``moved_score`` by the words that the text contains, for lists given in code."""
    return moved_score(base, contains_any(text, positive), contains_any(text, negative), contains_any(text, negations))


def moved_score(base: Column, positive: Column, negative: Column, negated: Column) -> Column:
    """Base score raised once, lowered once, then damped by a negation, in this order."""
    raised = F.when(positive, F.least(F.lit(1.0), base + 0.2)).otherwise(base)
    lowered = F.when(negative, F.greatest(F.lit(0.0), raised - 0.3)).otherwise(raised)
    damped = F.when(negated, lowered * 0.7).otherwise(lowered)
    return clip_unit(damped)


def known_language(text: Column, language: Column) -> Column:
    """The language, detected where it is given as ``auto``."""
    return F.when(language == "auto", detect_language(text)).otherwise(language)


def sentiment_score(
    text: Column, words: Column, language: Column, polarity: Column, base: Column, **lexicons
) -> Column:
    """Score of a comment: null and very short texts are neutral.

    ``words`` are the Latin words of the text, read only for English.
    """
    english = english_score(
        words,
        polarity,
        lexicons.get("positive_en", V.POSITIVE_EN),
        lexicons.get("negative_en", V.NEGATIVE_EN),
    )
    other = substring_score(
        text,
        base,
        lexicons.get("positive_zh", V.POSITIVE_ZH),
        lexicons.get("negative_zh", V.NEGATIVE_ZH),
        lexicons.get("negations", V.NEGATIONS_ZH),
    )
    return (
        F.when(text.isNull() | (F.length(text) < 5), F.lit(0.5))
        .when(language == "en", english)
        .otherwise(other)
    )


def sentiment_label(score: Column) -> Column:
    return (
        F.when(score > 0.7, V.LABEL_POSITIVE)
        .when(score < 0.3, V.LABEL_NEGATIVE)
        .otherwise(V.LABEL_NEUTRAL)
    )


def is_positive_label(label: Column) -> Column:
    return F.lower(label).isin(list(V.POSITIVE_LABELS))


def is_negative_label(label: Column) -> Column:
    return F.lower(label).isin(list(V.NEGATIVE_LABELS))


def rule_topic(text: Column, rules=V.TOPIC_RULES, other: str = V.TOPIC_OTHER) -> Column:
    """Label of the first rule with a keyword inside the lower-case text."""
    lowered = F.lower(F.coalesce(text, F.lit("")))
    label = F.when(F.lit(False), "")
    for name, keywords in rules:
        label = label.when(contains_any(lowered, [k.lower() for k in keywords]), name)
    return label.otherwise(other)
