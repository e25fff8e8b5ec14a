"""Scored and labelled comments."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scoring as S
from ..functions.text import distinct_words, lexicon_words
from .aggregates import value_shares
from .columns import computed_once, exploded
from .lexicon import with_labels
from .membership import hinted


def scored(
    comments: DataFrame,
    polarity: Mapping[str, float] | Column,
    base: Column | None = None,
    text: str = "cleaned_text",
    language: str = "language",
    **lexicons,
) -> DataFrame:
    """Adds ``sentiment_score`` and ``sentiment``.

    ``polarity`` is a small word lexicon or a column made by another model;
    ``base`` is the score of texts that are not English (0.5 without a model).
    """
    body, spoken = F.col(text), S.known_language(F.col(text), F.col(language))
    english = F.when(spoken == "en", lexicon_words(body))
    rows = computed_once(comments, "_words", F.coalesce(english, F.array().cast("array<string>")))
    words = F.col("_words")
    mood = polarity if isinstance(polarity, Column) else S.lexicon_polarity(words, polarity)
    base = F.lit(0.5) if base is None else base
    score = S.sentiment_score(body, words, spoken, mood, base, **lexicons)
    rows = computed_once(rows, "sentiment_score", score).drop("_words")
    return rows.withColumn("sentiment", S.sentiment_label(F.col("sentiment_score")))


def polarity_by_join(texts: DataFrame, key: str, text: str, lexicon: DataFrame) -> DataFrame:
    """``(key, polarity)`` for a ``(word, polarity)`` table of any size.

    Words are counted per row before the join, so a repeated word is one row.
    Rows without a lexicon word are absent: their polarity is 0.
    """
    words = (
        exploded(texts, [key], lexicon_words(F.col(text)), "word")
        .groupBy(key, "word")
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    known = words.join(hinted(lexicon.select("word", "polarity")), "word")
    total = F.sum(F.col("polarity") * F.col("_n")) / F.sum("_n")
    return known.groupBy(key).agg(total.alias("polarity"))


def hits_by_join(texts: DataFrame, key: str, text: str, lexicon: DataFrame) -> DataFrame:
    """``(key, hits)``: distinct lexicon words per row for a word table of any size."""
    words = exploded(texts, [key], distinct_words(F.col(text)), "word")
    return words.join(hinted(lexicon.select("word")), "word", "left_semi").groupBy(key).agg(
        F.count(F.lit(1)).alias("hits")
    )


#: Labels of the words that move a score, in a ``(word, label)`` table.
POSITIVE, NEGATIVE, NEGATION = "positive", "negative", "negation"


def substring_scored(rows: DataFrame, key: str, text: str, base: Column, listed: DataFrame, out: str = "score") -> DataFrame:
    """Adds the score of ``functions.scoring.substring_score`` for a ``(word, label)`` table of any length; ``key`` must be unique."""
    found = with_labels(rows, key, text, listed, "_labels")
    has = lambda label: F.array_contains("_labels", label)
    return found.withColumn(out, S.moved_score(base, has(POSITIVE), has(NEGATIVE), has(NEGATION))).drop("_labels")


def label_distribution(rows: DataFrame, label: str = "sentiment") -> DataFrame:
    """Rows and share per label."""
    return value_shares(rows, label)
