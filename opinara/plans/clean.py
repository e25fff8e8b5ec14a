"""Cleaned corpus: clean text, language, tokens, first row of each text."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fixed_values as V
from ..functions.segment import custom_lexicon, tokens
from ..functions.text import clean_comment, detect_language, english_tokens
from ..operators.columns import computed_once
from ..operators.lexicon import dictionary_tokens
from ..operators.rows import first_rows
from ..sources.files import landed_comments

LEAST_LENGTH = 6
STOPWORDS = V.STOPWORDS_ZH + V.STOPWORDS_EN


def with_clean_text(comments: DataFrame, content: str = "content") -> DataFrame:
    """Adds ``cleaned_text`` and its language."""
    cleaned = computed_once(comments, "cleaned_text", clean_comment(F.col(content)))
    return cleaned.withColumn("language", detect_language(F.col("cleaned_text")))


def distinct_texts(cleaned: DataFrame, order: Sequence[str], least: int = LEAST_LENGTH) -> DataFrame:
    """First row of each cleaned text of at least ``least`` characters.

    Equal texts have equal length, so the short ones (mostly blank) go before
    the shuffle.
    """
    return first_rows(cleaned.where(F.length("cleaned_text") >= least), ["cleaned_text"], order)


def clean_corpus(
    comments: DataFrame,
    order: Sequence[str] = ("platform", "row_id"),
    stopwords: Iterable[str] = STOPWORDS,
    entity: Iterable[str] = V.ENTITY_WORDS,
    lexicon: Mapping[str, str] | DataFrame | None = None,
    content: str = "content",
) -> DataFrame:
    """Comments with ``cleaned_text``, ``language`` and ``tokens``, each text once.

    Tokens are made after the duplicates are gone. The only shuffle is that of
    the first-row rule.
    """
    kept = distinct_texts(with_clean_text(comments, content), list(order))
    return with_tokens(kept, stopwords, entity, lexicon)


def with_language(rows: DataFrame) -> DataFrame:
    """The language of cleaned texts, detected where the table has no such column."""
    return rows if "language" in rows.columns else rows.withColumn("language", detect_language(F.col("cleaned_text")))


def with_tokens(
    rows: DataFrame, stopwords: Iterable[str] = STOPWORDS, entity: Iterable[str] = V.ENTITY_WORDS,
    lexicon: Mapping[str, str] | DataFrame | None = None,
) -> DataFrame:
    """The tokens of cleaned texts, made where the table has none.

    The lexicon is a mapping of word to tag, which becomes part of the plan, or for any length a ``(word, tag)`` table.
    """
    if "tokens" in rows.columns:
        return rows
    barred = sorted({*stopwords, *entity})
    if isinstance(lexicon, DataFrame):
        return tokens_by_table(with_language(rows), lexicon, barred)
    words = custom_lexicon() if lexicon is None else dict(lexicon)
    known = with_language(rows)
    return computed_once(known, "tokens", tokens(F.col("cleaned_text"), F.col("language"), words, barred))


def tokens_by_table(rows: DataFrame, lexicon: DataFrame, barred: Iterable[str]) -> DataFrame:
    """English texts by pattern, the others by the words of a table; each distinct other text is searched once."""
    other = rows.where(F.col("language") != "en").select("cleaned_text").distinct().withColumn("_text", F.md5("cleaned_text"))
    found = dictionary_tokens(other, "_text", "cleaned_text", lexicon, barred, out="_other").select("_text", "_other")
    keyed = rows.withColumn("_text", F.when(F.col("language") != "en", F.md5("cleaned_text")))
    english = F.when(F.col("language") == "en", english_tokens(F.col("cleaned_text"), list(barred)))
    made = F.coalesce(english, "_other", F.array().cast("array<string>"))
    return computed_once(keyed.join(found, "_text", "left"), "tokens", made).drop("_text", "_other")


def clean_folder(spark: SparkSession, folder: str, **options) -> DataFrame | None:
    """Cleaned corpus of a folder of landed CSV files, ``None`` without any."""
    landed = landed_comments(spark, folder)
    return None if landed is None else clean_corpus(landed, **options)
