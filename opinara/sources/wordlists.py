"""Word-list files, one word per line."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from ..functions import fixed_values as V
from ..operators.membership import normalize_words, union_words, word_frame


def word_list(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Trimmed, lower-case, distinct words of text files as ``(word)``."""
    return normalize_words(spark.read.text(paths), "value")


def stop_words(
    spark: SparkSession,
    paths: str | list[str] | None = None,
    listed: Iterable[str] = V.STOPWORDS_ZH + V.STOPWORDS_EN,
) -> DataFrame:
    """Default stop words merged with those of the files."""
    own = word_frame(spark, listed)
    return union_words(own, word_list(spark, paths)) if paths else own


def cloud_stop_words(spark: SparkSession, paths: str | list[str] | None = None) -> DataFrame:
    """Words kept out of the word cloud: files, cloud words and entity words."""
    return stop_words(spark, paths, V.CLOUD_WORDS + V.ENTITY_WORDS)
