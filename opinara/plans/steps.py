"""The steps of a whole run, linked by tables in one folder.

Each step reads what an earlier one wrote and writes its own tables, so a step
can be repeated alone. Steps that find no input return ``None``.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import models as M
from ..operators.columns import first_available
from ..sources.sinks import overwrite_table, write_findings
from ..sources.tables import first_table, read_table
from ..sources.wordlists import cloud_stop_words, stop_words
from ..operators.membership import inline_words, without_listed_tokens
from . import reports as R
from .clean import clean_folder, with_language, with_tokens

CLEANED, SCORED, KEYWORDS, TOPICS = "cleaned", "scored", "keywords", "topics"


def _write(frame: DataFrame, folder: str, name: str) -> DataFrame:
    path = f"{folder}/{name}"
    overwrite_table(frame, path)
    return read_table(frame.sparkSession, path)


def clean(spark: SparkSession, raw: str, folder: str, word_files: list[str] | None = None, **options) -> DataFrame | None:
    """Landed CSV files to the cleaned table."""
    listed = stop_words(spark, word_files) if word_files else None
    long = None
    if listed is not None:
        short = inline_words(listed)
        if short is None:
            long = listed
        else:
            options["stopwords"] = short
    rows = clean_folder(spark, raw, **options)
    if rows is None:
        return None
    rows = rows.withColumn("comment_key", F.md5("cleaned_text"))
    if long is not None:
        rows = without_listed_tokens(rows, "comment_key", long)
    return _write(rows, folder, CLEANED)


def score(
    spark: SparkSession, folder: str, polarity: Mapping[str, float] | None = None, labelled: DataFrame | None = None
) -> DataFrame | None:
    """Cleaned to scored table.

    The base score of English texts is the mean polarity of a word table, that of other languages the
    probability of a model trained on a labelled table; with one of the two, it serves all languages. Neither is an
    error: the rules alone move a constant and can't tell a comment from the next.
    """
    rows = read_table(spark, f"{folder}/{CLEANED}")
    if rows is None:
        return None
    if not polarity and labelled is None:
        raise ValueError("scores need a polarity table or a labelled table")
    rows = with_language(rows)
    base, mood = None, polarity
    if labelled is not None:
        rows = rows if "comment_key" in rows.columns else rows.withColumn("comment_key", F.md5("cleaned_text"))
        rows = M.positive_probability(M.train_sentiment(labelled), rows, "cleaned_text", "comment_key")
        base = F.col("base_score")
        mood = polarity if polarity else base * 2 - 1
    return _write(R.scored(rows, mood, base), folder, SCORED)


def keywords(spark: SparkSession, folder: str) -> dict[str, DataFrame] | None:
    """Weighted keywords and the share of comments that take a stance."""
    rows = read_table(spark, f"{folder}/{CLEANED}")
    if rows is None:
        return None
    return {
        "keywords": _write(R.opinion_keywords(rows), folder, KEYWORDS),
        "stance": _write(R.stance_share(rows), folder, "stance"),
    }


def topics(spark: SparkSession, folder: str) -> dict[str, DataFrame] | None:
    """Topic table with clusters, and the topic reports."""
    rows = read_table(spark, f"{folder}/{CLEANED}")
    if rows is None:
        return None
    moods = read_table(spark, f"{folder}/{SCORED}")
    tables = R.topic_report(with_tokens(rows), moods, "comment_key")
    return {name: _write(t, folder, TOPICS if name == "topics" else f"topic_{name}") for name, t in tables.items()}


def report(spark: SparkSession, folder: str, word_files: list[str] | None = None) -> dict[str, DataFrame] | None:
    """Every table behind the dashboard that the available columns allow."""
    rows = first_table(spark, [f"{folder}/{SCORED}", f"{folder}/{CLEANED}"])
    if rows is None:
        return None
    topic_rows = read_table(spark, f"{folder}/{TOPICS}")
    time = first_available(rows, ("publish_time", "timestamp")) or "publish_time"
    tables = {
        "headline": R.headline(rows),
        "sentiment": R.sentiment_distribution(rows),
        "platforms": R.platform_sentiment(rows),
        "trend": R.daily_trend(rows, time),
        "topic_counts": R.topic_distribution(topic_rows),
        "words": R.word_cloud(with_tokens(rows), cloud_stop_words(spark, word_files)),
        "findings": R.generate(rows, topic_rows, time),
    }
    written = {n: _write(t, folder, f"report_{n}") for n, t in tables.items() if t is not None}
    write_findings(written["findings"], f"{folder}/report_findings_text")
    return written


def run(
    spark: SparkSession, raw: str, folder: str, polarity: Mapping[str, float] | None = None, labelled: DataFrame | None = None,
    word_files: list[str] | None = None, **options,
) -> dict[str, DataFrame] | None:
    """All steps in order."""
    if clean(spark, raw, folder, word_files, **options) is None:
        return None
    score(spark, folder, polarity, labelled)
    keywords(spark, folder)
    topics(spark, folder)
    return report(spark, folder, word_files)
