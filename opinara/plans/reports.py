"""Report tables: what the dashboard shows."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import fixed_values as V
from ..operators import aggregates as A
from ..operators import keywords as K
from ..operators.columns import SENTIMENT_COLUMNS, TOPIC_COLUMNS, first_available
from ..operators.findings import generate, headline
from ..operators.models import cluster, cluster_sizes, cluster_terms
from ..operators.sentiment import label_distribution, scored
from ..operators.topics import (
    large_enough,
    topic_sentiment,
    topic_sentiment_shares,
    topic_sizes,
    with_rule_topic,
)

__all__ = ["generate", "headline", "scored"]


def sentiment_report(rows: DataFrame) -> DataFrame:
    """Rows and percentage per sentiment label."""
    label = first_available(rows, SENTIMENT_COLUMNS) or "sentiment"
    return label_distribution(rows, label).select(
        F.col(label).alias("sentiment"), "count", (F.col("share") * 100).alias("percent")
    )


def opinion_keywords(cleaned: DataFrame, top: int = 30, **lists) -> DataFrame:
    return K.top_keywords(K.keyword_weights(cleaned, **lists), top)


def stance_share(cleaned: DataFrame, phrases: Iterable[str] = V.STANCE_PHRASES) -> DataFrame:
    """How many comments name one of the phrases."""
    return K.match_share(cleaned, K.phrase_match(F.col("cleaned_text"), phrases))


def sentiment_distribution(rows: DataFrame) -> DataFrame | None:
    label = first_available(rows, SENTIMENT_COLUMNS)
    return A.value_counts(rows, label) if label else None


def platform_sentiment(rows: DataFrame, labels=A.LABELS) -> DataFrame | None:
    label = first_available(rows, SENTIMENT_COLUMNS)
    if label is None or "platform" not in rows.columns:
        return None
    return A.contingency(rows, "platform", label, labels)


def daily_trend(rows: DataFrame, time: str = "publish_time", score: str = "sentiment_score") -> DataFrame | None:
    """Rounded mean score per day in date order."""
    if time not in rows.columns or score not in rows.columns:
        return None
    daily = A.daily_mean(rows, time, score)
    return daily.select("date", F.bround("avg_score", 4).alias("avg_score")).orderBy("date")


def topic_distribution(rows: DataFrame | None) -> DataFrame | None:
    column = first_available(rows, TOPIC_COLUMNS) if rows is not None else None
    return A.value_counts(rows, column) if column else None


def word_cloud(
    cleaned: DataFrame, stopwords: Iterable[str] | DataFrame, least: int = 3, top: int = 120
) -> DataFrame:
    """Most frequent words for the cloud."""
    return K.top_words(K.word_frequencies(cleaned, stopwords, least), top)


def topic_report(cleaned: DataFrame, sentiments: DataFrame | None, key: str, **rules) -> dict[str, DataFrame]:
    """Topic table, sizes, sentiment shares per topic and, for 20 rows or more, clusters."""
    topics = with_rule_topic(cleaned, **rules)
    out = {"topics": topics, "sizes": topic_sizes(topics)}
    if sentiments is not None:
        out["shares"] = topic_sentiment_shares(topic_sentiment(topics, sentiments, key))
    if large_enough(cleaned):
        clustered, model, names = cluster(topics)
        out["topics"] = clustered.drop("features")
        out["cluster_sizes"] = cluster_sizes(clustered)
        out["cluster_terms"] = cluster_terms(cleaned, model, names)
    return out
