"""Rule topics and their reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import fixed_values as V
from ..functions.scoring import rule_topic
from .aggregates import group_shares
from .lexicon import with_labels


def with_rule_topic(
    comments: DataFrame, rules=V.TOPIC_RULES, other: str = V.TOPIC_OTHER, text: str = "cleaned_text"
) -> DataFrame:
    return comments.withColumn("rule_topic", rule_topic(F.col(text), rules, other))


def with_rule_topic_by_table(
    comments: DataFrame, key: str, rules: DataFrame, other: str = V.TOPIC_OTHER, text: str = "cleaned_text"
) -> DataFrame:
    """As ``with_rule_topic`` for a table ``(place, topic, word)`` of any length; ``key`` must be unique.

    The topic of the smallest place with a word inside the lower-case text counts, of equal places the first name.
    """
    listed = rules.select(F.lower("word").alias("word"), F.concat(F.lpad(F.col("place").cast("string"), 10, "0"), "topic").alias("label"))
    lowered = comments.withColumn("_lower", F.lower(F.coalesce(F.col(text), F.lit(""))))
    found = with_labels(lowered, key, "_lower", listed, "_labels").drop("_lower")
    first = F.get("_labels", F.lit(0))
    return found.withColumn("rule_topic", F.coalesce(F.substring(first, F.lit(11), F.length(first)), F.lit(other))).drop("_labels")


def rows_of_topic(topics: DataFrame, topic: str) -> DataFrame:
    return topics.where(F.col("rule_topic") == topic)


def topic_names(topics: DataFrame) -> DataFrame:
    return topics.select("rule_topic").distinct().orderBy("rule_topic")


def topic_sizes(topics: DataFrame) -> DataFrame:
    return topics.groupBy("rule_topic").agg(F.count(F.lit(1)).alias("count"))


def topic_sentiment(topics: DataFrame, sentiments: DataFrame, key: str) -> DataFrame:
    """Topics joined with sentiment by the comment key, which is unique on both sides."""
    return topics.join(sentiments.select(key, "sentiment"), key)


def topic_sentiment_shares(joined: DataFrame, top: int = 5) -> DataFrame:
    return group_shares(joined, "rule_topic", "sentiment", top)


def large_enough(rows: DataFrame, least: int = 20) -> bool:
    """At least ``least`` rows; reads no more than that."""
    return rows.limit(least).count() >= least
