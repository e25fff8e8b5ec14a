"""Sentiment and report tables over documents and events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fixed_values as V
from ..functions import scoring as S
from ..functions.ids import lenient_time
from ..functions.text import distinct_words, lexicon_words
from ..operators import aggregates as A
from ..operators.columns import computed_once
from ..operators.findings import generate, headline as headline_row
from ..operators.keywords import word_frequency_by
from ..operators.lexicon import labels_in, texts_with_any
from ..operators.membership import text_matches_words, word_frame
from ..operators.sentiment import NEGATION, NEGATIVE, POSITIVE, hits_by_join, polarity_by_join, substring_scored
from ..operators.topics import with_rule_topic
from ..plans import reports as R
from . import base as B
from .base import query, table

WORDS = f"w AS (SELECT doc_id AS row_id, unnest({B.lexicon_words_sql('text')}) AS word FROM documents)"
HITS = (
    f"WITH {WORDS}, h AS (SELECT row_id, count(DISTINCT word) AS hits FROM w WHERE word IN ({B.quoted(B.POSITIVE)}) GROUP BY row_id) "
)


@query(HITS + "SELECT doc_id AS row_id, coalesce(hits, 0) AS hits FROM documents LEFT JOIN h ON doc_id = row_id")
def lexicon_hits(spark: SparkSession, folder: str) -> DataFrame:
    hits = S.lexicon_hits(distinct_words(F.col("content")), B.POSITIVE).cast("long")
    return B.documents(spark, folder).select("row_id", hits.alias("hits"))


@query(HITS + "SELECT row_id, hits FROM h")
def lexicon_hits_join(spark: SparkSession, folder: str) -> DataFrame:
    """Distinct hits on the path for lexicons of any size."""
    return hits_by_join(B.documents(spark, folder), "row_id", "content", word_frame(spark, B.POSITIVE))


def _no_minus_zero(value: Column) -> Column:
    return F.when(F.abs(value) > 1e-9, F.round(value, 9)).otherwise(F.lit(0.0))


MOOD = f"WITH {WORDS}, m AS (SELECT row_id, avg(p) AS polarity FROM w JOIN (VALUES {B.pairs(B.POLARITY)}) AS lex(word, p) USING (word) GROUP BY row_id) "


@query(MOOD + "SELECT doc_id AS row_id, CASE WHEN abs(polarity) > 1e-9 THEN round(polarity, 9) ELSE 0 END AS polarity FROM documents LEFT JOIN m ON doc_id = row_id")
def lexicon_polarity(spark: SparkSession, folder: str) -> DataFrame:
    mood = S.lexicon_polarity(lexicon_words(F.col("content")), B.POLARITY)
    return B.documents(spark, folder).select("row_id", _no_minus_zero(mood).alias("polarity"))


@query(MOOD + "SELECT row_id, CASE WHEN abs(polarity) > 1e-9 THEN round(polarity, 9) ELSE 0 END AS polarity FROM m")
def lexicon_polarity_join(spark: SparkSession, folder: str) -> DataFrame:
    lexicon = spark.createDataFrame(list(B.POLARITY.items()), "word string, polarity double")
    mood = polarity_by_join(B.documents(spark, folder), "row_id", "content", lexicon)
    return mood.select("row_id", _no_minus_zero(F.col("polarity")).alias("polarity"))


@query(f"SELECT doc_id AS row_id, {B.contains_sql('text', B.NEGATIVE_PARTS)} AS found FROM documents")
def contains_any(spark: SparkSession, folder: str) -> DataFrame:
    found = S.contains_any(F.col("content"), B.NEGATIVE_PARTS)
    return B.documents(spark, folder).select("row_id", found.alias("found"))


@query(f"SELECT doc_id AS row_id, {B.contains_sql('text', B.NEGATIVE_PARTS)} AS found FROM documents")
def contains_any_arrow(spark: SparkSession, folder: str) -> DataFrame:
    """Containment by a join, the form for long lists."""
    rows = B.documents(spark, folder).select("row_id", "content")
    found = texts_with_any(rows, "row_id", "content", word_frame(spark, B.NEGATIVE_PARTS)).withColumn("found", F.lit(True))
    return rows.join(found, "row_id", "left").select("row_id", F.coalesce("found", F.lit(False)).alias("found"))


@query(
    f"WITH {WORDS}, lex AS (SELECT DISTINCT lower(trim(x)) AS word FROM (SELECT unnest(string_split(text, ' ')) AS x FROM benchmark WHERE item_id IS NOT NULL)) "
    "SELECT DISTINCT row_id FROM w JOIN lex USING (word)"
)
def word_table_matches(spark: SparkSession, folder: str) -> DataFrame:
    """Documents with a word of a word table."""
    words = table(spark, folder, "benchmark").select(F.explode(F.split("text", " ")).alias("x"))
    listed = words.select(F.lower(F.trim("x")).alias("word")).distinct()
    return text_matches_words(B.documents(spark, folder), "row_id", distinct_words(F.col("content")), listed)


@query(
    f"WITH {B.SCORED} SELECT row_id, round(e2, 9) AS score FROM scored"
)
def sentiment_en(spark: SparkSession, folder: str) -> DataFrame:
    words = F.col("words")
    score = S.english_score(words, S.lexicon_polarity(words, B.POLARITY), B.POSITIVE, B.NEGATIVE)
    rows = computed_once(B.corpus(spark, folder), "words", lexicon_words(F.col("cleaned_text")))
    return rows.select("row_id", F.round(score, 9).alias("score"))


@query(f"WITH {B.SCORED} SELECT row_id, round(z3, 9) AS score FROM scored")
def sentiment_substring(spark: SparkSession, folder: str) -> DataFrame:
    score = S.substring_score(
        F.col("cleaned_text"), F.lit(0.5), B.POSITIVE_PARTS, B.NEGATIVE_PARTS, B.NEGATIONS
    )
    return B.corpus(spark, folder).select("row_id", F.round(score, 9).alias("score"))


@query(B.SQL["sentiment_substring"])
def sentiment_substring_table(spark: SparkSession, folder: str) -> DataFrame:
    """The same scores with the words in a table."""
    lists = {POSITIVE: B.POSITIVE_PARTS, NEGATIVE: B.NEGATIVE_PARTS, NEGATION: B.NEGATIONS}
    listed = spark.createDataFrame([(w, label) for label, words in lists.items() for w in words], "word string, label string")
    rows = substring_scored(B.corpus(spark, folder), "row_id", "cleaned_text", F.lit(0.5), listed)
    return rows.select("row_id", F.round("score", 9).alias("score"))


@query(
    "WITH lex AS (SELECT DISTINCT w AS word FROM (SELECT unnest(string_split(text, ' ')) AS w FROM benchmark) WHERE length(w) > 2) "
    "SELECT doc_id, count(*) AS words FROM documents JOIN lex ON contains(text, word) GROUP BY doc_id"
)
def words_inside(spark: SparkSession, folder: str) -> DataFrame:
    """How many words of a table each document contains anywhere, inside other words too."""
    words = table(spark, folder, "benchmark").select(F.explode(F.split("text", " ")).alias("word")).where(F.length("word") > 2)
    found = labels_in(table(spark, folder, "documents"), "doc_id", "text", words.select("word", F.col("word").alias("label")))
    return found.select("doc_id", F.size("labels").cast("long").alias("words"))


@query(f"WITH {B.SCORED} SELECT row_id, platform, round(sentiment_score, 9) AS sentiment_score, sentiment FROM scored")
def scored_corpus(spark: SparkSession, folder: str) -> DataFrame:
    rows = B.scored_corpus(spark, folder)
    return rows.select("row_id", "platform", F.round("sentiment_score", 9).alias("sentiment_score"), "sentiment")


@query(f"WITH {B.EVENTS} SELECT row_id, sentiment FROM scored")
def sentiment_label(spark: SparkSession, folder: str) -> DataFrame:
    return B.scored_events(spark, folder).select("row_id", "sentiment")


@query(
    f"WITH {B.SCORED} SELECT sentiment, count(*) AS count, count(*) * 100.0::DOUBLE / sum(count(*)) OVER () AS percent FROM scored GROUP BY sentiment"
)
def label_share(spark: SparkSession, folder: str) -> DataFrame:
    return R.sentiment_report(B.scored_corpus(spark, folder))


@query(f"WITH {B.SCORED} SELECT sentiment, count(*) AS count FROM scored GROUP BY sentiment")
def sentiment_counts(spark: SparkSession, folder: str) -> DataFrame:
    return R.sentiment_distribution(B.scored_corpus(spark, folder))


PIVOT = ", ".join(f"count(*) FILTER (sentiment = '{v}') AS \"{v}\"" for v in A.LABELS)


@query(f"WITH {B.SCORED} SELECT platform, {PIVOT} FROM scored GROUP BY platform")
def platform_sentiment_pivot(spark: SparkSession, folder: str) -> DataFrame:
    return R.platform_sentiment(B.scored_corpus(spark, folder))


@query(f"WITH {B.EVENTS} SELECT platform, {PIVOT} FROM scored GROUP BY platform")
def event_sentiment_pivot(spark: SparkSession, folder: str) -> DataFrame:
    return R.platform_sentiment(B.scored_events(spark, folder))


RATIO = f"ratio AS (SELECT platform, count(*) FILTER (sentiment = '{V.LABEL_POSITIVE}') AS positive, count(*) AS total FROM scored GROUP BY platform)"


@query(f"WITH {B.EVENTS}, {RATIO} SELECT *, positive / total AS positive_ratio FROM ratio")
def positive_ratio(spark: SparkSession, folder: str) -> DataFrame:
    return A.positive_ratio(B.scored_events(spark, folder), "platform", "sentiment")


BEST = (
    "(SELECT platform FROM ratio ORDER BY positive / total DESC, platform LIMIT 1) AS best, "
    "(SELECT platform FROM ratio ORDER BY positive / total, platform LIMIT 1) AS worst"
)


@query(f"WITH {B.SCORED}, {RATIO} SELECT {BEST}")
def best_worst_platform(spark: SparkSession, folder: str) -> DataFrame:
    ratios = A.positive_ratio(B.scored_corpus(spark, folder), "platform", "sentiment")
    return A.best_and_worst(ratios, "platform")


DAYS = "days AS (SELECT ts::DATE AS date, avg(sentiment_score) AS avg_score FROM scored GROUP BY 1)"


@query(f"WITH {B.EVENTS}, {DAYS} SELECT strftime(date, '%Y-%m-%d') AS date, printf('%.4f', avg_score)::DOUBLE AS avg_score FROM days")
def daily_trend(spark: SparkSession, folder: str) -> DataFrame:
    rows = R.daily_trend(B.scored_events(spark, folder))
    return rows.withColumn("date", F.col("date").cast("string"))


HALVES = (
    f"{DAYS}, numbered AS (SELECT *, row_number() OVER (ORDER BY date) AS i, count(*) OVER () AS n FROM days), "
    "halves AS (SELECT max(n) AS days, avg(avg_score) FILTER (i <= n // 2) AS first_half, avg(avg_score) FILTER (i > n - n // 2) AS second_half FROM numbered)"
)


@query(f"WITH {B.EVENTS}, {HALVES} SELECT days, round(first_half, 9) AS first_half, round(second_half, 9) AS second_half FROM halves")
def half_period_trend(spark: SparkSession, folder: str) -> DataFrame:
    daily = A.daily_mean(B.scored_events(spark, folder), "publish_time", "sentiment_score")
    return A.half_means(daily).select(
        "days", F.round("first_half", 9).alias("first_half"), F.round("second_half", 9).alias("second_half")
    )


@query(
    "SELECT event_type AS value, count(*) AS count, printf('%.1f', count(*) / (SELECT count(*) FROM events) * 100)::DOUBLE AS share "
    "FROM events GROUP BY event_type ORDER BY count DESC, value LIMIT 1"
)
def top_platform_share(spark: SparkSession, folder: str) -> DataFrame:
    return A.top_value(B.scored_events(spark, folder), "platform")


@query(f"WITH {B.EVENTS} SELECT printf('%.4f', avg(sentiment_score))::DOUBLE AS mean FROM scored")
def overall_mean(spark: SparkSession, folder: str) -> DataFrame:
    return B.scored_events(spark, folder).agg(F.bround(F.avg("sentiment_score"), 4).alias("mean"))


BUCKETS = (
    f"count(*) AS total, count(*) FILTER (sentiment = '{V.LABEL_POSITIVE}') AS positive, "
    f"count(*) FILTER (sentiment = '{V.LABEL_NEGATIVE}') AS negative, count(*) FILTER (sentiment = '{V.LABEL_NEUTRAL}') AS neutral"
)


@query(f"WITH {B.EVENTS} SELECT {BUCKETS} FROM scored")
def label_buckets(spark: SparkSession, folder: str) -> DataFrame:
    return B.scored_events(spark, folder).agg(*A.label_buckets(F.col("sentiment")))


@query(
    "SELECT event_type AS platform, min(event_id) AS first_seen FROM events GROUP BY event_type ORDER BY first_seen, platform LIMIT 3"
)
def first_platforms(spark: SparkSession, folder: str) -> DataFrame:
    return A.first_seen_values(B.scored_events(spark, folder), "platform", "row_id")


@query("SELECT count(*) AS total, count(DISTINCT event_type) AS platforms, count(DISTINCT ts::DATE) AS days FROM events")
def totals(spark: SparkSession, folder: str) -> DataFrame:
    rows = B.scored_events(spark, folder)
    return rows.agg(
        F.count(F.lit(1)).alias("total"),
        F.countDistinct("platform").alias("platforms"),
        F.countDistinct(F.to_date("publish_time")).alias("days"),
    )


HEADLINE = (
    f"b AS (SELECT {BUCKETS}, count(DISTINCT platform) AS platforms, printf('%.3f', avg(sentiment_score))::DOUBLE AS avg_score FROM scored), "
    "seen AS (SELECT platform, min(row_id) AS seen_at FROM scored GROUP BY platform ORDER BY seen_at, platform LIMIT 3) "
    "SELECT total, platforms, positive, negative, neutral, printf('%.1f', positive / total * 100)::DOUBLE AS positive_pct, "
    "printf('%.1f', negative / total * 100)::DOUBLE AS negative_pct, avg_score, (SELECT string_agg(platform, '、' ORDER BY seen_at, platform) FROM seen) AS first_platforms FROM b"
)


@query(f"WITH {B.EVENTS}, {HEADLINE}")
def headline(spark: SparkSession, folder: str) -> DataFrame:
    return headline_row(B.scored_events(spark, folder))


@query(f"WITH {B.SCORED}, {HEADLINE}")
def headline_documents(spark: SparkSession, folder: str) -> DataFrame:
    return headline_row(B.scored_corpus(spark, folder))


def _fill_sql(key: str, **values: str) -> str:
    text = V.FINDING_FORMATS[key].replace("{subject}", V.SUBJECT)
    for name, value in values.items():
        text = text.replace("{" + name + "}", f"' || {value} || '")
    return f"'{text}'"


FINDINGS = (
    f"{RATIO}, {HALVES}, b AS (SELECT {BUCKETS}, printf('%.4f', avg(sentiment_score))::DOUBLE AS mean FROM scored), "
    "p AS (SELECT *, printf('%.1f', positive / total * 100)::DOUBLE AS pp, printf('%.1f', negative / total * 100)::DOUBLE AS np, printf('%.1f', neutral / total * 100)::DOUBLE AS up FROM b), "
    f"e AS (SELECT {BEST}), "
    "tp AS (SELECT platform, count(*) AS c FROM scored GROUP BY platform ORDER BY c DESC, platform LIMIT 1), "
    "tt AS (SELECT topic, count(*) AS c FROM topics GROUP BY topic ORDER BY c DESC, topic LIMIT 1), n AS (SELECT count(*) AS n FROM topics), "
    "parts AS ("
    "SELECT 1 AS no, 'mood' AS key, "
    + _fill_sql(
        "mood", total="total", positive="pp", negative="np", neutral="up",
        mood=f"CASE WHEN pp > np AND pp > up THEN '{V.MOOD_POSITIVE}' WHEN np > pp AND np > up THEN '{V.MOOD_NEGATIVE}' ELSE '{V.MOOD_NEUTRAL}' END",
    )
    + " AS text FROM p UNION ALL SELECT 2, 'platforms', "
    + _fill_sql("platforms", best="best", worst="worst")
    + " FROM e UNION ALL SELECT 3, 'level', "
    + _fill_sql("level", mean="mean", level=f"CASE WHEN mean > 0.55 THEN '{V.LEVEL_HIGH}' WHEN mean < 0.45 THEN '{V.LEVEL_LOW}' ELSE '{V.LEVEL_MIDDLE}' END")
    + " FROM p UNION ALL SELECT 4, 'trend', "
    + _fill_sql(
        "trend", days="days",
        trend=f"CASE WHEN second_half > first_half + 0.03 THEN '{V.TREND_UP}' WHEN second_half < first_half - 0.03 THEN '{V.TREND_DOWN}' ELSE '{V.TREND_FLAT}' END",
    )
    + " FROM halves UNION ALL SELECT 5, 'top_platform', "
    + _fill_sql("top_platform", platform="platform", count="c", share="printf('%.1f', c / total * 100)::DOUBLE")
    + " FROM tp, p UNION ALL SELECT 6, 'top_topic', "
    + _fill_sql("top_topic", topic="topic", count="c", share="printf('%.1f', c / n * 100)::DOUBLE")
    + " FROM tt, n UNION ALL SELECT 7, 'closing', "
    + _fill_sql("closing")
    + ") SELECT * FROM parts"
)


def topic_sql(value: str, rules=B.TOPICS, other: str = B.NO_TOPIC) -> str:
    cases = " ".join(f"WHEN {B.contains_sql(f'lower({value})', words)} THEN '{name}'" for name, words in rules)
    return f"CASE {cases} ELSE '{other}' END"


TOPIC_ROWS = f"topics AS (SELECT doc_id, {topic_sql('text')} AS topic FROM documents)"


@query(f"WITH {B.EVENTS}, {TOPIC_ROWS}, {FINDINGS}")
def findings(spark: SparkSession, folder: str) -> DataFrame:
    """Numbered findings from scored events and document topics."""
    topics = with_rule_topic(B.documents(spark, folder), B.TOPICS, B.NO_TOPIC, "content")
    return generate(B.scored_events(spark, folder), topics)


@query(
    f"WITH {B.EVENTS} SELECT count(*) AS n, round(avg(sentiment_score), 9) AS mean, round(stddev_samp(sentiment_score), 9) AS std, "
    "min(sentiment_score) AS min, max(sentiment_score) AS max FROM scored"
)
def score_statistics(spark: SparkSession, folder: str) -> DataFrame:
    row = A.summary_statistics(B.scored_events(spark, folder), "sentiment_score")
    return row.withColumns({"mean": F.round("mean", 9), "std": F.round("std", 9)})


@query(
    "SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS publish_time, strftime(ts, '%Y-%m-%d') AS date, "
    "props[7:7] IN ('1', '2') AS kept FROM events"
)
def lenient_dates(spark: SparkSession, folder: str) -> DataFrame:
    """Times written in several formats and read back; unreadable text gives null."""
    events = table(spark, folder, "events")
    written = (
        F.when(F.substring("props", 7, 1) == "1", F.date_format("ts", "yyyy/M/d H:mm:ss"))
        .when(F.substring("props", 7, 1) == "2", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"))
        .otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    )
    rows = events.select("event_id", written.alias("w"), F.substring("props", 7, 1).isin("1", "2").alias("kept"))
    moment = lenient_time(F.col("w"))
    return rows.select(
        "event_id",
        F.date_format(moment, "yyyy-MM-dd HH:mm:ss").alias("publish_time"),
        F.to_date(moment).cast("string").alias("date"),
        "kept",
    )


@query(
    f"WITH {B.CORPUS}, t AS (SELECT platform, row_id % 7 AS day, lower(trim(unnest(tokens))) AS word FROM corpus) "
    "SELECT platform, day, word, count(*) AS freq FROM t WHERE length(word) > 1 GROUP BY ALL"
)
def word_by_platform_and_day(spark: SparkSession, folder: str) -> DataFrame:
    """Word frequencies of the cleaned corpus per platform and day; the documents are dealt over seven days."""
    rows = B.corpus(spark, folder).withColumn("day", F.col("row_id") % 7)
    return word_frequency_by(rows, ["platform", "day"])
