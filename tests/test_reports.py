"""Keywords, aggregates, findings, topics."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from opinara.functions import fixed_values as V
from opinara.operators import aggregates as A
from opinara.operators import keywords as K
from opinara.operators import topics as T
from opinara.operators.findings import generate, headline, level_phrase, mood_phrase, trend_phrase
from opinara.plans import reports as R


def corpus(spark, lists):
    return spark.createDataFrame([(t,) for t in lists], "tokens array<string>")


def test_keyword_weights(spark):
    rows = corpus(spark, [["和平", "Peace ", "2667v3", "us", "ab", "abc", "x", "12", "没有", "和平", "iran"], ["peace", "abc", None, ""], None])
    got = {r["keyword"]: r["weight"] for r in K.keyword_weights(rows).collect()}
    assert got == {"和平": 3.0, "peace": 3.0, "abc": 2.0}
    assert [r["keyword"] for r in R.opinion_keywords(rows, 2).collect()] == ["peace", "和平"]


def test_filters_run_on_counted_words(spark):
    plan = K.keyword_weights(corpus(spark, [["a"]]))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("LeftAnti") < plan.index("Aggregate [")


def test_word_frequencies(spark):
    rows = corpus(spark, [["peace"] * 3 + ["战争"] * 5 + ["talks"] * 2, ["talks", "talks", "②③", "②③", "②③", "99", "99", "99", "a", "a", "a"]])
    got = {r["word"]: r["freq"] for r in K.word_frequencies(rows, V.CLOUD_WORDS).collect()}
    assert got == {"peace": 3, "talks": 4}
    table = spark.createDataFrame([("talks",)], "word string")
    assert R.word_cloud(rows, table, top=1).first()["word"] == "战争"


def test_phrase_share(spark):
    rows = spark.createDataFrame([("支持停火",), ("none",), (None,), ("NO PEACE",)], "cleaned_text string")
    row = K.match_share(rows, K.phrase_match(F.col("cleaned_text"), ("停火", "peace"))).first()
    assert (row["matches"], row["total"], row["share"]) == (2, 4, 0.5)
    assert R.stance_share(rows).first()["matches"] == 1


def test_counts_and_shares(spark):
    rows = spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "k string")
    assert [tuple(r) for r in A.value_counts(rows, "k").collect()] == [("b", 2), ("a", 1)]
    assert sorted(tuple(r) for r in A.value_shares(rows, "k").collect()) == [("a", 1, 0.25), ("b", 2, 0.5)]
    assert tuple(A.top_value(rows, "k").first()) == ("b", 2, 50.0)
    assert A.top_value(rows.where("false"), "k").count() == 0
    assert [r["k"] for r in A.first_seen_values(rows.withColumn("i", F.monotonically_increasing_id()), "k", "i", 1).collect()] == ["a"]


def test_contingency_and_ratios(spark):
    rows = spark.createDataFrame(
        [("a", "正面"), ("a", "负面"), ("b", "POSITIVE"), ("b", None), (None, "正面"), ("c", "正面"), ("c", "中性")], "platform string, sentiment string"
    )
    table = R.platform_sentiment(rows).collect()
    assert [tuple(r) for r in table] == [("a", 1, 0, 1), ("b", 0, 0, 0), ("c", 1, 1, 0)]
    ratios = A.positive_ratio(rows, "platform", "sentiment")
    assert {r["platform"]: r["positive_ratio"] for r in ratios.collect()} == {"a": 0.5, "b": 1.0, "c": 0.5}
    assert tuple(A.best_and_worst(ratios, "platform").first()) == ("b", "a")  # tie for the lowest: a before c
    assert tuple(rows.agg(*A.label_buckets(F.col("sentiment"))).first()) == (7, 4, 1, 1)


def test_percent_rounds_half_to_even(spark):
    rows = spark.createDataFrame([(1, 16), (3, 16), (0, 0)], "a int, b int")
    assert [r[0] for r in rows.select(A.percent(F.col("a"), F.col("b"))).collect()] == [6.2, 18.8, 0.0]


def days(spark, scores):
    rows = [((dt.date(2025, 5, 1) + dt.timedelta(d)).isoformat() + " 10:00:00", s) for d, s in enumerate(scores)]
    return spark.createDataFrame(rows + [("刚刚", 0.9), ("2025-05-01", None)], "publish_time string, sentiment_score double")


@pytest.mark.parametrize("scores,want", [
    ([0.2], (1, None, None)), ([0.2, 0.4], (2, 0.2, 0.4)), ([0.2, 0.9, 0.4], (3, 0.2, 0.4)), ([0.1, 0.3, 0.9, 0.5, 0.7], (5, 0.2, 0.6)),
])
def test_halves(spark, scores, want):
    row = A.half_means(A.daily_mean(days(spark, scores), "publish_time", "sentiment_score")).first()
    assert row["days"] == want[0]
    for got, expected in zip(row[1:], want[1:]):
        assert got == (None if expected is None else pytest.approx(expected))


def test_daily_trend(spark):
    rows = R.daily_trend(days(spark, [0.12344, 0.5])).collect()
    assert [tuple(r) for r in rows] == [(dt.date(2025, 5, 1), 0.1234), (dt.date(2025, 5, 2), 0.5)]
    assert R.daily_trend(spark.range(1)) is None


def test_phrases(spark):
    rows = spark.createDataFrame([(50.0, 30.0, 20.0), (30.0, 50.0, 20.0), (40.0, 40.0, 20.0), (20.0, 30.0, 50.0)], "p double, n double, u double")
    got = [r[0] for r in rows.select(mood_phrase(F.col("p"), F.col("n"), F.col("u"))).collect()]
    assert got == [V.MOOD_POSITIVE, V.MOOD_NEGATIVE, V.MOOD_NEUTRAL, V.MOOD_NEUTRAL]
    levels = spark.createDataFrame([(0.56,), (0.55,), (0.45,), (0.44,)], "m double")
    assert [r[0] for r in levels.select(level_phrase(F.col("m"))).collect()] == [V.LEVEL_HIGH, V.LEVEL_MIDDLE, V.LEVEL_MIDDLE, V.LEVEL_LOW]
    halves = spark.createDataFrame([(0.5, 0.54), (0.5, 0.52), (0.5, 0.46)], "a double, b double")
    assert [r[0] for r in halves.select(trend_phrase(F.col("a"), F.col("b"))).collect()] == [V.TREND_UP, V.TREND_FLAT, V.TREND_DOWN]


def scored(spark):
    rows = [
        ("weibo", "正面", 0.9, "2025-05-01"), ("weibo", "负面", 0.1, "2025-05-01"), ("zhihu", "正面", 0.8, "2025-05-02"),
        ("weibo", "中性", 0.5, "2025-05-03"), ("bilibili", None, 0.4, None),
    ]
    out = spark.createDataFrame(rows, "platform string, sentiment string, sentiment_score double, publish_time string")
    return out.withColumn("row_id", F.monotonically_increasing_id())


def test_findings(spark):
    topics = spark.createDataFrame([("和平反战",), ("和平反战",), ("其他",)], "rule_topic string")
    got = {r["key"]: (r["no"], r["text"]) for r in generate(scored(spark), topics).collect()}
    assert [got[k][0] for k in ("mood", "platforms", "level", "trend", "top_platform", "top_topic", "closing")] == list(range(1, 8))
    assert "共分析5条" in got["mood"][1] and "正面评论占比40.0%" in got["mood"][1] and "中性评论占比20.0%" in got["mood"][1]
    assert V.MOOD_POSITIVE in got["mood"][1]
    assert "zhihu平台" in got["platforms"][1] and "而weibo平台" in got["platforms"][1]
    assert "平均情感得分为0.54（" in got["level"][1] and V.LEVEL_MIDDLE in got["level"][1]
    assert "覆盖了3天" in got["trend"][1] and V.TREND_FLAT in got["trend"][1]
    assert "共有3条评论，占总量的60.0%" in got["top_platform"][1]
    assert "【和平反战】" in got["top_topic"][1] and "占比66.7%" in got["top_topic"][1]
    assert V.SUBJECT in got["closing"][1]


def test_findings_with_absent_columns(spark):
    bare = scored(spark).select("platform", "row_id")
    assert [r["key"] for r in generate(bare).collect()] == ["top_platform"]
    no_time = scored(spark).drop("publish_time")
    assert [r["key"] for r in generate(no_time).collect()] == ["mood", "platforms", "level", "top_platform", "closing"]


def test_headline(spark):
    row = headline(scored(spark)).first()
    assert (row["total"], row["platforms"], row["positive"], row["negative"], row["neutral"]) == (5, 3, 2, 1, 1)
    assert (row["positive_pct"], row["negative_pct"], row["avg_score"]) == (40.0, 20.0, 0.54)
    assert row["first_platforms"] == "weibo、zhihu、bilibili"


def test_topic_report(spark):
    rows = spark.createDataFrame([(1, "停火"), (2, "油价"), (3, "停火谈判"), (4, "天气")], "row_id int, cleaned_text string")
    moods = spark.createDataFrame([(1, "正面"), (2, "负面"), (3, "负面"), (4, None)], "row_id int, sentiment string")
    topics = T.with_rule_topic(rows)
    assert {r["rule_topic"]: r["count"] for r in T.topic_sizes(topics).collect()} == {"和平反战": 2, "战争影响": 1, "其他": 1}
    shares = T.topic_sentiment_shares(T.topic_sentiment(topics, moods, "row_id"))
    got = {(r["rule_topic"], r["sentiment"]): r["share"] for r in shares.collect()}
    assert got == {("和平反战", "正面"): 0.5, ("和平反战", "负面"): 0.5, ("战争影响", "负面"): 1.0}
    assert not T.large_enough(rows) and T.large_enough(rows, 4)
    report = R.topic_report(rows, moods, "row_id")
    assert set(report) == {"topics", "sizes", "shares"}
    assert [r["rule_topic"] for r in R.topic_distribution(topics).collect()][0] == "和平反战"
    assert R.topic_distribution(None) is None


def test_sentiment_report(spark):
    rows = {r["sentiment"]: r["percent"] for r in R.sentiment_report(scored(spark)).collect()}
    assert rows == {"正面": 40.0, "负面": 20.0, "中性": 20.0}
