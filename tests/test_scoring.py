import pytest
from pyspark.sql import functions as F

from opinara.functions import scoring as S
from opinara.functions.text import lexicon_words
from opinara.operators import membership as M
from opinara.operators.lexicon import texts_with_any
from opinara.operators.sentiment import hits_by_join, polarity_by_join, scored


def test_english_score(spark):
    cases = [
        ("nothing special here", 0.0, 0.5),
        ("peace and hope", 0.0, 0.62),
        ("peace hope safe good great right", 0.0, 0.7),  # capped at +0.2
        ("war war war", 0.0, 0.44),  # distinct words
        ("war attack bomb killed dead evil", 0.0, 0.25),  # capped at -0.25
        ("peace war", 0.5, 0.75),
        ("good", 1.0, 1.0),
        ("war", -1.0, 0.0),
        ("peace", None, 0.56),
        ("Peace-ful warlike", 0.0, 0.5),
    ]
    rows = spark.createDataFrame([(t, p, e) for t, p, e in cases], "t string, p double, e double")
    out = rows.select("e", S.english_score(lexicon_words(F.col("t")), F.col("p")).alias("s")).collect()
    for r in out:
        assert r["s"] == pytest.approx(r["e"], abs=1e-12)


def test_substring_score_order(spark):
    cases = [
        ("支持", 0.5, 0.7),
        ("支持和平加油", 0.5, 0.7),  # raised once
        ("反对", 0.5, 0.4),  # the positive word inside it counts first
        ("谴责", 0.5, 0.2),
        ("支持反对", 0.5, 0.4),
        ("不支持", 0.5, 0.49),
        ("无能", 0.5, 0.14),  # negative word that also holds a negation
        ("支持", 0.95, 1.0),
        ("垃圾", 0.1, 0.0),
        ("天气", 0.3, 0.3),
        ("没有", 0.3, 0.21),
    ]
    rows = spark.createDataFrame(cases, "t string, b double, e double")
    for r in rows.select("e", S.substring_score(F.col("t"), F.col("b")).alias("s")).collect():
        assert r["s"] == pytest.approx(r["e"], abs=1e-12)


def test_guard_language_and_label(spark):
    cases = [
        (None, "en", 0.5),
        ("war", "en", 0.5),  # under five characters
        ("war!!", "en", 0.44),
        ("支持和平！", "zh", 0.7),
        ("支持和平吧。", "auto", 0.7),
        ("evil war crimes", "auto", 0.38),
        ("支持 ok go", "other", 0.7),
    ]
    rows = spark.createDataFrame(cases, "t string, l string, e double")
    out = rows.select("e", S.sentiment_score(
        F.col("t"), lexicon_words(F.col("t")), S.known_language(F.col("t"), F.col("l")), F.lit(0.0), F.lit(0.5)
    ).alias("s"))
    for r in out.collect():
        assert r["s"] == pytest.approx(r["e"], abs=1e-12)
    labels = spark.createDataFrame([(0.7,), (0.71,), (0.3,), (0.29,), (0.5 + 0.2,)], "s double")
    got = [r[0] for r in labels.select(S.sentiment_label(F.col("s"))).collect()]
    assert got == ["中性", "正面", "中性", "负面", "中性"]


def test_scores_stay_in_range(spark):
    rows = spark.range(200).select(
        F.concat_ws(" ", F.when(F.col("id") % 2 == 0, "war evil").otherwise("peace"), F.lit("支持反对不")).alias("cleaned_text"),
        F.when(F.col("id") % 3 == 0, "en").otherwise("zh").alias("language"),
        ((F.col("id") % 21 - 10) / 10).alias("p"),
    )
    out = scored(rows, F.col("p"), (F.col("p") + 1) / 2).agg(F.min("sentiment_score"), F.max("sentiment_score")).first()
    assert 0 <= out[0] <= out[1] <= 1


def test_polarity_and_hits_by_join_equal_the_row_form(spark):
    lexicon = {"good": 0.7, "bad": -0.6, "so": 0.1}
    rows = spark.createDataFrame([(1, "good good bad"), (2, "so so"), (3, "nothing"), (4, "")], "k int, t string")
    row_form = {r["k"]: r["p"] for r in rows.select("k", S.lexicon_polarity(lexicon_words(F.col("t")), lexicon).alias("p")).collect()}
    table = spark.createDataFrame(list(lexicon.items()), "word string, polarity double")
    joined = {r["k"]: r["polarity"] for r in polarity_by_join(rows, "k", "t", table).collect()}
    assert row_form[1] == pytest.approx((0.7 * 2 - 0.6) / 3) and row_form[3] == 0.0
    assert all(row_form[k] == pytest.approx(joined.get(k, 0.0)) for k in row_form)
    hits = {r["k"]: r["hits"] for r in hits_by_join(rows, "k", "t", table.select("word")).collect()}
    assert hits == {1: 2, 2: 1}


def test_contains_any_forms_agree(spark):
    texts = ["abc", "xbcx", "", None, "和平解决", "b", "a longer text with zyx inside"]
    rows = spark.createDataFrame(list(enumerate(texts)), "k int, t string")
    for words in (["bc", "和平", "zyx"], ["zz"], ["b"]):
        inline = {r["k"] for r in rows.where(S.contains_any(F.col("t"), words)).collect()}
        listed = spark.createDataFrame([(w,) for w in words], "word string")
        assert {r["k"] for r in texts_with_any(rows, "k", "t", listed).collect()} == inline


def test_rule_topic(column):
    cases = {
        "呼吁停火": "和平反战",
        "油价上涨": "战争影响",
        "because": "势力评价",  # "us" inside a word
        "ANTI-WAR": "和平反战",
        "anti war": "其他",
        "网友说": "中国态度",
        "空袭": "军事行动",
        "医院": "人道灾难",
        "媒体": "媒体舆论",
        "和平 油价": "和平反战",
        None: "其他",
        "": "其他",
    }
    assert column(list(cases), S.rule_topic) == list(cases.values())


def test_large_lexicon_is_not_broadcast(spark):
    words = spark.range(50).select(F.concat(F.lit("w"), "id").alias("word"))
    counts = spark.range(100).select(F.concat(F.lit("w"), F.col("id")).alias("word"))
    small = M.without_words(counts, "word", words)
    large = M.without_words(counts, "word", words, rows=10)
    assert small.count() == large.count() == 50
    plan = large._jdf.queryExecution().optimizedPlan().toString()
    assert "broadcast" not in plan
    assert "broadcast" in small._jdf.queryExecution().optimizedPlan().toString()
    assert M.inline_words(words, 10) is None and len(M.inline_words(words)) == 50
