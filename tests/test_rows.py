"""First rows, caps, new rows, sources, posts; also with one group holding most rows."""

from pyspark.sql import functions as F

from opinara.operators import rows as R
from opinara.operators import selection as X
from opinara.plans.landing import reply_run
from opinara.sources.payloads import parse_replies


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def skewed(spark, n=3000):
    """A third of the rows share one key."""
    key = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 500))
    return spark.range(0, n, numPartitions=6).select(key.alias("key"), F.col("id").alias("row_id"))


def test_first_rows_keep_the_first_and_cut_before_the_shuffle(spark):
    text = plan(R.first_rows(skewed(spark), ["key"], ["row_id"]))
    assert text.count("WindowGroupLimit") == 2
    assert text.index("Final") < text.index("Exchange hashpartitioning") < text.index("Partial")
    out = R.first_rows(skewed(spark), ["key"], ["row_id"])
    got = {r["key"]: r["row_id"] for r in out.collect()}
    assert got["hot"] == 0 and len(got) == 501
    assert got["k7"] == 7


def test_cap_per_group(spark):
    out = R.cap_per_group(skewed(spark), ["key"], ["row_id"], 5)
    hot = sorted(r["row_id"] for r in out.where("key = 'hot'").collect())
    assert hot == [0, 3, 6, 9, 12]
    assert out.groupBy("key").count().agg(F.max("count")).first()[0] == 5


def test_long_caps_are_salted(spark, monkeypatch):
    monkeypatch.setattr(R, "EARLY_LIMIT", 3)
    short = R.cap_per_group(skewed(spark), ["key"], [F.desc("row_id")], 3)
    long = R.cap_per_group(skewed(spark), ["key"], [F.desc("row_id")], 40)
    assert "_salt" in plan(long) and "_salt" not in plan(short)
    hot = sorted(r["row_id"] for r in long.where("key = 'hot'").collect())
    assert hot == list(range(2997, 2997 - 120, -3))[::-1]


def test_cap_total_is_a_top_n(spark):
    out = R.cap_total(skewed(spark), [F.desc("row_id")], 4)
    assert [r["row_id"] for r in out.collect()] == [2999, 2998, 2997, 2996]
    assert "TakeOrderedAndProject" in plan(out)


def test_only_new(spark):
    new = spark.createDataFrame([("a", 1), ("b", 2), ("", 3), (None, 4)], "id string, v int")
    known = spark.createDataFrame([("a",), ("",), (None,)], "id string")
    once = R.only_new(new, known, "id")
    assert [(r["id"], r["v"]) for r in once.collect()] == [("b", 2)]
    assert R.only_new(once, known.union(once.select("id")), "id").count() == 0


def test_prefer_source(spark):
    rows = spark.createDataFrame([("x", 2, "a"), ("x", 3, "b"), ("x", 2, "c"), ("y", 3, "d")], "k string, rank int, v string")
    for bounded in (False, True):
        out = R.prefer_source(rows, ["k"], "rank", bounded).select("v")
        assert sorted(r["v"] for r in out.collect()) == ["a", "c", "d"]


def posts(spark, rows):
    return spark.createDataFrame(rows, "keyword_order int, keyword string, page int, pos long, post_url string, post_content string")


def test_post_selection(spark):
    hit, more = "美国空袭伊朗", "美国空袭伊朗导弹"
    rows = posts(spark, [
        (0, "k", 1, 0, "//weibo.com/1/A", hit), (0, "k", 1, 1, "//weibo.com/1/B", more),
        (0, "k", 1, 2, "//weibo.com/1/C", "天气"), (0, "k", 1, 3, "", more), (0, "k", 1, 4, "//weibo.com/1/D", None),
        (0, "k", 2, 0, "//weibo.com/1/A", more), (0, "k", 2, 1, "//weibo.com/1/E", hit),
        (1, "l", 1, 0, "//weibo.com/1/B", hit), (1, "l", 1, 1, "//weibo.com/1/F", hit),
    ])
    out = X.chosen_posts(X.scored_posts(rows), 10)
    got = sorted((r["keyword_order"], r["page"], r["post_url"][-1], r["score"], r["mobile_url"]) for r in out.collect())
    assert got == [
        (0, 1, "A", 5, "https://m.weibo.cn/detail/A"), (0, 1, "B", 6, "https://m.weibo.cn/detail/B"),
        (0, 2, "E", 5, "https://m.weibo.cn/detail/E"), (1, 1, "F", 5, "https://m.weibo.cn/detail/F"),
    ]
    assert X.chosen_posts(X.scored_posts(rows), 1).count() == 1  # B for both keywords


def test_repeats_on_one_page_count_towards_the_limit(spark):
    hit = "美国空袭伊朗"
    rows = posts(spark, [(0, "k", 1, i, "https://weibo.com/1/A", hit) for i in range(3)] + [(0, "k", 1, 9, "https://weibo.com/1/B", hit)])
    assert [r["post_url"][-1] for r in X.chosen_posts(X.scored_posts(rows), 3).collect()] == ["A"]
    assert X.chosen_posts(X.scored_posts(rows), 4).count() == 2


def test_video_selection_and_targets(spark):
    hrefs = [f"//b.tv/video/BV{i % 12}" for i in range(24)] + ["/other"]
    links = spark.createDataFrame([(0, 1, i, h) for i, h in enumerate(hrefs)], "keyword_order int, page int, pos long, href string")
    out = X.chosen_videos(links).orderBy("pos")
    assert [r["video_url"].rsplit("/", 1)[1] for r in out.collect()] == [f"BV{i}" for i in range(8)]
    targets = X.search_targets(spark, ["a", "b c"], 2).orderBy("keyword_order", "page").collect()
    assert [r["url"] for r in targets][2:] == ["https://s.weibo.com/weibo?q=b%20c&page=1", "https://s.weibo.com/weibo?q=b%20c&page=2"]
    assert X.video_search_targets(spark, ["a"]).count() == 2


PAYLOAD = """{"code":0,"data":{"page":{"count":3,"size":20},"replies":[
 {"rpid_str":"11","rpid":11,"like":3,"ctime":1714521600,"member":{"uname":" 张 三 "},"content":{"message":"支持\\n和平"},
  "replies":[{"rpid":12,"like":null,"ctime":null,"member":null,"content":{"message":"agree with you"}},
             {"rpid_str":"11","content":{"message":"重复的编号"}},{"rpid":0,"id":0,"content":{"message":"没有编号"}},{"rpid":13,"content":{"message":"x"}}]},
 {"rpid_str":"","rpid":14,"content":null,"replies":null},
 {"rpid_str":"15","content":{"message":"第二条"},"replies":[]}]}}"""


def payload(spark, item="BV1", rank=1, order=0):
    row = [(order, "k", order, item, "https://v/" + item, rank, 1, PAYLOAD)]
    raw = spark.createDataFrame(row, "keyword_order int, keyword string, item_order int, item_id string, item_url string, source_rank int, page_no int, j string")
    return raw.withColumn("replies", parse_replies(F.col("j"))).drop("j")


def test_reply_run(spark):
    import hashlib

    def md5(x):
        return hashlib.md5(x.encode()).hexdigest()

    known = spark.createDataFrame([(md5("bilibili_BV1_15"),)], "comment_id string")
    rows = reply_run(payload(spark), known, "2025-05-01 00:00:00").collect()
    assert [r["content"] for r in rows] == ["支持 和平", "agree with you", "没有编号"]
    first, second, third = rows
    assert (first["user_name"], first["like_count"], first["publish_time"], first["language"]) == ("张 三", 3, "2024-05-01 00:00:00", "zh")
    assert (second["user_name"], second["like_count"], second["publish_time"], second["language"]) == ("", 0, "", "en")
    assert third["comment_id"] == md5("bilibili_BV1_" + md5("没有编号"))
    assert first["source_url"] == "https://v/BV1" and first["platform"] == "bilibili"


def test_reply_run_falls_back_to_page_texts(spark):
    none = spark.createDataFrame([], "comment_id string")
    texts = spark.createDataFrame(
        [(0, "k", 0, "BV1", "u", 2, 1, 0, "这是页面上的一条评论"), (1, "k", 1, "BV2", "u", 2, 1, 0, "这是页面上的一条评论"), (1, "k", 1, "BV2", "u", 2, 1, 1, "短评")],
        "keyword_order int, keyword string, item_order int, item_id string, item_url string, source_rank int, page_no int, pos int, text string",
    )
    rows = reply_run(payload(spark), none, "t", texts).collect()
    assert [r["content"] for r in rows][-1] == "这是页面上的一条评论" and len(rows) == 5
    capped = reply_run(payload(spark), none, "t", texts, limit=2, total=3).collect()
    assert [r["content"] for r in capped] == ["支持 和平", "agree with you", "这是页面上的一条评论"]
