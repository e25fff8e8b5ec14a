"""Ids, addresses, counts, times."""

import datetime as dt

from pyspark.sql import functions as F

from opinara.functions import ids


def test_like_count(column):
    cases = {
        "1.2万": 12000, "3 万": 30000, "约2.55万赞": 25500, "3.4K": 3400, "7k": 7000, "1,234": 1234, "56": 56,
        "赞": 0, "": 0, None: 0, "12a": 0, "１２": 12, "1.5": 0, "9" * 30: 0,
    }
    assert column(list(cases), ids.like_count) == list(cases.values())


def test_video_addresses(column):
    cases = {
        "//www.bilibili.com/video/BV1xx411c7mD?p=2": "https://www.bilibili.com/video/BV1xx411c7mD",
        "BV1ab": "https://www.bilibili.com/video/BV1ab",
        "https://example.com": None, "": None, None: None,
    }
    assert column(list(cases), ids.video_url) == list(cases.values())
    assert column(["xxBV12/", "bv12"], ids.video_id) == ["BV12", None]


def test_post_addresses(column):
    cases = {
        "//weibo.com/7488/R3n?refer=1": "https://m.weibo.cn/detail/R3n",
        "/7488/R3n": "https://m.weibo.cn/detail/R3n",
        "https://weibo.com/7488/R3n/": "https://m.weibo.cn/detail/R3n",
        "https://weibo.com/7488/R-3n": "https://weibo.com/7488/R-3n",
        "https://weibo.com/onlyone": "https://weibo.com/onlyone",
        "https://m.weibo.cn/detail/55?x=1#y": "https://m.weibo.cn/detail/55",
        "https://weibo.com/1/R3n;p=1?q": "https://m.weibo.cn/detail/R3n",
        "": "", None: "",
    }
    assert column(list(cases), ids.mobile_url) == list(cases.values())
    assert column(["//a/b", "/b", "c", None], ids.absolute_url) == ["https://a/b", "https://weibo.com/b", "c", ""]


def test_search_addresses(column):
    one = column(["伊朗 美国", "a/b~*"], lambda c: ids.post_search_url(c, F.lit(2)))
    assert one == [
        "https://s.weibo.com/weibo?q=%E4%BC%8A%E6%9C%97%20%E7%BE%8E%E5%9B%BD&page=2",
        "https://s.weibo.com/weibo?q=a/b~%2A&page=2",
    ]
    two = column(["a b/c"], lambda c: ids.video_search_url(c, F.lit(1)))
    assert two == ["https://search.bilibili.com/video?keyword=a+b%2Fc&page=1"]


def test_comment_ids(column):
    import hashlib

    got = column(["12"], lambda c: ids.item_comment_id(F.lit("BV1"), c))
    assert got == [hashlib.md5(b"bilibili_BV1_12").hexdigest()]
    got = column(["文"], lambda c: ids.content_comment_id(F.lit("u"), c))
    assert got == ["weibo_comment_" + hashlib.md5("u文".encode()).hexdigest()]


def test_epoch_text(column):
    cases = {"0": "1970-01-01 00:00:00", "1714521600": "2024-05-01 00:00:00", " 昨天  10:00 ": "昨天 10:00", None: "", "1.5": "1.5"}
    assert column(list(cases), ids.epoch_text) == list(cases.values())
    assert column(["1714521600"], lambda c: ids.epoch_text(c, "Asia/Shanghai")) == ["2024-05-01 08:00:00"]


def test_lenient_time(column):
    cases = {
        "2025-05-01 10:00:00": dt.datetime(2025, 5, 1, 10), "2025-05-01": dt.datetime(2025, 5, 1),
        "2025/5/1": dt.datetime(2025, 5, 1), "2025/05/01 8:30": dt.datetime(2025, 5, 1, 8, 30),
        "06月08日 09:19": None, "5分钟前": None, "": None, None: None, "2025-13-01": None,
    }
    assert column(list(cases), ids.lenient_time) == list(cases.values())


def test_first_truthy_and_json(spark):
    rows = spark.createDataFrame(
        [("a", 1, 2), ("", 1, 2), (None, 0, 2), ("", 0, 0), ("0", 1, 1)], "a string, b long, c long"
    )
    out = rows.select(
        ids.first_truthy(ids.none_if_blank(F.col("a")), ids.none_if_zero(F.col("b")), ids.none_if_zero(F.col("c")), F.lit("z"))
    )
    assert [r[0] for r in out.collect()] == ["a", "1", "2", "z", "0"]
    body = spark.createDataFrame([('{"d":{"n":3}}',), ("{}",), (None,)], "j string")
    got = body.select(ids.json_field(F.col("j"), "$.d.n", F.lit("0"))).collect()
    assert [r[0] for r in got] == ["3", "0", "0"]


def test_platform_name(column):
    cases = {"bilibili_raw": "bilibili", " weibo_raw ": "weibo", "知乎_posts": "zhihu", "微博_raw": "微博_raw"}
    assert column(list(cases), ids.platform_name) == list(cases.values())
