"""Page lines: predicates, look-ahead windows, comment extraction."""

import pytest
from pyspark.sql import functions as F

from opinara.functions import lines as L
from opinara.operators import lines as O
from opinara.plans.landing import body_run, line_run, post_run

TIMES = {
    "06月08日 09:19": True, "6月8日 9:19": True, "25-6-8 9:19": True, "2025-06-08": True, "5分钟前": True,
    "3小时前": True, "刚刚": True, "昨天 10:00": True, "今天 1:05": True, "明天 10:00": False, "10:00": False, "2025": False,
}


def test_time_lines(column):
    assert column(list(TIMES), L.is_time_line) == list(TIMES.values())


def test_noise_lines(column):
    cases = {
        "": True, "赞": True, "点赞了": False, "共12条评论": True, "刚刚 来自网页": True, "09:19 来自湖北": True, "来自湖北": True,
        "来自湖北的朋友们都来了吧": False, "123": True, "123a": False, "支持和平": False, "小广告": True,
    }
    assert column(list(cases), L.is_noise_line) == list(cases.values())


def test_names(column):
    cases = {
        "张三": True, "a" * 30: True, "a" * 31: False, "": False, "张三，李四": False, "快讯中心": False, "12/30活动": False,
        "time10:30": False, "回复": False, "用户-1-2": False, "李.四!": True, "外媒": False, "12345": False, "谁？": False,
    }
    assert column(list(cases), L.looks_like_name) == list(cases.values())


def test_comment_texts(column):
    cases = {
        "支持和平": True, "和平": False, "a" * 50: False, "和" + "a" * 219: True, "和" + "a" * 220: False, "和！！": False,
        "和_a!b": True, "来自湖北": False, "他5分钟前说的": False,
    }
    assert column(list(cases), L.is_comment_text) == list(cases.values())


def test_split_at_colon(column):
    cases = {
        "张三：支持和平吧": ("张三", "支持和平吧"),
        "张三: 支持和平吧": ("张三", "支持和平吧"),
        "a:b：支持和平吧": ("a:b", "支持和平吧"),  # the full-width mark goes first
        "张三：一：二三四": ("张三", "一：二三四"),
        "张三：好": None,
        "快讯：支持和平吧": None,
        "没有标记": None,
        "：支持和平吧": None,
    }
    got = column(list(cases), L.split_at_colon)
    assert [None if r is None else tuple(r) for r in got] == list(cases.values())


def test_repeats_post(spark):
    long = "一二三四五六七八九十" * 2
    cases = [
        ("支持", "我支持和平", True), ("我支持和平啊", "支持和平", True), (long + "甲", "乙" + long + "丙", True),
        ("甲" + long, long + "乙", True), ("反对", "支持", False), ("", "支持", False), ("支持", "", False), (None, "x", False),
    ]
    rows = spark.createDataFrame(cases, "c string, p string, e boolean")
    out = rows.select("e", L.repeats_post(F.col("c"), F.col("p")).alias("g")).collect()
    assert [r["g"] for r in out] == [r["e"] for r in out]


def test_relevance(column):
    cases = {"伊朗与以色列": 4, "美国空袭伊朗": 5, "战争冲突": 2, "袭击": 2, "以色列国防军": 4, "天气": 0}
    assert column(list(cases), L.relevance) == list(cases.values())
    fits = {"袭击 冲突": True, "美国说": False, "美国和伊朗": True, "战争": False, "": False, "美国开战": True}
    assert column(list(fits), L.is_relevant) == list(fits.values())


def test_widget_comment(column):
    cases = {"1234567": False, "12345678": True, "a" * 2000: True, "a" * 2001: False, "请先立即登录再来": False}
    assert column(list(cases), L.is_widget_comment) == list(cases.values())


def test_body_lines(column):
    got = column(["a\r\nb\n\n  \nc d\x0be\x1cf\u2028g", "", None], O.body_lines)
    assert got == [["a", "b", "c d", "e", "f", "g"], [], []]


@pytest.mark.parametrize("chunk", [10, 16, 4096])
def test_lookahead_equals_a_plain_scan(spark, chunk):
    """One page holds a third of all lines and spans many chunks."""
    sizes = {"big": 200, "mid": 37, "one": 1, **{f"p{i}": 15 for i in range(24)}}
    rows = [(p, i, (i * 7 + len(p)) % 11) for p, n in sizes.items() for i in range(n)]
    lines = spark.createDataFrame(rows, "page string, line_no long, v int")
    found = {"near": (F.when(F.col("v") < 2, F.col("v")), 1, 5), "far": (F.when(F.col("v") == 9, F.col("line_no")), 2, 10)}
    got = {(r["page"], r["line_no"]): (r["near"], r["far"]) for r in O.with_lookahead(lines, "page", "line_no", found, chunk).collect()}
    value = {(p, i): v for p, i, v in rows}
    assert len(got) == len(rows)
    for (page, i), pair in got.items():
        near = next((value[page, j] for j in range(i + 1, i + 6) if value.get((page, j), 99) < 2), None)
        far = next((j for j in range(i + 2, i + 11) if value.get((page, j)) == 9), None)
        assert pair == (near, far)


def test_renumber_over_several_chunks(spark, monkeypatch):
    monkeypatch.setattr(O, "NUMBER_CHUNK", 8)
    rows = [("p", i * 3, "x" if i % 4 else " ") for i in range(40)] + [("q", 5, "y")]
    out = O.renumber_lines(spark.createDataFrame(rows, "p string, n int, l string"), "p", "n", "l")
    got = sorted((r["p"], r["line_no"]) for r in out.collect())
    assert got == [("p", i) for i in range(30)] + [("q", 0)]


BODY = "\n".join([
    "微博正文", "原文说了很多话在这里", "张三：支持和平解决问题", "06月08日 09:19 来自湖北", "赞", "1.2万",
    "李四", "反对战争需要对话", "甲乙", "丙丁", "戊己", "庚辛", "昨天 10:00", "35",
    "王五：支持和平解决问题", "赵六：原文说了很多话在这里啊", "孙七: 最后再说一句话", "评论",
])


def pages(spark):
    body = spark.createDataFrame([("u1", BODY), ("u2", "周八：反对战争需要对话\n吴九：另外一条新的")], "post_url string, body string")
    posts = spark.createDataFrame([("u1", 1, "k1", "原文说了很多话在这里"), ("u2", 2, "k2", "别的")], "post_url string, post_order int, keyword string, post_content string")
    return body, posts


def test_both_ways_of_extraction(spark):
    body, posts = pages(spark)
    found = sorted(map(tuple, O.candidates_from_bodies(body, "post_url", "body").collect()))
    lines = O.page_lines(body, "post_url", "body")
    assert found == sorted(map(tuple, O.candidates_from_lines(lines, "post_url").collect()))
    first = [r for r in found if r[:2] == ("u1", 2)][0]
    assert first[2:] == (1, "张三", "支持和平解决问题", "06月08日 09:19 来自湖北", 12000)
    # "李四" and its text: the time line is the fifth after the text, the count the sixth
    second = [r for r in found if r[:2] == ("u1", 6)][0]
    assert second[2:] == (2, "李四", "反对战争需要对话", "昨天 10:00", 35)


def test_run_over_pages(spark):
    body, posts = pages(spark)
    rows = body_run(body, posts, "2025-06-09 00:00:00").collect()
    by_text = {r["content"]: r for r in rows}
    assert len(by_text) == len(rows)
    assert by_text["支持和平解决问题"]["user_name"] == "张三"
    assert by_text["反对战争需要对话"]["source_url"] == "u1"  # first page keeps it
    assert "原文说了很多话在这里啊" not in by_text  # repeats the post
    assert by_text["另外一条新的"]["keyword"] == "k2"
    assert by_text["最后再说一句话"]["like_count"] == 0
    assert all(r["platform"] == "weibo" and r["language"] == "zh" and r["crawl_time"] == "2025-06-09 00:00:00" for r in rows)
    few = line_run(O.candidates_from_bodies(body, "post_url", "body"), posts, "t", limit=1, total=1).collect()
    # the body line passes as a name, so the whole next line is its comment
    assert [(r["user_name"], r["content"]) for r in few] == [("原文说了很多话在这里", "张三：支持和平解决问题")]


def test_chosen_posts_feed_a_line_run(spark):
    hit, more = "美国空袭伊朗", "美国空袭伊朗导弹"
    found = spark.createDataFrame(
        [(0, "k", 1, 0, "//weibo.com/1/A", hit), (0, "k", 1, 1, "//weibo.com/1/B", more)],
        "keyword_order int, keyword string, page int, pos long, post_url string, post_content string",
    )
    body = spark.createDataFrame(
        [("https://m.weibo.cn/detail/A", "张三：支持和平解决"), ("https://m.weibo.cn/detail/B", "李四：支持和平解决\n王五：反对战争吧")],
        "post_url string, body string",
    )
    rows = body_run(body, post_run(found), "t").collect()
    # B scores higher; its first line also passes as a name above the second
    assert [(r["user_name"], r["content"]) for r in rows] == [
        ("李四", "支持和平解决"), ("李四：支持和平解决", "王五：反对战争吧"), ("王五", "反对战争吧"),
    ]
    assert {r["source_url"] for r in rows} == {"https://m.weibo.cn/detail/B"}


def test_like_count_reach(spark):
    def body(gap):
        return "张三：支持和平解决\n" + "甲乙\n" * (gap - 1) + "88"

    rows = spark.createDataFrame([(g, body(g)) for g in (9, 10)], "post_url int, body string")
    out = O.candidates_from_bodies(rows, "post_url", "body").where("form = 1").collect()
    assert {r["post_url"]: r["like_count"] for r in out} == {9: 88, 10: 0}


def test_time_reach(spark):
    def body(gap):
        return "张三：支持和平解决\n" + "甲乙\n" * (gap - 1) + "刚刚"

    rows = spark.createDataFrame([(g, body(g)) for g in (5, 6)], "post_url int, body string")
    out = O.candidates_from_bodies(rows, "post_url", "body").where("form = 1").collect()
    assert {r["post_url"]: r["publish_time"] for r in out} == {5: "刚刚", 6: ""}


def test_several_bodies_of_a_page_read_as_one_after_the_other(spark):
    _, posts = pages(spark)
    first, second = BODY.split("\n")[: BODY.count("\n") // 2], BODY.split("\n")[BODY.count("\n") // 2 :]
    visits = [("u1", 10_000_000_000, "\n".join(second)), ("u1", 3, "\n".join(first)), ("u2", 5, "周八：反对战争需要对话"), ("u9", 1, "甲：没有帖子的页面")]
    bodies = spark.createDataFrame(visits, "post_url string, seen long, body string").repartition(3)
    found = O.candidates_from_bodies(bodies, "post_url", "body", visit="seen").where("post_url = 'u1'")
    # the same comments as of each body alone, the earlier visit first
    alone = [O.candidates_from_bodies(spark.createDataFrame([("u1", "\n".join(x))], "post_url string, body string"), "post_url", "body") for x in (first, second)]
    wanted = [tuple(r)[2:] for frame in alone for r in frame.orderBy("line_no", "form").collect()]
    assert [tuple(r)[2:] for r in found.orderBy("line_no", "form").collect()] == wanted and wanted
    rows = body_run(bodies, posts, "t", visit="seen").collect()
    assert len({r["content"] for r in rows}) == len(rows) and {r["source_url"] for r in rows} <= {"u1", "u2"}
    few = body_run(bodies, posts, "t", visit="seen", limit=1).where("source_url = 'u1'").collect()
    kept = [w for w in wanted if w[2] != "原文说了很多话在这里啊"]
    assert [r["content"] for r in few] == [kept[0][2]]
