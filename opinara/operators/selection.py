"""Choice of posts, videos and search targets for a landing run."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import fixed_values as V
from ..functions.ids import absolute_url, mobile_url, post_search_url, video_search_url, video_url
from ..functions.lines import is_relevant, relevance
from ..functions.text import normalize_space
from .columns import computed_once
from .rows import cap_per_group, first_rows


def search_targets(
    spark: SparkSession,
    keywords: Sequence[str],
    pages: int = V.MAX_POST_SEARCH_PAGES,
    url: Callable[[Column, Column], Column] = post_search_url,
) -> DataFrame:
    """``(keyword_order, keyword, page, url)`` of every search page."""
    listed = spark.createDataFrame(list(enumerate(keywords)), "keyword_order int, keyword string")
    return paged_targets(listed, pages, url)


def paged_targets(
    keywords: DataFrame, pages: int = V.MAX_POST_SEARCH_PAGES, url: Callable[[Column, Column], Column] = post_search_url
) -> DataFrame:
    """Adds ``page`` and ``url`` of every search page to a keyword table."""
    paged = keywords.withColumn("page", F.explode(F.sequence(F.lit(1), F.lit(pages))))
    return paged.withColumn("url", url(F.col("keyword"), F.col("page")))


def video_search_targets(
    spark: SparkSession, keywords: Sequence[str], pages: int = V.MAX_VIDEO_SEARCH_PAGES
) -> DataFrame:
    return search_targets(spark, keywords, pages, video_search_url)


def scored_posts(
    candidates: DataFrame,
    score: Callable[[Column], Column] = relevance,
    relevant: Callable[[Column], Column] = is_relevant,
) -> DataFrame:
    """Posts with text and address that fit the topic, with score and mobile address."""
    text, url = F.col("post_content"), absolute_url(F.col("post_url"))
    whole = candidates.where((F.coalesce(text, F.lit("")) != "") & (url != ""))
    shown = computed_once(whole, "_shown", normalize_space(text))
    return shown.where(relevant(F.col("_shown"))).select(
        "keyword_order",
        "keyword",
        "page",
        "pos",
        url.alias("post_url"),
        mobile_url(F.col("post_url")).alias("mobile_url"),
        text.alias("post_content"),
        score(F.col("_shown")).alias("score"),
    )


def chosen_posts(scored: DataFrame, limit: int = V.MAX_POSTS_PER_KEYWORD) -> DataFrame:
    """Best posts per keyword, page by page, each address once over all keywords.

    An address taken on an earlier page of a keyword is skipped there; repeats
    within one page count towards the limit and are dropped at the end. At most
    ``limit`` rows of an address can matter, so each is cut to that many first.
    """
    best = [F.col("page"), F.desc("score"), F.col("pos")]
    few = cap_per_group(scored, ["keyword_order", "post_url"], best, limit)
    first_page = F.min("page").over(Window.partitionBy("keyword_order", "post_url"))
    offered = few.withColumn("_first", first_page).where(F.col("page") == F.col("_first")).drop("_first")
    picked = cap_per_group(offered, ["keyword_order"], best, limit)
    return first_rows(picked, ["post_url"], ["keyword_order", *best])


def chosen_videos(links: DataFrame, limit: int = V.MAX_VIDEOS_PER_KEYWORD) -> DataFrame:
    """First ``limit`` distinct video addresses per keyword from raw links."""
    named = links.withColumn("video_url", video_url(F.col("href"))).where("video_url is not null")
    once = first_rows(named, ["keyword_order", "video_url"], ["page", "pos"])
    return cap_per_group(once, ["keyword_order"], ["page", "pos"], limit).drop("href")
