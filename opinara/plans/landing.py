"""Landing runs: replies, page lines and posts to new comment rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed_values as V
from ..functions import lines as L
from ..functions.ids import content_comment_id
from ..operators import lines as O
from ..operators.columns import to_comment_columns
from ..operators.replies import flatten_replies, landed_comments, page_text_comments, reply_comments
from ..operators.rows import first_rows
from ..operators.selection import chosen_posts, scored_posts


def reply_run(
    payloads: DataFrame,
    known: DataFrame,
    crawl_time: str | Column,
    page_texts: DataFrame | None = None,
    limit: int = V.MAX_COMMENTS_PER_ITEM,
    total: int = V.MAX_COMMENTS_PER_RUN,
) -> DataFrame:
    """New comments of reply payloads, with page texts where an item has no replies."""
    sources = [reply_comments(flatten_replies(payloads), crawl_time)]
    if page_texts is not None:
        sources.append(page_text_comments(page_texts, crawl_time))
    return to_comment_columns(landed_comments(sources, known, limit, total))


def line_run(
    candidates: DataFrame,
    posts: DataFrame,
    crawl_time: str | Column,
    page: str = "post_url",
    language: str = "zh",
    platform: str = "weibo",
    limit: int = V.MAX_COMMENTS_PER_ITEM,
    total: int = V.MAX_COMMENTS_PER_RUN,
) -> DataFrame:
    """Comment rows of a run over pages from their candidates.

    ``posts`` holds address, ``post_order``, ``keyword`` and ``post_content``, one
    row per address. Candidates of pages without a post are not landed: a run opens only
    the pages of its posts.
    """
    known = posts.select(page, "post_order", "keyword", "post_content")
    rows = O.run_comments(O.page_comments(candidates, known, page, "post_content", limit), "post_order", total)
    stamp = F.lit(crawl_time) if isinstance(crawl_time, str) else crawl_time
    user = F.when(F.col("user_name") == "", "unknown").otherwise(F.col("user_name"))
    return to_comment_columns(
        rows.select(
            F.lit(platform).alias("platform"),
            "keyword",
            content_comment_id(F.col(page), F.col("content")).alias("comment_id"),
            user.alias("user_name"),
            "content",
            "publish_time",
            "like_count",
            F.lit(language).alias("language"),
            F.col(page).alias("source_url"),
            stamp.alias("crawl_time"),
        )
    )


def body_run(
    pages: DataFrame, posts: DataFrame, crawl_time: str | Column, rules: L.LineRules = L.DEFAULT, visit: str | None = None, **options
) -> DataFrame:
    """As ``line_run`` from whole page bodies ``(post_url, body)``, any number of them per page if ``visit`` orders them.

    Bodies are matched with the addresses of the posts before they are read, so only those of opened pages are parsed.
    """
    opened = pages.join(posts.select("post_url"), "post_url", "left_semi")
    return line_run(O.candidates_from_bodies(opened, "post_url", "body", rules, visit), posts, crawl_time, **options)


def post_run(candidates: DataFrame, limit: int = V.MAX_POSTS_PER_KEYWORD, **scoring) -> DataFrame:
    """Posts to open, each address once: the ``posts`` of a line run.

    Comments are kept under the mobile address; ``post_order`` is the place of
    the post in the run. Of posts that share a mobile address the first of the run is opened.
    """
    chosen = chosen_posts(scored_posts(candidates, **scoring), limit)
    place = F.struct("keyword_order", "page", (-F.col("score")).alias("score"), "pos", F.col("post_url").alias("url"))
    opened = chosen.select(
        F.col("mobile_url").alias("post_url"), place.alias("post_order"), "keyword", "post_content", "score"
    )
    return first_rows(opened, ["post_url"], ["post_order"])
