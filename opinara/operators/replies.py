"""Reply payloads: nested replies and page texts to comment rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed_values as V
from ..functions.ids import epoch_text, first_truthy, item_comment_id, none_if_blank, none_if_zero
from ..functions.lines import is_widget_comment
from ..functions.text import detect_language_simple, normalize_space
from .columns import computed_once, exploded
from .rows import cap_per_group, cap_total, first_rows, only_new, prefer_source

_BODY = (
    "rpid_str: string, rpid: bigint, id: bigint, like: bigint, ctime: bigint, "
    "member: struct<uname: string>, content: struct<message: string>"
)
REPLY_FIELDS = ("rpid_str", "rpid", "id", "like", "ctime", "member", "content")
REPLIES_TYPE = f"array<struct<{_BODY}, replies: array<struct<{_BODY}>>>>"

# keyword_order, item_order: place of the item in the run; page_no, pos: place of the reply
RUN_ORDER = ("keyword_order", "item_order", "page_no", "pos")


def in_order(replies: Column) -> Column:
    """Each reply followed by its own children, one level deep."""

    def plain(reply: Column) -> Column:
        return F.struct(*[reply[f].alias(f) for f in REPLY_FIELDS])

    def family(reply: Column) -> Column:
        own, children = F.array(plain(reply)), F.transform(reply["replies"], plain)
        return F.when(reply["replies"].isNull(), own).otherwise(F.concat(own, children))

    return F.flatten(F.transform(replies, family))


def flatten_replies(payloads: DataFrame, replies: str = "replies") -> DataFrame:
    """One row per reply, its place in the payload as ``pos``."""
    others = [c for c in payloads.columns if c != replies]
    return exploded(payloads, others, in_order(F.col(replies)), "pos", "reply")


def reply_comments(
    flat: DataFrame, crawl_time: str | Column, platform: str = "bilibili", zone: str = "UTC"
) -> DataFrame:
    """Comment columns from single replies; texts under two characters are left out."""
    content = F.col("content")
    own_id = first_truthy(
        none_if_blank(F.col("reply.rpid_str")),
        none_if_zero(F.col("reply.rpid")),
        none_if_zero(F.col("reply.id")),
        F.md5(content),
    )
    stamp = F.lit(crawl_time) if isinstance(crawl_time, str) else crawl_time
    place = [c for c in flat.columns if c != "reply"]
    rows = computed_once(flat, "content", normalize_space(F.col("reply.content.message")))
    return rows.where(F.length(content) >= 2).select(
        *place,
        F.lit(platform).alias("platform"),
        item_comment_id(F.col("item_id"), own_id, platform).alias("comment_id"),
        normalize_space(F.col("reply.member.uname")).alias("user_name"),
        "content",
        epoch_text(F.col("reply.ctime"), zone).alias("publish_time"),
        F.coalesce(F.col("reply.like"), F.lit(0).cast("long")).alias("like_count"),
        detect_language_simple(content).alias("language"),
        F.col("item_url").alias("source_url"),
        stamp.alias("crawl_time"),
    )


def page_text_comments(
    texts: DataFrame, crawl_time: str | Column, platform: str = "bilibili"
) -> DataFrame:
    """Comment columns from bare page texts: the digest of the text is the id."""
    content = F.col("content")
    stamp = F.lit(crawl_time) if isinstance(crawl_time, str) else crawl_time
    place = [c for c in texts.columns if c != "text"]
    blank = F.lit("")
    rows = computed_once(texts, "content", normalize_space(F.col("text")))
    return rows.where(is_widget_comment(content)).select(
        *place,
        F.lit(platform).alias("platform"),
        item_comment_id(F.col("item_id"), F.md5(content), platform).alias("comment_id"),
        blank.alias("user_name"),
        "content",
        blank.alias("publish_time"),
        F.lit(0).cast("long").alias("like_count"),
        detect_language_simple(content).alias("language"),
        F.col("item_url").alias("source_url"),
        stamp.alias("crawl_time"),
    )


def item_comments(rows: DataFrame, limit: int = V.MAX_COMMENTS_PER_ITEM) -> DataFrame:
    """Per item and source: first row of each id, then the first ``limit`` rows."""
    item = ["keyword_order", "item_id", "source_rank"]
    once = first_rows(rows, [*item, "comment_id"], ["page_no", "pos"])
    return cap_per_group(once, item, ["page_no", "pos"], limit)


def landed_comments(
    sources: Sequence[DataFrame],
    known: DataFrame,
    limit: int = V.MAX_COMMENTS_PER_ITEM,
    total: int = V.MAX_COMMENTS_PER_RUN,
) -> DataFrame:
    """New comment rows of one run from several ranked sources.

    Duplicates go before the caps, the preferred source per item after them.
    """
    rows = reduce(lambda a, b: a.unionByName(b), sources)
    capped = item_comments(rows, limit)
    chosen = prefer_source(capped, ["keyword_order", "item_id"], "source_rank", bounded=True)
    fresh = first_rows(only_new(chosen, known, "comment_id"), ["comment_id"], RUN_ORDER)
    return cap_total(fresh, RUN_ORDER, total)
