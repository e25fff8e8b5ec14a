"""Landed JSON payloads of comment interfaces."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.segment import html_unescape
from ..operators.replies import REPLIES_TYPE

ITEM_FIELDS = (
    "keyword_order int, keyword string, item_order int, item_id string, item_url string, "
    "source_rank int, page_no int"
)
REPLY_PAYLOAD = f"{ITEM_FIELDS}, code int, data struct<page: struct<count: int, size: int>, replies: {REPLIES_TYPE}>"
THREAD_PAYLOAD = (
    "video_title string, video_id string, items array<struct<snippet: struct<topLevelComment: "
    "struct<snippet: struct<textDisplay: string>>>>>"
)


def reply_payloads(spark: SparkSession, path: str) -> DataFrame:
    """One row per landed page of replies; failed requests (``code`` not 0) are left out."""
    pages = spark.read.schema(REPLY_PAYLOAD).json(path)
    fields = [f.split()[0] for f in ITEM_FIELDS.split(", ")]
    return pages.where(F.col("code") == 0).select(*fields, F.col("data.replies").alias("replies"))


def parse_replies(payload) -> DataFrame:
    """Replies of a JSON text column."""
    return F.from_json(payload, f"struct<code: int, data: struct<replies: {REPLIES_TYPE}>>")["data"]["replies"]


def thread_comments(spark: SparkSession, path: str) -> DataFrame:
    """``(video_title, video_id, comment)`` with HTML entities decoded."""
    threads = spark.read.schema(THREAD_PAYLOAD).json(path)
    rows = threads.select("video_title", "video_id", F.explode("items").alias("item"))
    comment = F.col("item.snippet.topLevelComment.snippet.textDisplay")
    return rows.where(comment.isNotNull()).select(
        html_unescape("video_title").alias("video_title"),
        "video_id",
        html_unescape(comment).alias("comment"),
    )
