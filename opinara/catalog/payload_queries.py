"""Reply payloads, ids, addresses and other single values; streams over whole tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import ids, text
from ..functions.lines import is_widget_comment
from ..functions.segment import html_unescape
from ..operators import replies as R
from ..plans.landing import reply_run
from ..session import work_path
from ..sources.payloads import parse_replies
from ..streaming import caps, incremental, trend
from . import base as B
from .base import query, table

STAMP = "2025-05-01 00:00:00"


def payloads(spark: SparkSession, folder: str) -> DataFrame:
    """Every turn as a payload: the turn is a reply, its sentences are the children.

    The turns of one role in a conversation form an item; the payload is written
    as JSON text and read back the way a landed payload is.
    """
    turns = table(spark, folder, "conversations")
    sentences = F.transform(
        F.split("text", r"\. "),
        lambda s, i: F.struct(
            F.lit("").alias("rpid_str"),
            F.lit(0).cast("long").alias("rpid"),
            F.when(i % 2 == 0, (F.col("conv_id") * 1000 + F.col("turn") * 100 + i + 1).cast("long")).alias("id"),
            i.cast("long").alias("like"),
            (F.lit(1700000000) + F.col("conv_id") * 60 + i).cast("long").alias("ctime"),
            F.struct(F.col("role").alias("uname")).alias("member"),
            F.struct(s.alias("message")).alias("content"),
        ),
    )
    parent = F.struct(
        F.concat(F.lit("p"), F.col("conv_id"), F.lit("-"), F.col("turn")).alias("rpid_str"),
        F.lit(None).cast("long").alias("rpid"),
        F.lit(None).cast("long").alias("id"),
        F.lit(None).cast("long").alias("like"),
        F.lit(None).cast("long").alias("ctime"),
        F.when(F.col("role") != "assistant", F.struct(F.col("role").alias("uname"))).alias("member"),
        F.struct(F.col("text").alias("message")).alias("content"),
        F.when(F.col("role") != "user", sentences).alias("replies"),
    )
    body = F.to_json(F.struct(F.lit(0).alias("code"), F.struct(F.array(parent).alias("replies")).alias("data")))
    return turns.select(*item_columns(1), "role", parse_replies(body).alias("replies"))


def item_columns(source_rank: int) -> list[Column]:
    item = F.concat(F.lit("BV"), F.col("conv_id"), F.col("role"))
    return [
        F.length("role").alias("keyword_order"),
        F.col("role").alias("keyword"),
        F.col("conv_id").cast("int").alias("item_order"),
        item.alias("item_id"),
        F.concat(F.lit("https://www.bilibili.com/video/"), item).alias("item_url"),
        F.lit(source_rank).alias("source_rank"),
        F.col("turn").cast("int").alias("page_no"),
    ]


FLAT = (
    "parents AS (SELECT conv_id, turn, role, text, 0 AS pos, 'p' || conv_id || '-' || turn AS own, CASE WHEN role <> 'assistant' THEN role END AS uname, "
    "text AS message, NULL::BIGINT AS likes, NULL::BIGINT AS ctime FROM conversations), "
    "parts AS (SELECT conv_id, turn, role, unnest(p) AS message, generate_subscripts(p, 1) - 1 AS i FROM "
    "(SELECT *, string_split(text, '. ') AS p FROM conversations WHERE role <> 'user')), "
    "kids AS (SELECT conv_id, turn, role, i + 1 AS pos, CASE WHEN i % 2 = 0 THEN (conv_id * 1000 + turn * 100 + i + 1)::VARCHAR END AS own, "
    "role AS uname, message, i::BIGINT AS likes, (1700000000 + conv_id * 60 + i)::BIGINT AS ctime FROM parts), "
    "flat AS (SELECT conv_id, turn, role, pos, own, uname, message, likes, ctime FROM parents UNION ALL BY NAME SELECT conv_id, turn, role, pos, own, uname, message, likes, ctime FROM kids), "
    f"texts AS (SELECT *, {B.space_sql('message')} AS content FROM flat), "
    "comments AS (SELECT conv_id, turn, role, pos, md5('bilibili_BV' || conv_id || role || '_' || coalesce(own, md5(content))) AS comment_id, "
    "coalesce(uname, '') AS user_name, content, coalesce(strftime(make_timestamp(ctime * 1000000), '%Y-%m-%d %H:%M:%S'), '') AS publish_time, "
    "coalesce(likes, 0) AS like_count, "
    r"CASE WHEN regexp_full_match(content, '[a-zA-Z\s\p{Z}\p{Nd}.,!?;:''\"()\-_/]+') THEN 'en' ELSE 'other' END AS language "
    "FROM texts WHERE length(content) >= 2)"
).replace('\\"', '"')


@query(f"WITH {FLAT} SELECT conv_id::INT AS item_order, turn::INT AS page_no, pos::INT AS pos, message FROM flat")
def reply_flatten(spark: SparkSession, folder: str) -> DataFrame:
    flat = R.flatten_replies(payloads(spark, folder))
    return flat.select("item_order", "page_no", "pos", F.col("reply.content.message").alias("message"))


@query(
    f"WITH {FLAT} SELECT conv_id::INT AS item_order, turn::INT AS page_no, pos::INT AS pos, comment_id, user_name, content, publish_time, like_count, language FROM comments"
)
def reply_comments(spark: SparkSession, folder: str) -> DataFrame:
    rows = R.reply_comments(R.flatten_replies(payloads(spark, folder)), STAMP)
    return rows.select(
        "item_order", "page_no", "pos", "comment_id", "user_name", "content", "publish_time", "like_count", "language"
    )


LANDED = (
    f"{FLAT}, texts2 AS (SELECT conv_id, turn, role, {B.space_sql('text')} AS content FROM conversations), "
    "fallback AS (SELECT conv_id, turn, role, 0 AS pos, md5('bilibili_BV' || conv_id || role || '_' || md5(content)) AS comment_id, '' AS user_name, content, "
    "'' AS publish_time, 0::BIGINT AS like_count, "
    r"CASE WHEN regexp_full_match(content, '[a-zA-Z\s\p{Z}\p{Nd}.,!?;:''\"()\-_/]+') THEN 'en' ELSE 'other' END AS language "
    "FROM texts2 WHERE length(content) BETWEEN 8 AND 2000), "
    "all_rows AS (SELECT *, 1 AS rank FROM comments WHERE role <> 'system' UNION ALL SELECT conv_id, turn, role, pos, comment_id, user_name, content, publish_time, like_count, language, 2 FROM fallback), "
    "once AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, rank, comment_id ORDER BY turn, pos) AS i FROM all_rows), "
    "capped AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, rank ORDER BY turn, pos) AS j FROM once WHERE i = 1), "
    "best AS (SELECT *, min(rank) OVER (PARTITION BY conv_id, role) AS b FROM capped WHERE j <= 12), "
    "known AS (SELECT comment_id FROM comments WHERE like_count = 2), "
    "fresh AS (SELECT *, row_number() OVER (PARTITION BY comment_id ORDER BY length(role), conv_id, turn, pos) AS k FROM best "
    "WHERE rank = b AND comment_id NOT IN (SELECT comment_id FROM known)) "
).replace('\\"', '"')


@query(
    f"WITH {LANDED} SELECT 'bilibili' AS platform, role AS keyword, comment_id, user_name, content, publish_time, like_count, language, "
    f"'https://www.bilibili.com/video/BV' || conv_id || role AS source_url, '{STAMP}' AS crawl_time FROM fresh WHERE k = 1 "
    "ORDER BY length(role), conv_id, turn, pos LIMIT 1500"
)
def landing_run(spark: SparkSession, folder: str) -> DataFrame:
    """A whole landing run: replies first, page texts for items without any."""
    every = payloads(spark, folder)
    replies = every.where(F.col("role") != "system").drop("role")
    texts = table(spark, folder, "conversations").select(*item_columns(2), F.lit(0).alias("pos"), "text")
    earlier = R.reply_comments(R.flatten_replies(every), STAMP).where("like_count = 2")
    return reply_run(replies, earlier.select("comment_id"), STAMP, texts, limit=12)


@query(
    "SELECT event_id, CASE WHEN user_id % 2 = 0 THEN 'u' || user_id WHEN event_id % 3 <> 0 THEN (event_id % 3)::VARCHAR ELSE md5(event_type) END AS own FROM events"
)
def first_truthy(spark: SparkSession, folder: str) -> DataFrame:
    """First usable id: a text, else a number other than 0, else a digest."""
    own = ids.first_truthy(
        ids.none_if_blank(F.when(F.col("user_id") % 2 == 0, F.concat(F.lit("u"), F.col("user_id"))).otherwise("")),
        ids.none_if_zero(F.col("event_id") % 3),
        F.md5("event_type"),
    )
    return table(spark, folder, "events").select("event_id", own.alias("own"))


@query("SELECT event_id, json_extract_string(props, '$.k') AS k, 'none' AS missing FROM events")
def json_field(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").select(
        "event_id",
        ids.json_field(F.col("props"), "$.k", F.lit("")).alias("k"),
        ids.json_field(F.col("props"), "$.absent", F.lit("none")).alias("missing"),
    )


@query(
    "SELECT doc_id, md5('bilibili_' || source || '_' || doc_id) AS comment_id, 'weibo_comment_' || md5(source || text) AS content_id FROM documents"
)
def comment_id(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").select(
        "doc_id",
        ids.item_comment_id(F.col("source"), F.col("doc_id").cast("string")).alias("comment_id"),
        ids.content_comment_id(F.col("source"), F.col("text")).alias("content_id"),
    )


PATH = r"trim(regexp_replace(regexp_extract(u, '^(?:[^:/?#]+:)?(?://[^/?#]*)?([^?#]*)', 1), ';[^/]*$', ''), '/')"


@query(
    f"WITH a AS (SELECT page_id, CASE page_id % 4 WHEN 0 THEN regexp_replace(url, '^https?:', '') WHEN 1 THEN regexp_replace(url, '^https?://[^/]*', '') "
    "WHEN 2 THEN url ELSE 'https://m.weibo.cn/detail/' || page_id || '?x=1' END AS raw FROM pages), "
    "b AS (SELECT *, CASE WHEN starts_with(raw, '//') THEN 'https:' || raw WHEN starts_with(raw, '/') THEN 'https://weibo.com' || raw ELSE raw END AS u FROM a), "
    rf"c AS (SELECT *, {PATH} AS path FROM b) "
    "SELECT page_id, u AS absolute, CASE WHEN contains(u, 'm.weibo.cn/detail/') THEN string_split(u, '?')[1] "
    "WHEN regexp_matches(path, '/[A-Za-z0-9]+$') THEN 'https://m.weibo.cn/detail/' || regexp_extract(path, '/([A-Za-z0-9]+)$', 1) ELSE u END AS mobile FROM c"
)
def url_normalize(spark: SparkSession, folder: str) -> DataFrame:
    url, kind = F.col("url"), F.col("page_id") % 4
    raw = (
        F.when(kind == 0, F.regexp_replace(url, "^https?:", ""))
        .when(kind == 1, F.regexp_replace(url, "^https?://[^/]*", ""))
        .when(kind == 2, url)
        .otherwise(F.concat(F.lit("https://m.weibo.cn/detail/"), F.col("page_id"), F.lit("?x=1")))
    )
    rows = table(spark, folder, "pages").select("page_id", raw.alias("raw"))
    return rows.select(
        "page_id", ids.absolute_url(F.col("raw")).alias("absolute"), ids.mobile_url(F.col("raw")).alias("mobile")
    )


@query(
    "SELECT page_id, CASE WHEN regexp_matches(html, 'BV[0-9A-Za-z]+') THEN 'https://www.bilibili.com/video/' || regexp_extract(html, 'BV[0-9A-Za-z]+') END AS in_page, "
    "'https://www.bilibili.com/video/BV' || page_id || 'x' AS named FROM pages"
)
def video_url(spark: SparkSession, folder: str) -> DataFrame:
    named = F.concat(F.lit("//b.tv/video/BV"), F.col("page_id"), F.lit("x?p=1"))
    return table(spark, folder, "pages").select(
        "page_id", ids.video_url(F.col("html")).alias("in_page"), ids.video_url(named).alias("named")
    )


@query(
    "SELECT event_id, CASE event_id % 4 WHEN 0 THEN trunc(value * 10000)::BIGINT WHEN 1 THEN trunc(value * 1000)::BIGINT "
    "WHEN 2 THEN user_id * 1001 ELSE 0 END AS likes FROM events"
)
def like_count(spark: SparkSession, folder: str) -> DataFrame:
    value, kind = F.col("value"), F.col("event_id") % 4
    shown = (
        F.when(kind == 0, F.concat(value.cast("string"), F.lit(" 万")))
        .when(kind == 1, F.concat(value.cast("string"), F.lit("k")))
        .when(kind == 2, F.format_number(F.col("user_id") * 1001, 0))
        .otherwise("many")
    )
    return table(spark, folder, "events").select("event_id", ids.like_count(shown).alias("likes"))


@query(
    "SELECT event_id, CASE WHEN event_id % 5 = 0 THEN 'later today' ELSE strftime(make_timestamp((1700000000 + event_id) * 1000000), '%Y-%m-%d %H:%M:%S') END AS shown, "
    "CASE WHEN event_id % 5 = 0 THEN 'later today' ELSE strftime(make_timestamp((1700000000 + event_id + 28800) * 1000000), '%Y-%m-%d %H:%M:%S') END AS shown_shanghai FROM events"
)
def epoch_text(spark: SparkSession, folder: str) -> DataFrame:
    raw = F.when(F.col("event_id") % 5 == 0, " later  today ").otherwise((F.col("event_id") + 1700000000).cast("string"))
    return table(spark, folder, "events").select(
        "event_id", ids.epoch_text(raw).alias("shown"), ids.epoch_text(raw, "Asia/Shanghai").alias("shown_shanghai")
    )


@query(
    f"""SELECT page_id AS video_id, {B.unescape_sql("regexp_extract(html, '<title>([^<]*)</title>', 1)")} AS video_title FROM pages"""
)
def thread_titles(spark: SparkSession, folder: str) -> DataFrame:
    """Titles out of whole pages with their entities decoded."""
    title = F.regexp_extract("html", "<title>([^<]*)</title>", 1)
    return table(spark, folder, "pages").select(F.col("page_id").alias("video_id"), html_unescape(title).alias("video_title"))


@query(
    f"SELECT conv_id, turn, {B.space_sql('text')} AS content FROM conversations WHERE length({B.space_sql('text')}) BETWEEN 8 AND 2000 "
    f"AND NOT {B.contains_sql(B.space_sql('text'), ('best', 'thth', 'que la'))}"
)
def widget_texts(spark: SparkSession, folder: str) -> DataFrame:
    """Page texts that pass as comments."""
    content = text.normalize_space(F.col("text"))
    rows = table(spark, folder, "conversations").select("conv_id", "turn", content.alias("content"))
    return rows.where(is_widget_comment(F.col("content"), ("best", "thth", "que la")))


@query(
    f"WITH {B.EVENTS} SELECT strftime(ts, '%Y-%m-%d') AS date, round(avg(sentiment_score), 9) AS avg_score, count(*) AS n FROM scored GROUP BY 1"
)
def stream_daily_trend(spark: SparkSession, folder: str) -> DataFrame:
    """The daily trend computed by a stream over the events table."""
    schema = table(spark, folder, "events").schema
    events = spark.readStream.schema(schema).parquet(f"{folder}/events*.parquet")
    score = F.least(F.lit(1.0), F.col("value") / F.lit(B.EVENT_SCALE))
    scored = events.select(F.col("ts").alias("at"), score.alias("score"))
    out = work_path(spark, "trend")
    trend.write_open_trend(trend.daily_trend(scored, "at", "score"), out, out + "-state").awaitTermination()
    return spark.read.parquet(out).select(
        F.col("date").cast("string").alias("date"), F.round("avg_score", 9).alias("avg_score"), "n"
    )


@query(
    f"WITH t AS (SELECT md5(text) AS comment_id, {B.clean_sql('text')} AS cleaned_text FROM documents) SELECT DISTINCT comment_id, cleaned_text FROM t"
)
def stream_incremental(spark: SparkSession, folder: str) -> DataFrame:
    """Documents landed twice by a stream; each text is appended once."""
    schema = table(spark, folder, "documents").schema
    rows = spark.readStream.schema(schema).parquet(f"{folder}/documents*.parquet")
    landed = incremental.with_clean_text(rows, "text").withColumn("comment_id", F.md5("text"))
    out = work_path(spark, "landed")
    for run in ("first", "second"):
        incremental.append_stream(landed, out, f"{out}-{run}", order=("doc_id",)).awaitTermination()
    return spark.read.parquet(out).select("comment_id", "cleaned_text")


@query(
    "WITH r AS (SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS i FROM documents) "
    "SELECT doc_id, source FROM r WHERE i <= 7 ORDER BY doc_id LIMIT 120"
)
def stream_capped(spark: SparkSession, folder: str) -> DataFrame:
    """Documents that arrive in four parts, seven of a source and 120 of the run, counted over all parts."""
    docs = table(spark, folder, "documents").select("doc_id", "source", F.col("doc_id").cast("string").alias("comment_id"))
    docs = docs.withColumn("at", F.timestamp_seconds(F.col("doc_id")))
    last = docs.agg(F.max("doc_id")).scalar()
    landing, out = work_path(spark, "arrivals"), work_path(spark, "capped")
    for part in range(4):
        docs.where(F.floor(F.col("doc_id") * 4 / (last + 1)) == part).write.mode("append").parquet(landing)
        stream = spark.readStream.schema(docs.schema).parquet(landing)
        caps.capped_stream(stream, out, f"{out}-state", "source", ["doc_id"], "at", limit=7, total=120).awaitTermination()
    return spark.read.parquet(out).select("doc_id", "source")
