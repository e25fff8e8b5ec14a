"""Sources and sinks: a given table is written by a sink and read back by a source."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fixed_values as V
from ..functions.arrays import few_at_a_time
from ..functions.text import normalize_space
from ..operators import models as M
from ..operators.columns import to_comment_columns
from ..operators.findings import generate
from ..operators.rows import only_new
from ..operators.topics import with_rule_topic
from ..plans.landing import body_run, post_run
from ..session import work_path
from ..sources import csv_ranges, files, payloads, sinks, tables, wordlists
from ..streaming import incremental
from . import base as B
from . import line_queries as LQ
from . import report_queries as RQ
from . import topic_queries as TQ
from .base import query, table


@query(f"SELECT source AS platform, doc_id::VARCHAR AS user_name, md5({B.space_sql('text')}) AS digest FROM documents")
def landed_csv(spark: SparkSession, folder: str) -> DataFrame:
    """Documents landed as CSV part files of one source and read as comments of it."""
    landing = work_path(spark, "landing")
    docs = table(spark, folder, "documents")
    rows = docs.select(F.lit("x").alias("platform"), F.col("doc_id").alias("nick"), F.col("text").alias("body"), F.col("source").alias("topic"))
    sinks.overwrite_csv(rows, f"{landing}/forum_raw.csv")
    landed = files.landed_comments(spark, landing)
    return landed.select(
        F.col("topic").alias("platform"), F.col("user").alias("user_name"), F.md5(normalize_space(F.col("content")).cast("binary")).alias("digest")
    )


GBK_TEXT = r"regexp_replace(text, '[^\x00-\x7F]', '和', 'g')"


def as_gbk_lines(rows: DataFrame, header: str) -> DataFrame:
    """One text column of CSV records as GBK bytes, each part with its header first."""

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield pa.RecordBatch.from_arrays([pa.array([header.encode("gbk")], pa.binary())], ["value"])
        for batch in (part for whole in batches for part in few_at_a_time(whole)):
            yield pa.RecordBatch.from_arrays([pa.array([x.encode("gbk") for x in batch.column(0).to_pylist()], pa.binary())], ["value"])

    return rows.mapInArrow(encoded, "value binary").select(F.col("value").cast("string").alias("value"))


@query(
    "SELECT 'weibo' AS platform, doc_id::VARCHAR AS user_name, "
    f"md5({B.space_sql(GBK_TEXT)}) AS digest FROM documents"
)
def landed_gbk(spark: SparkSession, folder: str) -> DataFrame:
    """Documents, letters beyond ASCII as one Chinese character, landed as GBK files and read as comments."""
    landing = work_path(spark, "landing")
    text = F.regexp_replace("text", "[^\\x00-\\x7F]", "和")
    cell = F.concat(F.lit('"'), F.replace(text, F.lit('"'), F.lit('""')), F.lit('"'))
    records = table(spark, folder, "documents").select(F.concat_ws(",", F.col("doc_id").cast("string"), cell).alias("record"))
    as_gbk_lines(records, "昵称,content").write.text(landing)
    parts = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(landing).select("path").collect()
    landed = csv_ranges.read_sources(spark, {"weibo": [r["path"] for r in parts]})["weibo"]
    digest = F.md5(normalize_space(F.col("content")).cast("binary"))
    return landed.select(F.lit("weibo").alias("platform"), F.col("昵称").alias("user_name"), digest.alias("digest"))


@query(
    "SELECT 'scored' AS name, doc_id, len(string_split(text, ' ')) AS words FROM documents "
    "UNION ALL SELECT 'cleaned', doc_id, 0 FROM documents UNION ALL SELECT 'none', NULL, NULL FROM region WHERE r_regionkey = 0"
)
def stored_tables(spark: SparkSession, folder: str) -> DataFrame:
    """Tables written by the sink; each is read by path, and the first of a list that exists is taken."""
    out = work_path(spark, "tables")
    docs = table(spark, folder, "documents").select("doc_id", F.split("text", " ").alias("tokens"))
    sinks.overwrite_table(docs.withColumn("tokens", F.array().cast("array<string>")), f"{out}/cleaned")
    cleaned = tables.first_table(spark, [f"{out}/scored", f"{out}/cleaned"])
    sinks.overwrite_table(docs, f"{out}/scored")
    scored = tables.first_table(spark, [f"{out}/scored", f"{out}/cleaned"])
    absent = tables.read_table(spark, f"{out}/topics")
    shown = lambda name, rows: rows.select(F.lit(name).alias("name"), "doc_id", F.size("tokens").cast("long").alias("words"))
    none = spark.range(1 if absent is None else 0).select(F.lit("none"), F.lit(None).cast("long"), F.lit(None).cast("long"))
    return shown("scored", scored).union(shown("cleaned", cleaned)).union(none)


@query(
    r"WITH w AS (SELECT unnest(string_split_regex(text, '[ \n]+')) AS w FROM benchmark) SELECT DISTINCT lower(trim(w)) AS word FROM w WHERE trim(w) <> '' "
    f"UNION SELECT unnest([{B.quoted(sorted({w.strip().lower() for w in B.STOPWORDS}))}])"
)
def stop_word_files(spark: SparkSession, folder: str) -> DataFrame:
    """Words of a table written as lines of text files, read and merged with the default stop words."""
    out = work_path(spark, "words")
    words = table(spark, folder, "benchmark").select(F.explode(F.split("text", "[ \n]+")).alias("w"))
    words.select(F.concat(F.lit(" "), "w", F.lit(" "))).write.text(out)
    return wordlists.stop_words(spark, out)


@query("SELECT doc_id FROM documents WHERE md5(text) NOT IN (SELECT md5(text) FROM documents JOIN labels USING (doc_id))")
def unseen_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Documents whose key is not among those of earlier output."""
    out = work_path(spark, "earlier")
    docs = table(spark, folder, "documents").select("doc_id", F.md5("text").alias("comment_id"))
    none = files.known_ids(tables.read_table(spark, out), spark)
    first = only_new(docs.join(table(spark, folder, "labels"), "doc_id", "left_semi"), none, "comment_id")
    sinks.overwrite_table(first.union(first.withColumn("comment_id", F.lit(""))), out)
    return only_new(docs, files.known_ids(tables.read_table(spark, out), spark), "comment_id").select("doc_id")


@query(f"SELECT source AS platform, md5(text) AS comment_id, md5({B.space_sql('text')}) AS digest, n_chars AS like_count, 10 AS columns FROM documents")
def record_files(spark: SparkSession, folder: str) -> DataFrame:
    """Comment records as quoted CSV of the fixed column list, read back."""
    out = work_path(spark, "records")
    rows = table(spark, folder, "documents").select(
        F.col("source").alias("platform"), F.md5("text").alias("comment_id"), F.col("text").alias("content"), F.col("n_chars").alias("like_count"), "lang"
    )
    sinks.write_records(rows, out)
    read = files.read_csv(spark, out)
    return to_comment_columns(read).select(
        "platform", "comment_id", F.md5(normalize_space(F.col("content")).cast("binary")).alias("digest"),
        F.col("like_count").cast("long").alias("like_count"), F.lit(len(read.columns)).alias("columns"),
    )


THREADS = (
    "SELECT 'T' || c.conv_id || ' & co' AS video_title, 'v' || c.conv_id AS video_id, "
    f"md5({B.space_sql('text')} || ' <b> & é') AS digest FROM conversations c"
)


@query(THREADS)
def thread_payloads(spark: SparkSession, folder: str) -> DataFrame:
    """Conversations as threads: landed as JSON with entities, exploded to comments, written and read as CSV."""
    landed, out = work_path(spark, "threads"), work_path(spark, "comments")
    text = F.concat(normalize_space(F.col("text")), F.lit(" &lt;b&gt; &amp; &eacute;"))
    comment = F.struct(F.struct(text.alias("textDisplay")).alias("snippet"))
    nested = F.struct(F.struct(comment.alias("topLevelComment")).alias("snippet"))
    # A thread is landed as many lines of at most 128 comments, whatever the turns are numbered.
    paged = table(spark, folder, "conversations").withColumn("_page", F.shiftright(F.monotonically_increasing_id(), 7))
    turns = paged.groupBy("conv_id", "_page").agg(F.collect_list(nested).alias("items"))
    threads = turns.select(
        F.concat(F.lit("T"), F.col("conv_id"), F.lit(" &amp; co")).alias("video_title"),
        F.concat(F.lit("v"), F.col("conv_id")).alias("video_id"),
        "items",
    )
    threads.write.json(landed)
    sinks.write_video_comments(payloads.thread_comments(spark, landed), out)
    return files.read_csv(spark, out).select("video_title", "video_id", F.md5(F.col("comment").cast("binary")).alias("digest"))


@query(f"SELECT no || '. ' || text AS line FROM (WITH {B.EVENTS}, {RQ.TOPIC_ROWS}, {RQ.FINDINGS})")
def findings_file(spark: SparkSession, folder: str) -> DataFrame:
    """The findings written as a text file; its numbered lines."""
    out = work_path(spark, "findings")
    topics = with_rule_topic(B.documents(spark, folder), B.TOPICS, B.NO_TOPIC, "content")
    sinks.write_findings(generate(B.scored_events(spark, folder), topics), out)
    return spark.read.text(out).where(F.col("value").rlike("^[0-9]+[.] ")).select(F.col("value").alias("line"))


@query("SELECT DISTINCT event_type || user_id AS comment_id FROM events")
def stream_recent(spark: SparkSession, folder: str) -> DataFrame:
    """Each key of the events once, by a stream with a watermark; the whole table is one batch."""
    schema = table(spark, folder, "events").schema
    events = spark.readStream.schema(schema).parquet(f"{folder}/events*.parquet")
    keyed = events.select(F.concat("event_type", F.col("user_id").cast("string")).alias("comment_id"), F.col("ts").alias("at"))
    out = work_path(spark, "recent")
    sink = incremental.recent_distinct(keyed, "at", "1 hour").writeStream.format("parquet")
    sink.option("checkpointLocation", f"{out}-state").trigger(availableNow=True).start(out).awaitTermination()
    return spark.read.parquet(out).select("comment_id")


@query(f"WITH {B.CORPUS} SELECT 6 AS clusters, count(*) AS texts, 6 AS named, true AS in_range FROM corpus")
def cluster_invariants(spark: SparkSession, folder: str) -> DataFrame:
    """Six clusters that cover the corpus, each text in one of them and each with its strongest terms."""
    clustered, model, names = M.cluster(M.counted_terms(TQ.term_source(spark, folder), keep=["row_id"]))
    sizes = M.cluster_sizes(clustered).agg(F.count("*").cast("int").alias("clusters"), F.sum("size").alias("texts"))
    terms = M.cluster_terms(clustered, model, names).agg(F.countDistinct("cluster").cast("int").alias("named"))
    placed = clustered.agg(F.min(F.col("cluster").between(0, 5)).alias("in_range"))
    return sizes.crossJoin(F.broadcast(terms)).crossJoin(F.broadcast(placed))


@query(
    f"WITH {B.CORPUS} SELECT unnest(range(6))::INT AS cluster, true AS nearest, true AS rests, true AS strongest, true AS cheapest, "
    "(SELECT count(*) FROM corpus) AS texts"
)
def cluster_fixed_point(spark: SparkSession, folder: str) -> DataFrame:
    """The clusters of the corpus as a fixed point: nearest centroids, resting means, strongest terms, no start cheaper."""
    vectors, names = M.tfidf_vectors(M.counted_terms(TQ.term_source(spark, folder), keep=["row_id"]))
    models = M.started(vectors, M.CLUSTERS, M.STARTS, M.SEED, 300)
    costs = [model.summary.trainingCost for model in models]
    best = models[costs.index(min(costs))]
    placed = best.transform(vectors).drop("features")
    named = M.cluster_terms(vectors, best, names)
    weights = M.tfidf_rows(placed, "row_id", keep=["cluster"])
    found = M.cluster_certificate(weights, placed.select("row_id", "cluster"), M.center_rows(spark, best, names), named, "row_id")
    total = found.agg(F.sum("cost").alias("_cost"), F.sum("size").alias("texts"))
    cheapest = F.col("_cost") <= min(costs) * (1 + 1e-6)
    rows = found.select("cluster", "nearest", "rests", "strongest").crossJoin(F.broadcast(total))
    return rows.select("cluster", "nearest", "rests", "strongest", cheapest.alias("cheapest"), "texts")


@query("SELECT doc_id, true AS labelled FROM documents")
def svm_invariants(spark: SparkSession, folder: str) -> DataFrame:
    """One of the trained labels for every document."""
    out = TQ.supervised_topics_svm(spark, folder)
    return out.select("doc_id", F.col("topic_label").isin(0, 1).alias("labelled"))


@query("SELECT quality AS label, count(*) AS texts, true AS learned FROM labels JOIN documents USING (doc_id) GROUP BY quality")
def svm_learned(spark: SparkSession, folder: str) -> DataFrame:
    """For each label whether nine of ten of its texts get it; no constant label does that for both."""
    texts = TQ.labelled(spark, folder)
    model = M.train_topics(texts, "text", "quality", kind="svm")
    out = M.predicted_topics(model, texts.select("doc_id", "text", "quality"), "text", "doc_id")
    right = F.avg((F.col("topic_label") == F.col("quality")).cast("int"))
    return out.groupBy(F.col("quality").alias("label")).agg(F.count("*").alias("texts"), (right >= 0.9).alias("learned"))


#: Three neighbouring documents share an address, so there is one for every three rows of any table.
ADDRESS_SQL = "left(md5(CAST(doc_id // 3 AS VARCHAR)), 12)"
POSTS = (
    f"WITH {LQ.SCORES}, c AS (SELECT right(source, -3)::INT AS keyword_order, source AS keyword, text, (doc_id % 3 + 1)::INT AS page, doc_id AS pos, "
    f"'https://weibo.com/u' || (n_chars % 97) || '/R' || {ADDRESS_SQL} || '?a=1' AS url, 'https://m.weibo.cn/detail/R' || {ADDRESS_SQL} AS post_url, score "
    f"FROM scores WHERE {LQ.RELEVANT} AND text <> ''), "
    "f AS (SELECT *, min(page) OVER (PARTITION BY keyword_order, url) AS first_page FROM c), "
    "k AS (SELECT *, row_number() OVER (PARTITION BY keyword_order ORDER BY page, score DESC, pos) AS i FROM f WHERE page = first_page), "
    "u AS (SELECT *, row_number() OVER (PARTITION BY url ORDER BY keyword_order, page, score DESC, pos) AS j FROM k WHERE i <= 10), "
    "v AS (SELECT *, row_number() OVER (PARTITION BY post_url ORDER BY keyword_order, page, score DESC, pos, url) AS o FROM u WHERE j = 1), "
    f"posts AS (SELECT post_url, keyword_order, keyword, page, score, pos, {B.space_sql('text')} AS post FROM v WHERE o = 1), "
    f"bodies AS (SELECT doc_id, 'https://m.weibo.cn/detail/R' || {ADDRESS_SQL} AS post_url, text FROM documents), "
    f"rawl AS (SELECT doc_id, unnest(p) AS raw, generate_subscripts(p, 1) AS i FROM (SELECT doc_id, string_split_regex(text, {LQ.SPLIT}) AS p FROM bodies SEMI JOIN posts USING (post_url))), "
    f"cl AS (SELECT doc_id, i, {B.space_sql('raw')} AS line FROM rawl), "
    "lines AS (SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY i) - 1 AS line_no, line FROM cl WHERE line <> ''), "
    f"{LQ.candidate_sql('lines', 'doc_id', False)}, "
    "numbered AS (SELECT b.post_url, f.* EXCLUDE (line_no, doc_id), row_number() OVER (PARTITION BY b.post_url ORDER BY f.doc_id, f.line_no, f.form) AS line_no FROM found f JOIN bodies b USING (doc_id)), "
    f"own AS (SELECT f.*, p.keyword_order, p.keyword, p.page, p.score, p.pos FROM numbered f JOIN posts p USING (post_url) WHERE NOT {LQ.similar_sql('content', 'post')}), "
    f"{LQ.kept_sql('post_url', 200, 'keyword_order, page, score DESC, pos')} "
    "SELECT keyword, 'weibo_comment_' || md5(post_url || content) AS comment_id, user_name, content, source_url FROM "
    "(SELECT *, post_url AS source_url FROM final ORDER BY keyword_order, page, score DESC, pos, line_no, form LIMIT 1500)"
)


@query(POSTS)
def post_and_body_run(spark: SparkSession, folder: str) -> DataFrame:
    """Posts chosen from all documents, and the comments on the bodies of their pages, several for each address."""
    digest = F.substring(F.md5(F.floor(F.col("doc_id") / 3).cast("string").cast("binary")), 1, 12)
    posts = B.stored(post_run(LQ.post_candidates(spark, folder, digest), score=LQ.score, relevant=LQ.relevant), "posts")
    address = F.concat(F.lit("https://m.weibo.cn/detail/R"), digest)
    pages = table(spark, folder, "documents").select(address.alias("post_url"), "doc_id", F.col("text").alias("body"))
    rows = body_run(pages, posts, "t", LQ.RULES, visit="doc_id")
    return rows.select("keyword", "comment_id", "user_name", "content", "source_url")
