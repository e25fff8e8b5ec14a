"""Page lines and post selection over conversations, documents and pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import ids
from ..functions import lines as L
from ..functions.text import normalize_space
from ..operators import lines as O
from ..operators import selection as X
from ..operators.columns import computed_once
from ..operators.rows import cap_per_group, cap_total, first_rows, only_new, prefer_source
from ..plans.landing import body_run, line_run, post_run
from . import base as B
from .base import query, table

# Rules for the languages of the test tables.
RULES = L.LineRules(
    ui_lines=("Of.", "And.", "Re."),
    ui_phrases=("best", "que la", "thth"),
    time_patterns=(" und ", " that .* of ", " que "),
    from_word="from",
    name_prefixes=("The", "Die", "Les"),
    name_marks=("!", ",", ";"),
    count_pattern=r"^(?:\p{Nd}+|\p{Nd}+(?:\.\p{Nd}+)?万)$",
    script=r"\p{L}",
)

SPLIT = r"'[\n\v\f\r\x1c-\x1e\x{85}\x{2028}\x{2029}]'"
LINES = (
    f"raw AS (SELECT doc_id, unnest(p) AS raw, generate_subscripts(p, 1) AS i FROM (SELECT doc_id, string_split_regex(text, {SPLIT}) AS p FROM documents)), "
    f"cleaned_lines AS (SELECT doc_id, i, {B.space_sql('raw')} AS line FROM raw), "
    "lines AS (SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY i) - 1 AS line_no, line FROM cleaned_lines WHERE line <> '')"
)


@query(f"WITH {LINES} SELECT doc_id, line_no, line FROM lines")
def page_lines(spark: SparkSession, folder: str) -> DataFrame:
    rows = O.page_lines(table(spark, folder, "documents"), "doc_id", "text")
    return rows.withColumn("line_no", F.col("line_no").cast("long"))


TURNS = f"turns AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS line_no, {B.space_sql('text')} AS line FROM conversations)"


def turns(spark: SparkSession, folder: str) -> DataFrame:
    return O.renumber_lines(table(spark, folder, "conversations"), "conv_id", "turn", "text")


@query(f"WITH {TURNS} SELECT * FROM turns")
def renumber_lines(spark: SparkSession, folder: str) -> DataFrame:
    return turns(spark, folder)


@query(
    rf"WITH {LINES} SELECT doc_id, line_no, first_value(CASE WHEN regexp_matches(line, ' und | que |^Is ') THEN line END IGNORE NULLS) "
    "OVER (PARTITION BY doc_id ORDER BY line_no ROWS BETWEEN 1 FOLLOWING AND 5 FOLLOWING) AS next_match FROM lines"
)
def next_match_within_5(spark: SparkSession, folder: str) -> DataFrame:
    rows = O.page_lines(table(spark, folder, "documents"), "doc_id", "text")
    out = O.next_match(rows, "doc_id", "line_no", "line", F.col("line").rlike(r" und | que |^Is "))
    return out.select("doc_id", F.col("line_no").cast("long").alias("line_no"), "next_match")


@query(
    f"WITH {TURNS}, v AS (SELECT *, CASE WHEN length(line) % 3 = 0 THEN length(line) END AS v FROM turns) "
    "SELECT conv_id, line_no, coalesce(first_value(v IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY line_no "
    "ROWS BETWEEN 1 FOLLOWING AND 9 FOLLOWING), 0) AS next_value FROM v"
)
def next_number_within_9(spark: SparkSession, folder: str) -> DataFrame:
    rows = turns(spark, folder)
    value = F.when(F.length("line") % 3 == 0, F.length("line").cast("long"))
    return O.next_value(rows, "conv_id", "line_no", value).select("conv_id", "line_no", "next_value")


@query(f"WITH {TURNS} SELECT conv_id, line_no, lead(line) OVER (PARTITION BY conv_id ORDER BY line_no) AS next_line FROM turns")
def lead_pair(spark: SparkSession, folder: str) -> DataFrame:
    ahead = O.with_lookahead(turns(spark, folder), "conv_id", "line_no", {"next_line": (F.col("line"), 1, 1)})
    return ahead.select("conv_id", "line_no", "next_line")


# The line predicates as SQL, under the rules above.
def noise_sql(x: str) -> str:
    return (
        f"({x} = '' OR {x} IN ('Of.', 'And.', 'Re.') OR contains({x}, 'best') OR contains({x}, 'que la') OR contains({x}, 'thth') "
        rf"OR {time_sql(x)} OR regexp_full_match({x}, 'from[\x{{4e00}}-\x{{9fff}}]{{2,8}}') OR regexp_full_match({x}, '\p{{Nd}}+'))"
    )


def time_sql(x: str) -> str:
    return (
        rf"(contains({x}, ' und ') OR regexp_matches({x}, ' that .* of ') OR contains({x}, ' que ') "
        rf"OR (contains({x}, 'from') AND regexp_matches({x}, '\p{{Nd}}{{1,2}}[:：]\p{{Nd}}{{2}}')))"
    )


def name_sql(x: str) -> str:
    return (
        f"(length({x}) BETWEEN 1 AND 30 AND NOT {noise_sql(x)} "
        rf"AND NOT regexp_matches({x}, '\p{{Nd}}{{1,2}}[-/]\p{{Nd}}{{1,2}}') AND NOT regexp_matches({x}, '\p{{Nd}}{{1,2}}[:：]\p{{Nd}}{{2}}') "
        f"AND NOT starts_with({x}, 'The') AND NOT starts_with({x}, 'Die') AND NOT starts_with({x}, 'Les') "
        f"AND NOT contains({x}, '!') AND NOT contains({x}, ',') AND NOT contains({x}, ';'))"
    )


def text_sql(x: str) -> str:
    return (
        rf"(length({x}) BETWEEN 3 AND 220 AND regexp_matches({x}, '\p{{L}}') AND NOT {noise_sql(x)} "
        rf"AND length({B.replaced(x, '[^\\p{{L}}\\p{{N}}]+'.replace('{{', '{').replace('}}', '}'))}) >= 3)"
    )


@query(
    f"WITH {LINES} SELECT doc_id, line_no, {time_sql('line')} AS is_time, {noise_sql('line')} AS is_noise, "
    f"{name_sql('line')} AS is_name, {text_sql('line')} AS is_text FROM lines"
)
def line_predicates(spark: SparkSession, folder: str) -> DataFrame:
    line = F.col("line")
    rows = O.page_lines(table(spark, folder, "documents"), "doc_id", "text")
    return rows.select(
        "doc_id",
        F.col("line_no").cast("long").alias("line_no"),
        L.names_time(line, RULES).alias("is_time"),
        L.is_noise_line(line, RULES).alias("is_noise"),
        L.looks_like_name(line, RULES).alias("is_name"),
        L.is_comment_text(line, RULES).alias("is_text"),
    )


ROLE_LINES = f"said AS (SELECT conv_id, turn, role, {B.space_sql('text')} AS line FROM conversations)"


@query(
    f"WITH {ROLE_LINES} SELECT conv_id, turn, CASE WHEN {text_sql('line')} THEN role END AS \"user\", CASE WHEN {text_sql('line')} THEN line END AS content FROM said"
)
def colon_split(spark: SparkSession, folder: str) -> DataFrame:
    said = F.concat_ws(": ", F.col("role"), F.col("text"))
    pair = L.split_at_colon(normalize_space(said), RULES)
    return table(spark, folder, "conversations").select(
        "conv_id", "turn", pair["user"].alias("user"), pair["content"].alias("content")
    )


def candidate_sql(lines: str, page: str, form_one: bool) -> str:
    """Candidates of a line table by self-joins on the line number."""
    ahead = (
        f"CREATED AS (SELECT a.*, (SELECT min(b.line_no) FROM {lines} b WHERE b.{page} = a.{page} AND b.line_no BETWEEN a.line_no + 1 AND a.line_no + 5 AND {time_sql('b.line')}) AS t1, "
        f"(SELECT min(b.line_no) FROM {lines} b WHERE b.{page} = a.{page} AND b.line_no BETWEEN a.line_no + 2 AND a.line_no + 6 AND {time_sql('b.line')}) AS t2 FROM {lines} a), "
    ).replace("CREATED", "ahead")
    one = (
        f"SELECT a.{page}, a.line_no, 1 AS form, split_part(a.line, ': ', 1) AS user_name, a.said AS content, t1 AS at_line FROM ahead a "
        f"WHERE a.said IS NOT NULL AND {text_sql('a.said')} AND {name_sql(chr(115) + 'plit_part(a.line, ' + chr(39) + ': ' + chr(39) + ', 1)')} UNION ALL "
        if form_one
        else ""
    )
    two = (
        f"SELECT a.{page}, a.line_no, 2, a.line, b.line, t2 FROM ahead a JOIN {lines} b ON b.{page} = a.{page} AND b.line_no = a.line_no + 1 "
        f"WHERE {name_sql('a.line')} AND {text_sql('b.line')}"
    )
    if not form_one:
        two = two.replace("a.line_no, 2, a.line, b.line, t2", "a.line_no, 2 AS form, a.line AS user_name, b.line AS content, t2 AS at_line")
    return (
        f"{ahead}cand AS ({one}{two}), "
        f"found AS (SELECT c.*, coalesce(l.line, '') AS publish_time FROM cand c LEFT JOIN {lines} l ON l.{page} = c.{page} AND l.line_no = c.at_line)"
    )


def kept_sql(page: str, limit: int, order: str) -> str:
    """First appearance per page, cap per page, first appearance overall."""
    return (
        f"once AS (SELECT *, row_number() OVER (PARTITION BY {page}, content ORDER BY line_no, form) AS r1 FROM own), "
        f"capped AS (SELECT *, row_number() OVER (PARTITION BY {page} ORDER BY line_no, form) AS r2 FROM once WHERE r1 = 1), "
        f"global_once AS (SELECT *, row_number() OVER (PARTITION BY content ORDER BY {order}, line_no, form) AS r3 FROM capped WHERE r2 <= {limit}), "
        "final AS (SELECT * FROM global_once WHERE r3 = 1)"
    )


def similar_sql(x: str, post: str) -> str:
    return (
        f"({x} <> '' AND {post} <> '' AND (contains({post}, {x}) OR contains({x}, {post}) "
        f"OR (length({x}) >= 20 AND contains({post}, left({x}, 20))) OR (length({post}) >= 20 AND contains({x}, left({post}, 20)))))"
    )


BODY_FOUND = f"WITH {LINES}, {candidate_sql('lines', 'doc_id', False)}"


@query(f"{BODY_FOUND} SELECT doc_id, line_no, form, user_name, content, publish_time, 0::BIGINT AS like_count FROM found")
def body_candidates(spark: SparkSession, folder: str) -> DataFrame:
    """Candidates of whole document bodies, read inside their rows."""
    pages = table(spark, folder, "documents")
    return O.candidates_from_bodies(pages, "doc_id", "text", RULES)


@query(f"{BODY_FOUND} SELECT doc_id, line_no, form, user_name, content, publish_time, 0::BIGINT AS like_count FROM found")
def line_candidates(spark: SparkSession, folder: str) -> DataFrame:
    """The same candidates from a line table with chunked windows."""
    rows = O.page_lines(table(spark, folder, "documents"), "doc_id", "text")
    out = O.candidates_from_lines(rows, "doc_id", RULES)
    return out.withColumn("line_no", F.col("line_no").cast("long"))


CONV_LINES = (
    f"lines AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS line_no, "
    f"role || ': ' || {B.space_sql('text')} AS line, {B.space_sql('text')} AS said FROM conversations)"
)


@query(
    f"WITH {CONV_LINES}, {candidate_sql('lines', 'conv_id', True)}, "
    f"posts AS (SELECT conv_id, {B.space_sql('text')} AS post FROM conversations WHERE turn = 0), "
    f"own AS (SELECT f.* FROM found f JOIN posts USING (conv_id) WHERE NOT {similar_sql('content', 'post')}), "
    f"{kept_sql('conv_id', 3, 'conv_id')} "
    "SELECT 'forum' AS platform, 'k' AS keyword, 'weibo_comment_' || md5(conv_id::VARCHAR || content) AS comment_id, user_name, content, publish_time, "
    "0::BIGINT AS like_count, 'mixed' AS language, conv_id::VARCHAR AS source_url, '2025-05-01 00:00:00' AS crawl_time "
    "FROM final ORDER BY conv_id, line_no, form LIMIT 1500"
)
def line_comments(spark: SparkSession, folder: str) -> DataFrame:
    """Comments of conversations as pages; the first turn is the post."""
    conversations = table(spark, folder, "conversations").withColumn("url", F.col("conv_id").cast("string"))
    said = conversations.withColumn("said", F.concat_ws(": ", F.col("role"), F.col("text")))
    rows = O.renumber_lines(said, "url", "turn", "said").withColumnRenamed("url", "post_url")
    posts = conversations.where("turn = 0").select(
        F.col("url").alias("post_url"),
        F.col("conv_id").alias("post_order"),
        F.lit("k").alias("keyword"),
        F.col("text").alias("post_content"),
    )
    found = O.candidates_from_lines(rows, "post_url", RULES)
    return line_run(found, posts, "2025-05-01 00:00:00", language="mixed", platform="forum", limit=3)


@query(
    f"WITH t AS (SELECT conv_id, turn, {B.space_sql('text')} AS content FROM conversations), p AS (SELECT conv_id, content AS post FROM t WHERE turn = 0) "
    f"SELECT conv_id, turn, {similar_sql('content', 'post')} AS similar FROM t JOIN p USING (conv_id)"
)
def similar_to_post(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "conversations").select(
        "conv_id", "turn", normalize_space(F.col("text")).alias("content")
    )
    posts = rows.where("turn = 0").select("conv_id", F.col("content").alias("post"))
    return rows.join(posts, "conv_id").select(
        "conv_id", "turn", L.repeats_post(F.col("content"), F.col("post")).alias("similar")
    )


COUNTRIES = ("the ", "que ", "und ", "los ")
CONFLICTS = ("best", "thth", "worthless", "reti", "best")
PAIRS = (("stupid", "worthless"), ("idiot", "best"))


def score(text: Column) -> Column:
    return L.relevance(text, COUNTRIES, CONFLICTS)


def relevant(text: Column) -> Column:
    return L.is_relevant(text, COUNTRIES, CONFLICTS, PAIRS)


def terms_sql(x: str) -> str:
    two = " + ".join(f"contains({x}, '{w}')::INT" for w in COUNTRIES)
    one = " + ".join(f"contains({x}, '{w}')::INT" for w in CONFLICTS)
    return f"(2 * ({two}) + {one})"


SCORES = f"s AS (SELECT *, {B.space_sql('text')} AS body FROM documents), scores AS (SELECT *, {terms_sql('body')} AS score FROM s)"


@query(f"WITH {SCORES} SELECT doc_id, score FROM scores")
def relevance_score(spark: SparkSession, folder: str) -> DataFrame:
    shown = normalize_space(F.col("text")).alias("shown")
    rows = table(spark, folder, "documents").select("doc_id", shown)
    return rows.select("doc_id", score(F.col("shown")).alias("score"))


RELEVANT = (
    "(body <> '' AND (score >= 3 OR (contains(body, 'stupid') AND contains(body, 'worthless')) OR (contains(body, 'idiot') AND contains(body, 'best'))))"
)


@query(f"WITH {SCORES} SELECT doc_id FROM scores WHERE {RELEVANT}")
def relevance_filter(spark: SparkSession, folder: str) -> DataFrame:
    rows = computed_once(table(spark, folder, "documents"), "shown", normalize_space(F.col("text")))
    return rows.where(relevant(F.col("shown"))).select("doc_id")


def post_candidates(spark: SparkSession, folder: str, address: Column | None = None) -> DataFrame:
    """Documents as posts: source as keyword, three result pages, repeated addresses."""
    docs = table(spark, folder, "documents")
    address = (F.col("doc_id") % 41).cast("string") if address is None else address
    return docs.select(
        F.substring("source", 4, 9).cast("int").alias("keyword_order"),
        F.col("source").alias("keyword"),
        (F.col("doc_id") % 3 + 1).cast("int").alias("page"),
        F.col("doc_id").alias("pos"),
        F.concat(F.lit("//weibo.com/u"), (F.col("n_chars") % 97).cast("string"), F.lit("/R"), address, F.lit("?a=1")).alias("post_url"),
        F.col("text").alias("post_content"),
    )


@query(
    f"WITH {SCORES}, c AS (SELECT right(source, -3)::INT AS keyword_order, source AS keyword, (doc_id % 3 + 1)::INT AS page, doc_id AS pos, "
    "'https://weibo.com/u' || (n_chars % 97) || '/R' || (doc_id % 41) || '?a=1' AS post_url, 'https://m.weibo.cn/detail/R' || (doc_id % 41) AS mobile_url, score "
    f"FROM scores WHERE {RELEVANT} AND text <> ''), "
    "f AS (SELECT *, min(page) OVER (PARTITION BY keyword_order, post_url) AS first_page FROM c), "
    "k AS (SELECT *, row_number() OVER (PARTITION BY keyword_order ORDER BY page, score DESC, pos) AS i FROM f WHERE page = first_page), "
    "u AS (SELECT *, row_number() OVER (PARTITION BY post_url ORDER BY keyword_order, page, score DESC, pos) AS j FROM k WHERE i <= 10) "
    "SELECT keyword, page, pos, post_url, mobile_url, score FROM u WHERE j = 1"
)
def relevance_top_n(spark: SparkSession, folder: str) -> DataFrame:
    posts = X.chosen_posts(X.scored_posts(post_candidates(spark, folder), score, relevant))
    return posts.select("keyword", "page", "pos", "post_url", "mobile_url", "score")


@query(
    "SELECT event_id, user_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS i FROM events) WHERE i <= 20"
)
def cap_rows_per_group(spark: SparkSession, folder: str) -> DataFrame:
    rows = cap_per_group(table(spark, folder, "events"), ["user_id"], ["ts", "event_id"], 20)
    return rows.select("event_id", "user_id")


@query("SELECT event_id, event_type FROM events ORDER BY value DESC, event_id LIMIT 1500")
def global_cap(spark: SparkSession, folder: str) -> DataFrame:
    rows = cap_total(table(spark, folder, "events"), [F.desc("value"), "event_id"], 1500)
    return rows.select("event_id", "event_type")


@query(
    "SELECT event_id, user_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS i FROM events) WHERE i = 1"
)
def first_in_group(spark: SparkSession, folder: str) -> DataFrame:
    rows = first_rows(table(spark, folder, "events"), ["user_id", "event_type"], ["ts", "event_id"])
    return rows.select("event_id", "user_id", "event_type")


@query(
    "SELECT doc_id, md5(text) AS comment_id FROM documents WHERE md5(text) NOT IN (SELECT md5(text) FROM documents JOIN labels USING (doc_id) "
    "UNION ALL SELECT md5(text) FROM benchmark)"
)
def incremental_new_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Documents whose text is neither among the labelled ones nor in a second table."""
    digest = F.md5("text").alias("comment_id")
    documents = table(spark, folder, "documents")
    labelled = documents.join(table(spark, folder, "labels").select("doc_id"), "doc_id", "left_semi")
    known = labelled.select(digest).union(table(spark, folder, "benchmark").select(digest)).distinct()
    return only_new(documents.select("doc_id", digest), known, "comment_id").select("doc_id", "comment_id")


@query(
    "WITH r AS (SELECT *, CASE event_type WHEN 'error' THEN 1 WHEN 'click' THEN 2 ELSE 3 END AS rank, (user_id % 1000 * 40 + date_part('day', ts)) AS item FROM events) "
    "SELECT event_id, rank FROM (SELECT *, min(rank) OVER (PARTITION BY item) AS best FROM r) WHERE rank = best"
)
def source_fallback(spark: SparkSession, folder: str) -> DataFrame:
    """Per user and day the events of the best-ranked type that has any."""
    rank = F.when(F.col("event_type") == "error", 1).when(F.col("event_type") == "click", 2).otherwise(3)
    item = F.col("user_id") % 1000 * 40 + F.dayofmonth("ts")
    rows = table(spark, folder, "events").withColumn("rank", rank).withColumn("item", item)
    return prefer_source(rows, ["item"], "rank").select("event_id", "rank")


@query(
    "WITH h AS (SELECT page_id, unnest(list_distinct(regexp_extract_all(html, 'href=\"([^\"]*)\"', 1))) AS href FROM pages), "
    "v AS (SELECT (page_id % 5)::INT AS keyword_order, page_id, 'https://www.bilibili.com/video/BV' || regexp_extract(href, '^/([0-9A-Za-z]+)', 1) AS video_url FROM h "
    "WHERE regexp_matches(href, '^/[0-9A-Za-z]+')), "
    "o AS (SELECT keyword_order, video_url, min(page_id) AS page FROM v GROUP BY ALL), "
    "c AS (SELECT *, row_number() OVER (PARTITION BY keyword_order ORDER BY page, video_url) AS i FROM o) "
    "SELECT keyword_order, page, video_url FROM c WHERE i <= 8"
)
def video_links(spark: SparkSession, folder: str) -> DataFrame:
    """Video addresses from the links of all pages, eight per keyword."""
    href = F.explode(F.array_distinct(F.regexp_extract_all("html", F.lit('href="([^"]*)"'), F.lit(1))))
    links = table(spark, folder, "pages").select(
        (F.col("page_id") % 5).cast("int").alias("keyword_order"), F.col("page_id").alias("page"), href.alias("h")
    )
    named = links.where(F.col("h").rlike("^/[0-9A-Za-z]+")).withColumn(
        "href", F.concat(F.lit("//x.tv/BV"), F.regexp_extract("h", "^/(.*)$", 1))
    )
    placed = named.withColumn("pos", ids.video_url(F.col("href")))
    return X.chosen_videos(placed.drop("h")).select("keyword_order", "page", "video_url")


@query(
    "SELECT DISTINCT source AS keyword, page::INT AS page, 'https://s.weibo.com/weibo?q=' || replace(url_encode(source || ' à/b'), '%2F', '/') || '&page=' || page AS url "
    "FROM documents, range(1, 4) r(page)"
)
def search_targets(spark: SparkSession, folder: str) -> DataFrame:
    """Search addresses for the sources of the documents as keywords."""
    words = table(spark, folder, "documents").select(F.concat("source", F.lit(" à/b")).alias("keyword")).distinct()
    rows = X.paged_targets(words, 3)
    return rows.select(F.regexp_replace("keyword", " à/b$", "").alias("keyword"), "page", "url")


@query(
    "SELECT DISTINCT source AS keyword, page::INT AS page, 'https://search.bilibili.com/video?keyword=' || url_encode(source) || '&page=' || page AS url "
    "FROM documents, range(1, 3) r(page)"
)
def video_search_targets(spark: SparkSession, folder: str) -> DataFrame:
    """Video search addresses for the sources of the documents."""
    words = table(spark, folder, "documents").select(F.col("source").alias("keyword")).distinct()
    return X.paged_targets(words, 2, ids.video_search_url)
