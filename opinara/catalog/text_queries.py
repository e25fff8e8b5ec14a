"""Text functions and the cleaned corpus over whole documents."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import ids, segment, text
from ..operators import aggregates as A
from ..operators import lexicon
from ..operators.columns import handle_missing, split_rows, standardize
from ..operators.membership import mapped_name
from ..operators.rows import first_rows
from ..plans.clean import STOPWORDS, with_clean_text
from . import base as B
from .base import query, table

CONTENT = "content"


@query(f"SELECT doc_id AS row_id, {B.clean_sql('text')} AS cleaned_text FROM documents")
def clean_text(spark: SparkSession, folder: str) -> DataFrame:
    return B.documents(spark, folder).select("row_id", text.clean_comment(F.col(CONTENT)).alias("cleaned_text"))


@query(f"SELECT doc_id AS row_id, {B.space_sql('text')} AS line FROM documents")
def normalize_ws(spark: SparkSession, folder: str) -> DataFrame:
    return B.documents(spark, folder).select("row_id", text.normalize_space(F.col(CONTENT)).alias("line"))


@query(f"WITH {B.CLEANED} SELECT row_id, language FROM tagged")
def detect_language(spark: SparkSession, folder: str) -> DataFrame:
    return B.cleaned(spark, folder).select("row_id", "language")


@query(
    r"""SELECT doc_id AS row_id, CASE WHEN regexp_matches(text, '[\x{4e00}-\x{9fff}]') THEN 'zh'
    WHEN regexp_full_match(text, '[a-zA-Z\s\v\x1c-\x1f\x{85}\p{Z}\p{Nd}.,!?;:''"()\-_/]+') THEN 'en' ELSE 'other' END AS language
    FROM documents"""
)
def detect_language_simple(spark: SparkSession, folder: str) -> DataFrame:
    return B.documents(spark, folder).select("row_id", text.detect_language_simple(F.col(CONTENT)).alias("language"))


@query(
    f"WITH {B.CLEANED}, t AS (SELECT row_id, {B.tokens_sql('cleaned_text', STOPWORDS)} AS tokens FROM tagged) "
    "SELECT row_id, array_to_string(tokens, ' ') AS tokens, len(tokens)::BIGINT AS n FROM t"
)
def tokenize_en(spark: SparkSession, folder: str) -> DataFrame:
    rows = B.cleaned(spark, folder).withColumn("_t", text.english_tokens(F.col("cleaned_text"), STOPWORDS))
    return rows.select("row_id", F.array_join("_t", " ").alias("tokens"), F.size("_t").cast("long").alias("n"))


SEGMENT_WORDS = {
    "ción": "n", "é": "a", "éau": "n", "über": "v", "ñ": "d", "best": "a", "worthless": "a",
    "the": "u", "ü": "v", "ä": "r", "que les": "n", "und der": "ad",
}


@query(
    f"WITH {B.CLEANED}, piece AS (SELECT row_id, unnest(p) AS word, generate_subscripts(p, 1) AS i FROM "
    "(SELECT row_id, regexp_extract_all(cleaned_text, 'que les|und der|ción|über|éau|é|ñ|ä|ü|[A-Za-z0-9]+|(?s:.)') AS p FROM tagged)), "
    f"lex(word, tag) AS (VALUES {', '.join(chr(40) + B.quoted((w, t)) + chr(41) for w, t in SEGMENT_WORDS.items())}) "
    "SELECT row_id, string_agg(word, '|' ORDER BY i) AS words, count(*) AS n FROM piece JOIN lex USING (word) "
    "WHERE left(tag, 1) IN ('n', 'v', 'a', 'd') AND length(word) > 1 AND word <> 'best' GROUP BY row_id"
)
def segment_dictionary(spark: SparkSession, folder: str) -> DataFrame:
    words = segment.dictionary_tokens(F.col("cleaned_text"), SEGMENT_WORDS, ("best",))
    rows = B.cleaned(spark, folder).select("row_id", words.alias("_w")).where(F.size("_w") > 0)
    return rows.select("row_id", F.array_join("_w", "|").alias("words"), F.size("_w").cast("long").alias("n"))


@query(B.SQL["segment_dictionary"])
def segment_dictionary_arrow(spark: SparkSession, folder: str) -> DataFrame:
    """The same tokens on the path for large lexicons."""
    words = segment.dictionary_tokens(F.col("cleaned_text"), SEGMENT_WORDS, ("best",), in_jvm=False)
    rows = B.cleaned(spark, folder).select("row_id", words.alias("_w")).where(F.size("_w") > 0)
    return rows.select("row_id", F.array_join("_w", "|").alias("words"), F.size("_w").cast("long").alias("n"))


@query(B.SQL["segment_dictionary"])
def segment_dictionary_table(spark: SparkSession, folder: str) -> DataFrame:
    """The same tokens with the lexicon in a table."""
    listed = spark.createDataFrame(list(SEGMENT_WORDS.items()), "word string, tag string")
    rows = lexicon.dictionary_tokens(B.cleaned(spark, folder), "row_id", "cleaned_text", listed, ("best",), out="_w")
    return rows.where(F.size("_w") > 0).select("row_id", F.array_join("_w", "|").alias("words"), F.size("_w").cast("long").alias("n"))


@query(
    f"WITH {B.CLEANED}, piece AS (SELECT row_id, unnest(regexp_extract_all(cleaned_text, "
    "'que les|und der|ción|über|éau|é|ñ|ä|ü|[A-Za-z0-9]+|(?s:.)')) AS word FROM tagged), "
    f"lex(word, tag) AS (VALUES {', '.join(chr(40) + B.quoted((w, t)) + chr(41) for w, t in SEGMENT_WORDS.items())}) "
    "SELECT coalesce(tag, CASE WHEN regexp_full_match(word, '[0-9]+') THEN 'm' WHEN regexp_full_match(word, '[A-Za-z0-9]+') "
    "THEN 'eng' ELSE 'x' END) AS tag, count(*) AS n FROM piece LEFT JOIN lex USING (word) GROUP BY 1"
)
def segment_tags(spark: SparkSession, folder: str) -> DataFrame:
    """Pieces per tag over the whole texts, unlisted pieces included."""
    pairs = segment.segment(F.col("cleaned_text"), SEGMENT_WORDS)
    tags = B.cleaned(spark, folder).select(F.explode(F.transform(pairs, lambda p: p["tag"])).alias("tag"))
    return tags.groupBy("tag").agg(F.count(F.lit(1)).alias("n"))


@query(
    f"WITH {B.CORPUS} SELECT row_id, array_to_string(regexp_extract_all(lower(array_to_string(tokens, ' ')), "
    r"'[\p{L}\p{N}_]+'), ' ') AS terms FROM corpus"
)
def vector_terms(spark: SparkSession, folder: str) -> DataFrame:
    terms = text.vector_terms(F.col("tokens"))
    return B.corpus(spark, folder).select("row_id", F.array_join(terms, " ").alias("terms"))


@query(
    f"SELECT doc_id AS row_id, len(list_distinct({B.lexicon_words_sql('text')}))::BIGINT AS n_words FROM documents"
)
def distinct_words(spark: SparkSession, folder: str) -> DataFrame:
    n = F.size(text.distinct_words(F.col(CONTENT))).cast("long")
    return B.documents(spark, folder).select("row_id", n.alias("n_words"))


@query(
    f"WITH {B.CORPUS} SELECT row_id, array_to_string(tokens, ' ') AS tokens, len(tokens)::BIGINT AS n FROM corpus"
)
def stored_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """Token lists written as list literals in text and read back."""
    literal = F.concat(F.lit("["), F.array_join(F.transform("tokens", lambda w: F.concat(F.lit('"'), w, F.lit('"'))), ", "), F.lit("]"))
    rows = B.corpus(spark, folder).select("row_id", literal.alias("stored"))
    back = rows.select("row_id", text.stored_tokens(F.col("stored")).alias("_t"))
    return back.select("row_id", F.array_join("_t", " ").alias("tokens"), F.size("_t").cast("long").alias("n"))


@query(
    f"SELECT page_id, {B.unescape_sql('html')} AS html FROM pages"
)
def html_unescape(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "pages").select("page_id", segment.html_unescape("html").alias("html"))


@query(f"WITH {B.CORPUS} SELECT row_id, len(tokens)::BIGINT AS word_count FROM corpus")
def word_count(spark: SparkSession, folder: str) -> DataFrame:
    return B.corpus(spark, folder).select("row_id", F.size("tokens").cast("long").alias("word_count"))


@query(
    f"WITH {B.CLEANED}, r AS (SELECT *, row_number() OVER (PARTITION BY cleaned_text ORDER BY platform, row_id) AS rn FROM tagged) "
    "SELECT row_id, platform, language FROM r WHERE rn = 1"
)
def dedup_first(spark: SparkSession, folder: str) -> DataFrame:
    rows = first_rows(B.cleaned(spark, folder), ["cleaned_text"], ["platform", "row_id"])
    return rows.select("row_id", "platform", "language")


@query(f"WITH {B.CLEANED} SELECT row_id, length(cleaned_text)::BIGINT AS n_chars FROM tagged WHERE length(cleaned_text) > 5")
def min_length(spark: SparkSession, folder: str) -> DataFrame:
    rows = B.cleaned(spark, folder).where(F.length("cleaned_text") > 5)
    return rows.select("row_id", F.length("cleaned_text").cast("long").alias("n_chars"))


@query(
    f"WITH {B.CORPUS} SELECT row_id, platform, language, cleaned_text, array_to_string(tokens, ' ') AS tokens FROM corpus"
)
def clean_corpus(spark: SparkSession, folder: str) -> DataFrame:
    rows = B.corpus(spark, folder)
    return rows.select("row_id", "platform", "language", "cleaned_text", F.array_join("tokens", " ").alias("tokens"))


@query(f"WITH {B.CORPUS} SELECT language, count(*) AS count FROM corpus GROUP BY language")
def lang_counts(spark: SparkSession, folder: str) -> DataFrame:
    return A.value_counts(B.corpus(spark, folder), "language")


@query(f"WITH {B.CORPUS} SELECT platform, count(*) AS count FROM corpus GROUP BY platform")
def platform_counts(spark: SparkSession, folder: str) -> DataFrame:
    return A.value_counts(B.corpus(spark, folder), "platform")


NAMES = {"src0": "alpha", "src1": "beta", "src2": "gamma"}


@query(
    "SELECT doc_id, text AS content, '' AS timestamp, lang AS \"user\", "
    "CASE source WHEN 'src0' THEN 'alpha' WHEN 'src1' THEN 'beta' WHEN 'src2' THEN 'gamma' ELSE source END AS platform, "
    "'auto' AS language FROM documents"
)
def canonical_columns(spark: SparkSession, folder: str) -> DataFrame:
    """Aliases renamed, required columns added, platforms mapped."""
    raw = table(spark, folder, "documents").withColumnRenamed("lang", "author").drop("n_chars")
    out = standardize(raw, F.col("source")).drop("source")
    return out.withColumn("platform", ids.platform_name(F.concat(F.lit(" "), F.col("platform")), NAMES))


@query(
    "SELECT doc_id, CASE source WHEN 'src0' THEN 'alpha' WHEN 'src1' THEN 'beta' WHEN 'src2' THEN 'gamma' ELSE source END AS platform FROM documents"
)
def platform_lookup(spark: SparkSession, folder: str) -> DataFrame:
    """The platform mapping as a left join on a mapping table."""
    names = spark.createDataFrame(list(NAMES.items()), "name string, shown string")
    return mapped_name(table(spark, folder, "documents"), "source", names, "platform").select("doc_id", "platform")


@query(
    "SELECT 'documents' AS platform, doc_id AS id, text AS content, NULL AS \"user\", NULL AS timestamp FROM documents "
    "UNION ALL SELECT 'conversations', conv_id, text, role, NULL FROM conversations "
    "UNION ALL SELECT 'benchmark', item_id, text, NULL, NULL FROM benchmark"
)
def union_sources(spark: SparkSession, folder: str) -> DataFrame:
    """Tables with differing columns in one frame."""
    frames = [
        table(spark, folder, "documents").select(F.col("doc_id").alias("id"), "text"),
        table(spark, folder, "conversations").select(F.col("conv_id").alias("id"), "text", F.col("role").alias("nick")),
        table(spark, folder, "benchmark").select(F.col("item_id").alias("id"), "text"),
    ]
    names = ("documents", "conversations", "benchmark")
    landed = [standardize(f, F.lit(n)).drop("language", "timestamp") for f, n in zip(frames, names)]
    merged = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), landed)
    return merged.withColumn("timestamp", F.lit(None).cast("string"))


@query(
    f"SELECT page_id, {B.clean_sql('html')} AS cleaned_text, {B.language_sql(B.clean_sql('html'))} AS language FROM pages"
)
def clean_pages(spark: SparkSession, folder: str) -> DataFrame:
    """Markup and links stripped from whole page sources."""
    pages = with_clean_text(table(spark, folder, "pages"), "html")
    return pages.select("page_id", "cleaned_text", "language")


@query("SELECT conv_id, turn, CASE WHEN role = 'system' THEN 'none' ELSE role END AS role, text FROM conversations WHERE role <> 'user'")
def handle_missing_values(spark: SparkSession, folder: str) -> DataFrame:
    """Blank values dropped where required and filled elsewhere."""
    role = F.when(F.col("role") == "system", " ").otherwise(F.col("role"))
    text_or_blank = F.when(F.col("role") != "user", F.col("text"))
    rows = table(spark, folder, "conversations").select("conv_id", "turn", role.alias("role"), text_or_blank.alias("text"))
    return handle_missing(rows, ["text"], {"role": "none"})


@query(
    "SELECT doc_id, quality, CASE WHEN ('0x' || substr(md5('42:' || doc_id), 1, 8))::BIGINT / 4294967296 < 0.8 THEN 'train' ELSE 'test' END AS part FROM labels"
)
def train_test_split(spark: SparkSession, folder: str) -> DataFrame:
    train, test = split_rows(table(spark, folder, "labels").select("doc_id", "quality"), "doc_id", 0.8)
    return train.withColumn("part", F.lit("train")).union(test.withColumn("part", F.lit("test")))
