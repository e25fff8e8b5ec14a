"""Registry of queries and the parts they share.

Every query reads whole tables of the data folder. ``SQL`` holds the same
question for DuckDB, written independently: step by step where the Spark side
merges steps, with joins where the Spark side uses arrays.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fixed_values as V
from ..functions.scoring import sentiment_label
from ..operators.sentiment import scored
from ..plans.clean import STOPWORDS, clean_corpus, with_clean_text
from ..session import work_path

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if sql:
            SQL[function.__name__] = sql
        return function

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table of the data folder."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


# Lexicons made of words that occur in the test tables.
ENTITY = ("thatin", "ononst", "inoran")
VAGUE = ("rewh", "hehely", "eren")
BOOST = ("orre", "worthless", "best", "thed")
POLARITY = {
    "best": 1.0, "worthless": -0.9, "stupid": -0.8, "idiot": -0.7,
    "with": 0.45, "that": 0.6, "from": -0.65, "was": -0.4, "this": 0.35, "are": -0.15,
    "und": 0.25, "les": -0.55, "del": 0.5,
}
POSITIVE = ("best", "with", "for", "this", "und")
NEGATIVE = ("worthless", "stupid", "idiot", "from", "was", "les")
POSITIVE_PARTS = ("best", "thed", " mit ")
NEGATIVE_PARTS = ("worthless", "stupid", "idiot", "reti")
NEGATIONS = ("nicht", "onon", "ne ")
LEXICONS = {
    "positive_en": POSITIVE, "negative_en": NEGATIVE,
    "positive_zh": POSITIVE_PARTS, "negative_zh": NEGATIVE_PARTS, "negations": NEGATIONS,
}
TOPICS = (
    ("quarrel", ("idiot", "stupid", "worthless")),
    ("praise", ("best", "thanks")),
    ("french", (" que ", " les ")),
    ("german", (" und ", " der ")),
    ("spanish", (" los ", " del ")),
)
NO_TOPIC = "other"
# Odd on purpose: means of the scaled values never fall on a rounding tie.
EVENT_SCALE = 101.7


def documents(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as landed comments."""
    return table(spark, folder, "documents").select(
        F.col("doc_id").alias("row_id"), F.col("source").alias("platform"), F.col("text").alias("content")
    )


def corpus(spark: SparkSession, folder: str) -> DataFrame:
    return clean_corpus(documents(spark, folder))


def stored(df: DataFrame, label: str) -> DataFrame:
    """The rows written to the shared folder and read back, for plans that use them more than once."""
    path = work_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def scored_corpus(spark: SparkSession, folder: str) -> DataFrame:
    return scored(corpus(spark, folder), POLARITY, **LEXICONS)


def cleaned(spark: SparkSession, folder: str) -> DataFrame:
    return with_clean_text(documents(spark, folder))


def scored_events(spark: SparkSession, folder: str) -> DataFrame:
    """Events as scored comments: type as platform, value on a 0..1 scale."""
    events = table(spark, folder, "events")
    rows = events.select(
        F.col("event_id").alias("row_id"),
        F.col("event_type").alias("platform"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("publish_time"),
        F.least(F.lit(1.0), F.col("value") / F.lit(EVENT_SCALE)).alias("sentiment_score"),
    )
    return rows.withColumn("sentiment", sentiment_label(F.col("sentiment_score")))


# --- the same parts as SQL --------------------------------------------------------


def quoted(words) -> str:
    return ", ".join("'" + w.replace("'", "''") + "'" for w in words)


def pairs(values: dict[str, float]) -> str:
    return ", ".join(f"('{w}', {v}::DOUBLE)" for w, v in sorted(values.items()))


NON_SPACE = r"[^\s\v\x1c-\x1f\x{85}\p{Z}]"
SPACES = r"[\s\v\x1c-\x1f\x{85}\p{Z}]+"
EMOJI = r"[\x{1F600}-\x{1F64F}\x{1F300}-\x{1F5FF}\x{1F680}-\x{1F6FF}]+"


def replaced(value: str, pattern: str, by: str = "") -> str:
    return f"regexp_replace({value}, '{pattern}', '{by}', 'g')"


def clean_sql(value: str) -> str:
    out = replaced(f"coalesce({value}, '')", r"\[[^\[\]\n]*?\]")
    out = replaced(out, rf"http{NON_SPACE}+|@[\p{{L}}\p{{N}}_]+|【.*?】|《.*?》|<.*?>")
    out = replaced(out, EMOJI)
    out = replaced(out, r"[^\p{L}\p{N}_\x{4e00}-\x{9fff}.,!?，。！？]", " ")
    return f"trim({replaced(out, ' +', ' ')})"


def space_sql(value: str) -> str:
    return f"trim({replaced(f'replace(coalesce({value}, {chr(39)}{chr(39)}), chr(8203), {chr(39)}{chr(39)})', SPACES, ' ')})"


def language_sql(value: str) -> str:
    words = f"regexp_extract_all({value}, '[A-Za-z]{{2,}}')"
    cjk = rf"len(regexp_extract_all({value}, '[\x{{4e00}}-\x{{9fff}}]'))"
    letters = f"length(array_to_string({words}, ''))"
    return (
        f"CASE WHEN {cjk} >= 2 AND {cjk} >= {letters} * 0.3::DOUBLE THEN 'zh' "
        f"WHEN {letters} >= 8 AND len({words}) >= 2 THEN 'en' ELSE 'other' END"
    )


def unescape_sql(value: str) -> str:
    """The entities of the test tables; old names also count without a semicolon."""
    for name, shown in (("copy", "©"), ("quot", '"'), ("middot", "·"), ("amp", "&")):
        value = replaced(value, f"&{name};?", shown)
    return value


def tokens_sql(value: str, stopwords) -> str:
    """English tokens in order, as a list."""
    return (
        f"[w FOR w IN [trim(x, '''-_') FOR x IN regexp_extract_all(lower({value}), "
        f"'[A-Za-z][A-Za-z''\\-]+')] IF length(w) > 2 AND w NOT IN ({quoted(stopwords)})]"
    )


def lexicon_words_sql(value: str) -> str:
    return f"regexp_extract_all(lower({value}), '[A-Za-z][A-Za-z''\\-]*')"


BARRED = sorted({*STOPWORDS, *V.ENTITY_WORDS})

CLEANED = (
    f"cleaned AS (SELECT doc_id AS row_id, source AS platform, {clean_sql('text')} AS cleaned_text FROM documents), "
    f"tagged AS (SELECT *, {language_sql('cleaned_text')} AS language FROM cleaned)"
)
CORPUS = (
    f"{CLEANED}, ranked AS (SELECT *, row_number() OVER (PARTITION BY cleaned_text ORDER BY platform, row_id) AS rn FROM tagged), "
    "kept AS (SELECT row_id, platform, cleaned_text, language FROM ranked WHERE rn = 1 AND length(cleaned_text) > 5), "
    f"corpus AS (SELECT *, CASE WHEN language = 'en' THEN {tokens_sql('cleaned_text', BARRED)} ELSE [] END AS tokens FROM kept)"
)


def label_sql(score: str) -> str:
    return (
        f"CASE WHEN {score} > 0.7::DOUBLE THEN '{V.LABEL_POSITIVE}' "
        f"WHEN {score} < 0.3::DOUBLE THEN '{V.LABEL_NEGATIVE}' ELSE '{V.LABEL_NEUTRAL}' END"
    )


def contains_sql(value: str, words) -> str:
    return "(" + " OR ".join(f"contains({value}, '{w}')" for w in words) + ")"


SCORED = (
    f"{CORPUS}, spoken AS (SELECT row_id, unnest({lexicon_words_sql('cleaned_text')}) AS word FROM corpus), "
    f"mood AS (SELECT row_id, avg(p) AS polarity FROM spoken JOIN (VALUES {pairs(POLARITY)}) AS lex(word, p) USING (word) GROUP BY row_id), "
    f"hits AS (SELECT row_id, count(DISTINCT word) FILTER (word IN ({quoted(POSITIVE)})) AS up, "
    f"count(DISTINCT word) FILTER (word IN ({quoted(NEGATIVE)})) AS down FROM spoken GROUP BY row_id), "
    "parts AS (SELECT c.*, coalesce(m.polarity, 0) AS polarity, coalesce(h.up, 0) AS up, coalesce(h.down, 0) AS down, "
    f"{contains_sql('cleaned_text', POSITIVE_PARTS)} AS has_pos, {contains_sql('cleaned_text', NEGATIVE_PARTS)} AS has_neg, "
    f"{contains_sql('cleaned_text', NEGATIONS)} AS has_not "
    "FROM corpus c LEFT JOIN mood m USING (row_id) LEFT JOIN hits h USING (row_id)), "
    "english AS (SELECT *, least(1::DOUBLE, (polarity + 1) / 2 + least(0.2::DOUBLE, up * 0.06::DOUBLE)) AS e1 FROM parts), "
    "chinese AS (SELECT *, greatest(0::DOUBLE, e1 - least(0.25::DOUBLE, down * 0.06::DOUBLE)) AS e2, "
    "CASE WHEN has_pos THEN least(1::DOUBLE, 0.5::DOUBLE + 0.2::DOUBLE) ELSE 0.5::DOUBLE END AS z1 FROM english), "
    "lowered AS (SELECT *, CASE WHEN has_neg THEN greatest(0::DOUBLE, z1 - 0.3::DOUBLE) ELSE z1 END AS z2 FROM chinese), "
    "damped AS (SELECT *, CASE WHEN has_not THEN z2 * 0.7::DOUBLE ELSE z2 END AS z3 FROM lowered), "
    "points AS (SELECT *, CASE WHEN length(cleaned_text) < 5 THEN 0.5::DOUBLE WHEN language = 'en' THEN e2 ELSE z3 END AS sentiment_score FROM damped), "
    f"scored AS (SELECT *, {label_sql('sentiment_score')} AS sentiment FROM points)"
)

EVENTS = (
    "points AS (SELECT event_id AS row_id, event_type AS platform, ts, "
    f"least(1::DOUBLE, value / {EVENT_SCALE}::DOUBLE) AS sentiment_score FROM events), "
    f"scored AS (SELECT *, {label_sql('sentiment_score')} AS sentiment FROM points)"
)
