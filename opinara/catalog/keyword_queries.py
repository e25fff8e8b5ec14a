"""Keyword statistics over the cleaned corpus."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fixed_values as V
from ..functions.text import lexicon_words
from ..operators import keywords as K
from ..operators.columns import computed_once
from ..operators.membership import (
    normalize_words,
    union_words,
    with_weight,
    without_words,
)
from ..plans import reports as R
from . import base as B
from .base import query, table

LISTS = {"entity": B.ENTITY, "vague": B.VAGUE, "boost": B.BOOST}
EXPLODED = f"{B.CORPUS}, t AS (SELECT row_id, platform, lower(trim(unnest(tokens))) AS word FROM corpus), w AS (SELECT * FROM t WHERE length(word) > 1)"
KEYWORDS = (
    f"{EXPLODED}, f AS (SELECT word FROM w WHERE NOT regexp_full_match(word, '[0-9]+[a-z0-9]*') "
    f"AND word NOT IN ({B.quoted(B.ENTITY)}) AND word NOT IN ({B.quoted(B.VAGUE)}) "
    "AND NOT (regexp_full_match(word, '[a-z]+') AND length(word) <= 2)), "
    f"k AS (SELECT word AS keyword, sum(CASE WHEN word IN ({B.quoted(B.BOOST)}) THEN 1.5::DOUBLE ELSE 1::DOUBLE END) AS weight FROM f GROUP BY word)"
)


@query(f"WITH {KEYWORDS} SELECT keyword, weight FROM k ORDER BY weight DESC, keyword LIMIT 30")
def keyword_weights_top30(spark: SparkSession, folder: str) -> DataFrame:
    return R.opinion_keywords(B.corpus(spark, folder), 30, **LISTS)


@query(f"WITH {KEYWORDS} SELECT keyword, weight FROM k ORDER BY weight DESC, keyword LIMIT 12")
def keyword_weights_top12(spark: SparkSession, folder: str) -> DataFrame:
    return R.opinion_keywords(B.corpus(spark, folder), 12, **LISTS)


@query(f"WITH {KEYWORDS} SELECT keyword, weight FROM k")
def keyword_weights(spark: SparkSession, folder: str) -> DataFrame:
    return K.keyword_weights(B.corpus(spark, folder), **LISTS)


CLOUD_BARRED = sorted({*V.CLOUD_WORDS, *V.ENTITY_WORDS, *V.STOPWORDS_EN})
CLOUD = (
    f"{EXPLODED}, c AS (SELECT word, count(*) AS freq FROM w WHERE word NOT IN ({B.quoted(CLOUD_BARRED)}) "
    r"AND NOT regexp_full_match(word, '\p{Nd}+') GROUP BY word HAVING count(*) >= 3)"
)


@query(f"WITH {CLOUD} SELECT word, freq FROM c")
def word_freq_min3(spark: SparkSession, folder: str) -> DataFrame:
    return K.word_frequencies(B.corpus(spark, folder), CLOUD_BARRED)


@query(f"WITH {CLOUD} SELECT word, freq FROM c ORDER BY freq DESC, word LIMIT 120")
def word_cloud_top120(spark: SparkSession, folder: str) -> DataFrame:
    return R.word_cloud(B.corpus(spark, folder), CLOUD_BARRED)


@query(f"WITH {CLOUD} SELECT word, freq FROM c ORDER BY freq DESC, word LIMIT 20")
def word_freq_top20(spark: SparkSession, folder: str) -> DataFrame:
    return K.top_words(K.word_frequencies(B.corpus(spark, folder), CLOUD_BARRED), 20)


@query(f"WITH {EXPLODED} SELECT word, count(*) AS n FROM w GROUP BY word")
def token_frequency(spark: SparkSession, folder: str) -> DataFrame:
    return K.token_counts(B.corpus(spark, folder))


@query(
    f"SELECT word, count(*) AS n FROM (SELECT unnest({B.lexicon_words_sql('text')}) AS word FROM documents) "
    f"WHERE length(word) > 1 AND word NOT IN ({B.quoted(V.STOPWORDS_EN)}) AND word NOT IN ({B.quoted(B.ENTITY)}) GROUP BY word"
)
def stopword_anti_join(spark: SparkSession, folder: str) -> DataFrame:
    """Word counts of whole texts without stop words and entity words."""
    rows = computed_once(B.documents(spark, folder), "tokens", lexicon_words(F.col("content")))
    counts = without_words(K.token_counts(rows), "word", V.STOPWORDS_EN)
    return without_words(counts, "word", B.ENTITY)


@query(
    "WITH lex AS (SELECT DISTINCT lower(trim(w)) AS word FROM (SELECT unnest(string_split(text, ' ')) AS w FROM benchmark)), "
    f"s AS (SELECT unnest({B.lexicon_words_sql('text')}) AS word FROM documents) "
    "SELECT word, count(*) AS n FROM s WHERE length(word) > 1 AND word NOT IN (SELECT word FROM lex WHERE word <> '') GROUP BY word"
)
def table_anti_join(spark: SparkSession, folder: str) -> DataFrame:
    """Word counts without the words of a second table, whose size is measured first."""
    listed = table(spark, folder, "benchmark").select(F.explode(F.split("text", " ")).alias("w"))
    rows = computed_once(B.documents(spark, folder), "tokens", lexicon_words(F.col("content")))
    return without_words(K.token_counts(rows), "word", normalize_words(listed, "w"))


@query(
    "SELECT DISTINCT lower(trim(w)) AS word FROM (SELECT unnest(string_split(text, ' ')) AS w FROM benchmark "
    "UNION ALL SELECT role FROM conversations UNION ALL SELECT event_type FROM events) WHERE trim(w) <> ''"
)
def lexicon_union(spark: SparkSession, folder: str) -> DataFrame:
    """Word lists of several tables, normalized and merged."""
    words = table(spark, folder, "benchmark").select(F.explode(F.split("text", " ")).alias("w"))
    return union_words(
        normalize_words(words, "w"),
        normalize_words(table(spark, folder, "conversations"), "role"),
        normalize_words(table(spark, folder, "events"), "event_type"),
    )


@query(
    f"WITH {EXPLODED} SELECT word, count(*) AS n, CASE WHEN word IN ({B.quoted(B.BOOST)}) THEN 1.5::DOUBLE ELSE 1::DOUBLE END AS weight FROM w GROUP BY word"
)
def boost_weights(spark: SparkSession, folder: str) -> DataFrame:
    boost = {w: V.BOOST_WEIGHT for w in B.BOOST}
    return with_weight(K.token_counts(B.corpus(spark, folder)), "word", boost, V.PLAIN_WEIGHT)


PHRASES = ("Worthless", "best", "que les", "reti", "und der", "thed")


@query(
    f"WITH {B.CORPUS} SELECT count(*) FILTER (m) AS matches, count(*) AS total, avg(m::INT) AS share FROM "
    "(SELECT regexp_matches(cleaned_text, 'worthless|best|que les|reti|und der|thed', 'i') AS m FROM corpus)"
)
def regex_share(spark: SparkSession, folder: str) -> DataFrame:
    return R.stance_share(B.corpus(spark, folder), PHRASES)


@query(f"WITH {EXPLODED} SELECT platform, word, count(*) AS freq FROM w GROUP BY platform, word")
def word_by_platform(spark: SparkSession, folder: str) -> DataFrame:
    return K.word_frequency_by(B.corpus(spark, folder), ["platform"])


NEIGHBOURS = (
    f"WITH RECURSIVE {B.CORPUS}, tok AS (SELECT row_id, unnest(tokens) AS word, generate_subscripts(tokens, 1) AS i FROM corpus), "
    "p AS (SELECT a.word AS one, b.word AS two FROM tok a JOIN tok b ON a.row_id = b.row_id AND b.i BETWEEN a.i + 1 AND a.i + 4 WHERE a.word <> b.word), "
    "edges AS MATERIALIZED (SELECT src, word, count(*) AS w FROM (SELECT one AS src, two AS word FROM p UNION ALL SELECT two, one FROM p) GROUP BY ALL), "
    "sums AS (SELECT src, sum(w) AS s FROM edges GROUP BY src), "
    "shares AS MATERIALIZED (SELECT src, word, w / s AS share FROM edges JOIN sums USING (src))"
)
#: More rounds than any table here needs to settle.
ENOUGH = 150


@query(
    f"{NEIGHBOURS}, r AS (SELECT src AS word, 1::DOUBLE AS rank, 0 AS k FROM sums UNION ALL "
    "SELECT shares.word, 0.15::DOUBLE + 0.85::DOUBLE * sum(share * rank), k + 1 FROM shares JOIN r ON shares.src = r.word "
    f"WHERE k < {ENOUGH} GROUP BY shares.word, k) SELECT word, round(rank, 3) AS rank FROM r WHERE k = {ENOUGH}"
)
def text_rank(spark: SparkSession, folder: str) -> DataFrame:
    """Settled ranks of all words by their neighbours in the cleaned texts."""
    pairs = B.stored(K.neighbour_pairs(B.corpus(spark, folder)), "pairs")
    return K.text_rank(pairs, tolerance=1e-11).select("word", F.round("rank", 3).alias("rank"))


@query(
    f"{NEIGHBOURS} SELECT word, count(*) AS neighbours, true AS settled, (SELECT count(*) FROM sums) AS total FROM shares GROUP BY word"
)
def text_rank_settled(spark: SparkSession, folder: str) -> DataFrame:
    """Each rank against the one that the neighbours' ranks give; all ranks sum to the number of words."""
    pairs = B.stored(K.neighbour_pairs(B.corpus(spark, folder)), "pairs")
    packed = K.packed_pairs(pairs)
    ranks, shares = K.text_rank(pairs, packed=packed), K.neighbour_shares(pairs, packed)
    given = K.given_ranks(shares, ranks)
    near = F.abs(F.col("rank") - (0.15 + 0.85 * F.col("given"))) <= 1e-8 * F.col("rank")
    total = ranks.agg(F.round(F.sum("rank")).cast("long").alias("total"))
    return given.join(ranks, "word").select("word", "neighbours", near.alias("settled")).crossJoin(F.broadcast(total))
