"""Topics, term vectors, clusters and trained models."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fixed_values as V
from ..operators import aggregates as A
from ..operators import models as M
from ..operators import topics as T
from ..operators.sentiment import scored
from ..plans import reports as R
from . import base as B
from .base import query, table
from .report_queries import topic_sql

RULED = f"topics AS (SELECT row_id, {topic_sql('cleaned_text')} AS rule_topic FROM corpus)"


def ruled(spark: SparkSession, folder: str) -> DataFrame:
    return T.with_rule_topic(B.corpus(spark, folder), B.TOPICS, B.NO_TOPIC)


@query(f"WITH {B.CORPUS}, {RULED} SELECT * FROM topics")
def rule_topic(spark: SparkSession, folder: str) -> DataFrame:
    return ruled(spark, folder).select("row_id", "rule_topic")


@query(B.SQL["rule_topic"])
def rule_topic_table(spark: SparkSession, folder: str) -> DataFrame:
    """The same topics with the rules in a table."""
    rules = [(place, topic, word) for place, (topic, words) in enumerate(B.TOPICS) for word in words]
    listed = spark.createDataFrame(rules, "place int, topic string, word string")
    rows = T.with_rule_topic_by_table(B.corpus(spark, folder), "row_id", listed, B.NO_TOPIC)
    return rows.select("row_id", "rule_topic")


@query(
    f"WITH {B.CORPUS} SELECT row_id, {topic_sql('cleaned_text', V.TOPIC_RULES, V.TOPIC_OTHER)} AS rule_topic FROM corpus"
)
def rule_topic_default(spark: SparkSession, folder: str) -> DataFrame:
    """The seven default rules."""
    return T.with_rule_topic(B.corpus(spark, folder)).select("row_id", "rule_topic")


@query(f"WITH {B.CORPUS}, {RULED} SELECT rule_topic, count(*) AS count FROM topics GROUP BY rule_topic")
def topic_distribution(spark: SparkSession, folder: str) -> DataFrame:
    return R.topic_distribution(ruled(spark, folder))


@query(f"WITH {B.CORPUS}, {RULED} SELECT DISTINCT rule_topic FROM topics")
def topic_names(spark: SparkSession, folder: str) -> DataFrame:
    return T.topic_names(ruled(spark, folder))


@query(f"WITH {B.CORPUS}, {RULED} SELECT row_id FROM topics WHERE rule_topic = 'quarrel'")
def topic_rows(spark: SparkSession, folder: str) -> DataFrame:
    return T.rows_of_topic(ruled(spark, folder), "quarrel").select("row_id")


@query(
    f"WITH {B.SCORED}, {RULED} SELECT rule_topic AS value, count(*) AS count, "
    "printf('%.1f', count(*) / (SELECT count(*) FROM topics) * 100)::DOUBLE AS share FROM topics GROUP BY rule_topic ORDER BY count DESC, value LIMIT 1"
)
def top_topic_share(spark: SparkSession, folder: str) -> DataFrame:
    return A.top_value(ruled(spark, folder), "rule_topic")


@query(
    f"WITH {B.SCORED}, {RULED}, c AS (SELECT rule_topic, sentiment, count(*) AS count FROM topics JOIN scored USING (row_id) GROUP BY ALL), "
    "r AS (SELECT *, count / sum(count) OVER (PARTITION BY rule_topic) AS share, "
    "row_number() OVER (PARTITION BY rule_topic ORDER BY count DESC, sentiment) AS i FROM c) "
    "SELECT rule_topic, sentiment, count, share FROM r WHERE i <= 5"
)
def topic_sentiment_share(spark: SparkSession, folder: str) -> DataFrame:
    cleaned = B.stored(B.corpus(spark, folder).select("row_id", "cleaned_text", "language"), "cleaned")
    topics = T.with_rule_topic(cleaned, B.TOPICS, B.NO_TOPIC).select("row_id", "rule_topic")
    sentiments = scored(cleaned, B.POLARITY, **B.LEXICONS)
    return T.topic_sentiment_shares(T.topic_sentiment(topics, sentiments, "row_id"))


def term_source(spark: SparkSession, folder: str) -> DataFrame:
    return B.corpus(spark, folder).select("row_id", "tokens")


TFIDF = (
    f"{B.CORPUS}, tok AS (SELECT row_id, unnest(regexp_extract_all(lower(array_to_string(tokens, ' ')), "
    r"'[\p{L}\p{N}_]+')) AS term FROM corpus), "
    "tf AS (SELECT row_id, term, count(*) AS tf FROM tok GROUP BY ALL), "
    "vocab AS (SELECT term, sum(tf) AS total, count(*) AS df FROM tf GROUP BY term ORDER BY total DESC, term LIMIT 5000), "
    "w AS (SELECT row_id, term, tf, tf * (ln((1 + (SELECT count(*) FROM corpus)) / (1 + df)) + 1) AS w FROM tf JOIN vocab USING (term)), "
    "tfidf AS (SELECT row_id, term, tf, w / sqrt(sum(w * w) OVER (PARTITION BY row_id)) AS tfidf FROM w)"
)


@query(f"WITH {TFIDF} SELECT row_id, term, tf, round(tfidf, 6) AS tfidf FROM tfidf")
def tfidf_terms(spark: SparkSession, folder: str) -> DataFrame:
    rows = M.tfidf_rows(term_source(spark, folder), "row_id")
    return rows.withColumn("tfidf", F.round("tfidf", 6))


@query(
    f"WITH {TFIDF}, r AS (SELECT *, row_number() OVER (PARTITION BY row_id ORDER BY round(tfidf, 9) DESC, term) AS rank FROM tfidf) "
    "SELECT row_id, rank, term FROM r WHERE rank <= 5"
)
def tfidf_keywords(spark: SparkSession, folder: str) -> DataFrame:
    """Five strongest terms of every document."""
    rows = M.weighted_terms(term_source(spark, folder), "row_id")
    return M.top_terms_per_row(rows, "row_id", 5).select("row_id", F.col("rank").cast("long").alias("rank"), "term")


@query()
def kmeans_clusters(spark: SparkSession, folder: str) -> DataFrame:
    """Clusters of the whole corpus with their sizes and strongest terms."""
    clustered, model, names = M.cluster(M.counted_terms(term_source(spark, folder), keep=["row_id"]))
    terms = M.cluster_terms(clustered, model, names).groupBy("cluster").agg(
        F.sort_array(F.collect_list(F.struct("rank", "term"))).alias("_t")
    )
    sizes = M.cluster_sizes(clustered)
    return sizes.join(terms, "cluster", "left").select(
        "cluster", "size", F.concat_ws(" ", F.transform("_t", lambda t: t["term"])).alias("terms")
    )


BAYES = (
    "lab AS (SELECT l.doc_id, l.quality AS c, d.text FROM labels l JOIN documents d USING (doc_id)), "
    f"lw AS (SELECT doc_id, c, unnest({B.lexicon_words_sql('text')}) AS word FROM lab), "
    "vocab AS (SELECT word, count(*) AS n FROM lw GROUP BY word), "
    "classes AS (SELECT c, count(*) AS n FROM lab GROUP BY c), "
    "prior AS (SELECT c, ln(n + 1) - ln((SELECT sum(n) FROM classes) + (SELECT count(*) FROM classes)) AS p FROM classes), "
    "cw AS (SELECT c, word, count(*) AS n FROM lw JOIN vocab USING (word) GROUP BY c, word), "
    "ct AS (SELECT c, sum(n) AS total FROM cw GROUP BY c), "
    "theta AS (SELECT k.c, v.word, ln(coalesce(cw.n, 0) + 1) - ln(ct.total + (SELECT count(*) FROM vocab)) AS t "
    "FROM classes k CROSS JOIN vocab v LEFT JOIN cw ON cw.c = k.c AND cw.word = v.word JOIN ct ON ct.c = k.c), "
    f"dw AS (SELECT doc_id, word, count(*) AS n FROM (SELECT doc_id, unnest({B.lexicon_words_sql('text')}) AS word FROM documents) GROUP BY ALL), "
    "raw AS (SELECT doc_id, c, sum(n * t) AS s FROM dw JOIN theta USING (word) GROUP BY ALL), "
    "full_raw AS (SELECT d.doc_id, p.c, coalesce(s, 0) + p.p AS s FROM documents d CROSS JOIN prior p LEFT JOIN raw r ON r.doc_id = d.doc_id AND r.c = p.c), "
    "prob AS (SELECT a.doc_id, 1 / (1 + exp(least(700, b.s - a.s))) AS base_score FROM full_raw a JOIN full_raw b USING (doc_id) WHERE a.c = 1 AND b.c = 0)"
)


def labelled(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "text")
    return table(spark, folder, "labels").join(documents, "doc_id")


@query(f"WITH {BAYES} SELECT doc_id, round(base_score, 6) + 0 AS base_score FROM prob")
def nb_sentiment(spark: SparkSession, folder: str) -> DataFrame:
    """Naive Bayes trained on all labels scores all documents."""
    rows = labelled(spark, folder).withColumn("label", F.col("quality"))
    model = M.train_sentiment(rows)
    out = M.positive_probability(model, table(spark, folder, "documents").select("doc_id", "text"), key="doc_id")
    return out.select("doc_id", F.round("base_score", 6).alias("base_score"))


@query(
    f"WITH {BAYES} SELECT doc_id, (base_score > 0.5)::INT AS topic_label, round(greatest(base_score, 1 - base_score), 6) AS topic_confidence FROM prob"
)
def supervised_topics(spark: SparkSession, folder: str) -> DataFrame:
    """Supervised label with confidence for all documents."""
    model = M.train_topics(labelled(spark, folder), "text", "quality")
    out = M.predicted_topics(model, table(spark, folder, "documents").select("doc_id", "text"), "text", "doc_id")
    return out.select("doc_id", "topic_label", F.round("topic_confidence", 6).alias("topic_confidence"))


@query()
def supervised_topics_svm(spark: SparkSession, folder: str) -> DataFrame:
    model = M.train_topics(labelled(spark, folder), "text", "quality", kind="svm")
    out = M.predicted_topics(model, table(spark, folder, "documents").select("doc_id", "text"), "text", "doc_id")
    return out.select("doc_id", "topic_label")
