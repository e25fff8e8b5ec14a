"""The registered query of each operator, with its check SQL where SQL can state it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import work_path
from . import bpe, caps, chat, exact_dedup, minhash, mixing, packing, pii, quality, scan_queries, warc
from .registry import QUERIES, SQL, query, table

__all__ = ["QUERIES", "SQL", "scan_queries"]

#: The rank file that texts are packed with, and the pattern that splits them.
RANKS, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")

MIXING = r"""
WITH sizes AS (
  SELECT doc_id, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size, source,
         substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 16) AS shuffle
  FROM documents),
sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place
  FROM sizes GROUP BY source),
weighed AS (
  SELECT *, CASE place % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS weight,
         CASE place % 3 WHEN 0 THEN 0.0::DOUBLE WHEN 1 THEN 0.5::DOUBLE ELSE -0.5::DOUBLE END AS tilt,
         2.0::DOUBLE * source_size AS most
  FROM sources),
ranked AS (
  SELECT *, coalesce(sum(most) OVER w, 0) AS full_before, sum(weight) OVER v AS weight_left,
         (SELECT 1.5::DOUBLE * sum(source_size) FROM sources) AS total
  FROM weighed
  WINDOW w AS (ORDER BY most / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
         v AS (ORDER BY most / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
level AS (
  SELECT arg_min((total - full_before) / weight_left, most / weight) AS level
  FROM ranked WHERE (total - full_before) / weight_left <= most / weight),
planned AS (
  SELECT source, source_size, weight, tilt, least(level * weight, most) AS target FROM ranked, level),
passed AS (
  SELECT s.doc_id, s.size, p.source_size, p.weight, p.tilt, p.target,
         coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.shuffle, s.doc_id, s.size
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + s.size / 2.0::DOUBLE AS middle
  FROM sizes s JOIN planned p ON s.source IS NOT DISTINCT FROM p.source),
taken AS (
  SELECT *, CASE WHEN target > 0 AND middle <= target THEN 1 ELSE 0 END
          + CASE WHEN target > 0 AND source_size + middle <= target THEN 1 ELSE 0 END AS copies
  FROM passed)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target, CAST(copies * size AS BIGINT) AS taken,
       CASE WHEN copies > 0 THEN round(
         CASE WHEN middle = 0 THEN 0 ELSE 2 * (middle / target)
           / (1 - tilt + sqrt((1 - tilt) * (1 - tilt) + 4 * (middle / target) * tilt)) END, 6) END AS first_position
FROM taken
"""


@query(MIXING)
def op2_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """The mix of all documents, in training order; documents that it leaves out come last."""
    plan = mixing.mixed(table(spark, folder, "documents"))
    plan = plan.withColumn("first_position", F.round(F.get("positions", F.lit(0)), 6)).drop("positions")
    return plan.orderBy(F.col("first_position").asc_nulls_last(), "doc_id")


EXACT = r"""
WITH plain AS (
  SELECT doc_id, length(coalesce(text, '')) AS n_chars,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents),
keepers AS (
  SELECT *, first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY n_chars DESC, doc_id NULLS LAST) AS keep_id,
         count(*) OVER (PARTITION BY text_sha256) AS group_size
  FROM plain)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, text_sha256 FROM keepers
"""


@query(EXACT)
def op6_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """What becomes of every document."""
    return exact_dedup.exact_duplicates(table(spark, folder, "documents")).drop("n_chars")


@query()
def op7_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Every document encoded, and decoded again from its ids."""
    rows = bpe.encode(table(spark, folder, "documents"), TOKENIZER, decoded=True)
    return rows.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


NEAR = r"""
WITH RECURSIVE worded AS (
  SELECT doc_id, coalesce(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), []) AS w
  FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS s
  FROM worded),
items AS (SELECT doc_id, unnest(s) AS item FROM sets),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
  FROM items a JOIN items b ON a.item = b.item AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (
  SELECT a, b FROM common JOIN sets x ON x.doc_id = a JOIN sets y ON y.doc_id = b
  WHERE 100 * c >= 85 * (len(x.s) + len(y.s) - c)),
reach AS (
  SELECT doc_id, doc_id AS other FROM sets
  UNION SELECT r.doc_id, l.b FROM reach r JOIN links l ON r.other = l.a),
named AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY 1)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept
FROM sets JOIN named USING (doc_id)
"""


@query(NEAR)
def op10_minhash(spark: SparkSession, folder: str) -> DataFrame:
    """The near-duplicate component of every document."""
    return minhash.near_duplicates(table(spark, folder, "documents"), width=3, percent=85)


@query()
def op3_quality(spark: SparkSession, folder: str) -> DataFrame:
    """The quality score of every document."""
    return quality.quality(table(spark, folder, "documents"), table(spark, folder, "labels"))


def _spans_sql(kind: str, rank: int, pattern: str, check: str, score: str, bounded: bool = False, least: float = 0.0) -> str:
    """Spans of one kind for DuckDB: a row per match, with the gaps on both sides."""
    edges = "AND NOT regexp_matches(right(before, 1) || left(after, 1), '[A-Za-z0-9]')" if bounded else ""
    return rf"""
  SELECT doc_id, {rank} AS rank, '{kind}' AS kind, start, start + length(m) AS stop, {score} AS score FROM (
    SELECT doc_id, m, before, after, lower(right(before, 40) || ' ' || left(after, 40)) AS near,
           regexp_replace(m, '[ +().-]', '', 'g') AS digits,
           CAST(sum(length(before) + length(m)) OVER (PARTITION BY r ORDER BY i) - length(m) AS BIGINT) AS start
    FROM (SELECT doc_id, r, unnest(found) AS m, unnest(between[:len(found)]) AS before, unnest(between[2:]) AS after,
                 unnest(range(len(found))) AS i
          FROM (SELECT doc_id, r, regexp_extract_all(text, '{pattern}') AS found, string_split_regex(text, '{pattern}') AS between FROM texts)))
  WHERE ({check}) {edges} AND {score} >= {least}"""


_LUHN = r"""length(digits) BETWEEN 12 AND 19 AND list_sum(list_transform(range(length(digits)), lambda i:
    CASE WHEN i % 2 = 0 THEN CAST(substr(digits, length(digits) - i, 1) AS INT)
         ELSE [0, 2, 4, 6, 8, 1, 3, 5, 7, 9][1 + CAST(substr(digits, length(digits) - i, 1) AS INT)] END)) % 10 = 0"""
_MOD_97 = r"""list_reduce(list_prepend(0::BIGINT, list_transform(
    string_split(substr(replace(m, ' ', ''), 5) || left(replace(m, ' ', ''), 4), ''), lambda c: CAST(ascii(c) AS BIGINT))),
    lambda s, c: CASE WHEN c < 65 THEN (s * 10 + c - 48) % 97 ELSE (s * 100 + c - 55) % 97 END) = 1"""


def _score(base: float, words: str) -> str:
    return f"round(least({base}::DOUBLE + CASE WHEN regexp_matches(near, '{words}') THEN 0.3::DOUBLE ELSE 0 END, 1), 2)"


_TEL = "phone|call|tel|mobile|fax"
PII = (
    "WITH texts AS (SELECT doc_id, coalesce(text, '') AS text, row_number() OVER () AS r FROM documents), spans AS ("
    + " UNION ALL ".join(
        (
            _spans_sql("email", 0, r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", "true", _score(0.7, "mail|contact|write")),
            _spans_sql(
                "ip", 1, r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)",
                "list_max(list_transform(string_split(m, '.'), lambda p: CAST(p AS HUGEINT))) <= 255", _score(0.5, "ip|host|server|address"),
            ),
            _spans_sql("card", 2, r"[0-9](?:[\x20-]?[0-9])+", _LUHN, _score(0.8, "card|visa|credit|payment|pay")),
            _spans_sql("phone", 3, r"\+[0-9][\x20().0-9-]+[0-9]", "length(digits) BETWEEN 9 AND 15", _score(0.5, _TEL)),
            _spans_sql("iban", 4, r"[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}", _MOD_97, _score(0.7, "iban|account|bank|transfer|konto"), True, 0.6),
            _spans_sql(
                "ssn", 5, "[0-9]{3}-[0-9]{2}-[0-9]{4}",
                "NOT regexp_matches(m, '^(000|666|9)') AND substr(m, 5, 2) <> '00' AND substr(m, 8, 4) <> '0000'",
                _score(0.3, "ssn|social|security"), True, 0.6,
            ),
            _spans_sql("tel", 6, r"[0-9]{3}[\x20.-][0-9]{3}[\x20.-][0-9]{4}", "true", _score(0.3, _TEL), True, 0.6),
        )
    )
    + """),
joined AS (
  SELECT doc_id, count(*) FILTER (rank = 0) AS n_email, count(*) FILTER (rank = 1) AS n_ip,
         count(*) FILTER (rank = 2) AS n_card, count(*) FILTER (rank = 3) AS n_phone,
         string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rank) FILTER (rank < 4) AS base,
         string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rank) AS spans,
         max(score) AS top_score
  FROM spans GROUP BY doc_id)
SELECT doc_id, coalesce(n_email, 0) AS n_email, coalesce(n_ip, 0) AS n_ip, coalesce(n_card, 0) AS n_card,
       coalesce(n_phone, 0) AS n_phone, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, top_score
FROM documents LEFT JOIN joined USING (doc_id)"""
)


@query(PII)
def op8_pii(spark: SparkSession, folder: str) -> DataFrame:
    """Personal data of every document."""
    rows = pii.personal_data(table(spark, folder, "documents"))
    of_kind = lambda rank: F.filter("found", lambda x: x["rank"] == rank)
    counts = [F.size(of_kind(k)).cast("long").alias(f"n_{kind.name}") for k, kind in enumerate(pii.KINDS) if kind.base]
    base = F.filter("found", lambda x: x["rank"] < len(counts))
    return rows.select(
        "doc_id",
        *counts,
        F.sha2(pii.span_list(base), 256).alias("base_sha256"),
        pii.span_list(F.col("found")).alias("spans"),
        F.array_max(F.transform("found", lambda x: x["score"])).alias("top_score"),
    )


CAPS = """
WITH RECURSIVE vectors AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND list_max(list_transform(embedding, lambda x: abs(x))) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM vectors a JOIN vectors b ON a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.v, b.v) >= 0.95),
reach AS (
  SELECT vec_id, vec_id AS other FROM embeddings
  UNION SELECT r.vec_id, l.b FROM reach r JOIN links l ON r.other = l.a),
named AS (SELECT vec_id, min(other) AS component_id FROM reach GROUP BY 1),
counted AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY 1)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM named LEFT JOIN counted USING (vec_id)
"""


@query(CAPS)
def op4_caps(spark: SparkSession, folder: str) -> DataFrame:
    """Links and component of every vector."""
    return caps.near_vectors(table(spark, folder, "embeddings"))


WARC = """
WITH payloads AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
firsts AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM payloads)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id <> first THEN first END AS refers_to
FROM firsts
"""


@query(WARC)
def op5_warc(spark: SparkSession, folder: str) -> DataFrame:
    """All pages written as WARC files and read back."""
    out = work_path(spark, "warc")
    warc.write_warc(table(spark, folder, "pages"), out)
    return warc.read_warc(spark, out).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


CHAT = r"""
WITH turns AS (
  SELECT conv_id, coalesce(turn, 9223372036854775807) AS turn, replace(coalesce(text, ''), '<|', '<\|') AS text,
         CASE WHEN trim(regexp_replace(coalesce(role, ''), '[\s<|>=]+', ' ', 'g')) = '' THEN 'unknown'
              ELSE trim(regexp_replace(role, '[\s<|>=]+', ' ', 'g')) END AS speaker
  FROM conversations),
placed AS (
  SELECT *, coalesce(sum(length(text) + 32) OVER (PARTITION BY conv_id ORDER BY turn, speaker, text
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) // 1000000 AS part FROM turns),
people AS (SELECT DISTINCT conv_id, speaker AS assistant FROM turns WHERE speaker <> 'system'),
drawn AS (
  SELECT t.conv_id, p.assistant, t.part, t.turn, t.speaker, t.text, t.speaker = p.assistant AS mine,
         '<|im_start|>' || CASE WHEN t.speaker = p.assistant THEN 'assistant' WHEN t.speaker = 'system' THEN 'system'
                                ELSE 'user name=' || t.speaker END || chr(10) AS head, t.text || '<|im_end|>' AS body
  FROM placed t JOIN people p ON t.conv_id IS NOT DISTINCT FROM p.conv_id),
spans AS (
  SELECT *, sum(length(head) + length(body) + 1) OVER (PARTITION BY conv_id, assistant, part ORDER BY turn, speaker, text
    ROWS UNBOUNDED PRECEDING) - length(body) - 1 AS start FROM drawn)
SELECT conv_id, assistant, CAST(part AS BIGINT) AS part, count(*) AS n_turns,
       sha256(string_agg(head || body || chr(10), '' ORDER BY turn, speaker, text)) AS text_sha256,
       CAST(coalesce(sum(length(body)) FILTER (mine), 0) AS BIGINT) AS n_masked,
       coalesce(string_agg(CAST(start AS BIGINT) || ':' || CAST(start + length(body) AS BIGINT), ',' ORDER BY turn, speaker, text) FILTER (mine), '') AS masks
FROM spans GROUP BY conv_id, assistant, part
"""


@query(CHAT)
def op1_chat(spark: SparkSession, folder: str) -> DataFrame:
    """Every conversation from the perspective of each participant."""
    rows = chat.rotated(table(spark, folder, "conversations"))
    return rows.select(
        "conv_id",
        "assistant",
        "part",
        "n_turns",
        F.sha2("text", 256).alias("text_sha256"),
        F.aggregate("masks", F.lit(0), lambda n, m: n + m["stop"] - m["start"]).cast("long").alias("n_masked"),
        F.array_join(F.transform("masks", lambda m: F.concat_ws(":", m["start"], m["stop"])), ",").alias("masks"),
    )


@query()
def op9_packing(spark: SparkSession, folder: str) -> DataFrame:
    """Every document packed into rows, and read back from the files."""
    out = work_path(spark, "packed")
    packing.write_packed(table(spark, folder, "documents"), out, RANKS, PATTERN)
    rows = packing.read_packed(spark, out)
    digest = F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256)
    return rows.select("doc_id", "n_tokens", "n_pieces", digest.alias("ids_sha256"))
