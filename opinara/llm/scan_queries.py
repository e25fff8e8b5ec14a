"""Registered queries of the license scan, the importance resampling and the run detection, with their check SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import licenses, resample, runs
from .arrays import once
from .common import SPACE
from .registry import query, table


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


_RULES = ",\n".join(
    f"({rank}, {_quoted(r.label)}, {[*r.keywords]}, {r.priority}, {_quoted(r.pattern)})" for rank, r in enumerate(licenses.RULES)
)
LICENSES = rf"""
WITH rules(rank, label, keywords, priority, pattern) AS (VALUES {_RULES}),
lists AS (
  SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
texts AS (
  SELECT doc_id, r, w, CASE WHEN len(w) = 0 THEN '' ELSE ' ' || array_to_string(w, '  ') || ' ' END AS t FROM lists),
phrases(label, p) AS (VALUES ('cc-by', ['cc', 'by']), ('gpl', ['general', 'public', 'license']), ('reserved', ['all', 'rights', 'reserved'])),
places AS (
  SELECT r, label, unnest(list_filter(range(0, len(w) - len(p) + 1), lambda i: w[i + 1:i + len(p)] = p)) AS place
  FROM texts, phrases WHERE list_has_all(w, p)),
base AS (
  SELECT r, count(*) AS n, min(place) AS first_word, max(place) AS last_word, string_agg(DISTINCT label, ',' ORDER BY label) AS labels
  FROM places GROUP BY r),
hits AS (
  SELECT r, rank, label, priority, regexp_extract_all(t, pattern) AS m, string_split_regex(t, pattern) AS gaps
  FROM texts JOIN rules ON list_has_all(w, keywords)),
each AS (
  SELECT r, rank, label, priority, unnest(range(len(m))) AS i, unnest(m) AS m, unnest(gaps[:len(m)]) AS gap FROM hits),
counted AS (
  SELECT *, (length(m) - length(replace(m, ' ', ''))) // 2 AS size, (length(gap) - length(replace(gap, ' ', ''))) // 2 AS before FROM each),
spans AS (
  SELECT r, rank, label, priority, size, sum(before + size) OVER (PARTITION BY r, rank ORDER BY i) AS stop FROM counted),
stays AS (
  SELECT r, label, priority FROM (SELECT *, stop - size AS start FROM spans) a WHERE NOT EXISTS (
    FROM (SELECT *, stop - size AS start FROM spans) b WHERE a.r = b.r AND (a.rank <> b.rank OR a.start <> b.start) AND (
      (b.start <= a.start AND b.stop >= a.stop AND b.priority >= a.priority
       AND (b.start < a.start OR b.stop > a.stop OR b.priority > a.priority OR b.rank < a.rank))
      OR (b.priority > a.priority AND b.start < a.stop AND a.start < b.stop)))),
named AS (
  SELECT r, label, CASE priority WHEN 3 THEN 1.0::DOUBLE WHEN 2 THEN 0.9::DOUBLE ELSE 0.7::DOUBLE END AS score FROM stays
  UNION ALL SELECT r, label, 0.7::DOUBLE FROM places),
joined AS (SELECT r, string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(score) AS score FROM named GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n, 0) AS n_base, first_word, last_word,
       coalesce(base.labels, '') AS base_labels, coalesce(joined.labels, '') AS labels, coalesce(score, 0) AS score
FROM texts LEFT JOIN base USING (r) LEFT JOIN joined USING (r)
"""


@query(LICENSES)
def op13_licenses(spark: SparkSession, folder: str) -> DataFrame:
    """License phrases and labels of every document."""
    rows = licenses.licenses(table(spark, folder, "documents"))
    of = lambda array, field: F.transform(array, lambda x: x[field])
    sure = F.transform("found", lambda x: F.element_at(F.create_map(*[F.lit(v) for pair in licenses.SCORES.items() for v in pair]), x["priority"]))
    some = F.when(F.size("places") > 0, licenses.SCORES[licenses.NAME]).otherwise(0.0)
    joined = lambda labels: F.array_join(F.array_sort(F.array_distinct(labels)), ",")
    return rows.select(
        "doc_id", "n_words",
        F.aggregate("places", F.lit(0), lambda n, x: n + x["n"]).cast("long").alias("n_base"),
        F.array_min(of("places", "first")).cast("long").alias("first_word"),
        F.array_max(of("places", "last")).cast("long").alias("last_word"),
        joined(of("places", "label")).alias("base_labels"),
        joined(F.concat(of("places", "label"), of("found", "label"))).alias("labels"),
        F.greatest(some, F.coalesce(F.array_max(sure), F.lit(0.0))).alias("score"),
    )


#: CRC-32 of a list of bytes, by a table of the 256 one-byte steps.
_CRC_TABLE = """
crc AS (SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, [0, 0, 0, 0, 0, 0, 0, 0]),
  lambda x, y: CASE WHEN x % 2 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)) AS steps)"""


def _crc32(bytes_list: str) -> str:
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {bytes_list}), lambda x, b: xor(x >> 8, steps[1 + (xor(x, b) & 255)])), 4294967295)"


_UTF8 = "list_transform(range(strlen(f)), lambda i: CAST('0x' || substr(hex(encode(f)), 2 * i + 1, 2) AS BIGINT))"
RESAMPLE = rf"""
WITH {_CRC_TABLE},
lists AS (
  SELECT doc_id, row_number() OVER () AS r, coalesce(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w
  FROM documents),
own AS (SELECT r, unnest(w) AS f FROM lists),
wanted AS (SELECT unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS f
  FROM benchmark),
hashed AS (
  SELECT f, {_crc32(_UTF8)} % 10000 AS bucket
  FROM (SELECT f FROM own UNION SELECT f FROM wanted) CROSS JOIN crc),
s AS (SELECT bucket, count(*) AS n FROM own JOIN hashed USING (f) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS n FROM wanted JOIN hashed USING (f) GROUP BY bucket),
gains AS (
  SELECT bucket, floor(1000 * ln((coalesce(t.n, 0) + 1)::DOUBLE * (coalesce((SELECT sum(n) FROM s), 0) + 10000)::DOUBLE
    / ((coalesce(s.n, 0) + 1)::DOUBLE * (coalesce((SELECT sum(n) FROM t), 0) + 10000)::DOUBLE)))::BIGINT AS gain
  FROM s FULL JOIN t USING (bucket)),
sums AS (SELECT r, sum(gain)::BIGINT AS weight FROM own JOIN hashed USING (f) JOIN gains USING (bucket) GROUP BY r),
noised AS (
  SELECT doc_id, len(w) AS n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0) + floor(-1000 * ln(-ln(
    (CAST('0x' || left(sha256('2024:' || doc_id), 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score
  FROM lists LEFT JOIN sums USING (r)),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id, n_features) AS place,
         (SELECT 10 * count(*) // 100 FROM noised WHERE n_features >= 20) AS number
  FROM noised)
SELECT doc_id, CAST(n_features AS BIGINT) AS n_features, weight, score, CASE WHEN n_features >= 20 AND place <= number THEN place END AS rank
FROM ranked
"""


@query(RESAMPLE)
def op12_resample(spark: SparkSession, folder: str) -> DataFrame:
    """Weight, score and rank of every document toward the texts of the benchmark."""
    return resample.resampled(table(spark, folder, "documents"), table(spark, folder, "benchmark")).drop("n_words")


RUNS = rf"""
WITH {_CRC_TABLE},
lists AS (
  SELECT doc_id, row_number() OVER () AS r, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w,
         {_crc32("list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))")} AS h
  FROM documents CROSS JOIN crc),
planned AS (SELECT *, CASE WHEN h % 10 = 0 AND len(w) > 0 THEN (h // 10) % len(w) END AS a, 3 + (h // 10) % 8 AS d FROM lists),
texts AS (
  SELECT doc_id, r, CASE WHEN a IS NULL THEN w
    ELSE list_transform(range(len(w)), lambda i: w[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (len(w) - a) // d) END]) END AS w
  FROM planned),
words AS (SELECT r, unnest(range(len(w))) AS i, unnest(w) AS word FROM texts),
same AS (
  SELECT x.r, y.i - x.i AS p, x.i AS i, x.i - row_number() OVER (PARTITION BY x.r, y.i - x.i ORDER BY x.i) AS island
  FROM words x JOIN words y ON x.r = y.r AND x.word = y.word AND x.i < y.i),
stretches AS (
  SELECT r, min(i) AS start, count(*) + p AS length, p FROM same
  GROUP BY r, p, island HAVING count(*) + p >= greatest(6, 4 * p)),
runs AS (SELECT r, start, length, min(p) AS period FROM stretches GROUP BY r, start, length),
gone AS (SELECT DISTINCT words.r, words.i FROM words JOIN runs ON words.r = runs.r AND i >= start + period AND i < start + length),
kept AS (
  SELECT r, string_agg(word, ' ' ORDER BY i) AS collapsed FROM words ANTI JOIN gone USING (r, i) GROUP BY r),
listed AS (
  SELECT r, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS lines FROM runs GROUP BY r),
best AS (SELECT r, start, length, period FROM runs QUALIFY row_number() OVER (PARTITION BY r ORDER BY length DESC, start, period) = 1)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, start, length, period, 1000 * length // period AS exponent_milli,
       sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(collapsed, '')) AS collapsed_sha256
FROM texts LEFT JOIN listed USING (r) LEFT JOIN best USING (r) LEFT JOIN kept USING (r)
"""


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text``; in the texts whose checksum says so the words from some place on repeat the first of them."""
    checksum = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))

    def planted(words: Column, g: Column) -> Column:
        start = (g % F.size(words)).cast("int")
        period = (1 + F.floor((F.size(words) - start) / (3 + g % 8))).cast("int")
        place = lambda i: F.when(i < start, i).otherwise(start + (i - start) % period)
        return F.when(F.size(words) > 0, F.array_join(F.transform(words, lambda _, i: F.get(words, place(i))), " ")).otherwise("")

    words = F.regexp_extract_all("text", F.lit(f"[^{SPACE}]+"), F.lit(0))
    text = F.when((checksum % 10 == 0) & F.col("text").isNotNull(), once(words, lambda w: planted(w, F.floor(checksum / 10))))
    return docs.select("doc_id", F.when(checksum % 10 == 0, text).otherwise(F.col("text")).alias("text"))


@query(RUNS)
def op11_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Periodic runs of every document, some of which get a run by rule."""
    rows = runs.periodic_runs(with_planted_runs(table(spark, folder, "documents")))
    best = F.array_max(F.transform("runs", lambda x: F.struct(x["length"].alias("length"), (-x["start"]).alias("back"), (-x["period"]).alias("less"))))
    lines = F.transform("runs", lambda x: F.concat(F.concat_ws(",", x["start"], x["length"], x["period"]), F.lit("\n")))
    rows = rows.withColumn("best", best)
    return rows.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("best.back")).alias("start"), F.col("best.length").alias("length"), (-F.col("best.less")).alias("period"),
        F.floor(1000 * F.col("best.length") / -F.col("best.less")).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
