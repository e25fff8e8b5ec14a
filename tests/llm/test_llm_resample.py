"""Importance resampling against plain sums, and its edge cases."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from opinara.llm import resample


def features_of(text, order):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", low)
    runs = [" ".join(words[i : i + k]) for k in range(1, order + 1) for i in range(len(words) - k + 1)]
    return len(words), runs


def plain(rows, target, order=1, buckets=10_000, percent=10, least_words=20, seed=2024):
    """Rows of (id, words, features, weight, score, rank), one feature at a time."""
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    docs = [(i, *features_of(t, order)) for i, t in rows]
    s = Counter(bucket(f) for _, _, fs in docs for f in fs)
    t = Counter(bucket(f) for text in target for f in features_of(text, order)[1])
    total_s, total_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (total_s + buckets) / ((s[b] + 1) * (total_t + buckets)))) for b in range(buckets)]
    out = []
    for i, words, fs in docs:
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[bucket(f)] for f in fs)
        out.append([i, words, len(fs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), None])
    able = sorted((r for r in out if r[1] >= least_words), key=lambda r: (-r[4], r[0] is None, r[0] or 0, r[2]))
    for place, row in enumerate(able[: len(able) * percent // 100]):
        row[5] = place + 1
    return sorted(map(tuple, out), key=str)


def found(spark, rows, target, **how):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    wanted = spark.createDataFrame([(t,) for t in target], "text string")
    return sorted(map(tuple, resample.resampled(docs, wanted, **how).collect()), key=str)


VOCABULARY = ["The", "é", "fox", "of", "dogs", "42", "Ωμέγα", "rare", "x_y", "don't"]


def some_docs(number, seed=1):
    rng = np.random.default_rng(seed)
    return [(int(i), " ".join(rng.choice(VOCABULARY, rng.integers(0, 60), p=np.arange(10, 0, -1) / 55))) for i in range(number)]


TARGET = ["rare rare x_y Ωμέγα", "don't 42", None, ""]


def test_against_plain_sums(spark):
    docs = some_docs(300) + [(300, None), (301, ""), (302, "...")]
    assert found(spark, docs, TARGET) == plain(docs, TARGET)


def test_runs_of_words_few_buckets_and_other_shares(spark):
    docs = some_docs(80, 2)
    how = {"order": 3, "buckets": 97, "percent": 33, "least_words": 7, "seed": 5}
    assert found(spark, docs, TARGET, **how) == plain(docs, TARGET, **how)


def test_ties_repeated_and_absent_ids(spark):
    docs = [(None, "a " * 25)] * 3 + [(4, "a " * 25)] * 4 + [(5, "b " * 30), (5, "a b " * 15), (6, "b " * 19)]
    how = {"percent": 60}
    assert found(spark, docs, ["b"], **how) == plain(docs, ["b"], **how)


def test_a_very_long_text(spark):
    docs = [(1, "the fox of 42 dogs " * 60_000), (2, "the " * 20)]
    assert found(spark, docs, TARGET, percent=100, order=2) == plain(docs, TARGET, percent=100, order=2)


def test_sliced_sums_are_exact():
    rng = np.random.default_rng(3)
    for buckets in (1, 63, 64, 65, 1000):
        counts = rng.integers(0, 1 << rng.integers(1, 20, (7, 1)), (7, buckets)).astype(np.int32)
        values = rng.integers(-20_000, 9_000, buckets)
        assert (resample.SlicedGains.of(values).sums(counts) == counts.astype(np.int64) @ values).all()
        assert (resample.SlicedGains.of(np.zeros(buckets, np.int64)).sums(counts) == 0).all()


def test_empty_tables_and_other_columns(spark):
    docs = spark.createDataFrame([(1, "a b " * 20, 3, "w")], "doc_id long, text string, weight int, _id string")
    target = docs.select("text")
    assert resample.resampled(docs.limit(0), target).count() == 0
    (row,) = resample.resampled(docs, target.limit(0), percent=100).collect()
    assert row.asDict().keys() == {"doc_id", "n_words", "n_features", "weight", "score", "rank"} and row["rank"] == 1
    kept = resample.drawn(docs, target, percent=100)
    assert kept.columns == docs.columns and kept.collect() == docs.collect()
    assert resample.drawn(docs.withColumn("doc_id", F.lit(None).cast("long")), target, percent=99).count() == 0
