"""Importance resampling toward a target distribution, with bit-sliced sums.

Words and runs of words are hashed into buckets. How much more often the target
holds a bucket than the documents do, as a scaled logarithm, is the bucket's gain, and a
document's weight is the sum of the gains of its features. Its counts are cut into bit
planes, one bit per bucket; the gains, split by sign, into bit planes too. The bits
that a plane of counts has in common with one of gains are counted, and the counts, times
the powers of two that the planes stand for, sum to the exact weight.

Weights plus Gumbel noise from a digest of the id are sorted by range, and the highest are drawn:
a sample without replacement in proportion to the exponential of the weights.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import id_or_last, id_or_null, stored, with_place

BUCKETS = 10_000
#: Longest run of words that is a feature.
ORDER = 1
#: Gains and noise are whole thousandths.
SCALE = 1000
#: Share of the eligible documents that is drawn, in percent, and the words that make a document eligible.
PERCENT = 10
LEAST_WORDS = 20
SEED = 2024
#: Documents, and features, that are worked on at once.
BLOCK_DOCS = 64
BLOCK_FEATURES = 1 << 20


def letters() -> bytes:
    """What a byte counts as: A-Z in lower case, 0-9, a-z and bytes beyond ASCII themselves, all else a blank."""
    table = bytearray(b" " * 128 + bytes(range(128, 256)))
    for first, last, shift in ((0x30, 0x39, 0), (0x61, 0x7A, 0), (0x41, 0x5A, 0x20)):
        for byte in range(first, last + 1):
            table[byte] = byte + shift
    return bytes(table)


LETTERS = letters()


def buckets_of(text: str | None, order: int, buckets: int) -> tuple[int, Iterator[np.ndarray]]:
    """The number of words, and the buckets of all features, some at a time."""
    words = (text or "").encode().translate(LETTERS).split()

    def blocks() -> Iterator[np.ndarray]:
        for size in range(1, min(order, len(words)) + 1):
            for at in range(0, len(words) - size + 1, BLOCK_FEATURES):
                end = min(at + BLOCK_FEATURES, len(words) - size + 1)
                runs = words[at:end] if size == 1 else (b" ".join(words[i : i + size]) for i in range(at, end))
                yield np.fromiter(map(crc32, runs), np.int64, end - at) % buckets

    return len(words), blocks()


def bucket_counts(docs: DataFrame, text_col: str, order: int, buckets: int) -> DataFrame:
    """``bucket`` and ``n`` over all rows; a task adds up its rows before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        pending, size = [np.empty(0, np.int64)], 0
        for batch in batches:
            for text in batch.column(0):
                for found in buckets_of(text.as_py(), order, buckets)[1]:
                    pending.append(found)
                    size += len(found)
                    if size >= BLOCK_FEATURES:
                        total += np.bincount(np.concatenate(pending), minlength=buckets)
                        pending, size = [], 0
        if pending:
            total += np.bincount(np.concatenate(pending), minlength=buckets)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], ["bucket", "n"])

    rows = docs.select(F.col(text_col).alias("_text")).mapInArrow(run, "bucket long, n long")
    return rows.groupBy("bucket").agg(F.sum("n").alias("n"))


def dense(counts: DataFrame, buckets: int) -> list[int]:
    """The counts as a list; one number per bucket, so its size is a parameter."""
    held = [0] * buckets
    for row in counts.collect():
        held[row["bucket"]] = row["n"]
    return held


def gains(own: list[int], target: list[int]) -> np.ndarray:
    """Scaled logarithm of each bucket's smoothed share of the target over that of the documents, rounded down."""
    size, all_own, all_target = len(own), sum(own), sum(target)
    ratio = lambda s, t: float(t + 1) * float(all_own + size) / (float(s + 1) * float(all_target + size))
    return np.array([math.floor(SCALE * math.log(ratio(s, t))) for s, t in zip(own, target, strict=True)], np.int64)


def planes(numbers: np.ndarray) -> np.ndarray:
    """Bit planes of rows of numbers from 0 up: plane, row, 64 buckets a word."""
    words = -(-numbers.shape[1] // 64)
    levels = int(numbers.max(initial=0)).bit_length()
    out = np.zeros((levels, len(numbers), words * 8), np.uint8)
    for level in range(levels):
        bits = np.packbits((numbers >> level & 1).astype(bool), axis=1, bitorder="little")
        out[level, :, : bits.shape[1]] = bits
    return out.view(np.uint64)


@dataclass(frozen=True)
class SlicedGains:
    """Bit planes of the gains above and below zero."""

    above: np.ndarray
    below: np.ndarray

    @staticmethod
    def of(values: np.ndarray) -> SlicedGains:
        return SlicedGains(planes(np.maximum(values, 0)[None])[:, 0], planes(np.maximum(-values, 0)[None])[:, 0])

    def sums(self, counts: np.ndarray) -> np.ndarray:
        """For each row of bucket counts the exact sum of count times gain."""
        total = np.zeros(len(counts), np.int64)
        for level, plane in enumerate(planes(counts)):
            rows = np.flatnonzero(plane.any(axis=1))
            held = plane[rows]
            for sign, sliced in ((1, self.above), (-1, self.below)):
                for power, gain in enumerate(sliced):
                    common = np.bitwise_count(held & gain).sum(axis=1, dtype=np.int64)
                    total[rows] += sign * (common << (level + power))
        return total


def weighed(docs: DataFrame, sliced: SlicedGains, id_col: str, text_col: str, order: int, buckets: int) -> DataFrame:
    """``_id``, ``n_words``, ``n_features`` and ``weight`` of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_DOCS):
                part = batch.slice(at, BLOCK_DOCS)
                words = np.zeros(part.num_rows, np.int64)
                counts = np.zeros((part.num_rows, buckets), np.int32)
                for row, text in enumerate(part.column(1)):
                    words[row], blocks = buckets_of(text.as_py(), order, buckets)
                    for found in blocks:
                        counts[row] += np.bincount(found, minlength=buckets).astype(np.int32)
                numbers = [pa.array(words), pa.array(counts.sum(axis=1, dtype=np.int64)), pa.array(sliced.sums(counts))]
                yield pa.RecordBatch.from_arrays([part.column(0), *numbers], ["_id", "n_words", "n_features", "weight"])

    rows = docs.select(id_or_last(id_col).alias("_id"), F.col(text_col).alias("_text"))
    return rows.mapInArrow(run, "_id long, n_words long, n_features long, weight long")


def gumbel(id_text: Column, seed: int) -> Column:
    """Noise of an id, whole thousandths: a double logarithm of the first 32 bits of a digest."""
    digest = F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), id_text).cast("binary"), 256), 1, 8)
    share = (F.conv(digest, 16, 10).cast("double") + 0.5) / float(1 << 32)
    return F.floor(-SCALE * F.log(-F.log(share))).cast("long")


def resampled(
    docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_col: str = "text",
    order: int = ORDER, buckets: int = BUCKETS, percent: int = PERCENT, least_words: int = LEAST_WORDS, seed: int = SEED,
) -> DataFrame:
    """One row per row of ``docs``: id, ``n_words``, ``n_features``, ``weight``, ``score``, ``rank``.

    Of the rows with ``least_words`` words or more, ``percent`` of a hundred are drawn, rounded down: those
    of highest score, ties to the smaller id, ranked from 1; the others have no rank. Words are
    runs of 0-9, a-z and everything beyond ASCII, A-Z lower-cased. Null and empty texts have
    no features and weight 0. An empty target weighs every bucket alike before smoothing. A null id has the noise
    of '' and comes last in ties. Rows that share an id are drawn each; rows equal in id and score rank
    in order of their sizes, and beyond that are interchangeable. Other columns are left out. An
    empty table gives none. All texts count towards the gains.
    """
    own, wanted = (dense(bucket_counts(*table, order, buckets), buckets) for table in ((docs, text_col), (target, target_col)))
    rows = weighed(docs, SlicedGains.of(gains(own, wanted)), id_col, text_col, order, buckets)
    name = F.coalesce(id_or_null(F.col("_id")).cast("string"), F.lit(""))
    rows = stored(rows.withColumn("score", F.col("weight") + gumbel(name, seed)), "weights")
    able = F.col("n_words") >= least_words
    number = rows.filter(able).count() * percent // 100
    # Row numbers come from the sorted files, so no task sees more than its range.
    ordered = stored(rows.filter(able).orderBy(F.col("score").desc(), "_id", "n_features", "n_words"), "scores")
    ranked = with_place(ordered, "_place").withColumn("rank", F.when(F.col("_place") < number, F.col("_place") + 1)).drop("_place")
    both = ranked.unionByName(rows.filter(~able).withColumn("rank", F.lit(None).cast("long")))
    return both.select(id_or_null(F.col("_id")).alias(id_col), "n_words", "n_features", "weight", "score", "rank")


def drawn(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how: int) -> DataFrame:
    """The rows of ``docs`` that are drawn, with all their columns; rows that share an id go together."""
    chosen = resampled(docs, target, id_col, text_col, **how).filter("rank IS NOT NULL").select(id_or_last(id_col).alias("_key")).distinct()
    rows = docs.select(F.struct("*").alias("_doc"), id_or_last(id_col).alias("_key"))
    return rows.join(chosen, "_key", "left_semi").select("_doc.*")
