"""Word lists as tables, and joins against them.

A list that comes as a table is written once and measured before it is broadcast. Beyond
``BROADCAST_ROWS`` or ``BROADCAST_BYTES`` the same join runs as a shuffle join.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StringType

from ..session import work_path
from .columns import exploded

BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 1 << 26
INLINE_ROWS = 20_000
LISTED_ROWS = 200_000
LISTED_BYTES = 1 << 24


def normalize_words(df: DataFrame, column: str) -> DataFrame:
    """Trimmed, lower-case, non-empty, distinct words."""
    word = F.lower(F.trim(F.col(column)))
    return df.select(word.alias("word")).where(F.col("word") != "").distinct()


def word_frame(spark: SparkSession, words: Iterable[str]) -> DataFrame:
    """Table of a listed lexicon."""
    listed = sorted({w.strip().lower() for w in words if w and w.strip()})
    return spark.createDataFrame([(w,) for w in listed], "word string")


def union_words(*frames: DataFrame) -> DataFrame:
    out = frames[0].select("word")
    for frame in frames[1:]:
        out = out.union(frame.select("word"))
    return out.distinct()


def hinted(df: DataFrame, rows: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES) -> DataFrame:
    """The table, written once and measured there; marked for broadcast only if both bounds allow it."""
    path = work_path(df.sparkSession, "list")
    df.write.parquet(path)
    return broadcast_if_small(df.sparkSession.read.schema(df.schema).parquet(path), rows, size)


def measured(kept: DataFrame) -> tuple[int, int]:
    """Rows and bytes of a stored table; an array or map counts 8 bytes for each of 8 entries."""
    fields = kept.schema.fields
    texts = [F.coalesce(F.octet_length(f.name), F.lit(0)) for f in fields if isinstance(f.dataType, StringType)]
    nested = sum(isinstance(f.dataType, ArrayType | MapType) for f in fields)
    width = sum(texts, F.lit(8 * len(fields) + 56 * nested))
    seen = kept.agg(F.count(F.lit(1)).alias("rows"), F.sum(width).alias("size")).first()
    return seen["rows"], seen["size"] or 0


def broadcast_if_small(kept: DataFrame, rows: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES) -> DataFrame:
    """A stored table, marked for broadcast only if both bounds allow it."""
    return F.broadcast(kept) if fits_broadcast(kept, rows, size) else kept


def fits_broadcast(kept: DataFrame, rows: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES) -> bool:
    """Whether both bounds allow to broadcast a stored table."""
    seen_rows, seen_size = measured(kept)
    return seen_rows <= rows and seen_size <= size


def listed_rows(df: DataFrame, rows: int | None = None, size: int = LISTED_BYTES) -> tuple[DataFrame, list[Row] | None]:
    """The table, written once and measured there, and its rows if both bounds allow it, else ``None``."""
    path = work_path(df.sparkSession, "list")
    df.write.parquet(path)
    kept = df.sparkSession.read.schema(df.schema).parquet(path)
    seen_rows, seen_size = measured(kept)
    few = seen_rows <= (LISTED_ROWS if rows is None else rows) and seen_size <= size
    return kept, kept.collect() if few else None


def inline_words(df: DataFrame, rows: int = INLINE_ROWS) -> list[str] | None:
    """The words of a small lexicon table as a list, ``None`` if it is too long."""
    head = df.select("word").limit(rows + 1).collect()
    return [r[0] for r in head] if len(head) <= rows else None


def known_small(spark: SparkSession, words: Iterable[str], rows: int = BROADCAST_ROWS) -> DataFrame:
    """A listed lexicon as a table; its length is known, so no job measures it."""
    listed = list(words)
    frame = word_frame(spark, listed)
    return F.broadcast(frame) if len(listed) <= rows else frame


def without_words(
    df: DataFrame, column: str, words: Iterable[str] | DataFrame, rows: int = BROADCAST_ROWS
) -> DataFrame:
    """Rows whose word is not listed."""
    if isinstance(words, DataFrame):
        listed = hinted(words, rows)
    else:
        listed = known_small(df.sparkSession, words, rows)
    return df.join(listed.select(F.col("word").alias(column)), column, "left_anti")


def without_listed_tokens(df: DataFrame, key: str, listed: DataFrame, tokens: str = "tokens") -> DataFrame:
    """``tokens`` without listed words, for lists too long to inline; ``key`` must be unique.

    Words are compared by an anti join and put together again in order.
    """
    spoken = df.select(key, F.posexplode(tokens).alias("_at", "word"))
    left = spoken.join(listed.select("word"), "word", "left_anti").groupBy(key).agg(
        F.sort_array(F.collect_list(F.struct("_at", "word"))).alias("_left")
    )
    joined = df.join(left, key, "left")
    words = F.coalesce(F.transform("_left", lambda t: t["word"]), F.array().cast("array<string>"))
    return joined.withColumn(tokens, words).drop("_left")


def with_weight(
    df: DataFrame,
    column: str,
    weights: Mapping[str, float] | DataFrame,
    default: float,
    rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Adds ``weight`` of listed words, ``default`` for all others."""
    if isinstance(weights, DataFrame):
        listed = hinted(weights, rows)
    else:
        entries = sorted({w.strip().lower(): float(x) for w, x in weights.items()}.items())
        frame = df.sparkSession.createDataFrame(entries, "word string, weight double")
        listed = F.broadcast(frame) if len(entries) <= rows else frame
    joined = df.join(listed.select(F.col("word").alias(column), "weight"), column, "left")
    return joined.withColumn("weight", F.coalesce("weight", F.lit(default)))


def mapped_name(df: DataFrame, column: str, names: DataFrame, out: str) -> DataFrame:
    """Left lookup in a ``(name, shown)`` table, the trimmed value where unlisted."""
    key = F.trim(F.col(column))
    listed = hinted(names.select(F.col("name").alias("_name"), F.col("shown").alias("_shown")))
    joined = df.join(listed, key == F.col("_name"), "left")
    return joined.withColumn(out, F.coalesce("_shown", key)).drop("_name", "_shown")


def text_matches_words(
    texts: DataFrame, key: str, words: Column, listed: DataFrame
) -> DataFrame:
    """Keys of rows with a listed word, for lexicons too long to inline.

    ``words`` is the array of candidate words of a row. The semi join runs
    before the distinct, so only hits are shuffled when the list is broadcast.
    """
    spoken = exploded(texts, [key], words, "word")
    return spoken.join(hinted(listed), "word", "left_semi").select(key).distinct()

