"""First rows, caps, new rows and preferred sources.

``row_number() <= n`` lets Spark cut every group on the map side before the
shuffle (window group limit), so a group that holds a third of all rows sends
at most ``n`` rows per input task. Every order must be total, otherwise the
kept rows depend on the run.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ColumnOrName = Column | str


# Above this limit Spark does not cut groups before the shuffle.
EARLY_LIMIT = 999
SALTS = 64


def _first_of_each(
    df: DataFrame, group: Sequence[ColumnOrName], order: Sequence[ColumnOrName], n: int
) -> DataFrame:
    window = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).where(F.col("_rank") <= n).drop("_rank")


def cap_per_group(
    df: DataFrame, group: Sequence[ColumnOrName], order: Sequence[ColumnOrName], n: int
) -> DataFrame:
    """First ``n`` rows of each group in the given order.

    Long limits go in two steps: every group is split over salts and each part
    cut, so the last step sees at most ``n`` rows per salt.
    """
    if n > EARLY_LIMIT:
        salted = df.withColumn("_salt", F.monotonically_increasing_id() % SALTS)
        df = _first_of_each(salted, [*group, "_salt"], order, n).drop("_salt")
    return _first_of_each(df, group, order, n)


def first_rows(
    df: DataFrame, keys: Sequence[ColumnOrName], order: Sequence[ColumnOrName]
) -> DataFrame:
    """First row per key in the given order."""
    return cap_per_group(df, keys, order, 1)


def cap_total(df: DataFrame, order: Sequence[ColumnOrName], n: int) -> DataFrame:
    """First ``n`` rows of the whole table: a distributed top-n, no full sort."""
    return df.orderBy(*order).limit(n)


def only_new(rows: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """Rows whose key is neither blank nor known; the known side carries only keys."""
    keys = known.select(key).where(F.col(key).isNotNull() & (F.col(key) != ""))
    fresh = rows.where(F.col(key).isNotNull() & (F.col(key) != ""))
    return fresh.join(keys, key, "left_anti")


def prefer_source(df: DataFrame, keys: Sequence[str], rank: str, bounded: bool = False) -> DataFrame:
    """Per key only rows of the lowest-ranked source that has any.

    For keys of any size the minimum is pre-aggregated on the map side and
    joined back; the other side has one row per key, so adaptive execution can
    split a hot key. ``df`` is read twice for that. Where an earlier cap bounds
    the rows per key (``bounded``), one window does the same in one pass.
    """
    if bounded:
        least = F.min(rank).over(Window.partitionBy(*keys))
        return df.withColumn("_least", least).where(F.col(rank) == F.col("_least")).drop("_least")
    best = df.groupBy(*keys).agg(F.min(rank).alias(rank))
    return df.join(best, [*keys, rank], "left_semi")
