"""Counts, shares, tables and trends behind the reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import fixed_values as V
from ..functions.ids import lenient_time
from ..functions.scoring import is_negative_label, is_positive_label


def percent(part: Column, total: Column, digits: int = 1) -> Column:
    """Half-even rounded percentage, 0 for an empty total."""
    return F.when(total > 0, F.bround(part / total * 100, digits)).otherwise(F.lit(0.0))


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """``(column, count)`` of non-null values, largest first, ties by value."""
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy(F.desc("count"), column)
    )


def value_shares(df: DataFrame, column: str) -> DataFrame:
    """``(column, count, share)``; the share is of all rows, nulls included.

    The total is a scalar subquery over the same counts, so no task sees more
    than its part of the values.
    """
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("count"))
    total = counts.agg(F.sum("count")).scalar()
    shares = counts.withColumn("share", F.col("count") / total)
    return shares.where(F.col(column).isNotNull())


def group_shares(df: DataFrame, group: str, column: str, top: int = 5) -> DataFrame:
    """Share of each value inside its group, the ``top`` largest per group."""
    counts = (
        df.where(F.col(column).isNotNull())
        .groupBy(group, column)
        .agg(F.count(F.lit(1)).alias("count"))
    )
    whole = Window.partitionBy(group)
    ranked = Window.partitionBy(group).orderBy(F.desc("count"), column)
    shares = counts.withColumn("share", F.col("count") / F.sum("count").over(whole))
    return shares.withColumn("_n", F.row_number().over(ranked)).where(F.col("_n") <= top).drop("_n")


def contingency(df: DataFrame, rows: str, columns: str, values: Sequence[str]) -> DataFrame:
    """Counts of ``rows`` by the listed values of ``columns``, 0 where none."""
    both = df.where(F.col(rows).isNotNull() & F.col(columns).isNotNull())
    return both.groupBy(rows).pivot(columns, list(values)).count().na.fill(0).orderBy(rows)


def label_buckets(label: Column) -> list[Column]:
    """Total, positive, negative and other labelled rows; null labels only in the total."""
    positive, negative = is_positive_label(label), is_negative_label(label)
    other = label.isNotNull() & ~positive & ~negative

    def hits(x: Column) -> Column:
        return F.count_if(F.coalesce(x, F.lit(False)))

    return [
        F.count(F.lit(1)).alias("total"),
        hits(positive).alias("positive"),
        hits(negative).alias("negative"),
        hits(other).alias("neutral"),
    ]


def positive_ratio(df: DataFrame, group: str, label: str) -> DataFrame:
    """Positive share of the labelled rows per group."""
    labelled = df.where(F.col(group).isNotNull() & F.col(label).isNotNull())
    positive = F.count_if(is_positive_label(F.col(label)))
    return labelled.groupBy(group).agg(
        positive.alias("positive"),
        F.count(F.lit(1)).alias("total"),
        (positive / F.count(F.lit(1))).alias("positive_ratio"),
    )


def best_and_worst(ratios: DataFrame, group: str, ratio: str = "positive_ratio") -> DataFrame:
    """One row: groups with the highest and the lowest ratio, ties by the smaller name."""
    high = F.min(F.struct((-F.col(ratio)).alias("r"), F.col(group).alias("g")))
    low = F.min(F.struct(F.col(ratio).alias("r"), F.col(group).alias("g")))
    return ratios.agg(high["g"].alias("best"), low["g"].alias("worst"))


def top_value(df: DataFrame, column: str) -> DataFrame:
    """Most frequent value, its count and its percentage of all rows."""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("count"))
    named = F.col(column).isNotNull()
    best = F.min(F.when(named, F.struct((-F.col("count")).alias("c"), F.col(column).alias("v"))))
    picked = counts.agg(best.alias("_best"), F.sum("count").alias("total"))
    return picked.where(F.col("_best").isNotNull()).select(
        F.col("_best.v").alias("value"),
        (-F.col("_best.c")).alias("count"),
        percent(-F.col("_best.c"), F.col("total")).alias("share"),
    )


def daily_mean(df: DataFrame, time: str, score: str) -> DataFrame:
    """Mean score per day; rows without a readable time or a score are left out."""
    kind = df.schema[time].dataType.typeName()
    moment = lenient_time(F.col(time)) if kind == "string" else F.col(time)
    timed = df.select(F.to_date(moment).alias("date"), F.col(score).alias("_score")).dropna()
    return timed.groupBy("date").agg(F.avg("_score").alias("avg_score"), F.count(F.lit(1)).alias("n"))


def halves_of(days: Column) -> dict[str, Column]:
    """Number of days and means of the first and last half of a date-sorted series.

    The middle day of an odd number is in neither half.
    """
    count = F.size(days)
    half = F.floor(count / 2).cast("int")

    def mean(part: Column) -> Column:
        total = F.aggregate(part, F.lit(0.0), lambda acc, d: acc + d["avg_score"])
        return F.when(half > 0, total / half)

    return {
        "days": count.cast("long"),
        "first_half": mean(F.slice(days, F.lit(1), half)),
        "second_half": mean(F.slice(days, count - half + 1, half)),
    }


def half_means(daily: DataFrame) -> DataFrame:
    """One row: number of days, mean of the first and of the last half of the days.

    The collected series has at most one entry per calendar day.
    """
    entry = F.struct("date", "avg_score")
    series = daily.agg(F.sort_array(F.collect_list(entry)).alias("_days"))
    return series.select(*[c.alias(name) for name, c in halves_of(F.col("_days")).items()])


def first_seen_values(df: DataFrame, column: str, order: str, n: int = 3) -> DataFrame:
    """The ``n`` values that appear first, in order of appearance."""
    seen = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.min(order).alias("_at"))
    return seen.orderBy("_at", column).limit(n).select(column, F.col("_at").alias("first_seen"))


def summary_statistics(df: DataFrame, score: str) -> DataFrame:
    """One row of score statistics."""
    s = F.col(score)
    return df.agg(
        F.count(s).alias("n"),
        F.avg(s).alias("mean"),
        F.stddev_samp(s).alias("std"),
        F.min(s).alias("min"),
        F.max(s).alias("max"),
    )


LABELS = (V.LABEL_POSITIVE, V.LABEL_NEUTRAL, V.LABEL_NEGATIVE)
