"""Headline figures and written findings.

All figures come from one pass over the scored table: grouping sets by
platform, by day and in total are combined on the map side, and only their few
result rows go on.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed_values as V
from ..functions.ids import lenient_time
from .aggregates import halves_of, label_buckets, percent, top_value
from .columns import SENTIMENT_COLUMNS, TOPIC_COLUMNS, first_available

TOTAL, BY_PLATFORM, BY_DAY = 3, 1, 2


def headline(df: DataFrame, order: str = "row_id") -> DataFrame:
    """One row from one scan: totals, label shares, mean score and the platforms seen first."""
    label = first_available(df, SENTIMENT_COLUMNS)
    score = F.col("sentiment_score") if "sentiment_score" in df.columns else F.lit(None).cast("double")
    per_platform = df.groupBy("platform").agg(
        *label_buckets(F.col(label) if label else F.lit(None).cast("string")),
        F.sum(score).alias("_sum"),
        F.count(score).alias("_scored"),
        F.min(order).alias("_at"),
    )
    named = F.col("platform").isNotNull()
    total = F.sum("total")
    seen = F.sort_array(F.collect_list(F.when(named, F.struct("_at", "platform"))))  # one entry per platform
    return per_platform.agg(
        total.alias("total"),
        F.count_if(named).alias("platforms"),
        F.sum("positive").alias("positive"),
        F.sum("negative").alias("negative"),
        F.sum("neutral").alias("neutral"),
        percent(F.sum("positive"), total).alias("positive_pct"),
        percent(F.sum("negative"), total).alias("negative_pct"),
        F.bround(F.sum("_sum") / F.sum("_scored"), 3).alias("avg_score"),
        F.concat_ws("、", F.transform(F.slice(seen, 1, 3), lambda p: p["platform"])).alias("first_platforms"),
    )


def _summary(df: DataFrame, label: str | None, time: str | None) -> DataFrame:
    moment = F.lit(None).cast("timestamp_ntz")
    if time:
        kind = df.schema[time].dataType.typeName()
        moment = lenient_time(F.col(time)) if kind == "string" else F.col(time)
    score = F.col("sentiment_score") if "sentiment_score" in df.columns else F.lit(None).cast("double")
    rows = df.select(
        F.col("platform"),
        F.to_date(moment).alias("date"),
        (F.col(label) if label else F.lit(None).cast("string")).alias("label"),
        score.alias("score"),
    )
    groups = [[F.col("platform")], [F.col("date")], []]
    return rows.groupingSets(groups, F.col("platform"), F.col("date")).agg(
        F.grouping_id().cast("int").alias("level"),
        *label_buckets(F.col("label")),
        F.sum("score").alias("sum_score"),
        F.count("score").alias("scored"),
    )


def _fill(template: str, subject: str, **values: Column) -> Column:
    """The message with its places filled; literal text and columns in turn."""
    pieces, rest = [], template.replace("{subject}", subject)
    while "{" in rest:
        before, _, tail = rest.partition("{")
        name, _, rest = tail.partition("}")
        pieces += [F.lit(before), values[name].cast("string")]
    return F.concat(*pieces, F.lit(rest))


def _decimals(value: Column, least: int, most: int) -> Column:
    """Fixed decimals without superfluous zeros at the end."""
    text = F.format_string(f"%.{most}f", value)
    return F.regexp_replace(text, f"0{{1,{most - least}}}$", "") if most > least else text


def mood_phrase(positive: Column, negative: Column, neutral: Column) -> Column:
    return (
        F.when((positive > negative) & (positive > neutral), V.MOOD_POSITIVE)
        .when((negative > positive) & (negative > neutral), V.MOOD_NEGATIVE)
        .otherwise(V.MOOD_NEUTRAL)
    )


def level_phrase(mean: Column) -> Column:
    return F.when(mean > 0.55, V.LEVEL_HIGH).when(mean < 0.45, V.LEVEL_LOW).otherwise(V.LEVEL_MIDDLE)


def trend_phrase(first: Column, second: Column) -> Column:
    return (
        F.when(second > first + 0.03, V.TREND_UP)
        .when(second < first - 0.03, V.TREND_DOWN)
        .otherwise(V.TREND_FLAT)
    )


def figures(df: DataFrame, time: str = "publish_time") -> DataFrame:
    """One row with every figure the findings need, null where a column is absent."""
    label = first_available(df, SENTIMENT_COLUMNS)
    summary = _summary(df, label, time if time in df.columns else None)
    labelled = F.col("positive") + F.col("negative") + F.col("neutral")
    is_platform = (F.col("level") == BY_PLATFORM) & F.col("platform").isNotNull()
    is_total = F.col("level") == TOTAL
    is_day = (F.col("level") == BY_DAY) & F.col("date").isNotNull() & (F.col("scored") > 0)
    ratio = F.when(is_platform & (labelled > 0), F.col("positive") / labelled)
    mean = F.col("sum_score") / F.col("scored")

    def of_total(value: Column) -> Column:
        return F.max(F.when(is_total, value))

    def lowest(order: Column) -> Column:
        return F.min(F.when(order.isNotNull(), F.struct(order.alias("o"), F.col("platform").alias("p"))))

    series = F.collect_list(F.when(is_day, F.struct("date", mean.alias("avg_score"))))
    out = summary.agg(
        *[of_total(F.col(c)).alias(c) for c in ("total", "positive", "negative", "neutral")],
        F.bround(of_total(mean), 4).alias("mean"),
        lowest(-ratio)["p"].alias("best"),
        lowest(ratio)["p"].alias("worst"),
        lowest(F.when(is_platform, -F.col("total"))).alias("_top"),
        F.sort_array(series).alias("_days"),
    )
    for part in ("positive", "negative", "neutral"):
        out = out.withColumn(f"{part}_pct", percent(F.col(part), F.col("total")))
    out = out.withColumns(halves_of(F.col("_days")))
    return out.withColumns(
        {
            "labelled": F.lit(label is not None),
            "top_platform": F.col("_top.p"),
            "top_count": -F.col("_top.o"),
            "top_pct": percent(-F.col("_top.o"), F.col("total")),
        }
    ).drop("_top", "_days")


def generate(
    df: DataFrame,
    topics: DataFrame | None = None,
    time: str = "publish_time",
    subject: str = V.SUBJECT,
    formats: Mapping[str, str] = V.FINDING_FORMATS,
) -> DataFrame:
    """``(no, key, text)``: the findings that the available columns allow, numbered.

    The closing sentence follows only if at least three others exist.
    """
    row = figures(df, time)
    topic_column = first_available(topics, TOPIC_COLUMNS) if topics is not None else None
    if topic_column:
        top = top_value(topics, topic_column).select(F.struct("value", "count", "share"))
        row = row.withColumn("_topic", top.scalar())
    else:
        row = row.withColumn("_topic", F.lit(None).cast("struct<value:string,count:bigint,share:double>"))

    def text(key: str, when: Column, **values: Column) -> Column:
        return F.when(when, F.struct(F.lit(key).alias("key"), _fill(formats[key], subject, **values).alias("text")))

    c = F.col
    entries = [
        text(
            "mood", c("labelled"), total=c("total"),
            positive=_decimals(c("positive_pct"), 1, 1),
            negative=_decimals(c("negative_pct"), 1, 1),
            neutral=_decimals(c("neutral_pct"), 1, 1),
            mood=mood_phrase(c("positive_pct"), c("negative_pct"), c("neutral_pct")),
        ),
        text("platforms", c("best").isNotNull(), best=c("best"), worst=c("worst")),
        text("level", c("mean").isNotNull(), mean=_decimals(c("mean"), 1, 4), level=level_phrase(c("mean"))),
        text("trend", c("days") >= 2, trend=trend_phrase(c("first_half"), c("second_half")), days=c("days")),
        text(
            "top_platform", c("top_platform").isNotNull(), platform=c("top_platform"),
            count=c("top_count"), share=_decimals(c("top_pct"), 1, 1),
        ),
        text(
            "top_topic", c("_topic").isNotNull(), topic=c("_topic.value").cast("string"),
            count=c("_topic.count"), share=_decimals(c("_topic.share"), 1, 1),
        ),
    ]
    closing = F.struct(F.lit("closing").alias("key"), _fill(formats["closing"], subject).alias("text"))
    found = row.select(F.array_compact(F.array(*entries)).alias("_f"))
    whole = found.select(
        F.when(F.size("_f") >= 3, F.concat("_f", F.array(closing))).otherwise(F.col("_f")).alias("_f")
    )
    numbered = whole.select(F.posexplode("_f").alias("no", "finding"))
    return numbered.select((c("no") + 1).alias("no"), c("finding.key").alias("key"), c("finding.text").alias("text"))
