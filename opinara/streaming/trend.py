"""Daily trend of a score stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def daily_trend(stream: DataFrame, time: str, score: str, delay: str = "1 day") -> DataFrame:
    """Mean and count of the score per clock day, late rows accepted for ``delay``.

    Stream windows start at UTC midnight, so clock times are taken as UTC for
    the window and the date is read back the same way in any session zone.
    """
    utc, zone = F.lit("UTC"), F.current_timezone()
    clock = F.col(time).cast("timestamp_ntz")
    at = F.convert_timezone(utc, zone, clock).cast("timestamp")
    kept = stream.select(at.alias("_at"), F.col(score).alias("_score")).dropna().withWatermark("_at", delay)
    start = F.convert_timezone(zone, utc, F.col("_w.start").cast("timestamp_ntz"))
    return (
        kept.groupBy(F.window("_at", "1 day").alias("_w"))
        .agg(F.avg("_score").alias("avg_score"), F.count(F.lit(1)).alias("n"))
        .select(F.to_date(start).alias("date"), "avg_score", "n")
    )


def write_trend(trend: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Finished days appended to a table; the last open days follow with later data."""
    return (
        trend.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def write_open_trend(trend: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """All days seen so far, open ones too: each batch rewrites the small day table."""

    def write(batch: DataFrame, _batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(path)

    return (
        trend.writeStream.outputMode("complete")
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
