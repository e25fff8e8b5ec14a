"""Incremental landing: new files are cleaned and appended once per comment."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.rows import first_rows
from ..plans.clean import with_clean_text
from ..sources.sinks import append_new


def comment_stream(spark: SparkSession, folder: str, schema: T.StructType | str) -> DataFrame:
    """Landed Parquet files of a folder as a stream, cleaned row by row."""
    return with_clean_text(spark.readStream.schema(schema).parquet(folder))


def append_stream(
    stream: DataFrame, table: str, checkpoint: str, key: str = "comment_id", order: tuple[str, ...] = ("crawl_time",)
) -> StreamingQuery:
    """Append unseen comments of every batch to a table, then stop when caught up.

    A batch that is replayed after a failure finds its own rows in the table and
    adds nothing. Rows of one key that tie in ``order`` are told apart by a digest of all columns.
    """

    def write(batch: DataFrame, _batch_id: int) -> None:
        append_new(first_rows(batch, [key], [*order, F.xxhash64(*batch.columns)]), table, key)

    return (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def recent_distinct(stream: DataFrame, time: str, delay: str, key: str = "comment_id") -> DataFrame:
    """Each key once within the delay, with state that expires."""
    moment = stream.withColumn(time, F.col(time).cast("timestamp"))
    return moment.withWatermark(time, delay).dropDuplicatesWithinWatermark([key])
