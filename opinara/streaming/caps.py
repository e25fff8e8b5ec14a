"""Caps that hold over all micro-batches of a stream: rows per item, and rows of the whole run.

What is kept of a batch is decided from the batch and from how many rows each item has so far. That count is
a table for each batch in the stream's state folder. The chosen rows are written there first, then the counts,
then the rows go to the table by key: a batch that is replayed finds its rows chosen and only appends
what is missing, so a lost driver changes nothing. Counts of items that were not seen for some time expire.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..functions import fixed_values as V
from ..operators.rows import cap_per_group, cap_total, first_rows, only_new
from ..sources.sinks import append_new
from ..sources.tables import children, read_table, remove

ROWS, COUNTS = "rows-", "kept-"
#: Batches whose state stays: the one that is running, and the one before, which it starts from.
KEPT_BATCHES = 2


def _numbers(spark: SparkSession, state: str, prefix: str) -> list[int]:
    """Batches whose table of that kind is complete."""
    names = [name for name in children(spark, state) if name.startswith(prefix)]
    return sorted(int(name[len(prefix):]) for name in names if "_SUCCESS" in children(spark, f"{state}/{name}"))


def _counts_before(spark: SparkSession, state: str, batch: int, item: T.DataType) -> DataFrame:
    """``(item, kept, seen)`` after the last batch before this one; the row without an item has the whole run."""
    before = [n for n in _numbers(spark, state, COUNTS) if n < batch]
    if before:
        return spark.read.parquet(f"{state}/{COUNTS}{max(before)}")
    fields = [T.StructField("item", item), T.StructField("kept", T.LongType()), T.StructField("seen", T.TimestampType())]
    return spark.createDataFrame([], T.StructType(fields))


def chosen_rows(batch: DataFrame, counts: DataFrame, item: str, order: Sequence[str], limit: int, total: int) -> DataFrame:
    """The rows that may still be kept: the first of each item up to its limit, then the first of the run.

    Each task sends at most ``limit`` rows of an item on, so an item that holds a third of a batch is no hot key.
    """
    first = cap_per_group(batch, [item], order, limit)
    known = counts.where("item is not null").select(F.col("item").alias(item), F.col("kept").alias("_kept"))
    left = first.join(known, item, "left").withColumn("_left", F.lit(limit) - F.coalesce("_kept", F.lit(0)))
    rank = F.row_number().over(Window.partitionBy(item).orderBy(*order))
    open_rows = left.withColumn("_rank", rank).where("_rank <= _left").drop("_rank", "_left", "_kept")
    spent = counts.where("item is null").agg(F.coalesce(F.max("kept"), F.lit(0))).first()[0]
    return cap_total(open_rows, list(order), max(total - spent, 0))


def counts_after(counts: DataFrame, rows: DataFrame, item: str, time: str, expiry: str) -> DataFrame:
    """The counts with those of the kept rows added; items last seen longer than ``expiry`` before the newest row go."""
    own = rows.groupBy(F.col(item).alias("item")).agg(F.count(F.lit(1)).alias("kept"), F.max(F.col(time).cast("timestamp")).alias("seen"))
    run = rows.agg(F.lit(None).cast(rows.schema[item].dataType).alias("item"), F.count(F.lit(1)).alias("kept"), F.max(F.col(time).cast("timestamp")).alias("seen"))
    both = counts.unionByName(own.where("item is not null")).unionByName(run)
    added = both.groupBy("item").agg(F.sum("kept").alias("kept"), F.max("seen").alias("seen"))
    newest = added.agg(F.max("seen").alias("_newest"))
    held = added.crossJoin(F.broadcast(newest))
    return held.where(F.col("item").isNull() | F.col("seen").isNull() | (F.col("seen") >= F.col("_newest") - F.expr(f"INTERVAL {expiry}"))).drop("_newest")


def capped_stream(
    stream: DataFrame, table: str, checkpoint: str, item: str, order: Sequence[str], time: str,
    limit: int = V.MAX_COMMENTS_PER_ITEM, total: int = V.MAX_COMMENTS_PER_RUN, key: str = "comment_id", expiry: str = "30 days",
) -> StreamingQuery:
    """Appends unseen comments to a table until their item, or the run, has its number; stops when caught up.

    ``order`` must be total within a batch; batches count in the order of their arrival. Rows without an item, or
    without a key, are not landed.
    """
    state = f"{checkpoint.rstrip('/')}-caps"

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        counts = _counts_before(spark, state, number, batch.schema[item].dataType)
        if number not in _numbers(spark, state, ROWS):
            known = read_table(spark, table)
            fresh = first_rows(batch.where(F.col(item).isNotNull()), [key], list(order))
            fresh = only_new(fresh, fresh.select(key).limit(0) if known is None else known, key)
            chosen_rows(fresh, counts, item, order, limit, total).write.mode("overwrite").parquet(f"{state}/{ROWS}{number}")
        rows = spark.read.schema(batch.schema).parquet(f"{state}/{ROWS}{number}")
        if number not in _numbers(spark, state, COUNTS):
            counts_after(counts, rows, item, time, expiry).write.mode("overwrite").parquet(f"{state}/{COUNTS}{number}")
        append_new(rows, table, key)
        gone = [f"{kind}{n}" for kind in (ROWS, COUNTS) for n in _numbers(spark, state, kind)[:-KEPT_BATCHES]]
        held = children(spark, state)
        remove(spark, [held[name] for name in gone if name in held])

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
