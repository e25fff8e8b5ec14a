"""Parts that several operators share: stored tables, running totals, hot-key lookups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import work_path

#: The white space of the text contracts, as a class for regular expressions.
SPACE = "\\x20\\x09-\\x0D"
#: Stands for an absent id where a sort or a join needs a value; comes after every other id.
NO_ID = (1 << 63) - 1


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the cluster's shared folder and read again.

    Cuts the lineage: lost executors cost a read, not a recomputation, and what
    is not reproducible (range bounds from a sample, file names) is fixed.
    """
    path = work_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def with_place(table: DataFrame, out: str) -> DataFrame:
    """Adds the place, from 0, that each row of a stored Parquet table had when it was written.

    Part files are numbered by the partition that they hold, and a row knows its place in its file,
    so splits and the order in which Spark reads them don't matter. One row per file is ranked in one task.
    """
    rows = table.withColumns({"_file": F.col("_metadata.file_path"), "_own": F.col("_metadata.row_index")})
    number = F.regexp_extract("_file", "part-([0-9]+)[^/]*$", 1).try_cast("long")
    earlier = Window.orderBy(number, "_file").rowsBetween(Window.unboundedPreceding, -1)
    files = rows.groupBy("_file").agg(F.count("*").alias("_rows"))
    files = files.select("_file", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_start"))
    return rows.join(F.broadcast(files), "_file").withColumn(out, F.col("_start") + F.col("_own")).drop("_file", "_own", "_start")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def id_or_last(name: str) -> Column:
    """An id as long; an absent one becomes ``NO_ID``."""
    return F.coalesce(F.col(name).cast("long"), F.lit(NO_ID))


def id_or_null(column: Column) -> Column:
    """Undoes ``id_or_last``."""
    return F.when(column != NO_ID, column)


def running_totals(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, out: str) -> DataFrame:
    """Adds to each row the sum of ``value`` over the rows before it within its key.

    Rows are dealt by ranges of (keys, order), so a key of any size spreads over
    many partitions; partition totals give each range its start. Keys and values
    must not be null. Rows that tie in ``order`` are taken in any order, so equal
    rows are interchangeable. ``df`` should be a stored table: it is sampled
    and then read. The column ``_part`` must be free.
    """
    spark = df.sparkSession
    placed = df.repartitionByRange(shuffle_partitions(spark), *keys, *order)
    placed = stored(placed.withColumn("_part", F.spark_partition_id()), "ranges")
    by_part = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = placed.groupBy(*keys, "_part").agg(F.sum(value).alias("_sum"))
    starts = starts.select(*keys, "_part", F.coalesce(F.sum("_sum").over(by_part), F.lit(0)).alias("_start"))
    inside = Window.partitionBy(*keys, "_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    summed = placed.withColumn("_inside", F.coalesce(F.sum(value).over(inside), F.lit(0)))
    return (
        summed.join(starts, [*keys, "_part"])
        .withColumn(out, F.col("_start") + F.col("_inside"))
        .drop("_part", "_start", "_inside")
    )


def salted_lookup(rows: DataFrame, facts: DataFrame, key: str, salt: str) -> DataFrame:
    """``rows`` joined with ``facts`` (one row per key) without a hot partition.

    The facts go first to one row per (key, salt) and from there to the rows, so a
    key that holds a third of all rows spreads over as many tasks as it has salts.
    """
    spots = rows.select(key, salt).distinct()
    return rows.join(spots.join(facts, key), [key, salt])
