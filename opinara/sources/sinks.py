"""Written results."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import fixed_values as V
from ..operators.columns import to_comment_columns
from ..operators.rows import only_new
from .tables import children, read_table, remove, write_version


#: Parts of a table that batches are appended to.
KEY_PARTS = 256


def overwrite_table(df: DataFrame, path: str) -> None:
    """Cleaned, scored, topic or keyword table; arrays stay arrays. The old rows count until the new ones are complete."""
    write_version(df, path)


def replace_files(writer: DataFrameWriter, spark: SparkSession, kind: str, path: str) -> None:
    """Adds the new files to a folder of text files, and only then deletes those that it held.

    Such folders are read by other programs, file by file, so they have no versions: a
    writer that is lost leaves the old files, between the two steps both, never none.
    """
    before = children(spark, path)
    getattr(writer.mode("append"), kind)(path)
    remove(spark, [at for name, at in before.items() if name != "_SUCCESS"])


def overwrite_csv(df: DataFrame, path: str) -> None:
    """CSV copy; arrays and structs become JSON text."""
    nested = (T.ArrayType, T.StructType, T.MapType)
    columns = [
        F.to_json(f.name).alias(f.name) if isinstance(f.dataType, nested) else F.col(f.name)
        for f in df.schema.fields
    ]
    replace_files(df.select(*columns).write.option("header", True).option("escape", '"'), df.sparkSession, "csv", path)


def append_new(df: DataFrame, path: str, key: str = "comment_id", parts: int = KEY_PARTS) -> None:
    """Append the rows whose key the table does not hold yet.

    The table is partitioned by a digest of the key (``_part``), so a batch is compared
    with the keys of its own parts alone; their numbers, at most ``parts``, come to the driver.
    """
    rows = df.withColumn("_part", F.pmod(F.crc32(F.col(key).cast("binary")), F.lit(parts)).cast("int"))
    known = read_table(df.sparkSession, path)
    if known is None:
        known = df.select(key).limit(0)
    else:
        touched = [r["_part"] for r in rows.where("_part is not null").select("_part").distinct().collect()]
        known = known.where(F.col("_part").isin(touched))
    only_new(rows, known, key).repartition("_part").write.mode("append").partitionBy("_part").parquet(path)


def write_records(df: DataFrame, path: str, columns: Sequence[str] = V.COMMENT_COLUMNS) -> None:
    """Fixed column list as CSV with every cell quoted."""
    options = {"header": True, "quoteAll": True, "escape": '"'}
    replace_files(to_comment_columns(df, columns).write.options(**options), df.sparkSession, "csv", path)


def write_video_comments(df: DataFrame, path: str) -> None:
    rows = df.select(*V.VIDEO_COMMENT_COLUMNS)
    replace_files(rows.write.option("header", True).option("escape", '"'), df.sparkSession, "csv", path)


def write_findings(findings: DataFrame, path: str, title: str = V.FINDINGS_TITLE) -> None:
    """Title, rule and numbered findings as text lines; a report has at most seven."""
    head = F.array(F.struct(F.lit(0).alias("no"), F.lit(f"{title}\n{'=' * 40}\n").alias("line")))
    body = F.transform(
        F.sort_array(F.collect_list(F.struct("no", "text"))),
        lambda f: F.struct(f["no"].alias("no"), F.concat(f["no"].cast("string"), F.lit(". "), f["text"], F.lit("\n")).alias("line")),
    )
    lines = findings.agg(F.concat(head, body).alias("_l")).select(F.inline("_l"))
    replace_files(lines.coalesce(1).sortWithinPartitions("no").select("line").write, findings.sparkSession, "text", path)
