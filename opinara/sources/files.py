"""Landed files: comment CSV per platform, in UTF-8 or GBK.

A source is ``name.csv`` in the landing folder: one file of any size, or a folder of part
files as Spark writes it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.columns import standardize
from . import csv_ranges


def list_sources(spark: SparkSession, folder: str) -> dict[str, list[str]]:
    """Source names with their CSV files; only the listing is read, no content."""
    reader = spark.read.format("binaryFile").option("pathGlobFilter", "*.csv")
    files = reader.option("recursiveFileLookup", "true").load(folder).select("path")
    root = folder.split(":", 1)[-1].strip("/")
    sources: dict[str, list[str]] = {}
    for path in sorted(r["path"] for r in files.collect()):
        below = path.split(":", 1)[-1].strip("/")[len(root):].strip("/")
        top = below.split("/")[0]
        if top.lower().endswith(".csv"):
            sources.setdefault(top[: -len(".csv")], []).append(path)
    return sources


def file_encodings(spark: SparkSession, paths: list[str]) -> dict[str, str]:
    """UTF-8 unless the file has a line that is not valid UTF-8, else GBK; files valid in neither are absent."""
    return csv_ranges.encodings(spark, paths)


def read_csv(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """UTF-8 files of one header; quoted cells may span lines, all columns are text. One task reads a file."""
    return spark.read.csv(path, header=True, multiLine=True, escape='"', quote='"')


def has_content(df: DataFrame, column: str = "content") -> bool:
    """The source has at least one non-null content; stops at the first."""
    return not df.where(F.col(column).isNotNull()).isEmpty()


def landed_comments(spark: SparkSession, folder: str) -> DataFrame | None:
    """All sources of a folder in canonical columns, or ``None`` without any.

    The platform is the source name. ``row_id`` orders the rows of a platform by the
    name of the file and the place in the file. Files that are neither UTF-8 nor GBK are left out.
    """
    frames = []
    for name, source in csv_ranges.read_sources(spark, list_sources(spark, folder)).items():
        table = standardize(source, F.lit(name))
        if has_content(table):
            frames.append(table)
    if not frames:
        return None
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def known_ids(df: DataFrame | None, spark: SparkSession, column: str = "comment_id") -> DataFrame:
    """Distinct non-blank keys of earlier output, an empty table without any."""
    if df is None:
        return spark.createDataFrame([], f"{column} string")
    return df.select(column).where(F.col(column).isNotNull() & (F.col(column) != "")).distinct()
