"""Processed tables, read in order of preference; an absent table is ``None``.

A table that is written anew keeps its old rows until the new ones are complete. The files of one write share
a mark in their names; the newest manifest, an empty file whose name carries a number and a mark, says which files
count. Making that file is the single step that changes the table, so a writer that is lost before leaves it as it
was. The old files go afterwards, so programs that read the folder without its manifest see the same rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

MANIFEST = "_manifest-"
#: The mark in the names of Spark's part files, one for each write.
MARK = re.compile("^part-[0-9]+-([0-9a-f-]{36})")


def children(spark: SparkSession, path: str) -> dict[str, object]:
    """Names and Hadoop paths of what lies in a folder; nothing for an absent one."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    system = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not system.exists(folder) or not system.getFileStatus(folder).isDirectory():
        return {}
    return {status.getPath().getName(): status.getPath() for status in system.listStatus(folder)}


def remove(spark: SparkSession, paths: Iterable[object]) -> None:
    """Deletes what the Hadoop paths name."""
    for path in paths:
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def marks(names: Iterable[str]) -> set[str]:
    return {found[1] for name in names if (found := MARK.match(name))}


def newest(names: Iterable[str]) -> str | None:
    """The manifest that counts: the highest number, of equal numbers the highest mark, so all readers agree."""
    return max((name for name in names if name.startswith(MANIFEST)), default=None)


def commit(spark: SparkSession, path: str, number: int, mark: str) -> None:
    manifest = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{MANIFEST}{number:012}-{mark}")
    manifest.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(manifest, False).close()


def write_version(df: DataFrame, path: str) -> None:
    """The rows as the table's only ones; all others count until these are complete, and go then."""
    spark = df.sparkSession
    before = children(spark, path)
    last, old = newest(before), marks(before)
    if last is None and len(old) == 1:  # written without a manifest
        commit(spark, path, 0, *old)
    df.write.mode("append").parquet(path)
    (new,) = marks(children(spark, path).keys() - before.keys())
    commit(spark, path, int(last.split("-")[1]) + 1 if last else 1, new)
    done = children(spark, path)
    remove(spark, [at for name, at in done.items() if name not in ("_SUCCESS", newest(done)) and new not in name])


def read_table(spark: SparkSession, path: str) -> DataFrame | None:
    """Parquet table at a path, the files of its newest manifest if it has one, or a catalog table by name."""
    if "/" not in path:
        return spark.table(path) if spark.catalog.tableExists(path) else None
    try:
        last = newest(children(spark, path))
        return (spark.read.option("pathGlobFilter", f"*{last.split('-', 2)[2]}*") if last else spark.read).parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def first_table(spark: SparkSession, paths: Sequence[str]) -> DataFrame | None:
    """First existing table of a preference list, for example scored before cleaned."""
    for path in paths:
        found = read_table(spark, path)
        if found is not None:
            return found
    return None
