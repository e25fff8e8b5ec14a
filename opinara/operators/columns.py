"""Columns of landed tables: aliases, required columns, first available column."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed_values as V
from ..functions.ids import lenient_time, platform_name


def rename_aliases(df: DataFrame, aliases: Mapping[str, Iterable[str]] = V.COLUMN_ALIASES) -> DataFrame:
    """Rename the first known alias of each canonical column.

    A canonical column that exists already wins and its aliases stay as they are.
    """
    present = set(df.columns)
    chosen = {}
    for target, candidates in aliases.items():
        if target not in present:
            found = next((c for c in candidates if c in present), None)
            if found:
                chosen[found] = target
    return df.withColumnsRenamed(chosen) if chosen else df


def require_columns(df: DataFrame, names: Iterable[str] = V.REQUIRED_COLUMNS) -> DataFrame:
    """Add absent columns as empty text."""
    missing = {c: F.lit("") for c in names if c not in df.columns}
    return df.withColumns(missing) if missing else df


def default_language(df: DataFrame, value: str = "auto") -> DataFrame:
    return df if "language" in df.columns else df.withColumn("language", F.lit(value))


def standardize(df: DataFrame, platform: Column) -> DataFrame:
    """One landed table in canonical columns, its platform named by ``platform``."""
    out = default_language(require_columns(rename_aliases(df)))
    return out.withColumn("platform", platform_name(platform))


def first_available(df: DataFrame, names: Iterable[str]) -> str | None:
    """First of the names that is a column of the table."""
    return next((n for n in names if n in df.columns), None)


SENTIMENT_COLUMNS = ("sentiment_label", "sentiment")
TOPIC_COLUMNS = ("topic_label", "rule_topic", "cluster")


def to_comment_columns(df: DataFrame, columns: Iterable[str] = V.COMMENT_COLUMNS) -> DataFrame:
    """Fixed column list in order; absent columns are null."""
    return df.select(
        *[F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in columns]
    )


def computed_once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Adds a costly column behind a generator.

    A filter on a plain computed column is pushed below it with a copy of the
    expression, which would then run twice. A filter on generated output stays
    above, and every later use reads the one result.
    """
    others = [c for c in df.columns if c != name]
    return df.select(*others, F.explode(F.array(value)).alias(name))


def exploded(df: DataFrame, keep: Iterable[str], value: Column, *names: str) -> DataFrame:
    """Rows of a computed array next to the kept columns: its entries under one
    name, or positions and entries under two.

    ``explode`` of an expression makes the optimizer test the size of the array
    first, which computes it twice; here it is computed once.
    """
    held = computed_once(df, "_array", value)
    expand = F.explode if len(names) == 1 else F.posexplode
    return held.select(*keep, expand("_array").alias(*names))


def handle_missing(
    df: DataFrame, required: Iterable[str] = (), defaults: Mapping[str, object] | None = None
) -> DataFrame:
    """Rows without a required value dropped, other gaps filled; blank text counts as missing."""
    texts = {f.name for f in df.schema.fields if f.dataType.typeName() == "string"}
    named = {*required, *(defaults or {})}
    blank = {c: F.when(F.trim(c) != "", F.col(c)) for c in named if c in texts}
    out = (df.withColumns(blank) if blank else df).na.drop(subset=list(required) or None, how="any" if required else "all")
    return out.na.fill(dict(defaults)) if defaults else out


def with_date(df: DataFrame, time: str, name: str = "date") -> DataFrame:
    """Adds the calendar date of a time text, null where it cannot be read."""
    return df.withColumn(name, F.to_date(lenient_time(F.col(time))))


def split_rows(df: DataFrame, key: str, share: float, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Training and test rows by a digest of the key: the same rows in every run and on any cluster."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string")))
    place = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") / F.lit(float(1 << 32))
    return df.where(place < share), df.where(place >= share)
