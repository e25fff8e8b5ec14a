"""CSV files of any size whose quoted cells span lines, read by many tasks, in UTF-8 or GBK.

A file is read once, by byte ranges that end at line ends. Whether a line lies inside a
quoted cell depends on all lines before it, so each range is read for both cases: the first line of the
record that a line belongs to, and whether the range ends inside a cell, are noted once for a range that starts
outside a cell and once for one that starts inside. Going over the ranges of a file then tells which case holds,
and only records of several lines are put together. Neither encoding uses the bytes of
a line end, a quote or a comma inside a character, so this needs no decoding; whether a file is valid in
UTF-8 or GBK is noted line by line in the same pass.
"""

from __future__ import annotations

import csv
import re
from collections.abc import Iterator
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.arrays import few_at_a_time
from ..operators.membership import hinted
from ..session import work_path

UTF8, GBK = "UTF-8", "GBK"
OPTIONS = {"multiLine": "true", "quote": '"', "escape": '"'}
#: A quoted cell from its first quote on: the second group is empty where the line ends inside it.
CELL = re.compile(rb'(?:(?<=,)|^)"(?:[^"]|"")*("?)')
REST = re.compile(rb'(?:[^"]|"")*("?)')
LINE = "file string, range long, line long, value binary, first0 long, first1 long, open0 boolean, open1 boolean, blank boolean, utf8 boolean, gbk boolean"


def ends_inside(line: bytes, inside: bool) -> bool:
    """Whether the line ends inside a quoted cell, if it starts inside or outside one."""
    at = 0
    if inside:
        rest = REST.match(line)
        if not rest[1]:
            return True
        at = rest.end()
    last = None
    for last in CELL.finditer(line, at):
        pass
    return last is not None and not last[1]


def is_valid(line: bytes, encoding: str) -> bool:
    try:
        line.decode(encoding)
    except UnicodeDecodeError:
        return False
    return True


def _marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The lines with their number in the range and what they are in both cases; a task reads its ranges in order."""
    here, states, firsts, number = None, [False, True], [-1, -1], 0
    for batch in (part for whole in batches for part in few_at_a_time(whole)):
        rows: list[tuple] = []
        for file, start, value in zip(batch["file"].to_pylist(), batch["range"].to_pylist(), batch["value"].to_pylist(), strict=True):
            if (file, start) != here:
                here, states, firsts, number = (file, start), [False, True], [-1, -1], 0
            if start == 0 and number == 0:
                value = value.removeprefix(b"\xef\xbb\xbf")
            firsts = [first if inside else number for first, inside in zip(firsts, states, strict=True)]
            if b'"' in value:
                states = [ends_inside(value, inside) for inside in states]
            plain = value.isascii()
            utf8 = plain or is_valid(value, "utf-8")
            rows.append((file, start, number, value, *firsts, *states, value in (b"", b"\r"), utf8, plain or is_valid(value, "gbk")))
            number += 1
        columns = list(zip(*rows, strict=True)) if rows else [[] for _ in range(11)]
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), *[pa.bool_()] * 5]
        names = [field.split(" ")[0] for field in LINE.split(", ")]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)


def numbered(sources: dict[str, list[str]]) -> list[tuple[int, str, str]]:
    """Number, source and path of every file, by path."""
    pairs = sorted((path, source) for source, paths in sources.items() for path in paths)
    return [(no, source, path) for no, (path, source) in enumerate(pairs)]


def raw_lines(spark: SparkSession, sources: dict[str, list[str]]) -> DataFrame:
    """Every line of all files with its marks, written to the shared folder by ``source``."""
    listed = numbered(sources)
    lines = spark.read.option("lineSep", "\n").text([path for _, _, path in listed])
    lines = lines.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("range"), F.col("value").cast("binary").alias("value")
    )
    names = spark.createDataFrame([(place(path), source, no) for no, source, path in listed], "_place string, source string, no long")
    marked = lines.mapInArrow(_marked, LINE).withColumn("_place", place_column(F.col("file")))
    out = work_path(spark, "lines")
    marked.join(F.broadcast(names), "_place").drop("_place", "file").write.partitionBy("source").parquet(out)  # names: as long as the listing
    kept = ", ".join(field for field in LINE.split(", ") if not field.startswith("file "))
    return spark.read.schema(f"{kept}, no long, source string").parquet(out)


def place(path: str) -> str:
    """Path without scheme and escapes, equal for all ways Spark shows it."""
    return unquote(path).split(":", 1)[-1].lstrip("/")


def place_column(path: Column) -> Column:
    return F.ltrim(F.regexp_replace(F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B"))), "^[a-zA-Z]+:", ""), F.lit("/"))


def range_starts(lines: DataFrame) -> DataFrame:
    """For each range whether it starts inside a cell, its first line's number in the file and that of the record open there.

    Also ``head``, the file's first line that isn't blank, and ``encoding``, null for files that are valid in neither. A file has one row of ranges, as many
    as its size over that of a range.
    """
    own = lines.groupBy("no", "range").agg(
        F.count(F.lit(1)).alias("lines"), F.max_by(F.struct("open0", "open1"), "line").alias("ends"),
        F.max("first0").alias("last0"), F.max("first1").alias("last1"), F.min(F.when(~F.col("blank"), F.col("line"))).alias("some"), F.min("utf8").alias("utf8"), F.min("gbk").alias("gbk"),
    )
    files = own.groupBy("no").agg(
        F.array_sort(F.collect_list(F.struct("range", "lines", "ends", "last0", "last1", "some"))).alias("ranges"),
        F.when(F.min("utf8"), UTF8).when(F.min("gbk"), GBK).alias("encoding"),
    )

    def follow(state: Column, r: Column) -> Column:
        last = F.when(state["inside"], r["last1"]).otherwise(r["last0"])
        begun = F.struct(r["range"].alias("range"), state["inside"].alias("inside"), state["line"].alias("line"), state["record"].alias("record"), (state["line"] + r["some"]).alias("some"))
        return F.struct(
            F.when(state["inside"], r["ends"]["open1"]).otherwise(r["ends"]["open0"]).alias("inside"),
            (state["line"] + r["lines"]).alias("line"),
            F.when(last >= 0, state["line"] + last).otherwise(state["record"]).alias("record"),
            F.concat(state["done"], F.array(begun)).alias("done"),
        )

    nothing = F.array().cast("array<struct<range: bigint, inside: boolean, line: bigint, record: bigint, some: bigint>>")
    zero = F.struct(F.lit(False).alias("inside"), F.lit(0).cast("long").alias("line"), F.lit(0).cast("long").alias("record"), nothing.alias("done"))
    done = F.aggregate("ranges", zero, follow, lambda state: state["done"])
    files = files.select("no", "encoding", F.explode(F.array(done)).alias("_done"))
    rows = files.select("no", "encoding", F.array_min(F.transform("_done", lambda r: r["some"])).alias("head"), F.explode("_done").alias("_r"))
    return rows.select("no", "encoding", "head", "_r.range", F.col("_r.inside").alias("_inside"), F.col("_r.line").alias("_offset"), F.col("_r.record").alias("_carried"))


def records(lines: DataFrame, starts: DataFrame) -> DataFrame:
    """``(no, head, record, encoding, text)``: the records of all files as raw text; ``record`` is the number of the first line."""
    rows = lines.join(starts, ["no", "range"]).where("encoding is not null")
    chosen = lambda name: F.when(F.col("_inside"), F.col(f"{name}1")).otherwise(F.col(f"{name}0"))
    first = chosen("first")
    rows = rows.select(
        "no", "head", "encoding", (F.col("_offset") + F.col("line")).alias("_at"), F.col("value").cast("string").alias("text"),
        F.when(first >= 0, F.col("_offset") + first).otherwise(F.col("_carried")).alias("record"), chosen("open").alias("_open"),
    )
    alone = (F.col("_at") == F.col("record")) & ~F.col("_open")
    parts = F.transform(F.array_sort(F.collect_list(F.struct("_at", "text"))), lambda x: x["text"])
    several = rows.where(~alone).groupBy("no", "head", "record", "encoding").agg(F.array_join(parts, "\n").alias("text"))
    whole = rows.where(alone).select("no", "head", "record", "encoding", "text").unionByName(several)
    ended = F.when(F.substring("text", -1, 1) == "\r", F.expr("left(text, length(text) - 1)")).otherwise(F.col("text"))
    return whole.withColumn("text", ended).where("text <> ''")


def decoded(rows: DataFrame) -> DataFrame:
    """The records as text; those of GBK files pass through Python's codec."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in few_at_a_time(whole)):
            texts = pa.array([value.decode("gbk") for value in batch["text"].to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([batch["no"], batch["head"], batch["record"], texts], ["no", "head", "record", "text"])

    plain = rows.where(F.col("encoding") == UTF8).select("no", "head", "record", "text")
    other = rows.where(F.col("encoding") == GBK).select("no", "head", "record", F.col("text").cast("binary").alias("text"))
    return plain.unionByName(other.mapInArrow(decode, "no long, head long, record long, text string"))


def header_names(line: str) -> list[str]:
    """Column names of a header record; blank ones are numbered and repeated ones get their number added."""
    cells = next(csv.reader([line], doublequote=True))
    names = [cell if cell else f"_c{i}" for i, cell in enumerate(cells)]
    lower = [name.lower() for name in names]
    return [f"{name}{i}" if lower.count(name.lower()) > 1 else name for i, name in enumerate(names)]


def file_facts(starts: DataFrame) -> dict[int, tuple[str | None, int]]:
    """Encoding and header line of every file that has a line; as long as the listing."""
    return {r["no"]: (r["encoding"], r["head"]) for r in starts.select("no", "encoding", "head").distinct().collect()}


def read_sources(spark: SparkSession, sources: dict[str, list[str]], rows_per_file: int = 1 << 33) -> dict[str, DataFrame]:
    """The rows of each source with all columns as text and ``row_id``, by the name of the file and the place in it.

    The columns are those of the first readable file of the source, the first record of each file is its header.
    Files that are neither UTF-8 nor GBK are left out, and sources without any other file. Blank lines are no
    records; a cell that is never closed takes the rest of its file.
    """
    if not any(sources.values()):
        return {}
    lines = raw_lines(spark, sources)
    starts = hinted(range_starts(lines))
    facts = {no: head for no, (encoding, head) in file_facts(starts).items() if encoding and head is not None}
    out = {}
    for source in sources:
        readable = [no for no, name, _ in numbered(sources) if name == source and no in facts]
        if not readable:
            continue
        own = lines.where(F.col("source") == source)
        head = decoded(records(own.where(F.col("no") == readable[0]), starts)).where(F.col("record") == facts[readable[0]]).first()
        schema = ", ".join("`" + name.replace("`", "``") + "` string" for name in header_names(head["text"]))
        body = decoded(records(own, starts)).where("record > head")
        row_id = F.col("no") * rows_per_file + F.col("record")
        cells = F.from_csv("text", F.lit(schema), OPTIONS)
        out[source] = body.select(F.explode(F.array(cells)).alias("_cells"), row_id.alias("row_id")).select("_cells.*", "row_id")
    return out


def encodings(spark: SparkSession, paths: list[str]) -> dict[str, str]:
    """The encoding of each file; files valid in neither are absent."""
    if not paths:
        return {}
    listed = {"": paths}
    facts = file_facts(range_starts(raw_lines(spark, listed)))
    found = {path: facts.get(no, (UTF8, 0))[0] for no, _, path in numbered(listed)}
    return {path: name for path, name in found.items() if name}
