"""Exact duplicates by a tree merge of sorted digest runs.

Every row is reduced to a digest record. The records are dealt out to
``FAN ** rounds`` partitions; each sorts its records into one run and keeps one
record per digest. Then the partitions exchange runs in rounds, as in a binomial
tree with ``FAN`` children: in round r each partition cuts its run by the r-th
digit of the digest and sends the pieces to the partitions that differ from it in
digit r alone, and each receiver merges the ``FAN`` sorted runs that it gets. After
the last round every digest is in one partition. All partitions work in every
round, none holds more than its share, and copies meet early: a group of any
size is at most one record per partition after the first sort.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import id_or_last, id_or_null, salted_lookup, stored

#: Runs merged at once.
FAN = 8
#: Records per partition that the number of rounds is chosen for.
RUN_RECORDS = 4096
#: One record of a run: digest and normalised length (together the text's identity),
#: then what orders the rows of a group, then how many rows it stands for.
RECORD = np.dtype([("digest", "S32"), ("size", ">u4"), ("chars", "<i8"), ("id", "<i8"), ("row", "<i8"), ("rows", "<i8")])
RUNS = "at long, run binary"


def squeezed(text: Column) -> Column:
    """The text without ASCII white space; '' for null."""
    return F.translate(F.coalesce(text, F.lit("")), " \t\n\x0b\x0c\r", "")


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``_row``, ``_id``, ``_chars``, ``_size`` and ``_sha`` (lower-case hex) of every row."""
    plain = squeezed(F.col(text_col))
    return docs.select(
        F.monotonically_increasing_id().alias("_row"),
        id_or_last(id_col).alias("_id"),
        F.coalesce(F.length(text_col), F.lit(0)).cast("long").alias("_chars"),
        F.length(plain).cast("long").alias("_size"),
        F.sha2(plain, 256).alias("_sha"),
    )


def merged(runs: np.ndarray) -> np.ndarray:
    """Sorted runs laid end to end, merged to one record per text.

    The stable sort finds the sorted runs and merges them. Texts are equal if
    all 256 bits of the digest and the normalised length are; of a group
    the record with the most characters, then the smallest id and row, stays.
    """
    runs = runs[np.argsort(text_keys(runs), kind="stable")]
    keys = text_keys(runs)
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(runs) else np.empty(0, np.int64)
    if len(starts) == len(runs):
        return runs
    group = np.cumsum(np.bincount(starts, minlength=len(runs))) - 1
    best = np.lexsort((runs["row"], runs["id"], -runs["chars"], group))[starts]
    rows = np.add.reduceat(runs["rows"], starts)
    out = runs[best]
    out["rows"] = rows
    return out


def text_keys(runs: np.ndarray) -> np.ndarray:
    """Digest and length as one 36-byte key with a closing byte, as numpy cuts final zero bytes."""
    keys = np.ones((len(runs), 37), np.uint8)
    keys[:, :36] = runs.view(np.uint8).reshape(len(runs), RECORD.itemsize)[:, :36]
    return keys.view("S37").ravel()


def cut(at: int, records: np.ndarray, place: int) -> pa.Table:
    """A partition's run in pieces by digit ``place`` of the digest, addressed to the partitions that take them."""
    digits = run_digits(records, place)
    weight = FAN**place
    home = at - at // weight % FAN * weight
    pieces = [(home + d * weight, records[digits == d]) for d in range(FAN)]
    return packed([p for p in pieces if len(p[1])])


def first_runs(key: tuple, group: pa.Table) -> pa.Table:
    """The records of one partition as a sorted run, cut for the first round."""
    records = np.zeros(group.num_rows, RECORD)
    sha = "".join(group["_sha"].to_pylist())
    records["digest"] = np.frombuffer(bytes.fromhex(sha), "S32")
    for name, column in (("size", "_size"), ("chars", "_chars"), ("id", "_id"), ("row", "_row")):
        records[name] = group[column].to_numpy()
    records["rows"] = 1
    return cut(key[0].as_py(), merged(records), 0)


def packed(runs: list[tuple[int, np.ndarray]]) -> pa.Table:
    places = pa.array([at for at, _ in runs], pa.int64())
    return pa.table([places, pa.array([run.tobytes() for _, run in runs], pa.binary())], ["at", "run"])


def unpacked(column: pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), RECORD)


def run_digits(run: np.ndarray, place: int) -> np.ndarray:
    """The ``place``-th digit to base ``FAN`` of the first 60 bits of each digest."""
    head = run.view(np.uint8).reshape(len(run), RECORD.itemsize)[:, :8].copy().view(">u8").ravel()
    return (head.astype(np.uint64) >> np.uint64(4)).astype(np.int64) // FAN**place % FAN


def exchange(runs: DataFrame, next_place: int) -> DataFrame:
    """One round: each partition merges the runs that it was sent and cuts the result for the next round."""

    def merge(key: tuple, group: pa.Table) -> pa.Table:
        return cut(key[0].as_py(), merged(unpacked(group["run"])), next_place)

    return runs.groupBy("at").applyInArrow(merge, RUNS)


TEXTS = "_sha string, _size long, keep_chars long, keep long, keep_row long, group_size long"


def last_round(runs: DataFrame) -> DataFrame:
    """Merges the last pieces; one row per text: ``_sha``, ``_size`` and the record that stays."""

    def merge(key: tuple, group: pa.Table) -> pa.Table:
        records = merged(unpacked(group["run"]))
        raw = records.tobytes()
        columns = [pa.array([raw[i : i + 32].hex() for i in range(0, len(raw), RECORD.itemsize)])]
        columns += [pa.array(records[n].astype(np.int64)) for n in ("size", "chars", "id", "row", "rows")]
        return pa.table(columns, ["_sha", "_size", "keep_chars", "keep", "keep_row", "group_size"])

    return runs.groupBy("at").applyInArrow(merge, TEXTS)


def kept_texts(rows: DataFrame, rounds: int) -> DataFrame:
    """One row per text of stored digest records that have their partition in ``_at``."""
    runs = rows.groupBy("_at").applyInArrow(first_runs, RUNS)
    for place in range(1, rounds):
        runs = exchange(runs, place)
    return last_round(runs)


def rounds_for(count: int) -> int:
    """Rounds after which a partition holds about ``RUN_RECORDS`` records."""
    rounds = 1
    while RUN_RECORDS * FAN**rounds < count:
        rounds += 1
    return rounds


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``, ``n_chars``.

    Texts are equal that are identical without white space; null counts as empty, so
    empty texts and texts of white space are one group. Of a group the row with the
    most code points in the original text stays, then the smallest id (a null id
    is the largest). Rows that tie in both are one document repeated: exactly one of
    them has ``kept``, and all name the same ``keep_id``. Other columns are left out.
    An empty table gives an empty result. The records, 100 bytes a row, are
    written to the shared folder; the texts are read once and never shuffled.
    """
    found = stored(digests(docs, id_col, text_col), "digests")
    rounds = rounds_for(found.count())
    rows = found.withColumn("_at", F.pmod(F.xxhash64("_row"), F.lit(FAN**rounds)))
    texts = kept_texts(rows, rounds).drop("_size", "keep_chars")
    return salted_lookup(rows, texts, "_sha", "_at").select(
        id_or_null(F.col("_id")).alias(id_col),
        id_or_null(F.col("keep")).alias("keep_id"),
        "group_size",
        (F.col("_row") == F.col("keep_row")).alias("kept"),
        F.col("_sha").alias("text_sha256"),
        F.col("_chars").alias("n_chars"),
    )


def without_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns; one of each group."""
    kept = exact_duplicates(docs, id_col, text_col).filter("kept").select(
        F.coalesce(F.col(id_col), F.lit(-(1 << 63))).alias("_id"), F.col("text_sha256").alias("_sha"), F.col("n_chars").alias("_n")
    )
    keyed = docs.select(
        F.struct("*").alias("_doc"),
        F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63))).alias("_id"),
        F.sha2(squeezed(F.col(text_col)), 256).alias("_sha"),
        F.coalesce(F.length(text_col), F.lit(0)).cast("long").alias("_n"),
    )
    keys = ["_id", "_sha", "_n"]
    return keyed.join(kept, keys, "left_semi").dropDuplicates(keys).select("_doc.*")
