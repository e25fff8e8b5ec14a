"""Token ids packed into rows of fixed length, as binary files.

Documents longer than a row are split into pieces that fill a row each, and a
rest. Pieces go from the longest to the shortest to the row with the least room that still
holds them (best fit, decreasing); a segment tree over the amounts of room finds it
in log(row length) steps. Each task packs the documents that it reads, in groups of bounded
size, so nothing is shuffled; a group is one set of files:

* ``<name>.ids.npy``: the matrix of ids, a packed row each, filled up with the padding id;
* ``<name>.cu.npy``: cumulative lengths of the pieces, counted over the whole matrix laid end to
  end; the padding of a row is a piece of its own;
* ``<name>.resets.npy``: one bit per token, set where positions start at 0 again.

Files get their names when they are complete. The index, written last, has a row for each
document with its file and pieces; what it doesn't name, as files of lost attempts, doesn't count.
"""

from __future__ import annotations

import base64
import io
import uuid
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.fs
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import int_lists
from .common import id_or_last, id_or_null

ROW = 2048
#: Tokens after which a group of documents is packed; a longer document makes a longer group.
GROUP_TOKENS = 1 << 23


class Rooms:
    """Rows by the room that they have left, with a segment tree over the amounts."""

    def __init__(self, most: int) -> None:
        self.leaves = 1 << most.bit_length()
        self.some = [False] * (2 * self.leaves)
        self.rows: list[list[int]] = [[] for _ in range(most + 1)]

    def add(self, room: int, row: int) -> None:
        self.rows[room].append(row)
        at = room + self.leaves
        while at and not self.some[at]:
            self.some[at] = True
            at //= 2

    def take(self, length: int) -> tuple[int, int] | None:
        """Room and number of a row with the least room of at least ``length``; takes it out."""
        some = self.some
        at = length + self.leaves
        if not some[at]:
            # Up until a right neighbour holds a row, then down to its leftmost.
            while at > 1 and (at % 2 or not some[at + 1]):
                at //= 2
            if at <= 1:
                return None
            at += 1
            while at < self.leaves:
                at *= 2
                if not some[at]:
                    at += 1
        room = at - self.leaves
        row = self.rows[room].pop()
        if not self.rows[room]:
            some[at] = False
            at //= 2
            while at and not (some[2 * at] or some[2 * at + 1]):
                some[at] = False
                at //= 2
        return room, row


def best_fit(lengths: np.ndarray, row_length: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Row and start of each piece, and the number of rows."""
    rows, starts = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    rooms, number = Rooms(row_length), 0
    for piece in np.argsort(-lengths, kind="stable").tolist():
        length = int(lengths[piece])
        found = rooms.take(length)
        if found is None:
            found = (row_length, number)
            number += 1
        room, row = found
        rows[piece], starts[piece] = row, row_length - room
        if room > length:
            rooms.add(room - length, row)
    return rows, starts, number


def pieces_of(lengths: np.ndarray, row_length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document, start within the document and length of each piece, in order."""
    number = -(-lengths // row_length)
    document = np.repeat(np.arange(len(lengths)), number)
    start = (np.arange(len(document)) - np.repeat(np.cumsum(number) - number, number)) * row_length
    return document, start, np.minimum(lengths[document] - start, row_length)


class Packed:
    """The pieces of a group of documents in their rows."""

    def __init__(self, documents: list[np.ndarray], row_length: int, padding: int) -> None:
        lengths = np.array([len(x) for x in documents], np.int64)
        self.document, self.start, self.length = pieces_of(lengths, row_length)
        self.row, self.place, number = best_fit(self.length, row_length)
        self.ids = np.full((number, row_length), padding, documents[0].dtype)
        for d, s, n, r, p in zip(*(x.tolist() for x in (self.document, self.start, self.length, self.row, self.place)), strict=True):
            self.ids[r, p : p + n] = documents[d][s : s + n]
        at = np.sort(self.row * row_length + self.place)
        used = np.zeros(number, np.int64)
        np.add.at(used, self.row, self.length)
        padded = np.flatnonzero(used < row_length)
        at = np.union1d(at, padded * row_length + used[padded])
        self.cumulative = np.append(at, number * row_length)
        resets = np.zeros(number * row_length, bool)
        resets[at] = True
        self.resets = np.packbits(resets)


def positions(resets: np.ndarray, rows: int, row_length: int = ROW) -> np.ndarray:
    """The position of each token of a matrix, from the packed resets."""
    at = np.flatnonzero(np.unpackbits(resets, count=rows * row_length))
    lengths = np.diff(np.append(at, rows * row_length))
    return (np.arange(rows * row_length) - np.repeat(at, lengths)).reshape(rows, row_length)


@lru_cache(maxsize=2)
def encoding(path: str, pattern: str) -> tiktoken.Encoding:
    """The tokenizer of a rank file."""
    with open(path, "rb") as file:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
    return tiktoken.Encoding("file", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


INDEX = "file string, id long, n_tokens long, pieces array<struct<row: long, place: long, length: long>>"


def save(store: pyarrow.fs.FileSystem, path: str, array: np.ndarray) -> None:
    """Writes under a temporary name and renames."""
    head = io.BytesIO()
    np.lib.format.write_array_header_1_0(head, np.lib.format.header_data_from_array_1_0(array))
    draft = f"{path}.tmp"
    with store.open_output_stream(draft) as out:
        out.write(head.getvalue())
        out.write(pa.py_buffer(np.ascontiguousarray(array)))
    store.move(draft, path)


def load(store: pyarrow.fs.FileSystem, path: str) -> np.ndarray:
    with store.open_input_stream(path) as source:
        return np.load(io.BytesIO(source.read()), allow_pickle=False)


def write_packed(
    docs: DataFrame, folder: str, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
    row_length: int = ROW, group_tokens: int = GROUP_TOKENS, padding: int = 0,
) -> None:
    """Encodes whole texts with a rank file and writes the packed rows and the index to ``folder``, which must be new.

    Every row of ``docs`` is a document: repeated rows are packed each, null and empty
    texts have no pieces and only a row in the index. Null ids stay null. Other
    columns are left out. Ids take two bytes where the vocabulary allows, else four. An
    empty table gives an empty index.
    """
    store, base = pyarrow.fs.FileSystem.from_uri(folder)
    store.create_dir(base)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, place = pyarrow.fs.FileSystem.from_uri(folder)
        coder = encoding(path, pattern)
        kind = np.uint16 if coder.n_vocab <= 1 << 16 else np.uint32
        part = TaskContext.get().partitionId()
        keys: list[int] = []
        documents: list[np.ndarray] = []
        held = 0

        def packed() -> pa.RecordBatch:
            group = Packed(documents, row_length, padding)
            name = f"part-{part:06d}-{uuid.uuid4().hex}"
            for suffix, array in (("ids", group.ids), ("cu", group.cumulative), ("resets", group.resets)):
                save(files, f"{place}/{name}.{suffix}.npy", array)
            ends = np.cumsum([0, *np.bincount(group.document, minlength=len(documents)).tolist()])
            pieces = pa.StructArray.from_arrays([pa.array(x) for x in (group.row, group.place, group.length)], ["row", "place", "length"])
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([name] * len(keys)), pa.array(keys, pa.int64()), pa.array([len(x) for x in documents], pa.int64()),
                    pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pieces),
                ],
                ["file", "id", "n_tokens", "pieces"],
            )

        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                keys.append(key)
                documents.append(np.array(coder.encode_ordinary(text.as_py() or ""), kind))
                held += len(documents[-1])
                if held >= group_tokens:
                    yield packed()
                    keys, documents, held = [], [], 0
        if keys:
            yield packed()

    chosen = docs.select(id_or_last(id_col).alias("id"), F.col(text_col).alias("text"))
    chosen.mapInArrow(run, INDEX).write.parquet(f"{folder.rstrip('/')}/index")


def read_packed(spark: SparkSession, folder: str, id_col: str = "doc_id", row_length: int = ROW) -> DataFrame:
    """The documents of a packed folder: id, ``n_tokens``, ``n_pieces`` and ``ids``, put together from their pieces.

    Each file is read once. A matrix whose pieces, cumulative lengths and resets don't agree is an error.
    """
    index = spark.read.parquet(f"{folder.rstrip('/')}/index")

    def run(key: tuple, group: pa.Table) -> pa.Table:
        store, base = pyarrow.fs.FileSystem.from_uri(folder)
        name = key[0].as_py()
        matrix, cumulative, resets = (load(store, f"{base}/{name}.{suffix}.npy") for suffix in ("ids", "cu", "resets"))
        starts = np.flatnonzero(np.unpackbits(resets, count=matrix.size))
        if not np.array_equal(starts, cumulative[:-1]) or cumulative[-1] != matrix.size:
            raise ValueError(f"{name}: cumulative lengths and resets differ")
        flat = matrix.ravel()
        pieces = group["pieces"].combine_chunks()
        ends = pieces.offsets.to_numpy()
        row, place, length = (pieces.values.field(x).to_numpy() for x in ("row", "place", "length"))
        first = row * row_length + place
        if not np.array_equal(cumulative[np.searchsorted(cumulative, first) + 1] - first, length):
            raise ValueError(f"{name}: pieces and cumulative lengths differ")
        lists = [
            np.concatenate([flat[first[i] : first[i] + length[i]] for i in range(a, b)]) if b > a else flat[:0]
            for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)
        ]
        return pa.table(
            {
                "id": group["id"],
                "n_tokens": group["n_tokens"],
                "n_pieces": pa.array(np.diff(ends).astype(np.int64)),
                "ids": int_lists(lists),
            }
        )

    rows = index.groupBy("file").applyInArrow(run, "id long, n_tokens long, n_pieces long, ids array<int>")
    return rows.withColumn(id_col, id_or_null(F.col("id"))).drop("id")
