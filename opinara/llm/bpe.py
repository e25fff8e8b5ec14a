"""Byte-pair encoding and decoding with the vocabulary file of a public tokenizer.

A word's symbols form a doubly linked list; a priority queue holds the candidate
merges by rank and position. A popped candidate whose symbols have changed
since is stale and skipped. Decoding looks ids up and joins the vocabulary strings.

The file names the normalisation, the pattern that splits the text into words, the
vocabulary, the merges in rank order and the special tokens, which are found in
the raw text first.
"""

from __future__ import annotations

import heapq
import json
import unicodedata
from array import array
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Words, and pieces between blanks, whose encoding a worker remembers: twice as many at most.
CACHED_WORDS = 150_000
CACHED_PIECES = 80_000
#: Longer ones are not remembered.
CACHED_LENGTH = 64
#: Tokens after which a batch of results is handed on.
BATCH_TOKENS = 1 << 21


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies.

    Printable Latin-1 bytes stand for themselves; the others take the characters
    from 256 on, in order.
    """
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    shifted = iter(range(256, 512))
    return [chr(b if b in plain else next(shifted)) for b in range(256)]


class Remembered(dict):
    """Results of a function of a string. When full, the entries become the older ones, which are looked up once more."""

    def __init__(self, function: Callable[[str], bytes], most: int) -> None:
        super().__init__()
        self.function, self.most = function, most
        self.older: dict[str, bytes] = {}

    def __missing__(self, key: str) -> bytes:
        found = self.older.get(key)
        if found is None:
            found = self.function(key)
        if len(key) <= CACHED_LENGTH:
            self[key] = found
            if len(self) >= self.most:
                self.older = dict(self)
                self.clear()
        return found


class Vocabulary:
    """The tables of one tokenizer file. Encodings are packed as 32-bit numbers."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        ids = model["vocab"]
        suffix = model["end_of_word_suffix"] or ""
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = max([*ids.values(), *special.values()]) + 1
        self.tokens: list[str | None] = [None] * size
        for table in (ids, special):
            for token, i in table.items():
                self.tokens[i] = token
        symbols = byte_symbols()
        self.inner = [ids[s] for s in symbols]
        self.last = [ids[s + suffix] for s in symbols]
        #: For each left id the right ids that it merges with, and the rank; for each rank the id of the merged symbol.
        nothing: dict[int, int] = {}
        self.ranks: list[dict[int, int]] = [nothing] * size
        self.made: list[int] = []
        for rank, (a, b) in enumerate(model["merges"]):
            if self.ranks[ids[a]] is nothing:
                self.ranks[ids[a]] = {}
            self.ranks[ids[a]].setdefault(ids[b], rank)
            self.made.append(ids[a + b])
        steps = spec["pre_tokenizer"]["pretokenizers"]
        self.words = regex.compile(steps[0]["pattern"]["Regex"], flags=regex.V1)
        self.special = special
        self.cuts = regex.compile("|".join(map(regex.escape, sorted(special, key=len, reverse=True)))) if special else None
        self.word_ids = Remembered(lambda word: array("i", self.merged(word.encode())).tobytes(), CACHED_WORDS)
        self.piece_ids = Remembered(self.piece, CACHED_PIECES)

    def merged(self, word: bytes) -> list[int]:
        """Ids of one word: merges by rank, the leftmost first among equal ranks."""
        ids = [*map(self.inner.__getitem__, word)]
        ids[-1] = self.last[word[-1]]
        count = len(ids)
        ranks, made, pop, push = self.ranks, self.made, heapq.heappop, heapq.heappush
        # An entry is rank and position as one number; the pair at that place tells whether it is stale.
        bits = count.bit_length()
        mask = (1 << bits) - 1
        queue = []
        for i in range(count - 1):
            rank = ranks[ids[i]].get(ids[i + 1])
            if rank is not None:
                queue.append(rank << bits | i)
        if not queue:
            return ids
        heapq.heapify(queue)
        before, after = list(range(-1, count - 1)), [*range(1, count), -1]
        while queue:
            entry = pop(queue)
            i = entry & mask
            j = after[i]
            left = ids[i]
            rank = entry >> bits
            if j < 0 or left < 0 or ranks[left].get(ids[j]) != rank:
                continue  # stale: merged into its neighbour since, or one of the two was merged
            ids[i] = new = made[rank]
            ids[j] = -1
            k = after[i] = after[j]
            if k >= 0:
                before[k] = i
                rank = ranks[new].get(ids[k])
                if rank is not None:
                    push(queue, rank << bits | i)
            h = before[i]
            if h >= 0:
                rank = ranks[ids[h]].get(new)
                if rank is not None:
                    push(queue, rank << bits | h)
        return [i for i in ids if i >= 0]

    def piece(self, text: str) -> bytes:
        return b"".join(map(self.word_ids.__getitem__, self.words.findall(text)))

    def plain(self, text: str) -> bytes:
        """Encodes a text without special tokens. No word holds a blank or a line end, so pieces between them go alone."""
        text = lowered(unicodedata.normalize("NFC", text)).replace("\n", " ")
        return b"".join(map(self.piece_ids.__getitem__, text.split(" ")))

    def encode(self, text: str) -> np.ndarray:
        out, at = [], 0
        for found in self.cuts.finditer(text) if self.cuts else ():
            out += [self.plain(text[at : found.start()]), array("i", [self.special[found[0]]]).tobytes()]
            at = found.end()
        out.append(self.plain(text[at:] if at else text))
        return np.frombuffer(b"".join(out), np.int32)

    def forget(self) -> None:
        """Frees the remembered encodings: a worker outlives the task that filled them."""
        for known in (self.word_ids, self.piece_ids):
            known.clear()
            known.older = {}
        pa.default_memory_pool().release_unused()

    def decode(self, ids: list[int]) -> str:
        """Vocabulary strings joined by a space, as this file states no decoder of its own."""
        tokens = self.tokens
        return " ".join([t for i in ids if (t := tokens[i]) is not None])


def lowered(text: str) -> str:
    """Lower case character by character, so without the rule for a final sigma."""
    low = text.lower()
    return low if "ς" not in low and "Σ" not in text else "".join([c.lower() for c in text])


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    """One per worker and file; the file is at the same place on every machine."""
    return Vocabulary(path)


def int_lists(lists: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, lists)])
    flat = np.concatenate(lists) if lists else np.empty(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int32()))


def encoded(table: Vocabulary, batch: pa.RecordBatch, back: bool) -> Iterator[pa.RecordBatch]:
    """The ids of a batch of keys and texts, and the text that they decode to, handed on when there are many."""
    keys, texts = batch.column(0), batch.column(1)
    lists: list[np.ndarray] = []
    held = start = 0
    for at in range(batch.num_rows):
        lists.append(table.encode(texts[at].as_py() or ""))
        held += len(lists[-1])
        if held >= BATCH_TOKENS or at == batch.num_rows - 1:
            columns = {"id": keys.slice(start, at + 1 - start), "ids": int_lists(lists)}
            if back:
                columns["decoded"] = pa.array([table.decode(ids.tolist()) for ids in lists], pa.string())
            yield pa.RecordBatch.from_arrays([*columns.values()], [*columns])
            lists, held, start = [], 0, at + 1


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", decoded: bool = False) -> DataFrame:
    """``id_col`` and ``ids`` (array<int>) of every row; other columns are left out.

    With ``decoded`` also the text that ``decode`` makes of these ids, in the same pass. Whole
    texts, one row each. A null or empty text, or one of white space, has no
    ids. Repeated rows are encoded each. Memory holds a batch of texts, about
    ``BATCH_TOKENS`` ids and the remembered words. A very long word is one unit:
    its cost is n log n.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = vocabulary(path)
        try:
            for batch in batches:
                yield from encoded(table, batch, decoded)
        finally:
            table.forget()

    chosen = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = chosen.schema["id"].dataType.simpleString()
    schema = f"id {kind}, ids array<int>" + ", decoded string" * decoded
    return chosen.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def decode(rows: DataFrame, path: str, ids_col: str = "ids", out: str = "decoded") -> DataFrame:
    """Adds the text that the ids stand for; special tokens are written out, null ids give ''.

    Ids that the vocabulary lacks are left out. A column that is named as the result is replaced.
    """
    chosen = rows.drop(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = vocabulary(path)
        for batch in batches:
            lists = batch.column(batch.schema.get_field_index(ids_col))
            texts = [table.decode(x.values.to_pylist()) if x.is_valid else "" for x in lists]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], [*batch.schema.names, out])

    return chosen.mapInArrow(run, T.StructType([*chosen.schema.fields, T.StructField(out, T.StringType())]))
