"""Pairs of words as blocks of numbers: counted, laid out by target word and summed with numpy, batch by batch."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Tokens or pairs that become numbers together, tokens of a text in one row and rows of an answer.
CHUNK = 1 << 21
ROW_TOKENS = 1 << 10
OUT_ROWS = 1 << 16
#: Bits of a packed pair that hold its count; the other 46 hold two numbers below 2 ** 23.
COUNT_BITS = 18
MOST = (1 << COUNT_BITS) - 1
#: An odd factor whose product's upper bits deal keys out evenly.
FACTOR = np.uint64(0x9E3779B97F4A7C15)
#: Edges in a row of a stored block.
BLOCK = 1 << 17


def gathered(batches: Iterator[pa.RecordBatch], size: Callable[[pa.RecordBatch], int] = len, rows: int = 1 << 14) -> Iterator[pa.Table]:
    """Batches put together to about ``CHUNK`` by ``size``; larger ones are split into ``rows`` rows."""
    held, total = [], 0
    for batch in batches:
        for first in range(0, len(batch), rows):
            held.append(batch.slice(first, rows))
            total += size(held[-1])
            if total >= CHUNK:
                yield pa.Table.from_batches(held)
                held, total = [], 0
    if held:
        yield pa.Table.from_batches(held)


def joined(*columns: pa.ChunkedArray) -> pa.Array:
    """All values of columns of one type."""
    return pa.chunked_array([chunk for column in columns for chunk in column.chunks], columns[0].type).combine_chunks()


def numbers(words: pa.Array, names: pa.Array) -> np.ndarray:
    """The place of each word among the names, -1 for null and unknown ones."""
    coded = words.dictionary_encode()
    known = pc.index_in(coded.dictionary, value_set=names).fill_null(-1).to_numpy(zero_copy_only=False)
    return np.append(known, np.int32(-1))[coded.indices.fill_null(-1).to_numpy(zero_copy_only=False)]


def firsts(values: np.ndarray) -> np.ndarray:
    """Where each run of equal values starts."""
    return np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]])) if len(values) else np.zeros(0, np.int64)


def evenly(keys: np.ndarray, parts: int) -> np.ndarray:
    """A part for each key, by a digest."""
    digest = (keys.astype(np.uint64) * FACTOR) >> np.uint64(32)
    return ((digest * np.uint64(parts)) >> np.uint64(32)).astype(np.uint16)


def dealt(part: np.ndarray, parts: int, columns: dict[str, np.ndarray], **same: str) -> pa.RecordBatch:
    """A row per part with the bytes of its entries, in their order."""
    order = np.argsort(part, kind="stable")
    ends = np.cumsum(np.bincount(part, minlength=parts))
    full = np.flatnonzero(np.diff(ends, prepend=0))
    begins = np.concatenate([[0], ends])
    cells = [pa.array(full.astype(np.int32))]
    for values in columns.values():
        sorted_values = values[order]
        cells.append(pa.array([sorted_values[begins[k] : ends[k]].tobytes() for k in full], pa.binary()))
    cells += [pa.array([value] * len(full)) for value in same.values()]
    return pa.RecordBatch.from_arrays(cells, ["part", *columns, *same])


def values_of(cell: pa.Scalar, kind: str) -> np.ndarray:
    return np.frombuffer(cell.as_buffer(), kind)


def pair_keys(rows: pa.ListArray, names: pa.Array, window: int, bits: int) -> np.ndarray:
    """A key for each two different words less than ``window`` apart, the lesser number in its upper bits.

    The tokens of a row beyond ``ROW_TOKENS`` are the first of the next row and only seen from before.
    """
    ids = numbers(rows.flatten(), names).astype(np.int64)
    lengths = pc.list_value_length(rows).fill_null(0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(lengths)
    at = np.arange(len(ids))
    left = np.repeat(ends, lengths) - at
    left[(at - np.repeat(ends - lengths, lengths) >= ROW_TOKENS) | (ids < 0)] = 0
    keys = []
    for apart in range(1, max(window, 2)):
        first = np.flatnonzero(left > apart)
        one, two = ids[first], ids[first + apart]
        differ = (one != two) & (two >= 0)
        one, two = one[differ], two[differ]
        keys.append((np.minimum(one, two) << bits) | np.maximum(one, two))
    return np.concatenate(keys).view(np.uint64)


def packed_counts(keys: np.ndarray) -> np.ndarray:
    """Each key once with its count in the lower bits, twice or more often if the count does not fit."""
    keys.sort()
    starts = firsts(keys)
    counts = np.diff(starts, append=len(keys))
    keys, times = keys[starts], -(-counts // MOST)
    if len(keys) and times.max() > 1:
        last = np.cumsum(times) - 1
        rest = counts - (times - 1) * MOST
        keys, counts = np.repeat(keys, times), np.full(last[-1] + 1, MOST)
        counts[last] = rest
    return (keys << np.uint64(COUNT_BITS)) | counts.astype(np.uint64)


def counted(batches: Iterator[pa.RecordBatch], names: pa.Array, window: int, parts: int) -> Iterator[pa.RecordBatch]:
    """From rows of tokens to ``(part, packed)``: the counted pairs of a few million tokens, dealt to parts by a digest of the pair."""
    bits = max(len(names) - 1, 1).bit_length()
    size = lambda batch: pc.sum(pc.list_value_length(batch[0])).as_py() or 0
    for table in gathered(batches, size, 256):
        packed = packed_counts(pair_keys(joined(table.column(0)), names, window, bits))
        yield dealt(evenly(packed >> np.uint64(COUNT_BITS), parts), parts, {"packed": packed})


def added(batches: Iterator[pa.RecordBatch], names: pa.Array) -> Iterator[pa.RecordBatch]:
    """The pairs of one part as ``(one, two, weight)``, in order."""
    bits = max(len(names) - 1, 1).bit_length()
    packed = [values_of(cell, "u8") for batch in batches for cell in batch["packed"]]
    if not packed:
        return
    packed = np.concatenate(packed)
    packed.sort()
    keys, counts = packed >> np.uint64(COUNT_BITS), (packed & np.uint64(MOST)).astype(np.int64)
    starts = firsts(keys)
    keys, weights = keys[starts].view(np.int64), np.add.reduceat(counts, starts) if len(starts) else counts
    for first in range(0, len(keys), OUT_ROWS):
        some = keys[first : first + OUT_ROWS]
        cells = [names.take(pa.array(some >> bits)), names.take(pa.array(some & ((1 << bits) - 1))), pa.array(weights[first : first + OUT_ROWS])]
        yield pa.RecordBatch.from_arrays(cells, ["one", "two", "weight"])


def narrow(weights: np.ndarray) -> tuple[str, np.ndarray]:
    """The weights in the fewest bytes that hold them exactly."""
    if len(weights) and weights.min() >= 0 and (weights == np.floor(weights)).all():
        for kind in ("u1", "u2", "u4"):
            if weights.max() <= np.iinfo(kind).max:
                return kind, weights.astype(kind)
    return "f8", weights


SPLIT = "names array<string>, counts array<bigint>, one binary, two binary, weights binary, kind string"


def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From ``(one, two, weight)`` to a row for many pairs: their words, how often each comes, and places in that list instead of words."""
    for table in gathered(batches):
        coded = joined(table["one"], table["two"]).dictionary_encode()
        places = coded.indices.fill_null(-1).to_numpy(zero_copy_only=False)
        one, two = places[: len(table)], places[len(table) :]
        known = (one >= 0) & (two >= 0)
        one, two = one[known], two[known]
        counts = np.bincount(one, minlength=len(coded.dictionary)) + np.bincount(two, minlength=len(coded.dictionary))
        kind, weights = narrow(table["weight"].to_numpy()[known])
        lists = [pa.ListArray.from_arrays(pa.array([0, len(counts)], pa.int32()), values) for values in (coded.dictionary, pa.array(counts))]
        cells = [pa.array([values.astype(form).tobytes()], pa.binary()) for values, form in ((one, "i4"), (two, "i4"), (weights, kind))]
        yield pa.RecordBatch.from_arrays([*lists, *cells, pa.array([kind])], ["names", "counts", "one", "two", "weights", "kind"])


def directed(batches: Iterator[pa.RecordBatch], names: pa.Array, parts: int) -> Iterator[pa.RecordBatch]:
    """From split pairs to both directions of them, dealt to parts by a digest of the target's number."""
    for batch in batches:
        known = numbers(batch["names"].flatten(), names)
        ends = np.cumsum(pc.list_value_length(batch["names"]).to_numpy())
        for own, one, two, weights, kind in zip(np.split(known, ends[:-1]), *(batch[name] for name in ("one", "two", "weights", "kind")), strict=True):
            one, two, weights = own[values_of(one, "i4")], own[values_of(two, "i4")], values_of(weights, kind.as_py())
            targets, sources = np.concatenate([two, one]), np.concatenate([one, two])
            yield dealt(evenly(targets, parts), parts, {"words": targets, "sources": sources, "weights": np.concatenate([weights, weights])}, kind=kind.as_py())


def laid_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The edges of one part in blocks: each target once, where its edges start, their sources and weights.

    Sources of two bytes come first, so that most edges, which have a frequent word as their source, take little room.
    """
    words, sources, weights = [], [], []
    for batch in batches:
        for word, source, weight, kind in zip(*(batch[name] for name in ("words", "sources", "weights", "kind")), strict=True):
            words.append(values_of(word, "i4"))
            sources.append(values_of(source, "i4"))
            weights.append(values_of(weight, kind.as_py()).astype(np.float64))
    if not words:
        return
    words, sources, weights = np.concatenate(words), np.concatenate(sources), np.concatenate(weights)
    far = sources > np.iinfo("u2").max
    order = np.argsort((far.astype(np.int64) << 62) | (words.astype(np.int64) << 31) | sources, kind="stable")
    near = len(order) - int(far.sum())
    for some, form in ((order[:near], "u2"), (order[near:], "i4")):
        for first in range(0, len(some), BLOCK):
            block = some[first : first + BLOCK]
            targets = words[block]
            starts = firsts(targets).astype(np.int32)
            kind, own = narrow(weights[block])
            cells = [pa.array([values.tobytes()], pa.binary()) for values in (targets[starts], starts, sources[block].astype(form), own)]
            yield pa.RecordBatch.from_arrays([*cells, pa.array([form]), pa.array([kind])], ["words", "starts", "sources", "weights", "form", "kind"])


EDGES = "words binary, starts binary, sources binary, weights binary, form string, kind string"


def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, ...]]:
    """Targets, where their edges start, sources and weights of each stored block."""
    for batch in batches:
        for words, starts, sources, weights, form, kind in zip(*batch.columns, strict=True):
            yield values_of(words, "i4"), values_of(starts, "i4"), values_of(sources, form.as_py()), values_of(weights, kind.as_py())


def summed(batches: Iterator[pa.RecordBatch], numbers_of: np.ndarray) -> Iterator[pa.RecordBatch]:
    """``(words, sums)`` of each block: for each target the sum of weight times the source's number."""
    for words, starts, sources, weights in blocks(batches):
        sums = np.add.reduceat(numbers_of[sources] * weights, starts)
        yield pa.RecordBatch.from_arrays([pa.array([v.tobytes()], pa.binary()) for v in (words, sums)], ["words", "sums"])


def named_shares(batches: Iterator[pa.RecordBatch], names: pa.Array, sums: np.ndarray) -> Iterator[pa.RecordBatch]:
    """``(src, word, share)`` of each edge, those of a target in a block together."""
    for words, starts, sources, weights in blocks(batches):
        targets = np.repeat(words, np.diff(starts, append=len(sources)))
        for first in range(0, len(sources), OUT_ROWS):
            some = slice(first, first + OUT_ROWS)
            cells = [names.take(pa.array(sources[some])), names.take(pa.array(targets[some])), pa.array(weights[some] / sums[sources[some]])]
            yield pa.RecordBatch.from_arrays(cells, ["src", "word", "share"])


def passed(batches: Iterator[pa.RecordBatch], names: pa.Array, ranks: np.ndarray) -> Iterator[pa.RecordBatch]:
    """From ``(src, word, share)`` to ``(word, n, given)``: rows and the sum of share times the source's rank, for each word of a few million rows."""
    for table in gathered(batches):
        sources, coded = numbers(joined(table["src"]), names), joined(table["word"]).dictionary_encode()
        known, codes = sources >= 0, coded.indices.to_numpy(zero_copy_only=False)
        size = len(coded.dictionary)
        counts = np.bincount(codes[known], minlength=size)
        given = np.bincount(codes[known], table["share"].to_numpy()[known] * ranks[sources[known]], size)
        full = np.flatnonzero(counts)
        for first in range(0, len(full), OUT_ROWS):
            some = full[first : first + OUT_ROWS]
            yield pa.RecordBatch.from_arrays([coded.dictionary.take(pa.array(some)), pa.array(counts[some]), pa.array(given[some])], ["word", "n", "given"])
