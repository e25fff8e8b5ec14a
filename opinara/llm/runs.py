"""Periodic runs of words, by maximal pairs from an LCP-interval tree.

The suffixes of many texts are sorted together by doubling; texts share no word number,
so no two suffixes of different texts agree. Intervals of suffixes with a common prefix
are visited bottom-up, the deepest first. A set of occurrences has a list of places for each
word to the left. Where two sets meet at depth l, places i < j of different left words are
a maximal pair: the words from i on and from j on agree for exactly l words, and not further to
the left. With a distance p = j - i of at most l / (exponent - 1) the stretch from i to j + l has period p,
and nothing extends it: the pair is the run.

Occurrences of a string that lie that close are multiples of its smallest period apart, so
only neighbours in position can be a run's pair, and no product of lists is needed.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Least number of times that a run holds its period, and least length in words.
EXPONENT = 4
LENGTH = 6
#: Words whose suffixes are sorted at once; a longer text is a block of its own.
BLOCK_WORDS = 1 << 18
#: Smaller sets are put into a list one place at a time.
FEW = 32


def suffix_order(numbers: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """The suffixes in order, and ranks by the first 1, 2, 4, ... words as far as two suffixes agree."""
    size = len(numbers)
    order = np.argsort(numbers, kind="stable").astype(np.int32)
    first = np.concatenate([[True], np.diff(numbers[order]) != 0])
    starts = np.maximum.accumulate(np.where(first, np.arange(size), 0))
    rank = np.empty(size, np.int32)
    rank[order] = starts
    levels = [rank]
    alone = first & np.concatenate([first[1:], [True]])
    slots = np.flatnonzero(~alone)
    step = 1
    while len(slots):
        places = order[slots].astype(np.int64)
        after = places + step
        second = np.where(after < size, rank[np.minimum(after, size - 1)].astype(np.int64), -1)
        key = rank[places].astype(np.int64) * (size + 1) + second + 1
        by_key = np.argsort(key, kind="stable")
        places, key = places[by_key], key[by_key]
        order[slots] = places
        first = np.concatenate([[True], np.diff(key) != 0])
        rank = rank.copy()
        rank[places] = slots[np.maximum.accumulate(np.where(first, np.arange(len(slots)), 0))]
        levels.append(rank)
        slots = slots[~(first & np.concatenate([first[1:], [True]]))]
        step *= 2
    return order, levels


def common_prefixes(order: np.ndarray, levels: list[np.ndarray], least: int) -> np.ndarray:
    """For each suffix in order the words that it shares with the one before it; 0 where it may be fewer than ``least``."""
    size = len(order)
    out = np.zeros(size, np.int64)
    level = min(least.bit_length() - 1, len(levels) - 1)
    ranks = levels[level][order]
    rows = np.flatnonzero(ranks[1:] == ranks[:-1]) + 1
    a, b = order[rows - 1].astype(np.int64), order[rows].astype(np.int64)
    shared = np.zeros(len(rows), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        x, y = a + shared, b + shared
        inside = np.maximum(x, y) < size
        same = inside & (levels[k][np.minimum(x, size - 1)] == levels[k][np.minimum(y, size - 1)])
        shared += same.astype(np.int64) << k
    out[rows] = shared
    return out


class Occurrences:
    """Places of one string: in order, and as a list for each word to the left."""

    __slots__ = ("places", "classes")

    def __init__(self, place: int, left: int) -> None:
        self.places = [place]
        self.classes = {left: [place]}

    def add(self, other: Occurrences) -> None:
        if len(other.places) < FEW:
            for place in other.places:
                insort(self.places, place)
        else:
            self.places += other.places
            self.places.sort()
        for left, places in other.classes.items():
            self.classes.setdefault(left, []).extend(places)


class Runs:
    """Collects the maximal pairs of one block that are runs: (start, length) -> period."""

    def __init__(self, left: list[int], exponent: int, length: int) -> None:
        self.left, self.exponent, self.length = left, exponent, length
        self.found: dict[tuple[int, int], int] = {}

    def merged(self, one: Occurrences, other: Occurrences, depth: int) -> Occurrences:
        """The union of two sets that meet at ``depth``; pairs across them are examined."""
        small, large = (one, other) if len(one.places) < len(other.places) else (other, one)
        gap = depth // (self.exponent - 1)
        near = large.places
        for left, places in small.classes.items():
            if len(large.classes) == 1 and left in large.classes:
                continue  # every pair goes on to the left
            for place in places:
                at = bisect_left(near, place)
                if at < len(near) and near[at] - place <= gap and self.left[near[at]] != left:
                    self.pair(place, near[at], depth)
                if at and place - near[at - 1] <= gap and self.left[near[at - 1]] != left:
                    self.pair(near[at - 1], place, depth)
        large.add(small)
        return large

    def pair(self, start: int, other: int, depth: int) -> None:
        period = other - start
        if period + depth >= self.length:
            key = (start, period + depth)
            if period < self.found.get(key, period + 1):
                self.found[key] = period

    def visit(self, order: list[int], meets: list[int], least: int) -> None:
        """Bottom-up over the intervals of depth ``least`` or more; ``meets`` has the depth at which a suffix meets the next one."""
        stack: list[tuple[int, Occurrences]] = []
        for place, following in zip(order, meets, strict=True):
            node = Occurrences(place, self.left[place])
            while stack and stack[-1][0] > following:
                top, held = stack.pop()
                node = self.merged(held, node, top)
            if following >= least:
                if stack and stack[-1][0] == following:
                    node = self.merged(stack.pop()[1], node, following)
                stack.append((following, node))


def runs_of(numbers: np.ndarray, exponent: int, length: int) -> np.ndarray:
    """Rows of start, length and period of all runs in a block of texts that share no number, by start, then period."""
    least = min(max((exponent - 1) * period, length - period) for period in range(1, length + 1))
    if len(numbers) < 2:
        return np.empty((0, 3), np.int64)
    order, levels = suffix_order(numbers)
    prefixes = common_prefixes(order, levels, least)
    del levels
    # Suffixes that share too little with both neighbours are in no such interval.
    following = np.append(prefixes[1:], 0)
    used = (prefixes >= least) | (following >= least)
    left = np.concatenate([[-1], numbers[:-1]])
    runs = Runs(left.tolist() if used.any() else [], exponent, length)
    runs.visit(order[used].tolist(), following[used].tolist(), least)
    rows = np.array([(start, size, period) for (start, size), period in runs.found.items()], np.int64).reshape(-1, 3)
    return rows[np.lexsort((rows[:, 2], rows[:, 0]))]


def numbered(texts: list[list[bytes]]) -> np.ndarray:
    """A number for each word, the same for equal words of a text and for no words of two texts."""
    out, base = [], 0
    for words in texts:
        seen: dict[bytes, int] = {}
        out.append(np.fromiter((seen.setdefault(word, len(seen)) for word in words), np.int64, len(words)) + base)
        base += len(seen)
    return np.concatenate(out) if out else np.empty(0, np.int64)


def collapsed(words: list[bytes], rows: np.ndarray) -> str:
    """The words without those that a run holds after its first period, joined by a blank."""
    if len(rows):
        change = np.zeros(len(words) + 1, np.int64)
        np.add.at(change, rows[:, 0] + rows[:, 2], 1)
        np.add.at(change, rows[:, 0] + rows[:, 1], -1)
        words = [words[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0)]
    return b" ".join(words).decode()


RUN = "struct<start: long, length: long, period: long>"


def answered(ids: pa.Array, texts: list[list[bytes]], exponent: int, length: int) -> pa.RecordBatch:
    starts = np.cumsum([0, *map(len, texts)])
    rows = runs_of(numbered(texts), exponent, length)
    cuts = np.searchsorted(rows[:, 0], starts)
    shorter = []
    for k, words in enumerate(texts):
        own = rows[cuts[k] : cuts[k + 1]]
        own[:, 0] -= starts[k]
        shorter.append(collapsed(words, own))
    runs = pa.StructArray.from_arrays([pa.array(rows[:, k]) for k in range(3)], ["start", "length", "period"])
    lists = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), runs)
    return pa.RecordBatch.from_arrays([ids, pa.array(np.diff(starts)), lists, pa.array(shorter, pa.string())], ["id", "n_words", "runs", "collapsed"])


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", exponent: int = EXPONENT, length: int = LENGTH) -> DataFrame:
    """One row per row of ``docs``: id, ``n_words``, ``runs`` by start, then period, and ``collapsed``.

    Words are runs without ASCII white space. A run is a stretch of at least ``length`` words that
    holds its smallest period ``exponent`` times or more (3 at least) and that no neighbouring word
    extends; ``collapsed`` is the text without the words that some run holds after its first
    period, joined by single blanks. Whole texts are searched; null, empty and blank ones have 0
    words, no run and ''. Rows that repeat are searched each. Other columns are left out. An empty
    table gives none. Memory holds a block of words or one text, and about 4 bytes a word for
    each doubling until no two suffixes agree.
    """
    if exponent < 3 or length < 1:
        raise ValueError("a run holds its period three times at least")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held: list[list[bytes]] = []
            size = start = 0
            for at in range(batch.num_rows):
                held.append((batch.column(1)[at].as_py() or "").encode().split())
                size += len(held[-1])
                if size >= BLOCK_WORDS or at == batch.num_rows - 1:
                    yield answered(batch.column(0).slice(start, len(held)), held, exponent, length)
                    start, held, size = at + 1, [], 0

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, n_words long, runs array<{RUN}>, collapsed string").withColumnRenamed("id", id_col)
