"""Words of a list at all positions of many texts, as array operations over Arrow batches.

The list is a trie in arrays. All positions of a slice of texts go down the trie together, one
character a round; those without a child are left out, so a round costs what is still on a path.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Characters of the texts that are looked at together, and start positions that go down the trie together.
SLICE = 1 << 20
#: Children in a plain table up to this size, else in a sorted list.
TABLE = 1 << 23


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


@dataclass(frozen=True)
class Trie:
    """``edges`` are sorted keys ``node * letters + letter`` with their ``children``; ``word_of`` has -1 for nodes that end no word."""

    alphabet: np.ndarray
    edges: np.ndarray
    children: np.ndarray
    word_of: np.ndarray

    @property
    def letters(self) -> int:
        return len(self.alphabet) + 1


def build(words: Sequence[str]) -> Trie:
    """The trie of distinct words that are not empty, level by level."""
    points = code_points("".join(words))
    alphabet = np.unique(points)
    letters, codes = len(alphabet) + 1, np.searchsorted(alphabet, points) + 1
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    starts = np.cumsum(lengths) - lengths
    node, size, edges, children, ends = np.zeros(len(words), np.int64), 1, [], [], []
    open_words = np.arange(len(words))
    for depth in range(int(lengths.max(initial=0))):
        open_words = open_words[lengths[open_words] > depth]
        keys, own = np.unique(node[open_words] * letters + codes[starts[open_words] + depth], return_inverse=True)
        node[open_words] = size + own
        edges.append(keys)
        children.append(size + np.arange(len(keys)))
        size += len(keys)
        done = open_words[lengths[open_words] == depth + 1]
        ends.append((node[done], done))
    word_of = np.full(size, -1, np.int64)
    for at, word in ends:
        word_of[at] = word
    # Nodes are numbered by level and, inside a level, by key; so all keys are sorted.
    join = lambda parts: np.concatenate(parts) if parts else np.zeros(0, np.int64)
    return Trie(alphabet, join(edges), join(children), word_of)


class Finder:
    """A trie made ready for searches; one for each task."""

    def __init__(self, trie: Trie) -> None:
        self.trie, cells = trie, len(trie.word_of) * trie.letters
        self.table = None
        if cells <= TABLE:
            self.table = np.zeros(cells, np.int32)
            self.table[trie.edges] = trie.children
        self.number = None
        if len(trie.alphabet):
            self.number = np.zeros(int(trie.alphabet[-1]) + 2, np.int32)
            self.number[trie.alphabet] = np.arange(1, trie.letters)

    def codes(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The numbers of all characters, a 0 behind each text, and where the texts start."""
        lengths = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
        points = code_points("\0".join(texts) + "\0")
        out = self.number[np.minimum(points, len(self.number) - 1)]
        ends = np.cumsum(lengths)
        out[ends - 1] = 0
        return out, ends - lengths

    def step(self, node: np.ndarray, code: np.ndarray) -> np.ndarray:
        """The child of each node by the letter, 0 where there is none."""
        keys = node * self.trie.letters + code
        if self.table is not None:
            return self.table[keys].astype(np.int64)
        at = np.minimum(np.searchsorted(self.trie.edges, keys), len(self.trie.edges) - 1)
        return np.where(self.trie.edges[at] == keys, self.trie.children[at], 0)

    def hits(self, texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Text, position in it and word of every place where a word stands, by parts."""
        if self.number is None or not texts:
            return
        codes, starts = self.codes(texts)
        for first in range(0, len(codes), SLICE):
            at = first + np.flatnonzero(codes[first : first + SLICE])
            node, depth, places, words = np.zeros(len(at), np.int64), 0, [], []
            while len(at):
                node = self.step(node, codes[at + depth])
                kept = node > 0
                at, node, depth = at[kept], node[kept], depth + 1
                word = self.trie.word_of[node]
                places.append(at[word >= 0])
                words.append(word[word >= 0])
            if places:
                place = np.concatenate(places)
                text = np.searchsorted(starts, place, "right") - 1
                yield text, place - starts[text], np.concatenate(words)


def sliced(texts: pa.Array) -> Iterator[tuple[int, list[str]]]:
    """Parts of a batch of texts with the row of their first; null counts as empty, and a part ends with the text that fills it."""
    part, first, size = [], 0, 0
    for row, text in enumerate(texts):
        value = text.as_py() or ""
        part.append(value)
        size += len(value)
        if size >= SLICE:
            yield first, part
            part, first, size = [], row + 1, 0
    yield first, part


def labels_of(texts: pa.Array, finder: Finder, label_starts: np.ndarray, label_ids: np.ndarray, labels: pa.Array) -> pa.Array:
    """The distinct labels of the words in each text, sorted; a word has ``label_ids`` from its ``label_starts`` on."""
    rows, found, many = [], [], max(len(labels), 1)
    for first, part in sliced(texts):
        seen = [np.unique(text * len(label_starts) + word) for text, _, word in finder.hits(part)]
        if not seen:
            continue
        pairs = np.unique(np.concatenate(seen))
        text, word = np.divmod(pairs, len(label_starts))
        count = label_starts[word + 1] - label_starts[word]
        offset = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        own = np.unique(np.repeat(text, count) * many + label_ids[np.repeat(label_starts[word], count) + offset])
        rows.append(first + own // many)
        found.append(own % many)
    row = np.concatenate(rows) if rows else np.zeros(0, np.int64)
    offsets = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=len(texts)))]).astype(np.int32)
    ids = np.concatenate(found) if found else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets), labels.take(pa.array(ids)))


def longest_of(texts: pa.Array, finder: Finder, sizes: np.ndarray, tags: pa.Array) -> pa.Array:
    """For each position of a text at which a word starts the size and tag of the longest one, in order."""
    rows, places, words = [], [], []
    for first, part in sliced(texts):
        for text, place, word in finder.hits(part):
            order = np.lexsort((sizes[word], place, text))
            text, place, word = text[order], place[order], word[order]
            last = np.ones(len(text), bool)
            last[:-1] = (text[1:] != text[:-1]) | (place[1:] != place[:-1])
            rows.append(first + text[last])
            places.append(place[last])
            words.append(word[last])
    join = lambda parts: np.concatenate(parts) if parts else np.zeros(0, np.int64)
    row, place, word = join(rows), join(places), join(words)
    offsets = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=len(texts)))]).astype(np.int32)
    hit = pa.StructArray.from_arrays([pa.array(sizes[word], pa.int32()), tags.take(pa.array(word))], ["size", "tag"])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.StructArray.from_arrays([pa.array(place, pa.int32()), hit], ["_at", "_hit"]))
