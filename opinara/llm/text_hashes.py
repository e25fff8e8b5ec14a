"""64-bit hashes of the words of UTF-8 text, for whole arrays at a time."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

#: Text bytes worked on at once.
BLOCK_BYTES = 1 << 20
_RNG = np.random.default_rng(20)
BYTE_CODES = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
STEP = np.uint64(0x9E3779B97F4A7C15)
FACTORS = _RNG.integers(1, 1 << 63, 8, dtype=np.uint64) | np.uint64(1)
SPACES = np.zeros(256, bool)
SPACES[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
#: What a byte counts as: itself, or with A-Z in lower case.
AS_IS = np.arange(256, dtype=np.uint8)
LOWER = AS_IS.copy()
LOWER[0x41:0x5B] += 0x20


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finisher that lets each bit depend on all."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def block_word_hashes(data: np.ndarray, letter: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and 64-bit hashes of the words of UTF-8 bytes; ``letter`` says what a byte counts as."""
    inside = ~SPACES[data]
    edges = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]]).view(np.int8)))
    starts, ends = edges[::2], edges[1::2]
    if not len(starts):
        return starts, np.empty(0, np.uint64)
    lengths = ends - starts
    letters = letter[data[inside]]
    first = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    place = np.arange(len(letters)) - np.repeat(first, lengths)
    powers = np.cumprod(np.full(int(lengths.max()), STEP, np.uint64))
    sums = np.add.reduceat(BYTE_CODES[letters] * powers[place], first)
    return starts, mixed(sums + lengths.astype(np.uint64) * FACTORS[0])


def blocks(data: np.ndarray) -> Iterator[np.ndarray]:
    """The text in blocks that end at white space; a longer word makes a longer block."""
    at = 0
    while at < len(data):
        end = min(at + BLOCK_BYTES, len(data))
        while end < len(data):
            gap = np.flatnonzero(SPACES[data[end : end + BLOCK_BYTES]])
            if len(gap):
                end += int(gap[0])
                break
            end = min(end + BLOCK_BYTES, len(data))
        yield data[at:end]
        at = end


def word_hashes(data: np.ndarray, letter: np.ndarray) -> np.ndarray:
    """Hashes of the words of one text."""
    found = [block_word_hashes(block, letter)[1] for block in blocks(data)]
    return np.concatenate(found) if found else np.empty(0, np.uint64)
