"""Search in sorted arrays, and parts of Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def place_in(sorted_words: Column, word: Column, size: int) -> Column:
    """Where ``word`` is in a sorted array of at most ``size`` entries, or the entry before it."""
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(max(size, 1).bit_length()))])
    return F.aggregate(
        steps, F.lit(0), lambda at, step: F.when(F.coalesce(F.get(sorted_words, at + step) <= word, F.lit(False)), at + step).otherwise(at)
    )


#: Bytes of a batch that become Python values together, unless one row alone has more.
PART_BYTES = 1 << 20


def few_at_a_time[Rows: (pa.Array, pa.RecordBatch)](rows: Rows) -> Iterator[Rows]:
    """An array or a record batch in parts of equal length and about ``PART_BYTES``, at least one."""
    count = max(len(rows), 1)
    step = max(1, PART_BYTES * count // max(rows.nbytes, 1))
    for first in range(0, count, step):
        yield rows.slice(first, step)
