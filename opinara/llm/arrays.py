"""Column expressions over arrays."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once, also where ``use`` names it many times or in a loop."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def sums_before(numbers: Column) -> Column:
    """For each number of an int array the sum of those before it.

    Sums go over blocks of about the square root of their number, so a long array
    doesn't cost its square. An empty array gives an empty one.
    """
    add = lambda s, x: s + x
    total = lambda array, first, number: F.aggregate(F.slice(array, first, number), F.lit(0), add)

    def with_width(width: Column) -> Column:
        blocks = F.transform(F.sequence(F.lit(0), F.greatest(F.floor((F.size(numbers) - 1) / width).cast("int"), F.lit(0))), lambda b: total(numbers, b * width + 1, width))

        def with_blocks(sums: Column) -> Column:
            def with_before(before: Column) -> Column:
                block = lambda i: F.floor(i / width).cast("int")
                inside = lambda i: total(numbers, block(i) * width + 1, i % width)
                return F.transform(numbers, lambda _, i: F.get(before, block(i)) + inside(i))

            return once(F.transform(sums, lambda _, b: total(sums, F.lit(1), b)), with_before)

        return once(blocks, with_blocks)

    return once(F.greatest(F.ceil(F.sqrt(F.size(numbers))).cast("int"), F.lit(1)), with_width)


def maxima_before(numbers: Column, least: int) -> Column:
    """For each number of an int array the largest of those before it, ``least`` for the first.

    Block by block as ``sums_before``. An empty array gives an empty one.
    """
    larger = lambda s, x: F.greatest(s, x)
    top = lambda array, first, number: F.aggregate(F.slice(array, first, number), F.lit(least), larger)

    def with_width(values: Column, width: Column) -> Column:
        last = F.greatest(F.floor((F.size(values) - 1) / width).cast("int"), F.lit(0))
        blocks = F.transform(F.sequence(F.lit(0), last), lambda b: top(values, b * width + 1, width))

        def with_before(before: Column) -> Column:
            def value(i: Column) -> Column:
                block = F.floor(i / width).cast("int")
                return F.greatest(F.get(before, block), top(values, block * width + 1, i % width))

            return F.transform(values, lambda _, i: value(i))

        return once(blocks, lambda b: once(F.transform(b, lambda _, i: top(b, F.lit(1), i)), with_before))

    def with_values(values: Column) -> Column:
        return once(F.greatest(F.ceil(F.sqrt(F.size(values))).cast("int"), F.lit(1)), lambda width: with_width(values, width))

    return once(numbers, with_values)
