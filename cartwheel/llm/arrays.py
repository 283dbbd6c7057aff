"""Column expressions over long arrays and texts, in time that grows with their length."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Values that are gone through one by one: a longer array is cut into such blocks, whose
#: results are gone through the same way.
BLOCK = 128
#: Characters of the pieces that a text is cut into, to find a place without a walk from its start.
PIECE = 4096

Combine = Callable[[Column, Column], Column]


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once, however often it is used."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _one_by_one(values: Column, first: Column, combine: Combine) -> Column:
    """Each append copies what is there, so this is for short arrays."""
    kind = F.struct(first.alias("last"), F.slice(F.array(first), 1, 0).alias("out"))

    def step(held: Column, value: Column) -> Column:
        return let(combine(held["last"], value), lambda now: F.struct(
            now.alias("last"), F.array_append(held["out"], now).alias("out")))

    return F.aggregate(values, kind, step, lambda held: held["out"])


def running(values: Column, zero: Column, combine: Combine, levels: int = 3) -> Column:
    """Combine each value with all before it, as a running sum or maximum.

    ``zero`` changes nothing when combined. Up to ``BLOCK`` to the power of ``levels`` values
    take time in proportion to their number.
    """
    def short(v: Column) -> Column:
        return _one_by_one(v, zero, combine)

    def blocked(v: Column) -> Column:
        count = F.floor((F.size(v) - 1) / BLOCK).cast("int")
        blocks = F.transform(F.sequence(F.lit(0), count), lambda b: F.slice(v, b * BLOCK + 1, BLOCK))

        def joined(held: Column) -> Column:
            totals = F.transform(held, lambda block: F.aggregate(block, zero, combine))
            return let(running(totals, zero, combine, levels - 1), lambda before: F.flatten(F.transform(
                held, lambda block, i: _one_by_one(
                    block, F.when(i == 0, zero).otherwise(F.get(before, i - 1)), combine))))

        return let(blocks, joined)

    if levels == 1:
        return short(values)
    return let(values, lambda v: F.when(F.size(v) <= BLOCK, short(v)).otherwise(blocked(v)))


def running_sum(values: Column) -> Column:
    return running(values, F.lit(0), lambda a, b: a + b)


def running_max(values: Column) -> Column:
    return running(values, F.lit(-1), lambda a, b: F.greatest(a, b))


def pieces(text: Column) -> Column:
    """A text in pieces of :data:`PIECE` characters, for :func:`between`."""
    return F.regexp_extract_all(text, F.lit(rf"(?s).{{1,{PIECE}}}"), F.lit(0))


def between(cut: Column, start: Column, end: Column) -> Column:
    """Characters ``start`` to ``end`` (exclusive, from 0) of a text given by its :func:`pieces`."""
    first = F.floor(start / PIECE).cast("int")
    last = F.floor((end - 1) / PIECE).cast("int")
    held = F.array_join(F.slice(cut, first + 1, last - first + 1), "")
    return F.when(end > start, F.substr(held, start - first * PIECE + 1, end - start)).otherwise("")
