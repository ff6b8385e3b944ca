"""Running totals over arrays."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def running(values: Column, n: Column, combine: Callable[[Column, Column], Column], none: Column) -> Column:
    """Element i combines the elements 0 to i of values (n is their number, none the neutral element).

    Each round combines every element with the one 1, 2, 4, ... places before it, so n elements take
    n log n steps; appending to a growing array would take n squared."""

    def widen(acc: Column, back: Column) -> Column:
        return F.zip_with(F.concat(F.array_repeat(none, back), F.slice(acc, F.lit(1), F.size(acc) - back)), acc, combine)

    rounds = F.transform(F.sequence(F.lit(0), F.char_length(F.bin(n - 1)) - 1), lambda k: F.pow(F.lit(2), k).cast("int"))
    return F.when(n < 2, values).otherwise(F.aggregate(rounds, values, widen))


def running_sum(values: Column, n: Column) -> Column:
    return running(values, n, lambda a, b: a + b, F.lit(0))
