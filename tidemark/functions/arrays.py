"""Array expressions that stay near linear in the array's length."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Values that are folded from the start of their block; blocks are folded from the start of the array.
BLOCK = 64


def before(values: Column, zero: Column, add: Callable[[Column, Column], Column]) -> Column:
    """For each value the fold of all values before it, by blocks, so that no array grows value by value."""
    once = lambda value, body: F.transform(F.array(value), body)[0]

    def of(v: Column) -> Column:
        block = lambda b: F.slice(v, b * BLOCK + 1, F.lit(BLOCK))
        count = F.greatest(F.ceil(F.size(v) / BLOCK), F.lit(1)).cast("int")
        totals = F.transform(F.sequence(F.lit(0), count - 1), lambda b: F.aggregate(block(b), zero, add))
        starts = lambda t: F.transform(t, lambda _, b: F.aggregate(F.slice(t, F.lit(1), b), zero, add))
        within = lambda x, s: F.transform(x, lambda _, j: F.aggregate(F.slice(x, F.lit(1), j), s, add))
        return once(once(totals, starts), lambda st: F.flatten(F.transform(st, lambda s, b: once(block(b), lambda x: within(x, s)))))

    return once(values, of)
