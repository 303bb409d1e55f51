"""Helpers on array expressions: a value worked out once, and folds over what comes before."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.arrays import before

__all__ = ["before", "let"]


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once."""
    return F.transform(F.array(value), body)[0]
