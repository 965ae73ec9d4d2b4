"""What other functions are built from."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` over ``value``, which is evaluated once a row however often ``body`` and its lambdas use it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def pairwise(values: Column, body: Callable[[Column, Column], Column]) -> Column:
    """``body(previous, next)`` of all neighbours in an array."""
    return let(
        values,
        lambda x: F.zip_with(F.slice(x, 1, F.greatest(F.size(x) - 1, F.lit(0))), F.slice(x, 2, F.greatest(F.size(x) - 1, F.lit(0))), body),
    )
