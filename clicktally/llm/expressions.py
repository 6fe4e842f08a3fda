"""Column helpers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once for a row, however often the body names it.

    A column of a lower projection would do as well, but the optimizer may put its expression in
    every place that names it, in a filter always.
    """
    return F.get(F.transform(F.array(value), lambda bound: body(bound)), F.lit(0))
