"""Name a value inside an expression."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body(value)` with `value` worked out once.

    A Column used several times is written out several times in the plan. With regular
    expressions inside each other that makes expressions too long to compile, and values
    used within a lambda are worked out again for every element.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))
