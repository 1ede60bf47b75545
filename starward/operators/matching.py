"""Join conditions over many columns."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def all_equal(left: str, right: str, columns: Iterable[str], nulls_match: bool) -> Column:
    """Every column equal between two aliased frames.

    ``nulls_match`` is the rule of set operations; without it, as in a merge, NULL matches nothing.
    """
    def pair(name: str) -> Column:
        a, b = F.col(f"{left}.`{name}`"), F.col(f"{right}.`{name}`")
        return a.eqNullSafe(b) if nulls_match else a == b

    return reduce(lambda x, y: x & y, (pair(c) for c in columns))
