"""Gapless places inside a bounded number of groups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starward.operators.keys import assign_keys


def places(df: DataFrame, group: str, order_by: Sequence[str], sizes: dict[int, int], name: str) -> DataFrame:
    """Add ``name``: the row's place from 0 among those of its ``group``, in the given order.

    All rows are numbered over one range-partitioned sort that begins with the group, so a group may
    hold any share of them; what earlier groups hold is taken off.  ``sizes`` are the row counts by
    group, which the caller bounds.
    """
    before, steps = 0, F.lit(0).cast("bigint")
    cases: Column | None = None
    for key in sorted(sizes):
        hit = F.col(group) == key
        cases = F.when(hit, F.lit(before).cast("bigint")) if cases is None else cases.when(hit, F.lit(before).cast("bigint"))
        before += sizes[key]
    steps = steps if cases is None else cases
    numbered = assign_keys(df, "_number", [group, *order_by])
    return numbered.withColumn(name, F.col("_number") - 1 - steps).drop("_number")
