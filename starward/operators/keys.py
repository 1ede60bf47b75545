"""Surrogate keys: dense, growing, never reused."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starward.sources.scratch import staged

_POS, _PART, _BASE = "_pos", "_part", "_base"
# monotonically_increasing_id() holds the partition above bit 33 and the row's place below it.
_PLACE_BITS = 33


def assign_keys(
    df: DataFrame,
    key: str,
    order_by: Sequence[str | Column] = (),
    start: int | Column = 0,
    unique: bool = False,
) -> DataFrame:
    """Add ``key`` = ``start`` + rank, beginning at ``start`` + 1.

    With ``order_by`` keys follow that order.  The rows are range-partitioned, sorted inside each
    partition and written once, each with its place.  Key = start + rows in earlier partitions +
    place, so no task ever sees more than its own range, unlike a window over the whole table.
    The write is needed: range bounds are sampled and could move between two passes.

    Equal order values must not pile up in one range.  Unless the caller knows them to be
    ``unique``, the rows' arrival positions are written first and break the ties.

    Without ``order_by`` keys follow arrival, with no shuffle at all.
    """
    if order_by:
        order = list(order_by)
        source = df
        if not unique:
            source = staged(df.withColumn(_POS, F.monotonically_increasing_id()), f"{key}-arrival")
            order = [*order, _POS]
        df = source.repartitionByRange(*order).sortWithinPartitions(*order).drop(_POS)
    placed = staged(df.withColumn(_POS, F.monotonically_increasing_id()), f"{key}-placed")

    part = F.shiftright(F.col(_POS), _PLACE_BITS)
    place = F.col(_POS).bitwiseAND(F.lit((1 << _PLACE_BITS) - 1))
    # One row per written partition, so the unpartitioned window and the broadcast are bounded by
    # the number of tasks, not by the data.
    sizes = placed.groupBy(part.alias(_PART)).agg(F.count("*").alias("_n"))
    earlier = Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select(_PART, F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias(_BASE))

    begin = start if isinstance(start, Column) else F.lit(start)
    keyed = placed.withColumn(_PART, part).join(F.broadcast(bases), _PART)
    number = (begin.cast("bigint") + F.col(_BASE) + place + 1).alias(key)
    return keyed.select(number, *[c for c in placed.columns if c != _POS])


def highest_key(df: DataFrame, key: str) -> Column:
    """The largest key of a table as a scalar subquery, 0 when it is empty."""
    return df.agg(F.coalesce(F.max(key), F.lit(0)).cast("bigint")).scalar()
