"""Type 2 merge: keep every version of a row, with its dates."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starward.operators.copies import expand_copies
from starward.operators.keys import assign_keys, highest_key
from starward.operators.matching import all_equal
from starward.operators.setops import plain_text, under_collation
from starward.sources.scratch import staged

_SRC, _CUR = "_src", "_cur"
START, END, CURRENT = "StartDate", "EndDate", "IsCurrent"


def scd2_merge(
    dim: DataFrame,
    source: DataFrame,
    columns: Sequence[str],
    key: str,
    as_of: date,
    reclose: bool = True,
    start: int | Column | None = None,
    order_by: Sequence[str | Column] | None = None,
    unique: bool = False,
    collation: str | None = None,
) -> DataFrame:
    """The dimension after merging ``source`` on ``as_of``.

    A current row that equals a source row in all ``columns`` stays.  Any other row is closed:
    ``EndDate = as_of``, ``IsCurrent = 0``.  A source row that equals no current row is added,
    open from ``as_of``.  NULL equals nothing here, so a row with a NULL is closed and added anew.

    ``reclose=True`` also closes rows closed on an earlier day again, which moves their end date
    to ``as_of``; ``False`` leaves history alone.

    History is never shuffled: only current rows can match.  One shuffle over source and current
    rows, combined before it, finds the rows that differ.  Those are written once; usually they
    are few, Spark broadcasts them by the written size, and the dimension is only read again.

    Under a ``collation`` rows that it holds equal match; each keeps its own texts.
    """
    if collation is not None:
        sides = under_collation(dim, collation), under_collation(source, collation)
        return plain_text(scd2_merge(*sides, columns, key, as_of, reclose, start, order_by, unique), dim)
    columns = list(columns)
    layout = [key, *columns, START, END, CURRENT]
    today = F.lit(as_of)

    is_current = F.coalesce(F.col(CURRENT) == 1, F.lit(False))
    current, history = dim.where(is_current), dim.where(~is_current)
    if reclose:
        history = history.withColumn(END, today).withColumn(CURRENT, F.lit(0))

    changes = scd2_changes(current, source, columns, key)
    closing = changes.where(F.col(_CUR) > 0).select(*columns, F.lit(True).alias("_closes"))
    same = all_equal("t", "s", columns, nulls_match=True)
    checked = current.alias("t").join(closing.alias("s"), same, "left")
    closes = F.col("s._closes").isNotNull()
    after = checked.select(
        *[F.col(f"t.{c}") for c in (key, *columns, START)],
        F.when(closes, today).otherwise(F.col(f"t.{END}")).alias(END),
        F.when(closes, 0).otherwise(1).alias(CURRENT),
    )

    opened = scd2_opened(changes, columns, key, as_of, highest_key(dim, key) if start is None else start, order_by, unique)
    return history.select(*layout).unionByName(after).unionByName(opened)


def scd2_changes(current: DataFrame, source: DataFrame, columns: Sequence[str], key: str) -> DataFrame:
    """Distinct rows that only one side has, with how often on each side, written once."""
    tagged = source.select(*columns, F.lit(1).alias(_SRC), F.lit(0).alias(_CUR)).unionByName(
        current.select(*columns, F.lit(0).alias(_SRC), F.lit(1).alias(_CUR))
    )
    sides = tagged.groupBy(*columns).agg(F.sum(_SRC).alias(_SRC), F.sum(_CUR).alias(_CUR))
    has_null = reduce(lambda a, b: a | b, (F.col(c).isNull() for c in columns))
    stays = (F.col(_SRC) > 0) & (F.col(_CUR) > 0) & ~has_null
    return staged(sides.where(~stays), f"{key}-changes")


def scd2_closing(current: DataFrame, changes: DataFrame, columns: Sequence[str], key: str) -> DataFrame:
    """The keys of current rows that ``changes`` end."""
    ending = changes.where(F.col(_CUR) > 0).select(*columns)
    same = all_equal("t", "s", columns, nulls_match=True)
    return current.alias("t").join(ending.alias("s"), same, "left_semi").select(key)


def scd2_opened(
    changes: DataFrame,
    columns: Sequence[str],
    key: str,
    as_of: date,
    start: int | Column,
    order_by: Sequence[str | Column] | None = None,
    unique: bool = False,
) -> DataFrame:
    """The rows that ``changes`` open on ``as_of``, with new keys above ``start``."""
    return assign_keys(
        expand_copies(changes.select(*columns, _SRC), _SRC, spread=not unique),
        key,
        order_by=list(columns[:1]) if order_by is None else order_by,
        start=start,
        unique=unique,
    ).select(
        key,
        *columns,
        F.lit(as_of).alias(START),
        F.lit(None).cast("date").alias(END),
        F.lit(1).alias(CURRENT),
    )
