"""Set operations: NULL equals NULL and results hold no duplicates."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starward.functions.text import collated
from starward.operators.matching import all_equal

IN_SOURCE, IN_TARGET = "in_source", "in_target"


def under_collation(df: DataFrame, collation: str | None) -> DataFrame:
    """Text columns compared under ``collation``; binary comparison when there is none."""
    if collation is None:
        return df
    text = {f.name for f in df.schema if isinstance(f.dataType, T.StringType)}
    return df.select(
        *[collated(F.col(c), collation).alias(c) if c in text else F.col(c) for c in df.columns]
    )


def plain_text(df: DataFrame, like: DataFrame) -> DataFrame:
    """Text columns with the plain types they have in ``like``; a collation changes how texts compare and never the texts."""
    types = {f.name: f.dataType for f in like.schema}
    return df.select(*[F.col(c).cast(types[c]).alias(c) if c in types else F.col(c) for c in df.columns])


def union_distinct(*frames: DataFrame) -> DataFrame:
    """Distinct union by column name.  One ``distinct`` at the end is one shuffle for any number."""
    return reduce(DataFrame.unionByName, frames).distinct()


def except_distinct(left: DataFrame, right: DataFrame) -> DataFrame:
    """``left EXCEPT right``."""
    return left.subtract(right.select(*left.columns))


def except_loaded(new: DataFrame, loaded: DataFrame, distinct: bool = False, loaded_distinct: bool = False) -> DataFrame:
    """``new EXCEPT loaded`` where ``new`` is a day's feed and ``loaded`` a table's whole history.

    A plain anti-join must build or shuffle the history.  Here the history is first reduced to the
    rows that occur in the feed: in that semi-join the feed is the side Spark may broadcast, by
    its own size check, and the history is only read.  A feed too large for that shuffles both.
    ``distinct`` says that ``new`` holds no duplicates already, ``loaded_distinct`` that ``loaded`` hardly holds any: what was
    seen then goes into the second join as the first one left it, without a shuffle of its own.
    """
    fresh = new if distinct else new.distinct()
    same = all_equal("loaded", "fresh", new.columns, nulls_match=True)
    seen = loaded.select(*new.columns).alias("loaded").join(fresh.alias("fresh"), same, "left_semi")
    if not loaded_distinct:
        seen = seen.distinct()
    return fresh.alias("fresh").join(seen.alias("loaded"), same, "left_anti")


def change_set(source: DataFrame, target: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``source EXCEPT target`` and ``target EXCEPT source`` in one shuffle.

    Both sides are tagged and grouped by all columns, so copies combine before the shuffle and
    one hot ID spreads over many partitions.  Rows on both sides are left out; the rest carry
    ``in_source`` = 1 (new or changed) or ``in_target`` = 1 (gone).
    """
    tagged = source.select(
        *columns, F.lit(1).alias(IN_SOURCE), F.lit(0).alias(IN_TARGET)
    ).unionByName(target.select(*columns, F.lit(0).alias(IN_SOURCE), F.lit(1).alias(IN_TARGET)))
    sides = tagged.groupBy(*columns).agg(
        F.max(IN_SOURCE).alias(IN_SOURCE), F.max(IN_TARGET).alias(IN_TARGET)
    )
    return sides.where(F.col(IN_SOURCE) != F.col(IN_TARGET))
