"""Natural ID -> surrogate key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starward.functions.text import collated

_ID, _SLOT = "_lookup_id", "_slot"
UNKNOWN_KEY = 0
#: NULL IDs are spread over this many hash slots.
NULL_SLOTS = 4096


def lookup_key(
    rows: DataFrame,
    dim: DataFrame,
    on: Column,
    dim_id: str,
    take: Sequence[str],
    unknown: str = "drop",
    collation: str | None = None,
) -> DataFrame:
    """Join a dimension and take ``take`` (the key first) from it.

    ``unknown="drop"`` is an inner join: rows without a member vanish.  ``"member"`` keeps them
    with key 0.  Whether the dimension is broadcast is Spark's choice by its size; a dimension too
    large for that is sort-merged, where adaptive execution splits hot IDs.

    Under ``"member"`` NULL IDs would all hash to one partition although they can match nothing.
    A second join column spreads them.

    Texts compare byte by byte, or under a ``collation``.
    """
    known = F.col(dim_id)
    if collation is not None:
        on, known = collated(on, collation), collated(known, collation)
    side = dim.select(known.alias(_ID), *take)
    if unknown == "drop":
        return rows.join(side, on == F.col(_ID), "inner").drop(_ID)
    if unknown != "member":
        raise ValueError(f"unknown: {unknown}")

    key = take[0]
    fits = F.lit(-1)
    slot = F.pmod(F.xxhash64(*rows.columns), F.lit(NULL_SLOTS)).cast("int")
    spread = rows.withColumn(_SLOT, F.when(on.isNull(), slot).otherwise(fits))
    # Not a plain literal: the optimizer would fold it and take it out of the join's hash key.
    side = side.withColumn("_fits", F.when(F.col(_ID).isNotNull(), fits))
    joined = spread.join(side, (on == F.col(_ID)) & (F.col(_SLOT) == F.col("_fits")), "left")
    return joined.withColumn(key, F.coalesce(F.col(key), F.lit(UNKNOWN_KEY))).drop(
        _ID, _SLOT, "_fits"
    )
