"""Carry new surrogate keys of a dimension into a fact."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

OLD, NEW = "old_key", "new_key"


def key_changes(before: DataFrame, after: DataFrame, natural_id: str, key: str) -> DataFrame:
    """``old_key, new_key`` of the members that a sync gave a new key.

    An ID with several rows on either side names no single key and is left out, as are members that came or went.
    """

    def single(dim: DataFrame, name: str) -> DataFrame:
        rows = dim.where(F.col(natural_id).isNotNull()).groupBy(natural_id)
        return rows.agg(F.count("*").alias("_n"), F.max(key).alias(name)).where("_n = 1").select(natural_id, name)

    both = single(before, OLD).join(single(after, NEW), natural_id)
    return both.where(F.col(OLD) != F.col(NEW)).select(OLD, NEW)


def remapped(fact: DataFrame, column: str, changes: DataFrame) -> DataFrame:
    """``fact`` with the new keys in ``column``: a look-up in ``changes``, which Spark broadcasts if they are few; other rows stay."""
    joined = fact.join(changes, F.col(column) == F.col(OLD), "left")
    return joined.select(*[F.coalesce(NEW, c).alias(c) if c == column else F.col(c) for c in fact.columns])
