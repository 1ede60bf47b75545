"""Type 1 sync: make a dimension equal its source, by natural ID."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starward.functions.text import marked_deleted
from starward.operators.keys import assign_keys, highest_key
from starward.operators.setops import IN_SOURCE, change_set, plain_text, under_collation
from starward.sources.scratch import staged

_CHANGED = "_changed"


def scd1_actions(
    dim: DataFrame, source: DataFrame, natural_id: str, columns: Sequence[str], key: str, collation: str | None = None
) -> DataFrame:
    """The IDs that differ, written once, and whether the source still has them; none if both sides agree."""
    dim, source = under_collation(dim, collation), under_collation(source, collation)
    return staged(
        change_set(source, dim, columns)
        .where(F.col(natural_id).isNotNull())
        .groupBy(natural_id)
        .agg(F.max(IN_SOURCE).alias(_CHANGED)),
        f"{key}-actions",
    )


def scd1_changes_anything(
    dim: DataFrame,
    actions: DataFrame,
    natural_id: str,
    key: str,
    name_column: str | None = None,
    on_delete: str = "flag",
    protect_keys: Sequence[int] = (),
) -> bool:
    """Whether ``actions`` alter the dimension: a member that is marked as deleted already stays as it is."""
    if not actions.where(F.col(_CHANGED) == 1).isEmpty():
        return True
    gone = dim.join(actions, natural_id, "left_semi").where(~F.col(key).isin(*protect_keys))
    if on_delete == "flag":
        name = F.col(name_column)
        gone = gone.where(~name.eqNullSafe(marked_deleted(name)))
    return not gone.isEmpty()


def scd1_sync(
    dim: DataFrame,
    source: DataFrame,
    natural_id: str,
    columns: Sequence[str],
    key: str,
    name_column: str | None = None,
    on_delete: str = "flag",
    on_update: str = "rekey",
    protect_keys: Sequence[int] = (),
    start: int | Column | None = None,
    order_by: Sequence[str | Column] | None = None,
    unique: bool = False,
    actions: DataFrame | None = None,
    collation: str | None = None,
) -> DataFrame:
    """The dimension after one sync; ``actions`` are those of ``scd1_actions`` if they are known.

    ``columns`` are compared and include the natural ID but not the key.

    * An ID with any new or changed source row: its old rows go, its source rows come in with new
      keys.  ``on_update="keep"`` keeps the old key where the ID has one row on each side.
    * An ID whose row left the source: ``" (Deleted)"`` is added once to ``name_column``
      (``on_delete="flag"``) or the rows go (``"drop"``).  ``protect_keys`` exempts rows such as
      the unknown member, which no source contains.
    * A NULL ID matches nothing: such a row is neither replaced nor inserted.

    One shuffle over source and dimension finds what differs.  The IDs that differ are written
    once; usually they are few, and Spark broadcasts them by the written size, so neither table
    is shuffled again.

    Under a ``collation`` texts that it holds equal are no change, and IDs that it holds equal are one; the rows keep their own texts.
    """
    if collation is not None:
        compared = scd1_sync(
            under_collation(dim, collation), under_collation(source, collation), natural_id, columns, key, name_column,
            on_delete, on_update, protect_keys, start, order_by, unique, actions,
        )
        return plain_text(compared, dim)
    if on_delete not in ("flag", "drop"):
        raise ValueError(f"on_delete: {on_delete}")
    if on_update not in ("rekey", "keep"):
        raise ValueError(f"on_update: {on_update}")
    if on_delete == "flag" and name_column is None:
        raise ValueError("flagging needs a name column")

    columns = list(columns)
    if actions is None:
        actions = scd1_actions(dim, source, natural_id, columns, key)
    changed_ids = actions.where(F.col(_CHANGED) == 1).select(natural_id)

    marked = dim.join(actions, natural_id, "left")
    kept = marked.where(F.col(_CHANGED).isNull() | (F.col(_CHANGED) == 0))
    gone = F.col(_CHANGED).isNotNull()
    if protect_keys:
        gone = gone & ~F.col(key).isin(*protect_keys)
    if on_delete == "drop":
        kept = kept.where(~gone)
    else:
        kept = kept.withColumn(
            name_column,
            F.when(gone, marked_deleted(F.col(name_column))).otherwise(F.col(name_column)),
        )
    kept = kept.select(key, *columns)

    added = source.select(*columns).join(changed_ids, natural_id, "left_semi")
    if start is None:
        start = highest_key(dim, key)
    order = [natural_id] if order_by is None else order_by

    if on_update == "keep":
        old_keys = _only_row_keys(dim.join(changed_ids, natural_id, "left_semi"), natural_id, key)
        single = added.groupBy(natural_id).agg(F.count("*").alias("_n")).where("_n = 1")
        reusable = old_keys.join(single.select(natural_id), natural_id, "left_semi")
        kept = kept.unionByName(added.join(reusable, natural_id).select(key, *columns))
        added = added.join(reusable, natural_id, "left_anti")

    fresh = assign_keys(added.select(*columns), key, order_by=order, start=start, unique=unique)
    return kept.unionByName(fresh.select(key, *columns))


def _only_row_keys(rows: DataFrame, natural_id: str, key: str) -> DataFrame:
    """IDs that occur once, with their key."""
    return (
        rows.groupBy(natural_id)
        .agg(F.count("*").alias("_n"), F.max(key).alias(key))
        .where("_n = 1")
        .drop("_n")
    )
