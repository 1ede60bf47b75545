"""Fact merge: insert what is new, delete what is gone."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from starward.operators.copies import expand_copies
from starward.operators.matching import all_equal
from starward.operators.setops import under_collation

_SRC, _TGT, _STATE, _INS, _DEL = "_src", "_tgt", "_state", "_ins", "_del"
_SLOT, _COPIES = "_slot", "_copies"


@dataclass(frozen=True)
class FactMerge:
    """Counts per distinct row; the frames below unfold them."""

    counts: DataFrame
    columns: list[str]
    unique: bool = False

    def _rows(self, count: str) -> DataFrame:
        return expand_copies(self.counts.select(*self.columns, count), count, spread=not self.unique)

    @property
    def state(self) -> DataFrame:
        """The table after the merge."""
        return self._rows(_STATE)

    @property
    def inserted(self) -> DataFrame:
        return self._rows(_INS)

    @property
    def deleted(self) -> DataFrame:
        return self._rows(_DEL)

    @property
    def changes(self) -> DataFrame:
        """One row for each distinct row that comes or goes, with how often; matched rows aren't in it."""
        return self.counts.where((F.col(_INS) > 0) | (F.col(_DEL) > 0)).select(*self.columns, _INS, _DEL)


def merged_in_parts(
    fact: DataFrame, source: DataFrame, columns: Sequence[str], part: str, keys: Sequence[str], slots: int = 1
) -> tuple[DataFrame, Observation, Observation]:
    """The table after the merge, laid out by ``part``; what came and went; and how many rows share their ``keys``.

    As ``fact_merge`` for rows that hardly ever occur twice, but one shuffle does for all: rows meet by ``part`` and a slot of the first
    key, of which each part has ``slots``, and are matched, searched for repeated ``keys`` and written where they are.  ``columns``
    include ``part`` and ``keys``.  The observations are there once the frame has been written.
    """
    columns = list(columns)
    moved, repeated = Observation(), Observation()
    slot = F.pmod(F.xxhash64(keys[0]), F.lit(slots)).cast("int").alias(_SLOT)
    tagged = source.select(*columns, slot, F.lit(1).alias(_SRC), F.lit(0).alias(_TGT)).unionByName(
        fact.select(*columns, slot, F.lit(0).alias(_SRC), F.lit(1).alias(_TGT))
    )
    counted = _counts(tagged.repartition(part, _SLOT), [_SLOT, *columns], columns)
    counted = counted.observe(moved, F.sum(_INS).alias("inserted"), F.sum(_DEL).alias("deleted"))
    state = expand_copies(counted.select(_SLOT, *columns, _STATE), _STATE, spread=False)
    alike = Window.partitionBy(part, _SLOT, *keys)
    state = state.withColumn(_COPIES, F.count(F.lit(1)).over(alike))
    state = state.observe(repeated, F.count_if(F.col(_COPIES) > 1).alias("n"))
    return state.select(*columns), moved, repeated


def applied(fact: DataFrame, changes: DataFrame, columns: Sequence[str], unique: bool = False) -> DataFrame:
    """``fact`` after written ``changes``: the rows that stay are read in place, without a shuffle if changes are few."""
    columns = list(columns)
    gone = changes.where(F.col(_DEL) > 0).select(*columns)
    stays = fact.alias("t").join(gone.alias("s"), all_equal("t", "s", columns, nulls_match=True), "left_anti")
    return stays.select(*columns).unionByName(expand_copies(changes.select(*columns, _INS), _INS, spread=not unique))


def change_counts(changes: DataFrame) -> dict[str, int]:
    """Rows that written ``changes`` insert and delete."""
    sums = changes.agg(F.coalesce(F.sum(_INS), F.lit(0)), F.coalesce(F.sum(_DEL), F.lit(0))).first()
    return {"inserted": sums[0], "deleted": sums[1]}


def fact_merge(
    fact: DataFrame, source: DataFrame, columns: Sequence[str], unique: bool = False, collation: str | None = None
) -> FactMerge:
    """Match ``fact`` and ``source`` on every column.

    A source row without a match is inserted and a fact row without one is deleted; matched rows
    stay.  NULL matches nothing, so a row with a NULL is deleted and inserted again.

    Both tables are tagged, combined before the shuffle and grouped by all columns: one shuffle,
    spread by whole-row hash, gives the state and both deltas.

    ``unique`` says that rows hardly ever occur twice, as in a source that was grouped by its
    keys.  The result is the same; copies are then unfolded where they were counted.  Rows that a ``collation`` holds
    equal match, and one of them stands for all.
    """
    columns = list(columns)
    fact, source = under_collation(fact, collation), under_collation(source, collation)
    tagged = source.select(*columns, F.lit(1).alias(_SRC), F.lit(0).alias(_TGT)).unionByName(
        fact.select(*columns, F.lit(0).alias(_SRC), F.lit(1).alias(_TGT))
    )
    return FactMerge(_counts(tagged, columns, columns), columns, unique)


def _counts(tagged: DataFrame, groups: Sequence[str], compared: Sequence[str]) -> DataFrame:
    """For each distinct row how often it stands after the merge, comes and goes."""
    sides = tagged.groupBy(*groups).agg(F.sum(_SRC).alias(_SRC), F.sum(_TGT).alias(_TGT))
    has_null = reduce(lambda a, b: a | b, (F.col(c).isNull() for c in compared))
    matched = (F.col(_SRC) > 0) & (F.col(_TGT) > 0) & ~has_null
    zero = F.lit(0).cast("bigint")
    return sides.select(
        *groups,
        F.when(matched, F.col(_TGT)).otherwise(F.col(_SRC)).alias(_STATE),
        F.when(matched, zero).otherwise(F.col(_SRC)).alias(_INS),
        F.when(matched, zero).otherwise(F.col(_TGT)).alias(_DEL),
    )
