"""A type 2 dimension that only grows: a run appends the rows it opens and the keys it closes.

Three kinds of folders make up the table: ``open`` holds rows as they were opened, ``closing`` the keys that were closed with their
days, and ``closed`` whole closed rows.  Current rows are the open ones without a closing; that is one anti-join in which the
closings are the smaller side, and whoever wants current rows only never reads the closed ones.  Closed rows that every run closes again
need no rewrite either: a commit names the day, and it counts for whatever was closed up to that commit.

When the closings have grown to a part of the open rows, ``fold`` writes both kinds anew.  A run without changes writes nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starward.operators.history import CURRENT, END, START, scd2_changes, scd2_closing, scd2_opened
from starward.sources.parts import PartTable
from starward.sources.scratch import staged
from starward.sources.tables import read_table_or_empty

OPEN, CLOSING, CLOSED = "open", "closing", "closed"
KIND = T.StructField("Kind", T.StringType())
#: Closings are folded into the rows once they are more than this part of the open ones.
FOLD_SHARE = 0.2
_RECLOSED = "version bigint, day date"
#: The commit that a closed row belongs to.
_VERSION = "_version"


@dataclass(frozen=True)
class HistoryTable:
    """``schema`` ends in the start and end day and the current flag; ``key`` is its surrogate key."""

    spark: SparkSession
    root: str
    schema: T.StructType
    key: str

    @property
    def _rows(self) -> PartTable:
        stored = T.StructType([*self.schema.fields, T.StructField(_VERSION, T.LongType())])
        return PartTable(self.spark, f"{self.root}/rows", stored, KIND)

    @property
    def version(self) -> int:
        """Grows with every commit of rows and every new closing day."""
        return self._rows.version + self._reclosed().count()

    @property
    def high_water(self) -> int:
        return self._rows.high_water

    # --- reading ---

    def _reclosed(self) -> DataFrame:
        return read_table_or_empty(self.spark, f"{self.root}/reclosed", T.StructType.fromDDL(_RECLOSED))

    def _closed_again(self):
        """The last commit whose closed rows were closed again, and the day; none if never."""
        newest = F.max_by(F.struct("version", "day"), F.struct("version", "day"))
        return self._reclosed().agg(newest.alias("newest")).first().newest

    def current(self) -> DataFrame:
        """The current rows."""
        rows = self._rows
        opened, ended = rows.read([OPEN]), rows.read([CLOSING]).select(self.key)
        return opened.join(ended, self.key, "left_anti").select(*self.schema.names)

    def closed(self) -> DataFrame:
        """The closed rows with the days that count."""
        rows = self._rows
        ends = rows.read([CLOSING]).select(self.key, F.col(END).alias("_end"), _VERSION)
        lately = rows.read([OPEN]).drop(_VERSION).join(ends, self.key).withColumn(END, F.col("_end"))
        lately = lately.withColumn(CURRENT, F.lit(0)).select(*self.schema.names, _VERSION)
        both = rows.read([CLOSED]).select(*self.schema.names, _VERSION).unionByName(lately)
        again = self._closed_again()
        if again is not None:
            both = both.withColumn(END, F.when(F.col(_VERSION) <= again.version, F.lit(again.day)).otherwise(F.col(END)))
        return both.select(*self.schema.names)

    def read(self) -> DataFrame:
        return self.current().unionByName(self.closed())

    # --- writing ---

    def merge(
        self,
        source: DataFrame,
        columns: Sequence[str],
        as_of: date,
        reclose: bool = True,
        check: Callable[[DataFrame], None] | None = None,
        unique: bool = False,
    ) -> dict[str, int]:
        """Close what differs from ``source`` and open what is new, as ``scd2_merge``; returns how many of each.

        Equal sides write nothing, but for one row with the day where closed rows are closed again on another one.  ``check`` gets the opened
        rows, the only ones that are new.
        """
        columns, rows = list(columns), self._rows
        current = self.current()
        changes = scd2_changes(current, source, columns, self.key)
        counts = {"opened": 0, "closed": 0}
        if not changes.isEmpty() or not rows.version:
            version = F.lit(rows.version + 1).cast("bigint").alias(_VERSION)
            opened = scd2_opened(changes, columns, self.key, as_of, rows.high_water, unique=unique)
            ended = scd2_closing(current, changes, columns, self.key)
            empty = [F.lit(None).cast(f.dataType).alias(f.name) for f in self.schema if f.name not in (self.key, END)]
            closing = ended.select(self.key, F.lit(as_of).alias(END), *empty, version, F.lit(CLOSING).alias(KIND.name))
            both = opened.withColumns({_VERSION: version, KIND.name: F.lit(OPEN)}).unionByName(closing)

            def check_opened(written: DataFrame) -> None:
                # A closing repeats its row's key and nothing else of it.
                if check is not None:
                    check(written.where(F.col(START).isNotNull()).select(*self.schema.names))

            written = rows.commit(both, replace=(), key=self.key, check=check_opened, rebalance=False)
            counts = {
                "opened": sum(p.rows for p in written if p.part == OPEN),
                "closed": sum(p.rows for p in written if p.part == CLOSING),
            }
        if reclose:
            self._close_again(as_of)
        self._fold_if_large()
        return counts

    def _close_again(self, day: date) -> None:
        """All rows closed so far end on ``day``: one row says so, unless they all do already."""
        rows = self._rows
        if all(p.part == OPEN for p in rows.parts()):
            return
        again = self._closed_again()
        since = 0 if again is None else again.version
        if (again is None or again.day == day) and self._all_end_on(day, since):
            return
        row = self.spark.createDataFrame([(rows.version, day)], _RECLOSED)
        row.coalesce(1).write.mode("append").parquet(f"{self.root}/reclosed")

    def _all_end_on(self, day: date, since: int) -> bool:
        later = self._rows.read([CLOSING, CLOSED]).where(F.col(_VERSION) > since)
        return later.where(~F.col(END).eqNullSafe(F.lit(day))).isEmpty()

    def _fold_if_large(self) -> None:
        sizes = {OPEN: 0, CLOSING: 0}
        for p in self._rows.parts():
            if p.part in sizes:
                sizes[p.part] += p.rows
        if sizes[CLOSING] > FOLD_SHARE * sizes[OPEN]:
            self.fold()

    def fold(self) -> None:
        """Write current rows as open ones and closed rows whole; what the table reads as stays."""
        rows = self._rows
        version = F.lit(rows.version + 1).cast("bigint")
        ends = rows.read([CLOSING]).select(self.key, F.col(END).alias("_end"), F.col(_VERSION).alias("_at"))
        lately = rows.read([OPEN]).join(ends, self.key)
        closed = lately.select(*[c for c in self.schema.names if c not in (END, CURRENT)], F.col("_end").alias(END), F.lit(0).alias(CURRENT), F.col("_at").alias(_VERSION), F.lit(CLOSED).alias(KIND.name))
        current = self.current().withColumns({_VERSION: version, KIND.name: F.lit(OPEN)})
        # Closed rows of earlier folds stay where they are.
        rows.commit(staged(current.unionByName(closed), "folded"), replace=[OPEN, CLOSING], key=self.key)
