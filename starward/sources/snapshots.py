"""All-or-nothing replacement of a parquet table.

Parquet has no row-level change, and overwriting a path that the same plan reads destroys it.  So
each commit writes a new version folder, and one row appended to ``commits`` makes it current.  A
failed write leaves a folder no commit names; the next commit writes over it.  Readers keep the
version they opened.  One writer per table at a time.

The commit row also keeps the highest key ever given out, so that the number of a deleted last row
is not used again.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starward.sources.scratch import delete_path, path_exists

COMMIT_SCHEMA = "version bigint, high_water bigint"


@dataclass(frozen=True)
class SnapshotTable:
    spark: SparkSession
    root: str
    schema: T.StructType

    def _current(self) -> Row | None:
        """The newest commit: one row, whatever the size of the table."""
        path = f"{self.root}/commits"
        if not path_exists(self.spark, path):
            return None
        commits = self.spark.read.schema(COMMIT_SCHEMA).parquet(path)
        return commits.agg(F.max(F.struct("version", "high_water")).alias("newest")).first().newest

    @property
    def version(self) -> int:
        current = self._current()
        return current.version if current else 0

    @property
    def high_water(self) -> int:
        current = self._current()
        return current.high_water if current else 0

    def _folder(self, version: int) -> str:
        return f"{self.root}/data/version={version:08d}"

    def read(self, version: int | None = None) -> DataFrame:
        version = self.version if version is None else version
        if version == 0:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(self._folder(version))

    def commit(
        self,
        df: DataFrame,
        key: str | None = None,
        partition_by: Sequence[str] = (),
        restart: bool = False,
        check: Callable[[DataFrame], None] | None = None,
    ) -> DataFrame:
        """Write ``df`` as the next version and make it current.

        ``restart`` forgets the old high-water mark, as a key reset does.  ``check`` gets the written rows
        before they are made current; if it raises, they never are.
        """
        current = self._current()
        version = (current.version if current else 0) + 1
        rows = df.select(*[F.col(f.name).cast(f.dataType) for f in self.schema])
        seen = Observation()
        if key is not None:
            rows = rows.observe(seen, F.max(key).alias("top"))
        rows.write.mode("overwrite").partitionBy(*partition_by).parquet(self._folder(version))
        if check is not None:
            check(self.read(version))
        high_water = current.high_water if current and not restart else 0
        if key is not None:
            high_water = max(high_water, seen.get["top"] or 0)
        self.spark.createDataFrame([(version, high_water)], COMMIT_SCHEMA).coalesce(1).write.mode(
            "append"
        ).parquet(f"{self.root}/commits")
        return self.read(version)

    def retire(self, keep: int = 1) -> int:
        """Delete the folders of versions before the last ``keep``; returns how many.  Their readers must have ended."""
        old = [v for v in range(1, self.version - keep + 1) if path_exists(self.spark, self._folder(v))]
        for version in old:
            delete_path(self.spark, self._folder(version))
        return len(old)


def commit_snapshot(df: DataFrame, target: SnapshotTable, key: str | None = None) -> DataFrame:
    return target.commit(df, key=key)
