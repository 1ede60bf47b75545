"""Tables in parts: a commit writes only the parts that change and names the folders of all others again.

Each commit writes its rows to a folder of its own, one subfolder a part, then a manifest that lists every folder of the table with
its row count, digest and key range, and last one row in ``commits`` that makes the manifest current.  Readers go by the manifest and
never by what lies in the folders, so a failed write is seen by nobody and the next commit writes over it.  One writer per table at
a time.

Manifests hold a row a folder: months of a fact, days of a log.  They are read on the driver.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass
from datetime import date
from decimal import Decimal
from typing import Any, NamedTuple

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starward.sources.scratch import delete_path, path_exists

COMMITS = "version bigint, high_water bigint, batch string"
MANIFEST = "part string, folder string, rows bigint, digest decimal(38,0), low bigint, high bigint"
#: What the file layout calls a missing part value.
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


class Part(NamedTuple):
    """One folder of a table: its part's value, rows, order-free digest, and smallest and largest key."""

    part: str
    folder: str
    rows: int
    digest: Decimal
    low: int | None
    high: int | None


class RepeatedKey(ValueError):
    """A key of the rows about to be committed stands more than once."""


def part_name(value: Any) -> str:
    return NO_VALUE if value is None else value.isoformat() if isinstance(value, date) else str(value)


def row_digest(columns: Iterable[str]) -> Column:
    """A number for a set of rows that their order and partitioning don't change: the sum of their hashes.

    A hash alone passes over NULLs, so which columns are NULL is hashed too.
    """
    columns = [F.col(f"`{c}`") for c in columns]
    mixed = F.xxhash64(*columns, F.array(*[c.isNull() for c in columns]))
    return F.coalesce(F.sum(mixed.cast("decimal(38,0)")), F.lit(0)).cast("decimal(38,0)")


def digests(rows: DataFrame, by: str, schema: T.StructType) -> dict[str, tuple[int, Decimal]]:
    """``part -> (rows, digest)`` of rows brought to the types of ``schema``; a row a part reaches the driver."""
    typed = rows.select(F.col(by), *[F.col(f.name).cast(f.dataType) for f in schema])
    found = typed.groupBy(by).agg(F.count("*").alias("n"), row_digest(schema.names).alias("d")).collect()
    return {part_name(r[by]): (r.n, r.d) for r in found}


@dataclass(frozen=True)
class PartTable:
    """``schema`` are the columns that readers see; ``by`` is the column that names a row's part, none for a table in one part."""

    spark: SparkSession
    root: str
    schema: T.StructType
    by: T.StructField | None = None

    @property
    def stored(self) -> T.StructType:
        """The columns with ``by``, which the folder names hold."""
        if self.by is None or self.by.name in self.schema.names:
            return self.schema
        return T.StructType([*self.schema.fields, self.by])

    # --- what is committed ---

    def commits(self) -> DataFrame:
        path = f"{self.root}/commits"
        if not path_exists(self.spark, path):
            return self.spark.createDataFrame([], COMMITS)
        return self.spark.read.schema(COMMITS).parquet(path)

    def _current(self) -> Row | None:
        newest = F.max(F.struct("version", "high_water")).alias("newest")
        return self.commits().agg(newest).first().newest

    @property
    def version(self) -> int:
        current = self._current()
        return current.version if current else 0

    @property
    def high_water(self) -> int:
        """The highest key ever given out."""
        current = self._current()
        return current.high_water if current else 0

    def has_batch(self, batch: str) -> bool:
        """Whether a commit carries this batch's name already; no rows of the table are read."""
        return not self.commits().where(F.col("batch") == batch).isEmpty()

    def parts(self, version: int | None = None) -> list[Part]:
        version = self.version if version is None else version
        if version == 0:
            return []
        found = self.spark.read.schema(MANIFEST).parquet(self._manifest(version)).collect()
        return sorted(Part(*r) for r in found)

    def rows(self, version: int | None = None) -> int:
        """The number of rows, from the manifest."""
        return sum(p.rows for p in self.parts(version))

    def _manifest(self, version: int) -> str:
        return f"{self.root}/manifests/{version:08d}"

    def _read_folders(self, folders: Sequence[str], schema: T.StructType) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], schema)
        reader = self.spark.read.schema(self.stored).option("basePath", f"{self.root}/data")
        return reader.parquet(*[f"{self.root}/data/{f}" for f in folders]).select(*[f"`{c}`" for c in schema.names])

    def read(self, parts: Iterable[Any] | None = None, version: int | None = None, stored: bool = False) -> DataFrame:
        """The rows of the named parts, or all; the folders of others are not even listed.  ``stored`` keeps the column ``by``."""
        names = None if parts is None else {part_name(p) for p in parts}
        folders = [p.folder for p in self.parts(version) if names is None or p.part in names]
        return self._read_folders(folders, self.stored if stored else self.schema)

    # --- committing ---

    def commit(
        self,
        df: DataFrame | None,
        replace: Iterable[Any] | None = None,
        key: str | None = None,
        check: Callable[[DataFrame], None] | None = None,
        batch: str | None = None,
        unique: bool = False,
        rebalance: bool = True,
    ) -> list[Part]:
        """Write the rows of ``df`` and make them current instead of the parts in ``replace``; returns the folders written.

        ``replace`` are parts that ``df`` holds whole, those that end included; None is the whole table, ``()`` none, which appends.
        ``check`` gets the written rows before they are current; if it raises, they never are.  ``key`` is the
        column whose range a folder's manifest row keeps; with ``unique`` a key that is written twice, or that
        a folder which stays holds already, ends the commit.  ``batch`` names what brought the rows.
        """
        current = self._current()
        version, high_water = (current.version, current.high_water) if current else (0, 0)
        gone = None if replace is None else {part_name(p) for p in replace}
        kept = [] if gone is None else [p for p in self.parts(version) if p.part not in gone]
        written: list[Part] = []
        if df is not None:
            written = self._write(df, version + 1, key, rebalance)
            rows = self._read_folders([p.folder for p in written], self.stored)
            if unique and key is not None:
                self._refuse_repeated(rows, written, kept, key)
            if check is not None:
                check(rows.select(*[f"`{c}`" for c in self.schema.names]))
        high_water = max([high_water, *(p.high for p in written if p.high is not None)])
        manifest = self.spark.createDataFrame([tuple(p) for p in [*kept, *written]], MANIFEST)
        manifest.coalesce(1).write.mode("overwrite").parquet(self._manifest(version + 1))
        row = self.spark.createDataFrame([(version + 1, high_water, batch)], COMMITS)
        row.coalesce(1).write.mode("append").parquet(f"{self.root}/commits")
        return written

    def _write(self, df: DataFrame, version: int, key: str | None, rebalance: bool) -> list[Part]:
        folder = f"version={version:08d}"
        rows = df.select(*[F.col(f.name).cast(f.dataType) for f in self.stored])
        writer_rows = rows
        if self.by is not None and rebalance:  # whole files a part; a large part is split over several tasks
            writer_rows = rows.hint("rebalance", self.by.name)
        writer = writer_rows.write.mode("overwrite")
        if self.by is not None:
            writer = writer.partitionBy(self.by.name)
        writer.parquet(f"{self.root}/data/{folder}")
        written = self.spark.read.schema(self.stored).parquet(f"{self.root}/data/{folder}")
        ends = (F.min(key), F.max(key)) if key is not None else (F.lit(None), F.lit(None))
        of_part = [self.by.name] if self.by is not None else []
        found = written.groupBy(*of_part).agg(
            F.count("*").alias("n"), row_digest(self.schema.names).alias("d"), *[e.cast("bigint").alias(n) for e, n in zip(ends, ("low", "high"), strict=True)]
        )
        out = []
        for r in found.where("n > 0").collect():
            name = part_name(r[self.by.name]) if self.by is not None else ""
            out.append(Part(name, f"{folder}/{self.by.name}={name}" if name else folder, r.n, r.d, r.low, r.high))
        return sorted(out)

    @staticmethod
    def overlapping(written: Sequence[Part], kept: Sequence[Part]) -> list[Part]:
        """Folders that stay and whose key range meets that of any written one."""
        ranges = [(p.low, p.high) for p in written if p.low is not None]
        return [p for p in kept if p.low is not None and any(p.low <= high and low <= p.high for low, high in ranges)]

    def _refuse_repeated(self, rows: DataFrame, written: Sequence[Part], kept: Sequence[Part], key: str) -> None:
        """Only the written rows are grouped; of the others those folders are read whose key range overlaps."""
        counted = rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n"))
        twice = counted.where("n > 1").select(key)
        near = self.overlapping(written, kept)
        if near:
            twice = twice.unionByName(counted.select(key).join(self._read_folders([p.folder for p in near], self.stored).select(key), key, "left_semi"))
        example = twice.first()
        if example is not None:
            raise RepeatedKey(f"{key} {example[0]} stands more than once")

    # --- old versions ---

    def retire(self, keep: int = 1) -> int:
        """Delete what only versions before the last ``keep`` name; returns the folders deleted.

        Readers of older versions must have ended.
        """
        newest = self.version
        stay = range(max(1, newest - keep + 1), newest + 1)
        named = {p.folder for v in stay for p in self.parts(v)}
        deleted: set[str] = set()
        for v in range(1, stay.start):
            if not path_exists(self.spark, self._manifest(v)):
                continue
            for p in self.parts(v):
                if p.folder not in named and p.folder not in deleted:
                    delete_path(self.spark, f"{self.root}/data/{p.folder}")
                    deleted.add(p.folder)
            delete_path(self.spark, self._manifest(v))
        return len(deleted)
