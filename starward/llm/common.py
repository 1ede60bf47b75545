"""What several operators share: tables, word splitting, byte-bounded Arrow blocks."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starward.sources.scratch import scratch_path

#: A word is a run of characters other than the six ASCII white-space characters, which are also
#: those that ``bytes.split()`` splits at.
WORD = r"[^\x20\x09-\x0D]+"
#: Rows in one Arrow batch.  Texts may be long, and Spark bounds batches by rows only.
BATCH_ROWS = 1000
#: Text bytes that one vectorised step works on.
BLOCK_BYTES = 8 << 20


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return prepared(spark).read.parquet(f"{folder}/{name}.parquet")


def prepared(spark: SparkSession) -> SparkSession:
    """The session, ready for this package's Arrow functions: small batches, and the code on every executor."""
    ship_code(spark)
    return small_batches(spark)


def ship_code(spark: SparkSession) -> None:
    """Give the executors this library, once for each context, as an archive in the shared scratch folder."""
    context = spark.sparkContext
    if getattr(context, "_starward_code", None):
        return
    root = Path(__file__).resolve().parent.parent
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w") as archive:
        for file in sorted(root.rglob("*.py")):
            archive.writestr(str(file.relative_to(root.parent)), file.read_bytes())
    name = scratch_path(spark, "code") + ".zip"
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    out = path.getFileSystem(spark._jsc.hadoopConfiguration()).create(path)
    out.write(bytearray(packed.getvalue()))
    out.close()
    context.addPyFile(name)
    context._starward_code = name


def small_batches(spark: SparkSession) -> SparkSession:
    """Keep Arrow batches small on this session; it has to hold until the frame has run."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark


def size_blocks(arrays: Iterable[tuple[pa.Array, ...]], limit: int = BLOCK_BYTES) -> Iterator[tuple[pa.Array, ...]]:
    """Regroup batches of columns, the first of them the text, into blocks of about ``limit`` text bytes.

    Order and total length stay.  A text that alone is larger is a block of its own.
    """
    held: list[tuple[pa.Array, ...]] = []
    held_bytes = 0

    def joined():
        return tuple(pa.concat_arrays(list(parts)) for parts in zip(*held, strict=True))

    for columns in arrays:
        sizes = pc.fill_null(pc.binary_length(columns[0]), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        start = 0
        while start < len(sizes):
            ends = np.cumsum(sizes[start:]) + held_bytes
            n = int(np.searchsorted(ends, limit, side="left")) + 1
            if n > 1 and n <= len(ends) and ends[n - 1] > 2 * limit:
                n -= 1  # the last one is very long and gets a block of its own
            n = min(n, len(ends))
            held.append(tuple(c.slice(start, n) for c in columns))
            held_bytes = int(ends[n - 1])
            start += n
            if held_bytes >= limit or start < len(sizes):
                yield joined()
                held, held_bytes = [], 0
    if held:
        yield joined()


def texts_of(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of each text, empty for null."""
    return [b"" if x is None else x for x in column.cast(pa.binary()).to_pylist()]


def text_column(df: DataFrame, name: str = "text") -> Column:
    """A column by name, dots and all."""
    return F.col(f"`{name}`")


def fresh(df: DataFrame, name: str) -> str:
    """``name``, with underscores before it until no column of ``df`` has it (compared as Spark does)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def arrow_type(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)
