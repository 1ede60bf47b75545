"""Bring counted rows back to one row per copy."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Copies one task writes for one chunk of a repeated row.
CHUNK = 10_000


def expand_copies(df: DataFrame, count: str, spread: bool = True, chunk: int = CHUNK) -> DataFrame:
    """Repeat each row ``count`` times and drop the count; rows with a count of 0 vanish.

    Rows that occur once, nearly all of them, pass straight through.  Repeated ones are cut into
    chunks and the chunks are spread over all tasks before they are unfolded, so a row with a
    billion copies is no single task's work.  That takes a second look at ``df``.

    ``spread=False`` unfolds in place, in one look: for rows known to occur once or a few times.
    """
    rows = [c for c in df.columns if c != count]
    if not spread:
        numbers = F.when(F.col(count) == 1, F.array(F.lit(1).cast("bigint"))).when(
            F.col(count) > 1, F.sequence(F.lit(1).cast("bigint"), F.col(count))
        )
        return df.withColumn("_copy", F.explode(numbers)).select(*rows)

    once = df.where(F.col(count) == 1).select(*rows)
    chunks = df.where(F.col(count) > 1).withColumn(
        "_chunk", F.explode(F.sequence(F.lit(0).cast("bigint"), F.expr(f"(`{count}` - 1) div {chunk}")))
    )
    spread_out = chunks.repartition("_chunk", *rows)
    size = F.least(F.lit(chunk).cast("bigint"), F.col(count) - F.col("_chunk") * chunk)
    many = spread_out.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), size)))
    return once.unionByName(many.select(*rows))
