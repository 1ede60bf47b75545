"""Packing into length buckets whose boundaries cost the least padding."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starward.llm.common import WORD, text_column
from starward.llm.numbering import places
from starward.sources.scratch import staged

BUCKETS = 8
MAX_LENGTH = 2048
TOKEN_BUDGET = 16_384


def best_boundaries(lengths: np.ndarray, counts: np.ndarray, buckets: int) -> list[int]:
    """Ascending bucket lengths, at most ``buckets``, for which padding is least.

    ``cost[j]`` is what the first j lengths take up in the buckets so far; the last bucket reaches
    from i to j and pads all to length j.  Equal costs go to the smaller i.
    """
    if not len(lengths):
        return []
    size = np.concatenate(([0], lengths)).astype(np.int64)
    total = np.concatenate(([0], np.cumsum(counts))).astype(np.int64)
    far = np.iinfo(np.int64).max
    cost, last = np.full(len(size), far), []
    cost[0] = 0
    for _ in range(buckets):
        new, chosen = np.empty_like(cost), np.zeros(len(size), np.int64)
        for j in range(len(size)):
            reach = cost[: j + 1]
            each = np.where(reach == far, far, reach + np.where(reach == far, 0, size[j] * (total[j] - total[: j + 1])))
            chosen[j] = int(each.argmin())
            new[j] = each[chosen[j]]
        cost = new
        last.append(chosen)
    j, ends = len(size) - 1, set()
    for chosen in reversed(last):
        if j:
            ends.add(int(size[j]))
        j = int(chosen[j])
    return sorted(ends)


def pieces(df: DataFrame, max_length: int = MAX_LENGTH, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, piece, start, length``: each text's words and one end mark, in pieces of at most ``max_length``."""
    n = F.regexp_count(F.coalesce(text_column(df, text), F.lit("")), F.lit(WORD)).cast("bigint") + 1
    counted = df.select(text_column(df, doc_id).alias("doc_id"), n.alias("n"))
    last = F.expr(f"(n - 1) div {max_length}")
    cut = counted.select("doc_id", "n", F.explode(F.sequence(F.lit(0).cast("bigint"), last)).alias("piece"))
    start = F.col("piece") * max_length
    return cut.select("doc_id", "piece", start.alias("start"), F.least(F.col("n") - start, F.lit(max_length)).alias("length"))


def pack(
    df: DataFrame,
    buckets: int = BUCKETS,
    max_length: int = MAX_LENGTH,
    token_budget: int = TOKEN_BUDGET,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """``doc_id, piece, start, length, bucket, bucket_length, batch, slot, padding``: every word in one place.

    A text counts its words and one end mark; what is longer than ``max_length`` goes on in further
    pieces, so nothing is cut off.  The histogram has ``max_length`` rows at most; over it, dynamic
    programming finds the bucket lengths with the least padding.  Pieces of a bucket, ordered by length, id
    and piece, fill batches one after another; a batch holds as many as its token budget has room for at
    the bucket's length, and at least one.

    Null and empty texts are one piece of length 1.  Null ids come first within their length.  Repeated
    rows each get a place.  An empty table gives no rows.  Further columns are ignored.
    """
    cut = staged(pieces(df, max_length, doc_id, text), "pieces")
    rows = cut.groupBy("length").count().orderBy("length").collect()  # max_length rows at most
    lengths = np.array([r["length"] for r in rows], np.int64)
    counts = np.array([r["count"] for r in rows], np.int64)
    ends = best_boundaries(lengths, counts, buckets)

    number, reach = F.lit(0), F.lit(max_length)
    for k in reversed(range(len(ends))):
        number = F.when(F.col("length") <= ends[k], k).otherwise(number)
        reach = F.when(F.col("length") <= ends[k], ends[k]).otherwise(reach)
    bucketed = cut.withColumn("bucket", number.cast("int")).withColumn("bucket_length", reach.cast("bigint"))
    of = np.searchsorted(ends, lengths)
    sizes = {k: int(counts[of == k].sum()) for k in range(len(ends))}
    placed = places(bucketed, "bucket", ["length", "doc_id", "piece"], sizes, "place")
    room = F.greatest(F.lit(1), F.expr(f"{token_budget} div bucket_length"))
    return placed.select(
        "doc_id",
        "piece",
        "start",
        "length",
        "bucket",
        "bucket_length",
        F.floor(F.col("place") / room).alias("batch"),
        (F.col("place") % room).alias("slot"),
        (F.col("bucket_length") - F.col("length")).alias("padding"),
    )


def pack_sql(buckets: int = BUCKETS, max_length: int = MAX_LENGTH, token_budget: int = TOKEN_BUDGET) -> str:
    """The same in SQL, with one step of the dynamic program for each bucket."""
    steps = "".join(
        f""",
d{k} AS (
  SELECT j, cost, i FROM (
    SELECT b.j, a.cost + b.length * (b.total - s.total) AS cost, a.j AS i,
           row_number() OVER (PARTITION BY b.j ORDER BY a.cost + b.length * (b.total - s.total), a.j) AS best
    FROM d{k - 1} a JOIN s ON s.j = a.j JOIN s b ON b.j >= a.j) WHERE best = 1)"""
        for k in range(1, buckets + 1)
    )
    back = "".join(
        f""",
e{k} AS (SELECT d.i AS j FROM d{k + 1} d JOIN e{k + 1} e ON d.j = e.j)"""
        for k in range(buckets - 1, 0, -1)
    )
    every = " UNION ".join(f"SELECT j FROM e{k}" for k in range(1, buckets + 1))
    return f"""
WITH w AS (
  SELECT doc_id, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) + 1 AS n FROM documents),
p AS (
  SELECT doc_id, k AS piece, k * {max_length} AS start, least(n - k * {max_length}, {max_length}) AS length
  FROM (SELECT doc_id, n, unnest(range(0, (n - 1) // {max_length} + 1)) AS k FROM w)),
h AS (SELECT length, count(*) AS c FROM p GROUP BY length),
s AS (
  SELECT row_number() OVER (ORDER BY length) AS j, length, CAST(sum(c) OVER (ORDER BY length) AS BIGINT) AS total FROM h
  UNION ALL SELECT 0, 0, 0),
d0 AS (SELECT CAST(0 AS BIGINT) AS j, CAST(0 AS BIGINT) AS cost, CAST(0 AS BIGINT) AS i){steps},
e{buckets} AS (SELECT max(j) AS j FROM s){back},
ends AS (
  SELECT row_number() OVER (ORDER BY length) - 1 AS bucket, length AS bucket_length,
         coalesce(lag(length) OVER (ORDER BY length), 0) AS above
  FROM s WHERE j > 0 AND j IN ({every})),
placed AS (
  SELECT p.*, bucket, bucket_length,
         row_number() OVER (PARTITION BY bucket ORDER BY p.length, doc_id NULLS FIRST, piece) - 1 AS place,
         greatest(1, {token_budget} // bucket_length) AS room
  FROM p JOIN ends ON p.length > above AND p.length <= bucket_length)
SELECT doc_id, piece, start, length, CAST(bucket AS INTEGER) AS bucket, bucket_length,
       place // room AS batch, place % room AS slot, bucket_length - length AS padding
FROM placed"""
