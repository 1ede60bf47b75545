"""Nearest neighbours by a forest of sorted hash strings, searched by longest common prefix."""

from __future__ import annotations

from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starward.llm.common import text_column
from starward.sources.scratch import staged

NEAREST = 20
TREES = 64
#: Bits of a hash string.
BITS = 32
#: Part of a block's vectors that a query gathers before it stops ascending.  Vectors without any clusters
#: need this much for nine in ten of the true neighbours; clustered ones would do with less.
SHARE = 0.45
#: Vectors that one forest holds, and queries that visit it together.
BLOCK_ROWS = 16_384
QUERY_ROWS = 2_048
SEED = 7
FOUND = "query_id bigint, vec_id bigint, score double"


class Forest:
    """``trees`` sorted arrays of hash strings over distinct vectors.

    A string's bits are the sides of random planes.  Vectors get one more coordinate that makes them equally
    long, and queries a zero there, so that a small angle means a large inner product.
    """

    def __init__(self, vectors: np.ndarray, longest: float, trees: int = TREES, bits: int = BITS):
        self.vectors, self.trees, self.bits = vectors, trees, bits
        rest = np.sqrt(np.maximum(longest**2 - np.einsum("ij,ij->i", vectors, vectors), 0))
        rng = np.random.default_rng(SEED)
        self.planes = rng.standard_normal((vectors.shape[1] + 1, trees * bits)).astype(np.float32)
        hashes = self._hash(np.column_stack((vectors, rest)))
        self.order = np.argsort(hashes, axis=0).T.astype(np.int32)
        self.sorted = np.ascontiguousarray(np.sort(hashes, axis=0).T)

    def _hash(self, points: np.ndarray) -> np.ndarray:
        """(points, trees) strings as numbers, first bit highest."""
        places = np.uint64(1) << np.arange(self.bits, dtype=np.uint64)[::-1]
        out = np.empty((len(points), self.trees), np.uint64)
        for i in range(0, len(points), 2048):
            sides = points[i : i + 2048].astype(np.float32) @ self.planes > 0
            out[i : i + 2048] = sides.reshape(-1, self.trees, self.bits) @ places
        return out

    def _longest(self, strings: np.ndarray) -> np.ndarray:
        """Length of each query's longest prefix match in any tree: descend to where its string would stand."""
        best = np.zeros(len(strings), np.int64)
        for t in range(self.trees):
            at = np.searchsorted(self.sorted[t], strings[:, t])
            for side in (at - 1, at):
                other = self.sorted[t][np.clip(side, 0, self.sorted.shape[1] - 1)] ^ strings[:, t]
                best = np.maximum(best, self.bits - np.ceil(np.log2(other.astype(np.float64) + 1)).astype(np.int64))
        return best

    def candidates(self, queries: np.ndarray, least: int):
        """``(query, vectors)`` for each query: all that share the longest prefixes with it in any tree.

        All trees ascend together, one bit at a time, until ``least`` different vectors are found.
        """
        strings = self._hash(np.column_stack((queries, np.zeros(len(queries)))))
        start = self._longest(strings)
        waiting = np.ones(len(queries), bool)
        for length in range(self.bits, -1, -1):
            active = np.flatnonzero(waiting & (start >= length))
            if not len(active):
                continue
            shift = np.uint64(self.bits - length)
            low = (strings[active] >> shift) << shift
            high = low + (np.uint64(1) << shift)
            lo = np.array([np.searchsorted(self.sorted[t], low[:, t]) for t in range(self.trees)])
            hi = np.array([np.searchsorted(self.sorted[t], high[:, t]) for t in range(self.trees)])
            enough = (hi - lo).sum(axis=0) >= least
            for i in np.flatnonzero(enough | (length == 0)).tolist():
                found = np.zeros(len(self.vectors), bool)
                for t, (a, b) in enumerate(zip(lo[:, i].tolist(), hi[:, i].tolist(), strict=True)):
                    found[self.order[t, a:b]] = True
                which = np.flatnonzero(found)
                if len(which) >= least or length == 0:
                    waiting[active[i]] = False
                    yield active[i], which


def search_block(ids: np.ndarray, vectors: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, longest: float, k: int, share: float, trees: int):
    """The nearest ``k`` that each query finds in one block: query ids, ids, scores.

    Equal vectors are one entry with their smallest ids, of which no more than k + 1 can be needed.
    """
    order = np.argsort(ids, kind="stable")
    ids, vectors = ids[order], np.ascontiguousarray(vectors[order])
    _, first, which = np.unique(vectors.view(np.dtype((np.void, vectors.itemsize * vectors.shape[1]))).ravel(), return_index=True, return_inverse=True)
    distinct = vectors[first]
    by = np.argsort(which, kind="stable")
    starts = np.concatenate(([0], np.cumsum(np.bincount(which, minlength=len(distinct)))))
    forest = Forest(distinct, longest, trees)
    least = min(len(distinct), max(4 * k, ceil(share * len(distinct))))
    out: list[tuple[int, int, float]] = []
    for q, near in forest.candidates(queries, least):
        scores = distinct[near] @ queries[q]
        if len(near) > k + 1:
            edge = np.partition(scores, len(scores) - k - 1)[len(scores) - k - 1]
            near = near[scores >= edge - 1e-9 * (1 + abs(edge))]
        exact = (distinct[near] * queries[q]).sum(axis=1)  # the same for a vector wherever it stands
        rows = [
            (-s, i)
            for v, s in zip(near.tolist(), exact.tolist(), strict=True)
            for i in ids[by[starts[v] : min(starts[v] + k + 1, starts[v + 1])]].tolist()
            if i != query_ids[q]
        ]
        out.extend((int(query_ids[q]), i, -s) for s, i in sorted(rows)[:k])
    return out


def usable(df: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """``id, v``: rows that take part, once for each id, with the smallest vector if there are several."""
    v = text_column(df, vector).cast("array<double>")
    rows = df.select(text_column(df, vec_id).cast("bigint").alias("id"), v.alias("v"))
    fit = rows.where(
        "id IS NOT NULL AND v IS NOT NULL AND size(v) > 0 AND forall(v, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('Infinity')) "
        "AND exists(v, x -> x != 0)"
    )
    return fit.groupBy("id").agg(F.min("v").alias("v"))


def nearest(
    df: DataFrame,
    k: int = NEAREST,
    every: int = 20,
    share: float = SHARE,
    trees: int = TREES,
    block_rows: int = BLOCK_ROWS,
    query_rows: int = QUERY_ROWS,
    vec_id: str = "vec_id",
    vector: str = "embedding",
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` largest inner products found for each id divisible by ``every``.

    Vectors are dealt into blocks of about ``block_rows`` by their id's hash, queries into sets of about
    ``query_rows``, and every set visits every block, whose forest gives the candidates; these are scored exactly, in
    double precision.  A query's best of each block meet in a limited ranking.  Each task holds one block and one
    set, whatever the table's size.  Work is that of the queries times a part of the rows.

    Null, zero and unusual vectors take no part, nor do null ids and vectors of another length than most.  Equal scores
    go to the smaller id.  Rows of one id count once, with the smallest vector.  Fewer than ``k`` others give fewer rows.  An
    empty table gives none.  Further columns are ignored.
    """
    rows = staged(usable(df, vec_id, vector), "vectors")
    shape = rows.groupBy(F.size("v").alias("size")).agg(F.count("*").alias("n"), F.max(F.expr("aggregate(v, 0D, (s, x) -> s + x * x)")).alias("longest"))
    most = shape.orderBy(F.desc("n"), "size").limit(1).first()
    if most is None:
        return rows.sparkSession.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    longest = float(most["longest"]) ** 0.5
    rows = rows.where(F.size("v") == most["size"])
    asked = rows.where(F.col("id") % every == 0)
    blocks, sets = max(1, ceil(most["n"] / block_rows)), max(1, ceil(most["n"] / every / query_rows))

    def cell(frame: DataFrame, own: str, other: str, salt: int, own_count: int, other_count: int) -> DataFrame:
        mine = F.pmod(F.xxhash64("id", F.lit(salt)), F.lit(own_count)).cast("int").alias(own)
        each = F.explode(F.sequence(F.lit(0), F.lit(other_count - 1))).alias(other)
        return frame.select("id", "v", mine, each)

    index = cell(rows, "block", "part", 1, blocks, sets).groupBy("block", "part")
    queries = cell(asked, "block", "part", 2, sets, blocks)
    queries = queries.select("id", "v", F.col("block").alias("part"), F.col("part").alias("block")).groupBy("block", "part")

    def visit(held: pa.Table, asking: pa.Table) -> pa.Table:
        found: list[tuple[int, int, float]] = []
        if held.num_rows and asking.num_rows:
            (ids, vectors), (query_ids, points) = (
                (t["id"].to_numpy(), t["v"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(t.num_rows, -1)) for t in (held, asking)
            )
            found = search_block(ids, vectors, query_ids, points, longest, k, share, trees)
        columns = list(zip(*found, strict=True)) or [(), (), ()]
        kinds = (pa.int64(), pa.int64(), pa.float64())
        return pa.table([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["query_id", "vec_id", "score"])

    found = index.cogroup(queries).applyInArrow(visit, FOUND)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
