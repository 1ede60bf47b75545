"""SimHash near-duplicates by meeting in the middle of Hamming balls."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starward.llm.common import fresh, size_blocks, text_column, texts_of
from starward.llm.components import connected_components
from starward.sources.scratch import staged

SHINGLE_WORDS = 3
SEED = 42
#: Text bytes that one step works on.
BLOCK = 2 << 20
#: Shingles whose bits are counted in one step.
_STEP = 1 << 16


def shingle_hashes(text: bytes, words: int = SHINGLE_WORDS) -> np.ndarray:
    """XXH64 of each shingle, repeats included.

    Only A-Z are lower-cased.  Fewer words than a shingle has make one shingle; none give no hash.
    """
    parts = text.lower().split()
    joined = b" ".join(parts)
    digest = xxhash.xxh64_intdigest
    if len(parts) <= words:
        return np.array([digest(joined, SEED)] if parts else [], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = len(parts) - words + 1
    spans = zip(starts[:n].tolist(), ends[words - 1 :].tolist(), strict=True)
    return np.fromiter((digest(joined[s:e], SEED) for s, e in spans), np.uint64, n)


def majority(hashes: np.ndarray) -> np.uint64:
    """The bits that are set in over half of the hashes."""
    n, counts = len(hashes), np.zeros(64, np.int64)
    for i in range(0, n, _STEP):
        step = hashes[i : i + _STEP]
        counts += np.unpackbits(step.view(np.uint8)).reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return np.packbits(2 * counts > n).view(np.uint64)[0]


def fingerprint_of(text: bytes, words: int = SHINGLE_WORDS) -> np.uint64:
    """SimHash of one text: a bit is set if it is set in over half of the shingles' hashes; zero without words."""
    return majority(shingle_hashes(text, words))


def fingerprint(text: Column, words: int = SHINGLE_WORDS) -> Column:
    """Fingerprint of a text column as a signed long with the same 64 bits; null counts as empty."""

    @F.arrow_udf("bigint")
    def simhash(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for (block,) in size_blocks(((b,) for b in batches), BLOCK):
            prints = np.array([fingerprint_of(t, words) for t in texts_of(block)], np.uint64)
            yield pa.array(prints.view(np.int64))

    return simhash.asNondeterministic()(text)


def links(prints: DataFrame, radius: int = 2) -> DataFrame:
    """Edges ``(a, b)`` that connect whatever fingerprints ``fp`` lie within ``radius`` bits.

    Every distinct fingerprint is emitted under all values within half the radius of it, and the
    shuffle on those values brings together all pairs within the radius.  A value's members differ
    from it by at most one bit, so a group is two numbers, a mask of flipped bits and whether the
    value itself is a member: its size is fixed (65 at most) and it is gathered by a plain
    aggregate.  Members of a group hang on its smallest, since any two of them are linked.
    ``radius`` is 2: the variants are those of one bit.
    """
    if radius != 2:
        raise ValueError("the ball of half the radius is written out for a radius of 2")
    flips = F.expr("transform(sequence(0, 63), i -> named_struct('v', fp ^ shiftleft(1L, i), 'm', shiftleft(1L, i)))")
    own = F.expr("array(named_struct('v', fp, 'm', 0L))")
    tasks = int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # each row becomes 65
    # By another hash than the distinct's own, or Spark would drop this step and join its few bytes to one or two tasks.
    spread = prints.select("fp").distinct().repartition(tasks, F.xxhash64("fp"))
    emitted = spread.select(F.inline(F.concat(own, flips)))
    met = (
        emitted.groupBy("v")
        .agg(F.bit_or("m").alias("m"), F.max(F.col("m") == 0).alias("own"))
        .where(F.bit_count("m") + F.col("own").cast("int") > 1)
    )
    members = F.expr(
        "concat(IF(own, array(v), array()), transform(filter(sequence(0, 63), "
        "i -> (m & shiftleft(1L, i)) != 0L), i -> v ^ shiftleft(1L, i)))"
    )
    pairs = met.select(members.alias("s")).select(F.explode("s").alias("a"), F.array_min("s").alias("b"))
    return pairs.where((F.col("a") != F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius)).distinct()


def rooted(prints: DataFrame, radius: int) -> DataFrame:
    """``fp, root``: the component of each distinct fingerprint, named by its smallest one."""
    roots = connected_components(links(prints, radius)).withColumnRenamed("node", "fp")
    return prints.select("fp").distinct().join(roots, "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"))


def near_duplicates(df: DataFrame, doc_id: str = "doc_id", text: str = "text", radius: int = 2) -> DataFrame:
    """``doc_id, fingerprint, component_id``, a row for each row of ``df``.

    Rows whose fingerprints differ by at most ``radius`` bits are linked, and what is linked over
    others too is one component.  Its id is the smallest doc_id in it.

    Null and white-space texts have fingerprint zero and are linked like any others.  Null ids take
    part but name no component; where all ids are null, so is the component's.  Repeated rows give
    repeated rows.  An empty table gives none.  Further columns are ignored.
    """
    prints = staged(
        df.select(text_column(df, doc_id).alias("doc_id"), fingerprint(text_column(df, text)).alias("fp")), "prints"
    )
    ids = _least_of_component(prints, F.col("doc_id"), radius).withColumnRenamed("least", "component_id")
    shown = F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint")
    return prints.join(ids, "fp").select("doc_id", shown, "component_id")


def _least_of_component(prints: DataFrame, value: Column, radius: int) -> DataFrame:
    """``fp, least``: the smallest ``value`` among all rows of a fingerprint's component; summed by fingerprint first."""
    nodes = prints.groupBy("fp").agg(F.min(value).alias("first"))
    members = nodes.join(rooted(prints, radius), "fp")
    least = members.groupBy("root").agg(F.min("first").alias("least"))
    return members.join(least, "root").select("fp", "least")


def one_of_each(df: DataFrame, doc_id: str = "doc_id", text: str = "text", radius: int = 2) -> DataFrame:
    """One row of ``df`` for each component of ``near_duplicates``; all columns stay.

    The row with the smallest id stays; a missing id is the largest.  Rows of one id with different texts are judged each by itself, and
    of several rows with the smallest id that differ in any column the one with the smallest hash stays.  Equal rows leave one.
    """
    missing = F.array(*[F.col(f"`{c}`").isNull() for c in df.columns])
    row = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns], missing)
    key = text_column(df, doc_id)
    prints = staged(df.select(key.alias("doc_id"), row.alias("row"), fingerprint(text_column(df, text)).alias("fp")), "prints")
    place = F.struct(F.col("doc_id").isNull().alias("missing"), F.col("doc_id"), F.col("row"))
    judged = prints.withColumn("place", place).join(_least_of_component(prints, place, radius), "fp")
    counted = staged(
        judged.groupBy("doc_id", "row").agg(F.max(F.col("place") == F.col("least")).alias("stays"), F.count("*").alias("n")).where("NOT stays OR n > 1"),
        "dropped",
    )
    mine, other = fresh(df, "drop_id"), fresh(df, "drop_row")

    def rows(which: str) -> DataFrame:
        return counted.where(which).select(F.col("doc_id").alias(mine), F.col("row").alias(other))

    def among(which: str, how: str) -> DataFrame:
        return df.join(rows(which), key.eqNullSafe(F.col(mine)) & (row == F.col(other)), how)

    kept = among("true", "left_anti")
    repeated = "stays AND n > 1"
    if counted.where(repeated).isEmpty():
        return kept
    return kept.unionByName(among(repeated, "left_semi").dropDuplicates())
