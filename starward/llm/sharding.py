"""Shards of near-equal bytes: the leaves of a k-d tree over what is known of each row."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starward.llm.common import text_column
from starward.llm.numbering import places
from starward.sources.scratch import staged

SHARDS = 16
#: Bars of one histogram; each pass narrows a cut's range by this factor.
BARS = 4096
#: Share of a shard's bytes by which a cut may miss so that a group of equal texts stays together.
SLACK = 0.002
#: Levels of the tree after which the rows' nodes are written rather than worked out again.
LEVELS_AT_ONCE = 5


@dataclass
class Node:
    """``leaves`` shards from number ``first`` on."""

    first: int
    leaves: int


@dataclass
class Cut:
    """Rows with a smaller key go left, as do those with this key and a smaller tie."""

    dim: str
    key: int
    tie: int = 0

    def left(self) -> Column:
        key = F.col(self.dim)
        return (key < self.key) | ((key == self.key) & (F.col("tie") < self.tie))


def kd_shards(rows: DataFrame, dims: list[str], shards: int = SHARDS, slack: float = SLACK) -> DataFrame:
    """Add ``shard`` to rows with ``size``, ``tie`` and the given dimensions, all non-negative longs.

    A node of n shards is split along its widest dimension (its extent over the table's extent) so that its
    halves hold bytes in the ratio of their shards.  The weighted median is found for all nodes of a level
    together, by histograms over ever narrower ranges: a pass gives the driver ``BARS`` sums for each node,
    whatever the rows.  Rows of equal key stay together unless the cut would miss by more than ``slack`` of a
    shard; then their ties split them.
    """
    total = rows.agg(F.sum("size")).first()[0] or 0
    slack_bytes = slack * total / shards
    nodes = {0: Node(0, shards)}
    placed, level = rows.withColumn("shard", F.lit(0)), 0
    spans: dict[str, int] = {}
    while open_nodes := {k: n for k, n in nodes.items() if n.leaves > 1}:
        extremes = [f(d).alias(f"{name}_{d}") for d in dims for name, f in (("lo", F.min), ("hi", F.max))]
        found = placed.groupBy("shard").agg(F.sum("size").alias("bytes"), *extremes).collect()  # a row a node
        bounds = {r["shard"]: r for r in found if r["shard"] in open_nodes}
        if not spans:
            spans = {d: max([1, *(r[f"hi_{d}"] - r[f"lo_{d}"] for r in found)]) for d in dims}
        cuts = _cuts(placed, open_nodes, bounds, spans, slack_bytes)
        number, nodes = F.col("shard"), {k: n for k, n in nodes.items() if n.leaves == 1}
        for k, node in open_nodes.items():
            half = node.leaves // 2
            nodes[k] = Node(node.first, half)
            nodes[k + half] = Node(node.first + half, node.leaves - half)
            if k in cuts:
                number = F.when((F.col("shard") == k) & ~cuts[k].left(), k + half).otherwise(number)
        placed = placed.withColumn("shard", number)
        level += 1
        if level % LEVELS_AT_ONCE == 0:
            placed = staged(placed, "nodes")
    return placed


def _cuts(placed: DataFrame, nodes: dict, bounds: dict, spans: dict[str, int], slack: float) -> dict[int, Cut]:
    """The cut of each node that has rows."""
    goal = {k: r["bytes"] * (nodes[k].leaves // 2) / nodes[k].leaves for k, r in bounds.items()}
    cuts, ranges, below = {}, {}, dict.fromkeys(bounds, 0)
    for k, r in bounds.items():
        dim = max(spans, key=lambda d: (r[f"hi_{d}"] - r[f"lo_{d}"]) / spans[d])
        cuts[k] = Cut(dim, r[f"lo_{dim}"])
        ranges[k] = (r[f"lo_{dim}"], r[f"hi_{dim}"])
    _narrow(placed, cuts, ranges, below, goal, slack, by_tie=False)
    if ranges:  # one key alone outweighs the slack
        ranges = dict.fromkeys(ranges, (0, (1 << 63) - 1))
        _narrow(placed, cuts, ranges, below, goal, slack, by_tie=True)
    return cuts


def _narrow(placed, cuts, ranges, below, goal, slack, by_tie: bool) -> None:
    """Narrow each range until its cut is settled, and take it out; one key that is too heavy stays in."""
    while active := {k: r for k, r in ranges.items() if by_tie or r[0] <= r[1]}:
        bar = F.lit(None).cast("bigint")
        for k, (lo, hi) in active.items():
            width = -(-(hi - lo + 1) // BARS)
            value = F.col("tie") if by_tie else F.col(cuts[k].dim)
            inside = (F.col("shard") == k) & value.between(lo, hi)
            if by_tie:
                inside &= F.col(cuts[k].dim) == cuts[k].key
            bar = F.when(inside, F.call_function("div", value - lo, F.lit(width).cast("bigint"))).otherwise(bar)
        sums: dict[int, list] = {k: [] for k in active}
        framed = placed.select("shard", "size", bar.alias("bar")).where("bar IS NOT NULL")
        for r in framed.groupBy("shard", "bar").agg(F.sum("size").alias("bytes")).collect():  # BARS a node
            sums[r["shard"]].append((r["bar"], r["bytes"]))
        for k, (lo, hi) in active.items():
            width, under, edge = -(-(hi - lo + 1) // BARS), below[k], hi + 1
            for number, weight in sorted(sums[k]):
                if under + weight >= goal[k]:
                    edge = lo + number * width
                    break
                under += weight
            else:
                weight = 0
            after = min(edge + width, hi + 1)
            if weight <= slack or (width == 1 and by_tie):
                at = edge if goal[k] - under <= under + weight - goal[k] else after
                if by_tie:
                    cuts[k].tie = at
                else:
                    cuts[k].key = at
                del ranges[k]
            else:
                below[k] = under
                if width == 1:
                    cuts[k].key = edge
                    ranges[k] = (1, 0)  # done here; its ties come next
                else:
                    ranges[k] = (edge, after - 1)


def shard_documents(df: DataFrame, shards: int = SHARDS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard``; the law is ``bytes``.

    The dimensions are bytes, characters and checksum of a text: what is known of it without its neighbours.
    Each is extended by the checksum, so equal texts are one point of the tree and share a shard unless
    that would upset the balance; a text that fills more than a shard's slack with its copies is split by id.
    Slots follow the id.

    Null texts count as empty: size 1, checksum 0.  Null ids and repeated rows are placed like others;
    rows with one id and one text can't be told apart and share a shard.  An empty table gives no rows.
    Further columns are ignored.
    """
    body = F.coalesce(text_column(df, text), F.lit(""))
    crc = F.crc32(body.cast("binary"))
    low = F.lit(1 << 31)
    known = df.select(
        text_column(df, doc_id).alias("doc_id"),
        (F.octet_length(body) + F.lit(1).cast("bigint")).alias("size"),
        F.char_length(body).cast("bigint").alias("chars"),
        crc.alias("text_crc32"),
        F.shiftrightunsigned(F.xxhash64(text_column(df, doc_id)), 1).alias("tie"),
    )
    near = F.shiftright("text_crc32", 1)
    rows = staged(
        known.select(
            "doc_id",
            "size",
            "text_crc32",
            "tie",
            (F.col("size") * low + near).alias("by_bytes"),
            (F.col("chars") * low + near).alias("by_chars"),
            F.col("text_crc32").alias("by_sum"),
        ),
        "sizes",
    )
    placed = staged(kd_shards(rows, ["by_bytes", "by_chars", "by_sum"], shards).select("doc_id", "size", "text_crc32", "shard"), "shards")
    counts = {r["shard"]: r["count"] for r in placed.groupBy("shard").count().collect()}  # a row a shard
    return places(placed, "shard", ["doc_id"], counts, "slot").select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        F.col("shard").cast("int"),
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
