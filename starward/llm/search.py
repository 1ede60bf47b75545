"""Ranked lexical search over a tree of the documents' term vectors."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starward.llm.common import text_column, texts_of
from starward.sources.scratch import staged

TOP = 10
#: Bytes of item texts that are sent to the executors at once; more items are searched in as many passes.
ITEM_BYTES = 8 << 20
#: Postings (a document and one of its terms) that one tree holds, which bounds a task's memory.
TREE_POSTINGS = 1 << 19
#: Documents up to which a subtree is a leaf, whose documents are scored together.
LEAF = 24
#: Bytes of a text that are split at once.
_PIECE = 4 << 20
#: Letters A-Z in lower case; ASCII characters other than letters and digits as spaces; the rest as it is.
_TERMS = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256)
)
_SCALE = 1_000_000_000


def terms_of(text: bytes) -> Counter:
    """Terms and their occurrences; a very long text is split in pieces that end between terms."""
    if len(text) <= _PIECE:
        return Counter(text.translate(_TERMS).split())
    found, plain, start = Counter(), text.translate(_TERMS), 0
    while start < len(plain):
        end = plain.find(b" ", start + _PIECE)
        end = len(plain) if end < 0 else end
        found.update(plain[start:end].split())
        start = end
    return found


# --- the tree -----------------------------------------------------------------------------------


@dataclass
class Tree:
    """Documents sorted by their vectors, and the subtrees over them.

    A subtree is a run of documents.  ``ids, shares`` list, term by term (``term_starts``), the subtrees that hold it, each with the
    most that an occurrence can be worth there: the largest tf under the smallest m.
    """

    starts: np.ndarray  # first posting of each document, and the end
    terms: np.ndarray
    values: np.ndarray  # of each posting: what a unit of weight earns
    children: list[np.ndarray]  # of each subtree; none for a leaf
    begins: np.ndarray
    ends: np.ndarray
    term_starts: np.ndarray
    ids: np.ndarray
    shares: np.ndarray


def earned(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return (_SCALE * tf) // (1000 * tf + 8 * m)


def shared_prefixes(starts: np.ndarray, terms: np.ndarray) -> np.ndarray:
    """For each document, how many leading terms it has in common with the one before."""
    n = len(starts) - 1
    sizes = np.diff(starts)
    out, alive = np.zeros(n, np.int64), np.arange(1, n)
    depth = 0
    while len(alive):
        longer = (sizes[alive] > depth) & (sizes[alive - 1] > depth)
        alive = alive[longer]
        alive = alive[terms[starts[alive] + depth] == terms[starts[alive - 1] + depth]]
        out[alive] += 1
        depth += 1
    return out


def tree_of(starts: np.ndarray, terms: np.ndarray, tf: np.ndarray, m: np.ndarray, n_terms: int) -> Tree:
    """The tree over documents whose vectors (terms in ascending rank) are sorted.

    Documents below a node share a path.  A subtree of more than ``LEAF`` documents branches where their paths part; branches that
    are small share a leaf with their neighbours.
    """
    n = len(starts) - 1
    common = shared_prefixes(starts, terms)
    begins, ends, children = [0], [n], [np.zeros(0, np.int64)]
    pending = [0]
    while pending:
        node = pending.pop()
        a, b = begins[node], ends[node]
        if b - a <= LEAF:
            continue
        inner = common[a + 1 : b]
        cuts = np.flatnonzero(inner == inner.min()) + a + 1
        bounds = [a]
        for x, y in zip(cuts.tolist(), [*cuts[1:].tolist(), b], strict=True):
            # a branch ends at x; the next one goes on to y
            if y - bounds[-1] > LEAF and x > bounds[-1]:
                bounds.append(x)
        bounds.append(b)
        mine = np.arange(len(begins), len(begins) + len(bounds) - 1)
        children[node] = mine
        begins += bounds[:-1]
        ends += bounds[1:]
        children += [np.zeros(0, np.int64)] * len(mine)
        pending += mine.tolist()
    first, last = np.array(begins), np.array(ends)
    # Every document's postings under each subtree over it: largest tf by subtree and term.
    nodes, of_term, largest = [], [], []
    least = np.minimum.reduceat(np.append(m, 0), np.column_stack((first, last)).ravel())[::2] if n else np.zeros(1, np.int64)
    for node, (a, b) in enumerate(zip(begins, ends, strict=True)):
        if a == b:
            continue
        t, f = terms[starts[a] : starts[b]], tf[starts[a] : starts[b]]
        order = np.argsort(t, kind="stable")
        t, f = t[order], f[order]
        at = np.flatnonzero(np.append(True, t[1:] != t[:-1])) if len(t) else np.zeros(0, np.int64)
        nodes.append(np.full(len(at), node))
        of_term.append(t[at])
        largest.append(np.maximum.reduceat(f, at) if len(at) else f)
    none = np.zeros(0, np.int64)
    ids, of_term, largest = (np.concatenate(x) if x else none for x in (nodes, of_term, largest))
    order = np.argsort(of_term, kind="stable")
    ids = ids[order]
    return Tree(
        starts, terms, earned(tf, np.repeat(m, np.diff(starts))), children, first, last,
        np.searchsorted(of_term[order], np.arange(n_terms + 1)), ids, earned(largest[order], least[ids]) if len(ids) else none,
    )


def best_of(tree: Tree, terms: np.ndarray, weights: np.ndarray, ids: list, weight_of: np.ndarray, top: int = TOP) -> list[tuple[int, int]]:
    """``(score, document)`` of the item's best documents in the tree, best first; equal scores by ``ids``.

    Depth first, the better branch first; a branch is left out if the most that any document in it
    can score is below the worst of a full list.  ``weight_of`` is zero and is left zero.
    """
    bound = np.zeros(len(tree.begins), np.int64)
    for t, w in zip(terms.tolist(), weights.tolist(), strict=True):
        a, b = tree.term_starts[t], tree.term_starts[t + 1]
        bound[tree.ids[a:b]] += w * tree.shares[a:b]
    weight_of[terms] = weights
    found: list[tuple[int, tuple, int]] = []
    least = 0
    stack = [0]
    while stack:
        node = stack.pop()
        if bound[node] <= 0 or bound[node] < least:
            continue
        kids = tree.children[node]
        if len(kids):
            reach = bound[kids]
            kids = kids[(reach > 0) & (reach >= least)]
            stack += kids[np.argsort(bound[kids], kind="stable")].tolist()
            continue
        a, b = int(tree.begins[node]), int(tree.ends[node])
        lo, hi = tree.starts[a], tree.starts[b]
        sums = np.concatenate((np.zeros(1, np.int64), np.cumsum(weight_of[tree.terms[lo:hi]] * tree.values[lo:hi])))
        offsets = tree.starts[a : b + 1] - lo
        scores = sums[offsets[1:]] - sums[offsets[:-1]]
        for i in np.flatnonzero((scores > 0) & (scores >= least)).tolist():
            found.append((-int(scores[i]), _by_id(ids[a + i]), a + i))
        if len(found) >= top:
            found = sorted(found)[:top]
            least = -found[-1][0] if len(found) == top else 0
    weight_of[terms] = 0
    return [(-s, i) for s, _, i in sorted(found)[:top]]


def _by_id(doc_id) -> tuple:
    """Ids in ascending order, missing ones last."""
    return (doc_id is None, doc_id if doc_id is not None else 0)


# --- Spark --------------------------------------------------------------------------------------


def item_terms(texts: list[str | None]) -> list[list[bytes]]:
    return [sorted(terms_of((t or "").encode())) for t in texts]


def vectors(docs: DataFrame, vocabulary) -> DataFrame:
    """``doc_id, n, terms, tf``: all terms counted, those of the ``vocabulary`` (a broadcast) listed by number."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary.value
        for batch in batches:
            sizes, terms, tfs = [], [], []
            for text in texts_of(batch.column(1)):
                found = terms_of(text)
                sizes.append(found.total())
                pairs = [(known[t], c) for t, c in found.items() if t in known]
                terms.append([p[0] for p in pairs])
                tfs.append([p[1] for p in pairs])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(terms, pa.list_(pa.int32())), pa.array(tfs, pa.list_(pa.int64()))],
                ["doc_id", "n", "terms", "tf"],
            )

    return docs.mapInArrow(counted, f"doc_id {kind}, n bigint, terms array<int>, tf array<bigint>")


def _searched(paths: DataFrame, items, weights, n_docs: int, n_terms: int) -> DataFrame:
    """``item, doc_id, score``: each item's best documents in each tree; ``items`` and ``weights`` are broadcasts."""
    kind = paths.schema["doc_id"].dataType.simpleString()

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight = weights.value
        weight_of = np.zeros(len(weight), np.int64)
        for block in _blocks(batches):
            ids = block.column("doc_id").to_pylist()
            n = block.column("n").to_numpy()
            m = 10 + (90 * n * n_docs) // n_terms
            path = block.column("path").combine_chunks()
            starts = path.offsets.to_numpy().astype(np.int64)
            tf = block.column("tf").combine_chunks()
            tree = tree_of(starts - starts[0], path.flatten().to_numpy(), tf.flatten().to_numpy(), m, len(weight))
            numbers, docs, scores = [], [], []
            for number, terms in items.value:
                for score, at in best_of(tree, terms, weight[terms], ids, weight_of):
                    numbers.append(number)
                    docs.append(ids[at])
                    scores.append(score)
            yield pa.RecordBatch.from_arrays(
                [pa.array(numbers, pa.int64()), pa.array(docs, block.schema.field("doc_id").type), pa.array(scores, pa.int64())],
                ["item", "doc_id", "score"],
            )

    return paths.select("doc_id", "n", "path", "tf").mapInArrow(search, f"item bigint, doc_id {kind}, score bigint")


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    held, postings = [], 0
    for batch in batches:
        held.append(batch)
        postings += len(batch.column(2).flatten())
        if postings >= TREE_POSTINGS:
            yield pa.Table.from_batches(held)
            held, postings = [], 0
    if held:
        yield pa.Table.from_batches(held)


def ranked(docs: DataFrame, items: DataFrame, top: int = TOP, item_bytes: int = ITEM_BYTES) -> DataFrame:
    """``item_id, rank, doc_id, score``: the documents of highest score for each row of ``items (item_id, text)``.

    Documents are cut down to the terms that any item has.  Terms are put in the order of their document frequency, most
    frequent first, and documents in that of their term lists, so that neighbours share a path of a tree.  A
    task builds trees over runs of documents and searches each for all items, depth first and by bounds; the best of all trees are
    ranked by one window over ``top`` rows for each item and tree.

    Items go to the executors in portions of about ``item_bytes``, each in a pass of its own over the documents, so neither they nor
    their vocabulary are bound by a task's memory.

    Equal scores are in the order of ids, missing ids last.  Null and empty texts have no terms: such an item has no rows, such a document is in none.
    Repeated rows are ranked each by itself, and so are items that share an id.  Fewer than ``top`` documents above 0 are all returned.  An empty table
    on either side gives no rows.  Further columns are ignored.
    """
    spark = docs.sparkSession
    plain = docs.select(text_column(docs, "doc_id").alias("doc_id"), text_column(docs, "text").alias("text"))
    size = F.coalesce(F.octet_length("text"), F.lit(0)) + 16
    asked = staged(
        items.select(text_column(items, "item_id").alias("item_id"), text_column(items, "text").alias("text")).select(
            F.monotonically_increasing_id().alias("item"), "item_id", "text", size.alias("size")
        ),
        "items",
    )
    total = asked.agg(F.sum("size")).first()[0] or 0
    portions = max(1, math.ceil(total / item_bytes))
    found = None
    for portion in range(portions):
        chunk = asked.where(F.pmod(F.xxhash64("item"), F.lit(portions)) == portion).select("item", "text").collect()  # of item_bytes
        some = _pass(spark, plain, [(r["item"], r["text"]) for r in chunk], top)
        found = some if found is None else found.unionByName(some)
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    best = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return best.join(asked, "item").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


def _pass(spark, docs: DataFrame, items: list[tuple[int, str | None]], top: int) -> DataFrame:
    """The best documents of each tree for one portion of items."""
    lists = item_terms([text for _, text in items])
    words = sorted({t for terms in lists for t in terms})
    number = {t: i for i, t in enumerate(words)}
    context = spark.sparkContext
    listed = staged(vectors(docs, context.broadcast(number)), "vectors")
    n_docs, n_terms, postings = (
        x or 0 for x in listed.agg(F.count_if(F.col("n") > 0), F.sum("n"), F.sum(F.size("terms"))).first()
    )
    counts = listed.select(F.explode("terms").alias("t")).groupBy("t").count().collect()  # a row a term of the portion
    df = np.zeros(len(words), np.int64)
    for t, c in counts:
        df[t] = c
    by_frequency = sorted(range(len(words)), key=lambda t: (-df[t], words[t]))
    rank = np.zeros(len(words), np.int32)
    rank[by_frequency] = np.arange(len(words), dtype=np.int32)
    weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) for t in by_frequency], np.int64)
    asked = [
        (item, np.sort(rank[[number[t] for t in terms]]).astype(np.int64)) for (item, _), terms in zip(items, lists, strict=True) if terms
    ]
    ranks = context.broadcast(rank)

    def in_order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            terms, tf = batch.column(2), batch.column(3)
            lists_, counts_ = [], []
            for t, c in zip(terms, tf, strict=True):
                path = ranks.value[t.values.to_numpy()]
                order = np.argsort(path)
                lists_.append(path[order])
                counts_.append(c.values.to_numpy()[order])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(lists_, pa.list_(pa.int32())), pa.array(counts_, pa.list_(pa.int64())), batch.column(4)],
                ["doc_id", "n", "path", "tf", "tie"],
            )

    kind = listed.schema["doc_id"].dataType.simpleString()
    matched = listed.where(F.size("terms") > 0).withColumn("tie", F.monotonically_increasing_id())
    paths = matched.mapInArrow(in_order, f"doc_id {kind}, n bigint, path array<int>, tf array<bigint>, tie bigint")
    tasks = max(context.defaultParallelism, math.ceil(postings / TREE_POSTINGS))
    # The place breaks ties, so copies of one document spread over ranges.
    sorted_ = paths.repartitionByRange(tasks, "path", "tie").sortWithinPartitions("path", "tie")
    return _searched(sorted_, context.broadcast(asked), context.broadcast(weight), max(n_docs, 1), max(n_terms, 1))


def ranked_sql(top: int = TOP) -> str:
    """The same in DuckDB's SQL, every document scored for every item."""
    pattern = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"""
    WITH words AS (
      SELECT doc_id, unnest(regexp_extract_all({lower}, '{pattern}')) AS term FROM documents
    ), tfs AS (
      SELECT doc_id, term, count(*) AS tf FROM words GROUP BY ALL
    ), sizes AS (
      SELECT doc_id, count(*) AS n FROM words GROUP BY doc_id
    ), totals AS (
      SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM sizes
    ), weights AS (
      SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tfs, totals GROUP BY term, docs
    ), asked AS (
      SELECT DISTINCT item_id, unnest(regexp_extract_all({lower}, '{pattern}')) AS term FROM benchmark
    ), scored AS (
      SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // terms)))) AS BIGINT) AS score
      FROM asked JOIN tfs USING (term) JOIN weights USING (term) JOIN sizes USING (doc_id), totals GROUP BY ALL
    ), ranked AS (
      SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank, doc_id, score FROM scored WHERE score > 0
    )
    SELECT * FROM ranked WHERE rank <= {top}
    """
