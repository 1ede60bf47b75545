"""Ranked search against scoring every document for every item."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
from cases import awkward, documents, prose

from starward.llm import search
from starward.llm.search import best_of, ranked, shared_prefixes, terms_of, tree_of

TERM = re.compile("[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_terms(text):
    return TERM.findall((text or "").translate(LOWER))


def plain(rows, items, top=10):
    docs = [Counter(plain_terms(t)) for _, t, _ in rows]
    sizes = [d.total() for d in docs]
    n_docs, n_terms = sum(s > 0 for s in sizes), sum(sizes)
    df = Counter(t for d in docs for t in d)
    out = []
    for item, text in items:
        scores = []
        for (doc_id, *_), d, n in zip(rows, docs, sizes):
            m = 10 + (90 * n * n_docs) // max(n_terms, 1)
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * d[t]) // (1000 * d[t] + 8 * m))
                for t in set(plain_terms(text))
                if d[t]
            )
            if score > 0:
                scores.append((-score, doc_id is None, doc_id or 0, doc_id))
        out += [(item, k + 1, s[3], -s[0]) for k, s in enumerate(sorted(scores)[:top])]
    return sorted(out, key=repr)


def asked(spark, items):
    return spark.createDataFrame([(i, t, "x", 1) for i, t in items], "item_id bigint, text string, item string, rank int")


def some():
    rows = awkward() + [(100 + i, prose(i % 40, 30 + i % 50, 60) + " Same" * (i % 5), "en") for i in range(150)]
    rows += [(400 + i, prose(7, 40, 60), "en") for i in range(60)]  # copies, more than are asked for
    items = [(i, prose(200 + i, 12, 60)) for i in range(12)] + [(50, None), (51, " .,"), (52, "unheard zzzz"), (53, prose(7, 40, 60)), (None, "SAME same")]
    return rows, items + [(53, prose(7, 40, 60)), (54, "漢字 ÉÀ 12")]


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_against_scoring_everything(spark):
    rows, items = some()
    got = ranked(documents(spark, rows), asked(spark, items))
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert rows_of(got) == plain(rows, items)


def test_many_small_trees_and_portions_give_the_same(spark, monkeypatch):
    rows, items = some()
    monkeypatch.setattr(search, "TREE_POSTINGS", 300)
    monkeypatch.setattr(search, "LEAF", 3)
    assert rows_of(ranked(documents(spark, rows), asked(spark, items), item_bytes=200)) == plain(rows, items)
    assert rows_of(ranked(documents(spark, rows), asked(spark, items), top=3)) == plain(rows, items, 3)


def test_empty_sides(spark):
    rows, items = some()
    assert ranked(documents(spark, []), asked(spark, items)).collect() == []
    assert ranked(documents(spark, rows), asked(spark, [])).collect() == []
    assert ranked(documents(spark, [(1, None, None), (2, " ", "en")]), asked(spark, items)).collect() == []


def test_terms_of_a_very_long_text_in_pieces(monkeypatch):
    monkeypatch.setattr(search, "_PIECE", 50)
    text = prose(3, 400) + " ÉÀ-é" + "z" * 200
    assert terms_of(text.encode()) == Counter(t.encode() for t in plain_terms(text))


def vectors(seed, n, terms=40):
    rng = random.Random(seed)
    docs = sorted(sorted(rng.sample(range(terms), rng.randrange(1, 9))) for _ in range(n))
    starts = np.concatenate(([0], np.cumsum([len(d) for d in docs])))
    flat = np.array([t for d in docs for t in d])
    return docs, starts, flat, np.array([rng.randrange(1, 9) for _ in flat]), np.array([rng.randrange(11, 200) for _ in docs])


def test_documents_below_a_node_share_its_path_and_bounds_hold():
    docs, starts, terms, tf, m = vectors(1, 600)
    assert shared_prefixes(starts, terms)[1:].tolist() == [
        next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b))) for a, b in zip(docs, docs[1:])
    ]
    tree = tree_of(starts, terms, tf, m, 40)
    leaves = [i for i, kids in enumerate(tree.children) if not len(kids)]
    covered = sorted((int(tree.begins[i]), int(tree.ends[i])) for i in leaves)
    assert covered[0][0] == 0 and covered[-1][1] == 600 and all(a[1] == b[0] for a, b in zip(covered, covered[1:]))
    assert all(b - a <= search.LEAF for a, b in covered)
    held = defaultdict(dict)
    for t in range(40):
        for k in range(tree.term_starts[t], tree.term_starts[t + 1]):
            held[int(tree.ids[k])][t] = int(tree.shares[k])
    for node in range(len(tree.begins)):
        for d in range(tree.begins[node], tree.ends[node]):
            for p in range(starts[d], starts[d + 1]):
                assert tree.values[p] <= held[node][int(terms[p])]


def test_branch_and_bound_visits_few_leaves_and_misses_nothing():
    _, starts, terms, tf, m = vectors(2, 3000)
    tree = tree_of(starts, terms, tf, m, 40)
    weights = np.array([900, 700, 500])
    for wanted in ([0, 5, 9], [1, 2, 39], [30, 35, 38]):
        found = best_of(tree, np.array(wanted), weights, list(range(3000)), np.zeros(40, np.int64))
        scores = np.zeros(3000, np.int64)
        for t, w in zip(wanted, weights):
            at = np.flatnonzero(terms == t)
            np.add.at(scores, np.searchsorted(starts, at, side="right") - 1, w * tree.values[at])
        order = sorted(range(3000), key=lambda d: (-scores[d], d))[:10]
        assert found == [(int(scores[d]), d) for d in order if scores[d] > 0]
