from itertools import combinations

import duckdb
import numpy as np
import pytest
from cases import awkward, documents

from starward.llm.packing import best_boundaries, pack, pack_sql


def words(text):
    return len((text or "").encode().split())


@pytest.mark.parametrize("seed", range(12))
def test_boundaries_are_the_best(seed):
    rng = np.random.default_rng(seed)
    lengths = np.sort(rng.choice(np.arange(1, 40), rng.integers(1, 9), replace=False))
    counts = rng.integers(1, 50, len(lengths))
    buckets = int(rng.integers(1, 5))

    def waste(ends):
        return int(((np.array(ends)[np.searchsorted(ends, lengths)] - lengths) * counts).sum())

    inner = lengths[:-1].tolist()
    best = min(waste([*c, int(lengths[-1])]) for k in range(min(buckets - 1, len(inner)) + 1) for c in combinations(inner, k))
    ends = best_boundaries(lengths, counts, buckets)
    assert len(ends) <= buckets and waste(ends) == best


def test_every_word_has_one_place(spark):
    rows = awkward()
    got = pack(documents(spark, rows), buckets=3, max_length=64, token_budget=256).collect()
    assert sum(r.length for r in got) == sum(words(t) + 1 for _, t, _ in rows)
    assert all(0 < r.length <= r.bucket_length <= 64 and r.padding == r.bucket_length - r.length for r in got)
    places = {(r.bucket, r.batch, r.slot) for r in got}
    assert len(places) == len(got)
    for r in got:
        assert r.bucket_length * (r.slot + 1) <= max(256, r.bucket_length)
        assert r.slot == 0 or (r.bucket, r.batch, r.slot - 1) in places
        assert r.batch == 0 or (r.bucket, r.batch - 1, 0) in places
    assert len({(r.bucket, r.bucket_length) for r in got}) <= 3


def test_empty_table(spark):
    assert pack(documents(spark, [])).collect() == []


def test_sql_says_the_same(spark):
    rows = [r for r in dict.fromkeys(awkward()) if r[0] is not None]
    got = pack(documents(spark, rows), 4, 100, 300)
    db = duckdb.connect()
    held = documents(spark, rows).select("doc_id", "text").toPandas()  # noqa: F841
    db.execute("CREATE VIEW documents AS SELECT * FROM held")
    want = db.execute(pack_sql(4, 100, 300))
    names = [d[0] for d in want.description]
    assert sorted(got.columns) == sorted(names)
    assert sorted(tuple(r[c] for c in names) for r in got.collect()) == sorted(want.fetchall())
