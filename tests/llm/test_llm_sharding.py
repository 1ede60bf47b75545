import zlib
from collections import defaultdict

from cases import awkward, documents, prose

from starward.llm.sharding import shard_documents


def checked(rows, got):
    want = sorted((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, _ in rows if i is not None)
    assert sorted((r.doc_id, r["size"], r.text_crc32) for r in got if r.doc_id is not None) == want
    assert len(got) == len(rows)
    slots = defaultdict(list)
    for r in got:
        assert 0 <= r.shard < 16 and r.law == "bytes" and r.grown_shard is None
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_awkward_rows(spark):
    rows = awkward()
    checked(rows, shard_documents(documents(spark, rows)).collect())
    assert shard_documents(documents(spark, [])).collect() == []
    checked([(1, "x", "en")], shard_documents(documents(spark, [(1, "x", "en")])).collect())


def test_shards_are_even_though_a_third_are_copies(spark):
    rows = [(i, prose(1, 50) if i % 3 == 0 else prose(i, 20 + i % 60), "en") for i in range(1500)]
    rows += [(2000 + i, prose(5000 + i // 3, 30), "en") for i in range(300)]
    got = shard_documents(documents(spark, rows)).collect()
    checked(rows, got)
    sizes, shards = defaultdict(int), defaultdict(set)
    for r in got:
        sizes[r.shard] += r["size"]
        shards[r.text_crc32].add(r.shard)
    assert len(sizes) == 16 and max(sizes.values()) < 1.06 * min(sizes.values())
    several = [s for c, s in shards.items() if len(s) > 1]
    assert len(several) <= 16  # only groups that a cut has to go through
