import xxhash
from cases import awkward, documents, prose

from starward.llm.components import connected_components
from starward.llm.simhash import near_duplicates, one_of_each


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain(rows):
    prints = [plain_fingerprint(r[1]) for r in rows]
    groups = {p: p for p in prints}

    def root(p):
        while groups[p] != p:
            p = groups[p]
        return p

    for a in groups:
        for b in groups:
            if bin(a ^ b).count("1") <= 2:
                groups[root(a)] = root(b)
    first = {}
    for r, p in zip(rows, prints):
        if r[0] is not None:
            first[root(p)] = min(first.get(root(p), r[0]), r[0])
    return sorted(((r[0], f"{p:016x}", first.get(root(p))) for r, p in zip(rows, prints)), key=repr)


def test_against_all_pairs(spark):
    long = prose(50, 400).split()
    rows = awkward() + [(100 + i, " ".join([*long[:i], "new", *long[i + 1 :]]), "en") for i in range(0, 400, 8)]
    rows += [(600 + i, "same text here once more", "en") for i in range(30)]
    got = sorted((tuple(r) for r in near_duplicates(documents(spark, rows)).collect()), key=repr)
    assert got == plain(rows)
    assert len({r[2] for r in got}) < len({r[1] for r in got})  # some are linked over a distance


def edited():
    """Each text with one word of 400 changed here and there, so that most fingerprints are near."""
    rows = []
    for k in range(6):
        words = prose(700 + k, 400).split()
        rows += [(1000 + 20 * k + i, " ".join("new" if n == 37 * i else w for n, w in enumerate(words)), "en") for i in range(6)]
    return rows


def test_one_of_each(spark):
    rows = awkward() + edited()
    want = {c for *_, c in plain(rows)}
    kept = one_of_each(documents(spark, rows))
    assert kept.columns == documents(spark, rows).columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(want)
    assert len(want) < len({r[0] for r in rows if r[0] is not None})


def test_rows_that_share_an_id_are_judged_by_their_texts(spark):
    one, two, three = prose(1, 60), prose(2, 60), prose(3, 60)
    rows = [(1, one, "en"), (5, one, "en"), (5, two, "en"), (7, three, "en"), (7, three, "en"), (8, two, "en"), (None, one, "en")]
    rows += [(None, prose(4, 60), "en"), (9, prose(5, 60), "en"), (9, prose(6, 60), "en")]
    kept = sorted(((r.doc_id, r.text) for r in one_of_each(documents(spark, rows)).collect()), key=repr)
    assert kept == sorted([(1, one), (5, two), (7, three), (None, prose(4, 60)), (9, prose(5, 60)), (9, prose(6, 60))], key=repr)


def test_a_group_of_rows_without_an_id_leaves_one(spark):
    kept = one_of_each(documents(spark, [(None, prose(1, 60), "en"), (None, prose(1, 60), "fr")])).collect()
    assert len(kept) == 1


def test_fingerprints_are_spread_before_their_variants(spark):
    """The few bytes of the distinct fingerprints aren't joined to one task that would emit all variants."""
    from starward.llm.simhash import links

    prints = spark.range(2000).selectExpr("xxhash64(id) AS fp")
    plan = links(prints)._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_NUM" in plan


def test_empty_and_all_null_ids(spark):
    assert near_duplicates(documents(spark, [])).collect() == []
    assert one_of_each(documents(spark, [])).collect() == []
    assert [tuple(r)[2] for r in near_duplicates(documents(spark, [(None, "a b c d", None)] * 2)).collect()] == [None, None]


def test_long_chain_is_one_component(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101), (5, 5)], "a bigint, b bigint")
    got = {r.node: r.root for r in connected_components(edges).collect()}
    assert got == {**{i: 0 for i in range(1, 61)}, 101: 100}
