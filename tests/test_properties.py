"""Syncs and merges against a row-by-row rendering of their rules, on random small tables."""

from datetime import date

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from starward.operators.history import scd2_merge
from starward.operators.sync import scd1_sync

IDS = st.one_of(st.none(), st.integers(1, 4))
NAMES = st.sampled_from(["a", "b", "a (Deleted)"])
SOURCE = st.lists(st.tuples(IDS, NAMES), max_size=7)
FEW = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))


def sync_by_hand(dim, source, drop):
    """``dim`` holds (key, id, name); the keys of added rows are left out."""
    held = {(i, n) for _, i, n in dim}
    changed = {i for i, n in set(source) - held if i is not None}
    kept = [r for r in dim if r[1] not in changed or r[1] is None]
    added = [r for r in source if r[0] in changed]
    now = {(i, n) for _, i, n in kept} | set(added)
    gone = {i for i, n in now - set(source) if i is not None}
    if drop:
        kept = [r for r in kept if r[1] is None or r[1] not in gone]
    else:
        mark = lambda n: n if "(Deleted)" in n else n + " (Deleted)"
        kept = [(k, i, mark(n) if i is not None and i in gone else n) for k, i, n in kept]
    return kept, added


@FEW
@given(SOURCE, SOURCE, st.booleans())
def test_type1_sync(spark, old, source, drop):
    dim = [(k + 1, *row) for k, row in enumerate(old)]
    got = scd1_sync(
        spark.createDataFrame(dim, "k bigint, id int, name string"),
        spark.createDataFrame(source, "id int, name string"),
        "id",
        ["id", "name"],
        "k",
        name_column="name",
        on_delete="drop" if drop else "flag",
    ).collect()
    kept, added = sync_by_hand(dim, source, drop)
    assert sorted((tuple(r) for r in got if r.k <= len(dim)), key=str) == sorted(kept, key=str)
    new = [r for r in got if r.k > len(dim)]
    assert sorted((r.id, r.name) for r in new) == sorted(added)
    assert sorted(r.k for r in new) == [len(dim) + i + 1 for i in range(len(added))]


@FEW
@given(
    st.lists(st.tuples(IDS, NAMES, st.sampled_from([0, 1])), max_size=7), SOURCE, st.booleans()
)
def test_type2_merge(spark, old, source, reclose):
    was, now = date(2010, 1, 1), date(2010, 1, 2)
    dim = [(k + 1, i, n, was, None if cur else was, cur) for k, (i, n, cur) in enumerate(old)]
    got = scd2_merge(
        spark.createDataFrame(
            dim, "k bigint, id int, name string, StartDate date, EndDate date, IsCurrent int"
        ),
        spark.createDataFrame(source, "id int, name string"),
        ["id", "name"],
        "k",
        now,
        reclose=reclose,
    ).collect()

    def same(row, src):
        return row[5] == 1 and row[1] is not None and row[1:3] == src

    want = []
    for row in dim:
        stays = any(same(row, s) for s in source) or (row[5] == 0 and not reclose)
        want.append(row if stays else (*row[:4], now, 0))
    added = [s for s in source if not any(same(row, s) for row in dim)]
    assert sorted((tuple(r) for r in got if r.k <= len(dim)), key=str) == sorted(want, key=str)
    new = [r for r in got if r.k > len(dim)]
    assert sorted((tuple(r[1:]) for r in new), key=str) == sorted(
        ((*s, now, None, 1) for s in added), key=str
    )
    assert sorted(r.k for r in new) == [len(dim) + i + 1 for i in range(len(added))]
