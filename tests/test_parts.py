"""Commits that write only the parts that change."""

from contextlib import nullcontext
from datetime import date

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starward.plans.warehouse_load import merge_facts
from starward.session import hashed_joins
from starward.sources.parts import PartTable, RepeatedKey, digests
from starward.sources.scratch import staged

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("v", T.StringType())])
MONTH = T.StructField("month", T.IntegerType())


def table(spark, tmp_path, by=MONTH):
    return PartTable(spark, str(tmp_path / "t"), SCHEMA, by)


def frame(spark, rows):
    return spark.createDataFrame(rows, "id bigint, v string, month int")


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def folders(df):
    return sorted({f.split("/data/")[1].rsplit("/", 1)[0] for f in df.inputFiles()})


def test_a_changed_part_is_written_and_the_others_are_named_again(spark, tmp_path):
    t = table(spark, tmp_path)
    assert t.version == 0 and t.read().collect() == [] and t.parts() == []
    t.commit(frame(spark, [(1, "a", 1), (2, "b", 2), (3, "c", None)]), key="id")
    first = {p.part: p for p in t.parts()}
    t.commit(frame(spark, [(4, "d", 2)]), replace=[2], key="id")
    second = {p.part: p for p in t.parts()}
    assert rows(t.read()) == [(1, "a"), (3, "c"), (4, "d")] and t.rows() == 3
    assert {p for p in first if first[p] == second[p]} == {"1", "__HIVE_DEFAULT_PARTITION__"}
    assert folders(t.read([2])) == ["version=00000002/month=2"]
    assert folders(t.read([1, None])) == ["version=00000001/month=1", "version=00000001/month=__HIVE_DEFAULT_PARTITION__"]
    assert rows(t.read(stored=True)) == [(1, "a", 1), (3, "c", None), (4, "d", 2)]
    assert rows(t.read(version=1)) == [(1, "a"), (2, "b"), (3, "c")]
    assert t.high_water == 4


def test_an_append_adds_a_folder_and_a_part_may_end(spark, tmp_path):
    t = table(spark, tmp_path)
    t.commit(frame(spark, [(1, "a", 1)]), replace=(), key="id", unique=True)
    t.commit(frame(spark, [(2, "b", 1), (3, "c", 2)]), replace=(), key="id", unique=True)
    assert rows(t.read()) == [(1, "a"), (2, "b"), (3, "c")] and len(t.parts()) == 3
    t.commit(None, replace=[1])
    assert rows(t.read()) == [(3, "c")] and t.high_water == 3
    t.commit(frame(spark, []), replace=None)
    assert t.read().collect() == [] and t.high_water == 3 and t.version == 4


def test_readers_during_and_after_a_failed_append_see_the_old_state(spark, tmp_path):
    t = table(spark, tmp_path)
    t.commit(frame(spark, [(1, "a", 1)]), replace=())
    broken = frame(spark, [(2, "b", 1), (3, "c", 2)]).withColumn("v", F.when(F.col("id") == 3, F.raise_error(F.lit("lost"))).otherwise(F.col("v")))
    with pytest.raises(Exception, match="lost"):
        t.commit(broken, replace=())
    seen = []

    def refuse(written):
        seen.append(rows(t.read()))
        assert rows(written) == [(2, "b")]
        raise ValueError("not these")

    with pytest.raises(ValueError, match="not these"):
        t.commit(frame(spark, [(2, "b", 1)]), replace=(), check=refuse)
    assert seen == [[(1, "a")]] and rows(t.read()) == [(1, "a")] and t.version == 1
    t.commit(frame(spark, [(4, "d", 2)]), replace=())
    assert rows(t.read()) == [(1, "a"), (4, "d")]


def test_a_repeated_key_is_caught_across_commits_by_key_ranges(spark, tmp_path):
    t = table(spark, tmp_path)
    t.commit(frame(spark, [(1, "a", 1), (5, "b", 1), (10, "c", 2)]), replace=(), key="id", unique=True)
    with pytest.raises(RepeatedKey, match="id 7"):
        t.commit(frame(spark, [(7, "x", 3), (7, "y", 3)]), replace=(), key="id", unique=True)
    with pytest.raises(RepeatedKey, match="id 5"):
        t.commit(frame(spark, [(5, "x", 3), (6, "y", 3)]), replace=(), key="id", unique=True)
    t.commit(frame(spark, [(11, "x", 1), (12, "y", 1)]), replace=(), key="id", unique=True)
    written = [p for p in t.parts() if p.low == 11]
    assert t.overlapping(written, [p for p in t.parts() if p.low != 11]) == []  # nothing else was read
    assert t.read().count() == 5


def test_a_batch_is_known_by_its_commit(spark, tmp_path):
    t = table(spark, tmp_path, T.StructField("month", T.DateType()))
    day = spark.createDataFrame([(1, "a", date(2010, 1, 2))], "id bigint, v string, month date")
    t.commit(day, replace=(), batch="visits/0")
    assert t.has_batch("visits/0") and not t.has_batch("visits/1")
    assert rows(t.read([date(2010, 1, 2)])) == [(1, "a")] and t.read([date(2010, 1, 3)]).collect() == []


def test_a_table_in_one_part(spark, tmp_path):
    t = table(spark, tmp_path, None)
    t.commit(frame(spark, [(1, "a", 1)]), replace=(), key="id")
    t.commit(frame(spark, [(2, None, 1)]), replace=(), key="id")
    assert rows(t.read()) == [(1, "a"), (2, None)]


def test_digests_see_values_nulls_and_copies_but_not_order(spark):
    def d(*r):
        return digests(spark.createDataFrame([(*x, 1) for x in r], "id bigint, v string, month int"), "month", SCHEMA)["1"]

    assert d((1, "a"), (2, "b")) == d((2, "b"), (1, "a"))
    assert len({d((1, "a")), d((1, "b")), d((1, None)), d((None, "a")), d((1, "a"), (1, "a")), d((None, None))}) == 6


def test_only_months_that_differ_are_merged_and_written(spark, tmp_path):
    t = table(spark, tmp_path)
    months = [(i, f"v{i}", 1 + i % 6) for i in range(60)]
    assert merge_facts(t, frame(spark, months), SCHEMA.names) == {"inserted": 60, "deleted": 0}
    before = {p.part: p.folder for p in t.parts()}
    changed = [(i, "new" if i == 7 else v, m) for i, v, m in months if m != 6]
    assert merge_facts(t, frame(spark, changed), SCHEMA.names) == {"inserted": 1, "deleted": 11}
    after = {p.part: p.folder for p in t.parts()}
    assert set(after) == {"1", "2", "3", "4", "5"} and {p for p in after if after[p] != before[p]} == {"2"}
    assert rows(t.read()) == sorted(((i, v) for i, v, _ in changed), key=repr)
    assert folders(t.read([2])) == ["version=00000002/month=2"]
    assert merge_facts(t, frame(spark, changed), SCHEMA.names) == {"inserted": 0, "deleted": 0}
    assert t.version == 2


def test_a_first_fill_is_not_merged(spark, tmp_path, monkeypatch):
    """Nothing to compare with: rows, copies and NULLs go into their months without a merge or a copy."""
    t, some = table(spark, tmp_path), [(1, "a", 1), (1, "a", 1), (2, None, 2), (None, "c", None)]
    with monkeypatch.context() as m:
        m.setattr("starward.plans.warehouse_load.staged", lambda *_: pytest.fail("written twice"))
        m.setattr("starward.plans.warehouse_load.fact_merge", lambda *_: pytest.fail("merged"))
        assert merge_facts(t, frame(spark, some), SCHEMA.names) == {"inserted": 4, "deleted": 0}
    assert rows(t.read()) == sorted(((i, v) for i, v, _ in some), key=repr)
    assert merge_facts(t, frame(spark, some), SCHEMA.names) == {"inserted": 0, "deleted": 0} and t.version == 1
    empty = table(spark, tmp_path / "empty")
    assert merge_facts(empty, frame(spark, []), SCHEMA.names) == {"inserted": 0, "deleted": 0} and empty.version == 1


def test_rows_with_keys_are_merged_searched_and_written_in_one_shuffle(spark, tmp_path, monkeypatch):
    """The same table and numbers as the merge by written changes; nothing but the source is written in between."""
    first = [(i, f"v{i}", 1 + i % 3) for i in range(30)] + [(90, None, 1), (None, "n", 2)]
    now = [(i, "new" if i in (4, 8) else v, m) for i, v, m in first if i != 5] + [(31, "a", 2), (6, "twice", 1), (None, "n", 2)]
    by_changes, by_keys = table(spark, tmp_path / "a"), table(spark, tmp_path / "b")
    for t in (by_changes, by_keys):
        merge_facts(t, frame(spark, first), SCHEMA.names, unique=True)
    expected = merge_facts(by_changes, frame(spark, now), SCHEMA.names, unique=True)
    written, told = [], []
    monkeypatch.setattr("starward.plans.warehouse_load.staged", lambda df, label: written.append(label) or staged(df, label))
    monkeypatch.setattr("starward.plans.warehouse_load.SLOT_ROWS", 4)

    def check(rows, repeated):
        told.append((rows.count(), repeated))

    assert merge_facts(by_keys, frame(spark, now), SCHEMA.names, unique=True, check=check, keys=["id"]) == expected
    assert written == ["fact-source"] and told == [(34, 4)]  # 6 stands twice in its month, and so does the missing key
    assert rows(by_keys.read(stored=True)) == rows(by_changes.read(stored=True)) == sorted(now, key=repr)
    assert [(p.part, p.rows, p.digest) for p in by_keys.parts()] == [(p.part, p.rows, p.digest) for p in by_changes.parts()]


def test_a_merge_by_keys_without_changes_commits_nothing(spark, tmp_path):
    t = table(spark, tmp_path)
    merge_facts(t, frame(spark, [(1, "a", 1), (1, "a", 1), (2, "b", 2)]), SCHEMA.names)
    # One copy matches both, so the months differ and the rows don't.
    assert merge_facts(t, frame(spark, [(1, "a", 1), (2, "b", 2)]), SCHEMA.names, unique=True, keys=["id"]) == {"inserted": 0, "deleted": 0}
    assert t.version == 1 and t.rows() == 3
    assert merge_facts(t, frame(spark, []), SCHEMA.names, unique=True, keys=["id"]) == {"inserted": 0, "deleted": 3}
    assert t.version == 2 and t.rows() == 0


def test_large_joins_of_a_load_are_hashed(spark, tmp_path):
    """Neither side may be broadcast; within ``hashed_joins`` none is sorted, and the setting goes again."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    setting = "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold"
    before = spark.conf.get(setting)
    try:
        plans = []
        for hashed in (False, True):
            joined = spark.range(2000).withColumn("v", F.col("id") % 7).join(spark.range(0, 3000, 2), "id")
            with hashed_joins(spark) if hashed else nullcontext():
                assert joined.count() == 1000
                joined.write.mode("overwrite").parquet(str(tmp_path / "out"))
                assert joined.collect()
                plans.append(joined._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0])
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in plans[0] and "ShuffledHashJoin" in plans[1] and "SortMergeJoin" not in plans[1]
    assert spark.conf.get(setting) == before


def test_retired_versions_leave_what_is_named(spark, tmp_path):
    t = table(spark, tmp_path)
    for k in range(4):
        t.commit(frame(spark, [(k, "a", 1)]), replace=[1] if k else None)
        if not k:
            t.commit(frame(spark, [(9, "b", 2)]), replace=())
    assert t.retire(keep=2) == 2
    assert rows(t.read()) == [(3, "a"), (9, "b")] and rows(t.read(version=t.version - 1)) == [(2, "a"), (9, "b")]
    assert t.retire(keep=2) == 0
