from starward.operators.quality import (
    duplicate_keys,
    missing,
    orphans,
    outside_set,
    too_long,
    warehouse_row_violations,
)
from starward.operators.reconcile import reconcile
from starward.operators.setops import change_set, except_distinct, except_loaded, union_distinct
from starward.schemas import WAREHOUSE

AB = "a int, b string"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_union_except_with_nulls_and_copies(spark):
    one = spark.createDataFrame([(1, "x"), (1, "x"), (2, None)], AB)
    two = spark.createDataFrame([("x", 1), ("y", 3)], "b string, a int")
    loaded = spark.createDataFrame([(2, None), (9, "z")], AB)
    arrived = union_distinct(one, two)
    assert rows(arrived) == [(1, "x"), (2, None), (3, "y")]
    assert rows(except_distinct(arrived, loaded)) == [(1, "x"), (3, "y")]
    assert rows(except_loaded(one.unionByName(two), loaded)) == [(1, "x"), (3, "y")]
    assert rows(except_loaded(one, one)) == []


def test_except_loaded_agrees_with_except_on_a_large_history(spark):
    history = spark.range(20000).selectExpr("cast(id % 977 as int) a", "if(id % 5 = 0, null, string(id % 13)) b")
    new = spark.range(3000).selectExpr("cast(id % 1500 as int) a", "if(id % 7 = 0, null, string(id % 17)) b")
    left = rows(except_loaded(new, history))
    assert left and left == rows(new.subtract(history))


def test_except_loaded_reads_the_history_without_shuffling_it(spark, tmp_path):
    """With a small written feed the only shuffle is of the history rows that occur in it."""
    spark.range(50000).selectExpr("id", "string(id) s").write.parquet(str(tmp_path / "history"))
    spark.createDataFrame([(5, "5"), (-1, "n")], "id bigint, s string").write.parquet(
        str(tmp_path / "feed")
    )
    history = spark.read.parquet(str(tmp_path / "history"))
    feed = spark.read.parquet(str(tmp_path / "feed"))
    result = except_loaded(feed, history, distinct=True)
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert "LeftSemi, BuildRight" in plan and "LeftAnti, BuildRight" in plan
    assert "SortMergeJoin" not in plan and plan.count("Exchange hashpartitioning") == 1
    assert rows(result) == [(-1, "n")]


def test_except_loaded_from_distinct_rows_shuffles_each_side_once(spark, tmp_path):
    """A feed too large for a broadcast: what was seen isn't shuffled again; NULLs are equal, and copies in the history do no harm."""
    feed = [(i, None if i % 3 else f"v{i}") for i in range(300)]
    spark.createDataFrame([*feed[100:], feed[150]], "id bigint, s string").write.parquet(str(tmp_path / "history"))
    spark.createDataFrame(feed, "id bigint, s string").write.parquet(str(tmp_path / "feed"))
    history, new = spark.read.parquet(str(tmp_path / "history")), spark.read.parquet(str(tmp_path / "feed"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        result = except_loaded(new, history, distinct=True, loaded_distinct=True)
        found = rows(result)
        plan = result._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    final = plan.split("Initial Plan")[0]
    assert sorted(found, key=repr) == sorted(feed[:100], key=repr)
    assert final.count("SortMergeJoin") == 2 and "HashAggregate" not in final
    assert final.count("Exchange hashpartitioning") - final.count("ReusedExchange") <= 3 and final.count("ReusedExchange") >= 1


def test_change_set_has_both_sides(spark):
    src = spark.createDataFrame([(1, "x"), (2, "new"), (3, None), (3, None)], AB)
    tgt = spark.createDataFrame([(1, "x"), (2, "old"), (3, None), (4, "gone")], AB)
    assert rows(change_set(src, tgt, ["a", "b"])) == [
        (2, "new", 1, 0),
        (2, "old", 0, 1),
        (4, "gone", 0, 1),
    ]


def test_constraint_checks_find_one_bad_row_each(spark):
    df = spark.createDataFrame(
        [(1, "F", "ok"), (1, "F", "ok"), (2, "X", "ok"), (3, None, "toolong"), (None, "F", "ok")],
        "k int, flag string, txt string",
    )
    assert rows(duplicate_keys(df, ["k"])) == [(1, 2)]
    parent = spark.createDataFrame([(1,), (1,), (2,)], "p int")
    assert rows(orphans(df.select("k"), "k", parent, "p")) == [(3,)]
    assert rows(outside_set(df, "flag", ["F"])) == [(2, "X", "ok")]
    assert rows(missing(df.select("k", "flag"), ["k", "flag"])) == [
        (3, None, ["flag"]),
        (None, "F", ["k"]),
    ]
    assert rows(too_long(df.select("k", "txt"), {"txt": 5})) == [(3, "toolong", ["txt"])]


def test_warehouse_rules(spark):
    clinics = spark.createDataFrame(
        [(1, 1, "a", "b", "c", "98001"), (2, 2, None, "b", "c", "98001-1234")], WAREHOUSE["dim_clinics"]
    )
    assert rows(warehouse_row_violations("dim_clinics", clinics)) == [
        (2, "ClinicName is null"),
        (2, "ClinicZip over 5"),
    ]
    shifts = spark.createDataFrame([(1, 1, "07:00:00", None)], WAREHOUSE["dim_shifts"])
    assert rows(warehouse_row_violations("dim_shifts", shifts)) == [(1, "ShiftEnd is null")]


def test_reconcile(spark):
    before, added = spark.range(5), spark.range(3)
    assert rows(reconcile(before, before.union(added), added, "t")) == [("t", 5, 3, 8, True)]
    assert reconcile(before, before, added, "t").first().balanced is False
