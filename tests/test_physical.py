"""The plans that matter at scale: what is pushed down, what is shuffled, what is broadcast."""

import pytest
from pyspark.sql import functions as F

from starward.catalog import QUERIES
from starward.operators.copies import expand_copies
from starward.operators.merge import change_counts, fact_merge
from starward.operators.setops import change_set
from starward.operators.sync import scd1_sync
from starward.session import FIRST_PARTITIONS, first_partitions, scan_split, shuffle_partitions, tune

TABLES = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def before_and_after(spark, tmp_path_factory):
    """20,000 members, of which a few changed, left or came."""
    root = tmp_path_factory.mktemp("dims")
    ids = spark.range(20000).select("id", F.concat(F.lit("name "), "id").alias("name"))
    ids.where("id < 19990").withColumn("k", F.col("id") + 1).write.parquet(f"{root}/dim")
    changed = F.when(F.col("id") < 5, F.lit("new")).otherwise(F.col("name"))
    ids.where("id > 0").withColumn("name", changed).write.parquet(f"{root}/src")
    return spark.read.parquet(f"{root}/dim"), spark.read.parquet(f"{root}/src")


def test_sync_does_not_shuffle_the_dimension_again(before_and_after):
    dim, src = before_and_after
    state = scd1_sync(dim, src, "id", ["id", "name"], "k", name_column="name")
    plan = plan_of(state)
    assert "SortMergeJoin" not in plan and "LeftOuter, BuildRight" in plan
    # Only the offsets of the new keys: one row per written partition.
    assert plan.count("Exchange") - plan.count("BroadcastExchange") == 3
    assert state.agg(F.count("*"), F.countDistinct("k")).first()[:] == (20000, 20000)
    assert state.where("name LIKE '%(Deleted)'").count() == 1


def test_change_set_is_one_shuffle_after_a_partial_count(before_and_after):
    dim, src = before_and_after
    plan = plan_of(change_set(src, dim, ["id", "name"]))
    assert plan.count("Exchange hashpartitioning(id") == 1 and plan.count("Exchange") == 1
    below = plan[plan.index("Exchange") :]
    assert "partial_max" in below and "Join" not in plan


def test_merge_of_unique_rows_is_one_shuffle(before_and_after):
    dim, src = before_and_after
    state = fact_merge(dim, src, ["id", "name"], unique=True).state
    assert plan_of(state).count("Exchange") == 1 and "Join" not in plan_of(state)


def test_merge_of_nothing_still_reports(spark):
    empty = spark.createDataFrame([], "id int")
    for unique in (True, False):
        assert change_counts(fact_merge(empty, empty, ["id"], unique).changes) == {"inserted": 0, "deleted": 0}


def test_hot_copies_leave_their_partition(spark):
    """A row with 100,000 copies is written by more than one task."""
    df = spark.createDataFrame([("hot", 100_000), ("x", 1), ("y", 1)], "v string, n bigint")
    setting = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(setting, "false")
    try:
        tasks = (
            expand_copies(df, "n")
            .where("v = 'hot'")
            .groupBy(F.spark_partition_id().alias("p"))
            .count()
            .collect()
        )
    finally:
        spark.conf.set(setting, "true")
    assert sum(t["count"] for t in tasks) == 100_000 and len(tasks) > 1


def test_range_filter_and_columns_reach_the_scan(spark):
    plan = plan_of(QUERIES["p10_range_filter"](spark, TABLES))
    assert "GreaterThanOrEqual(o_orderdate,1996-01-01T00:00), LessThanOrEqual(o_orde" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>" in plan


def test_visit_facts_read_only_their_columns(spark):
    plan = plan_of(QUERIES["w13_fact_visits"](spark, TABLES))
    scan = plan[plan.index("FileScan parquet [l_orderkey") :].split("\n")[0]
    assert "l_extendedprice" not in scan and "l_quantity" not in scan


@pytest.mark.parametrize(
    "name, kind", [("j7_semi_join", "LeftSemi"), ("j8_anti_join", "LeftAnti"), ("u2_except", "LeftAnti")]
)
def test_subqueries_become_semi_and_anti_joins(spark, name, kind):
    assert kind in plan_of(QUERIES[name](spark, TABLES))


@pytest.mark.parametrize(
    "name",
    ["j10_star_readback", "w2_scd1_flag", "w4_scd2_merge", "w5_fact_merge", "w16_new_patients", "w17_new_visits"],
)
def test_without_broadcasts_every_join_is_keyed(spark, name):
    """Sides too large to broadcast are joined by key: no nested loops, no Python."""
    setting = "spark.sql.autoBroadcastJoinThreshold"
    spark.conf.set(setting, "-1")
    try:
        plan = plan_of(QUERIES[name](spark, TABLES))
    finally:
        spark.conf.unset(setting)
    for bad in ("NestedLoop", "Cartesian", "Python"):
        assert bad not in plan


def test_sizing():
    assert shuffle_partitions(10**6, cores=8) == 8
    assert shuffle_partitions(10**12, cores=800) == 3726
    assert shuffle_partitions(100 * 10**12, cores=8000) == 50_000
    assert scan_split(10**9) == 128 * 2**20
    assert scan_split(100 * 10**12) == 10**9


def test_shuffles_start_with_partitions_for_the_input(spark):
    """A task's share of a shuffle, and with it its memory, doesn't grow with the input."""
    gb = 1024**3
    assert (first_partitions(0, 200), first_partitions(gb, 4), first_partitions(6 * gb, 4), first_partitions(100 * gb, 4)) == (200, 128, 768, 2000)
    try:
        tune(spark, gb)
        assert ", 128)" in plan_of(spark.range(100).groupBy((F.col("id") % 7).alias("k")).count())
        assert spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == "16m"
    finally:
        tune(spark)
    assert spark.conf.get(FIRST_PARTITIONS) == "4"


def test_a_query_sizes_its_shuffles_for_its_folder(spark, tmp_path):
    (tmp_path / "large.parquet").write_bytes(bytes(50 * 1024**2))
    spark.range(20).selectExpr("id s_suppkey", "concat('n', id) s_name", "double(id) s_acctbal").write.parquet(str(tmp_path / "supplier.parquet"))
    try:
        assert QUERIES["s4_read_table"](spark, str(tmp_path)).count() == 20
        assert spark.conf.get(FIRST_PARTITIONS) == "7"
    finally:
        tune(spark)
