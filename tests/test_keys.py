from pyspark.sql import functions as F

from starward.operators.copies import expand_copies
from starward.operators.keys import assign_keys, highest_key


def keys_of(df, *cols):
    return [tuple(r) for r in df.orderBy("k").select("k", *cols).collect()]


def test_keys_follow_the_order_from_start(spark):
    df = spark.createDataFrame([(3, "c"), (1, "a"), (2, "b")], "id int, v string")
    assert keys_of(assign_keys(df, "k", ["id"], start=5), "id") == [(6, 1), (7, 2), (8, 3)]


def test_keys_match_a_global_row_number(spark):
    df = spark.range(5000).select((F.col("id") * 7919 % 5003).alias("id"))
    got = assign_keys(df.repartition(13), "k", ["id"], unique=True)
    ranks = {r.id: i + 1 for i, r in enumerate(df.orderBy("id").collect())}
    assert {r.id: r.k for r in got.collect()} == ranks


def test_descending_and_null_orders(spark):
    df = spark.createDataFrame([(1,), (None,), (2,)], "id int")
    assert keys_of(assign_keys(df, "k", [F.col("id").desc_nulls_first()]), "id") == [
        (1, None),
        (2, 2),
        (3, 1),
    ]


def test_hot_value_gets_dense_keys_spread_over_ranges(spark):
    """A third of the rows share one value, copies included."""
    df = spark.range(9000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("v"))
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = assign_keys(df, "k", ["v"]).cache()
        assert got.agg(F.count("*"), F.min("k"), F.max("k"), F.countDistinct("k")).first()[:] == (
            9000,
            1,
            9000,
            9000,
        )
        rows = [r.v for r in got.orderBy("k").collect()]
        assert rows == sorted(rows)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)


def test_arrival_keys_need_no_shuffle_of_the_rows(spark):
    df = spark.range(1000).repartition(7)
    got = assign_keys(df, "k", start=10)
    assert got.agg(F.min("k"), F.max("k"), F.countDistinct("k")).first()[:] == (11, 1010, 1000)


def test_no_rows(spark):
    df = spark.createDataFrame([], "id int")
    assert assign_keys(df, "k", ["id"]).count() == 0
    assert assign_keys(df, "k").count() == 0


def test_start_from_the_highest_key(spark):
    old = spark.createDataFrame([(4,), (9,)], "k bigint")
    new = spark.createDataFrame([("x",), ("y",)], "v string")
    assert keys_of(assign_keys(new, "k", ["v"], start=highest_key(old, "k")), "v") == [
        (10, "x"),
        (11, "y"),
    ]
    assert keys_of(assign_keys(new, "k", ["v"], start=highest_key(old.where("k < 0"), "k")), "v") == [
        (1, "x"),
        (2, "y"),
    ]


def test_no_window_over_the_rows(spark):
    """The only single-partition step works on one row per written partition."""
    df = spark.range(100).select(F.col("id").alias("v"))
    plan = assign_keys(df, "k", ["v"], unique=True)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SinglePartition") == 1
    below = plan[plan.index("SinglePartition") :]
    assert "HashAggregate(keys=[" in below and "ReadSchema: struct<_pos:bigint>" in below


def test_expand_copies_is_exact_for_any_count(spark):
    df = spark.createDataFrame([("a", 0), ("b", 1), ("c", 25), ("d", 10), ("e", 11)], "v string, n bigint")
    for spread in (True, False):
        got = expand_copies(df, "n", spread, chunk=10).groupBy("v").count().collect()
        assert {r.v: r["count"] for r in got} == {"b": 1, "c": 25, "d": 10, "e": 11}
