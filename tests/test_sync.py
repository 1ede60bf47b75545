import pytest

from starward.operators.sync import scd1_sync
from starward.plans.dimensions import with_unknown_member

COLS = ["id", "name", "city"]
SRC = "id int, name string, city string"
DIM = "k bigint, id int, name string, city string"


def src(spark, *rows):
    return spark.createDataFrame(list(rows), SRC)


def sync(dim, source, **how):
    how = {"name_column": "name"} | how
    return scd1_sync(dim, source, "id", COLS, "k", **how)


def rows(df):
    return sorted(tuple(r) for r in df.collect())


A, B, C = (1, "a", "x"), (2, "b", "y"), (3, "c", "z")


def kept(spark, df):
    return spark.createDataFrame(df.collect(), DIM)


def test_change_scenario(spark):
    """Fill, insert, update, delete, repeat, return: the keys and names of each step."""
    dim = spark.createDataFrame([], DIM)
    dim = kept(spark, sync(dim, src(spark, C, A, B)))
    assert rows(dim) == [(1, *A), (2, *B), (3, *C)]
    dim = kept(spark, sync(dim, src(spark, A, B, C, (4, "ins", "w"))))
    assert rows(dim)[3] == (4, 4, "ins", "w")
    dim = kept(spark, sync(dim, src(spark, A, B, C, (4, "upd", "w"))))
    assert rows(dim) == [(1, *A), (2, *B), (3, *C), (5, 4, "upd", "w")]
    for _ in range(2):
        dim = kept(spark, sync(dim, src(spark, A, B, C)))
        assert rows(dim)[3] == (5, 4, "upd (Deleted)", "w")
    dim = kept(spark, sync(dim, src(spark, A, B, C, (4, "upd", "w"))))
    assert rows(dim)[3] == (6, 4, "upd", "w")
    assert rows(sync(dim, src(spark, A, B, C, (4, "upd", "w")))) == rows(dim)


def test_hard_delete_and_high_water(spark):
    dim = spark.createDataFrame([(1, *A), (2, *B)], DIM)
    dim = kept(spark, sync(dim, src(spark, A), on_delete="drop", name_column=None))
    assert rows(dim) == [(1, *A)]
    again = sync(dim, src(spark, A, B), on_delete="drop", name_column=None, start=2)
    assert rows(again) == [(1, *A), (3, *B)]


def test_unknown_member_is_marked_unless_protected(spark):
    dim = with_unknown_member(spark.createDataFrame([(1, *A)], DIM), (0, 0, "Unknown", "?"))
    assert rows(sync(dim, src(spark, A)))[0] == (0, 0, "Unknown (Deleted)", "?")
    assert rows(sync(dim, src(spark, A), protect_keys=[0]))[0] == (0, 0, "Unknown", "?")
    dropped = sync(dim, src(spark, A), on_delete="drop", protect_keys=[0])
    assert rows(dropped) == [(0, 0, "Unknown", "?"), (1, *A)]


def test_update_can_keep_the_key(spark):
    dim = spark.createDataFrame([(1, *A), (2, *B)], DIM)
    source = src(spark, A, (2, "b2", "y"), (5, "new", "n"))
    assert rows(sync(dim, source, on_update="keep")) == [(1, *A), (2, 2, "b2", "y"), (3, 5, "new", "n")]


def test_keep_gives_new_keys_to_repeated_ids(spark):
    dim = spark.createDataFrame([(1, *A), (2, *B)], DIM)
    source = src(spark, A, (2, "b2", "y"), (2, "b3", "y"))
    got = rows(sync(dim, source, on_update="keep"))
    assert [r[0] for r in got] == [1, 3, 4] and {r[2] for r in got} == {"a", "b2", "b3"}


def test_repeated_ids_and_copies_follow_set_rules(spark):
    """One differing row of an ID replaces all its rows; source copies all come in."""
    dim = spark.createDataFrame([(1, *A), (2, 1, "a", "old"), (3, *B)], DIM)
    source = src(spark, A, A, (1, "a", "new"), B)
    got = rows(sync(dim, source))
    assert got[0] == (3, *B)
    assert [r[0] for r in got[1:]] == [4, 5, 6]
    assert sorted(r[1:] for r in got[1:]) == sorted([A, A, (1, "a", "new")])


def test_an_id_with_one_stale_row_is_marked_on_all_rows(spark):
    dim = spark.createDataFrame([(1, *A), (2, 1, "a", "old")], DIM)
    assert rows(sync(dim, src(spark, A))) == [
        (1, 1, "a (Deleted)", "x"),
        (2, 1, "a (Deleted)", "old"),
    ]


def test_null_ids_match_nothing(spark):
    dim = spark.createDataFrame([(1, None, "n", "x")], DIM)
    got = sync(dim, src(spark, (None, "m", "x"), A))
    assert sorted(map(str, rows(got))) == sorted(map(str, [(1, None, "n", "x"), (2, *A)]))


def test_null_attributes_compare_equal(spark):
    dim = spark.createDataFrame([(1, 1, "a", None)], DIM)
    assert rows(sync(dim, src(spark, (1, "a", None)))) == [(1, 1, "a", None)]


def test_wrong_options(spark):
    dim = spark.createDataFrame([], DIM)
    for bad in ({"on_delete": "x"}, {"on_update": "x"}, {"name_column": None}):
        with pytest.raises(ValueError):
            sync(dim, src(spark, A), **bad)
