from datetime import date

import pytest

from starward.operators.history import scd2_merge
from starward.schemas import WAREHOUSE

COLS = ["PatientID", "PatientFullName", "PatientCity", "PatientState", "PatientZipCode"]
D1, D2, D3 = date(2010, 1, 1), date(2010, 1, 2), date(2010, 1, 3)


def src(spark, *rows):
    return spark.createDataFrame(
        list(rows),
        "PatientID bigint, PatientFullName string, PatientCity string, PatientState string, PatientZipCode int",
    )


def merge(spark, dim, source, day, **how):
    out = scd2_merge(dim, source, COLS, "PatientKey", day, **how)
    return spark.createDataFrame(out.collect(), WAREHOUSE["dim_patients"])


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def patient(i, city="Kent"):
    return (i, f"P {i}", city, "WA", 98000)


@pytest.fixture
def filled(spark):
    empty = spark.createDataFrame([], WAREHOUSE["dim_patients"])
    return merge(spark, empty, src(spark, patient(1), patient(2)), D1)


def test_first_fill_is_open(filled):
    assert rows(filled) == [
        (1, *patient(1), D1, None, 1),
        (2, *patient(2), D1, None, 1),
    ]


def test_change_vanish_and_insert(spark, filled):
    got = merge(spark, filled, src(spark, patient(1, "Auburn"), patient(3)), D2)
    assert rows(got) == [
        (1, *patient(1), D1, D2, 0),
        (2, *patient(2), D1, D2, 0),
        (3, *patient(1, "Auburn"), D2, None, 1),
        (4, *patient(3), D2, None, 1),
    ]


def test_rerun_moves_old_end_dates_only_when_reclosing(spark, filled):
    source = src(spark, patient(1, "Auburn"), patient(2))
    second = merge(spark, filled, source, D2)
    assert rows(merge(spark, second, source, D3, reclose=False)) == rows(second)
    moved = rows(merge(spark, second, source, D3))
    assert moved[0] == (1, *patient(1), D1, D3, 0)
    assert moved[1:] == rows(second)[1:]


def test_a_returning_version_gets_a_new_row(spark, filled):
    away = merge(spark, filled, src(spark, patient(2)), D2)
    back = merge(spark, away, src(spark, patient(1), patient(2)), D3, reclose=False)
    assert rows(back) == [
        (1, *patient(1), D1, D2, 0),
        (2, *patient(2), D1, None, 1),
        (3, *patient(1), D3, None, 1),
    ]


def test_null_attribute_never_matches(spark):
    empty = spark.createDataFrame([], WAREHOUSE["dim_patients"])
    source = src(spark, (1, "P 1", None, "WA", 98000))
    first = merge(spark, empty, source, D1)
    second = rows(merge(spark, first, source, D2))
    assert [(r[0], r[6], r[7], r[8]) for r in second] == [(1, D1, D2, 0), (2, D2, None, 1)]


def test_source_copies_each_come_in_then_match(spark):
    empty = spark.createDataFrame([], WAREHOUSE["dim_patients"])
    source = src(spark, patient(1), patient(1))
    first = merge(spark, empty, source, D1)
    assert [r[0] for r in rows(first)] == [1, 2]
    assert rows(merge(spark, first, source, D2)) == rows(first)
