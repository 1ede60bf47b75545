"""Every registered query against its SQL, on the smallest test tables."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract

FOLDER = Path("/root/testdata/sf0.001")
QUERIES, SQL = contract.QUERIES, contract.ORACLE_SQL
JOBS = {"x1_daily_files", "x2_warehouse", "x3_streamed_files"}

pytestmark = pytest.mark.skipif(not FOLDER.exists(), reason="no test tables here")


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for file in FOLDER.glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def normal(value):
    if value is None or value != value:
        return "null"
    return f"{value:.4f}" if isinstance(value, (int, float)) and not isinstance(value, bool) else str(value)


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted([normal(r[i]) for i in order] for r in rows)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, db, name):
    got = QUERIES[name](spark, str(FOLDER))
    want = db.execute(SQL[name])
    columns = [d[0] for d in want.description]
    assert sorted(got.columns) == sorted(columns)
    assert table(got.columns, [tuple(r) for r in got.collect()]) == table(columns, want.fetchall())


def test_entry_runs(spark):
    report = contract.entry(spark)
    assert report.columns == ["MonthID", "MonthName", "ClinicName", "visits", "charge"]
    assert report.count() > 0
