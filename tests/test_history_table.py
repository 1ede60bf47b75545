"""A type 2 dimension that appends what it opens and closes, against the merge of whole tables."""

import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from starward.operators.history import scd2_merge
from starward.plans.dimensions import PATIENT
from starward.schemas import WAREHOUSE
from starward.sources import history as H
from starward.sources.history import HistoryTable

SCHEMA = WAREHOUSE["dim_patients"]


def people(spark, rows):
    return spark.createDataFrame([(i, f"P {i}", town, "WA", z) for i, town, z in rows], "PatientID bigint, PatientFullName string, PatientCity string, PatientState string, PatientZipCode int")


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def table(spark, tmp_path, name="t"):
    return HistoryTable(spark, str(tmp_path / name), SCHEMA, "PatientKey")


def files(t):
    return {f for part in t._rows.parts() for f in t._rows._read_folders([part.folder], t._rows.stored).inputFiles()}


@pytest.mark.parametrize("reclose", [(True,), (False,), (True, False)])
def test_runs_agree_with_the_merge_of_whole_tables(spark, tmp_path, reclose, monkeypatch):
    monkeypatch.setattr(H, "FOLD_SHARE", 0.5)
    rng = random.Random(len(reclose) + reclose[0])
    t, whole, top = table(spark, tmp_path), spark.createDataFrame([], SCHEMA), 0
    state = {i: ("Kent", 1) for i in range(12)}
    for run in range(4):
        day, again = date(2010, 1, 2 + run), reclose[run % len(reclose)]
        source = people(spark, [(i, town, z) for i, (town, z) in state.items()])
        counts = t.merge(source, PATIENT, day, reclose=again, unique=True)
        merged = scd2_merge(whole, source, PATIENT, "PatientKey", day, reclose=again, start=top)
        before, after = rows(whole), rows(merged)
        whole = spark.createDataFrame(after, SCHEMA)
        top = max(r[0] for r in after)
        assert rows(t.read()) == after, run
        assert rows(t.current()) == [r for r in after if r[-1] == 1] and t.high_water == top
        assert counts["opened"] == len(after) - len(before)
        for _ in range(4):  # one moves, one goes, one comes or comes back
            state[rng.randrange(14)] = (rng.choice(["Kent", "Auburn", "Renton"]), rng.randrange(3))
        state.pop(rng.choice(sorted(state)))


def test_a_run_without_changes_writes_nothing(spark, tmp_path):
    t = table(spark, tmp_path)
    t.merge(people(spark, [(1, "Kent", 1), (2, "Kent", 2)]), PATIENT, date(2010, 1, 2))
    moved = people(spark, [(1, "Auburn", 1), (2, "Kent", 2)])
    assert t.merge(moved, PATIENT, date(2010, 1, 3)) == {"opened": 1, "closed": 1}
    version, written = t.version, files(t)
    assert t.merge(moved, PATIENT, date(2010, 1, 3)) == {"opened": 0, "closed": 0}
    assert t.merge(moved, PATIENT, date(2010, 1, 4), reclose=False) == {"opened": 0, "closed": 0}
    assert t.version == version and files(t) == written
    # Another day that closes again what is closed is one row beside the table.
    t.merge(moved, PATIENT, date(2010, 1, 5))
    assert t.version == version + 1 and files(t) == written
    assert [r.EndDate for r in t.closed().collect()] == [date(2010, 1, 5)]


def test_folding_changes_no_row_and_current_rows_read_no_closed_ones(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(H, "FOLD_SHARE", 99)
    t = table(spark, tmp_path)
    for k in range(3):
        t.merge(people(spark, [(i, f"Town {k if i < 3 else 0}", 1) for i in range(6)]), PATIENT, date(2010, 1, 2 + k), reclose=False)
    before = rows(t.read())
    assert len(before) == 12 and {p.part for p in t._rows.parts()} == {"open", "closing"}
    t.fold()
    assert rows(t.read()) == before and {p.part: p.rows for p in t._rows.parts()} == {"open": 6, "closed": 6}
    assert not any("Kind=closed" in f for f in t.current().inputFiles())
    t.merge(people(spark, [(i, "Town 9", 1) for i in range(6)]), PATIENT, date(2010, 1, 9))
    assert {r.EndDate for r in t.closed().collect()} == {date(2010, 1, 9)} and t.current().count() == 6


def test_a_refused_row_is_seen_by_nobody(spark, tmp_path):
    t = table(spark, tmp_path)
    t.merge(people(spark, [(1, "Kent", 1)]), PATIENT, date(2010, 1, 2))

    def refuse(written):
        assert rows(written.select("PatientID")) == [(2,)]
        raise ValueError("no")

    with pytest.raises(ValueError, match="no"):
        t.merge(people(spark, [(2, "Kent", 1)]), PATIENT, date(2010, 1, 3), check=refuse)
    assert [r.PatientID for r in t.read().collect()] == [1] and t.read().where(F.col("IsCurrent") == 1).count() == 1
