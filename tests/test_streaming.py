from datetime import date

import pytest

import feeds as files
from starward.plans.file_load import Operational
from starward.streaming.daily_files import load_new_files


def test_each_file_is_loaded_once_even_when_a_checkpoint_is_lost(spark, tmp_path):
    folder = files.write_day(tmp_path / "in")
    into = Operational(str(tmp_path / "op"))
    for _ in range(2):
        load_new_files(spark, folder, into, str(tmp_path / "cp1"))
        assert into.visits(spark).count() == 154
        assert into.patients(spark).count() == 6
    files.write_day(tmp_path / "in", date(2010, 1, 3))
    load_new_files(spark, folder, into, str(tmp_path / "cp2"))
    days = {r.VisitDay: r["count"] for r in into.visits(spark).groupBy("VisitDay").count().collect()}
    assert days == {date(2010, 1, 2): 154, date(2010, 1, 3): 154}
    assert into.patients(spark).count() == 6


def test_bad_and_undated_input_ends_the_stream(spark, tmp_path):
    folder = files.write_day(tmp_path / "in")
    into = Operational(str(tmp_path / "op"))
    files.write(tmp_path / "in" / "Bellevue" / "20100104Visits.csv", files.VISIT_HEADS["Bellevue"], ["9:00,1,2,3"])
    with pytest.raises(Exception, match="doesn't fit its layout"):
        load_new_files(spark, folder, into, str(tmp_path / "cp1"))
    load_new_files(spark, folder, into, str(tmp_path / "cp2"), on_bad_line="skip")
    assert into.visits(spark).count() == 154
    files.write(tmp_path / "in" / "Bellevue" / "newVisits.csv", files.VISIT_HEADS["Bellevue"], ["9:00,1,2,3,4.00"])
    with pytest.raises(Exception, match="no day in the file name"):
        load_new_files(spark, folder, into, str(tmp_path / "cp2"), on_bad_line="skip")


def test_a_batch_repeated_after_a_failure_is_known_by_its_commit(spark, tmp_path, monkeypatch):
    from starward.streaming import daily_files as S

    folder = files.write_day(tmp_path / "in")
    into = Operational(str(tmp_path / "op"))
    append = S.append_visits

    def append_then_die(*args):
        append(*args)
        raise RuntimeError("lost between the commit and the checkpoint")

    monkeypatch.setattr(S, "append_visits", append_then_die)
    with pytest.raises(Exception, match="lost between"):
        load_new_files(spark, folder, into, str(tmp_path / "cp"))
    assert into.visits(spark).count() == 154
    calls = []
    monkeypatch.setattr(S, "append_visits", lambda *args: calls.append(args))
    load_new_files(spark, folder, into, str(tmp_path / "cp"))
    assert calls == [] and into.visits(spark).count() == 154  # not even compared with the table
    batches = [r.batch for r in into.visits_table(spark).commits().collect()]
    assert len(batches) == 1 and batches[0].startswith("Visits/") and batches[0].endswith("/0")
