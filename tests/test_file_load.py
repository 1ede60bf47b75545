from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

import feeds as files
from starward.plans.file_load import (
    Operational,
    load_daily_files,
    loaded_between,
    loaded_on,
    new_patients,
    new_visits,
    visit_rows,
    visits_in_order,
)
from starward.schemas import OPERATIONAL
from starward.sources.feeds import conform_feed, delivered_files, read_feed, read_feed_by_header, read_feeds, rejected_lines
from starward.sources.tables import jdbc_options


@pytest.fixture
def folder(tmp_path):
    return files.write_day(tmp_path / "in")


def test_feeds_are_read_by_layout_and_day(spark, folder):
    redmond = read_feed(spark, folder, "Redmond", "Visits")
    assert redmond.columns == ["Time", "Clinic", "Patient", "Doctor", "Procedure", "Charge", "FileDay"]
    first = redmond.where("Patient = '0'").first()
    assert first.Time == "9:00" and first.Clinic == "3" and first.Charge == "100"
    assert first.FileDay == files.DAY
    same = read_feed_by_header(spark, f"{folder}/Redmond/20100102Visits.csv")
    assert same.columns[0] == "Time" and same.count() == 56


def test_wrong_header_order_raises(spark, folder):
    layout = read_feed(spark, folder, "Kirkland", "Visits").drop("FileDay").schema
    with pytest.raises(Exception, match="header|CSV"):
        read_feed(spark, folder, "Redmond", "Visits", schema=layout).collect()


def test_conformed_shape(spark, folder):
    feeds = read_feeds(spark, folder, "Visits")
    assert {tuple(f.columns) for f in feeds.values()} == {
        ("Time", "Clinic", "Patient", "Doctor", "Procedure", "Charge", "FileDay")
    }
    assert {c: f.count() for c, f in feeds.items()} == files.COUNTS
    assert feeds["Bellevue"].where("Clinic IS NOT NULL").isEmpty()


def test_visit_types_and_clinic_numbers(spark, folder):
    numbers = {}
    for clinic, feed in read_feeds(spark, folder, "Visits").items():
        rows = visit_rows(feed, clinic, files.DAY)
        numbers[clinic] = [r.Clinic for r in rows.select("Clinic").distinct().collect()]
        assert rows.agg(F.min("Date")).first()[0] == datetime(2010, 1, 2, 9)
    assert numbers == {"Bellevue": [100], "Kirkland": [200], "Redmond": [300]}


def test_two_runs_load_once_and_number_densely(spark, folder, tmp_path):
    into = Operational(str(tmp_path / "op"))
    for added in ({"patients": 6, "visits": 154}, {"patients": 0, "visits": 0}):
        assert load_daily_files(spark, folder, into, files.DAY) == added
        assert into.visits(spark).count() == 154
        assert into.patients(spark).count() == 6
    ids = into.visits(spark).agg(F.min("ID"), F.max("ID"), F.countDistinct("ID")).first()
    assert ids[:] == (1, 154, 154)
    emails = [r.Email for r in into.patients(spark).orderBy("LName").collect()]
    assert emails[0] == "ann.example.com (Invalid) " and emails[5] == "flo@example (Invalid) "
    ordered = visits_in_order(into.visits(spark)).select("ID").collect()
    by_id = into.visits(spark).orderBy("ID").select("Date", "Clinic").collect()
    assert len(ordered) == 154 and by_id == sorted(by_id)


def test_next_day_continues_the_numbers(spark, folder, tmp_path):
    into = Operational(str(tmp_path / "op"))
    load_daily_files(spark, folder, into, files.DAY)
    files.write_day(tmp_path / "in", date(2010, 1, 3))
    load_daily_files(spark, folder, into, date(2010, 1, 3))
    visits = into.visits(spark)
    assert visits.count() == 308 and into.patients(spark).count() == 6
    assert visits.where("VisitDay = '2010-01-03'").agg(F.min("ID")).first()[0] == 155


def test_loaded_rows_of_the_day_are_pruned_by_partition(spark, folder, tmp_path):
    into = Operational(str(tmp_path / "op"))
    load_daily_files(spark, folder, into, files.DAY)
    again = new_visits(read_feeds(spark, folder, "Visits"), into.visits(spark), files.DAY)
    plan = again._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [(isnull(VisitDay" in plan
    assert again.isEmpty()


def test_days_of_a_batch_bound_the_history(spark):
    visits = spark.createDataFrame(
        [(i, at, 100, 1, 1, 1, None) for i, at in enumerate(
            [datetime(2010, 1, 1, 23), datetime(2010, 1, 2), datetime(2010, 1, 3, 23, 59), None])],
        OPERATIONAL["visits"],
    )
    kept = loaded_between(visits, date(2010, 1, 2), date(2010, 1, 3))
    assert sorted(r.ID for r in kept.collect()) == [1, 2, 3]
    stored = visits.withColumn("VisitDay", F.to_date("Date"))
    days = spark.createDataFrame([(date(2010, 1, 1),), (date(2010, 1, 3),), (None,)], "VisitDay date")
    assert sorted(r.ID for r in loaded_on(stored, days).collect()) == [0, 2, 3]
    assert [r.ID for r in loaded_on(stored, days.where("VisitDay IS NULL")).collect()] == [3]


def test_lines_that_do_not_fit_end_the_load_or_are_told(spark, tmp_path):
    folder = files.write_day(tmp_path / "in")
    lines = ["9:00,1,2,3,4,5.00", "9:30,1,2,3,4", "10:00,1,2,3,4,5.00,more"]
    files.write(tmp_path / "in" / "Kirkland" / "20100102Visits.csv", files.VISIT_HEADS["Kirkland"], lines)
    into = Operational(str(tmp_path / "op"))
    with pytest.raises(Exception, match="doesn't fit its layout"):
        load_daily_files(spark, folder, into, files.DAY)
    with pytest.raises(Exception, match="doesn't fit its layout"):
        read_feed(spark, folder, "Kirkland", "Visits").select("Time").collect()
    told = rejected_lines(spark, folder, "Kirkland", "Visits").collect()
    assert sorted(r.Line for r in told) == sorted(lines[1:]) and {r.File for r in told} == {"20100102Visits.csv"}
    assert load_daily_files(spark, folder, into, files.DAY, on_bad_line="skip")["visits"] == 50 + 1 + 56


def test_a_file_without_a_day_ends_the_load(spark, tmp_path):
    folder = files.write_day(tmp_path / "in")
    files.write(tmp_path / "in" / "Redmond" / "latestVisits.csv", files.VISIT_HEADS["Redmond"], ["9:00,3,1,2,3,4.00"])
    with pytest.raises(Exception, match="no day in the file name"):
        load_daily_files(spark, folder, Operational(str(tmp_path / "op")))
    assert load_daily_files(spark, folder, Operational(str(tmp_path / "op2")), files.DAY)["visits"] == 154


def test_loaded_row_with_null_counts_as_equal(spark):
    patients = spark.createDataFrame(
        [(1, "Ann", "Ames", "a@b.com", None, "K", "WA", 98000)], OPERATIONAL["patients"]
    )
    feed = patients.drop("ID").withColumn("ZipCode", F.col("ZipCode").cast("string"))
    assert new_patients({"Redmond": feed}, patients).isEmpty()
    moved = feed.withColumn("Address", F.lit("9 New St"))
    assert new_patients({"Redmond": moved, "Kirkland": moved}, patients).count() == 1


def test_collation_is_an_option(spark):
    patients = spark.createDataFrame(
        [(1, "ann", "ames", "a@b.com", "x", "K", "WA ", 98000)], OPERATIONAL["patients"]
    )
    feed = patients.drop("ID").withColumn("ZipCode", F.col("ZipCode").cast("string"))
    other = feed.withColumn("FName", F.lit("ANN")).withColumn("State", F.lit("wa"))
    assert new_patients({"Redmond": other}, patients).count() == 1
    assert new_patients({"Redmond": other}, patients, "UTF8_LCASE_RTRIM").isEmpty()
    fresh = new_patients({"Redmond": other}, patients.where("false"), "UTF8_LCASE_RTRIM")
    assert fresh.dtypes == patients.drop("ID").dtypes


def test_conform_keeps_unknown_days(spark):
    feed = spark.createDataFrame([("9:00", "1", "2", "3", "4")], "Time string, Patient string, Doctor string, Procedure string, Charge string")
    assert conform_feed(feed, "Visits").first()[:] == ("9:00", None, "1", "2", "3", "4")


def test_jdbc_split_needs_bounds():
    options = jdbc_options("jdbc:x", "Patients", "ID", 1, 1000, 8)
    assert options["numPartitions"] == "8" and options["partitionColumn"] == "ID"
    with pytest.raises(ValueError):
        jdbc_options("jdbc:x", "Patients", "ID")


def test_files_delivered_again_are_told(spark, tmp_path):
    from starward.plans.file_load import Redelivered

    folder = files.write_day(tmp_path / "in")
    into = Operational(str(tmp_path / "op"))
    load_daily_files(spark, folder, into, files.DAY)
    load_daily_files(spark, folder, into, files.DAY)  # as they were
    first = {(r.Clinic, r.Kind): (r.Lines, r.State) for r in into.files(spark).collect()}
    assert first[("Redmond", "Visits")] == (56, "new") and len(first) == 6 and into.files(spark).count() == 6
    lines = ["9:00,3,1,1,1,5"]
    files.write(tmp_path / "in" / "Redmond" / "20100102Visits.csv", files.VISIT_HEADS["Redmond"], lines)
    with pytest.raises(Redelivered, match="Redmond/20100102Visits.csv"):
        load_daily_files(spark, folder, into, files.DAY, on_redelivered="fail")
    assert into.visits(spark).count() == 154 and into.files(spark).count() == 6
    assert load_daily_files(spark, folder, into, files.DAY) == {"patients": 0, "visits": 1}
    changed = into.files(spark).where("State = 'changed'").collect()
    assert [(r.Clinic, r.File, r.Lines) for r in changed] == [("Redmond", "20100102Visits.csv", 1)]


def test_a_feed_reads_the_folders_of_its_days_only(spark, tmp_path):
    folder = files.write_day(tmp_path / "in")
    into = Operational(str(tmp_path / "op"))
    load_daily_files(spark, folder, into, files.DAY)
    files.write_day(tmp_path / "in", date(2010, 1, 3))
    assert load_daily_files(spark, folder, into, date(2010, 1, 3))["visits"] == 154
    table = into.visits_table(spark)
    assert [(p.part, p.rows) for p in table.parts()] == [("2010-01-02", 154), ("2010-01-03", 154)]
    assert all("VisitDay=2010-01-03" in f for f in table.read([date(2010, 1, 3), None]).inputFiles())
    assert table.high_water == 308 and into.visits(spark).select("ID").distinct().count() == 308


def test_names_are_searched_once_a_file(spark, folder):
    """Not for each line: a day's load knows its day, and lines are counted by path before the name is cut out."""
    plan = read_feed(spark, folder, "Redmond", "Visits", files.DAY)._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_extract" not in plan and read_feed(spark, folder, "Redmond", "Visits", files.DAY).first().FileDay == files.DAY
    plan = delivered_files(spark, folder, "Visits")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate [_path#") == 3


def test_a_file_in_parts_is_one_file(spark, tmp_path):
    """Header lines with and without a mark are left out in every part, and no other line is."""
    for clinic in files.COUNTS:
        at = tmp_path / clinic / "20100102Visits.csv"
        files.write(at / "part-0.csv", files.VISIT_HEADS[clinic], list(files.visit_lines(clinic, 3)))
        (at / "part-1.csv").write_text("\n".join([files.VISIT_HEADS[clinic], "\ufeffother"]))
    found = {r.Clinic: (r.File, r.Lines) for r in delivered_files(spark, str(tmp_path), "Visits").collect()}
    assert found == {clinic: ("20100102Visits.csv", 4) for clinic in files.COUNTS}


def test_a_load_that_adds_nothing_numbers_nothing(spark, folder, tmp_path, monkeypatch):
    into = Operational(str(tmp_path / "op"))
    first = load_daily_files(spark, folder, into, files.DAY)
    assert first["visits"] > 0 and first["patients"] > 0
    monkeypatch.setattr("starward.plans.file_load.assign_keys", lambda *_, **__: pytest.fail("numbered"))
    assert load_daily_files(spark, folder, into, files.DAY) == {"patients": 0, "visits": 0}
