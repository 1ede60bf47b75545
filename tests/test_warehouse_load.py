from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from starward.operators import quality
from starward.plans import dimensions as D
from starward.plans.facts import fact_visits_src
from starward.plans.readback import charges_by_month, star_readback
from starward.plans.warehouse_load import Warehouse, load_warehouse, stage_sources
from starward.schemas import OPERATIONAL, WAREHOUSE
from starward.sources.snapshots import SnapshotTable

D1, D2 = date(2010, 1, 2), date(2010, 1, 3)
NOW = datetime(2010, 1, 2, 1)
FACTS = ("fact_doctor_shifts", "fact_visits")


def sources(spark, **changed):
    rows = {
        "clinics": [(i, f"Clinic {i}", "a", "Town", "WA", "98000") for i in (1, 2, 3)],
        "doctors": [(i, "Doc", f"No{i}", f"d{i}@x.com", "Kent", "WA", "98000") for i in (1, 2)],
        "shifts": [(1, "09:00:00", "05:00:00"), (2, "01:00:00", "21:00:00"), (3, "21:00:00", "09:00:00")],
        "doctor_shifts": [
            (1, date(2010, 1, 2), 1, 1, 1),
            (2, date(2010, 1, 2), 2, 3, 2),
            (3, date(2010, 1, 2), 2, 3, 99),
        ],
        "patients": [(i, "P", str(i), "e", "a", "Kent", "WA", 98000) for i in (1, 2)],
        "procedures": [(1, "X-ray", "d", Decimal(348)), (2, "Scan", "d", Decimal(50))],
        "visits": [
            (1, datetime(2010, 1, 2, 9), 100, 1, 1, 1, Decimal(1)),
            (2, datetime(2010, 1, 2, 10), 300, 2, 2, 2, Decimal(1)),
            (3, datetime(2010, 1, 2, 11), 300, 2, None, 2, Decimal(1)),
            (4, datetime(2010, 1, 2, 11), 400, 2, 2, 2, Decimal(1)),
            (5, datetime(1999, 1, 2, 11), 100, 2, 2, 2, Decimal(1)),
        ],
    } | changed
    return {n: spark.createDataFrame(r, OPERATIONAL[n]) for n, r in rows.items()}


def load(spark, w, as_of=D1, **how):
    given = how.pop("sources", None) or sources(spark)
    load_warehouse(w, stage_sources(spark, given, w.root), as_of, NOW, **how)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture(scope="module")
def loaded(spark, tmp_path_factory):
    w = Warehouse(spark, str(tmp_path_factory.mktemp("w1")))
    load(spark, w)
    return w


def test_first_load(loaded):
    counts = {n: loaded.read(n).count() for n in WAREHOUSE if n != "etl_log"}
    assert counts == {
        "dim_clinics": 3,
        "dim_dates": 2556,
        "dim_doctors": 3,
        "dim_patients": 2,
        "dim_procedures": 2,
        "dim_shifts": 3,
        "fact_doctor_shifts": 2,
        "fact_visits": 2,
    }
    facts = loaded.read("fact_visits").orderBy("VisitKey").collect()
    assert [(f.VisitKey, f.DoctorKey, f.ProcedureVistCharge) for f in facts] == [
        (1, 1, Decimal(348)),
        (2, 2, Decimal(50)),
    ]
    assert [r.HoursWorked for r in loaded.read("fact_doctor_shifts").orderBy("DoctorsShiftID").collect()] == [8, 12]
    assert loaded.read("dim_doctors").where("DoctorKey = 0").first().DoctorFullName == "Unknown (Deleted)"


def test_log_names_every_step_in_order(loaded):
    log = loaded.log().orderBy("ETLLogID").collect()
    assert [r.ETLLogID for r in log][:8] == list(range(1, 9))
    assert [r.ETLAction for r in log][:8] == [
        "sync dim_clinics",
        "sync dim_doctors",
        "sync dim_patients",
        "sync dim_procedures",
        "sync dim_shifts",
        "sync dim_dates",
        "sync fact_doctor_shifts",
        "sync fact_visits",
    ]
    assert log[7].ETLLogMessage == "fact_visits synced: 2 inserted, 0 deleted"


def test_a_second_run_writes_only_what_changed(loaded):
    before = {n: loaded.table(n).version for n in ("fact_visits", "fact_doctor_shifts", "dim_dates", "dim_clinics", "dim_shifts")}
    load_warehouse(loaded, stage_sources(loaded.spark, sources(loaded.spark), loaded.root), date(2010, 1, 2), NOW)
    after = {n: loaded.table(n).version for n in before}
    assert after == before


def test_broken_rules_block_the_commit_or_are_told(spark, tmp_path):
    given = sources(spark)
    given["shifts"] = spark.createDataFrame([(1, "09:00:00", "05:30:00"), (2, "01:00:00", "21:00:00")], given["shifts"].schema)
    w = Warehouse(spark, str(tmp_path / "w"))
    staged = stage_sources(spark, given, w.root)
    with pytest.raises(Exception, match="dim_shifts not committed, ShiftEnd is null: 1 rows"):
        load_warehouse(w, staged, date(2010, 1, 2), NOW)
    assert w.table("dim_shifts").version == 0 and w.table("fact_visits").version == 0
    load_warehouse(w, staged, date(2010, 1, 2), NOW, on_violation="report")
    assert w.table("dim_shifts").version == 1 and w.table("fact_visits").version == 1
    notes = [r.ETLLogMessage for r in w.log().where("ETLAction = 'sync dim_shifts'").collect()]
    assert any("broken rules: ShiftEnd is null: 1 rows" in n for n in notes)


def test_star_keeps_every_fact(loaded):
    star = star_readback(*[loaded.read(n) for n in (
        "fact_visits", "dim_clinics", "dim_dates", "dim_doctors", "dim_patients", "dim_procedures")])
    assert star.count() == 2
    report = charges_by_month(star).orderBy("ClinicName").collect()
    assert [(r.MonthName, r.ClinicName, r.visits, r.charge) for r in report] == [
        ("January 2010", "Clinic 1", 1, Decimal(348)),
        ("January 2010", "Clinic 3", 1, Decimal(50)),
    ]


def test_constraints_hold(loaded):
    for name in WAREHOUSE:
        if name != "etl_log":
            assert quality.warehouse_row_violations(name, loaded.read(name)).isEmpty(), name
    facts = loaded.read("fact_visits")
    assert quality.duplicate_keys(facts, facts.columns[:-1]).isEmpty()
    assert quality.orphans(facts, "PatientKey", loaded.read("dim_patients"), "PatientKey").isEmpty()


def test_second_load_changes_nothing(spark, loaded):
    before = {n: rows(loaded.read(n)) for n in WAREHOUSE if n != "etl_log"}
    load(spark, loaded)
    assert {n: rows(loaded.read(n)) for n in before} == before


def test_member_mode_and_changed_patient(spark, tmp_path):
    w = Warehouse(spark, str(tmp_path / "w"))
    load(spark, w, unknown="member", protect_unknown=True)
    assert {r.VisitKey: r.DoctorKey for r in w.read("fact_visits").collect()} == {1: 1, 2: 2, 3: 0}
    assert w.read("dim_doctors").where("DoctorKey = 0").first().DoctorFullName == "Unknown"
    moved = sources(spark, patients=[(1, "P", "1", "e", "a", "Auburn", "WA", 98000), (2, "P", "2", "e", "a", "Kent", "WA", 98000)])
    load(spark, w, D2, sources=moved, unknown="member", protect_unknown=True, reclose=False)
    patients = {r.PatientKey: (r.PatientID, r.IsCurrent, r.EndDate) for r in w.read("dim_patients").collect()}
    assert patients == {1: (1, 0, D2), 2: (2, 1, None), 3: (1, 1, None)}
    # All of the patient's visits, the old one too, point to the newest version.
    assert {r.VisitKey: r.PatientKey for r in w.read("fact_visits").collect()} == {1: 3, 2: 2, 3: 2}
    last = w.log().orderBy(F.desc("ETLLogID")).first()
    assert last.ETLLogMessage == "fact_visits synced: 1 inserted, 1 deleted"


def test_failed_step_logs_and_keeps_the_last_state(spark, tmp_path, monkeypatch):
    w = Warehouse(spark, str(tmp_path / "w"))
    bad = sources(spark)
    bad["procedures"] = bad["procedures"].drop("Desc")
    with pytest.raises(Exception, match="Desc"):
        load(spark, w, sources=bad)
    assert w.read("dim_patients").count() == 2
    assert w.table("dim_procedures").version == 0 and w.table("fact_visits").version == 0
    log = {r.ETLAction: r.ETLLogMessage for r in w.log().collect()}
    assert "Desc" in log["sync dim_procedures"] and log["sync dim_dates"] == "dim_dates synced"
    assert len(log) == 6


def test_snapshot_survives_a_failed_write(spark, tmp_path):
    table = SnapshotTable(spark, str(tmp_path / "t"), WAREHOUSE["dim_shifts"])
    good = spark.createDataFrame([(7, 1, "a", "b")], WAREHOUSE["dim_shifts"])
    table.commit(good, key="ShiftKey")
    broken = table.read().withColumn("ShiftID", F.raise_error(F.lit("lost")).cast("int"))
    with pytest.raises(Exception, match="lost"):
        table.commit(broken, key="ShiftKey")
    assert table.version == 1 and rows(table.read()) == [(7, 1, "a", "b")]
    table.commit(table.read().where("false"), key="ShiftKey")
    assert table.version == 2 and table.read().isEmpty() and table.high_water == 7
    assert rows(table.read(version=1)) == [(7, 1, "a", "b")]


def facts_of(spark, visits, patients, small=lambda df: df, **how):
    s = sources(spark)
    keyed = {
        "clinics": D.dim_clinics_src(s["clinics"]).withColumn("ClinicKey", F.col("ClinicID").cast("bigint")),
        "doctors": D.dim_doctors_src(s["doctors"]).withColumn("DoctorKey", F.col("DoctorID")),
        "procedures": D.dim_procedures_src(s["procedures"]).withColumn("ProcedureKey", F.col("ProcedureID")),
    }
    dates = D.dim_dates(spark, date(2010, 1, 2), date(2010, 1, 2))
    keyed = {name: small(df) for name, df in keyed.items()}
    return fact_visits_src(visits, small(dates), patients=patients, **keyed, **how)


def test_only_the_current_version_counts_and_copies_are_summed(spark):
    patients = spark.createDataFrame(
        [(10, 1, "a", "b", "c", 1, D1, D2, 0), (11, 1, "a", "b2", "c", 1, D2, None, 1)],
        WAREHOUSE["dim_patients"],
    )
    visit = (1, datetime(2010, 1, 2, 9), 100, 1, 1, 1, Decimal(1))
    visits = spark.createDataFrame([visit, visit], OPERATIONAL["visits"])
    assert [(r.PatientKey, r.ProcedureVistCharge) for r in facts_of(spark, visits, patients).collect()] == [
        (11, Decimal(696))
    ]


def hot(spark, tmp_path, n=60000):
    """A third of the visits have no doctor and a third belong to one patient."""
    i = F.col("id")
    spark.range(n).select(
        i.alias("ID"),
        F.lit(datetime(2010, 1, 2, 9)).cast("timestamp_ntz").alias("Date"),
        F.lit(100).alias("Clinic"),
        F.when(i % 3 == 1, 1).otherwise(i % 1000).cast("bigint").alias("Patient"),
        F.when(i % 3 != 0, i % 2 + 1).cast("bigint").alias("Doctor"),
        (i % 2 + 1).alias("Procedure"),
        F.lit(1).cast("decimal(19,4)").alias("Charge"),
    ).write.parquet(str(tmp_path / "visits"))
    i = F.col("id")
    spark.range(1000).select(
        i.alias("PatientKey"),
        i.alias("PatientID"),
        F.lit("x").alias("PatientFullName"),
        F.lit(1).alias("IsCurrent"),
    ).write.parquet(str(tmp_path / "patients"))
    return spark.read.parquet(str(tmp_path / "visits")), spark.read.parquet(str(tmp_path / "patients"))


def test_hot_patient_is_split_and_the_facts_stay_whole(spark, tmp_path):
    visits, patients = hot(spark, tmp_path)
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        facts = facts_of(spark, visits, patients, unknown="member")
        assert facts.agg(F.count("*"), F.countDistinct("VisitKey")).first()[:] == (60000, 60000)
        facts.collect()
        plan = facts._jdf.queryExecution().executedPlan().toString()
        assert "isSkew=true" in plan or "skew=true" in plan
        assert "SinglePartition" not in plan
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_null_ids_spread_over_the_partitions(spark, tmp_path):
    """The join's hash key holds the slot, so a missing doctor is not one partition's work."""
    visits, patients = hot(spark, tmp_path, 3000)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = facts_of(spark, visits, patients, unknown="member")._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning(_doctor" in plan
        at = plan.index("hashpartitioning(_doctor")
        assert "_slot" in plan[at : at + 60]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_grouping_uses_the_patient_shuffle(spark, tmp_path):
    """Patients too large to broadcast cost one shuffle of the visits; the sum costs no second."""
    visits, patients = hot(spark, tmp_path, 3000)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        facts = facts_of(spark, visits, patients, small=F.broadcast)
        plan = facts._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("SortMergeJoin") == 1 and plan.count("BroadcastHashJoin") == 4
    assert plan.count("Exchange hashpartitioning") == 2


def data_files(folder):
    return sorted(str(p.relative_to(folder)) for p in folder.rglob("*.parquet"))


def test_a_run_without_changes_leaves_every_table_as_it_was(spark, tmp_path):
    w = Warehouse(spark, str(tmp_path / "w"))
    load(spark, w)
    tables = [n for n in WAREHOUSE if n != "etl_log"]
    before = {n: data_files(tmp_path / "w" / n) for n in tables}
    load(spark, w)
    assert {n: data_files(tmp_path / "w" / n) for n in tables} == before
    assert w.log().count() == 16 and len(data_files(tmp_path / "w" / "etl_log")) == 4  # one file for each group of steps


def test_a_changed_month_is_the_only_one_written(spark, tmp_path):
    w = Warehouse(spark, str(tmp_path / "w"))
    visits = [(i, datetime(2010, 1 + i % 4, 2, 9), 100, 1, 1, 1, Decimal(1)) for i in range(1, 13)]
    load(spark, w, sources=sources(spark, visits=visits))
    before = {p.part: p.folder for p in w.table("fact_visits").parts()}
    assert list(before) == ["201001", "201002", "201003", "201004"]
    changed = [v for v in visits if v[0] != 5] + [(20, datetime(2010, 2, 3, 9), 100, 1, 1, 2, Decimal(1))]
    load(spark, w, sources=sources(spark, visits=changed))
    after = {p.part: p.folder for p in w.table("fact_visits").parts()}
    assert [p for p in after if after[p] != before[p]] == ["201002"]
    assert sorted(r.VisitKey for r in w.read("fact_visits").collect()) == [1, 2, 3, 4, 6, 7, 8, 9, 10, 11, 12, 20]
    assert w.retire() == 1 and w.read("fact_visits").count() == 12


def test_the_run_counts_what_it_reads_drops_and_adds(spark, loaded):
    counts = {(r.table_name, r.part): r.n_rows for r in loaded.counts().where(F.col("run_at") == F.lit(NOW)).collect()}
    visits = {part: n for (name, part), n in counts.items() if name == "fact_visits"}
    lost = {part.removeprefix("dropped by "): n for part, n in visits.items() if part.startswith("dropped")}
    assert lost == {"dim_dates": 1, "dim_clinics": 1, "dim_procedures": 0, "dim_doctors": 1, "dim_patients": 0} and visits["read"] == 5
    from starward.sources.ledger import balances

    assert all(r.balanced for r in balances(loaded.counts()).collect())


def test_a_fact_without_its_member_is_refused_told_or_set_aside(spark, loaded, tmp_path):
    from starward.operators.quality import split_by_reference
    from starward.plans.facts import VISIT_FACT
    from starward.plans.warehouse_load import Violation, guard, merge_facts

    dims = {n: loaded.read(n) for n in WAREHOUSE if n.startswith("dim_")}
    good = loaded.table("fact_visits").read(stored=True)
    bad = good.withColumn("DoctorKey", F.lit(77).cast("bigint")).withColumn("VisitKey", F.col("VisitKey") + 100)
    both = good.unionByName(bad.withColumn("ClinicKey", F.when(F.col("VisitKey") == 101, 99).otherwise(F.col("ClinicKey"))))
    w, told = Warehouse(spark, str(tmp_path / "w")), {}
    table = w.table("fact_visits")
    with pytest.raises(Violation, match="ClinicKey not in dim_clinics: 1 rows; DoctorKey not in dim_doctors: 2 rows"):
        merge_facts(table, both, VISIT_FACT, check=guard("fact_visits", "block", told, lambda: dims))
    assert table.version == 0 and told == {}
    kept, rejected = split_by_reference("fact_visits", both, dims)
    assert rows(kept) == rows(good)
    assert {r.VisitKey: r.reason for r in rejected.collect()} == {
        101: "ClinicKey not in dim_clinics; DoctorKey not in dim_doctors",
        102: "DoctorKey not in dim_doctors",
    }
    merge_facts(table, both, VISIT_FACT, check=guard("fact_visits", "report", told, lambda: dims))
    assert table.rows() == 4 and "DoctorKey not in dim_doctors: 2 rows" in told["fact_visits"]


def test_rejects_are_kept_with_their_reason(spark, tmp_path, monkeypatch):
    from starward.plans import warehouse_load as W

    source = W.fact_visits_src
    monkeypatch.setattr(W, "fact_visits_src", lambda *a, **k: source(*a, **k).withColumn("DoctorKey", F.col("DoctorKey") * 10))
    w = Warehouse(spark, str(tmp_path / "w"))
    load(spark, w, on_violation="reject")
    assert w.read("fact_visits").count() == 0 and w.read("fact_doctor_shifts").count() == 2
    assert sorted((r.VisitKey, r.reason) for r in w.rejects("fact_visits").collect()) == [
        (1, "DoctorKey not in dim_doctors"),
        (2, "DoctorKey not in dim_doctors"),
    ]
    counts = {r.part: r.n_rows for r in w.counts().where("table_name = 'fact_visits'").collect()}
    assert counts["rejected"] == 2 and counts["after"] == 0
