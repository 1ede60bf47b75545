"""Queries over the finished star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def star_readback(
    visits: DataFrame,
    clinics: DataFrame,
    dates: DataFrame,
    doctors: DataFrame,
    patients: DataFrame,
    procedures: DataFrame,
) -> DataFrame:
    """Every visit fact with the columns of all five dimensions."""
    return (
        visits.join(dates, "DateKey")
        .join(clinics, "ClinicKey")
        .join(procedures, "ProcedureKey")
        .join(doctors, "DoctorKey")
        .join(patients, "PatientKey")
    )


def charges_by_month(star: DataFrame) -> DataFrame:
    """Report: visits and charges by month and clinic."""
    return star.groupBy("MonthID", "MonthName", "ClinicName").agg(
        F.count("*").alias("visits"),
        F.sum("ProcedureVistCharge").alias("charge"),
    )
