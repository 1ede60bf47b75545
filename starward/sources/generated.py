"""Rows that come from no file: the calendar and literal members."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starward.functions.clock import date_id

# First and last day of the lookup calendar.
CALENDAR = (date(1990, 1, 1), date(2020, 12, 31))


def date_spine(spark: SparkSession, start: date = CALENDAR[0], end: date = CALENDAR[1]) -> DataFrame:
    """Every day from ``start`` to ``end``, both included, with its ``yyyymmdd`` number.

    ``range`` makes the days in parallel; there is no loop and no shuffle.
    """
    days = spark.range((end - start).days + 1).select(
        F.date_add(F.lit(start), F.col("id").cast("int")).alias("FullDate")
    )
    return days.select(date_id(F.col("FullDate")).alias("DateID"), "FullDate")


def literal_rows(spark: SparkSession, rows: Sequence[tuple], schema: T.StructType | str) -> DataFrame:
    """A handful of rows written in the program."""
    return spark.createDataFrame(list(rows), schema)
