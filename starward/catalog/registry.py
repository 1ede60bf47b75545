"""Named queries over the test tables, each with the SQL it must agree with where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starward.session import tune
from starward.sources.scratch import bytes_below

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


class Tables:
    """The parquet tables of one folder, as attributes."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def plain(df: DataFrame) -> DataFrame:
    """Types both engines print alike: whole numbers and flags as bigint, money as double, times as text."""

    def cast(field: T.StructField):
        column = F.col(f"`{field.name}`")
        match field.dataType:
            case T.BooleanType() | T.ByteType() | T.ShortType() | T.IntegerType():
                column = column.cast("bigint")
            case T.DecimalType():
                column = column.cast("double")
            case T.DateType():
                column = F.date_format(column, "yyyy-MM-dd")
            case T.TimestampType() | T.TimestampNTZType():
                column = F.date_format(column, "yyyy-MM-dd HH:mm:ss")
        return column.alias(field.name)

    return df.select(*[cast(f) for f in df.schema])


def query(name: str, sql: str | None = None):
    """Register ``fn(tables) -> DataFrame`` under ``name``."""

    def register(fn: Callable[[Tables], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return plain(fn(Tables(tune(spark, bytes_below(spark, folder)), folder)))

        run.__name__, run.__doc__ = name, fn.__doc__
        assert name not in QUERIES, name
        QUERIES[name] = run
        if sql is not None:
            ORACLE_SQL[name] = sql
        return fn

    return register
