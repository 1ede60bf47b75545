"""Pick up each new daily file once.

A file stream per clinic and kind remembers which files it has read; the three clinics' streams are one
query, so every micro-batch of a kind runs the body of the batch load once, over all clinics.  The commit that
shows a batch's rows carries the batch's name, so a batch that is repeated after a failure is known without a look at the
table.  Rows that another stream or the batch load has loaded are found by comparing with the table.
"""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starward.plans.file_load import Operational, append_patients, append_visits, patient_rows, visit_rows
from starward.schemas import CLINICS, FEED_SCHEMAS, KINDS
from starward.sources.feeds import FEED_OPTIONS, checked, conform_feed, feed_path, feed_schema


def stream_feed(
    spark: SparkSession,
    folder: str,
    clinic: str,
    kind: str,
    files_per_batch: int | None = None,
    on_bad_line: str = "fail",
) -> DataFrame:
    """One clinic's files of one kind as a stream; its header must match the declared layout."""
    reader = spark.readStream.schema(feed_schema(clinic, kind)).options(**FEED_OPTIONS)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    rows = reader.csv(feed_path(folder, clinic, kind))
    return checked(rows, FEED_SCHEMAS[(clinic, kind)].names, on_bad_line)


def stream_rows(
    spark: SparkSession,
    folder: str,
    kind: str,
    files_per_batch: int | None = None,
    on_bad_line: str = "fail",
) -> DataFrame:
    """All clinics' files of one kind as one stream of operational rows."""

    def rows(clinic: str) -> DataFrame:
        feed = conform_feed(stream_feed(spark, folder, clinic, kind, files_per_batch, on_bad_line), kind)
        return patient_rows(feed) if kind == "NewPatients" else visit_rows(feed, clinic, F.col("FileDay"))

    return reduce(DataFrame.unionByName, map(rows, CLINICS))


def stream_id(spark: SparkSession, checkpoints: str, kind: str) -> str:
    """The name that a stream's checkpoint was given when it was made; a new checkpoint has another one."""
    return json.loads(spark.read.text(f"{checkpoints}/{kind}/metadata").first().value)["id"]


def load_new_files(
    spark: SparkSession,
    folder: str,
    into: Operational,
    checkpoints: str,
    files_per_batch: int | None = None,
    collation: str | None = None,
    on_bad_line: str = "fail",
) -> None:
    """Load every file that arrived since the last call, then return.

    All patients come before any visits, one query after the other.  ``checkpoints`` is a folder that all
    executors and later runs share.  What one call finds of a kind is numbered together, as in the batch load.
    """

    def body(kind: str):
        def append(batch: DataFrame, number: int) -> None:
            name = f"{kind}/{stream_id(spark, checkpoints, kind)}/{number}"
            patients = kind == "NewPatients"
            table = into.patients_table(spark) if patients else into.visits_table(spark)
            if table.has_batch(name):
                return  # committed by a run that ended before its checkpoint did
            if patients:
                append_patients(spark, batch.distinct(), into, collation, name)
            else:
                append_visits(spark, batch.distinct(), into, name)

        return append

    for kind in KINDS:
        stream = stream_rows(spark, folder, kind, files_per_batch, on_bad_line)
        query = (
            stream.writeStream.foreachBatch(body(kind))
            .option("checkpointLocation", f"{checkpoints}/{kind}")
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
