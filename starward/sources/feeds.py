"""Daily clinic files: comma-separated, one header row, every column text."""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starward.schemas import CLINICS, CONFORMED, FEED_SCHEMAS
from starward.sources.parts import row_digest

# Fixed value: a day's file is named yyyymmdd plus its kind, e.g. 20100102Visits.csv.
FILE_DAY = r"/(\d{8})[A-Za-z]+\.csv"


def feed_path(folder: str, clinic: str, kind: str, day: date | None = None) -> str:
    """All of a clinic's files of one kind, or one day's; each may be a file or a folder of parts."""
    name = f"*{kind}.csv" if day is None else f"{day:%Y%m%d}{kind}.csv"
    return f"{folder}/{clinic}/{name}"


#: Column that holds the text of a line that doesn't fit its layout.
BAD_LINE = "_bad_line"
#: Options of the batch and the streaming reader.  ``enforceSchema=false`` checks the header against
#: the schema; without it Spark binds by position and a swapped column goes unnoticed.  A line with too
#: few or too many fields keeps its text in ``BAD_LINE`` instead of being bent to the layout; all
#: fields are parsed even if few are asked for, or such a line would pass.
FEED_OPTIONS = {
    "header": "true",
    "enforceSchema": "false",
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": BAD_LINE,
    "columnPruning": "false",
}


def feed_schema(clinic: str, kind: str) -> T.StructType:
    """A clinic's layout, and the place for lines that don't fit it."""
    return with_bad_line(FEED_SCHEMAS[(clinic, kind)])


def with_bad_line(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(BAD_LINE, T.StringType())])


def file_day() -> Column:
    """The day in the name of the file a row came from; NULL if the name has none."""
    return F.try_to_date(F.regexp_extract(F.col("_metadata.file_path"), FILE_DAY, 1), "yyyyMMdd")


def unfit_line(columns: list[str]) -> Column:
    """NULL for a line that fits, else its text and first field.

    The first field is there because Spark refuses to read the text of bad lines without any other column.
    """
    return F.concat(F.col(BAD_LINE), F.lit(", first field "), F.coalesce(F.col(columns[0]), F.lit("missing")))


def checked(rows: DataFrame, columns: list[str], on_bad_line: str = "fail", named: date | None = None) -> DataFrame:
    """Rows as parsed -> the layout's columns and ``FileDay``; batch and stream share this.

    ``named`` is the day in the names of all files, if only such files are read; else each row's file name is searched for it.

    ``on_bad_line`` says what a line does that doesn't fit: ``"fail"`` ends the load with the line and its
    file, ``"skip"`` leaves it to ``rejected_lines``.  A file without a day in its name always ends the load:
    its rows would have no date.
    """
    if on_bad_line not in ("fail", "skip"):
        raise ValueError(f"on_bad_line is fail or skip, not {on_bad_line}")
    where = F.col("_metadata.file_path")
    bad = unfit_line(columns)
    if on_bad_line == "skip":
        rows = rows.where(bad.isNull())
    undated = F.raise_error(F.concat(F.lit("no day in the file name "), where)).cast("date")
    found = F.coalesce(file_day(), undated) if named is None else F.lit(named)
    unfit = F.raise_error(F.concat(F.lit("line doesn't fit its layout in "), where, F.lit(": "), bad)).cast("date")
    day = F.when(bad.isNotNull(), unfit).otherwise(found)
    return rows.select(*columns, day.alias("FileDay")).where(F.col("FileDay").isNotNull())


def parsed_feed(
    spark: SparkSession, folder: str, clinic: str, kind: str, day: date | None = None, schema: T.StructType | None = None
) -> DataFrame:
    """One clinic's files of one kind with ``BAD_LINE``.

    Each clinic and kind gets its own read because one read binds all its files to one layout.
    """
    schema = feed_schema(clinic, kind) if schema is None else with_bad_line(schema)
    return spark.read.schema(schema).options(**FEED_OPTIONS).csv(feed_path(folder, clinic, kind, day))


def read_feed(
    spark: SparkSession,
    folder: str,
    clinic: str,
    kind: str,
    day: date | None = None,
    schema: T.StructType | None = None,
    on_bad_line: str = "fail",
) -> DataFrame:
    """One clinic's files of one kind, plus ``FileDay`` taken from each file's name."""
    rows = parsed_feed(spark, folder, clinic, kind, day, schema)
    return checked(rows, (schema or FEED_SCHEMAS[(clinic, kind)]).names, on_bad_line, day)


def rejected_lines(
    spark: SparkSession, folder: str, clinic: str, kind: str, day: date | None = None
) -> DataFrame:
    """``Clinic, Kind, File, Line``: the lines that don't fit the clinic's layout."""
    rows = parsed_feed(spark, folder, clinic, kind, day)
    return rows.where(unfit_line(FEED_SCHEMAS[(clinic, kind)].names).isNotNull()).select(
        F.lit(clinic).alias("Clinic"),
        F.lit(kind).alias("Kind"),
        F.regexp_extract("_metadata.file_path", r"(\d{8}[A-Za-z]+\.csv)", 1).alias("File"),
        F.col(BAD_LINE).alias("Line"),
    )


def read_feed_by_header(spark: SparkSession, path: str) -> DataFrame:
    """A file of unknown column order, all text, bound by its header names."""
    return spark.read.option("header", True).csv(path)


def conform_feed(df: DataFrame, kind: str) -> DataFrame:
    """One clinic's layout -> the common layout; a column the clinic lacks becomes NULL."""
    extra = [c for c in df.columns if c == "FileDay"]
    present = set(df.columns)
    return df.select(
        *[
            F.col(f.name) if f.name in present else F.lit(None).cast(f.dataType).alias(f.name)
            for f in CONFORMED[kind]
        ],
        *extra,
    )


def read_feeds(
    spark: SparkSession, folder: str, kind: str, day: date | None = None, on_bad_line: str = "fail"
) -> dict[str, DataFrame]:
    """All clinics' files of one kind, conformed, by clinic."""
    return {
        c: conform_feed(read_feed(spark, folder, c, kind, day, on_bad_line=on_bad_line), kind) for c in CLINICS
    }


def delivered_files(spark: SparkSession, folder: str, kind: str, day: date | None = None) -> DataFrame:
    """``Clinic, Kind, File, Lines, Digest``: each delivered file with what is in it.

    The digest is a sum over its lines, the header left out, so a file may be of any size and in parts.  A file without a
    line has no row.
    """

    def of(clinic: str) -> DataFrame:
        header = ",".join(FEED_SCHEMAS[(clinic, kind)].names)
        lines = spark.read.text(feed_path(folder, clinic, kind, day)).select(F.col("_metadata.file_path").alias("_path"), "value")
        line = F.col("value")
        # Few lines begin with the mark, so few are trimmed.
        is_header = (line == header) | (line.startswith("\ufeff") & (F.ltrim(line, F.lit("\ufeff")) == header))
        # Paths are counted first: a name is searched for once a file, not once a line.
        paths = lines.where(~is_header).groupBy("_path").agg(F.count("*").alias("n"), row_digest(["value"]).alias("d"))
        name = F.regexp_extract("_path", r"([^/]*" + kind + r"\.csv)", 1)
        return paths.groupBy(name.alias("File")).agg(F.sum("n").alias("Lines"), F.sum("d").cast("decimal(38,0)").alias("Digest")).select(
            F.lit(clinic).alias("Clinic"), F.lit(kind).alias("Kind"), "File", "Lines", "Digest"
        )

    return reduce(DataFrame.unionByName, map(of, CLINICS))


def delivery_states(delivered: DataFrame, known: DataFrame) -> DataFrame:
    """``delivered`` with ``State``: new, again (a known file as it was) or changed (a known name with other content)."""
    name = ["Clinic", "Kind", "File"]
    earlier = known.groupBy(*name).agg(F.collect_set(F.struct("Lines", "Digest")).alias("_known"))
    same = F.array_contains("_known", F.struct("Lines", "Digest"))
    state = F.when(F.col("_known").isNull(), "new").when(same, "again").otherwise("changed")
    return delivered.join(earlier, name, "left").withColumn("State", state).drop("_known")
