"""Session defaults and sizing.

Nothing here picks a physical plan.  The settings make results reproducible (UTC, ANSI errors)
and let adaptive execution size partitions and split hot join keys at run time.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from math import ceil

from pyspark.sql import SparkSession

#: SQL settings every job relies on; all of them can be changed on a running session.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A hot patient or clinic is split even where the split costs one more shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Parquet is smaller on disk than in memory; broadcast decisions must count the latter.
    "spark.sql.sources.fileCompressionFactor": "3.0",
    # A task of a merge holds its part of both tables in several aggregates and sorts at once.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
    "spark.sql.files.maxPartitionBytes": "32m",
}

MB = 1024 * 1024
TARGET_PARTITION_BYTES = 256 * MB
#: Every map task writes one block per partition.  Beyond this many the blocks of a large shuffle
#: get too small to fetch well, so partitions grow instead; sorts and aggregates of that size spill.
MAX_PARTITIONS = 50_000
MAX_SCAN_TASKS = 100_000
#: A shuffle over so many bytes of input starts with one more partition.
INPUT_PER_PARTITION = 8 * MB
#: Beyond this many, map tasks report average block sizes only, and adaptive execution is blind.
MAX_FIRST_PARTITIONS = 2_000
FIRST_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
#: A join that is shuffled needs no sort if no partition of its smaller side is larger, as shuffled; adaptive execution looks at each join.
HASHED_SIDE_BYTES = 16 * MB
_HASHED_SIDE = "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold"


def first_partitions(input_bytes: int, least: int) -> int:
    """Partitions that a shuffle starts with, so that a task's share doesn't grow with the input; adaptive execution joins small ones."""
    return max(least, min(ceil(input_bytes / INPUT_PER_PARTITION), MAX_FIRST_PARTITIONS))


def tune(spark: SparkSession, input_bytes: int = 0) -> SparkSession:
    """Apply the settings above to a session that somebody else built, and size its shuffles for so much input."""
    for name, value in RUNTIME_CONF.items():
        spark.conf.set(name, value)
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    spark.conf.set(FIRST_PARTITIONS, str(first_partitions(input_bytes, least)))
    return spark


@contextmanager
def hashed_joins(spark: SparkSession) -> Iterator[None]:
    """Within it, joins of a large table with one whose partitions are all small when shuffled are hashed instead of sorted."""
    before = spark.conf.get(_HASHED_SIDE)
    spark.conf.set(_HASHED_SIDE, str(HASHED_SIDE_BYTES))
    try:
        yield
    finally:
        spark.conf.set(_HASHED_SIDE, before)


def shuffle_partitions(shuffled_bytes: int, cores: int) -> int:
    """Partitions of about 256 MB: at least one per core, at most ``MAX_PARTITIONS``.

    100 TB give 50,000 partitions of 2 GB.  Adaptive execution joins small ones.
    """
    return max(cores, min(ceil(shuffled_bytes / TARGET_PARTITION_BYTES), MAX_PARTITIONS))


def scan_split(scanned_bytes: int) -> int:
    """Bytes one scan task reads: 128 MB, more where that would mean too many tasks, at most 1 GB."""
    return min(max(128 * MB, ceil(scanned_bytes / MAX_SCAN_TASKS)), 1024 * MB)


def build_session(
    app: str = "starward",
    master: str | None = None,
    shuffled_bytes: int | None = None,
    cores: int = 8,
    **conf: str,
) -> SparkSession:
    """Session for a job; ``shuffled_bytes`` is about the size of its largest table."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = dict(RUNTIME_CONF)
    if shuffled_bytes is not None:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions(shuffled_bytes, cores))
        settings["spark.sql.files.maxPartitionBytes"] = str(scan_split(shuffled_bytes))
    settings.update(conf)
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()
