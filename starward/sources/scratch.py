"""Written tables in the cluster's shared scratch folder.

A frame that several later steps read, or whose row positions must not move, is written once and
read back.  The copy outlives any executor, starts a new lineage, and gives the optimizer a real
file size, which is what decides whether a later join may broadcast it.
"""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession


def scratch_root(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, which a cluster's executors share.

    Where it is unset, a session on one machine takes a folder below its warehouse; so does a cluster whose warehouse is not on the
    driver's own disk.  Any other has to name one.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    warehouse = spark.conf.get("spark.sql.warehouse.dir", None)
    own_disk = warehouse is not None and (warehouse.startswith("file:") or "://" not in warehouse)
    if warehouse is None or (own_disk and not spark.sparkContext.master.startswith("local")):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{warehouse}/_scratch"


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{scratch_root(spark)}/starward/{label}-{uuid4().hex}"


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to scratch and return the written table."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there, on whatever file system the path names."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop_path)


def bytes_below(spark: SparkSession, path: str) -> int:
    """Bytes of all files in a folder, on whatever file system the path names; 0 if it isn't there."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    return files.getContentSummary(hadoop_path).getLength() if files.exists(hadoop_path) else 0


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a file or folder, on whatever file system the path names."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop_path, True)
