"""Intermediate tables that several parts of one plan read."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_folder: str | None = None


def staging_folder(spark: SparkSession) -> str:
    """The shared folder that the session names in `spark.checkpoint.dir`.

    Only a session without a cluster may leave it unset; its tables go to a temporary
    folder. On a cluster a missing setting is an error, since executors could not read
    each other's files and a plan without staged tables would repeat its work per use.
    """
    global _local_folder
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return f"{folder}/termloom"
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if _local_folder is None:
        _local_folder = tempfile.mkdtemp(prefix="termloom-")
    return _local_folder


def new_path(spark: SparkSession, name: str) -> str:
    """A folder for one table, never used before."""
    return f"{staging_folder(spark)}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write `df` once and go on from the table.

    What follows then neither repeats the work per use nor depends on shuffle files of
    executors that may be lost.
    """
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stage_buckets(df: DataFrame, name: str, parts: int, by: str) -> DataFrame:
    """`stage` for a table that is read by `by`: what joins or sums by it needs no exchange where it starts from the table.

    `df` should already lie in `parts` parts by `by`, so that each task writes one file.
    """
    path = new_path(df.sparkSession, name)
    known = path.rsplit("/", 1)[1].replace("-", "_")
    df.write.bucketBy(parts, by).option("path", path).format("parquet").saveAsTable(known)
    return df.sparkSession.table(known)


def discard(df: DataFrame) -> None:
    """Delete a table of `stage_buckets` that nothing reads any more."""
    spark, files = df.sparkSession, df.inputFiles()
    if files:
        folder = spark._jvm.org.apache.hadoop.fs.Path(files[0]).getParent()
        spark.sql(f"DROP TABLE {folder.getName().replace('-', '_')}")
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def remove_staged(spark: SparkSession) -> None:
    """Delete every staged table. Frames that were built on them can't be read afterwards."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(staging_folder(spark))
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
