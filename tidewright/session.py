"""Session helpers: the shared scratch folder and tables written to it."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a session whose executors are threads of this process may fall back to a temporary folder of its own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="tidewright-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def hadoop_path(spark: SparkSession, path: str) -> tuple:
    """The file system that Spark uses for ``path``, and the path on it."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: a short, durable lineage.

    The file's size is known to the optimizer, so a join broadcasts it only while
    it is under ``spark.sql.autoBroadcastJoinThreshold`` and shuffles beyond it.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete the files of a materialized table that is no longer needed."""
    spark = df.sparkSession
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()[:1]}:
        fs, path = hadoop_path(spark, folder)
        fs.delete(path, True)


LISTING = "spark.sql.sources.parallelPartitionDiscovery.parallelism"


def read_folders(spark: SparkSession, folders: list[str], base_path: str | None = None) -> DataFrame:
    """Parquet folders, their files listed by a few tasks a core: left alone, Spark starts a task for each folder."""
    reader = spark.read if base_path is None else spark.read.option("basePath", base_path)
    before = spark.conf.get(LISTING, None)
    spark.conf.set(LISTING, 4 * spark.sparkContext.defaultParallelism)
    try:
        return reader.parquet(*folders)
    finally:
        spark.conf.unset(LISTING) if before is None else spark.conf.set(LISTING, before)
