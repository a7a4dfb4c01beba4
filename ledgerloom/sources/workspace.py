"""Folders for tables that a query writes and reads again: below the session's shared folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def new_folder(spark: SparkSession, name: str) -> str:
    """A path that doesn't exist yet, below spark.checkpoint.dir. Only a local session may go without that setting: it gets a temporary folder."""
    context = spark.sparkContext
    named = context._jsc.sc().getCheckpointDir()
    base = spark.conf.get("spark.checkpoint.dir", None) or (named.get() if named.isDefined() else None)
    if not base:
        if not context.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the cluster shares")
        base = tempfile.mkdtemp(prefix="ledgerloom-")
        context.setCheckpointDir(base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is something at the path, in any file system that Spark reads."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def stored(df: DataFrame, name: str) -> DataFrame:
    """df written once below the shared folder and read from there: for rows that several branches of a query start from."""
    path = new_folder(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: The writers of Spark put this file in place last.
DONE = "_SUCCESS"


def made_once(spark: SparkSession, path: str, make) -> DataFrame:
    """The Parquet table at the path, which make() gives if it is not there yet: a first pass is not repeated.

    Only a table whose writer has ended counts. A new one is written beside it and put in place by a rename, so what a failed or stopped
    pass leaves is neither taken for the table nor in the way; of two passes at once the first stays.
    """
    if not exists(spark, f"{path}/{DONE}"):
        beside = f"{path.rstrip('/')}.{uuid.uuid4().hex}"
        make().write.option("compression", "zstd").parquet(beside)
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        files = at.getFileSystem(spark._jsc.hadoopConfiguration())
        if files.exists(at) and not exists(spark, f"{path}/{DONE}"):
            files.delete(at, True)  # what a pass without an end left
        source = spark._jvm.org.apache.hadoop.fs.Path(beside)
        if files.exists(at) or not files.rename(source, at):
            files.delete(source, True)
    return spark.read.parquet(path)
