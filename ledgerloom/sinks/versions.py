"""A table whose changes are versions: only the partitions that change are written, and a version is there once its entry in the log is.

path/parts/version=V/<by>=.../    the rows of the partitions that version V has written
path/lists/...                    for each version, which partition is in which version's folder
path/log/V                        the entry of version V, which names its list; made last, and only if no other writer has made it

A reader takes the latest entry, so it sees a whole version, and goes on seeing it while later ones are written. A writer says which version
it has read; if there is a later one by then, it is refused and nothing of it is seen.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.sinks import writers
from ledgerloom.sources.workspace import stored


class Refused(RuntimeError):
    """Another writer was first."""


def _files(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path
    return at(path).getFileSystem(spark._jsc.hadoopConfiguration()), at


def latest(spark: SparkSession, path: str) -> int:
    """The last version; 0 without any. An entry without a name in it belongs to a writer at work, or one that was stopped: see abandon()."""
    files, at = _files(spark, path)
    log = at(f"{path}/log")
    return max((int(f.getPath().getName()) for f in files.listStatus(log) if f.getPath().getName().isdigit() and f.getLen()), default=0) if files.exists(log) else 0


def abandon(spark: SparkSession, path: str) -> None:
    """Takes back what a stopped writer has left after its entry was made; not for use while one may be at work."""
    files, at = _files(spark, path)
    version = latest(spark, path) + 1
    files.delete(at(f"{path}/parts/version={version}"), True)
    files.delete(at(f"{path}/log/{version}"), False)


def _list(spark: SparkSession, path: str, version: int) -> DataFrame:
    """by (as text) and version of each partition of a version."""
    entry = spark.read.text(f"{path}/log/{version}").first()["value"]
    return spark.read.schema("_by string, _version bigint").parquet(f"{path}/lists/{entry}")


def read(spark: SparkSession, path: str, by: str, version: int | None = None, with_version: bool = False) -> DataFrame:
    """The rows of a version, the latest if none is named. with_version: and which version wrote them, as written_in."""
    named = version if version is not None else latest(spark, path)
    if not named:
        raise ValueError(f"{path} has no version")
    parts = spark.read.parquet(f"{path}/parts")
    one = _list(spark, path, named)
    rows = parts.join(F.broadcast(one), (F.col("version") == F.col("_version")) & F.col(by).cast("string").eqNullSafe(F.col("_by")))  # a row a partition
    return rows.withColumnRenamed("version", "written_in").drop("_by", "_version") if with_version else rows.drop("version", "_by", "_version")


def _write(rows: DataFrame, path: str, by: str, base: int, kept: DataFrame | None) -> int:
    spark, version = rows.sparkSession, base + 1
    if latest(spark, path) != base:
        raise Refused(f"version {base} isn't the latest of {path}")
    attempt = uuid.uuid4().hex
    folder = f"{path}/.parts-{attempt}"
    rows.write.partitionBy(by).parquet(folder)
    # the partitions are those that were written: asked of the folder, not of the rows, which would be made again
    new = spark.read.schema(rows.schema).parquet(folder).select(F.col(by).cast("string").alias("_by")).distinct().withColumn("_version", F.lit(version).cast("bigint"))
    (new if kept is None else new.unionByName(kept)).write.parquet(f"{path}/lists/{attempt}")
    files, at = _files(spark, path)
    files.mkdirs(at(f"{path}/parts"))
    files.mkdirs(at(f"{path}/log"))
    try:
        entry = files.create(at(f"{path}/log/{version}"), False)  # fails if it is there
    except Exception as error:
        files.delete(at(folder), True)
        raise Refused(f"version {version} of {path} was written meanwhile") from error
    # The entry is this writer's now. Its rows come into place before the entry names its list; until then readers skip it and other writers are refused.
    files.rename(at(folder), at(f"{path}/parts/version={version}"))
    entry.write(bytearray(attempt.encode()))
    entry.close()
    return version


def create(rows: DataFrame, path: str, by: str) -> int:
    """The first version, partitioned by a column."""
    return _write(rows, path, by, 0, None)


def change(after: DataFrame, path: str, by: str, keys: list[str], columns: list[str], base: int, dry_run: bool = False) -> tuple[DataFrame, int]:
    """(keys of the rows that change, version): of a table like version `base` in which `columns` may differ, the partitions that change are written.

    A dry run writes nothing. Without any change no version is made. Partitions that stay keep their files.
    """
    spark = after.sparkSession
    before = read(spark, path, by, base)
    changed = writers.changed_rows(before, after, keys, columns)
    if dry_run:
        return changed, base
    if latest(spark, path) != base:  # before anything is compared
        raise Refused(f"version {base} isn't the latest of {path}")
    # one row a partition, asked for several times; the comparison is made once
    touched = stored(writers.changed_rows(before, after, keys, columns, by).select(F.col(by).cast("string").alias("_by")).distinct(), "touched")
    if touched.isEmpty():
        return changed, base
    rows = after.join(touched, F.col(by).cast("string").eqNullSafe(F.col("_by")), "left_semi")
    kept = _list(spark, path, base).join(touched, "_by", "left_anti")
    return changed, _write(rows, path, by, base, kept)
