"""Small helpers that the operators of this subpackage share."""

from __future__ import annotations

import math
import tempfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII space and the five control characters that separate words; everything else is part of a word.
WORD_BREAKS = r"[\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def fold_ascii(text: Column) -> Column:
    """Lower-cases A-Z and nothing else; null stays null."""
    return F.translate(text, UPPER, LOWER)


#: With it Spark removes a query's shuffle files when the query ends, not when the driver next collects garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

#: Rows that go to Python at once; texts are long, so few of them fill a batch.
BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder of the session: spark.checkpoint.dir, which the cluster shares. Only a local session may go without (tests): it gets a temporary one."""
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named and not context.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the cluster shares")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="ledgerloom-checkpoint-"))
    return context._jsc.sc().getCheckpointDir().get()


def cut(df: DataFrame) -> DataFrame:
    """Cuts lineage: writes df to the shared checkpoint folder and reads it from there."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def free_name(df: DataFrame, name: str) -> str:
    """The name, with underscores before it until no column of df has it, also in other case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def shuffle_width(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def power_at_least(base: int, n: int) -> int:
    """The smallest power of base that is n or more."""
    return base ** max(0, math.ceil(math.log(max(1, n), base) - 1e-9))


def give_back() -> None:
    """Returns freed memory to the system: a worker process serves one task after another, and an executor has several."""
    import ctypes

    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # glibc only
        trim(0)


def text_slices(batches, column: int = 1, limit: int = 4_000_000):
    """Cuts Arrow record batches so that a slice has about `limit` bytes in the given string column; a longer text makes a slice alone."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    for batch in batches:
        size = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column).cast(pa.large_string())), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < batch.num_rows:
            end = max(at + 1, int(np.searchsorted(size, (size[at - 1] if at else 0) + limit, "right")))
            yield batch.slice(at, end - at)
            at = end
    give_back()


def written(df: DataFrame, name: str, rows: int = 1000) -> DataFrame:
    """Like cut(), but as a compressed Parquet table in the same folder, after which the shuffle files of df go. rows: how many go to Python at once."""
    import uuid

    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    held = {CLEANUP: "true", BATCH: str(rows)}
    before = {k: spark.conf.get(k) for k in held}
    try:
        for k, v in held.items():
            spark.conf.set(k, v)
        df.write.parquet(path)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    return spark.read.schema(df.schema).parquet(path)
