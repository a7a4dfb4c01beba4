"""Incremental refresh of the ledger from files that land in a folder; beyond what a batch needs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.operators import verify
from ledgerloom.schema import AMOUNTS


def landing(spark: SparkSession, path: str, schema: str, files_each: int = 100) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_each).parquet(path)


def verified_stream(rows: DataFrame) -> DataFrame:
    """Row checks are stateless, so they run on a stream as on a batch."""
    return verify.verify(rows)


def totals_by_year(rows: DataFrame) -> DataFrame:
    """Running totals; state is one row for each fiscal year and chamber."""
    return rows.filter(~F.col("is_subtotal")).groupBy("fiscal_year", "chamber").agg(F.sum(AMOUNTS[2]).alias("amount"), F.count(F.lit(1)).alias("n_rows"))


def refresh(rows: DataFrame, out: str, checkpoint: str):
    """Appends checked rows to a Parquet ledger, each file once."""
    query = verified_stream(rows).writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).outputMode("append").start()
    query.awaitTermination()
    return query
