"""Accounts over time: series, labels, title changes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerloom.functions import text as fx


def representatives(df: DataFrame, metric: str = "committee_recommendation") -> DataFrame:
    """For each (report, account_key) the line item with the largest absolute amount, the first of ties."""
    rows = df.filter(F.col("account_key").isNotNull() & F.col(metric).isNotNull() & F.col("fiscal_year").isNotNull() & ~fx.is_rollup(F.col("is_subtotal"), F.col("line_item_text")))
    rank = F.row_number().over(W.partitionBy("report_id", "account_key").orderBy(F.abs(metric).desc(), "row_ord"))
    title = F.coalesce(F.nullif(fx.strip(F.col("account")), F.lit("")), F.nullif(fx.strip(F.col("line_item_text")), F.lit("")))
    return rows.withColumn("_rank", rank).filter("_rank = 1").select("report_id", "account_key", "fiscal_year", "chamber", "stage", F.col(metric).alias("amount"), title.alias("title"))


def series(reps: DataFrame) -> DataFrame:
    return reps.groupBy("account_key", "fiscal_year", "chamber", "stage").agg(F.sum("amount").alias("amount"))


def labels(reps: DataFrame) -> DataFrame:
    """Each label of an account with its first and last year."""
    return reps.filter("title IS NOT NULL").groupBy("account_key", "title").agg(F.min("fiscal_year").alias("first_year"), F.max("fiscal_year").alias("last_year"))


def dominant_labels(reps: DataFrame) -> DataFrame:
    """Of each account and year the label with the most absolute money, then most rows, then first in order."""
    sums = reps.filter("title IS NOT NULL").groupBy("account_key", "fiscal_year", "title").agg(F.sum(F.abs("amount")).alias("money"), F.count(F.lit(1)).alias("n"))
    rank = F.row_number().over(W.partitionBy("account_key", "fiscal_year").orderBy(F.desc("money"), F.desc("n"), "title"))
    return sums.withColumn("_rank", rank).filter("_rank = 1").select("account_key", "fiscal_year", "title")


def title_changes(reps: DataFrame) -> DataFrame:
    """Changes of the dominant label against the last year that has one: kind prefix or reword; equal but for case and punctuation is no change."""
    w = W.partitionBy("account_key").orderBy("fiscal_year")
    pairs = dominant_labels(reps).withColumn("before", F.lag("title").over(w)).withColumn("year_before", F.lag("fiscal_year").over(w)).filter("before IS NOT NULL")
    return pairs.select("account_key", "year_before", "fiscal_year", "before", F.col("title").alias("after"), fx.classify_title_change(F.col("before"), F.col("title")).alias("kind")).filter("kind <> 'case'")


def accounts(df: DataFrame, metric: str = "committee_recommendation", min_years: int = 1) -> DataFrame:
    """One row for each account: years, reports, and nested series, labels and title changes."""
    reps = representatives(df, metric)
    base = reps.groupBy("account_key").agg(F.count_distinct("fiscal_year").alias("n_years"), F.count_distinct("report_id").alias("report_count"), F.min(F.when(F.col("title").isNotNull(), F.struct("fiscal_year", "report_id", "title")))["title"].alias("canonical_title"))
    nest = lambda d, name, *cols: d.groupBy("account_key").agg(F.array_sort(F.collect_list(F.struct(*cols))).alias(name))
    out = base.filter(F.col("n_years") >= min_years)
    out = out.join(nest(series(reps), "series", "fiscal_year", "chamber", "stage", "amount"), "account_key", "left")
    out = out.join(nest(labels(reps), "labels", "first_year", "title", "last_year"), "account_key", "left")
    return out.join(nest(title_changes(reps), "title_changes", "fiscal_year", "year_before", "before", "after", "kind"), "account_key", "left")


def list_accounts(found: DataFrame, *, changed_only: bool = False, kind: str | None = None, limit: int = 100, offset: int = 0) -> DataFrame:
    out = found
    if changed_only:
        out = out.filter(F.coalesce(F.size("title_changes"), F.lit(0)) > 0)
    if kind:
        out = out.filter(F.coalesce(F.exists("title_changes", lambda c: c["kind"] == kind), F.lit(False)))
    return out.orderBy("account_key").offset(offset).limit(limit)
