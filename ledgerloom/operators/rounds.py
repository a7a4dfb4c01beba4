"""Reading pages in rounds: one reader for each attempt, the pages still open for the next, and a state on disk from which a stopped run goes on."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators.extract import page_kind
from ledgerloom.sources.workspace import exists, made_once

#: Kinds of answers after which a page isn't read again.
SETTLED = ("rows", "non_comparative")
KEY = ["report_id", "page"]


@dataclass(frozen=True)
class Rounds:
    """answers: report_id, page, attempt, kind, answer of settled pages. quarantine: pages that no reader could settle, with the attempts spent. reports: those that are through. state: every attempt."""

    answers: DataFrame
    quarantine: DataFrame
    reports: DataFrame
    state: DataFrame


def read_in_rounds(pages: DataFrame, readers: Sequence[Callable], path: str, kind: Callable[[Column], Column] = page_kind, rounds: int | None = None) -> Rounds:
    """pages (report_id, page, and whatever readers take) through the readers, one a round, each on what the rounds before have left open.

    A reader goes from an iterator of pandas frames to one of frames (report_id, page, answer); a page that it leaves out, or gives no answer for, counts as tried. Every round
    is a table below the path, put in place when it is whole: a run that was stopped, or that was told to do some `rounds` only, goes on behind the
    last whole round when it is called again, and never asks a reader twice about a page. A report is through when all its pages are settled or,
    after the last reader, in quarantine; that is noted for each round in the same way, so a report half read is not taken for one that is done.
    """
    spark, kinds = pages.sparkSession, dict(pages.dtypes)
    schema = f"report_id {kinds['report_id']}, page {kinds['page']}, answer string"
    tried: list[DataFrame] = []
    for n, reader in enumerate(readers[: rounds if rounds is not None else len(readers)], 1):
        settled = [t.filter(F.col("kind").isin(*SETTLED)).select(*KEY) for t in tried]
        left = pages.join(reduce(DataFrame.unionByName, settled), KEY, "left_anti") if settled else pages

        def attempt(left=left, reader=reader, n=n) -> DataFrame:
            got = left.mapInPandas(reader, schema).groupBy(*KEY).agg(F.max("answer").alias("answer"))  # one answer a page
            all_ = left.select(*KEY).distinct().join(got, KEY, "left")
            return all_.select(*KEY, F.lit(n).alias("attempt"), kind(F.col("answer")).alias("kind"), "answer")

        tried.append(made_once(spark, f"{path}/round={n}", attempt))
        state = reduce(DataFrame.unionByName, tried)
        last = n == len(readers)
        done = state.filter(F.col("kind").isin(*SETTLED)).select(*KEY).distinct()
        whole = pages.select(*KEY).distinct().join(done.withColumn("_done", F.lit(True)), KEY, "left").groupBy("report_id").agg(F.bool_and(F.coalesce("_done", F.lit(last))).alias("through")).filter("through").select("report_id")
        made_once(spark, f"{path}/through={n}", lambda whole=whole: whole)
    if not tried:
        raise ValueError("at least one reader and one round are needed")
    state = reduce(DataFrame.unionByName, tried)
    through = [spark.read.parquet(f"{path}/through={n}") for n in range(1, len(readers) + 1) if exists(spark, f"{path}/through={n}/_SUCCESS")]
    answers = state.filter(F.col("kind").isin(*SETTLED))
    spent = state.groupBy(*KEY).agg(F.max("attempt").alias("attempts"), F.bool_or(F.col("kind").isin(*SETTLED)).alias("_settled"))
    quarantine = spent.filter(~F.col("_settled") & (F.col("attempts") == len(readers))).drop("_settled")
    return Rounds(answers, quarantine, reduce(DataFrame.unionByName, through).distinct(), state)
