"""Command line over a released ledger: reconcile, trace, compare, facets, status; and reports, over a catalog."""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.operators import query, reconcile, trace
from ledgerloom.sources.ledger import load_catalog


def main(args: list[str] | None = None, spark: SparkSession | None = None) -> int:
    parser = argparse.ArgumentParser(prog="ledgerloom")
    commands = parser.add_subparsers(dest="command", required=True)
    for name in ("reconcile", "trace", "compare", "facets", "status"):
        commands.add_parser(name).add_argument("source", help="Parquet ledger")
    own = commands.choices
    reports = commands.add_parser("reports")
    reports.add_argument("source", help="JSON catalog")
    for name, kind in (("congress", int), ("chamber", str), ("subcommittee", str), ("fiscal-year", int), ("stage", str)):
        reports.add_argument(f"--{name}", type=kind)
    own["reconcile"].add_argument("--report")
    own["reconcile"].add_argument("--worst", type=int, default=10)
    own["reconcile"].add_argument("--fail-under", type=float)
    own["trace"].add_argument("--metric", default="committee_recommendation")
    own["trace"].add_argument("--min-years", type=int, default=2)
    own["trace"].add_argument("--reword-only", action="store_true")
    own["compare"].add_argument("--account", required=True)
    own["compare"].add_argument("--metric", default="committee_recommendation")
    given = parser.parse_args(args)
    spark = spark or SparkSession.builder.appName("ledgerloom").getOrCreate()
    if given.command == "reports":
        wanted = {c: getattr(given, c) for c in ("congress", "chamber", "subcommittee", "fiscal_year", "stage")}
        _show(query.find_reports(load_catalog(spark, given.source), **wanted).orderBy("congress", "package_id"))
        return 0
    rows = query.with_defaults(spark.read.parquet(given.source))
    if given.command == "reconcile":
        totals = reconcile.reconcile(rows.filter(F.col("report_id") == given.report) if given.report else rows).persist()
        summary = reconcile.summarize(totals)
        _show(summary)
        _show(reconcile.review_queue(totals, given.worst))
        rate = summary.first()["pass_rate"]
        return int(given.fail_under is not None and (rate is None or rate < given.fail_under))
    if given.command == "trace":
        changes = trace.title_changes(trace.representatives(rows, given.metric))
        _show(changes.filter("kind = 'reword'") if given.reword_only else changes)
    elif given.command == "compare":
        _show(query.compare(rows, given.metric, account=given.account).orderBy("fiscal_year"))
    elif given.command == "facets":
        _show(query.facets(rows).orderBy("facet", "value"))
    else:
        _show(query.coverage_matrix(rows.withColumn("verified", F.lit(False)) if "verified" not in rows.columns else rows))
    return 0


def _show(df: DataFrame, most: int = 100) -> None:
    for r in df.limit(most).collect():
        print("\t".join(str(x) for x in r))


if __name__ == "__main__":
    sys.exit(main())
