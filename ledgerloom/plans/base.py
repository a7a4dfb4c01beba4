"""What the query modules share: the register of queries and their SQL, and the ledger with all columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.operators import query
from ledgerloom.schema import AMOUNTS
from ledgerloom.sources.ledger import LEDGER_SQL, ledger, ledger_by_report
from ledgerloom.sources.workspace import stored

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def amounts():
    return tuple(map(F.col, AMOUNTS))


def register(name: str, sql: str | None = None, on_ledger: bool = True, recursive: bool = False):
    """Registers a query, and the SQL that gives the same rows: after the ledger's, or alone."""

    def add(f):
        QUERIES[name] = f
        if sql:
            whole = (LEDGER_SQL + sql) if on_ledger else sql
            ORACLES[name] = whole.replace("WITH", "WITH RECURSIVE", 1) if recursive else whole
        return f

    return add


def full(spark: SparkSession, sf_dir: str) -> DataFrame:
    return query.with_defaults(ledger(spark, sf_dir))


def kept(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """The ledger, or the columns of it that a query reads, derived once and stored, for queries that start from it several times."""
    rows = ledger_by_report(spark, sf_dir)
    return stored(rows.select(*columns) if columns else rows, "ledger")
