"""The combined fact: line items flattened, keyed to accounts, tiered and written, in one pass over rows that are derived once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from ledgerloom.functions import text as fx
from ledgerloom.operators import crosswalk, verify
from ledgerloom.schema import AMOUNTS, FACT, LEVELS
from ledgerloom.sinks import writers
from ledgerloom.sources.workspace import stored

#: Where a row's context is read, for its account.
CONTEXT = ("subcommittee", "department", "agency", "title_name", "program")
#: Whole numbers and flags of the fact, for reading it back.
WHOLE = ("congress", "fiscal_year", *AMOUNTS, "hierarchy_depth")
FLAGS = ("is_memo", "is_subtotal", "in_thousands", "verified")


def _first_filled(*names: str) -> Column:
    return F.coalesce(*[F.nullif(F.col(c), F.lit("")) for c in names])


def federal_accounts(rows: DataFrame, accounts: DataFrame) -> DataFrame:
    """rows (report_id, row_ord, ..., account_key and account_match) with federal accounts for what is still without a key.

    Line items with an amount, by their inferred account or label: unambiguous ones first, then what the subcommittee's agencies decide. A key that is there stays.
    accounts: ref_ord, federal_account_symbol, account_title, agency, bureau.
    """
    name, bucket = _first_filled("account_inferred", "line_item_text"), F.coalesce("subcommittee", F.lit(""))
    is_open = ~F.coalesce("is_subtotal", F.lit(False)) & F.col("account_key").isNull() & F.coalesce(*AMOUNTS).isNotNull()
    labels = stored(rows.filter(is_open).select(name.alias("name"), bucket.alias("bucket")).distinct(), "open-names")  # several branches start from them
    found = crosswalk.contained_twice(labels, accounts)
    bureaus = accounts.groupBy(F.col("federal_account_symbol").alias("symbol"), F.col("account_title").alias("title"), "agency").agg(F.min_by("bureau", "ref_ord").alias("bureau"))
    found = found.join(bureaus, ["symbol", "title", "agency"], "left").select("name", "bucket", F.struct("symbol", "title", "agency", "bureau", "pass").alias("_f"))
    found = stored(found, "federal-accounts")  # of a known size: few of them go to the rows
    out = rows.withColumn("name", F.when(is_open, name)).withColumn("bucket", bucket).join(found, ["name", "bucket"], "left").drop("name", "bucket")
    hit = F.col("_f").isNotNull()
    # How such a match is called.
    how = F.when(F.col("_f.pass") == 1, "tango").otherwise("tango_scoped")
    new = {"account_key": F.when(hit, F.col("_f.symbol")).otherwise(F.col("account_key")), "account_key_title": F.when(hit, F.col("_f.title")).otherwise(F.col("account_key_title")), "account_match": F.when(hit, how).otherwise(F.col("account_match"))}
    return out.withColumns(new | {"account_key_agency": F.col("_f.agency"), "account_key_bureau": F.col("_f.bureau")}).drop("_f")


def combined(lines: DataFrame, inline: DataFrame | Callable[[DataFrame], DataFrame], reference: DataFrame, accounts: DataFrame, factors: DataFrame) -> DataFrame:
    """The fact: row_ord and the columns of FACT in their order.

    lines: a row for each line item and total, its amounts as records (value, raw_text, in_thousands), and row_ord. inline: report_id, amounts, label, or what makes
    that of the stored lines, where amounts are plain.
    reference: ref_ord, code, title, agency. accounts: see federal_accounts(). factors: fiscal_year, real_factor; a year without one has none.
    The lines are stored once, and every step starts from there. Missing amounts stay missing; memos in parentheses are marked.
    """
    memo = F.coalesce("is_memo", F.lit(False)) | fx.is_paren_memo(F.col("committee_recommendation"))
    flat = lines.withColumn("is_memo", memo).withColumns({c: F.col(c)["value"] for c in AMOUNTS})
    flat = flat.withColumn("designation", fx.label_parts(fx.strip(F.coalesce(_first_filled("account", "account_inferred", "line_item_text"), F.lit(""))))["designation"])
    flat = flat.withColumn("column_layout", fx.column_layout(F.col("line_item_text"), *map(F.col, AMOUNTS)))
    flat = stored(crosswalk.with_names(flat), "lines")
    keyed = federal_accounts(crosswalk.enrich_accounts(flat, reference, CONTEXT), accounts)
    # restatements count only where no other tier comes first
    lone = flat.filter(~F.coalesce("verified", F.lit(False)) & F.coalesce(*AMOUNTS).isNotNull() & (fx.strip(F.coalesce("account_inferred", F.lit(""))) == ""))
    said = crosswalk.corroborated(lone, inline(flat) if callable(inline) else inline, ("line_item_text", "account_inferred"))
    # The rows move once, into the order in which they are written, and a report's restated ones come before them as one row.
    marks = stored(said.groupBy("report_id").agg(F.collect_list("row_ord").alias("_rows")), "restated")  # the order's sampling reads them too
    out = keyed.unionByName(marks, allowMissingColumns=True).repartitionByRange("report_id")
    found = F.last("_rows", ignorenulls=True).over(Window.partitionBy("report_id").orderBy("row_ord"))
    out = out.withColumn("_said", F.when(F.array_contains(found, F.col("row_ord")), True)).filter("_rows IS NULL")
    tier = verify.verification_tier(F.col("verified"), F.col("verification_method"), F.coalesce(*AMOUNTS).isNotNull(), F.col("account_inferred"), F.col("_said"))
    out = out.withColumn("verification_tier", tier)
    out = out.join(F.broadcast(factors.select("fiscal_year", F.col("real_factor").alias("real_factor_2024"))), "fiscal_year", "left")  # a row a year
    return out.select("row_ord", *FACT)


def write_fact(fact: DataFrame, path: str) -> dict[str, int]:
    """Writes the fact as compressed CSV in document order, and gives its counts, which the writing job itself takes."""
    seen = Observation("fact")
    has = F.coalesce(*map(F.col, LEVELS)).isNotNull()
    counts = {
        "n_rows": F.count(F.lit(1)), "line_items": F.count_if(~F.col("is_subtotal")), "totals": F.count_if("is_subtotal"), "with_amount": F.count_if(has),
        "keyed": F.count("account_key"), "verified": F.count_if("verified"), "memos": F.count_if("is_memo"), "untiered": F.count_if(F.col("verification_tier") == "none"),
    }
    ordered = fact.orderBy("report_id", "row_ord")  # counts are taken after the sort, whose sampling reads the rows too
    writers.write_csv(ordered.observe(seen, *[v.alias(k) for k, v in counts.items()]).select(*FACT), path, compression="gzip")
    return seen.get
