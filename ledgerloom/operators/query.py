"""Filters, projections, dedupe, flows, comparisons, facets and coverage over the ledger."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerloom.functions import text as fx
from ledgerloom.schema import FLOW_LEVELS
from ledgerloom.sources.workspace import stored

UNSPECIFIED, OTHER = "(unspecified)", "(other)"


def with_defaults(df: DataFrame) -> DataFrame:
    """Adds the columns of the full fact that a narrower ledger lacks, as nulls, and account_effective."""
    missing = [c for c in ("account_inferred", "account_recovered", "account_key", "account_key_title", "designation", "title_name", "department", "agency", "congress") if c not in df.columns]
    out = df.withColumns({c: F.lit(None).cast("string") for c in missing}) if missing else df
    blank = lambda c: F.nullif(fx.strip(F.col(c)), F.lit(""))
    return out.withColumn("account_effective", F.coalesce(blank("account"), blank("account_inferred"), blank("account_recovered")))


def filter_items(df: DataFrame, *, congress: int | None = None, chamber: str | None = None, subcommittee: str | None = None, stage: str | None = None, fiscal_year: int | None = None, fiscal_year_min: int | None = None, fiscal_year_max: int | None = None, account: str | None = None, account_key: str | None = None, designation: str | None = None, include_subtotals: bool = False) -> DataFrame:
    """All given conditions hold. A row without fiscal year is outside any range. account is found in account, label and title, ignoring case."""
    own = {"congress": congress, "chamber": chamber and chamber.lower(), "subcommittee": subcommittee, "stage": stage and stage.lower(), "fiscal_year": fiscal_year, "account_key": account_key, "designation": designation}
    conditions = [F.col(k) == v for k, v in own.items() if v is not None]
    if not include_subtotals:
        conditions.append(~F.coalesce(F.col("is_subtotal"), F.lit(False)))
    if fiscal_year_min is not None:
        conditions.append(F.col("fiscal_year") >= fiscal_year_min)
    if fiscal_year_max is not None:
        conditions.append(F.col("fiscal_year") <= fiscal_year_max)
    if account is not None:
        conditions.append(F.lower(F.concat_ws(" ", "account_effective", "line_item_text", "account_key_title")).contains(account.lower()))
    return df.filter(reduce(lambda a, b: a & b, conditions)) if conditions else df


# The columns of a line item as it is listed.
PROJECTION = (
    "report_id", "congress", "chamber", "fiscal_year", "subcommittee", "stage", "title_name", "department", "agency", "account", "account_inferred", "is_memo", "account_effective", "program", "line_item_text",
    "prior_year_enacted", "budget_estimate", "committee_recommendation", "delta_vs_enacted", "delta_vs_estimate", "account_key", "account_key_title", "account_key_agency", "account_key_bureau", "designation",
    "hierarchy_depth", "verified", "verification_tier", "verification_method", "column_layout", "extraction_method",
)


def project(df: DataFrame, *more: str) -> DataFrame:
    """The listed columns, null where df lacks one, and `more`."""
    return df.select(*[F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in PROJECTION], *more)


def page(df: DataFrame, limit: int = 100, offset: int = 0, most: int = 2000) -> DataFrame:
    """A page in document order, with the total before paging in `total`."""
    if not 0 < limit <= most or offset < 0:
        raise ValueError(f"limit must be 1 to {most}, and offset not negative")
    total = df.agg(F.count(F.lit(1)).alias("total")).scalar()
    return df.orderBy("report_id", "row_ord").offset(offset).limit(limit).withColumn("total", total)


def strict_subset(df: DataFrame) -> DataFrame:
    return df.filter("column_layout = 'standard' AND verification_tier <> 'none'")


def account_grain(df: DataFrame, metric: str = "committee_recommendation") -> DataFrame:
    """For each (report, account key or name) the row with the largest absolute amount, the first of ties; totals and rows without amount or account don't take part."""
    ident = F.coalesce("account_key", "account_effective")
    rows = df.withColumn("_ident", ident).filter(F.col(metric).isNotNull() & F.col("_ident").isNotNull() & ~fx.is_rollup(F.col("is_subtotal"), F.col("line_item_text")))
    rank = F.row_number().over(W.partitionBy("report_id", "_ident").orderBy(F.abs(metric).desc(), "row_ord"))
    return rows.withColumn("_rank", rank).filter("_rank = 1").drop("_rank", "_ident")


def grain_coverage(df: DataFrame, metric: str = "committee_recommendation") -> DataFrame:
    """How many rows with an amount have a printed account, a recovered one, or none."""
    rows = df.filter(F.col(metric).isNotNull() & ~fx.is_rollup(F.col("is_subtotal"), F.col("line_item_text")))
    return rows.groupBy(account_tier().alias("account_tier")).agg(F.count(F.lit(1)).alias("n_rows"))


def account_tier() -> Column:
    return F.when(fx.strip(F.coalesce("account", F.lit(""))) != "", "named").when(F.col("account_effective").isNotNull(), "recovered").otherwise("unlabeled")


def flow(df: DataFrame, metric: str = "committee_recommendation", levels: tuple[str, ...] = ("subcommittee", "title_name", "account"), top: int = 12) -> tuple[DataFrame, DataFrame]:
    """Nodes (level, name, total) and links (source_level, source, target_level, target, value) of a layered flow, at account grain.

    Blank names are unspecified. A level with 60 % or more of the money unspecified goes, except for the two least sparse. Of each level the `top`
    names by absolute money stay, ties by name; the rest is one node. The account grain is stored once. Which levels and names stay are two scalar
    subqueries over it (at most seven levels, of 50 names each), so that the rows themselves are mapped in place.
    """
    if len(levels) < 2 or not set(levels) <= set(FLOW_LEVELS) or not 2 <= top <= 50:
        raise ValueError("a flow takes two or more known levels, and top from 2 to 50")
    value = lambda c: F.coalesce(F.nullif(fx.strip(F.col("account_effective") if c == "account" else F.col(c)), F.lit("")), F.lit(UNSPECIFIED))
    grain = stored(account_grain(df, metric).select(F.col(metric).alias("amount"), F.array(*map(value, levels)).alias("names")), "grain")
    sizes = grain.select("amount", F.posexplode("names").alias("place", "name")).groupBy("place", "name").agg(F.sum(F.abs("amount")).alias("size"))
    shares = sizes.groupBy("place").agg(F.coalesce(F.try_divide(F.sum(F.when(F.col("name") == UNSPECIFIED, F.col("size")).otherwise(0)), F.sum("size")), F.lit(0.0)).alias("share"))
    order = F.array_sort(F.collect_list(F.struct("share", "place")))  # the least sparse first
    keep = shares.agg(F.transform(F.filter(order, lambda x, i: (i < 2) | (x["share"] < 0.6)), lambda x: x["place"]).alias("v")).scalar()
    best = sizes.withColumn("rank", F.row_number().over(W.partitionBy("place").orderBy(F.desc("size"), "name"))).filter(F.col("rank") <= top)
    best = best.agg(F.collect_list(F.struct("place", "name")).alias("v")).scalar()
    # without any row nothing is kept, and there is nothing to map
    rows = grain.select("amount", "names", F.coalesce(keep, F.array().cast("array<int>")).alias("keep"), best.alias("best"))
    node = lambda name, i: F.struct(F.get(F.array(*map(F.lit, levels)), i).alias("level"), F.when(F.array_contains("best", F.struct(i.cast("int").alias("place"), name.alias("name"))), name).otherwise(OTHER).alias("name"))
    path = F.filter(F.transform("names", node), lambda _, i: F.array_contains("keep", i.cast("int")))
    rows = rows.select("amount", path.alias("path"))
    nodes = rows.select("amount", F.explode("path").alias("n")).groupBy("n.level", "n.name").agg(F.sum("amount").alias("total"))
    pairs = F.zip_with(F.slice("path", F.lit(1), F.size("path") - 1), F.slice("path", F.lit(2), F.size("path") - 1), lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    links = rows.filter(F.size("path") > 1).select("amount", F.explode(pairs).alias("p")).groupBy(F.col("p.a.level").alias("source_level"), F.col("p.a.name").alias("source"), F.col("p.b.level").alias("target_level"), F.col("p.b.name").alias("target")).agg(F.sum("amount").alias("value"))
    return nodes, links


def compare(df: DataFrame, metric: str = "committee_recommendation", factors: DataFrame | None = None, **conditions) -> DataFrame:
    """Totals by fiscal year of the rows that meet the conditions (account or account_key is required); with factors, in base-year money.

    Rows of a year without a factor stay nominal and set factor_missing. Totals and programs are not deduplicated.
    """
    if not (conditions.get("account") or conditions.get("account_key")):
        raise ValueError("account or account_key is required")
    rows = filter_items(df, **conditions).filter(F.col(metric).isNotNull() & F.col("fiscal_year").isNotNull())
    value, missing = F.col(metric), F.lit(False)
    if factors is not None:
        rows = rows.join(factors.select("fiscal_year", "real_factor"), "fiscal_year", "left")
        missing = F.col("real_factor").isNull()
        value = F.coalesce(F.bround(value * F.col("real_factor"), 0).cast("bigint"), value)
    return rows.groupBy("fiscal_year").agg(F.sum(value).alias("amount"), F.count(F.lit(1)).alias("n_rows"), F.max(missing).alias("factor_missing"))


def facets(df: DataFrame, columns: tuple[str, ...] = ("chamber", "stage", "subcommittee", "fiscal_year")) -> DataFrame:
    """(facet, value) of distinct non-empty values."""
    each = F.explode(F.array(*[F.struct(F.lit(c).alias("facet"), F.col(c).cast("string").alias("value")) for c in columns])).alias("f")
    return df.select(each).select("f.*").filter("value IS NOT NULL AND value <> ''").distinct()


def coverage_matrix(df: DataFrame) -> DataFrame:
    return df.groupBy("stage", "chamber", "fiscal_year").agg(F.count_distinct("report_id").alias("reports"), F.count(F.lit(1)).alias("n_rows"), F.count_if(F.coalesce(F.col("verified"), F.lit(False))).alias("verified"))


def histogram(df: DataFrame, column: str) -> DataFrame:
    """Rows and percent by value."""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("n_rows"))
    total = F.sum("n_rows").over(W.partitionBy())  # over a row a value
    return counts.withColumn("percent", F.round(F.col("n_rows") * 100.0 / total, 4))


def unverified_profile(df: DataFrame, category: Column, top: int = 8, samples: int = 4) -> DataFrame:
    """By category of unverified rows with an amount: count, the `top` reports with the most of them, and the labels of the first `samples` rows in document order."""
    own = df.withColumn("category", category)
    rows = own.groupBy("category", "report_id").agg(F.count(F.lit(1)).alias("n"))
    ranked = rows.withColumn("rank", F.row_number().over(W.partitionBy("category").orderBy(F.desc("n"), "report_id")))
    listed = lambda c, k: F.array_join(F.transform(F.array_sort(F.collect_list(c)), lambda x: x[k]), ",")
    counts = ranked.groupBy("category").agg(F.sum("n").alias("n_rows"), listed(F.when(F.col("rank") <= top, F.struct("rank", "report_id")), "report_id").alias("top_reports"))
    first = own.select("category", F.coalesce("line_item_text", F.lit("")).alias("label"), F.row_number().over(W.partitionBy("category").orderBy("report_id", "row_ord")).alias("rank")).filter(F.col("rank") <= samples)
    return counts.join(first.groupBy("category").agg(listed(F.struct("rank", "label"), "label").alias("samples")), "category")


def smallest_first(sizes: DataFrame, size: str = "pages", key: str = "report_id") -> DataFrame:
    """The order in which work of unequal size is done: the smallest first, ties by key."""
    return sizes.orderBy(size, key)


def ordered_blank_first(df: DataFrame, *keys: str) -> DataFrame:
    """In order of the keys, where a missing text counts as an empty one."""
    return df.orderBy(*[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys])


def report_items(df: DataFrame, report_id: str) -> DataFrame:
    """The line items of one report in document order, as listed; no rows for an unknown report."""
    return project(df.filter(F.col("report_id") == report_id), "row_ord").orderBy("row_ord")


def find_reports(catalog: DataFrame, **conditions) -> DataFrame:
    """Reports that meet all given equalities (congress, chamber, subcommittee, fiscal_year, stage, package_id); subcommittees in canonical spelling."""
    given = [F.col(k) == v for k, v in conditions.items() if v is not None]
    out = catalog.withColumn("subcommittee", fx.canon_subcommittee(F.col("subcommittee")))
    return out.filter(reduce(lambda a, b: a & b, given)) if given else out
