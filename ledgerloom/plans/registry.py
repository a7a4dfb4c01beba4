"""The registered queries over the ledger and the SQL that must give the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions import text as fx
from ledgerloom.operators import crosswalk, query, reconcile, structure, trace, verify
from ledgerloom.plans.base import ORACLES, QUERIES, kept, register
from ledgerloom.plans.base import amounts as _amounts
from ledgerloom.plans.base import full as _full
from ledgerloom.schema import CPI, LEVELS
from ledgerloom.sources.ledger import deflators, ledger, ledger_by_report, table
from ledgerloom.sources.workspace import stored

FLAGSHIP = "compare_by_year"
__all__ = ["FLAGSHIP", "ORACLES", "QUERIES"]


# ---- filters, dedupe, flows -----------------------------------------------------------------------------------------


@register("filter_line_items", """
SELECT report_id, row_ord, fiscal_year, account, line_item_text, committee_recommendation FROM ledger
WHERE NOT is_subtotal AND chamber = 'senate' AND fiscal_year >= 1994 AND fiscal_year <= 1996
 AND contains(lower(concat_ws(' ', account, line_item_text)), 'anvil')""")  # fmt: skip
def filter_line_items(spark, sf_dir):
    rows = query.filter_items(_full(spark, sf_dir), chamber="SENATE", fiscal_year_min=1994, fiscal_year_max=1996, account="Anvil")
    return rows.select("report_id", "row_ord", "fiscal_year", "account", "line_item_text", "committee_recommendation")


@register("list_page", """
SELECT report_id, row_ord, line_item_text, count(*) OVER () AS total FROM ledger WHERE NOT is_subtotal ORDER BY report_id, row_ord LIMIT 100 OFFSET 50""")
def list_page(spark, sf_dir):
    return query.page(query.filter_items(_full(spark, sf_dir)).select("report_id", "row_ord", "line_item_text"), 100, 50)


_COMPARE = "SELECT fiscal_year, CAST(sum(committee_recommendation) AS BIGINT) AS amount, count(*) AS n_rows, false AS factor_missing FROM ledger WHERE NOT is_subtotal AND committee_recommendation IS NOT NULL AND contains(lower(concat_ws(' ', account, line_item_text)), 'gear') GROUP BY fiscal_year"


@register("compare_by_year", _COMPARE)
def compare_by_year(spark, sf_dir):
    return query.compare(_full(spark, sf_dir), account="gear")


_CPI_SQL = ", ".join(f"({y}, {v})" for y, v in CPI.items())


@register("compare_real", f"""
, f AS (SELECT y, CAST(round_even({CPI[2024]}::DOUBLE / v::DOUBLE, 4) AS DOUBLE) AS factor FROM (VALUES {_CPI_SQL}) AS t(y, v))
SELECT l.fiscal_year + 22 AS fiscal_year, CAST(sum(CASE WHEN factor IS NULL THEN committee_recommendation ELSE CAST(round_even(committee_recommendation * factor, 0) AS BIGINT) END) AS BIGINT) AS amount,
 count(*) AS n_rows, bool_or(factor IS NULL) AS factor_missing
FROM ledger l LEFT JOIN f ON y = l.fiscal_year + 22 WHERE NOT is_subtotal AND committee_recommendation IS NOT NULL AND contains(lower(concat_ws(' ', account, line_item_text)), 'bolt') GROUP BY ALL""")  # fmt: skip
def compare_real(spark, sf_dir):
    """The ledger's years moved into the price series."""
    rows = _full(spark, sf_dir).withColumn("fiscal_year", F.col("fiscal_year") + 22)
    return query.compare(rows, account="bolt", factors=deflators(spark))


@register("inflation_factors", f", y AS (SELECT DISTINCT fiscal_year + 20 AS fiscal_year FROM ledger) SELECT CAST(y.fiscal_year AS INTEGER) AS fiscal_year, CAST(round_even({CPI[2024]}::DOUBLE / v::DOUBLE, 4) AS DOUBLE) AS real_factor FROM y LEFT JOIN (VALUES {_CPI_SQL}) AS t(c, v) ON c = y.fiscal_year")
def inflation_factors(spark, sf_dir):
    """The factor of every year of the ledger; some years have none."""
    years = ledger(spark, sf_dir).select((F.col("fiscal_year") + 20).cast("int").alias("fiscal_year")).distinct()
    return years.join(deflators(spark), "fiscal_year", "left").select("fiscal_year", "real_factor")


_GRAIN = """
, g AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY report_id, account ORDER BY abs(committee_recommendation) DESC, row_ord) AS rk
 FROM ledger WHERE committee_recommendation IS NOT NULL AND account IS NOT NULL AND NOT is_subtotal) WHERE rk = 1)"""


@register("account_grain_dedupe", _GRAIN + " SELECT report_id, account, row_ord, committee_recommendation FROM g")
def account_grain_dedupe(spark, sf_dir):
    return query.account_grain(_full(spark, sf_dir)).select("report_id", "account", "row_ord", "committee_recommendation")


_FLOW = _GRAIN + """
, r AS (SELECT report_id, row_ord, committee_recommendation AS amount, subcommittee, agency, account FROM g)
, s AS (SELECT 'subcommittee' AS level, subcommittee AS name, sum(abs(amount)) AS size FROM r GROUP BY 2 UNION ALL SELECT 'agency', agency, sum(abs(amount)) FROM r GROUP BY 2 UNION ALL SELECT 'account', account, sum(abs(amount)) FROM r GROUP BY 2)
, k AS (SELECT level, name FROM (SELECT *, row_number() OVER (PARTITION BY level ORDER BY size DESC, name) AS rk FROM s) WHERE rk <= 12)
, n AS (SELECT r.*, coalesce(a.name, '(other)') AS s1, coalesce(b.name, '(other)') AS s2, coalesce(c.name, '(other)') AS s3 FROM r
 LEFT JOIN k a ON a.level = 'subcommittee' AND a.name = subcommittee LEFT JOIN k b ON b.level = 'agency' AND b.name = agency LEFT JOIN k c ON c.level = 'account' AND c.name = account)"""


def _flow(spark, sf_dir):
    return query.flow(_full(spark, sf_dir), levels=("subcommittee", "agency", "account"))


@register("flow_nodes", _FLOW + """
SELECT 'subcommittee' AS level, s1 AS name, CAST(sum(amount) AS BIGINT) AS total FROM n GROUP BY s1 UNION ALL SELECT 'agency', s2, CAST(sum(amount) AS BIGINT) FROM n GROUP BY s2 UNION ALL SELECT 'account', s3, CAST(sum(amount) AS BIGINT) FROM n GROUP BY s3""")  # fmt: skip
def flow_nodes(spark, sf_dir):
    return _flow(spark, sf_dir)[0]


@register("flow_links", _FLOW + """
SELECT 'subcommittee' AS source_level, s1 AS source, 'agency' AS target_level, s2 AS target, CAST(sum(amount) AS BIGINT) AS value FROM n GROUP BY s1, s2
UNION ALL SELECT 'agency', s2, 'account', s3, CAST(sum(amount) AS BIGINT) FROM n GROUP BY s2, s3""")  # fmt: skip
def flow_links(spark, sf_dir):
    return _flow(spark, sf_dir)[1]


@register("facets", """
SELECT DISTINCT facet, value FROM (SELECT 'chamber' AS facet, chamber AS value FROM ledger UNION ALL SELECT 'stage', stage FROM ledger UNION ALL SELECT 'subcommittee', subcommittee FROM ledger UNION ALL SELECT 'fiscal_year', CAST(fiscal_year AS VARCHAR) FROM ledger)""")  # fmt: skip
def facets(spark, sf_dir):
    return query.facets(ledger(spark, sf_dir))


_PASS = "coalesce(committee_recommendation - prior_year_enacted = delta_vs_enacted, true) AND coalesce(committee_recommendation - budget_estimate = delta_vs_estimate, true)"
_STATUS = f"CASE WHEN (committee_recommendation - prior_year_enacted = delta_vs_enacted) IS NULL AND (committee_recommendation - budget_estimate = delta_vs_estimate) IS NULL THEN 'unverifiable' WHEN {_PASS} THEN 'pass' ELSE 'fail' END"


@register("coverage_matrix", f"""
SELECT stage, chamber, fiscal_year, count(DISTINCT report_id) AS reports, count(*) AS n_rows, count(*) FILTER ({_STATUS} = 'pass') AS verified FROM ledger GROUP BY ALL""")
def coverage_matrix(spark, sf_dir):
    return query.coverage_matrix(ledger(spark, sf_dir).withColumn("verified", verify.row_status(*_amounts()) == "pass"))


_SPLIT = "pe <> 0 AND be <> 0 AND pe + be = cr AND de = pe AND dt = be"


@register("column_layout", """
, k AS (SELECT CASE WHEN pk % 43 = 9 THEN ' ' || (pk % 200) || CASE WHEN pk % 2 = 0 THEN '.' ELSE '' END WHEN pk % 43 = 10 THEN '1234' ELSE line_item_text END AS label, prior_year_enacted AS pe, CASE WHEN pk % 47 = 4 THEN 0 ELSE budget_estimate END AS be,
 CASE WHEN pk % 47 IN (3, 4) THEN prior_year_enacted + CASE WHEN pk % 47 = 4 THEN 0 ELSE budget_estimate END ELSE committee_recommendation END AS cr, CASE WHEN pk % 47 IN (3, 4) THEN prior_year_enacted ELSE delta_vs_enacted END AS de, CASE WHEN pk % 47 = 3 THEN budget_estimate WHEN pk % 47 = 4 THEN 0 ELSE delta_vs_estimate END AS dt FROM ledger)
SELECT column_layout, count(*) AS n_rows FROM (SELECT CASE WHEN regexp_full_match(trim(label), '[0-9]{1,3}\\.?') THEN 'procurement_qty' WHEN coalesce(pe <> 0 AND be <> 0 AND pe + be = cr AND de = pe AND dt = be, false) THEN 'category_split' ELSE 'standard' END AS column_layout FROM k) GROUP BY 1""")  # fmt: skip
def column_layout(spark, sf_dir):
    """Some labels are bare numbers; some rows have the sum of two columns as the third, of which those with a zero don't count."""
    rows, n = ledger(spark, sf_dir), F.col("pk")
    label = F.when(n % 43 == 9, F.concat(F.lit(" "), (n % 200).cast("string"), F.when(n % 2 == 0, ".").otherwise(""))).when(n % 43 == 10, "1234").otherwise(F.col("line_item_text"))
    pe, be, split = F.col("prior_year_enacted"), F.when(n % 47 == 4, 0).otherwise(F.col("budget_estimate")), (n % 47).isin(3, 4)
    cr, de, dt = (F.when(split, x).otherwise(F.col(c)) for x, c in ((pe + be, "committee_recommendation"), (pe, "delta_vs_enacted"), (be, "delta_vs_estimate")))
    return rows.groupBy(fx.column_layout(label, pe, be, cr, de, dt).alias("column_layout")).agg(F.count(F.lit(1)).alias("n_rows"))


# ---- accounts over time ---------------------------------------------------------------------------------------------

_REPS = """
, reps AS (SELECT report_id, code AS account_key, fiscal_year, chamber, stage, committee_recommendation AS amount, account AS title FROM (
 SELECT *, row_number() OVER (PARTITION BY report_id, code ORDER BY abs(committee_recommendation) DESC, row_ord) AS rk FROM ledger WHERE code IS NOT NULL AND committee_recommendation IS NOT NULL AND NOT is_subtotal) WHERE rk = 1)"""
_DOMINANT = _REPS + """
, dom AS (SELECT account_key, fiscal_year, title FROM (SELECT *, row_number() OVER (PARTITION BY account_key, fiscal_year ORDER BY money DESC, n DESC, title) AS rk FROM (
 SELECT account_key, fiscal_year, title, sum(abs(amount)) AS money, count(*) AS n FROM reps GROUP BY ALL)) WHERE rk = 1)"""


def _reps(spark, sf_dir):
    return trace.representatives(_full(spark, sf_dir).withColumn("account_key", F.col("code")))


@register("trace_series", _REPS + " SELECT account_key, fiscal_year, chamber, stage, CAST(sum(amount) AS BIGINT) AS amount FROM reps GROUP BY ALL")
def trace_series(spark, sf_dir):
    return trace.series(_reps(spark, sf_dir))


@register("trace_labels", _REPS + " SELECT account_key, title, min(fiscal_year) AS first_year, max(fiscal_year) AS last_year FROM reps GROUP BY ALL")
def trace_labels(spark, sf_dir):
    return trace.labels(_reps(spark, sf_dir))


_NORM = "trim(regexp_replace(lower({}), '[^a-z0-9]+', ' ', 'g'))"
_KIND = "CASE WHEN {a} = {b} THEN 'case' WHEN starts_with({a} || ' ', {b} || ' ') OR starts_with({b} || ' ', {a} || ' ') THEN 'prefix' ELSE 'reword' END".format(a=_NORM.format("before"), b=_NORM.format("after"))


@register("trace_changes", _DOMINANT + f"""
, c AS (SELECT account_key, lag(fiscal_year) OVER w AS year_before, fiscal_year, lag(title) OVER w AS before, title AS after FROM dom WINDOW w AS (PARTITION BY account_key ORDER BY fiscal_year))
SELECT * FROM (SELECT *, {_KIND} AS kind FROM c WHERE before IS NOT NULL) WHERE kind <> 'case'""")  # fmt: skip
def trace_changes(spark, sf_dir):
    return trace.title_changes(_reps(spark, sf_dir))


@register("trace_kinds", _DOMINANT + f"""
, c AS (SELECT account_key, lag(title) OVER (PARTITION BY account_key ORDER BY fiscal_year) AS before, title AS after FROM dom)
SELECT kind, count(*) AS changes, count(DISTINCT account_key) AS accounts FROM (SELECT *, {_KIND} AS kind FROM c WHERE before IS NOT NULL) WHERE kind <> 'case' GROUP BY kind""")  # fmt: skip
def trace_kinds(spark, sf_dir):
    return trace.title_changes(_reps(spark, sf_dir)).groupBy("kind").agg(F.count(F.lit(1)).alias("changes"), F.count_distinct("account_key").alias("accounts"))


# ---- row checks -----------------------------------------------------------------------------------------------------


@register("delta_status", f"SELECT {_STATUS} AS status, chamber, count(*) AS n_rows FROM ledger GROUP BY ALL")
def delta_status(spark, sf_dir):
    return ledger(spark, sf_dir).groupBy(verify.row_status(*_amounts()).alias("status"), "chamber").agg(F.count(F.lit(1)).alias("n_rows"))


_BROKEN = """
, b AS (SELECT report_id, row_ord, is_subtotal, chamber, prior_year_enacted AS pe, budget_estimate AS be, CASE WHEN NOT is_subtotal AND row_ord % 19 = 3 THEN NULL WHEN NOT is_subtotal AND row_ord % 23 = 5 THEN committee_recommendation + 100 ELSE committee_recommendation END AS cr, delta_vs_enacted AS de, delta_vs_estimate AS dt FROM ledger)
, p AS (SELECT *, pe + de AS c1, be + dt AS c2 FROM b)"""


def _broken(spark, sf_dir):
    """The ledger with some recommendations missing and some wrong."""
    cr = F.when(~F.col("is_subtotal") & (F.col("row_ord") % 19 == 3), None).when(~F.col("is_subtotal") & (F.col("row_ord") % 23 == 5), F.col("committee_recommendation") + 100).otherwise(F.col("committee_recommendation"))
    return ledger(spark, sf_dir).withColumn("committee_recommendation", cr)


@register("recover_primary", _BROKEN + " SELECT report_id, row_ord, coalesce(cr, CASE WHEN c1 IS NULL THEN c2 WHEN c2 IS NULL THEN c1 WHEN c1 = c2 THEN c1 END) AS recovered FROM p")
def recover_primary(spark, sf_dir):
    return _broken(spark, sf_dir).select("report_id", "row_ord", verify.recovered_primary(*_amounts()).alias("recovered"))


@register("repair", _BROKEN + """
, a AS (SELECT *, coalesce(cr, CASE WHEN c1 IS NULL THEN c2 WHEN c2 IS NULL THEN c1 WHEN c1 = c2 THEN c1 END) AS found FROM p)
, x AS (SELECT *, CASE WHEN is_subtotal THEN NULL WHEN cr IS NULL AND found IS NOT NULL THEN 'recovered' WHEN c1 = c2 AND c1 <> cr THEN 'corrected' END AS repair_action FROM a)
SELECT report_id, row_ord, repair_action, CASE WHEN repair_action = 'corrected' THEN cr END AS corrected_from, CASE WHEN repair_action = 'corrected' THEN c1 WHEN repair_action = 'recovered' THEN found ELSE cr END AS repaired FROM x""")  # fmt: skip
def repair(spark, sf_dir):
    return verify.repair(_broken(spark, sf_dir)).select("report_id", "row_ord", "repair_action", "corrected_from", "repaired")


@register("verify_summary", _BROKEN + """
, f AS (SELECT *, c1 = c2 AND c1 IS DISTINCT FROM cr AS fixed, CASE WHEN c1 = c2 AND c1 IS DISTINCT FROM cr THEN c1 ELSE cr END AS v FROM p)
, s AS (SELECT *, CASE WHEN (v - pe = de) IS NULL AND (v - be = dt) IS NULL THEN 'unverifiable' WHEN coalesce(v - pe = de, true) AND coalesce(v - be = dt, true) THEN 'pass' ELSE 'fail' END AS st FROM f)
SELECT chamber, count(*) FILTER (st = 'pass') AS passed, count(*) FILTER (st = 'fail') AS failed, count(*) FILTER (st = 'unverifiable') AS unverifiable, count(*) FILTER (coalesce(fixed, false)) AS auto_repaired,
 round(count(*) FILTER (st = 'pass') / CAST(count(*) FILTER (st <> 'unverifiable') AS DOUBLE), 6) AS pass_rate FROM s GROUP BY chamber""")  # fmt: skip
def verify_summary(spark, sf_dir):
    return verify.verify_summary(verify.verify(_broken(spark, sf_dir)), "chamber")


@register("repair_counts", _BROKEN + """
, a AS (SELECT *, coalesce(cr, CASE WHEN c1 IS NULL THEN c2 WHEN c2 IS NULL THEN c1 WHEN c1 = c2 THEN c1 END) AS found FROM p)
SELECT chamber, count(*) FILTER (NOT is_subtotal AND cr IS NULL AND found IS NOT NULL) AS recovered, count(*) FILTER (NOT is_subtotal AND c1 = c2 AND c1 <> cr) AS corrected FROM a GROUP BY ROLLUP (chamber)""")  # fmt: skip
def repair_counts(spark, sf_dir):
    return verify.repair(_broken(spark, sf_dir)).rollup("chamber").agg(F.count_if(F.col("repair_action") == "recovered").alias("recovered"), F.count_if(F.col("repair_action") == "corrected").alias("corrected"))


@register("magnitude", "SELECT report_id, row_ord, substr(line_item_text, 1, 60) AS label, CASE WHEN abs(prior_year_enacted) > 9000000 THEN 'prior_year_enacted' WHEN abs(budget_estimate) > 9000000 THEN 'budget_estimate' ELSE 'committee_recommendation' END AS \"column\", CASE WHEN abs(prior_year_enacted) > 9000000 THEN prior_year_enacted WHEN abs(budget_estimate) > 9000000 THEN budget_estimate ELSE committee_recommendation END AS value FROM ledger WHERE abs(prior_year_enacted) > 9000000 OR abs(budget_estimate) > 9000000 OR abs(committee_recommendation) > 9000000")
def magnitude(spark, sf_dir):
    return verify.oversized(ledger(spark, sf_dir), "report_id", "row_ord", ceiling=9_000_000)


@register("check_deltas", """
SELECT identity, holds, count(*) AS n_rows FROM (SELECT 'vs_enacted' AS identity, committee_recommendation - prior_year_enacted = coalesce(delta_vs_enacted, 0) AS holds FROM ledger UNION ALL SELECT 'vs_estimate', committee_recommendation - budget_estimate = coalesce(delta_vs_estimate, 0) FROM ledger) WHERE holds IS NOT NULL GROUP BY ALL""")  # fmt: skip
def check_deltas(spark, sf_dir):
    return verify.check_deltas(ledger(spark, sf_dir), "report_id", "row_ord").groupBy("identity", "holds").agg(F.count(F.lit(1)).alias("n_rows"))


@register("check_subtotal", "SELECT report_id, blk, CAST(sum(CASE WHEN is_subtotal THEN 0 ELSE coalesce(committee_recommendation, 0) END) AS BIGINT) AS computed, CAST(sum(CASE WHEN is_subtotal THEN coalesce(committee_recommendation, 0) ELSE 0 END) AS BIGINT) AS printed, sum(CASE WHEN is_subtotal THEN 0 ELSE coalesce(committee_recommendation, 0) END) = sum(CASE WHEN is_subtotal THEN coalesce(committee_recommendation, 0) ELSE 0 END) AS holds FROM ledger GROUP BY ALL")
def check_subtotal(spark, sf_dir):
    return verify.check_subtotal(ledger(spark, sf_dir), "report_id", "blk")


@register("three_tier_hits", r"""
WITH q AS MATERIALIZED (SELECT item_id, trim(regexp_replace(text, '\s+', ' ', 'g')) AS raw, regexp_replace(text, '\s+', '', 'g') AS bare FROM benchmark),
d AS MATERIALIZED (SELECT doc_id, text, regexp_replace(text, '\s+', ' ', 'g') AS flat, regexp_replace(text, '\s+', '', 'g') AS bare FROM documents)
SELECT item_id, doc_id, CASE WHEN contains(text, raw) THEN 'exact' WHEN contains(flat, raw) THEN 'whitespace' ELSE 'spaceless' END AS tier FROM q JOIN d ON contains(d.bare, q.bare) WHERE q.bare <> ''""", on_ledger=False)  # fmt: skip
def three_tier_hits(spark, sf_dir):
    """Every passage against every whole document."""
    passages = table(spark, sf_dir, "benchmark").withColumn("text", F.regexp_replace("text", r"\s+", " "))
    return verify.contained_passages(passages, table(spark, sf_dir, "documents"), "item_id", "doc_id")


@register("three_tier_match", r"""
WITH q AS MATERIALIZED (SELECT item_id, trim(regexp_replace(text, '\s+', ' ', 'g')) AS raw, regexp_replace(text, '\s+', '', 'g') AS bare FROM benchmark),
d AS MATERIALIZED (SELECT doc_id, text, regexp_replace(text, '\s+', ' ', 'g') AS flat, regexp_replace(text, '\s+', '', 'g') AS bare FROM documents)
SELECT item_id, count(*) FILTER (contains(text, raw)) AS exact, count(*) FILTER (NOT contains(text, raw) AND contains(flat, raw)) AS whitespace, count(*) FILTER (NOT contains(text, raw) AND NOT contains(flat, raw) AND text IS NOT NULL) AS spaceless FROM q LEFT JOIN d ON contains(d.bare, q.bare) AND q.bare <> '' GROUP BY item_id""", on_ledger=False)  # fmt: skip
def three_tier_match(spark, sf_dir):
    """For each passage the number of documents that hold it, by tier, over all documents."""
    passages = table(spark, sf_dir, "benchmark").withColumn("text", F.regexp_replace("text", r"\s+", " "))
    hits = verify.contained_passages(passages, table(spark, sf_dir, "documents"), "item_id", "doc_id")
    n = lambda t: F.count_if(F.col("tier") == t).alias(t)
    return passages.select("item_id").join(hits, "item_id", "left").groupBy("item_id").agg(n("exact"), n("whitespace"), n("spaceless"))


# ---- order ----------------------------------------------------------------------------------------------------------


@register("summary_islands", r"""
, t AS (SELECT report_id, row_ord, CASE WHEN row_ord % 29 = 0 THEN 'Projection of outlays' WHEN row_ord % 29 IN (1, 2) THEN 'Discretionary' WHEN row_ord % 31 = 7 THEN '1997' ELSE line_item_text END AS x FROM ledger)
, k AS (SELECT *, regexp_matches(x, '^(19|20)[0-9][0-9]$') AS y, x = 'Projection of outlays' AS h FROM t), s AS (SELECT *, y OR h OR x = 'Discretionary' AS kind FROM k)
, i AS (SELECT *, sum(CASE WHEN kind THEN 0 ELSE 1 END) OVER (PARTITION BY report_id ORDER BY row_ord) AS island FROM s)
SELECT report_id, row_ord, kind AND (y OR bool_or(h) OVER (PARTITION BY report_id, island ORDER BY row_ord)) AS is_summary FROM i""")  # fmt: skip
def summary_islands(spark, sf_dir):
    n = F.col("row_ord")
    label = F.when(n % 29 == 0, "Projection of outlays").when((n % 29).isin(1, 2), "Discretionary").when(n % 31 == 7, "1997").otherwise(F.col("line_item_text"))
    return structure.summary_flags(ledger(spark, sf_dir).withColumn("line_item_text", label)).select("report_id", "row_ord", "is_summary")


@register("next_rollup_backfill", """
, u2 AS (SELECT report_id, row_ord, is_subtotal, line_item_text, CASE WHEN pk % 3 = 0 THEN NULL ELSE account END AS account FROM ledger)
SELECT report_id, row_ord, CASE WHEN NOT is_subtotal AND account IS NULL THEN first_value(CASE WHEN is_subtotal THEN substr(line_item_text, 8) END IGNORE NULLS) OVER (PARTITION BY report_id ORDER BY row_ord ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) END AS account_recovered FROM u2""")  # fmt: skip
def next_rollup_backfill(spark, sf_dir):
    rows = ledger(spark, sf_dir).withColumn("account", F.when(F.col("pk") % 3 == 0, None).otherwise(F.col("account")))
    return structure.next_rollup_account(rows).select("report_id", "row_ord", "account_recovered")


@register("range_compress", """
, v AS (SELECT DISTINCT report_id, row_ord FROM ledger WHERE is_memo OR is_subtotal), g AS (SELECT *, row_ord - row_number() OVER (PARTITION BY report_id ORDER BY row_ord) AS k FROM v)
, r AS (SELECT report_id, min(row_ord) AS a, max(row_ord) AS b FROM g GROUP BY report_id, k)
SELECT report_id, string_agg(CASE WHEN a = b THEN CAST(a AS VARCHAR) ELSE CAST(a AS VARCHAR) || ':' || CAST(b AS VARCHAR) END, ',' ORDER BY a) AS ranges FROM r GROUP BY report_id""")  # fmt: skip
def range_compress(spark, sf_dir):
    return structure.compressed_ranges(ledger(spark, sf_dir).filter("is_memo OR is_subtotal"), "row_ord", "report_id")


@register("keep_first", "SELECT report_id, account, min(row_ord) AS row_ord FROM ledger WHERE account IS NOT NULL GROUP BY ALL")
def keep_first(spark, sf_dir):
    return structure.keep_first(ledger(spark, sf_dir).filter("account IS NOT NULL"), "report_id", "account").select("report_id", "account", "row_ord")


@register("forward_fill", """
, x AS (SELECT report_id, row_ord, CASE WHEN row_ord % 17 = 1 THEN agency END AS d, CASE WHEN row_ord % 5 = 2 THEN account END AS a FROM ledger)
, e AS (SELECT *, count(d) OVER (PARTITION BY report_id ORDER BY row_ord) AS k FROM x)
SELECT report_id, row_ord, last_value(d IGNORE NULLS) OVER (PARTITION BY report_id ORDER BY row_ord) AS department_ctx, last_value(a IGNORE NULLS) OVER (PARTITION BY report_id, k ORDER BY row_ord) AS account_ctx FROM e""")  # fmt: skip
def forward_fill(spark, sf_dir):
    n = F.col("row_ord")
    levels = [("department_ctx", F.when(n % 17 == 1, F.col("agency"))), ("account_ctx", F.when(n % 5 == 2, F.col("account")))]
    return structure.fill_context(ledger(spark, sf_dir).select("report_id", "row_ord", "agency", "account"), levels).select("report_id", "row_ord", "department_ctx", "account_ctx")


#: Blocks in order, one after the other: whether each closes, with the total of the one before as an addend if that closed.
_CHAIN = """
, l AS (SELECT *, CAST(sum(CASE WHEN is_subtotal THEN 1 ELSE 0 END) OVER (PARTITION BY report_id ORDER BY row_ord) - CASE WHEN is_subtotal THEN 1 ELSE 0 END AS BIGINT) AS k FROM ledger)
, b AS (SELECT report_id, k, max(CASE WHEN is_subtotal THEN blk END) AS blk, bool_or(is_subtotal) AS named,
 count(*) FILTER (NOT is_subtotal) AS n, count(*) FILTER (NOT is_subtotal AND NOT coalesce({paren}, false)) AS m,
 coalesce(CAST(sum(committee_recommendation) FILTER (NOT is_subtotal) AS BIGINT), 0) AS s1, coalesce(CAST(sum(budget_estimate) FILTER (NOT is_subtotal) AS BIGINT), 0) AS s2, coalesce(CAST(sum(prior_year_enacted) FILTER (NOT is_subtotal) AS BIGINT), 0) AS s3,
 coalesce(CAST(sum(committee_recommendation) FILTER (NOT is_subtotal AND NOT coalesce({paren}, false)) AS BIGINT), 0) AS f1, coalesce(CAST(sum(budget_estimate) FILTER (NOT is_subtotal AND NOT coalesce({paren}, false)) AS BIGINT), 0) AS f2, coalesce(CAST(sum(prior_year_enacted) FILTER (NOT is_subtotal AND NOT coalesce({paren}, false)) AS BIGINT), 0) AS f3,
 max(CASE WHEN is_subtotal THEN committee_recommendation END) AS t1, max(CASE WHEN is_subtotal THEN budget_estimate END) AS t2, max(CASE WHEN is_subtotal THEN prior_year_enacted END) AS t3 FROM l GROUP BY report_id, k)
, x AS (SELECT report_id, CAST(-1 AS BIGINT) AS k, CAST(NULL AS BIGINT) AS blk, false AS named, false AS good, CAST(NULL AS BIGINT) AS excess, CAST(NULL AS BIGINT) AS c1, CAST(NULL AS BIGINT) AS c2, CAST(NULL AS BIGINT) AS c3 FROM b WHERE k = 0
 UNION ALL
 SELECT report_id, k, blk, named, good, excess, CASE WHEN good THEN t1 END, CASE WHEN good THEN t2 END, CASE WHEN good THEN t3 END FROM (
  SELECT b.*, b.named AND (coalesce(n + p1 > 0 AND s1 + coalesce(c1, 0) = t1, false) OR coalesce(n + p2 > 0 AND s2 + coalesce(c2, 0) = t2, false) OR coalesce(n + p3 > 0 AND s3 + coalesce(c3, 0) = t3, false)
    OR (m <> n AND (coalesce(m + p1 > 0 AND f1 + coalesce(c1, 0) = t1, false) OR coalesce(m + p2 > 0 AND f2 + coalesce(c2, 0) = t2, false) OR coalesce(m + p3 > 0 AND f3 + coalesce(c3, 0) = t3, false)))) AS good,
   coalesce(CASE WHEN n + p1 > 0 THEN s1 + coalesce(c1, 0) - t1 END, CASE WHEN n + p2 > 0 THEN s2 + coalesce(c2, 0) - t2 END, CASE WHEN n + p3 > 0 THEN s3 + coalesce(c3, 0) - t3 END) AS excess
  FROM b JOIN (SELECT *, (c1 IS NOT NULL)::INT AS p1, (c2 IS NOT NULL)::INT AS p2, (c3 IS NOT NULL)::INT AS p3 FROM x) x ON b.report_id = x.report_id AND b.k = x.k + 1))"""


@register("block_inference", _CHAIN.format(paren="is_memo") + """
SELECT l.report_id, l.row_ord, 'Order ' || CAST(x.blk AS VARCHAR) AS account_inferred FROM x JOIN l ON l.report_id = x.report_id AND l.k = x.k WHERE NOT l.is_subtotal AND x.good""", recursive=True)
def block_inference(spark, sf_dir):
    rows = kept(spark, sf_dir).withColumn("account", F.lit(None).cast("string"))
    return structure.infer_block_accounts(rows).filter("account_inferred IS NOT NULL").select("report_id", "row_ord", "account_inferred")


@register("oversum_blocks", _CHAIN.format(paren="NULL") + """
SELECT report_id, k AS block, 'Order ' || CAST(blk AS VARCHAR) AS name, excess FROM x WHERE named AND NOT good AND excess > 0""", recursive=True)
def oversum_blocks(spark, sf_dir):
    return structure.oversum_blocks(kept(spark, sf_dir))


@register("recover_indent", """
, b AS (SELECT report_id, blk, sum(CASE WHEN NOT is_subtotal AND NOT is_memo THEN committee_recommendation END) AS s, max(CASE WHEN is_subtotal THEN committee_recommendation END) AS t, bool_or(is_memo) AS f FROM ledger GROUP BY ALL)
SELECT l.report_id, l.row_ord, l.is_memo, CASE WHEN NOT l.is_memo THEN 'Order ' || CAST(l.blk AS VARCHAR) END AS account_inferred FROM ledger l JOIN b ON l.report_id = b.report_id AND l.blk = b.blk WHERE b.f AND b.s = b.t AND NOT l.is_subtotal""")  # fmt: skip
def recover_indent(spark, sf_dir):
    rows = kept(spark, sf_dir)
    done = structure.recover_indent(rows.withColumn("is_memo", F.lit(False)), rows.filter("is_memo"))
    return done.filter("account_inferred IS NOT NULL OR is_memo").select("report_id", "row_ord", "is_memo", "account_inferred")


#: Totals print the recommendation only, a page is forty rows, and what a reader answers depends on the page: nothing, no JSON, the first line of each block, or the lines that are memos.
_INDENT = _CHAIN.format(paren="NULL").replace("max(CASE WHEN is_subtotal THEN budget_estimate END) AS t2", "CAST(NULL AS BIGINT) AS t2").replace("max(CASE WHEN is_subtotal THEN prior_year_enacted END) AS t3", "CAST(NULL AS BIGINT) AS t3") + """
, o AS (SELECT x.report_id, x.k, x.blk, max(CASE WHEN l.is_subtotal THEN l.row_ord END) // 40 AS page, max(CASE WHEN l.is_subtotal THEN l.committee_recommendation END) AS t FROM x JOIN l ON l.report_id = x.report_id AND l.k = x.k WHERE x.named AND NOT x.good AND x.excess > 0 GROUP BY x.report_id, x.k, x.blk)
, g AS (SELECT *, page % 7 AS answer, chr(CAST(64 + row_number() OVER (PARTITION BY report_id, page ORDER BY k) AS INTEGER)) AS letter FROM o)
, f AS (SELECT l.report_id, l.row_ord, g.page, g.letter, g.k, g.t, 'Order ' || CAST(g.blk AS VARCHAR) AS name, g.answer, l.committee_recommendation AS v, l.line_item_text AS label, row_number() OVER (PARTITION BY l.report_id, l.k ORDER BY l.row_ord) AS leaf, l.is_memo FROM g JOIN l ON l.report_id = g.report_id AND l.k = g.k WHERE NOT l.is_subtotal)
, e AS (SELECT *, CASE WHEN answer = 2 THEN leaf = 1 WHEN answer > 2 THEN is_memo ELSE false END AS outside FROM f)
, d AS (SELECT *, bool_or(outside) OVER b AND coalesce(sum(CASE WHEN NOT outside THEN v END) OVER b = t, false) AS fits FROM e WINDOW b AS (PARTITION BY report_id, k))
"""


def _indent(spark, sf_dir):
    """The line items of over-summing blocks, and the answers to their questions."""
    rows = ledger_by_report(spark, sf_dir).withColumns({c: F.when(~F.col("is_subtotal"), F.col(c)) for c in ("budget_estimate", "prior_year_enacted")}).withColumn("page", F.expr("row_ord div 40")).withColumn("account", F.lit(None).cast("string"))
    marked = stored(structure.indent_leaves(rows, carry=("is_memo",)), "leaves")  # answers, gates and counts start from them
    leaves = marked.drop("is_memo")
    each = marked.groupBy("report_id", "page", "letter").agg(F.sort_array(F.collect_list(F.when(F.when(F.col("page") % 7 == 2, F.col("leaf") == 1).otherwise(F.col("is_memo")), F.col("leaf")))).alias("lines"))
    right = each.groupBy("report_id", "page").agg(F.to_json(F.map_from_entries(F.collect_list(F.struct("letter", "lines")))).alias("json"))
    answer = F.when(F.col("page") % 7 == 0, None).when(F.col("page") % 7 == 1, "I see {A: [1, and more").otherwise(F.concat(F.lit("Here it is:\n"), "json", F.lit(" as asked")))
    return leaves, structure.indent_flags(right.select("report_id", "page", answer.alias("answer")))


@register("indent_accepted", _INDENT + " SELECT report_id, row_ord, outside AS is_memo, CASE WHEN NOT outside THEN name END AS account_inferred FROM d WHERE fits", recursive=True)
def indent_accepted(spark, sf_dir):
    """What the answers change: memos and names of the blocks that close without the lines said to be non-adding."""
    return structure.indent_accepted(*_indent(spark, sf_dir)).select("report_id", "row_ord", "is_memo", "account_inferred")


@register("indent_stats", _INDENT + """ SELECT count(DISTINCT (report_id, k)) AS oversum_blocks, count(DISTINCT (report_id, page)) AS pages, count(DISTINCT CASE WHEN answer = 0 THEN (report_id, page) END) AS pages_failed, count(DISTINCT CASE WHEN answer = 1 THEN (report_id, page) END) AS pages_malformed,
 count(DISTINCT CASE WHEN fits THEN (report_id, k) END) AS blocks_recovered, count(*) FILTER (fits AND NOT outside) AS rows_labeled, count(*) FILTER (fits AND outside) AS lines_marked FROM d""", recursive=True)
def indent_stats(spark, sf_dir):
    leaves, flags = _indent(spark, sf_dir)
    return structure.indent_stats(leaves, flags, structure.indent_accepted(leaves, flags))


@register("indent_questions", _INDENT + """
, q AS (SELECT report_id, page, k, 'Block ' || letter || ', total of ' || name || ' = ' || t || chr(10) || string_agg('  ' || leaf || '. ' || left(label, 60) || ': ' || coalesce(CAST(v AS VARCHAR), 'no amount'), chr(10) ORDER BY leaf) AS block FROM d GROUP BY report_id, page, k, letter, name, t)
SELECT report_id, page, string_agg(block, chr(10) ORDER BY k) AS blocks FROM q GROUP BY report_id, page""", recursive=True)
def indent_questions(spark, sf_dir):
    """The questions, without their first line, which says what is asked."""
    asked = structure.indent_questions(_indent(spark, sf_dir)[0])
    return asked.select("report_id", "page", F.regexp_replace("question", r"^.*\n", "").alias("blocks"))


# ---- reconciliation -------------------------------------------------------------------------------------------------

#: The ledger as some printer might have spoilt it: totals of another view, and line items whose recommendation wasn't read.
_STATEMENT = """
, statement AS (SELECT report_id, row_ord, chamber, stage, fiscal_year, blk, is_subtotal, is_memo, prior_year_enacted AS pe, budget_estimate AS be,
 CASE WHEN is_subtotal AND blk % 17 = 4 THEN 'Total, available this fiscal year' ELSE line_item_text END AS label,
 CASE WHEN NOT is_subtotal AND pk % 37 = 9 THEN NULL ELSE committee_recommendation END AS cr,
 CASE WHEN NOT is_subtotal AND pk % 37 = 9 THEN NULL ELSE delta_vs_enacted END AS de, CASE WHEN NOT is_subtotal AND pk % 37 = 9 THEN NULL ELSE delta_vs_estimate END AS dt FROM ledger)
, p AS (SELECT *, coalesce(cr, CASE WHEN pe + de IS NULL THEN be + dt WHEN be + dt IS NULL OR pe + de = be + dt THEN pe + de END) AS v, is_subtotal OR regexp_matches(label, '(?i)^\\s*\\(?(sub)?total\\b') AS tot FROM statement)"""
#: The same verdicts row by row: the state after each row is the list of open addends.
_VERDICTS = _STATEMENT + """
, s(report_id, i, vals, firm, n_firm, best, n_open) AS (
 SELECT DISTINCT report_id, CAST(0 AS BIGINT), CAST([] AS BIGINT[]), CAST([] AS BIGINT[]), CAST([] AS BIGINT[]), CAST(NULL AS STRUCT(g BIGINT, o BIGINT, gap BIGINT)), CAST(0 AS BIGINT) FROM p
 UNION ALL
 SELECT report_id, i + 1, CASE WHEN v IS NULL THEN vals WHEN NOT tot THEN list_append(vals, v) ELSE list_append(vals[1:n - k], v) END,
  CASE WHEN v IS NULL THEN firm WHEN NOT tot THEN list_append(firm, CASE WHEN is_memo THEN 0 ELSE v END) ELSE list_append(firm[1:n - k], v) END,
  CASE WHEN v IS NULL THEN n_firm WHEN NOT tot THEN list_append(n_firm, CASE WHEN is_memo THEN 0 ELSE 1 END) ELSE list_append(n_firm[1:n - k], 1) END, b,
  CASE WHEN b IS NULL THEN 0 WHEN b.o % 2 = 1 THEN k ELSE CAST(list_sum(n_firm[n - k + 1:n]) AS BIGINT) END
 FROM (SELECT *, coalesce(b.o // 2, 0) AS k FROM (SELECT s.report_id, i, vals, firm, n_firm, len(vals) AS n, p.v, p.tot, p.is_memo, CASE WHEN p.tot AND p.v IS NOT NULL AND len(vals) > 0 THEN
   list_sort(list_filter(flatten(list_transform(range(1, len(vals) + 1), lambda j: [
     CASE WHEN list_sum(n_firm[len(vals) - j + 1:]) > 0 THEN {'g': abs(CAST(list_sum(firm[len(vals) - j + 1:]) AS BIGINT) - p.v), 'o': CAST(2 * j AS BIGINT), 'gap': CAST(list_sum(firm[len(vals) - j + 1:]) AS BIGINT) - p.v} END,
     {'g': abs(CAST(list_sum(vals[len(vals) - j + 1:]) AS BIGINT) - p.v), 'o': CAST(2 * j + 1 AS BIGINT), 'gap': CAST(list_sum(vals[len(vals) - j + 1:]) AS BIGINT) - p.v}])), lambda x: x IS NOT NULL))[1] END AS b
  FROM s JOIN p ON p.report_id = s.report_id AND p.row_ord = s.i + 1)))
, t AS (SELECT p.*, coalesce(lag(CASE WHEN v IS NOT NULL THEN row_ord END IGNORE NULLS) OVER (PARTITION BY report_id ORDER BY row_ord), 0) AS since FROM p WHERE tot)
, w AS (SELECT t.report_id, t.row_ord, bool_or(regexp_matches(lower(p.label), 'advance|available this fiscal|appropriated in this bill|forward fund|less prior year|prior year appropriation|available in|to remain available')) AS views,
  bool_or(NOT p.tot AND NOT p.is_memo AND p.v IS NULL AND coalesce(p.pe, p.be, p.de, p.dt) IS NOT NULL) AS part FROM t JOIN p ON p.report_id = t.report_id AND p.row_ord > t.since AND p.row_ord <= t.row_ord GROUP BY ALL)
, verdicts AS (SELECT t.report_id, t.row_ord, chamber, stage, t.v AS printed, CASE WHEN v IS NOT NULL THEN coalesce(best.gap, -v) END AS delta, CASE WHEN v IS NOT NULL THEN CASE WHEN best.o % 2 = 1 THEN 'included' ELSE 'excluded' END END AS memo_mode, CASE WHEN v IS NULL THEN 0 ELSE n_open END AS n_children,
  CASE WHEN v IS NULL THEN 'unchecked' WHEN best.gap = 0 AND n_open > 0 THEN 'ok' WHEN views THEN 'overlapping_view' WHEN part THEN 'partial_read' WHEN v <> 0 AND abs(coalesce(best.gap, -v)) / CAST(abs(v) AS DOUBLE) <= 0.02 THEN 'off_by_small' ELSE 'unreconciled' END AS status
  FROM t JOIN s ON s.report_id = t.report_id AND s.i = t.row_ord JOIN w ON w.report_id = t.report_id AND w.row_ord = t.row_ord)"""


def _statement(spark, sf_dir):
    lost = ~F.col("is_subtotal") & (F.col("pk") % 37 == 9)
    rows = ledger_by_report(spark, sf_dir).withColumn("line_item_text", F.when(F.col("is_subtotal") & (F.col("blk") % 17 == 4), "Total, available this fiscal year").otherwise(F.col("line_item_text")))
    return rows.withColumns({c: F.when(~lost, F.col(c)) for c in ("committee_recommendation", "delta_vs_enacted", "delta_vs_estimate")})


@register("reconcile_totals", _VERDICTS + " SELECT report_id, row_ord, printed, delta, status, memo_mode, n_children FROM verdicts", recursive=True)
def reconcile_totals(spark, sf_dir):
    return reconcile.reconcile(_statement(spark, sf_dir)).select("report_id", "row_ord", "printed", "delta", "status", "memo_mode", "n_children")


@register("reconcile_ledger", _VERDICTS + " SELECT report_id, count(*) AS totals, count(*) FILTER (status = 'ok') AS ok, count(*) FILTER (status = 'partial_read') AS partial_read, sum(n_children)::BIGINT AS n_children FROM verdicts GROUP BY report_id", recursive=True)
def reconcile_ledger(spark, sf_dir):
    """One JSON text a report, read again."""
    texts = reconcile.ledger_json(reconcile.reconcile(_statement(spark, sf_dir)))
    kept = "summary struct<ok:bigint,partial_read:bigint>, totals array<struct<row_ord:bigint,status:string,children:array<bigint>>>"
    rows = texts.select("report_id", F.from_json("json", kept).alias("j"))
    return rows.select("report_id", F.size("j.totals").cast("bigint").alias("totals"), "j.summary.ok", "j.summary.partial_read", F.aggregate("j.totals", F.lit(0).cast("bigint"), lambda n, t: n + F.size(t["children"])).alias("n_children"))


@register("reconcile_summary", _VERDICTS + """
, k AS (SELECT CASE WHEN stage = 'enacted' THEN 'enacted' ELSE chamber END AS track, status FROM verdicts)
, n AS (SELECT track, count(*) AS totals, count(*) FILTER (status = 'ok') AS ok, count(*) FILTER (status = 'unchecked') AS unchecked, count(*) FILTER (status = 'off_by_small') AS off_by_small, count(*) FILTER (status = 'partial_read') AS partial_read, count(*) FILTER (status = 'overlapping_view') AS overlapping_view, count(*) FILTER (status = 'unreconciled') AS unreconciled FROM k GROUP BY ROLLUP (track))
SELECT *, totals - unchecked AS checkable, totals - unchecked - overlapping_view AS measurable, round(ok / CAST(nullif(totals - unchecked, 0) AS DOUBLE), 6) AS pass_rate, round(ok / CAST(nullif(totals - unchecked - overlapping_view, 0) AS DOUBLE), 6) AS strict_pass_rate FROM n""", recursive=True)  # fmt: skip
def reconcile_summary(spark, sf_dir):
    return reconcile.summarize(reconcile.reconcile(_statement(spark, sf_dir).withColumn("track", F.expr("CASE WHEN stage = 'enacted' THEN stage ELSE chamber END")), ("track",)), "track")


@register("review_queue", _VERDICTS + """
SELECT report_id, count(*) FILTER (status IN ('off_by_small', 'partial_read', 'unreconciled')) AS genuine, count(*) AS totals FROM verdicts GROUP BY report_id HAVING count(*) FILTER (status IN ('off_by_small', 'partial_read', 'unreconciled')) > 0 ORDER BY genuine DESC, report_id LIMIT 10""", recursive=True)  # fmt: skip
def review_queue(spark, sf_dir):
    return reconcile.review_queue(reconcile.reconcile(_statement(spark, sf_dir)))


@register("reconcile_checks", _VERDICTS + """
SELECT report_id, row_ord, printed, CASE WHEN n_children > 0 THEN printed + delta END AS computed, n_children > 0 AS complete FROM verdicts WHERE printed IS NOT NULL""", recursive=True)  # fmt: skip
def reconcile_checks(spark, sf_dir):
    """The check of the recommendation column: every child counts there, so it is complete wherever there is one."""
    c = F.col("checks")["committee_recommendation"]
    return reconcile.reconcile(_statement(spark, sf_dir)).filter("checks IS NOT NULL").select("report_id", "row_ord", c["printed"].alias("printed"), c["computed"].alias("computed"), c["complete"].alias("complete"))


@register("blind_reports", _STATEMENT.replace("CASE WHEN NOT is_subtotal AND pk % 37 = 9 THEN NULL", "CASE WHEN (NOT is_subtotal AND pk % 37 = 9) OR (is_subtotal AND substr(md5(report_id), 1, 1) < '4') THEN NULL") + " SELECT report_id, count(*) AS n_rows, count(*) FILTER (tot) AS totals FROM p GROUP BY report_id HAVING count(*) FILTER (tot AND v IS NOT NULL) = 0", recursive=True)
def blind_reports(spark, sf_dir):
    """About a quarter of the reports has totals of which no amount was read."""
    blank = F.col("is_subtotal") & (F.substring(F.md5("report_id"), 1, 1) < "4")
    rows = _statement(spark, sf_dir)
    rows = rows.withColumns({c: F.when(~blank, F.col(c)) for c in ("committee_recommendation", "delta_vs_enacted", "delta_vs_estimate")})
    return reconcile.blind_reports(reconcile.reconcile(rows), rows)


_AUDIT = _STATEMENT + """
, s(report_id, i, vals, hit, nearest) AS (
 SELECT DISTINCT report_id, CAST(0 AS BIGINT), CAST([] AS BIGINT[]), CAST(NULL AS BIGINT), CAST(NULL AS BIGINT) FROM p
 UNION ALL SELECT report_id, i + 1, CASE WHEN v IS NULL THEN vals WHEN hit IS NULL THEN list_append(vals, v) ELSE list_append(vals[1:len(vals) - hit], v) END, hit, nearest
 FROM (SELECT s.report_id, i, vals, p.v, CASE WHEN is_subtotal AND p.v IS NOT NULL THEN list_min(list_filter(range(1, len(vals) + 1), lambda j: list_sum(vals[len(vals) - j + 1:]) = p.v)) END AS hit,
   CASE WHEN is_subtotal AND p.v IS NOT NULL THEN list_min(list_transform(range(1, len(vals) + 1), lambda j: abs(CAST(list_sum(vals[len(vals) - j + 1:]) AS BIGINT) - p.v))) END AS nearest FROM s JOIN p ON p.report_id = s.report_id AND p.row_ord = s.i + 1))
, t AS (SELECT *, coalesce(lag(row_ord) OVER (PARTITION BY report_id ORDER BY row_ord), 0) AS since FROM p WHERE is_subtotal AND v IS NOT NULL)
, w AS (SELECT t.report_id, t.row_ord, t.v, bool_or(p.label LIKE '%available this fiscal%') AS views, bool_or(NOT p.is_subtotal AND p.v IS NULL AND coalesce(p.pe, p.be, p.de, p.dt) IS NOT NULL) AS part FROM t JOIN p ON p.report_id = t.report_id AND p.row_ord > t.since AND p.row_ord <= t.row_ord GROUP BY ALL)
, audited AS (SELECT w.report_id, w.row_ord, w.v AS printed, CASE WHEN hit IS NOT NULL THEN 'ok' WHEN views THEN 'structural' WHEN part THEN 'partial_read' WHEN w.v <> 0 AND nearest / CAST(abs(w.v) AS DOUBLE) <= 0.02 THEN 'off_by_small' ELSE 'structural' END AS verdict
FROM w JOIN s ON s.report_id = w.report_id AND s.i = w.row_ord)"""


@register("audit_blocks", _AUDIT + " SELECT * FROM audited", recursive=True)
def audit_blocks(spark, sf_dir):
    return reconcile.audit(_statement(spark, sf_dir))


@register("audit_by_track", _AUDIT + """
, k AS (SELECT CASE WHEN p.stage = 'enacted' THEN 'enacted' ELSE p.chamber END AS track, CAST(114 + floor((p.fiscal_year + 22 - 2016) / 2) AS INTEGER) AS congress, verdict FROM audited JOIN p ON p.report_id = audited.report_id AND p.row_ord = audited.row_ord)
SELECT track, congress, count(*) AS totals, count(*) FILTER (verdict = 'ok') AS ok, count(*) FILTER (verdict = 'structural') AS structural, count(*) FILTER (verdict = 'partial_read') AS partial_read, count(*) FILTER (verdict = 'off_by_small') AS off_by_small FROM k GROUP BY ROLLUP (track, congress)""", recursive=True)
def audit_by_track(spark, sf_dir):
    """The audit's verdicts by track and congress, with the rows for all."""
    rows = _statement(spark, sf_dir)
    place = rows.select("report_id", "row_ord", F.expr("CASE WHEN stage = 'enacted' THEN stage ELSE chamber END AS track"), fx.congress_of_year(F.col("fiscal_year") + 22).alias("congress"))
    counts = [F.count_if(F.col("verdict") == v).alias(v) for v in ("ok", "structural", "partial_read", "off_by_small")]
    return reconcile.audit(rows).join(place, ["report_id", "row_ord"]).rollup("track", "congress").agg(F.count(F.lit(1)).alias("totals"), *counts)


@register("typeset_reconcile", """
, b AS (SELECT report_id, row_ord, is_subtotal, sum(CASE WHEN is_subtotal THEN 1 ELSE 0 END) OVER (PARTITION BY report_id ORDER BY row_ord) - CASE WHEN is_subtotal THEN 1 ELSE 0 END AS k, coalesce(budget_estimate, 0) AS req, coalesce(committee_recommendation, 0) AS rec FROM ledger)
, g AS (SELECT report_id, k, max(CASE WHEN is_subtotal THEN row_ord END) AS row_ord, count(*) FILTER (NOT is_subtotal) AS n, coalesce(sum(req) FILTER (NOT is_subtotal), 0) AS q, coalesce(sum(rec) FILTER (NOT is_subtotal), 0) AS c, max(CASE WHEN is_subtotal THEN req END) AS tq, max(CASE WHEN is_subtotal THEN rec END) AS tc FROM b GROUP BY ALL)
, r AS (SELECT *, row_number() OVER (PARTITION BY report_id ORDER BY k) AS i FROM g WHERE row_ord IS NOT NULL)
, s(report_id, i, sq, sc, outcome) AS (
 SELECT DISTINCT report_id, CAST(0 AS BIGINT), CAST([] AS BIGINT[]), CAST([] AS BIGINT[]), CAST(NULL AS VARCHAR) FROM r
 UNION ALL SELECT report_id, i + 1, list_append(CASE WHEN NOT leaf AND hit IS NOT NULL THEN sq[1:len(sq) - hit] ELSE sq END, tq), list_append(CASE WHEN NOT leaf AND hit IS NOT NULL THEN sc[1:len(sc) - hit] ELSE sc END, tc), CASE WHEN leaf THEN 'leaf' WHEN hit IS NOT NULL THEN 'rollup' ELSE 'bad' END
 FROM (SELECT s.report_id, s.i, sq, sc, r.tq, r.tc, r.n > 0 AND r.q = r.tq AND r.c = r.tc AS leaf, list_min(list_filter(range(1, len(sq) + 1), lambda j: r.q + list_sum(sq[len(sq) - j + 1:]) = r.tq AND r.c + list_sum(sc[len(sc) - j + 1:]) = r.tc)) AS hit FROM s JOIN r ON r.report_id = s.report_id AND r.i = s.i + 1))
SELECT r.report_id, r.row_ord, s.outcome FROM s JOIN r ON r.report_id = s.report_id AND r.i = s.i""", recursive=True)  # fmt: skip
def typeset_reconcile(spark, sf_dir):
    rows = ledger(spark, sf_dir).select("report_id", "row_ord", F.when(F.col("is_subtotal"), "total").otherwise("value").alias("kind"), F.col("budget_estimate").alias("request"), F.col("committee_recommendation").alias("recommendation"))
    return reconcile.typeset_totals(rows)


# ---- joins ----------------------------------------------------------------------------------------------------------


def _reference(spark, sf_dir):
    """Parts as a reference of accounts: the name is the symbol, name and type the title."""
    p = table(spark, sf_dir, "part")
    return p.select(F.col("p_partkey").alias("ref_ord"), F.col("p_name").alias("federal_account_symbol"), F.concat_ws(" ", "p_name", "p_type").alias("account_title"), F.col("p_brand").alias("agency"))


@register("crosswalk_containment", """
WITH stop AS (SELECT unnest(['the','of','and','for','to','a','an','in','on','at','by','salaries','expenses','account','accounts','fund','funds','revolving','appropriation','appropriations']) AS w),
rw AS (SELECT DISTINCT p_partkey, p_name, t, w FROM (SELECT p_partkey, p_name, p_name || ' ' || p_type AS t, unnest(regexp_extract_all(lower(p_name || ' ' || p_type), '[a-z0-9]+')) AS w FROM part) WHERE length(w) > 2 AND w NOT IN (SELECT w FROM stop)),
r AS (SELECT * FROM rw WHERE p_partkey IN (SELECT p_partkey FROM rw GROUP BY 1 HAVING count(*) >= 2)),
lab AS (SELECT DISTINCT p_name AS name FROM part UNION SELECT string_split(p_name, ' ')[2] || ' ' || p_type FROM part), lw AS (SELECT DISTINCT name, w FROM (SELECT name, unnest(regexp_extract_all(lower(name), '[a-z0-9]+')) AS w FROM lab) WHERE length(w) > 2 AND w NOT IN (SELECT w FROM stop)),
l AS (SELECT *, count(*) OVER (PARTITION BY name) AS n FROM lw),
m AS (SELECT name, p_partkey, p_name, t FROM l JOIN r USING (w) WHERE n >= 2 GROUP BY name, n, p_partkey, p_name, t HAVING count(*) = n)
SELECT name, min(p_name) AS symbol, arg_min(t, p_partkey) AS title FROM m GROUP BY name HAVING count(DISTINCT p_name) = 1""", on_ledger=False)  # fmt: skip
def crosswalk_containment(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    labels = p.select(F.col("p_name").alias("name")).union(p.select(F.concat_ws(" ", F.element_at(F.split("p_name", " "), 2), "p_type")))
    return crosswalk.contained(labels.withColumn("bucket", F.lit("")), _reference(spark, sf_dir)).select("name", "symbol", "title")


@register("crosswalk_two_pass", """
, stop AS (SELECT unnest(['the','of','and','for','to','a','an','in','on','at','by','salaries','expenses','account','accounts','fund','funds','revolving','appropriation','appropriations']) AS w)
, rw AS (SELECT DISTINCT p_partkey, p_name, p_brand, p_name || ' ' || p_type AS t, w FROM (SELECT *, unnest(regexp_extract_all(lower(p_name || ' ' || p_type), '[a-z0-9]+')) AS w FROM part) WHERE length(w) > 2 AND w NOT IN (SELECT w FROM stop))
, lab AS (SELECT DISTINCT line_item_text AS name, subcommittee AS bucket FROM ledger WHERE account IS NOT NULL)
, lw AS (SELECT name, bucket, w, count(*) OVER (PARTITION BY name, bucket) AS n FROM (SELECT DISTINCT name, bucket, unnest(regexp_extract_all(lower(name), '[a-z0-9]+')) AS w FROM lab) WHERE length(w) > 2 AND w NOT IN (SELECT w FROM stop))
, m AS (SELECT name, bucket, p_partkey, p_name, p_brand, t FROM lw JOIN rw USING (w) WHERE n >= 2 GROUP BY name, bucket, n, p_partkey, p_name, p_brand, t HAVING count(*) = n)
, f AS (SELECT name, bucket, min(p_name) AS symbol, arg_min(t, p_partkey) AS title, arg_min(p_brand, p_partkey) AS agency FROM m GROUP BY name, bucket HAVING count(DISTINCT p_name) = 1)
, g AS (SELECT name, bucket, min(p_name) AS symbol, arg_min(t, p_partkey) AS title, arg_min(p_brand, p_partkey) AS agency FROM m WHERE NOT EXISTS (SELECT 1 FROM f WHERE f.name = m.name AND f.bucket = m.bucket) AND EXISTS (SELECT 1 FROM f WHERE f.bucket = m.bucket AND f.agency = m.p_brand) GROUP BY name, bucket HAVING count(DISTINCT p_name) = 1)
SELECT *, 1 AS pass FROM f UNION ALL SELECT *, 2 FROM g""")
def crosswalk_two_pass(spark, sf_dir):
    labels = ledger(spark, sf_dir).filter("account IS NOT NULL").select(F.col("line_item_text").alias("name"), F.col("subcommittee").alias("bucket"))
    return crosswalk.contained_twice(labels, _reference(spark, sf_dir))


@register("crosswalk_prefix", """
WITH k AS (SELECT DISTINCT lower(p_name) AS name, p_brand AS context FROM part)
, h AS (SELECT k.name, k.context, p_partkey, p_name, p_name || ' ' || p_type AS title, CASE WHEN p_brand = context THEN 2 ELSE 1 END AS o FROM k JOIN part ON lower(p_name || ' ' || p_type) = name OR starts_with(lower(p_name || ' ' || p_type), name || ' '))
, a AS (SELECT *, max(o) OVER (PARTITION BY name, context) AS most FROM h)
, b AS (SELECT name, context, CASE WHEN count(*) = 1 THEN 'exact' WHEN count(*) FILTER (o = most) = 1 THEN 'agency_scoped' ELSE 'ambiguous' END AS match, min(p_name) FILTER (o = most) AS code, min(title) FILTER (o = most) AS title FROM a GROUP BY name, context)
SELECT name, context, match, CASE WHEN match <> 'ambiguous' THEN code END AS code, CASE WHEN match <> 'ambiguous' THEN title END AS title FROM b""", on_ledger=False)
def crosswalk_prefix(spark, sf_dir):
    reference = _reference(spark, sf_dir).select("ref_ord", F.col("federal_account_symbol").alias("code"), F.col("account_title").alias("title"), "agency")
    labels = table(spark, sf_dir, "part").select(F.lower("p_name").alias("name"), F.col("p_brand").alias("context"))
    return crosswalk.match_accounts(labels, reference)


@register("inline_corroboration", """
, i AS (SELECT report_id, account AS label, committee_recommendation AS a, prior_year_enacted AS b FROM ledger WHERE NOT is_subtotal)
, m AS (SELECT l.report_id, l.row_ord, concat_ws(' ', l.account, l.line_item_text) AS x, i.label FROM ledger l JOIN i ON l.report_id = i.report_id WHERE NOT l.is_subtotal AND (l.prior_year_enacted IN (i.a, i.b) OR l.budget_estimate IN (i.a, i.b) OR l.committee_recommendation IN (i.a, i.b)))
SELECT DISTINCT report_id, row_ord FROM m WHERE len(list_intersect(list_filter(regexp_extract_all(lower(x), '[a-z]+'), lambda w: length(w) > 3), list_filter(regexp_extract_all(lower(label), '[a-z]+'), lambda w: length(w) > 3))) > 0""")  # fmt: skip
def inline_corroboration(spark, sf_dir):
    """Rows against the inline records of a report: every line item's account, with recommendation and prior year."""
    rows = kept(spark, sf_dir, "report_id", "row_ord", "is_subtotal", "account", "line_item_text", *LEVELS).filter("NOT is_subtotal")
    inline = rows.select("report_id", F.col("account").alias("label"), F.array("committee_recommendation", "prior_year_enacted").alias("amounts"))
    return crosswalk.corroborated(rows, inline)


@register("page_replace", """
, r AS (SELECT report_id, row_ord // 10 AS page, row_ord, line_item_text FROM ledger), n AS (SELECT DISTINCT report_id, page FROM r WHERE page % 4 = 1)
SELECT report_id, page, row_ord, line_item_text FROM r WHERE (report_id, page) NOT IN (SELECT (report_id, page) FROM n) UNION ALL SELECT report_id, page, row_ord, 'again ' || line_item_text FROM r WHERE page % 4 = 1""")  # fmt: skip
def page_replace(spark, sf_dir):
    rows = ledger(spark, sf_dir).select("report_id", F.expr("row_ord div 10").alias("page"), "row_ord", "line_item_text")
    again = rows.filter("page % 4 = 1").withColumn("line_item_text", F.concat(F.lit("again "), "line_item_text"))
    return crosswalk.replace_pages(rows, again)


# ---- scalar functions on what the tables hold, printed in every form ---------------------------------------------------

_AMOUNT_FORMS = """CASE l_orderkey % 12 WHEN 0 THEN '$' || n WHEN 1 THEN '       ' || n || ' ' WHEN 2 THEN '-' || n WHEN 3 THEN '+' || n WHEN 4 THEN '(' || n || ')' WHEN 5 THEN '(+' || n || ')' WHEN 6 THEN '(-' || n || ')' WHEN 7 THEN '---' WHEN 8 THEN '- - -' WHEN 9 THEN '..........' WHEN 10 THEN '' ELSE n END"""


@register("parse_dollar", f"""
WITH d AS (SELECT l_orderkey, l_linenumber, format('{{:,}}', CAST(l_partkey * 1000 + l_linenumber AS BIGINT)) AS n FROM lineitem)
, p AS (SELECT l_orderkey, l_linenumber, trim({_AMOUNT_FORMS}) AS t FROM d), m AS (SELECT *, regexp_extract(t, '(\\()?([+\\-])?\\$?([0-9,]+)(\\))?', 3) AS digits, regexp_extract(t, '(\\()?([+\\-])?\\$?([0-9,]+)(\\))?', 2) AS s, starts_with(t, '(') AS o FROM p)
SELECT l_orderkey, l_linenumber, TRY_CAST(nullif(replace(digits, ',', ''), '') AS BIGINT) * (CASE WHEN s = '-' THEN -1 ELSE 1 END) AS memo_value, TRY_CAST(nullif(replace(digits, ',', ''), '') AS BIGINT) * 1000 * (CASE WHEN s = '-' OR (s = '' AND o) THEN -1 ELSE 1 END) AS accounting_value,
 coalesce(o AND s <> '-' AND NOT contains(t, '-') AND TRY_CAST(nullif(replace(digits, ',', ''), '') AS BIGINT) > 0, false) AS is_memo FROM m""", on_ledger=False)  # fmt: skip
def parse_dollar(spark, sf_dir):
    """Numbers of line items as amounts in every printed form."""
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.format_number((F.col("l_partkey") * 1000 + F.col("l_linenumber")).cast("bigint"), 0).alias("n"))
    rows = rows.select("l_orderkey", "l_linenumber", F.expr(_AMOUNT_FORMS).alias("v"))
    a, b = fx.parse_dollar(F.col("v"), paren_negative=False), fx.parse_dollar(F.col("v"), True, paren_negative=True)
    return rows.select("l_orderkey", "l_linenumber", a["value"].alias("memo_value"), b["value"].alias("accounting_value"), fx.is_paren_memo(a).alias("is_memo"))


_PRINTED = "CASE p_partkey % 10 WHEN 0 THEN p_name || ' 1,250,000' WHEN 1 THEN p_name || ' (emergency)' WHEN 2 THEN p_name || ', Base' WHEN 3 THEN 'and ' || p_name WHEN 4 THEN upper(p_name) || ' [OCO]  450 000' WHEN 5 THEN 'Works)' WHEN 6 THEN upper(p_name) || ' built in 1907' WHEN 7 THEN upper(p_name) || ' (disaster relief), rescission of 3' WHEN 8 THEN upper(p_name) || ',' ELSE 'Operations of ' || p_name || ' $12' END"


@register("clean_labels", f"""
WITH d AS (SELECT p_partkey, {_PRINTED} AS v FROM part), s AS (SELECT p_partkey, v, trim(regexp_replace(v, '(\\s+\\$?[0-9]{{1,3}}([ ,][0-9]{{3}})*)+\\s*$', '')) AS k FROM d)
SELECT p_partkey, k AS stripped, trim(regexp_replace(regexp_replace(lower(regexp_replace(regexp_replace(k, '[(\\[][^)\\]]*[)\\]]', '', 'g'), ',\\s*(base|emergency|oco|disaster|rescission)\\b.*$', '', 'i')), '[^a-z0-9 ]', ' ', 'g'), '\\s+', ' ', 'g')) AS normalized,
 CASE WHEN contains(v, '[OCO]') THEN 'OCO' WHEN contains(v, '(emergency)') THEN 'emergency' WHEN contains(v, '(disaster relief)') THEN 'disaster' ELSE 'base' END AS designation,
 length(k) < 4 OR regexp_matches(k, '^[a-z]') OR length(replace(k, ')', '')) < length(replace(k, '(', '')) OR regexp_matches(k, '[,/-]$') OR regexp_matches(k, '(?i)^(and|or|the|of|operations|relief|appropriation)\\b') AS is_fragment FROM s""", on_ledger=False)
def clean_labels(spark, sf_dir):
    """Names of parts printed with leaked amounts, qualifiers, years and broken ends."""
    v = F.col("v")
    printed = table(spark, sf_dir, "part").select("p_partkey", F.expr(_PRINTED).alias("v"))
    return printed.select("p_partkey", fx.label_parts(v).alias("c")).select("p_partkey", "c.*")


_PHRASES = [(name, phrase) for name, phrases in fx.SUBCOMMITTEES.items() for phrase in phrases]
_PHRASE_SQL = "CASE c_custkey % " + str(len(_PHRASES) + 1) + " " + " ".join(f"WHEN {k} THEN '{p}'" for k, (_, p) in enumerate(_PHRASES)) + " ELSE 'a museum of clocks' END"
#: A phrase that holds another one is of the first subcommittee that has one of its phrases.
_FOUND = [next(n for n, phrases in fx.SUBCOMMITTEES.items() if any(q in p for q in phrases)) for _, p in _PHRASES]
_NAME_SQL = "CASE c_custkey % " + str(len(_PHRASES) + 1) + " " + " ".join(f"WHEN {k} THEN '{n}'" for k, n in enumerate(_FOUND)) + " END"
_TITLE_SQL = f"""CASE c_custkey % 5 WHEN 0 THEN 'A bill for ' || {_PHRASE_SQL} || ', AP- PROPRIATIONS Bill, ' || (2010 + c_nationkey) WHEN 1 THEN upper({_PHRASE_SQL}) || ' Act, ' || (2010 + c_nationkey) || ' of 1999' WHEN 2 THEN 'Conference report on ' || {_PHRASE_SQL} || ' appropriations, September 30, ' || (2010 + c_nationkey)
 WHEN 3 THEN 'Resolution for consideration of ' || {_PHRASE_SQL} || ' appropriation for fiscal year ' || (2010 + c_nationkey) ELSE 'Joint explanatory words on ' || {_PHRASE_SQL} END"""


@register("classify_titles", f"SELECT c_custkey, {_NAME_SQL} AS subcommittee, CASE WHEN c_custkey % 5 < 4 THEN CAST(2010 + c_nationkey AS INTEGER) END AS fiscal_year, CASE WHEN c_custkey % 5 IN (2, 4) THEN 'conference' ELSE 'committee' END AS stage, c_custkey % 5 IN (0, 2) OR (c_custkey % 5 IN (1, 4) AND contains({_PHRASE_SQL}, 'appropriation')) AS is_report FROM customer", on_ledger=False)
def classify_titles(spark, sf_dir):
    """A title for each customer, with every phrase of every subcommittee."""
    t = F.col("v")
    titles = table(spark, sf_dir, "customer").select("c_custkey", F.expr(_TITLE_SQL).alias("v"))
    return titles.select("c_custkey", fx.classify_subcommittee(t).alias("subcommittee"), fx.extract_fiscal_year(t).alias("fiscal_year"), fx.classify_stage(t).alias("stage"), fx.is_report_title(t).alias("is_report"))


@register("congress_years", "SELECT o_orderkey, CAST(114 + floor((year(o_orderdate) + o_orderkey % 30 - 2016) / 2.0) AS INTEGER) AS congress FROM orders", on_ledger=False)
def congress_years(spark, sf_dir):
    """The congress of each order's year, and of years around it."""
    return table(spark, sf_dir, "orders").select("o_orderkey", fx.congress_of_year(F.year("o_orderdate") + F.col("o_orderkey") % 30).alias("congress"))


@register("event_props", "SELECT event_type, count(*) AS n, count(*) FILTER (props IS NOT NULL AND json_valid(props)) AS valid FROM events GROUP BY event_type", on_ledger=False)
def event_props(spark, sf_dir):
    """JSON text parsed into a map; malformed text would be null."""
    return table(spark, sf_dir, "events").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.count(F.from_json("props", "map<string,string>")).alias("valid"))


@register("document_lines", "SELECT doc_id, len(string_split(text, chr(10))) AS n_lines, len(list_filter(string_split(text, chr(10)), lambda x: x <> '')) AS n_filled FROM documents", on_ledger=False)
def document_lines(spark, sf_dir):
    from ledgerloom.sources.ledger import lines_of

    return lines_of(table(spark, sf_dir, "documents"), "doc_id").groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_lines"), F.count_if(F.col("line") != "").alias("n_filled"))


from ledgerloom.plans import accounts, combined, exchange, extraction  # noqa: E402, F401
