"""The combined fact as one product: written, read back, and counted by the job that writes it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import text as fx
from ledgerloom.operators import fact
from ledgerloom.plans.accounts import _CASCADE, _reference
from ledgerloom.plans.base import register
from ledgerloom.schema import AMOUNTS, CPI, FACT, REAL_BASE
from ledgerloom.sources import ledger as sources
from ledgerloom.sources.ledger import ledger_by_report, table
from ledgerloom.sources.workspace import new_folder


def _amount(value, raw, n):
    return F.when(value.isNotNull(), F.struct(value.cast("bigint").alias("value"), raw.alias("raw_text"), (n % 2 == 0).alias("in_thousands")))


def _lines(spark, sf_dir) -> DataFrame:
    """The ledger as extracted lines in which every outcome occurs: fragments as accounts, inferred accounts, memos in parentheses, rows without amounts, designations, split and quantity tables."""
    rows, n = ledger_by_report(spark, sf_dir), F.col("pk")
    item = ~F.col("is_subtotal")
    split, bare = item & (n % 47 == 3), item & (n % 41 == 7)
    pe, be, cr, de, dt = (F.when(~bare, F.col(c)) for c in AMOUNTS)
    value = dict(zip(AMOUNTS, (pe, be, F.when(split, pe + be).otherwise(cr), F.when(split, pe).otherwise(de), F.when(split, be).otherwise(dt)), strict=True))
    raw = F.when(item & (n % 29 == 1), F.lit("(1,234)")).otherwise(F.lit("1,234"))
    label = F.when(~item, F.col("line_item_text")).when(n % 43 == 9, "29").otherwise(F.concat(F.initcap("line_item_text"), F.when(n % 37 == 5, " (emergency)").otherwise("")))
    verified = item & (n % 4 == 1)
    return rows.select(
        "report_id", "row_ord", fx.congress_of_year(F.col("fiscal_year") + 22).alias("congress"), "chamber", (F.col("fiscal_year") + 22).cast("int").alias("fiscal_year"), "subcommittee", "stage",
        F.concat(F.lit("TITLE "), (n % 4).cast("string")).alias("title_name"), F.when(n % 5 < 2, "Alpha bureau").otherwise("Beta bureau").alias("department"), F.lit(None).cast("string").alias("agency"),
        F.when(n % 2 == 0, "operations)").alias("account"), F.when(item & (n % 3 == 0), F.initcap(F.concat_ws(" ", "line_item_text", "account"))).alias("account_inferred"), (F.col("is_memo") & (n % 2 == 0)).alias("is_memo"),
        F.when(n % 6 == 0, "Surveys").alias("program"), label.alias("line_item_text"), *[_amount(v, raw, n).alias(c) for c, v in value.items()], "is_subtotal", (n % 4).cast("int").alias("hierarchy_depth"), (n % 2 == 0).alias("in_thousands"),
        F.when(n % 2 == 0, "llm").otherwise("text").alias("extraction_method"), verified.alias("verified"), fx.gate_of(verified, F.col("stage"), F.col("chamber"), F.when(n % 2 == 0, "llm").otherwise("text")).alias("verification_method"),
    )


def _inline(lines: DataFrame) -> DataFrame:
    """Each label of a report with its largest recommendation, as the report's prose would restate it."""
    own = lines.filter("NOT is_subtotal").groupBy("report_id", "line_item_text").agg(F.max("committee_recommendation").alias("v"))
    return own.select("report_id", F.col("line_item_text").alias("label"), F.array("v").alias("amounts"))


def _accounts(spark, sf_dir) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return p.select(F.col("p_partkey").alias("ref_ord"), F.col("p_name").alias("federal_account_symbol"), F.concat_ws(" ", "p_name", "p_type").alias("account_title"), F.col("p_brand").alias("agency"), F.concat(F.lit("Bureau "), "p_type").alias("bureau"))


def _fact(spark, sf_dir) -> DataFrame:
    lines = _lines(spark, sf_dir)
    return fact.combined(lines, _inline, _reference(spark, sf_dir), _accounts(spark, sf_dir), sources.deflators(spark))


_FACTORS = ", ".join(f"({y}, {v})" for y, v in CPI.items())

#: The cascade's SQL takes its candidates and contexts from these lines: names without designation, and the first of two bureaus in the context.
_FACT_SQL = _CASCADE.replace("lower(line_item_text) FROM ledger WHERE NOT is_subtotal)", "lower(line_item_text) FROM ledger WHERE NOT is_subtotal AND pk % 43 <> 9)") + r"""
, lines AS (SELECT *, fiscal_year + 22 AS fy, NOT is_subtotal AND pk % 41 = 7 AS bare, NOT is_subtotal AND pk % 47 = 3 AS split,
  CASE WHEN is_subtotal THEN line_item_text WHEN pk % 43 = 9 THEN '29' ELSE upper(string_split(line_item_text, ' ')[1])[1] || lower(string_split(line_item_text, ' ')[1])[2:] || CASE WHEN contains(line_item_text, ' ') THEN ' ' || upper(string_split(line_item_text, ' ')[2])[1] || lower(string_split(line_item_text, ' ')[2])[2:] ELSE '' END || CASE WHEN pk % 37 = 5 THEN ' (emergency)' ELSE '' END END AS label,
  CASE WHEN NOT is_subtotal AND pk % 3 = 0 THEN array_to_string(list_transform(string_split(line_item_text || ' ' || account, ' '), lambda w: upper(w[1]) || lower(w[2:])), ' ') END AS inferred,
  NOT is_subtotal AND pk % 4 = 1 AS checked FROM ledger)
, v AS (SELECT *, CASE WHEN NOT bare THEN prior_year_enacted END AS pe, CASE WHEN NOT bare THEN budget_estimate END AS be, CASE WHEN bare THEN NULL WHEN split THEN prior_year_enacted + budget_estimate ELSE committee_recommendation END AS cr,
  CASE WHEN bare THEN NULL WHEN split THEN prior_year_enacted ELSE delta_vs_enacted END AS de, CASE WHEN bare THEN NULL WHEN split THEN budget_estimate ELSE delta_vs_estimate END AS dt FROM lines)
, k AS (SELECT v.*, b.match AS match1, CASE WHEN b.match <> 'ambiguous' THEN b.code END AS key1, CASE WHEN b.match <> 'ambiguous' THEN b.title END AS title1 FROM v LEFT JOIN best b ON b.report_id = v.report_id AND b.row_ord = v.row_ord AND b.k = 1)
, stop AS (SELECT unnest(['the','of','and','for','to','a','an','in','on','at','by','salaries','expenses','account','accounts','fund','funds','revolving','appropriation','appropriations']) AS w)
, tw AS (SELECT DISTINCT p_partkey, p_name, p_brand, t, 'Bureau ' || p_type AS bureau, w FROM (SELECT *, p_name || ' ' || p_type AS t, unnest(regexp_extract_all(lower(p_name || ' ' || p_type), '[a-z0-9]+')) AS w FROM part) WHERE length(w) > 2 AND w NOT IN (SELECT w FROM stop))
, lab AS (SELECT DISTINCT coalesce(inferred, label) AS name, subcommittee AS bucket FROM k WHERE NOT is_subtotal AND key1 IS NULL AND coalesce(pe, be, cr, de, dt) IS NOT NULL)
, lw AS (SELECT name, bucket, w, count(*) OVER (PARTITION BY name, bucket) AS n FROM (SELECT DISTINCT name, bucket, unnest(regexp_extract_all(lower(name), '[a-z0-9]+')) AS w FROM lab) WHERE length(w) > 2 AND w NOT IN (SELECT w FROM stop))
, mm AS (SELECT name, bucket, p_partkey, p_name, p_brand, t, bureau FROM lw JOIN tw USING (w) WHERE n >= 2 GROUP BY name, bucket, n, p_partkey, p_name, p_brand, t, bureau HAVING count(*) = n)
, one AS (SELECT name, bucket, min(p_name) AS symbol, arg_min(t, p_partkey) AS title, arg_min(p_brand, p_partkey) AS agency, arg_min(bureau, p_partkey) AS bureau, 'tango' AS how FROM mm GROUP BY name, bucket HAVING count(DISTINCT p_name) = 1)
, two AS (SELECT name, bucket, min(p_name) AS symbol, arg_min(t, p_partkey) AS title, arg_min(p_brand, p_partkey) AS agency, arg_min(bureau, p_partkey) AS bureau, 'tango_scoped' AS how FROM mm WHERE NOT EXISTS (SELECT 1 FROM one WHERE one.name = mm.name AND one.bucket = mm.bucket) AND EXISTS (SELECT 1 FROM one WHERE one.bucket = mm.bucket AND one.agency = mm.p_brand) GROUP BY name, bucket HAVING count(DISTINCT p_name) = 1)
, fed AS (SELECT * FROM one UNION ALL SELECT * FROM two)
, top AS (SELECT report_id, label, max(cr) AS most FROM v WHERE NOT is_subtotal GROUP BY ALL)
, word AS (SELECT report_id, most, unnest(list_distinct(list_filter(regexp_extract_all(lower(label), '[a-z]+'), lambda w: length(w) > 3))) AS w FROM top WHERE most IS NOT NULL)
, own AS (SELECT report_id, row_ord, pe, be, cr, unnest(list_distinct(list_filter(regexp_extract_all(lower(label || ' ' || coalesce(inferred, '')), '[a-z]+'), lambda w: length(w) > 3))) AS w FROM v)
, said AS (SELECT DISTINCT own.report_id, own.row_ord FROM own JOIN word ON own.report_id = word.report_id AND own.w = word.w AND most IN (pe, be, cr))
, f AS (SELECT k.report_id, CAST(114 + floor((fy - 2016) / 2) AS INTEGER) AS congress, chamber, CAST(fy AS INTEGER) AS fiscal_year, subcommittee, stage, 'TITLE ' || (pk % 4) AS title_name, CASE WHEN pk % 5 < 2 THEN 'Alpha bureau' ELSE 'Beta bureau' END AS department, CAST(NULL AS VARCHAR) AS agency,
  CASE WHEN pk % 2 = 0 THEN 'operations)' END AS account, inferred AS account_inferred, (is_memo AND pk % 2 = 0) OR (NOT is_subtotal AND pk % 29 = 1 AND cr IS NOT NULL) AS is_memo, CASE WHEN pk % 6 = 0 THEN 'Surveys' END AS program, label AS line_item_text,
  pe AS prior_year_enacted, be AS budget_estimate, cr AS committee_recommendation, de AS delta_vs_enacted, dt AS delta_vs_estimate, is_subtotal, CAST(pk % 4 AS INTEGER) AS hierarchy_depth, pk % 2 = 0 AS in_thousands, CASE WHEN pk % 2 = 0 THEN 'llm' ELSE 'text' END AS extraction_method, checked AS verified,
  CASE WHEN NOT checked THEN 'none' WHEN stage = 'enacted' THEN 'verbatim_page' WHEN chamber = 'senate' THEN 'string_match' WHEN pk % 2 = 0 THEN 'delta_arithmetic' ELSE 'verbatim_page' END AS verification_method,
  CASE WHEN label = '29' THEN 'procurement_qty' WHEN split AND NOT bare AND pe <> 0 AND be <> 0 THEN 'category_split' ELSE 'standard' END AS column_layout,
  coalesce(fed.symbol, key1) AS account_key, coalesce(fed.title, title1) AS account_key_title, coalesce(how, match1) AS account_match, fed.agency AS account_key_agency, fed.bureau AS account_key_bureau,
  CASE WHEN pk % 2 = 1 AND inferred IS NULL AND contains(label, '(emergency)') THEN 'emergency' ELSE 'base' END AS designation, CAST(round_even(%BASE% / cpi, 4) AS DOUBLE) AS real_factor_2024,
  said.row_ord IS NOT NULL AS restated, coalesce(pe, be, cr, de, dt) IS NOT NULL AS has
  FROM k LEFT JOIN fed ON NOT is_subtotal AND key1 IS NULL AND coalesce(pe, be, cr, de, dt) IS NOT NULL AND fed.name = coalesce(inferred, label) AND fed.bucket = subcommittee
  LEFT JOIN said ON said.report_id = k.report_id AND said.row_ord = k.row_ord LEFT JOIN (VALUES %FACTORS%) AS c(y, cpi) ON c.y = fy)
, g AS (SELECT * EXCLUDE (restated, has), CASE WHEN verified THEN verification_method WHEN NOT has THEN 'none' WHEN account_inferred IS NOT NULL THEN 'block' WHEN restated THEN 'inline' ELSE 'none' END AS verification_tier FROM f)
""".replace("%BASE%", str(CPI[REAL_BASE])).replace("%FACTORS%", _FACTORS)


@register("combined_fact", _FACT_SQL + " SELECT * FROM g")
def combined_fact(spark, sf_dir):
    """All columns, as they are read back from the file."""
    path = new_folder(spark, "fact")
    fact.write_fact(_fact(spark, sf_dir), path)
    return sources.csv_fact(spark, path, fact.WHOLE, fact.FLAGS, ("real_factor_2024",)).select(*FACT)


@register("combined_fact_counts", _FACT_SQL + """ SELECT count(*) AS n_rows, count(*) FILTER (NOT is_subtotal) AS line_items, count(*) FILTER (is_subtotal) AS totals, count(*) FILTER (coalesce(prior_year_enacted, budget_estimate, committee_recommendation) IS NOT NULL) AS with_amount,
 count(account_key) AS keyed, count(*) FILTER (verified) AS verified, count(*) FILTER (is_memo) AS memos, count(*) FILTER (verification_tier = 'none') AS untiered FROM g""")
def combined_fact_counts(spark, sf_dir):
    """The counts that the writing job takes of what it writes."""
    counts = fact.write_fact(_fact(spark, sf_dir), new_folder(spark, "fact"))
    return spark.createDataFrame([tuple(counts.values())], ", ".join(f"{k} bigint" for k in counts))
