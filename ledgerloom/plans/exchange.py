"""Queries of sources and sinks: tables are written to the shared folder, and what is read back must be what was written."""

from __future__ import annotations

import io
import zipfile

import pandas as pd
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerloom.operators import crosswalk, extract, query, reconcile, verify
from ledgerloom.plans.accounts import _PACKAGES, _reference, packages
from ledgerloom.plans.base import amounts, register
from ledgerloom.plans.extraction import _inline, _typeset
from ledgerloom.plans.registry import _VERDICTS, _statement
from ledgerloom.sinks import versions, writers
from ledgerloom.sources import ledger as sources
from ledgerloom.sources.catalog_api import CatalogSource
from ledgerloom.sources.ledger import ledger, ledger_by_report, table
from ledgerloom.sources.workspace import made_once, new_folder, stored

# ---- catalogs -----------------------------------------------------------------------------------------------------------


@register("catalog_pages", _PACKAGES + " SELECT package_id, title, doc_class, CAST(114 + s_suppkey % 5 AS VARCHAR) AS congress FROM s", on_ledger=False)
def catalog_pages(spark, sf_dir):
    """The paged source over a stored listing of packages, seven a page; a congress without packages has none."""
    path = new_folder(spark, "listing")
    found = packages(spark, sf_dir).withColumn("congress", F.expr("114 + cast(regexp_extract(package_id, '(\\\\d+)$', 1) as int) % 5"))
    found.repartition("congress").sortWithinPartitions("congress", "package_id").write.partitionBy("congress").json(path)
    spark.dataSource.register(CatalogSource)
    uri = path if "://" in path or path.startswith("file:") else f"file://{path}"
    read = spark.read.format("ledgerloom_catalog").option("transport", "ledgerloom.sources.catalog_api:stored_listing").option("source", uri)
    return read.option("congresses", "113,114,115,116,117,118").option("page_size", "7").option("wait", "0.01").load().drop("date_issued")


_PRINTS = "(VALUES " + ", ".join(f"('{k}', {y})" for k, y in sources.STATEMENT_PRINTS.items()) + ") AS e(package_id, fiscal_year)"


@register("enacted_registry", f"""
, y AS (SELECT fiscal_year + 22 AS fiscal_year, count(*) FILTER (stage = 'enacted') AS enacted_rows FROM ledger GROUP BY 1)
SELECT package_id, CAST(regexp_extract(package_id, '^CPRT-([0-9]+)', 1) AS INTEGER) AS congress, CAST(regexp_extract(package_id, 'HPRT([0-9]+)$', 1) AS INTEGER) AS report_number, e.fiscal_year, 'enacted' AS stage, enacted_rows
FROM {_PRINTS} JOIN y ON y.fiscal_year = e.fiscal_year WHERE CAST(regexp_extract(package_id, '^CPRT-([0-9]+)', 1) AS INTEGER) BETWEEN 115 AND 117""")  # fmt: skip
def enacted_registry(spark, sf_dir):
    """The prints of three congresses whose years the ledger has, with its enacted rows of the year."""
    years = ledger(spark, sf_dir).groupBy((F.col("fiscal_year") + 22).alias("fiscal_year")).agg(F.count_if(F.col("stage") == "enacted").alias("enacted_rows"))
    return sources.enacted_prints(spark, 115, 117).join(years, "fiscal_year").select("package_id", "congress", "report_number", "fiscal_year", "stage", "enacted_rows")


@register("catalog_round_trip", _PACKAGES + " SELECT stage, count(*) AS reports, count(subcommittee) AS named FROM (SELECT stage, subcommittee FROM c UNION ALL SELECT 'enacted', NULL FROM range(16)) GROUP BY stage", on_ledger=False)
def catalog_round_trip(spark, sf_dir):
    """Discovered reports and enacted prints, written as JSON and loaded; a catalog that isn't there has no rows."""
    path = new_folder(spark, "catalog")
    found = sources.catalog(packages(spark, sf_dir)).unionByName(sources.enacted_prints(spark))
    writers.write_json(found, path)
    loaded = sources.load_catalog(spark, path).unionByName(sources.load_catalog(spark, path + "-none"))
    return loaded.groupBy("stage").agg(F.count(F.lit(1)).alias("reports"), F.count("subcommittee").alias("named"))


# ---- files --------------------------------------------------------------------------------------------------------------


@register("cached_files", """
SELECT 's' || s_suppkey AS report_id, CASE WHEN s_suppkey % 2 = 0 THEN 'house' ELSE 'senate' END AS chamber, sha256(s_name || chr(10)) AS sha256, length(s_name) + 1 AS length, s_suppkey % 4 <> 1 AS intact FROM supplier""", on_ledger=False)  # fmt: skip
def cached_files(spark, sf_dir):
    """Stored texts with their digests, against those noted when they were stored: some are other ones, some are missing."""
    path = new_folder(spark, "raw")
    s = table(spark, sf_dir, "supplier").select(F.concat(F.lit("s"), "s_suppkey").alias("report_id"), F.when(F.col("s_suppkey") % 2 == 0, "house").otherwise("senate").alias("chamber"), F.lit(118).alias("congress"), "s_name", "s_suppkey")
    writers.write_packs(s.withColumn("content", F.encode(F.concat("s_name", F.lit("\n")), "UTF-8")), path, "txt")
    noted = s.filter("s_suppkey % 4 <> 2").select("report_id", F.when(F.col("s_suppkey") % 4 == 1, "another").otherwise(F.sha2(F.concat("s_name", F.lit("\n")), 256)).alias("noted"))
    return sources.verified_files(sources.cached_files(spark, path, "txt"), noted).select("report_id", "chamber", "sha256", F.col("length").cast("int").alias("length"), "intact")


def _split_pages(frames):
    """A reader for texts whose pages end in form feeds."""
    for frame in frames:
        rows = [(r, k, t) for r, c in zip(frame["report_id"], frame["content"], strict=True) for k, t in enumerate(c.decode("utf-8").split("\f"), 1)]
        yield pd.DataFrame(rows, columns=["report_id", "page", "text"])


@register("page_text_lines", "SELECT CAST(doc_id AS VARCHAR) AS report_id, len(string_split(text, '. ')) AS pages, len(string_split(text, '. ')) + len(text) - len(replace(text, chr(10), '')) AS n_lines FROM documents WHERE text IS NOT NULL", on_ledger=False)
def page_text_lines(spark, sf_dir):
    """Paged files through an injected reader; here a page is a sentence."""
    d = table(spark, sf_dir, "documents").filter("text IS NOT NULL")
    files = d.select(F.col("doc_id").cast("string").alias("report_id"), F.encode(F.replace("text", F.lit(". "), F.lit("\f")), "UTF-8").alias("content"))
    return sources.page_lines(files, _split_pages).groupBy("report_id").agg(F.max("page").alias("pages"), F.count(F.lit(1)).alias("n_lines"))


@register("text_files", "SELECT CAST(n_nationkey AS VARCHAR) AS nation, 2 AS n_lines, n_name AS first_line FROM nation", on_ledger=False)
def text_files(spark, sf_dir):
    """Whole text files and their lines."""
    path = new_folder(spark, "texts")
    n = table(spark, sf_dir, "nation")
    n.select(F.col("n_nationkey").cast("string").alias("nation"), "n_name").write.partitionBy("nation").text(path)
    docs = sources.documents_of(spark, f"{path}/*").withColumn("report_id", F.regexp_extract(F.input_file_name(), r"nation=(\d+)", 1))
    lines = sources.lines_of(docs)
    return lines.groupBy(F.col("report_id").alias("nation")).agg(F.count(F.lit(1)).cast("int").alias("n_lines"), F.max(F.when(F.col("row_ord") == 0, F.col("line"))).alias("first_line"))


@register("extracted_tree", ", r AS (SELECT chamber, report_id, count(*) AS n_rows, CAST(sum(committee_recommendation) AS BIGINT) AS amount FROM ledger GROUP BY ALL) SELECT * FROM r")
def extracted_tree(spark, sf_dir):
    """A tree of reports as JSON, a number of reports a file, with intermediate files beside them that don't count."""
    path = new_folder(spark, "extracted")
    docs = ledger(spark, sf_dir).groupBy("chamber", "report_id").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("committee_recommendation").alias("amount"))
    writers.write_report_files(docs, f"{path}/done", "chamber", "report_id")
    for end in ("_nemotron", "_hybrid"):
        writers.write_report_files(docs.withColumn("amount", F.lit(-1).cast("bigint")), f"{path}/pass{end}", "chamber", "report_id", end=end)
    rows = sources.extracted_json(spark, path, "reports array<struct<chamber:string,report_id:string,n_rows:bigint,amount:bigint>>")
    return rows.select(F.explode("reports").alias("r")).select("r.*")


@register("reports_as_json", "SELECT chamber, report_id, count(*) AS n_rows, CAST(sum(committee_recommendation) AS BIGINT) AS amount FROM ledger GROUP BY ALL")
def reports_as_json(spark, sf_dir):
    """One folder of JSON rows for each chamber and report group."""
    path = new_folder(spark, "reports")
    writers.write_json(ledger(spark, sf_dir).select("chamber", "report_id", "row_ord", "committee_recommendation"), path, "chamber")
    back = spark.read.schema("report_id string, row_ord int, committee_recommendation bigint, chamber string").json(path)
    return back.groupBy("chamber", "report_id").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("committee_recommendation").alias("amount"))


@register("nested_json", "SELECT report_id, count(*) AS n_rows, max(line_item_text) AS last_label FROM ledger GROUP BY 1")
def nested_json(spark, sf_dir):
    texts = writers.nested_json(ledger(spark, sf_dir).select("report_id", "row_ord", "line_item_text"), "report_id")
    rows = texts.select("report_id", F.explode(F.from_json("json", "rows array<struct<row_ord:int,line_item_text:string>>")["rows"]).alias("r"))
    return rows.groupBy("report_id").agg(F.count(F.lit(1)).alias("n_rows"), F.max("r.line_item_text").alias("last_label"))


# ---- facts --------------------------------------------------------------------------------------------------------------


def _released(spark, sf_dir) -> str:
    path = new_folder(spark, "release")
    writers.write_release(ledger(spark, sf_dir).select("report_id", "row_ord", "chamber", "stage", "fiscal_year", "account", "is_subtotal", "committee_recommendation"), path, "fact")
    return path


@register("csv_fact", "SELECT report_id, row_ord, fiscal_year, account, is_subtotal, committee_recommendation FROM ledger")
def csv_fact(spark, sf_dir):
    path = _released(spark, sf_dir)
    return sources.csv_fact(spark, f"{path}/fact.csv", ("row_ord", "fiscal_year", "committee_recommendation"), ("is_subtotal",)).select("report_id", "row_ord", "fiscal_year", "account", "is_subtotal", "committee_recommendation")


@register("release_tracks", ", t AS (SELECT CASE WHEN stage = 'enacted' THEN 'enacted' ELSE chamber END AS track, CAST(sum(committee_recommendation) AS BIGINT) AS amount, count(*) AS n_rows FROM ledger GROUP BY 1) SELECT 'csv' AS form, * FROM t UNION ALL SELECT 'parquet', * FROM t")
def release_tracks(spark, sf_dir):
    """Both copies of a release, only the columns that are asked for."""
    path = _released(spark, sf_dir)
    columns = ["stage", "chamber", "committee_recommendation"]
    rows = sources.release(spark, f"{path}/fact.csv", columns, ("committee_recommendation",)).withColumn("form", F.lit("csv")).unionByName(sources.release(spark, f"{path}/fact.parquet", columns).withColumn("form", F.lit("parquet")))
    return rows.groupBy("form", "track").agg(F.sum("committee_recommendation").alias("amount"), F.count(F.lit(1)).alias("n_rows"))


@register("release_manifest", "SELECT DISTINCT fiscal_year, CASE WHEN fiscal_year IN (1995, 1996) THEN 'altered' WHEN fiscal_year = 1997 THEN 'missing' ELSE 'intact' END AS state FROM ledger UNION ALL SELECT 1997, 'unlisted'")
def release_manifest(spark, sf_dir):
    """The checksums of a release after two files have changed places and one has another name; large files are hashed in pieces, which here are those over 10 kB."""
    path = new_folder(spark, "release")
    rows = ledger(spark, sf_dir).select("report_id", "row_ord", "committee_recommendation", "fiscal_year")
    rows.repartition("fiscal_year").write.partitionBy("fiscal_year").option("header", True).csv(path)
    writers.write_sums(spark, path, whole=10_000)
    jvm = spark._jvm.org.apache.hadoop.fs
    fs = jvm.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    a, b, c = (fs.globStatus(jvm.Path(f"{path}/fiscal_year={y}/part-*"))[0].getPath() for y in (1995, 1996, 1997))
    aside = jvm.Path(f"{path}/aside")
    for x, y in ((a, aside), (b, a), (aside, b), (c, c.suffix("-again"))):
        fs.rename(x, y)
    found = writers.checked_sums(spark, path, whole=10_000)
    return found.select(F.regexp_extract("file", r"fiscal_year=(\d+)", 1).cast("int").alias("fiscal_year"), "state")


@register("release_in_order", """
, o AS (SELECT report_id, row_ord, row_number() OVER (ORDER BY report_id, row_ord) - 1 AS place, CASE WHEN stage = 'enacted' THEN 'enacted' ELSE chamber END AS track FROM ledger)
SELECT 'csv' AS form, * FROM o UNION ALL SELECT 'parquet', * FROM o""")  # fmt: skip
def release_in_order(spark, sf_dir):
    """Both copies of a release of many files, each row with its place in document order."""
    path = new_folder(spark, "ordered")
    rows = ledger(spark, sf_dir).select("report_id", "row_ord", "chamber", "stage").orderBy("report_id", "row_ord")
    rows.write.option("header", True).option("maxRecordsPerFile", 5000).csv(f"{path}/fact.csv")
    rows.write.option("maxRecordsPerFile", 5000).parquet(f"{path}/fact.parquet")
    columns = ["report_id", "row_ord", "stage", "chamber"]
    csv = sources.release(spark, f"{path}/fact.csv", columns, ("row_ord",), place="place").withColumn("form", F.lit("csv"))
    both = csv.unionByName(sources.release(spark, f"{path}/fact.parquet", columns, place="place").withColumn("row_ord", F.col("row_ord").cast("bigint")).withColumn("form", F.lit("parquet")))
    return both.select("form", "report_id", "row_ord", "place", "track")


@register("inline_csv", "SELECT report_id, subcommittee || ' OFFICE' AS heading, prior_year_enacted AS prior_year, committee_recommendation FROM ledger WHERE is_subtotal")
def inline_csv(spark, sf_dir):
    path = new_folder(spark, "inline")
    found = extract.inline_tables(_inline(spark, sf_dir))
    writers.write_csv(found.select("report_id", "line_number", "heading", F.col("prior_year")["value"].alias("prior_year"), F.col("committee_recommendation")["value"].alias("committee_recommendation")), path)
    return sources.csv_fact(spark, path, ("line_number", "prior_year", "committee_recommendation")).select("report_id", "heading", "prior_year", "committee_recommendation")


@register("crosswalk_queue", "SELECT lower(p_name) AS name, 'ambiguous' AS match FROM part GROUP BY p_name HAVING count(DISTINCT p_type) > 1", on_ledger=False)
def crosswalk_queue(spark, sf_dir):
    """Names without a sure match, written for review in order of context and name, and read back."""
    path = new_folder(spark, "crosswalk")
    names = table(spark, sf_dir, "part").select(F.lower("p_name").alias("name"), F.lit("").alias("context")).distinct()
    writers.write_csv(writers.crosswalk_queue(crosswalk.match_accounts(names, _reference(spark, sf_dir).withColumn("agency", F.lit(None).cast("string")))), path)
    return sources.csv_fact(spark, path, ()).select("name", "match")


@register("metrics_log", "SELECT chamber, 2 * count(*) AS n_rows FROM ledger GROUP BY 1")
def metrics_log(spark, sf_dir):
    """Two appends to a log of metrics."""
    path = new_folder(spark, "metrics")
    row = ledger(spark, sf_dir).groupBy("chamber").agg(F.count(F.lit(1)).alias("n_rows"))
    for _ in range(2):
        writers.append_metrics(row, path)
    return sources.csv_fact(spark, path, ("n_rows",)).groupBy("chamber").agg(F.sum("n_rows").alias("n_rows"))


_FIXES = """
, b AS (SELECT report_id, row_ord, prior_year_enacted AS pe, budget_estimate AS be, CASE WHEN NOT is_subtotal AND row_ord % 19 = 3 THEN NULL WHEN NOT is_subtotal AND row_ord % 23 = 5 THEN committee_recommendation + 100 ELSE committee_recommendation END AS cr, delta_vs_enacted AS de, delta_vs_estimate AS dt FROM ledger)"""


def _spoilt(spark, sf_dir):
    n = F.col("row_ord")
    cr = F.when(~F.col("is_subtotal") & (n % 19 == 3), None).when(~F.col("is_subtotal") & (n % 23 == 5), F.col("committee_recommendation") + 100).otherwise(F.col("committee_recommendation"))
    return ledger(spark, sf_dir).withColumn("committee_recommendation", cr)


@register("write_back", _FIXES + " SELECT report_id, row_ord FROM b WHERE pe + de = be + dt AND pe + de IS DISTINCT FROM cr")
def write_back(spark, sf_dir):
    """Repaired rows go into a new version of the table; the rows that changed are returned, read from the versions."""
    one, two = new_folder(spark, "version"), new_folder(spark, "version")
    _spoilt(spark, sf_dir).write.parquet(one)
    before = spark.read.parquet(one)
    writers.write_back(before, verify.verify(before), ["report_id", "row_ord"], ["committee_recommendation"], two)
    return writers.changed_rows(before, spark.read.parquet(two), ["report_id", "row_ord"], ["committee_recommendation"])


@register("write_back_versions", _FIXES + """
, y AS (SELECT report_id, row_ord, fiscal_year FROM ledger)
, c AS (SELECT fiscal_year, count(*) FILTER (fiscal_year % 3 = 0 AND pe + de = be + dt AND pe + de IS DISTINCT FROM cr) AS n_changed, count(*) AS n_rows FROM b JOIN y USING (report_id, row_ord) GROUP BY 1)
SELECT fiscal_year, CASE WHEN n_changed > 0 THEN 2 ELSE 1 END AS written_in, n_changed, n_rows, 'refused' AS second_writer FROM c""")
def write_back_versions(spark, sf_dir):
    """Repairs of some years as a second version: the years' files that stay, the rows that changed, and a second writer who had read the first version."""
    path, keys = new_folder(spark, "versions"), ["report_id", "row_ord"]
    versions.create(_spoilt(spark, sf_dir), path, "fiscal_year")
    before = versions.read(spark, path, "fiscal_year", 1)
    fixed = verify.verify(before.withColumn("_read", F.col("committee_recommendation")))  # row by row, so what was read stays beside it
    after = fixed.withColumn("committee_recommendation", F.when(F.col("fiscal_year") % 3 == 0, F.col("committee_recommendation")).otherwise(F.col("_read"))).select(before.columns)
    versions.change(after, path, "fiscal_year", keys, ["committee_recommendation"], base=1)
    try:
        versions.change(after, path, "fiscal_year", keys, ["committee_recommendation"], base=1)
        second = "written"
    except versions.Refused:
        second = "refused"
    now = versions.read(spark, path, "fiscal_year", with_version=True)
    differ = writers.changed_rows(before, now, keys, ["committee_recommendation"]).withColumn("_differs", F.lit(1))
    counts = now.join(differ, keys, "left").groupBy("fiscal_year").agg(F.max("written_in").cast("int").alias("written_in"), F.count("_differs").alias("n_changed"), F.count(F.lit(1)).alias("n_rows"))
    return counts.withColumn("second_writer", F.lit(second))


@register("typeset_deliverables", """
, x AS (SELECT report_id, count(DISTINCT blk) AS accounts FROM ledger WHERE NOT is_subtotal GROUP BY 1)
SELECT x.report_id, accounts, (SELECT count(*) FROM ledger l WHERE l.report_id = x.report_id AND NOT l.is_subtotal) + accounts AS n_rows, accounts AS n_marks FROM x""")  # fmt: skip
def typeset_deliverables(spark, sf_dir):
    """Accounts with nested rows and marks, written as JSON and read back: every account has one closing total and one mark."""
    path = new_folder(spark, "typeset")
    nested, _, _ = writers.typeset_deliverables(extract.typeset_statement(_typeset(spark, sf_dir)))
    writers.write_json(nested, path, compression="gzip")
    back = spark.read.schema("report_id string, account_no bigint, rows array<struct<label:string,marks:array<struct<label:string,amount:bigint>>>>").json(path)
    marks = F.aggregate("rows", F.lit(0), lambda n, r: n + F.size(r["marks"]))
    return back.groupBy("report_id").agg(F.count(F.lit(1)).alias("accounts"), F.sum(F.size("rows")).alias("n_rows"), F.sum(marks).alias("n_marks"))


@register("extraction_meta", """
, s AS (SELECT chamber, blk, is_subtotal, CASE WHEN (committee_recommendation - prior_year_enacted = delta_vs_enacted) IS NULL AND (committee_recommendation - budget_estimate = delta_vs_estimate) IS NULL THEN 'unverifiable' WHEN coalesce(committee_recommendation - prior_year_enacted = delta_vs_enacted, true) AND coalesce(committee_recommendation - budget_estimate = delta_vs_estimate, true) THEN 'pass' ELSE 'fail' END AS status FROM ledger)
SELECT chamber, count(DISTINCT blk) AS pages, count(*) AS n_rows, count(*) FILTER (NOT is_subtotal) AS items, count(*) FILTER (is_subtotal) AS totals, count(*) FILTER (status = 'pass') AS passed, count(*) FILTER (status = 'fail') AS failed, round(count(*) FILTER (status = 'pass') / CAST(nullif(count(*) FILTER (status <> 'unverifiable'), 0) AS DOUBLE), 6) AS pass_rate FROM s GROUP BY chamber""")  # fmt: skip
def extraction_meta(spark, sf_dir):
    rows = ledger(spark, sf_dir).withColumn("status", verify.row_status(*amounts())).withColumn("page", F.col("blk"))
    return writers.extraction_meta(rows, "chamber")


# ---- dimensions and first passes ------------------------------------------------------------------------------------------


@register("account_dimension", "SELECT DISTINCT p_brand AS federal_account_symbol, p_type AS account_title FROM part", on_ledger=False)
def account_dimension(spark, sf_dir):
    raw = table(spark, sf_dir, "part").select(F.col("p_brand").alias("federal_account_symbol"), F.explode(F.array("p_type", F.lit(None))).alias("account_title"), F.lit("a").alias("agency"), F.lit(None).cast("string").alias("bureau"))
    return sources.account_dimension(raw).select("federal_account_symbol", "account_title")


@register("inline_accounts", """
, k AS (SELECT report_id, row_ord, CASE WHEN pk % 3 = 0 THEN '  ' ELSE account END AS a, CASE WHEN pk % 6 = 0 THEN '' ELSE agency END AS h, committee_recommendation AS value, chamber FROM ledger WHERE NOT is_subtotal)
SELECT report_id, coalesce(nullif(trim(a), ''), nullif(trim(h), '')) AS name, value FROM k WHERE coalesce(nullif(trim(a), ''), nullif(trim(h), '')) IS NOT NULL""")  # fmt: skip
def inline_accounts(spark, sf_dir):
    """The flat table has the reports of one chamber; those of the other come from the nested one, which has all."""
    rows = ledger(spark, sf_dir).filter("NOT is_subtotal").select("report_id", F.when(F.col("pk") % 3 == 0, "  ").otherwise(F.col("account")).alias("account_name"), F.when(F.col("pk") % 6 == 0, "").otherwise(F.col("agency")).alias("context_heading"), F.col("committee_recommendation").alias("value"), "chamber")
    return sources.inline_accounts(rows.filter("chamber = 'house'").drop("chamber"), rows.drop("chamber"))


@register("first_pass", "SELECT stage, count(*) AS n_rows FROM ledger GROUP BY stage")
def first_pass(spark, sf_dir):
    """A first pass that is already there is read, not made again."""
    path = new_folder(spark, "first")
    made_once(spark, path, lambda: ledger(spark, sf_dir).select("stage", "report_id"))
    return made_once(spark, path, lambda: ledger(spark, sf_dir).limit(0)).groupBy("stage").agg(F.count(F.lit(1)).alias("n_rows"))


@register("proof_sheets", _VERDICTS + """
, q AS (SELECT report_id, count(*) AS sheet_rows, count(*) FILTER (tot) AS formulas, CAST(sum(CASE WHEN tot THEN cr END) AS BIGINT) AS rollups FROM p GROUP BY report_id)
SELECT q.*, count(*) AS listed, count(*) FILTER (status = 'ok') AS agree, count(*) FILTER (status <> 'unchecked' AND n_children > 0) AS checks FROM q JOIN verdicts v ON v.report_id = q.report_id GROUP BY ALL""", recursive=True)
def proof_sheets(spark, sf_dir):
    """Spreadsheet files opened again: the proof with a live sum for each total, the list of totals with their checks, and the notes' count of those that agree."""
    books = writers.workbooks(writers.proof_of(reconcile.reconcile_in_place(_statement(spark, sf_dir))))

    def opened(frames):
        import re

        for frame in frames:
            found = []
            for report, content in zip(frame["report_id"], frame["content"], strict=True):
                book = zipfile.ZipFile(io.BytesIO(content))
                proof, listed, notes = (book.read(f"xl/worksheets/sheet{k}.xml").decode() for k in (1, 2, 3))
                rollups = [int(v) for v in re.findall(r'<c r="D\d+"><v>(-?\d+)</v>', proof)]
                agree = int(re.search(r"Agree: (\d+)", notes)[1])
                checks = len(re.findall(r"<f>C\d+-D\d+</f>", listed))
                found.append((report, proof.count("<row ") - 1, proof.count("<f>"), sum(rollups) if rollups else None, listed.count("<row ") - 1, agree, checks))
            made = pd.DataFrame(found, columns=["report_id", "sheet_rows", "formulas", "rollups", "listed", "agree", "checks"])
            made["rollups"] = pd.array(made["rollups"].tolist(), "Int64")
            yield made

    return books.mapInPandas(opened, "report_id string, sheet_rows bigint, formulas bigint, rollups bigint, listed bigint, agree bigint, checks bigint")


@register("proof_formulas", """
, b AS (SELECT report_id, blk, min(CASE WHEN NOT is_subtotal THEN row_ord END) AS a, max(CASE WHEN NOT is_subtotal THEN row_ord END) AS z, max(CASE WHEN is_subtotal THEN row_ord END) AS place, bool_or(is_memo) AS memo, max(CASE WHEN is_subtotal THEN committee_recommendation END) AS t, CAST(sum(CASE WHEN NOT is_subtotal THEN committee_recommendation END) AS BIGINT) AS s FROM ledger GROUP BY ALL)
SELECT report_id, place AS row_ord, CASE WHEN a = z THEN '=SUM(C' || (a + 1) || ')' ELSE '=SUM(C' || (a + 1) || ':C' || (z + 1) || ')' END AS formula FROM b WHERE NOT memo AND t = s AND t <> 0""")  # fmt: skip
def proof_formulas(spark, sf_dir):
    """The formulas of totals over blocks without memos that close exactly. Whether a block is such a one goes along with its total, so a report's rows are moved once."""
    block = W.partitionBy("report_id", "fiscal_year", "chamber", "blk")
    closing, total = F.col("is_subtotal"), F.col("committee_recommendation")
    t, s = F.max(F.when(closing, total)).over(block), F.sum(F.when(~closing, total)).over(block)
    rows = ledger_by_report(spark, sf_dir).withColumn("plain", F.coalesce(~F.bool_or("is_memo").over(block) & (t == s) & (t != 0), F.lit(False)))
    totals = reconcile.reconcile(rows, ("plain",)).filter("plain")
    formula = F.when(F.col("status") == "ok", writers.proof_formula(F.col("children"), F.col("rollups"))).otherwise("=0")
    return totals.select("report_id", F.col("row_ord").cast("int").alias("row_ord"), formula.alias("formula"))


@register("summary_drop", r"""
, t AS (SELECT report_id, row_ord, CASE WHEN row_ord % 29 = 0 THEN 'Projection of outlays' WHEN row_ord % 29 IN (1, 2) THEN 'Discretionary' WHEN row_ord % 31 = 7 THEN '1997' ELSE line_item_text END AS x FROM ledger)
, k AS (SELECT *, regexp_matches(x, '^(19|20)[0-9][0-9]$') AS y, x = 'Projection of outlays' AS h FROM t), s AS (SELECT *, y OR h OR x = 'Discretionary' AS kind FROM k)
, i AS (SELECT *, sum(CASE WHEN kind THEN 0 ELSE 1 END) OVER (PARTITION BY report_id ORDER BY row_ord) AS island FROM s)
, f AS (SELECT report_id, row_ord, x, kind AND (y OR bool_or(h) OVER (PARTITION BY report_id, island ORDER BY row_ord)) AS is_summary FROM i)
SELECT report_id, row_ord, x AS line_item_text FROM f WHERE NOT is_summary""")  # fmt: skip
def summary_drop(spark, sf_dir):
    from ledgerloom.operators import structure

    n = F.col("row_ord")
    label = F.when(n % 29 == 0, "Projection of outlays").when((n % 29).isin(1, 2), "Discretionary").when(n % 31 == 7, "1997").otherwise(F.col("line_item_text"))
    return structure.drop_summary_rows(ledger(spark, sf_dir).withColumn("line_item_text", label)).select("report_id", "row_ord", "line_item_text")


@register("flow_coverage", "SELECT CAST(sum(committee_recommendation) AS BIGINT) AS total_flowed FROM (SELECT *, row_number() OVER (PARTITION BY report_id, account ORDER BY abs(committee_recommendation) DESC, row_ord) AS k FROM ledger WHERE committee_recommendation IS NOT NULL AND account IS NOT NULL AND NOT is_subtotal) WHERE k = 1")
def flow_coverage(spark, sf_dir):
    """What flows in all; every level of a flow adds up to it."""
    nodes, _ = query.flow(query.with_defaults(ledger(spark, sf_dir)), levels=("subcommittee", "account"), top=3)
    return nodes.filter("level = 'account'").agg(F.sum("total").alias("total_flowed"))
