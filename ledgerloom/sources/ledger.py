"""Sources: the derived ledger over star-schema tables, text documents, JSON trees, CSV and Parquet facts, dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerloom.functions import text as fx
from ledgerloom.schema import CPI, REAL_BASE
from ledgerloom.sources.workspace import exists

#: The ledger as SQL over lineitem, orders, customer, nation and part. It runs in Spark and DuckDB alike.
#: A report is a month of a region, of 150,000 order keys at most, so that reports keep their size at any scale. Year and chamber follow from the report; rows
#: are numbered within all three, so that conditions on year and chamber are pushed below the numbering.
LEDGER_SQL = """
WITH li AS (
 SELECT l_orderkey, l_partkey, l_returnflag, l_linestatus,
  CAST(ROUND(l_extendedprice*100) AS BIGINT) AS c, CAST(ROUND(l_discount*100) AS BIGINT) AS dp, CAST(ROUND(l_tax*100) AS BIGINT) AS tp,
  row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber,l_partkey,l_suppkey,l_quantity,l_extendedprice,l_shipdate) AS ln
 FROM lineitem),
leaf AS (
 SELECT concat('RPT-', CAST(year(o_orderdate) AS STRING), '-', CAST(month(o_orderdate) AS STRING), '-', CAST(n_regionkey AS STRING), '-', CAST(CAST(FLOOR(o_orderkey / 150000) AS INT) AS STRING)) AS report_id,
  year(o_orderdate) + CASE WHEN month(o_orderdate)>=10 THEN 1 ELSE 0 END AS fiscal_year,
  CASE WHEN n_regionkey % 2 = 0 THEN 'house' ELSE 'senate' END AS chamber,
  CASE WHEN o_orderstatus='F' THEN 'enacted' ELSE 'committee' END AS stage,
  c_mktsegment AS subcommittee, n_name AS agency, p_type AS account, p_name AS line_item_text, p_brand AS code,
  o_orderkey AS blk, ln, false AS is_subtotal, (l_returnflag='R' AND l_partkey % 3 = 0) AS is_memo,
  c AS committee_recommendation, CAST(FLOOR(c*(100-dp)/100) AS BIGINT) AS prior_year_enacted, CAST(FLOOR(c*(100+tp)/100) AS BIGINT) AS budget_estimate, l_partkey AS pk
 FROM li JOIN orders ON l_orderkey=o_orderkey JOIN customer ON o_custkey=c_custkey JOIN nation ON c_nationkey=n_nationkey JOIN part ON l_partkey=p_partkey),
tot AS (
 SELECT report_id, fiscal_year, chamber, stage, subcommittee, agency, blk,
  CASE WHEN blk % 13 = 0 THEN NULL WHEN blk % 11 = 0 THEN CAST(FLOOR(SUM(CASE WHEN is_memo THEN 0 ELSE committee_recommendation END)*101/100) AS BIGINT)
   WHEN blk % 7 = 0 THEN CAST(SUM(committee_recommendation)*2+1 AS BIGINT) WHEN blk % 5 = 0 THEN CAST(SUM(committee_recommendation) AS BIGINT)
   ELSE CAST(SUM(CASE WHEN is_memo THEN 0 ELSE committee_recommendation END) AS BIGINT) END AS committee_recommendation,
  CAST(SUM(prior_year_enacted) AS BIGINT) AS prior_year_enacted, CAST(SUM(budget_estimate) AS BIGINT) AS budget_estimate
 FROM leaf GROUP BY report_id, fiscal_year, chamber, stage, subcommittee, agency, blk),
u AS (
 SELECT report_id,fiscal_year,chamber,stage,subcommittee,agency,account,line_item_text,code,blk,ln,is_subtotal,is_memo,committee_recommendation,prior_year_enacted,budget_estimate,pk FROM leaf
 UNION ALL SELECT report_id,fiscal_year,chamber,stage,subcommittee,agency,NULL,concat('Total, Order ',CAST(blk AS STRING)),NULL,blk,1000000,true,false,committee_recommendation,prior_year_enacted,budget_estimate,0 FROM tot),
ledger AS (
SELECT *, row_number() OVER (PARTITION BY report_id, fiscal_year, chamber ORDER BY blk,ln) AS row_ord,
 committee_recommendation - prior_year_enacted + CASE WHEN pk%17=1 THEN 1 ELSE 0 END AS delta_vs_enacted,
 committee_recommendation - budget_estimate AS delta_vs_estimate FROM u)
"""
TABLES = ("lineitem", "orders", "customer", "nation", "part")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _query(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    for name in TABLES:
        sql = sql.replace(f"FROM {name})", f"FROM {{{name}}})").replace(f"JOIN {name} ", f"JOIN {{{name}}} ").replace("JOIN part ON", "JOIN {part} ON")
    return spark.sql(sql, **{name: table(spark, sf_dir, name) for name in TABLES})


def ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The derived ledger: one row for each line item and printed total, in document order (report_id, row_ord)."""
    return _query(spark, sf_dir, LEDGER_SQL + "SELECT * FROM ledger")


def _line_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of `leaf` in LEDGER_SQL, a report's in one partition.

    Orders meet their customers before their lines. Line items move three times: to their orders, parts and reports. They take little more than keys and
    numbers along; what follows from those (a report's name, its year and chamber, amounts) is made where the rows have arrived.
    """
    li, o, c, n, p = (table(spark, sf_dir, name) for name in TABLES)
    cents = lambda name: F.round(F.col(name) * 100).cast("bigint")
    memo = ((F.col("l_returnflag") == "R") & (F.col("l_partkey") % 3 == 0)).alias("is_memo")
    # a price of whole cents is its cents, so only another one goes along
    price = F.col("c") / F.lit(100.0)
    li = li.select("l_orderkey", "l_partkey", "l_linenumber", "l_suppkey", "l_quantity", "l_shipdate", "l_extendedprice", memo, cents("l_extendedprice").alias("c"), cents("l_discount").alias("dp"), cents("l_tax").alias("tp"))
    li = li.withColumn("l_extendedprice", F.when(~F.col("l_extendedprice").eqNullSafe(price), F.col("l_extendedprice"))).repartition("l_orderkey")
    line = W.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", F.coalesce("l_extendedprice", price), "l_shipdate")
    li = li.select("l_orderkey", "l_partkey", "is_memo", "c", "dp", "tp", F.row_number().over(line).alias("ln"))
    months = (F.year("o_orderdate") * 12 + F.month("o_orderdate") - 1).alias("months")
    o = o.join(c, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", months, (F.col("o_orderstatus") == "F").alias("final"), "c_mktsegment", "c_nationkey")
    rows = li.join(o, F.col("l_orderkey") == F.col("o_orderkey")).join(p.select("p_partkey", "p_name", "p_type", "p_brand"), F.col("l_partkey") == F.col("p_partkey")).join(n, F.col("c_nationkey") == F.col("n_nationkey"))
    rows = rows.select("months", "final", "c_mktsegment", "n_name", "n_regionkey", "p_type", "p_name", "p_brand", "o_orderkey", "ln", "is_memo", "c", "dp", "tp", "l_partkey")
    year, month = F.floor(F.col("months") / 12).cast("int"), F.pmod("months", F.lit(12)) + 1
    report = F.concat(F.lit("RPT-"), *[x for k in (year, month, F.col("n_regionkey")) for x in (k.cast("string"), F.lit("-"))], F.floor(F.col("o_orderkey") / 150000).cast("int").cast("string"))
    part = lambda percent: F.floor(F.col("c") * percent / 100).cast("bigint")
    return rows.repartition(report).select(
        report.alias("report_id"), (year + F.when(month >= 10, 1).otherwise(0)).alias("fiscal_year"), F.when(F.col("n_regionkey") % 2 == 0, "house").otherwise("senate").alias("chamber"),
        F.when(F.col("final"), "enacted").otherwise("committee").alias("stage"), F.col("c_mktsegment").alias("subcommittee"), F.col("n_name").alias("agency"), F.col("p_type").alias("account"), F.col("p_name").alias("line_item_text"),
        F.col("p_brand").alias("code"), F.col("o_orderkey").alias("blk"), "ln", "is_memo", F.col("c").alias("committee_recommendation"), part(100 - F.col("dp")).alias("prior_year_enacted"), part(100 + F.col("tp")).alias("budget_estimate"), F.col("l_partkey").alias("pk"),
    )


def ledger_by_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows, for queries that work through whole reports: a report's rows lie in one partition, so windows and groups by report need no further exchange.

    Line items are derived once, and the first of a block brings the block's total with it. Columns that a query doesn't read are not moved.
    """
    block = W.partitionBy("blk", "report_id", "fiscal_year", "chamber", "stage", "subcommittee", "agency").orderBy("ln")  # rows are sorted by the number first, which seldom ties
    whole = block.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    c, every = F.col("committee_recommendation"), F.sum("committee_recommendation").over(whole)
    net = F.sum(F.when(F.col("is_memo"), 0).otherwise(c)).over(whole)
    sums = _line_items(spark, sf_dir).select("*", F.row_number().over(block).alias("_n"), every.alias("_every"), net.alias("_net"), F.sum("prior_year_enacted").over(whole).alias("_prior"), F.sum("budget_estimate").over(whole).alias("_budget"))
    rows = sums.withColumn("is_subtotal", F.explode(F.when(F.col("_n") == 1, F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))))
    printed = F.expr("CASE WHEN blk % 13 = 0 THEN NULL WHEN blk % 11 = 0 THEN CAST(FLOOR(_net * 101 / 100) AS BIGINT) WHEN blk % 7 = 0 THEN _every * 2 + 1 WHEN blk % 5 = 0 THEN _every ELSE _net END")
    none = F.lit(None).cast("string")
    total = {
        "account": none, "line_item_text": F.concat(F.lit("Total, Order "), F.col("blk").cast("string")), "code": none, "ln": F.lit(1000000), "is_memo": F.lit(False),
        "committee_recommendation": printed, "prior_year_enacted": F.col("_prior"), "budget_estimate": F.col("_budget"), "pk": F.lit(0).cast("bigint"),
    }
    own = lambda k: F.when(F.col("is_subtotal"), total[k]).otherwise(F.col(k)).alias(k)
    rows = rows.select("report_id", "fiscal_year", "chamber", "stage", "subcommittee", "agency", *map(own, ("account", "line_item_text", "code")), "blk", own("ln"), "is_subtotal", *map(own, ("is_memo", "committee_recommendation", "prior_year_enacted", "budget_estimate", "pk")))
    order = W.partitionBy("report_id", "fiscal_year", "chamber").orderBy("blk", "ln")
    return rows.withColumns({
        "row_ord": F.row_number().over(order), "delta_vs_enacted": c - F.col("prior_year_enacted") + F.when(F.col("pk") % 17 == 1, 1).otherwise(0), "delta_vs_estimate": c - F.col("budget_estimate"),
    })


def documents_of(spark: SparkSession, path: str) -> DataFrame:
    """Whole text files: report_id from the file name, and text."""
    name = F.element_at(F.split(F.col("_metadata.file_name"), r"\."), 1)
    return spark.read.text(path, wholetext=True).select(name.alias("report_id"), F.col("value").alias("text"))


def lines_of(docs: DataFrame, id_col: str = "report_id", text_col: str = "text") -> DataFrame:
    """One row for each line, with row_ord from 0."""
    return docs.select(id_col, F.posexplode(F.split(text_col, "\n", -1)).alias("row_ord", "line"))


def extracted_json(spark: SparkSession, path: str, schema: str, intermediate: tuple[str, ...] = ("_nemotron", "_hybrid")) -> DataFrame:
    """A tree of extracted reports without intermediate files; rows keep their place in the file's arrays."""
    rows = spark.read.schema(schema).option("multiLine", True).option("recursiveFileLookup", True).option("pathGlobFilter", "*.json").json(path)
    stem = F.regexp_replace(F.col("_metadata.file_name"), r"\.json$", "")
    keep = F.lit(True)
    for end in intermediate:
        keep &= ~stem.endswith(end)
    return rows.withColumn("_stem", stem).filter(keep)


def in_file_order(rows: DataFrame, name: str = "row_ord") -> DataFrame:
    """rows, straight from files that Spark has read, with their place (from 0) in the order of the files and of the rows within each.

    Files come in the order of their part numbers and names. Parquet knows a row's place in its file; other formats are numbered in two passes: rows of one split
    of a file are read one after another, so a row's place is that within its split after the splits before. Only a row for each split is put in order
    as a whole; the rows stay where they were read.
    """
    meta = rows.select("*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.file_path").alias("_path"), F.col("_metadata.file_block_start").alias("_start"), F.monotonically_increasing_id().alias("_id"))
    part = F.coalesce(F.regexp_extract("_file", r"^part-(\d+)", 1).try_cast("bigint"), F.lit(-1))
    splits = meta.groupBy("_path", "_start").agg(F.min(part).alias("part"), F.min("_file").alias("file"), F.count(F.lit(1)).alias("n"), F.min("_id").alias("_first"))
    order = W.orderBy("part", "file", "_path", "_start")
    splits = splits.withColumn("_before", F.sum("n").over(order) - F.col("n")).select("_path", "_start", "_first", "_before")
    out = meta.join(splits, ["_path", "_start"]).withColumn(name, F.col("_before") + F.col("_id") - F.col("_first"))
    return out.drop("_file", "_path", "_start", "_id", "_first", "_before")


def csv_fact(spark: SparkSession, path: str, integers: tuple[str, ...], booleans: tuple[str, ...] = (), floats: tuple[str, ...] = (), place: str | None = None, multiline: bool = True) -> DataFrame:
    """A CSV fact, read as text and coerced: '' and 'None' are null, whole numbers may be written as floats. place: a column for the row's place in the files.

    multiline: values may hold line breaks, and a file is read by one task; without it large files are split.
    """
    read = spark.read.option("header", True).option("multiLine", multiline).option("escape", '"').csv(path)
    kind = {**dict.fromkeys(integers, fx.to_int), **dict.fromkeys(booleans, fx.to_bool), **dict.fromkeys(floats, fx.to_float)}
    df = in_file_order(read, place) if place else read
    return df.select(*[kind.get(c, fx.to_text)(F.col(c)).alias(c) for c in read.columns], *([place] if place else []))


def release(spark: SparkSession, path: str, columns: list[str], integers: tuple[str, ...] = (), booleans: tuple[str, ...] = (), place: str | None = None) -> DataFrame:
    """Only the needed columns of a released fact, Parquet or (by the end of its name) CSV, with its track. place: a column for the row's place in the files, by which a report's rows are in order."""
    if path.rstrip("/").endswith(".csv"):
        rows = csv_fact(spark, path, integers, booleans, place=place)
    else:
        rows = spark.read.parquet(path)
        rows = in_file_order(rows, place) if place else rows
    return rows.select(*columns, *([place] if place else [])).withColumn("track", F.when(F.col("stage") == "enacted", "enacted").otherwise(F.col("chamber")))


def deflators(spark: SparkSession) -> DataFrame:
    """fiscal_year, cpi_u and the factor to the base year's dollars, rounded half to even at four places."""
    rows = spark.createDataFrame(list(CPI.items()), "fiscal_year int, cpi_u double")
    return rows.withColumn("real_factor", F.bround(F.lit(CPI[REAL_BASE]) / F.col("cpi_u"), 4))


# Prints of explanatory statements with their fiscal years; no search by title finds them.
STATEMENT_PRINTS = {
    "CPRT-114HPRT98155": 2016, "CPRT-114HPRT98369": 2016, "CPRT-115HPRT25289": 2017, "CPRT-115HPRT29456": 2018, "CPRT-115HPRT29457": 2018, "CPRT-116HPRT35160": 2019, "CPRT-116HPRT38678": 2020, "CPRT-116HPRT38679": 2020,
    "CPRT-117HPRT43749": 2021, "CPRT-117HPRT43750": 2021, "CPRT-117HPRT47047": 2022, "CPRT-117HPRT47048": 2022, "CPRT-117HPRT50347": 2023, "CPRT-117HPRT50348": 2023, "CPRT-118HPRT55008": 2024, "CPRT-118HPRT56550": 2024,
}


def enacted_prints(spark: SparkSession, first: int | None = None, last: int | None = None) -> DataFrame:
    """Report metadata of the enacted prints, of congresses from first to last where given."""
    rows = spark.createDataFrame(list(STATEMENT_PRINTS.items()), "package_id string, fiscal_year int")
    part = lambda g: F.regexp_extract("package_id", r"^CPRT-(\d+)HPRT(\d+)$", g).try_cast("int")
    none = F.lit(None).cast("string")
    out = rows.select("package_id", part(1).alias("congress"), F.lit("house").alias("chamber"), part(2).alias("report_number"), F.concat(F.lit("Consolidated appropriations, explanatory statement for "), "fiscal_year").alias("title"), none.alias("subcommittee"), "fiscal_year", F.lit("enacted").alias("stage"), none.alias("date_issued"))
    return out.filter(F.col("congress").between(first if first is not None else 0, last if last is not None else 1 << 30))


CATALOG = "package_id string, congress int, chamber string, report_number int, title string, subcommittee string, fiscal_year int, stage string, date_issued string"


def load_catalog(spark: SparkSession, path: str) -> DataFrame:
    """A catalog written as JSON; no rows where there is none."""
    return spark.read.schema(CATALOG).json(path) if exists(spark, path) else spark.createDataFrame([], CATALOG)


def catalog(packages: DataFrame, content_url: str | None = None) -> DataFrame:
    """Report metadata of package summaries (package_id, title, doc_class, congress, date_issued): known chambers, titles of reports, known subcommittees.

    content_url: where packages are published; it adds html_url and pdf_url.
    """
    t = F.col("title")
    out = packages.select("package_id", F.col("congress").cast("int").alias("congress"), fx.chamber_of_class(F.col("doc_class")).alias("chamber"), fx.report_number(F.col("package_id")).alias("report_number"), t.alias("title"), fx.classify_subcommittee(t).alias("subcommittee"), fx.extract_fiscal_year(t).alias("fiscal_year"), fx.classify_stage(t).alias("stage"), "date_issued")
    if content_url is not None:
        url = lambda folder, end: F.concat(F.lit(f"{content_url.rstrip('/')}/"), "package_id", F.lit(f"/{folder}/"), "package_id", F.lit(end))
        out = out.withColumn("html_url", url("html", ".htm")).withColumn("pdf_url", url("pdf", ".pdf"))
    return out.filter(fx.is_report_title(t) & F.col("chamber").isNotNull() & F.col("report_number").isNotNull() & F.col("subcommittee").isNotNull())


def cached_files(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """Downloaded files with digest: congress, chamber, report_id, sha256, content, length; files that are not of their kind are dropped.

    Layouts: .../{congress}/{chamber}/{id}.{kind}, .../congress=C/chamber=C/report_id=ID/part-*.{kind} as Spark writes it, and packs of many files each, as
    writers.write_packs() makes them: a file of its own for each report costs a listing, a commit and an open each.
    """
    out, packs = _single_files(spark, path, kind), packs_of(path, kind)
    if exists(spark, packs):
        packed = spark.read.schema(PACKED).parquet(packs)
        out = out.unionByName(packed.select("congress", "chamber", "report_id", F.sha2("content", 256).alias("sha256"), "content", F.octet_length("content").cast("bigint").alias("length")))
    return out.filter(F.col("content").startswith(F.lit(b"%PDF"))) if kind == "pdf" else out


#: A row of a pack: a file with its content.
PACKED = "congress string, chamber string, report_id string, content binary"


def packs_of(path: str, kind: str) -> str:
    """The folder of the packs of a cache."""
    return f"{path.rstrip('/')}/packs-{kind}"


def _single_files(spark: SparkSession, path: str, kind: str) -> DataFrame:
    rows = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", f"*.{kind}").load(path)
    parts = F.split("path", "/")
    parts = F.when(F.element_at(parts, -1).startswith("part-"), F.slice(parts, F.lit(1), F.size(parts) - 1)).otherwise(parts)
    part = lambda n: F.regexp_replace(F.element_at(parts, n), "^[a-z_]+=", "")
    return rows.select(part(-3).alias("congress"), part(-2).alias("chamber"), F.regexp_replace(part(-1), rf"\.{kind}$", "").alias("report_id"), F.sha2("content", 256).alias("sha256"), "content", "length")


def verified_files(files: DataFrame, sidecars: DataFrame) -> DataFrame:
    """Adds intact: the digest noted when a file was stored (report_id, noted) is the file's; a file without a note passes."""
    return files.join(sidecars.select("report_id", "noted"), "report_id", "left").withColumn("intact", F.col("noted").isNull() | (F.col("noted") == F.col("sha256"))).drop("noted")


def page_lines(files: DataFrame, reader) -> DataFrame:
    """Text lines of paged files: report_id, page, row_ord (over the whole report), line. reader: from an iterator of pandas frames (report_id, content) to one of (report_id, page, text)."""
    pages = files.select("report_id", "content").mapInPandas(reader, "report_id string, page int, text string")
    lines = pages.select("report_id", "page", F.posexplode(F.split("text", "\n", -1)).alias("pos", "line"))
    return lines.select("report_id", "page", (F.row_number().over(W.partitionBy("report_id").orderBy("page", "pos")) - 1).alias("row_ord"), "line")


def inline_accounts(flat: DataFrame, nested: DataFrame) -> DataFrame:
    """Ground truth of accounts: (report_id, name, value) rows from the flat table, and from the nested one for reports that it lacks.

    Both: report_id, account_name, context_heading, value. The name is the account's, else the heading; rows without either are skipped.
    """
    name = F.coalesce(*[F.nullif(fx.strip(F.col(c)), F.lit("")) for c in ("account_name", "context_heading")])
    rows = flat.unionByName(nested.join(flat.select("report_id").distinct(), "report_id", "left_anti"))
    return rows.select("report_id", name.alias("name"), "value").filter("name IS NOT NULL")


def account_dimension(raw: DataFrame) -> DataFrame:
    """Distinct (symbol, title) rows of a federal account listing, without incomplete ones."""
    return raw.select("federal_account_symbol", "account_title", "agency", "bureau").dropna(subset=["federal_account_symbol", "account_title"]).dropDuplicates(["federal_account_symbol", "account_title"])
