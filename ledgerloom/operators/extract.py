"""Text to rows: inline funding tables, fixed-width statements, enacted statements, typeset statements, page-reader items.

Documents come as lines (report_id, row_ord, line); order is always (report_id, row_ord).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerloom.functions import latex
from ledgerloom.functions import text as fx
from ledgerloom.operators import structure
from ledgerloom.schema import AMOUNTS

# What lines of these documents look like.
_FUNDING = r"^\s*[A-Za-z][\w\s,()\\/*]+?\.{3,}\s*.+?\s*$"
_AFTER_DOTS = r"^\.{3,}\s*(.+?)\s*$"
_START = r"^\s*Appropriations?,\s*\d{4}\s*\.{3,}|^\s*Appropriation,\s*fiscal\s+year\s+\d{4}"
_COMPARED = "Bill compared with:"
_THOUSANDS = r"(?i)\[In thousands of dollars\]"
_RULE = r"^\s*[-=]{20,}\s*$"


def _w(*keys: str):
    return W.partitionBy(*keys).orderBy("row_ord")


def inline_tables(lines: DataFrame) -> DataFrame:
    """Inline funding tables: report_id, line_number (from 1), heading, five amount records.

    A block opens at a start line and goes on over funding lines, 'Bill compared with:', and a blank whose next filled line,
    within two, is a funding line. It needs two lines, and a prior year or a recommendation.
    """
    line, w = F.col("line"), _w("report_id")
    blank = fx.strip(line) == ""
    rows = lines.withColumn("funding", line.contains("...") & line.rlike(_FUNDING)).withColumn("compared", fx.strip(line) == _COMPARED).withColumn("start", line.contains("ppropriation") & line.rlike(_START)).withColumn("blank", blank)
    rows = structure.nearest_heading(rows)
    # No label of a funding line has a dot, so it ends at the first. Windows move on over short rows in one order: of a line stays what funding says.
    label = F.when(F.col("funding"), F.substring_index(line, "...", 1))
    rows = rows.withColumn("label", label).withColumn("raw", F.regexp_extract(F.substr(line, F.length("label") + 1), _AFTER_DOTS, 1)).drop("line")
    ahead = lambda n: (F.coalesce(F.lead("blank", n).over(w), F.lit(True)), F.coalesce(F.lead("funding", n).over(w), F.lit(False)))
    (b1, f1), (_, f2) = ahead(1), ahead(2)
    rows = rows.withColumn("inside", F.coalesce(F.col("funding") | F.col("compared") | (F.col("blank") & (f1 | (b1 & f2))), F.lit(False))).drop("blank")
    # A stretch of inside lines is one island; a block opens at its first start line, that before which the last other line or start is no start.
    event = F.when(~F.col("inside"), False).when(F.col("start"), True)
    opens = F.col("inside") & F.col("start") & ~F.coalesce(F.last(event, ignorenulls=True).over(w.rowsBetween(W.unboundedPreceding, -1)), F.lit(False))
    rows = rows.withColumn("opens", opens).drop("start")
    opened = F.when(~F.col("inside"), F.struct(F.lit(None).cast(lines.schema["row_ord"].dataType).alias("at"))).when(F.col("opens"), F.struct(F.col("row_ord").alias("at")))
    rows = rows.withColumn("opened", F.last(opened, ignorenulls=True).over(w)["at"]).withColumn("below", F.last(F.when(F.col("compared"), F.col("row_ord")), ignorenulls=True).over(w))
    rows = rows.filter(F.col("inside") & F.col("opened").isNotNull()).withColumn("below", F.coalesce(F.col("below") >= F.col("opened"), F.lit(False)))
    kind = F.when(F.col("funding"), fx.kind_of_label(F.lower(fx.strip(F.col("label"))), fx.detect_indent(F.col("label")), F.col("below")))
    rows = rows.select("report_id", "opened", "row_ord", kind.alias("kind"), "raw", F.when(F.col("row_ord") == F.col("opened"), F.col("heading")).alias("heading"))
    # of each kind the last line; its amount is read when that is known
    last = lambda k: F.max(F.when(F.col("kind") == k, F.struct("row_ord", "raw"))).alias(k)
    kinds = ("prior_year", "budget_estimate", "committee_recommendation", "delta_vs_enacted", "delta_vs_estimate")
    out = rows.groupBy("report_id", "opened").agg(F.count(F.lit(1)).alias("n"), F.max("heading").alias("heading"), *map(last, kinds))
    out = out.withColumns({k: F.when(F.col(k).isNotNull(), fx.parse_dollar(F.col(k)["raw"], paren_negative=False)) for k in kinds} | {"heading": fx.repair_dropcap(F.col("heading"))})
    out = out.filter("n >= 2 AND (prior_year IS NOT NULL OR committee_recommendation IS NOT NULL)")
    return out.select("report_id", (F.col("opened") + 1).alias("line_number"), "heading", *kinds)


def fixed_width(lines: DataFrame, strict: bool = False) -> DataFrame:
    """Rows of a fixed-width comparative statement, with its running hierarchy.

    The section begins at the heading with a thousands mark within eight lines, its data after the third rule of the first
    twenty lines; it ends at the minority, dissenting or additional views. strict drops rows without any amount.
    """
    line, w = F.col("line"), _w("report_id")
    whole = W.partitionBy("report_id")
    mark = line.contains("[") & line.rlike(_THOUSANDS)
    rows = lines.withColumn("near", F.max(mark).over(w.rowsBetween(0, 7)))
    rows = rows.withColumn("begin", F.min(F.when(F.col("near") & line.rlike(r"(?i)comparative statement of new budget"), F.col("row_ord"))).over(whole)).filter("begin IS NOT NULL AND row_ord >= begin")
    views = fx.strip(line).isin("MINORITY VIEWS", "DISSENTING VIEWS", "ADDITIONAL VIEWS") & (F.col("row_ord") >= F.col("begin") + 20)
    rows = rows.withColumn("end", F.coalesce(F.min(F.when(views, F.col("row_ord"))).over(whole), F.lit(1 << 31))).filter("row_ord < end")
    rows = rows.withColumn("thousands", F.max(mark & (F.col("row_ord") < F.col("begin") + 10)).over(whole))
    rules = F.sum(F.when((F.col("row_ord") < F.col("begin") + 20) & line.rlike(_RULE), 1).otherwise(0)).over(w)
    rows = rows.withColumn("rules", rules)
    rows = rows.withColumn("data", F.coalesce(F.min(F.when(F.col("rules") >= 3, F.col("row_ord"))).over(whole) + 1, F.col("begin"))).filter("row_ord >= data")
    header = (line.contains("Item") & F.lower(line).contains("appropriation")) | (line.contains("Committee recommendation") & (line.contains("recommendation") | F.lower(line).contains("compared with"))) | (line.contains("Budget estimate") & F.lower(line).contains("compared with")) | mark | line.rlike(_RULE)
    rows = rows.filter(line.contains("...") & ~header & line.rlike(r"[\d,]{3,}|\([\d,]+\)|[+\-][\d,]+|\.{4,}"))
    label = F.substring_index(line, "...", 1)
    rest = F.ltrim(F.substr(line, F.length(label) + 1), F.lit("."))
    tokens = F.regexp_extract_all(rest, F.lit(r"(\(\+?[\d,]+\)|[+\-][\d,]+|[\d,]{3,}|\.{4,})"), 1)
    rows = rows.withColumn("label", F.rtrim(label)).withColumn("tokens", tokens).withColumn("indent", fx.detect_indent(line))
    rows = rows.withColumn("level", fx.hierarchy_level(F.col("label"), F.col("indent"))).withColumn("line_item_text", fx.strip(F.col("label")))
    at = lambda n: F.when(F.col("level") == n, F.col("line_item_text"))
    rows = structure.fill_context(rows, [("title_name", at(fx.TITLE)), ("department", at(fx.DEPARTMENT)), ("agency", at(fx.AGENCY)), ("account", at(fx.ACCOUNT))])
    amounts = {c: fx.token_amount(F.coalesce(F.get("tokens", i), F.lit("")), F.col("thousands")) for i, c in enumerate(AMOUNTS)}
    out = rows.withColumns(amounts).withColumn("is_subtotal", (F.col("level") != fx.ACCOUNT) & fx.is_subtotal_line(F.col("line_item_text")) | fx.is_subtotal_line(F.col("line_item_text")) & ~F.col("line_item_text").endswith(":"))
    out = out.withColumn("is_memo", fx.is_paren_memo(F.col("committee_recommendation"))).withColumn("program", F.when(F.col("level") >= fx.PROGRAM, F.col("line_item_text")))
    if strict:
        out = out.filter(F.coalesce(*[F.col(c)["value"] for c in AMOUNTS]).isNotNull())
    return out.select("report_id", "row_ord", (F.col("row_ord") + 1).alias("line_number"), "title_name", "department", "agency", "account", "program", F.col("level").alias("hierarchy_depth"), "line_item_text", *AMOUNTS, "is_subtotal", "is_memo", F.col("thousands").alias("in_thousands"))


def enacted_statement(lines: DataFrame, with_page: bool = False) -> DataFrame:
    """Rows of enacted statements: (report_id, page, row_ord, line) to division, account, label, request, enacted, in_thousands, verified.

    A units header holds from its line to the page's end; a division holds until the next, over pages. A caps line (with 85 %
    or more in capitals, no amount) is a heading of what follows until a blank. Where the two-column header was seen, a row of
    70 % or more capitals has the request first and the enacted amount last; else dot leaders or a total give the amount.
    with_page adds page_text, the lines of the row's page as they were printed. Windows over a report in one order.
    """
    amount = r"(\$?\d{1,3}(?:,\d{3})+)"
    line = F.col("line")
    rows = lines.select("report_id", "page", "row_ord", fx.join_split_numbers(line).alias("line"), line.alias("_printed"))
    rows = rows.withColumn("_printed", F.when(line != F.col("_printed"), F.col("_printed")))  # seldom
    p, r = _w("report_id", "page"), W.partitionBy("report_id").orderBy("page", "row_ord")
    s, low, any_ = F.col("s"), F.col("low"), F.col("any")
    # what the windows read, as flags; only rows with amounts are taken apart, after them
    rows = rows.withColumn("s", fx.strip(line)).withColumn("any", line.contains(",") & line.rlike(amount)).withColumn("low", F.lower("s"))
    heading = ~any_ & s.rlike(r"^[A-Z][A-Z0-9\s,&()'./\-]{3,58}$") & ~s.rlike("^DIVISION") & (fx.caps_fraction(s) >= 0.85)
    column = F.when(low.contains("final") | low.contains("bill"), low).otherwise(F.when(low.isNotNull(), F.lit("")))  # of other lines only that they stand between
    rows = rows.select(
        "report_id", "page", "row_ord", "line", "_printed", "any", F.when(heading, s).alias("heading"), fx.is_thousands_marker(s).alias("marker"), low.contains("in thousands of dollars").alias("units"), column.alias("column"),
        (s == "").alias("blank"), F.when(s.startswith("DIVISION"), F.nullif(F.regexp_extract(s, r"^DIVISION\s+([A-Z])\b", 1), F.lit(""))).alias("division"),
    )
    rows = rows.withColumns({"thousands": F.max("marker").over(p), "gap": F.count_if("blank").over(p), **{f"_{k}": F.lead("column", k).over(p) for k in (1, 2, 3)}})
    rows = rows.withColumn("two", F.col("units") & F.concat_ws(" ", "_1", "_2", "_3").contains("final bill")).withColumn("division", F.last("division", ignorenulls=True).over(r))
    rows = rows.drop("marker", "units", "column", "blank", "_1", "_2", "_3")
    # before the last window, so that the filter after it reads columns and evaluates nothing again
    rows = rows.withColumn("nums", F.when(any_, F.regexp_extract_all("line", F.lit(amount), 1)))
    rows = rows.withColumn("label", F.when(any_, fx.label_before(fx.strip(line), F.get("nums", 0), r"\$?\d{1,3}(?:,\d{3})+.*$")))
    rows = rows.withColumn("capitals", F.when(any_, (F.length("label") > 3) & (fx.caps_fraction(F.col("label")) >= 0.7))).withColumn("single", F.when(any_, line.contains("...") | fx.is_enacted_total(F.col("label"))))
    above = F.collect_list(F.when(F.col("heading").isNotNull(), F.struct("gap", "heading"))).over(p)
    seen = {"two": F.max("two").over(p), "heads": above}
    if with_page:
        seen["_printed"] = F.collect_list(F.coalesce("_printed", "line")).over(p.rowsBetween(W.unboundedPreceding, W.unboundedFollowing))
    rows = rows.withColumns(seen).withColumn("two", F.col("two") & F.col("capitals")).filter(any_ & (F.col("two") | F.col("single")))
    rows = rows.withColumn("heads", F.transform(F.filter("heads", lambda x: x["gap"] == F.col("gap")), lambda x: x["heading"]))
    rows = rows.withColumn("request_raw", F.when(F.col("two") & (F.size("nums") >= 2), F.get("nums", 0))).withColumn("enacted_raw", F.element_at("nums", -1))
    out = rows.withColumn("account", F.nullif(F.array_join(F.slice("heads", F.greatest(F.size("heads") - 2, F.lit(1)), F.lit(3)), " / "), F.lit("")))
    out = out.withColumn("request", fx.dollars(F.col("request_raw"), F.col("thousands"))).withColumn("enacted", fx.dollars(F.col("enacted_raw"), F.col("thousands")))
    page = [F.array_join("_printed", "\n").alias("page_text")] if with_page else []
    return out.select("report_id", "page", "row_ord", "division", "account", "label", "request", "enacted", F.col("thousands").alias("in_thousands"), fx.is_enacted_total(F.col("label")).alias("is_subtotal"), "request_raw", "enacted_raw", *page)


def verbatim(rows: DataFrame, pages: DataFrame | None = None) -> DataFrame:
    """Adds verified: both raw amounts are printed on their page (report_id, page, page_text); without pages, rows bring their page_text."""
    out = rows.join(pages, ["report_id", "page"], "left") if pages is not None else rows
    seen = fx.on_page(F.col("request_raw"), F.col("page_text")) & fx.on_page(F.col("enacted_raw"), F.col("page_text"))
    return out.withColumn("verified", F.coalesce(seen, F.lit(False))).drop("page_text")


# The only rows of two amounts that a typeset account has.
OFFSETS = ("LESS REIMBURSABLES", "UNDISTRIBUTED ADJUSTMENT", "HISTORICAL UNOBLIGATED BALANCES", "PROJECTED OVERESTIMATION OF CIVILIAN COMPENSATION")
# Fixed value: the sentence that opens a typeset account.
ANCHOR = "recommends the following appropriations for"
# Fixed value: marks that typesetting leaves on a page.
FURNITURE = r"VerDate|Jkt \d|PO \d{5}|Frm \d|Fmt \d|Sfmt \d|In thousands of dollars|Dollars in thousands|^htiw$|^no$"


def without_furniture(lines: DataFrame) -> DataFrame:
    return lines.filter(~F.col("line").rlike(FURNITURE))


# A heading in capitals, a title's line, a budget line's code, two or more dots of a leader.
_CAPITALS = r"^[A-Z0-9][A-Z0-9 ,&/.\-\[\]()']*[A-Z)\]]$"
_TITLE_LINE = r"^TITLE\s+([IVX]+)\b"
_CODE = r"^([0-9A-Z][0-9A-Z]{0,4})\s+(.+)$"
_LEADER = r"\.{2,}"
#: Lines of one wrapped heading at most, and of the heading of a block in whole dollars.
WRAPPED, BLOCK_HEADING = 16, 4


def _filled(lines: DataFrame) -> DataFrame:
    return lines.withColumn("line", fx.strip(F.col("line"))).filter("line <> ''")


def _heads(line: Column) -> Column:
    """A line in capitals that may be (part of) a name: no total, no amounts at its end."""
    return ~line.startswith("TOTAL") & line.rlike(_CAPITALS) & (F.size(fx.trailing_amounts(line)) == 0)


def account_above(lines: DataFrame) -> tuple[DataFrame, Column]:
    """lines (without blank ones) with helper columns, and the expression for the name of the account whose sentence stands in a row.

    The name is the line above, but for page numbers and lines in parentheses, if it is a heading in capitals. The lines right above that end in a
    comma, up to WRAPPED of them, belong to it. A total, a row with amounts or ordinary text there means no name. Windows over a report in one order.
    """
    w, line = _w("report_id"), F.col("line")
    part = line.endswith(",") & _heads(F.rtrim(line, F.lit(",")))
    rows = lines.withColumn("_part", part).withColumn("_gap", F.count_if(~F.col("_part")).over(w))
    run = F.collect_list(F.when(F.col("_part"), F.struct("_gap", "line"))).over(w.rowsBetween(-WRAPPED, 0))
    rows = rows.withColumn("_run", F.transform(F.filter(run, lambda x: x["_gap"] == F.col("_gap")), lambda x: x["line"]))
    rows = rows.withColumn("_own", F.struct("line", F.lag("_run").over(w).alias("before")))
    base = F.last(F.when(~line.rlike(r"^\d+$") & ~line.startswith("("), F.col("_own")), ignorenulls=True).over(w.rowsBetween(W.unboundedPreceding, -1))
    rows = rows.withColumn("_base", base)
    name = F.regexp_replace(F.concat_ws(" ", F.array_join("_base.before", " "), F.col("_base.line")), r"\s+", " ")
    return rows, F.when(_heads(F.col("_base.line")) & fx.strip(name).rlike(_CAPITALS), fx.strip(name))


def inline_blocks(lines: DataFrame) -> DataFrame:
    """Three lines in whole dollars: request, recommendation and change: report_id, row_ord, account, request, recommendation, change.

    The account is the heading in capitals right above, of BLOCK_HEADING lines at most; none without one.
    """
    w = _w("report_id")
    amount = lambda c: F.regexp_replace(F.regexp_extract(c, r"(-?\$-?[\d,]+)", 1), r"[$,]", "").try_cast("bigint")
    rows = _filled(lines).withColumn("l1", F.lead("line", 1).over(w)).withColumn("l2", F.lead("line", 2).over(w))
    heads = _heads(F.col("line")) & ~F.lower("line").contains("recommendation")
    above = F.collect_list(F.struct(heads.alias("heads"), "line")).over(w.rowsBetween(-BLOCK_HEADING, -1))
    account = F.aggregate(above, F.lit(""), lambda name, x: F.when(x["heads"], F.concat_ws(" ", F.nullif(name, F.lit("")), x["line"])).otherwise(""))
    rows = rows.withColumn("account", F.nullif(F.regexp_replace(account, r"\s+", " "), F.lit("")))
    fits = F.col("line").rlike(r"^Fiscal year \d{4} budget request\b.*\$") & F.col("l1").rlike(r"^Committee recommendation\b.*\$") & F.col("l2").rlike(r"^Change from budget request\b")
    return rows.filter(fits).select("report_id", "row_ord", "account", amount(F.col("line")).alias("request"), amount(F.col("l1")).alias("recommendation"), amount(F.col("l2")).alias("change"))


def recap(lines: DataFrame) -> DataFrame:
    """Summary rows with a dot leader of two or more dots: the first row of each label of a report."""
    rows = lines.filter(F.col("line").rlike(r"\.{2,}\s*[+-]?\$?[\d,]+")).withColumn("label", fx.strip(F.regexp_replace("line", r"\.{2,}.*$", "")))
    out = structure.keep_first(rows, "report_id", "label")
    return out.select("report_id", "row_ord", "label", F.transform(fx.trailing_amounts(F.regexp_replace("line", r"^.*?\.{2,}", " ")), lambda x: F.replace(x, F.lit(","), F.lit("")).cast("bigint")).alias("amounts"))


def typeset_statement(lines: DataFrame, anchor: str = ANCHOR, offsets: tuple[str, ...] = OFFSETS) -> DataFrame:
    """Rows of a typeset statement: report_id, row_ord, title, account_no, account, code, label, kind (value, total or mark), marks_row, amounts (array of bigint).

    A sentence that matches `anchor` opens an account; account_above() says which. Three or more trailing amounts make a row, or two after a known
    offset; one amount after a label that isn't all capitals is an adjustment mark on the row before, unless a total or another account came in
    between. Lines with a dot leader belong to the recapitulation. A code before a label is one of up to five capitals and digits, with a digit or of four at least. Of an
    account's totals the last stays.
    """
    w = _w("report_id")
    rows = structure.merge_wrapped_totals(_filled(lines.withColumn("line", fx.typeset_minus(F.col("line")))))
    # before the windows, so that what comes after reads columns and evaluates nothing again
    rows = rows.withColumn("tail", fx.trailing_run(F.col("line")))
    rows = rows.withColumn("nums", fx.amounts_of_run(F.col("tail"))).withColumn("label", fx.strip(fx.without_leader(F.left("line", F.length("line") - F.length("tail"))))).drop("tail")
    rows, name = account_above(rows)
    opens = F.col("line").rlike(anchor)
    # one row of the window after another: F.struct keeps a missing name apart from no sentence
    rows = rows.withColumn("_opens", F.when(opens, F.struct(name.alias("name")))).withColumn("account_no", F.count_if(opens).over(w)).withColumn("account", F.last("_opens", ignorenulls=True).over(w)["name"])
    title = F.when(F.col("line").rlike(_TITLE_LINE) & (F.length("line") < 60), F.concat(F.lit("Title "), F.regexp_extract("line", _TITLE_LINE, 1)))
    rows = rows.withColumn("title", F.last(title, ignorenulls=True).over(w)).withColumn("title", F.last(F.when(opens, F.struct("title")), ignorenulls=True).over(w)["title"])
    n, is_offset = F.size("nums"), F.col("label").isin(*offsets)
    prose = F.lower("label").startswith("the ") | F.lower("label").startswith("section ")
    kind = F.when(opens | F.col("line").rlike(_LEADER), None).when((n >= 3) & F.col("label").rlike("^TOTAL"), "total").when((n >= 3) & ~prose, "value").when((n == 2) & is_offset, "value").when((n == 1) & ~fx.is_upper(F.col("label")) & (F.col("label") != ""), "mark")
    rows = rows.withColumn("kind", kind).filter("kind IS NOT NULL AND account_no > 0")
    before = F.last(F.when(F.col("kind") != "mark", F.struct("row_ord", "kind")), ignorenulls=True).over(_w("report_id", "account_no"))
    rows = rows.withColumn("_row", before).withColumn("on_row", F.when(F.col("_row.kind") == "value", F.col("_row.row_ord")))
    last_total = F.max(F.when(F.col("kind") == "total", F.col("row_ord"))).over(W.partitionBy("report_id", "account_no"))
    rows = rows.withColumn("last_total", last_total).filter("(kind <> 'total' OR row_ord = last_total) AND (kind <> 'mark' OR on_row IS NOT NULL)")
    code = F.regexp_extract("label", _CODE, 1)
    coded = (F.col("kind") == "value") & ~is_offset & (code.rlike(r"\d") | (F.length(code) >= 4))
    return rows.select(
        "report_id", "row_ord", "title", "account_no", "account", F.when(coded, code).alias("code"), F.when(coded, fx.strip(F.regexp_extract("label", _CODE, 2))).otherwise(F.col("label")).alias("label"), "kind",
        F.when(F.col("kind") == "mark", F.col("on_row")).alias("marks_row"), F.transform("nums", lambda x: F.replace(x, F.lit(","), F.lit("")).cast("bigint")).alias("amounts"),
    )


def item_lines(pages: DataFrame, items: str = "items") -> DataFrame:
    """Page-reader items (report_id, page, items) as ledger rows; a title resets the department, and both carry over pages."""
    rows = pages.select("report_id", "page", F.posexplode(items).alias("pos", "i")).select("report_id", "page", "pos", "i.*")
    rows = rows.withColumn("row_ord", F.row_number().over(W.partitionBy("report_id").orderBy("page", "pos")) - 1)
    text = fx.strip(F.coalesce("text", F.lit("")))
    title = text.rlike(r"^TITLE\s+[IVXLC]+")
    dept = ~title & fx.is_upper(text) & (F.col("indent") < 2) & ~F.coalesce("is_subtotal", F.lit(False))
    rows = structure.fill_context(rows, [("title_name", F.when(title, text)), ("department", F.when(dept, text))])
    amounts = {c: fx.parse_dollar(F.coalesce(f"col{i + 1}", F.lit("")), True, paren_negative=False) for i, c in enumerate(AMOUNTS)}
    level = F.when(title, fx.TITLE).when(dept, fx.DEPARTMENT).when(F.col("indent") <= 0, fx.ACCOUNT).when(F.col("indent") <= 1, fx.PROGRAM).otherwise(fx.SUBPROGRAM)
    out = rows.withColumn("line_item_text", text).withColumn("hierarchy_depth", level).withColumns(amounts)
    return out.withColumn("is_memo", fx.is_paren_memo(F.col("committee_recommendation"))).select("report_id", "page", "row_ord", "title_name", "department", "line_item_text", "hierarchy_depth", *AMOUNTS, F.coalesce("is_subtotal", F.lit(False)).alias("is_subtotal"), "is_memo", (F.col("page") * 100).alias("line_number"))


def read_pages(images: DataFrame, reader, schema: str) -> DataFrame:
    """Page images through a reader, a function from an iterator of pandas frames to one of frames of `schema`. Tests inject one; no network is used here."""
    return images.mapInPandas(reader, schema)


def has_large_image(images: Column) -> Column:
    """Some image of a page is over 200 by 200."""
    return F.coalesce(F.exists(images, lambda i: (i["w"] > 200) & (i["h"] > 200)), F.lit(False))


def page_kind(raw: Column) -> Column:
    """What an answer holds: rows of a comparative table, another table only (non_comparative), or none (empty_failed)."""
    return fx.once(latex.tables(F.coalesce(raw, F.lit(""))), lambda found: F.when(latex.has_items(found), "rows").when(F.size(found) > 0, "non_comparative").otherwise("empty_failed"))


def is_text_layer(pages: DataFrame) -> DataFrame:
    """Reports without any large image (over 200 by 200) that show a marker: (report_id, page, images array<struct<w,h>>, page_text)."""
    return pages.groupBy("report_id").agg((~F.max(has_large_image(F.col("images"))) & F.max(F.coalesce(F.col("page_text").rlike(ANCHOR + "|EXPLANATION OF PROJECT LEVEL ADJUSTMENTS"), F.lit(False)))).alias("is_text"))


def suspect_pages(rows: DataFrame, recalled: DataFrame, pages: DataFrame) -> DataFrame:
    """Pages to read again: with a failed row, without rows, or named by recall."""
    failed = rows.filter("status = 'fail'").select("report_id", "page")
    empty = pages.select("report_id", "page").join(rows.select("report_id", "page"), ["report_id", "page"], "left_anti")
    return failed.union(empty).union(recalled.select("report_id", "page")).distinct()


def merge_pages(rows: DataFrame, again: DataFrame) -> DataFrame:
    """rows with the pages that `again` has replaced as wholes, and `place`: the row's number within its report, by page and then row_ord."""
    kept = rows.join(again.select("report_id", "page").distinct(), ["report_id", "page"], "left_anti").unionByName(again)
    return kept.withColumn("place", F.row_number().over(W.partitionBy("report_id").orderBy("page", "row_ord")))


def route(reports: DataFrame) -> DataFrame:
    """Which extractor a report takes."""
    kind: Column = F.when(F.col("stage") == "enacted", "enacted").when(F.col("chamber") == "senate", "fixed_width").when(F.coalesce("is_text", F.lit(False)), "typeset").otherwise("pages")
    return reports.withColumn("route", kind)
