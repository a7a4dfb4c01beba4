"""Queries and operators whose cost must follow the input: what they did too often, or kept too much of."""

import io
import os
import re
import zipfile
from pathlib import Path

import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from ledgerloom.functions import latex
from ledgerloom.functions import text as fx
from ledgerloom.operators import extract, reconcile, structure
from ledgerloom.plans import exchange, extraction
from ledgerloom.sinks import versions, writers
from ledgerloom.sources import ledger as sources
from ledgerloom.sources import workspace


def test_cached_files_are_packed(spark, monkeypatch):
    """The query's files lie many to a pack, not in a folder for each report."""
    folders = []
    monkeypatch.setattr(exchange, "new_folder", lambda s, name: folders.append(workspace.new_folder(s, name)) or folders[-1])
    rows = exchange.cached_files(spark, SMALL).count()
    files = sum(len(f) for _, _, f in os.walk(folders[0]))
    assert rows > 0 and files < rows


def test_packs_and_single_files(spark, tmp_path):
    single = tmp_path / "118" / "house" / "a.pdf"
    single.parent.mkdir(parents=True)
    single.write_bytes(b"%PDF one")
    writers.write_packs(spark.createDataFrame([(118, "senate", "b", bytearray(b"%PDF two!")), (118, "senate", "c", bytearray(b"no pdf"))], "congress int, chamber string, report_id string, content binary"), str(tmp_path), "pdf")
    got = sources.cached_files(spark, str(tmp_path), "pdf").orderBy("report_id").select("congress", "chamber", "report_id", "length", F.sha2("content", 256) == F.col("sha256")).collect()
    assert [tuple(r) for r in got] == [("118", "house", "a", 8, True), ("118", "senate", "b", 9, True)]
    assert Path(tmp_path / "packs-pdf").is_dir()


def plan(rows) -> str:
    """The optimized plan."""
    return rows._jdf.queryExecution().optimizedPlan().toString()


def test_page_kinds_read_a_table_once(spark):
    """An answer is taken apart once, whatever is asked of it; kinds stay those of the items."""
    table = r"\begin{tabular}{lrr} Item & 1996 Enacted & Bill \\ "
    raws = [table + r"a & 1 & 2 \\ \end{tabular}", table + r"\end{tabular}", r"\begin{tabular}{lr} Item & Count \\ a & 1 \\ \end{tabular}", "", None, table + r"302(b) & 1 & 2 \\ \end{tabular}"]
    rows = spark.createDataFrame(list(enumerate(raws)), "k int, raw string")
    kinds = rows.select("k", extract.page_kind(F.col("raw")).alias("kind"), F.size(latex.comparative_items(F.coalesce("raw", F.lit("")))).alias("n"))
    assert [(r["kind"], r["n"]) for r in kinds.orderBy("k").collect()] == [("rows", 1), ("non_comparative", 0), ("non_comparative", 0), ("empty_failed", 0), ("empty_failed", 0), ("non_comparative", 0)]
    assert plan(rows.select(extract.page_kind(F.col("raw")).alias("kind"))).count("regexp_extract_all") == 1


def test_header_is_read_once_a_table(spark):
    rows = spark.createDataFrame([(r"\begin{tabular}{lrrr} Item & 1996 Enacted & Request & Bill \\ a & 1 & & 3 \\ \end{tabular}",)], "raw string")
    items = rows.select(F.explode(latex.comparative_items(F.col("raw"))).alias("i")).select("i.*")
    assert [tuple(r) for r in items.collect()] == [("a", 0, False, "1", None, "3", None, None)]
    assert plan(items).count("compared") <= 6  # twice a reading of the header, which was read some twenty times


def test_amounts_are_matched_once(spark):
    cases = [("(1,234)", True, -1234), ("(1,234)", False, 1234), ("(+5)", True, 5), ("-$7", True, -7), ("($12)", True, -12), ("(3", True, 3), ("- - -", True, None), ("....", True, None), ("", True, None), (None, True, None), (" x +1,0 2", False, 10), (",", False, None)]
    for raw, negative, value in cases:
        rows = spark.createDataFrame([(raw,)], "raw string").select(fx.parse_dollar(F.col("raw"), True, paren_negative=negative).alias("a"))
        assert rows.first()["a"]["value"] == (None if value is None else 1000 * value), raw
    rows = spark.createDataFrame([("1",)], "raw string").filter("raw <> ''").select(fx.parse_dollar(F.col("raw"), paren_negative=False).alias("a"))
    assert plan(rows).lower().count("regexp_extract") + plan(rows).count("RLIKE") <= 1


def test_nearest_heading_in_one_pass(spark):
    lines = [(0, "     Salaries and expenses"), (1, "OFFICE OF WORKS"), *[(k, "x") for k in range(2, 40)]]
    rows = spark.createDataFrame([("r", *x) for x in lines], "report_id string, row_ord int, line string")
    got = structure.nearest_heading(rows)
    found = {r["row_ord"]: r["heading"] for r in got.collect()}
    assert found[0] is None and found[15] == "Salaries and expenses" and found[16] == "OFFICE OF WORKS" and found[31] == "OFFICE OF WORKS" and found[32] is None
    assert "RowFrame, -15" not in plan(got) and "RowFrame, -30" not in plan(got)


def test_typeset_rows_without_names(spark):
    """What no one asks for isn't made: rows without accounts' names don't collect the lines above them. Wrapped totals need one order only."""
    text = ["WATER,", "AND WORKS", f"The committee {extract.ANCHOR} all:", "Pumps 1,000 2,000 +1,000", "Minor change 5", "TOTAL, WATER 1", "2 3", "TOTAL, A", "TOTAL, B", "TOTAL, C 7 8 9"]
    rows = spark.createDataFrame([("r", k, line) for k, line in enumerate(text)], "report_id string, row_ord int, line string")
    found = extract.typeset_statement(rows)
    got = [(r["row_ord"], r["account"], r["kind"], r["label"], r["amounts"]) for r in found.orderBy("row_ord").collect()]
    assert got == [(3, "WATER, AND WORKS", "value", "Pumps", [1000, 2000, 1000]), (4, "WATER, AND WORKS", "mark", "Minor change", [5]), (9, "WATER, AND WORKS", "total", "TOTAL, C", [7, 8, 9])]
    assert "collect_list" not in plan(found.select("report_id", "account_no", "kind", "label", "amounts"))
    assert plan(structure.merge_wrapped_totals(rows)).count("+- Sort") <= 1 and "_run" not in plan(structure.merge_wrapped_totals(rows))


def test_routes_and_turns_need_no_totals(spark):
    """Neither a sort of all rows for a largest text nor the aggregation of totals, whose pages are those of their line items."""
    from ledgerloom.plans.registry import QUERIES

    for name in ("routes", "work_order"):
        rows = QUERIES[name](spark, SMALL)
        if name == "routes":  # what is sorted has a few rows a report
            assert re.search(r"[^t]HashAggregate\(keys=\[report_id#\d+, stage#\d+, chamber#\d+\]", rows._jdf.queryExecution().executedPlan().toString())
        assert "Union" not in plan(rows)


def test_versions_read_their_rows_once(spark, tmp_path):
    """The rows of a version are made for its files alone, and a late writer is refused before anything is compared."""
    seen = spark.sparkContext.accumulator(0)

    def counted(frames):
        for frame in frames:
            seen.add(len(frame))
            yield frame

    rows = spark.range(40).selectExpr("id", "cast(id % 4 as int) AS part", "id AS v")
    path = str(tmp_path / "table")
    versions.create(rows.mapInPandas(counted, rows.schema), path, "part")
    assert seen.value == 40
    changed = lambda k: versions.read(spark, path, "part", 1).withColumn("v", F.when(F.col("part") == k, F.col("v") + 1).otherwise(F.col("v")))
    versions.change(changed(2), path, "part", ["id"], ["v"], base=1)
    now = versions.read(spark, path, "part", with_version=True)
    assert {(r["part"], r["written_in"], r["n"]) for r in now.groupBy("part", "written_in").agg(F.count("*").alias("n")).collect()} == {(0, 1, 10), (1, 1, 10), (2, 2, 10), (3, 1, 10)}
    seen.value = 0
    late = changed(3)
    with pytest.raises(versions.Refused):
        versions.change(late.mapInPandas(counted, late.schema), path, "part", ["id"], ["v"], base=1)
    assert seen.value == 0


def test_ledger_by_report_is_the_ledger(spark):
    a, b = sources.ledger(spark, SMALL), sources.ledger_by_report(spark, SMALL)
    assert a.schema.simpleString() == b.schema.simpleString() and b.count() > 0
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_proof_formulas_reconcile_once(spark):
    """Totals were searched for once for each use, beside a stored ledger; now the ledger is derived and searched once."""
    found = plan(exchange.proof_formulas(spark, SMALL))
    assert found.count("FlatMapGroupsInArrow") == 1 and found.count("row_ord#") > 0 and "Join LeftOuter" not in found


def test_proof_formula_has_ranges_by_column(spark):
    rows = spark.createDataFrame([([1, 2, 4, 6, 5], [False, False, True, True, True]), ([3], [False]), ([], [])], "children array<bigint>, rollups array<boolean>")
    got = [r[0] for r in rows.select(writers.proof_formula(F.col("children"), F.col("rollups"))).collect()]
    assert got == ["=SUM(C2:C3,D5:D7)", "=SUM(C4)", "=0"]


def test_proof_rows_move_rows_once(spark):
    """Rows were joined three times to what totals say of them; one pass over each report finds it, and totals without rows of their own change nothing."""
    rows = spark.createDataFrame([("r", 1, "(oak)", False, True, 5), ("r", 2, "(ash)", False, True, 7), ("r", 3, "Total", True, False, 12), ("r", 4, "(elm)", False, True, 9)], "report_id string, row_ord int, line_item_text string, is_subtotal boolean, is_memo boolean, committee_recommendation bigint")
    totals = spark.createDataFrame([("r", 3, "included", [1, 2], [False, False])], "report_id string, row_ord bigint, memo_mode string, children array<bigint>, rollups array<boolean>")
    proof = writers.proof_rows(rows, totals)
    assert [(r["leaf"], r["rollup"], r["formula"]) for r in proof.orderBy("row_ord").collect()] == [(5, None, None), (7, None, None), (None, 12, "=SUM(C2:C3)"), (None, None, None)]
    assert "Join" not in plan(proof)


def test_workbooks_of_rows_beside_their_verdicts(spark):
    """Rows and totals were stored, met again for the proof and once more for the files, whose rows Python made one by one; now a report's rows are searched in place and become elements as expressions."""
    labels = [("oak <1> & co", False, False, 10), ("(of which)", False, True, 5), ("Total, x", True, False, 15), ("ash", False, False, None), ("", False, False, 7), ("Total", True, False, 23), ("Total, y", True, False, None)]
    rows = [(r, i, t, s, m, v, *[None] * 4) for r, n in (("r", 7), ("s", 2)) for i, (t, s, m, v) in enumerate(labels[:n], 1)]
    rows = spark.createDataFrame(rows, "report_id string, row_ord int, line_item_text string, is_subtotal boolean, is_memo boolean, committee_recommendation bigint, prior_year_enacted bigint, budget_estimate bigint, delta_vs_enacted bigint, delta_vs_estimate bigint")
    totals = reconcile.reconcile(rows)
    proof = writers.proof_of(reconcile.reconcile_in_place(rows))
    cells = ("report_id", "row_ord", "label", "leaf", "rollup", "formula")
    got = [tuple(r) for r in proof.select(*cells).orderBy("report_id", "row_ord").collect()]
    assert got == [tuple(r) for r in writers.proof_rows(rows, totals).select(*cells).orderBy("report_id", "row_ord").collect()]
    assert got[:3] == [("r", 1, "oak <1> & co", 10, None, None), ("r", 2, "(of which)", 5, None, None), ("r", 3, "Total, x", None, 15, "=SUM(C2:C3)")]
    one, two = (dict(df.collect()) for df in (writers.workbooks(proof), writers.workbooks(writers.proof_rows(rows, totals), totals)))
    assert one == two and sorted(one) == ["r", "s"]
    said = lambda report, k: zipfile.ZipFile(io.BytesIO(one[report])).read(f"xl/worksheets/sheet{k}.xml").decode()
    assert '<row r="2"><c r="A2"><v>1</v></c><c r="B2" t="inlineStr"><is><t xml:space="preserve">oak &lt;1&gt; &amp; co</t></is></c><c r="C2"><v>10</v></c></row>' in said("r", 1)
    assert "<f>Proof!E4</f></c><c r=\"E2\"><f>C2-D2</f></c><c r=\"F2\"><v>2</v></c>" in said("r", 2) and "Totals: 3<" in said("r", 3) and "none can be checked" in said("s", 3)
    found = plan(exchange.proof_sheets(spark, SMALL))
    assert found.count("FlatMapGroupsInArrow") == 2 and "CoGroup" not in found


def test_enacted_statements_in_one_order(spark):
    """Line items were derived twice, pages printed twice and joined to their rows, and labels taken off by patterns; now a report's lines stay in place in one order."""
    found = plan(extraction.enacted_statements(spark, SMALL))
    assert found.count("lineitem.parquet") <= 1 and found.count("posexplode") == 1 and "LeftOuter" not in found and found.count("l_linenumber#") > 0
    lines = ["DIVISION B--ACTS", "[In thousands of dollars]", "Request   Final", "Bill", "OLD OFFICE", "", "FIRST OFFICE", "SECOND OFFICE", "OAKS 1 ,500 $2,000", "oaks 7,000", "ASHES. . .. 3,000", "Total, wood..... 4,500", "ELMS\r1,000 2,000", "12"]
    pages = spark.createDataFrame([("r", 1, i, t) for i, t in enumerate(lines)] + [("r", 2, 0, "Total 9,000")], "report_id string, page int, row_ord int, line string")
    rows = extract.enacted_statement(pages, with_page=True)
    text = spark.createDataFrame([("r", 1, "\n".join(lines)), ("r", 2, "Total 9,000")], "report_id string, page int, page_text string")
    one, two = (r.orderBy("page", "row_ord").select("division", "account", "label", "request", "enacted", "is_subtotal", "verified") for r in (extract.verbatim(rows), extract.verbatim(extract.enacted_statement(pages), text)))
    got = [tuple(r) for r in one.collect()]
    office = "FIRST OFFICE / SECOND OFFICE"
    assert got == [tuple(r) for r in two.collect()]
    assert got[0] == ("B", office, "OAKS", 1_500_000, 2_000_000, False, False) and got[1] == ("B", office, "ASHES", None, 3_000_000, False, True)
    assert got[2][2:] == ("Total, wood", None, 4_500_000, True, True) and got[3][2:5] == ("ELMS", 1_000_000, 2_000_000) and got[4] == ("B", None, "Total", None, 9_000, True, True) and len(got) == 5


def test_label_before_is_what_the_patterns_leave(spark):
    odd = ["OAK TREE 1,000 2,000", "Total, x..... $1,000", "1,234", "a . 12,345,678 b", "a\r1,000\rb", "b. 1,000\u2028c", "x\u2028 9,000", "tab\t. 5,000 ", "no 1", "12,34 51,234 1,234", "b .\u0085 1,000"]
    amount, rest = r"(\$?\d{1,3}(?:,\d{3})+)", r"\$?\d{1,3}(?:,\d{3})+.*$"
    rows = spark.createDataFrame([(t,) for t in odd], "t string").withColumn("s", fx.strip(F.col("t"))).withColumn("nums", F.regexp_extract_all("s", F.lit(amount), 1)).filter("size(nums) > 0")
    want = fx.strip(F.regexp_replace(F.regexp_replace("s", rest, ""), r"[.\s]+$", ""))
    got = rows.select("t", fx.label_before(F.col("s"), F.get("nums", 0), rest).alias("got"), want.alias("want")).collect()
    assert len(got) == 10 and [r["got"] for r in got] == [r["want"] for r in got]


def test_indent_leaves_come_with_their_blocks(spark):
    """Line items were joined to their blocks, and those to their totals; carried columns come along."""
    rows = spark.createDataFrame([("r", 1, "oak", False, 5, True), ("r", 2, "ash", False, 7, None), ("r", 3, "Total, wood", True, 7, False)], "report_id string, row_ord int, line_item_text string, is_subtotal boolean, committee_recommendation bigint, is_memo boolean")
    rows = rows.selectExpr("*", "1 AS page", "CAST(NULL AS string) AS account", "CAST(NULL AS bigint) AS budget_estimate", "CAST(NULL AS bigint) AS prior_year_enacted")
    leaves = structure.indent_leaves(rows, carry=("is_memo",))
    got = leaves.orderBy("leaf").select("letter", "leaf", "row_ord", "name", "label", "committee_recommendation", "t_committee_recommendation", "is_memo").collect()
    assert [tuple(r) for r in got] == [("A", 1, 1, "wood", "oak", 5, 7, True), ("A", 2, 2, "wood", "ash", 7, 7, None)]
    assert "Join" not in plan(leaves)


def test_recall_meets_names_not_accounts(spark):
    """Accounts of one name met each row's name on their own, with both lists of words in the groups' keys."""
    from ledgerloom.operators import crosswalk

    rows = spark.createDataFrame([("r", "Total, oak wood", 5), ("r", "red ash tree", None)], "report_id string, line_item_text string, committee_recommendation bigint")
    accounts = spark.createDataFrame([("r", 1, "oak wood", None), ("r", 2, "oak wood", 5), ("r", 3, "ASH tree", None), ("r", 4, "elm", 6), ("s", 5, "oak wood", 5)], "report_id string, account_id int, name string, value bigint")
    found = crosswalk.audit_recall(rows, accounts)
    assert [tuple(r) for r in found.orderBy("account_id").select("account_id", "found_by").collect()] == [(1, "name"), (2, "value"), (3, "contained"), (4, "missing"), (5, "missing")]
    pairs = next(line for line in plan(found).splitlines() if "Aggregate" in line and "both#" in line)
    assert "account_id" not in pairs and "words#" not in pairs


def executed(rows) -> str:
    """The physical plan, before it is adapted."""
    return rows._jdf.queryExecution().executedPlan().toString()


def test_ledger_by_report_moves_what_is_read(spark):
    """Every column of a line item went to its report; names that no one reads now stay where they are, and orders meet customers before their lines."""
    rows = sources.ledger_by_report(spark, SMALL).select("report_id", "row_ord", "pk", "committee_recommendation")
    found = executed(rows)
    assert not [c for c in ("p_name", "p_type", "p_brand", "l_tax") if c in found] and "l_discount" not in found
    orders = next(x for x in found.splitlines() if "Join" in x and "o_custkey" in x)  # lines don't move to their customers
    assert "l_orderkey" not in orders


def test_ledger_by_report_of_odd_rows(spark, tmp_path):
    """Prices of no whole cents, missing values, orders, parts and nations that stand twice or not at all."""
    li = [(1, 1, 7, 1, 2.0, 10.004, 0.05, 0.02, "R"), (1, 1, 7, 1, 2.0, 10.001, 0.05, 0.02, "R"), (1, 9, 7, 2, 1.0, 3.0, 0.0, 0.0, "N"), (1, 3, 8, 3, 1.0, 5.5, None, 0.08, None), (2, 2, 7, 1, 4.0, None, 0.1, 0.0, "A"), (2, 3, 7, 2, 4.0, 0.0, 0.1, 0.0, "R"), (9, 1, 7, 1, 1.0, 1.0, 0.0, 0.0, "A"), (150001, 2, 7, 1, 1.0, 77.77, 0.01, 0.01, "R")]
    tables = {
        "lineitem": spark.createDataFrame([(*x, "O") for x in li], "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string").withColumn("l_shipdate", F.lit("1996-01-02").cast("timestamp")),
        "orders": spark.createDataFrame([(1, 5, "F", "1996-12-31"), (2, 6, None, "1997-10-01"), (2, 5, "O", "1997-09-30"), (150001, 5, "F", "1996-01-01")], "o_orderkey bigint, o_custkey bigint, o_orderstatus string, d string").withColumn("o_orderdate", F.col("d").cast("timestamp")),
        "customer": spark.createDataFrame([(5, 1, "WATER"), (6, 2, None)], "c_custkey bigint, c_nationkey int, c_mktsegment string"),
        "nation": spark.createDataFrame([(1, "A", 0), (2, "B", 1), (2, "C", 3)], "n_nationkey int, n_name string, n_regionkey int"),
        "part": spark.createDataFrame([(1, "oak", "x", "b"), (2, "ash", "y", "b"), (3, "elm", "x", "c"), (3, "fir", "z", None)], "p_partkey bigint, p_name string, p_type string, p_brand string"),
    }
    for name, rows in tables.items():
        rows.write.parquet(f"{tmp_path}/{name}.parquet")
    a, b = ([tuple(r) for r in f(spark, str(tmp_path)).drop("row_ord", "account", "line_item_text", "code").collect()] for f in (sources.ledger, sources.ledger_by_report))
    assert len(a) > 12 and sorted(map(repr, a)) == sorted(map(repr, b))


def test_fact_moves_its_rows_once(spark):
    """The fact's rows went to their restatements and then into their order, and its inline records derived the ledger again."""
    from ledgerloom.plans import combined

    found = executed(combined._fact(spark, SMALL).orderBy("report_id", "row_ord"))
    assert found.count("rangepartitioning") == 1 and "lineitem.parquet" not in found
    assert not [x for x in found.splitlines() if "Join" in x and "row_ord#" in x]


def test_corroborated_without_pairs(spark):
    """Rows and records of a frequent amount met one by one."""
    from ledgerloom.operators import crosswalk

    rows = spark.createDataFrame([("r", 1, "Water works", 5, None, None), ("r", 2, "water", None, 5, 5), ("r", 3, "fire", 5, 5, 5), ("s", 1, "water", 5, 5, 5), ("r", 4, "water", 6, None, None), (None, 5, "water", 5, 5, 5)], "report_id string, row_ord int, line_item_text string, prior_year_enacted bigint, budget_estimate bigint, committee_recommendation bigint")
    inline = spark.createDataFrame([("r", "Water", [5, None, 5]), ("r", "of it", [6]), (None, "water", [5]), ("s", "fire", [5])], "report_id string, label string, amounts array<bigint>")
    found = crosswalk.corroborated(rows, inline, ("line_item_text",))
    assert sorted(map(tuple, found.collect())) == [("r", 1), ("r", 2)]
    assert "Join" not in plan(found)


def test_fact_is_written_compressed(spark, tmp_path):
    from ledgerloom.operators import fact
    from ledgerloom.plans import combined
    from ledgerloom.schema import FACT

    counts = fact.write_fact(combined._fact(spark, SMALL), str(tmp_path / "fact"))
    files = [f for f in os.listdir(tmp_path / "fact") if f.startswith("part-")]
    assert files and all(f.endswith(".csv.gz") for f in files)
    back = sources.csv_fact(spark, str(tmp_path / "fact"), fact.WHOLE, place="place").orderBy("place").select("place", *FACT).collect()
    assert len(back) == counts["n_rows"] and [r["report_id"] for r in back] == sorted(r["report_id"] for r in back)


def in_place(rows) -> bool:
    """The ledger is derived once, and what follows works on its reports where they are."""
    found = executed(rows)
    return found.count("lineitem.parquet") == 1 and "Exchange hashpartitioning(report_id#" not in found


def test_inline_tables_read_lines_in_place(spark):
    """Whole texts were gathered, sorted and cut again, moved and put into three orders with all of their lines."""
    rows = extraction.inline_tables(spark, SMALL)
    assert in_place(rows) and "collect_list" not in plan(rows) and "island" not in plan(rows)


def test_inline_tables_blocks(spark):
    """A second start goes on with its block, lines before a start don't count, and what interrupts a block ends it."""
    a, b, c, d = "Recommended in the bill....... 7", "Appropriation, fiscal year 1996.... $1,000", "Bill compared with:", "    Appropriation, fiscal year 1996..... +5"
    text = ["OLD OFFICE", a, b, a, c, d, "", "", d, "words", d, b, b, a, None, c, b, "words", b]
    rows = spark.createDataFrame([("r", k, t) for k, t in enumerate(text)], "report_id string, row_ord int, line string")
    kinds = ("prior_year", "committee_recommendation", "delta_vs_enacted")
    got = extract.inline_tables(rows).orderBy("line_number").select("line_number", "heading", *[F.col(k)["value"] for k in kinds]).collect()
    assert [tuple(r) for r in got] == [(3, "OLD OFFICE", 1000, 7, 5), (11, "OLD OFFICE", 1000, 7, None)]


def test_inline_csv_reads_lines_in_place(spark):
    assert in_place(extract.inline_tables(exchange._inline(spark, SMALL)))


def test_typeset_accounts_in_place(spark):
    assert in_place(extraction.typeset_accounts(spark, SMALL))


def test_typeset_marks_in_place(spark):
    """Marks were joined to their rows, for which all was derived and read twice."""
    rows = extraction.typeset_marks(spark, SMALL)
    assert in_place(rows) and "marks_row" not in "".join(x for x in executed(rows).splitlines() if "Join" in x)


def test_typeset_deliverables_in_place(spark):
    """Marks were joined to their rows; a row keeps all of its marks, and a mark without a row goes nowhere."""
    assert in_place(writers.typeset_deliverables(extract.typeset_statement(exchange._typeset(spark, SMALL)))[0])
    rows = [("r", 1, 1, "A", "value", "x", None, [1, 2, 3]), ("r", 2, 1, "A", "mark", "m2", 1, [5]), ("r", 3, 1, "A", "mark", "m1", 1, [6]), ("r", 4, 1, "A", "total", "t", None, [7]), ("r", 9, 1, "A", "mark", "lost", 8, [1]), ("r", 10, 1, "A", "mark", "none", None, [1]), ("r", 5, 2, None, "value", "y", None, [4])]
    found = spark.createDataFrame(rows, "report_id string, row_ord int, account_no bigint, account string, kind string, label string, marks_row int, amounts array<bigint>").withColumn("code", F.lit(None).cast("string"))
    nested, items, marks = writers.typeset_deliverables(found)
    got = {r["account_no"]: [(x["row_ord"], [tuple(m) for m in x["marks"]]) for x in r["rows"]] for r in nested.collect()}
    assert got == {1: [(1, [("m1", 6), ("m2", 5)]), (4, [])], 2: [(5, [])]} and items.count() == 3 and marks.count() == 4


def test_pages_are_made_in_place(spark):
    """Pages were gathered from a ledger that was derived twice, and moved for that."""
    assert in_place(extraction._latex(spark, SMALL, F.lit(""), F.col("line_item_text"), "l"))


def test_triples_meet_no_rows(spark):
    """Rows and triples of an equal amount met one by one, each moved with every amount; now groups by one, two and three amounts say it, missing ones too."""
    from ledgerloom.operators import verify
    from ledgerloom.plans import accounts

    assert in_place(accounts.matched_triples(spark, SMALL))
    schema = "report_id string, {}prior_year_enacted bigint, budget_estimate bigint, committee_recommendation bigint"
    rows = spark.createDataFrame([("r", 1, 2, 3), ("r", 1, 5, 6), ("r", 4, None, 6), ("s", 7, 8, 9)], schema.format(""))
    triples = [("r", 1, 1, 2, 3), ("r", 2, 1, 9, 6), ("r", 3, 3, 1, 2), ("r", 4, None, None, None), ("r", 5, 4, None, 6), ("s", 6, 1, 2, 3), ("t", 7, None, None, None), ("r", 8, 1, 2, 6), (None, 9, 1, 2, 3)]
    found = verify.matched_triples(rows, spark.createDataFrame(triples, schema.format("triple_id int, ")))
    got = {r["triple_id"]: (r["score"], r["verdict"]) for r in found.collect()}
    assert got == {1: (3, "EXACT"), 2: (2, "PARTIAL"), 3: (0, "MISSING"), 4: (1, "PARTIAL"), 5: (3, "EXACT"), 6: (0, "MISSING"), 7: (0, "MISSING"), 8: (2, "PARTIAL"), 9: (0, "MISSING")}
    assert "Join" not in plan(found)


@pytest.mark.parametrize("name, most", [("prose_verdicts", 9), ("enrich_accounts", 7), ("inline_corroboration", 8)])
def test_kept_columns(spark, monkeypatch, name, most):
    """The whole ledger was stored, and derived twice for that; now it is the columns that the query reads."""
    from ledgerloom.plans import base
    from ledgerloom.plans.registry import QUERIES

    seen = []
    monkeypatch.setattr(base, "stored", lambda df, what: seen.append(df) or workspace.stored(df, what))
    QUERIES[name](spark, SMALL)
    assert len(seen) == 1 and len(seen[0].columns) <= most and executed(seen[0]).count("lineitem.parquet") == 1
