"""The ledger's operators on stated facts and against the registered SQL."""

import io
import itertools
import random
import re
import zipfile
from xml.etree import ElementTree

import duckdb
import numpy as np
import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from ledgerloom import cli
from ledgerloom.functions import latex
from ledgerloom.functions import text as fx
from ledgerloom.operators import crosswalk, extract, query, reconcile, similar, structure, trace, verify
from ledgerloom.plans import registry
from ledgerloom.schema import AMOUNTS
from ledgerloom.sinks import versions, writers
from ledgerloom.sources import catalog_api, workspace
from ledgerloom.sources import ledger as sources
from ledgerloom.streaming import refresh


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "benchmark"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_against_sql(spark, con, name):
    got = registry.QUERIES[name](spark, SMALL)
    cursor = con.execute(registry.ORACLES[name])
    names = [c[0] for c in cursor.description]
    assert sorted(names) == sorted(got.columns)
    assert sorted(map(repr, map(tuple, got.select(*names).collect()))) == sorted(map(repr, cursor.fetchall()))


def lines(spark, text, report="r"):
    return sources.lines_of(spark.createDataFrame([(report, text)], "report_id string, text string"))


def one(spark, value, *columns):
    return spark.createDataFrame([(value,)], "v string").select(*columns).first()


STATEMENT = "report_id string, row_ord int, line_item_text string, is_subtotal boolean, is_memo boolean, " + ", ".join(f"{c} bigint" for c in AMOUNTS)


def statement(spark, *items):
    """(label, is_total, is_memo, recommendation, other amounts) rows of one report each."""
    rows = []
    for k, group in enumerate(items):
        for i, (label, total, memo, value, *more) in enumerate(group):
            amounts = dict.fromkeys(AMOUNTS) | {"committee_recommendation": value} | (more[0] if more else {})
            rows.append((f"r{k}", i, label, total, memo, *amounts.values()))
    return spark.createDataFrame(rows, STATEMENT)


def verdicts(spark, *items):
    got = reconcile.reconcile(statement(spark, *items)).orderBy("report_id", "row_ord").collect()
    return [[r for r in got if r["report_id"] == f"r{k}"] for k in range(len(items))]


def test_reconciler_modes(spark):
    one_memo, nested, big, none = verdicts(
        spark,
        [("rent", False, True, 24), ("pay", False, False, 134), ("Total, house", True, False, 158)],
        [("oak", False, False, 10), ("of which", False, True, 5), ("Total", True, False, 10), ("ash", False, False, 7), ("Subtotal, wood", True, False, 7), ("(Total, land)", False, False, 17)],
        [("oak", False, None, 2**60 + 1), ("ash", False, False, 2**60), ("Total", True, None, 2**61 + 1)],
        [("oak", False, False, 10)],
    )
    assert [(t["status"], t["memo_mode"], t["children"]) for t in one_memo] == [("ok", "included", [0, 1])] and none == []
    assert [t["status"] for t in nested] == ["ok"] * 3 and nested[2]["children"] == [2, 4]
    assert [(t["status"], t["computed"]) for t in big] == [("ok", 2**61 + 1)]  # beyond what a double holds


def test_reconciler_failures(spark):
    unchecked, small, partial, view, alone, zero, memos = verdicts(
        spark,
        [("oak", False, False, 10), ("Total, n", True, False, None), ("Total, m", True, False, 10)],
        [("oak", False, False, 199_000), ("Total", True, False, 200_000)],
        [("oak", False, False, None, {"prior_year_enacted": 4}), ("ash", False, False, 5), ("Total", True, False, 50)],
        [("oak", False, False, 1), ("Total, available this fiscal year", True, False, 50)],
        [("Total", True, False, 5)],
        [("Total", True, False, None, {"prior_year_enacted": 500, "delta_vs_enacted": -500})],
        [("oak", False, False, 3, {"prior_year_enacted": 2}), ("ash", False, False, 4), ("Total", True, False, 7, {"prior_year_enacted": 2})],
    )
    assert [t["status"] for t in unchecked] == ["unchecked", "ok"]
    assert (small[0]["status"], small[0]["delta"]) == ("off_by_small", -1000)
    assert partial[0]["status"] == "partial_read" and view[0]["status"] == "overlapping_view"
    assert (alone[0]["status"], alone[0]["computed"]) == ("unreconciled", 0)
    assert [t["printed"] for t in zero] == [0]
    assert memos[0]["checks"]["prior_year_enacted"].asDict() == {"printed": 2, "computed": 2, "complete": False} and not memos[0]["complete"]


def test_closing_run_against_brute_force():
    rng = random.Random(3)
    for _ in range(400):
        n = rng.randrange(7)
        value, firm = [rng.randrange(-3, 9) for _ in range(n)], [rng.random() < 0.6 for _ in range(n)]
        printed, best = rng.randrange(-3, 25), None
        for k in range(1, n + 1):
            for optional in (False, True):
                if (optional or any(firm[n - k :])) and (best is None or best[2] != 0):
                    gap = sum(v for v, f in zip(value[n - k :], firm[n - k :], strict=True) if f or optional) - printed
                    if best is None or abs(gap) < abs(best[2]):
                        best = k, optional, gap
        got = reconcile.closing_run(np.array(value, np.int64), np.array(firm, bool), printed)
        assert got == (best or (0, False, -printed))


def test_open_addends_against_brute_force():
    """Totals one after another, as in a report: each consumes its run, and is open itself."""
    rng = random.Random(8)
    for _ in range(60):
        open_, stack = reconcile.OpenAddends(), []
        for row in range(60):
            if rng.random() < 0.7 or not stack:
                value, firm = rng.randrange(-4, 12), rng.random() < 0.6
                open_.push(row, value, firm)
                stack.append((row, value, firm))
                continue
            printed, best = rng.randrange(-5, 40), None
            for k in range(1, len(stack) + 1):
                for optional in (False, True):
                    if optional or any(f for _, _, f in stack[-k:]):
                        gap = sum(v for _, v, f in stack[-k:] if f or optional) - printed
                        best = (abs(gap), k, optional, gap) if best is None or abs(gap) < best[0] else best
            _, k, optional, gap = best
            assert open_.close(printed) == (gap, optional, [r for r, _, f in stack[-k:] if f or optional])
            del stack[-k:]
            open_.push(row, printed, True)
            stack.append((row, printed, True))


def test_open_sums_against_brute_force():
    rng = random.Random(9)
    for _ in range(200):
        sums, stack = reconcile.OpenSums(), []
        for _ in range(40):
            if rng.random() < 0.75:
                value = rng.randrange(-3, 4)
                sums.push(value)
                stack.append(value)
            elif rng.random() < 0.5:
                top = rng.randrange(len(stack) + 1)
                sums.cut(top)
                del stack[top:]
            wanted, last = rng.randrange(-6, 9), rng.choice([None, rng.randrange(-1, 40)])
            runs = [(abs(sum(stack[k:]) - wanted), -k) for k in range(len(stack)) if last is None or k <= last]
            exact = [-k for gap, k in runs if gap == 0]
            assert sums.exact(wanted, last) == (max(exact) if exact else None)
            assert sums.nearest(wanted, last) == ((min(runs)[0], -min(runs)[1]) if runs else None)


def test_long_report_of_misses_is_quick():
    """Fifty thousand addends stay open under totals that all miss by little: near linear time, where a scan of the stack takes minutes."""
    import time

    began, open_ = time.time(), reconcile.OpenSums()
    for k in range(50_000):
        open_.push(3 * k + 1)
        if k % 5 == 4:
            assert open_.nearest(10**15)[1] == 0
    assert time.time() - began < 20


def test_typeset_totals(spark):
    rows = [("value", 1, 2), ("value", 3, 4), ("total", 4, 6), ("value", 5, 5), ("total", 5, 5), ("total", 9, 11), ("total", 1, 1), ("value", None, 2), ("total", 9, 13)]
    df = spark.createDataFrame([("r", i, *x) for i, x in enumerate(rows)], "report_id string, row_ord int, kind string, request bigint, recommendation bigint")
    assert [(r["row_ord"], r["outcome"]) for r in reconcile.typeset_totals(df).orderBy("row_ord").collect()] == [(2, "leaf"), (4, "leaf"), (5, "rollup"), (6, "bad"), (8, "bad")]


def test_audit_keeps_what_a_failure_left(spark):
    got = reconcile.audit(statement(spark, [("oak", False, False, 5), ("Total", True, False, 9), ("ash", False, True, 3), ("Total", True, False, 17)])).orderBy("row_ord").collect()
    assert [(r["printed"], r["verdict"]) for r in got] == [(9, "structural"), (17, "ok")]


def test_summary_flags(spark):
    labels = ["Real account", "Projection of outlays", "Discretionary", "1999", "(2) x", "", "2000 and future years", "302(b) table", "Land", "Mandatory"]
    df = spark.createDataFrame([("r", i, t) for i, t in enumerate(labels)], "report_id string, row_ord int, line_item_text string")
    got = [r["is_summary"] for r in structure.summary_flags(df).orderBy("row_ord").collect()]
    assert got == [False, True, True, True, True, True, True, True, False, False]


def test_block_inference_barrier_and_carry(spark):
    schema = "report_id string, row_ord int, line_item_text string, is_subtotal boolean, is_memo boolean, account string, prior_year_enacted long, budget_estimate long, committee_recommendation long"
    rows = [("a", False, 5), ("b", False, 6), ("Subtotal, X", True, 11), ("c", False, 4), ("Total, Y", True, 15), ("d", False, 1), ("Total, Z", True, 99), ("e", False, 2), ("Total", True, 2), ("f", False, 3), ("Total, W", True, 3)]
    df = spark.createDataFrame([("r", i, t, s, False, None, None, None, v) for i, (t, s, v) in enumerate(rows)], schema)
    got = {r["line_item_text"]: r["account_inferred"] for r in structure.infer_block_accounts(df).collect()}
    assert {k: got[k] for k in "abcdef"} == {"a": "X", "b": "X", "c": "Y", "d": None, "e": None, "f": "W"}
    over = structure.oversum_blocks(df.withColumn("committee_recommendation", F.when(F.col("row_ord") == 5, 500).otherwise(F.col("committee_recommendation")))).collect()
    assert [(r["name"], r["excess"]) for r in over] == [("Z", 416)]


def test_scalars(spark):
    v = F.col("v")
    assert one(spark, "Total. Joint Items :", fx.rollup_name(v))[0] == "Joint Items"
    assert one(spark, "Subtotal", fx.rollup_name(v), fx.is_subtotal_line(v), fx.is_rollup(F.lit(False), v)) == (None, True, False)
    assert one(spark, "FFICE OF THE CLERK", fx.repair_dropcap(v))[0] == "OFFICE OF THE CLERK"
    assert one(spark, "    Budget estimate, 2025", fx.label_type(v, fx.detect_indent(v), F.lit(True)))[0] == "delta_vs_estimate"
    assert one(spark, "(Dollars in thousands)", fx.is_thousands_marker(v))[0] and not one(spark, "thousands);", fx.is_thousands_marker(v))[0]
    assert one(spark, "134 ,529", fx.join_split_numbers(v))[0] == "134,529"
    assert one(spark, "SALARIES and", fx.caps_fraction(v))[0] == pytest.approx(8 / 11)
    assert one(spark, "29", fx.column_layout(v, *[F.lit(1)] * 5))[0] == "procurement_qty"
    assert one(spark, "x", fx.column_layout(v, F.lit(1), F.lit(2), F.lit(3), F.lit(1), F.lit(2)))[0] == "category_split"
    assert one(spark, "12.50", fx.to_int(v), fx.to_float(v)) == (12, 12.5) and one(spark, "None", fx.to_text(v))[0] is None
    assert one(spark, "CRPT-118hrpt553", fx.report_number(v))[0] == 553
    assert one(spark, "Mission Support", fx.classify_title_change(v, F.lit("MISSION  SUPPORT")))[0] == "case"
    assert one(spark, "x 1,000 +2 -3", fx.trailing_amounts(v))[0] == ["1,000", "+2", "-3"]


def test_matching(spark):
    source = "alpha  $1,000 and 2 345 end"
    tier = lambda raw: one(spark, source, verify.matched(F.lit(raw), F.col("v")))[0]["tier"]
    assert [tier(x) for x in ("$1,000", "alpha $1,000", "2345", "", "9")] == ["exact", "whitespace", "spaceless", "failed", "failed"]


def test_contained_passages(spark):
    """All pairs, of any length and at any place, against brute force."""
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abc") for _ in range(rng.randrange(1, 9)))
    docs = [(i, (" " if i % 3 else "\n ").join(word() for _ in range(60))) for i in range(30)] + [(50, None), (51, ""), (52, "é\u2028x" * 9)]
    passages = []
    for k in range(120):
        text = docs[rng.randrange(30)][1]
        at = rng.randrange(len(text))
        passages.append((k, text[at : at + rng.choice([1, 2, 3, 6, 7, 14, 15, 40, 63, 90])].replace("\n ", "\n " if k % 2 else "")))
    passages += [(200, ""), (201, None), (202, " \n"), (203, "\u2028xé"), (204, "nowhere")]
    flat, none = (lambda t: re.sub(r"\s+", " ", t, flags=re.A)), (lambda t: re.sub(r"\s+", "", t, flags=re.A))
    want = set()
    for (i, raw), (j, text) in itertools.product(passages, docs):
        raw = (raw or "").strip(" \n")
        if raw and text and none(raw) in none(text):
            want.add((i, j, "exact" if raw in text else "whitespace" if flat(raw) in flat(text) else "spaceless"))
    frame = lambda rows, key: spark.createDataFrame(rows, f"{key} long, text string")
    got = verify.contained_passages(frame(passages, "item_id"), frame(docs, "doc_id"), "item_id", "doc_id").collect()
    assert sorted(map(tuple, got)) == sorted(want) and {t for _, _, t in want} == {"exact", "whitespace", "spaceless"}
    assert verify.contained_passages(frame([(1, "")], "item_id"), frame(docs, "doc_id"), "item_id", "doc_id").count() == 0


SENATE = """
COMPARATIVE STATEMENT OF NEW BUDGET AUTHORITY
                 [In thousands of dollars]
--------------------------------------------------
      Item          2024 appropriation  Budget estimate
--------------------------------------------------
--------------------------------------------------
           TITLE I--DEPARTMENT OF THE INTERIOR
Land Resources:
    Rangeland management..........     112,340      115,152      112,340   ...............      -2,812
    (Limitation on use)...........     (34,000)     (35,000)     (35,000)     (+1,000)   ..............
      Subtotal, Land..............     112,340      115,152      112,340   ...............      -2,812
MINORITY VIEWS
"""


def test_fixed_width(spark):
    got = extract.fixed_width(lines(spark, SENATE)).orderBy("row_ord").collect()
    first = got[0]
    assert [first[c]["value"] for c in AMOUNTS] == [112_340_000, 115_152_000, 112_340_000, None, -2_812_000]
    assert got[1]["is_memo"] and got[1]["committee_recommendation"]["value"] == 35_000_000 and got[1]["delta_vs_enacted"]["value"] == 1_000_000
    assert got[2]["is_subtotal"] and len(got) == 3


HOUSE = """
            OFFICE OF INSPECTION

Appropriation, fiscal year 2024.................  $1,000,000
Budget request, fiscal year 2025................   1,200,000
Recommended in the bill.........................   1,100,000
Bill compared with:
    Appropriation, fiscal year 2024.............    +100,000
    Budget request, fiscal year 2025............   - - -

Prose follows.
"""


def test_inline(spark):
    got = extract.inline_tables(lines(spark, HOUSE)).collect()
    assert len(got) == 1 and got[0]["heading"] == "OFFICE OF INSPECTION" and got[0]["line_number"] == 4
    assert [got[0][k] and got[0][k]["value"] for k in ("prior_year", "budget_estimate", "committee_recommendation", "delta_vs_enacted", "delta_vs_estimate")] == [1_000_000, 1_200_000, 1_100_000, 100_000, None]


def test_enacted(spark):
    text = "DIVISION A--AGRICULTURE\n[In thousands of dollars]\nRequest Final Bill\nOFFICE OF AUDIT\nSALARIES AND EXPENSES 1,000 2,000\nTotal, Audit..... 2 ,000\n"
    pages = lines(spark, text).withColumn("page", F.lit(1))
    got = extract.verbatim(extract.enacted_statement(pages), spark.createDataFrame([("r", 1, text)], "report_id string, page int, page_text string")).orderBy("row_ord").collect()
    assert [(r["division"], r["label"], r["request"], r["enacted"]) for r in got][0] == ("A", "SALARIES AND EXPENSES", 1_000_000, 2_000_000)
    assert got[0]["verified"] and got[1]["is_subtotal"] and got[1]["enacted"] == 2_000_000


def test_typeset(spark):
    text = "The bill recommends the following appropriations for x\nSystems 100 200 100\nminor fix 5\nLESS REIMBURSABLES -10 -10\nTOTAL, X 90\n190 100\nTOTAL, Y 90 190 100"
    got = extract.typeset_statement(lines(spark, text)).orderBy("row_ord").collect()
    assert [(r["kind"], r["label"], list(r["amounts"])) for r in got] == [("value", "Systems", [100, 200, 100]), ("mark", "minor fix", [5]), ("value", "LESS REIMBURSABLES", [-10, -10]), ("total", "TOTAL, Y", [90, 190, 100])]
    assert got[1]["marks_row"] == 1


def test_wrapped_total(spark):
    got = structure.merge_wrapped_totals(lines(spark, "a 1 2 3\nTOTAL, X 90\n190 100\nTOTAL\nTOTAL 1\n2 3 4\nb")).orderBy("row_ord").collect()
    assert [r["line"] for r in got] == ["a 1 2 3", "TOTAL, X 90 190 100", "TOTAL TOTAL 1", "2 3 4", "b"]


def test_latex_and_json(spark):
    raw = r"\begin{tabular}{cccc} Item & FY2024 Enacted & Request & Bill \\ \hline Land & 1,000 & 2,000 & 3,000 \\ Total, Land & 1 & 2 & 3 \\ \end{tabular}"
    items = one(spark, raw, latex.comparative_items(F.col("v")))[0]
    assert [(i["text"], i["col1"], i["col2"], i["col3"], i["is_subtotal"]) for i in items] == [("Land", "1,000", "2,000", "3,000", False), ("Total, Land", "1", "2", "3", True)]
    assert one(spark, raw.replace("Request", "Projection of outlays"), latex.comparative_items(F.col("v")))[0] == []
    single = one(spark, r"\begin{tabular}{cc} Land & 1,000 \\ Note & none \\ \end{tabular}", latex.single_column_items(F.col("v")))[0]
    assert [(i["text"], i["col3"]) for i in single] == [("Land", "1,000")]
    assert one(spark, '```json\n[{"text": "a", "col1": "5"}]\n```', latex.json_items(F.col("v")))[0][0]["col1"] == "5" and one(spark, "no", latex.json_items(F.col("v")))[0] == []
    pages = spark.createDataFrame([("r", 1, raw)], "report_id string, page int, raw string").withColumn("items", latex.comparative_items(F.col("raw")))
    got = extract.item_lines(pages).orderBy("row_ord").collect()
    assert got[0]["prior_year_enacted"]["value"] == 1_000_000 and got[0]["line_number"] == 100


def test_crosswalk(spark):
    ref = spark.createDataFrame([(0, "A1", "Office of the Secretary", "Interior"), (1, "A2", "Office of the Secretary and Management", "Homeland"), (2, "B1", "Land Acquisition", "Interior")], "ref_ord int, code string, title string, agency string")
    labels = spark.createDataFrame([("land acquisition", ""), ("office of the secretary", "homeland"), ("office of the secretary", ""), ("land acquisitions", "interior"), ("zebra", "")], "name string, context string")
    got = {(r["name"], r["context"]): (r["match"], r["code"]) for r in crosswalk.match_accounts(labels, ref).collect()}
    assert got == {("land acquisition", ""): ("exact", "B1"), ("office of the secretary", "homeland"): ("agency_scoped", "A2"), ("office of the secretary", ""): ("ambiguous", None), ("land acquisitions", "interior"): ("needs_review", "B1"), ("zebra", ""): ("unmatched", None)}
    assert crosswalk.token_set_ratio("a b", "b a c") == 100 and crosswalk.token_set_ratio("", "x") == 0


def brute_ratio(a, b):
    """The token set ratio by its public definition, with a table of common subsequences."""

    def same(p, q):
        row = [0] * (len(q) + 1)
        for x in p:
            row = [0, *itertools.accumulate(range(len(q)), lambda left, j: row[j] + 1 if x == q[j] else max(row[j + 1], left), initial=0)][1:]
        return row[-1]

    x, y = set(a.split()), set(b.split())
    if not x or not y:
        return 0.0
    both = " ".join(sorted(x & y))
    one, two = (" ".join(w for w in [both, *sorted(s)] if w) for s in (x - y, y - x))
    if both and (x <= y or y <= x):
        return 100.0
    return max([200 * same(p, q) / (len(p) + len(q)) for p, q in ((both, one), (both, two), (one, two)) if p and q])


def test_fuzzy_matches_equal_all_pairs(spark):
    """Misspelt names against every reference: the best of 92 or more, the first of ties; nothing is lost to the blocking."""
    rng = random.Random(11)
    words = ["office", "of", "the", "land", "water", "harbour", "ferries", "survey", "to", "art", "fund", "bridge", "in", "maps", "a", "b", "x"]
    refs = [(k, f"C{k}", " ".join(rng.sample(words, rng.randrange(1, 6)))) for k in range(250)]
    names = set()
    for _ in range(500):
        w = list(rng.choice(refs)[2])
        if rng.random() < 0.2:
            w = list(" ".join(rng.sample(own := "".join(w).split(), len(own))))
        for _ in range(rng.choice((0, 1, 1, 2, 5))):
            at = rng.randrange(len(w))
            w[at : at + rng.randrange(2)] = rng.choice("abcdefgh ")
        names.add(" ".join("".join(w).split()))
    got = {r["name"]: (r["match"], r["code"]) for r in crosswalk.match_accounts(spark.createDataFrame([(n, "") for n in names if n], "name string, context string"), spark.createDataFrame([(*r, "") for r in refs], "ref_ord int, code string, title string, agency string")).collect()}
    reviewed = 0
    for name, found in got.items():
        if any(t == name or t.startswith(name + " ") for _, _, t in refs):
            assert found[0] in ("exact", "ambiguous")
            continue
        scores = [(brute_ratio(name, t), -k, c) for k, c, t in refs]
        best = max(scores)
        assert found == (("needs_review", best[2]) if best[0] >= 92 else ("unmatched", None)), name
        reviewed += found[0] == "needs_review"
    assert reviewed > 20 and crosswalk.common_subsequence("abcbdab", "bdcaba") == 4 and crosswalk.common_subsequence("", "a") == 0


def test_candidates_hold_every_similar_pair(spark):
    """Long labels, few letters, one-letter words, other orders: no pair that reaches the score is missing, at two scores; and few others are there."""
    rng = random.Random(4)
    texts = ["a" * 72 + "bcdefghijklmnopqrstuvwxyzbcde"]
    texts += [" ".join("".join(rng.choice("abc") for _ in range(rng.randrange(1, 9))) for _ in range(rng.randrange(1, 12))) for _ in range(60)]
    texts += [" ".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 14))) for _ in range(20)]
    names = []
    for t in texts:
        for edits in (0, 1, 2, 4, 7):
            w = t.split()
            rng.shuffle(w)
            w = list(t if edits % 2 else " ".join(w))
            for _ in range(edits):
                at = rng.randrange(len(w))
                w[at : at + rng.randrange(2)] = rng.choice("abcdz ")
            names.append(" ".join("".join(w).split()))
    names = sorted({n for n in names if n})
    left, right = spark.createDataFrame([(n,) for n in names], "name string"), spark.createDataFrame(list(enumerate(texts)), "ref int, title string")
    scores = {(n, k): crosswalk.token_set_ratio(n, t) for n in names for k, t in enumerate(texts)}
    for least in (92.0, 85.0):
        got = {(r["name"], r["ref"]): r["sure"] for r in similar.candidates(left, right, "name", "name", "ref", "title", least).collect()}
        assert {p for p, s in scores.items() if s >= least} <= set(got)
        assert all((scores[p] == 100) >= sure for p, sure in got.items())
    everything = spark.createDataFrame([(f"office {k}", ["office", f"w{k}"]) for k in range(300)], "title string, words array<string>")
    own = spark.createDataFrame([("a", ["office"]), ("b", ["office", "w7"]), ("c", ["office", "none"]), ("d", [])], "name string, mine array<string>")
    inside = similar.contained_in(own, everything, "mine", "words").collect()
    assert sorted((r["name"], r["title"]) for r in inside) == sorted([("a", f"office {k}") for k in range(300)] + [("b", "office 7")])
    met = similar.meet(own.select("name", F.lit("office").alias("k")), everything.withColumn("k", F.lit("office")), "k", most=20)
    assert met.count() == 4 * 300


def test_first_pass_after_a_failed_write(spark, tmp_path):
    """What a write without an end leaves is not the table; a whole one is not made again."""
    path, made = str(tmp_path / "pass"), []

    def make():
        made.append(1)
        return spark.range(3)

    (tmp_path / "pass").mkdir()
    (tmp_path / "pass" / "part-00000.parquet").write_bytes(b"half")
    assert workspace.made_once(spark, path, make).count() == 3 and workspace.made_once(spark, path, make).count() == 3 and len(made) == 1
    assert not list(tmp_path.glob("pass.*"))


_PLANNED: set = set()


def flaky_listing(congress, offset, page_size):
    """A transport whose first call for each page fails; 30 packages and one for each congress beyond 110."""
    if (congress, offset) not in _PLANNED:
        _PLANNED.add((congress, offset))
        raise OSError("not yet")
    total = 30 + int(congress) - 110
    return [{"package_id": f"p{i}"} for i in range(offset, min(total, offset + page_size))], offset + page_size < total


def test_catalog_tries_again():
    reader = catalog_api.CatalogReader({"transport": "test_ledger:flaky_listing", "congresses": "117,118", "wait": "0", "page_size": "10"})
    found = [[r[0] for r in reader.read(p)] for p in reader.partitions()]
    assert [len(f) for f in found] == [37, 38] and found[0] == [f"p{i}" for i in range(37)]


def test_workbook_and_catalog(spark, tmp_path):
    rows = statement(spark, [("oak <1>", False, False, 10), ("of which", False, True, 5), ("Total, x", True, False, 10), ("ash", False, False, 7), ("Total", True, False, 17), ("Total, y", True, False, None)])
    proof = writers.proof_rows(rows, reconcile.reconcile(rows)).orderBy("row_ord").collect()
    assert [(r["leaf"], r["rollup"], r["formula"]) for r in proof] == [(10, None, None), (None, None, None), (None, 10, "=SUM(C1)"), (7, None, None), (None, 17, "=SUM(C4,D3)"), (None, None, "=0")]
    totals = reconcile.reconcile(rows)
    three = zipfile.ZipFile(io.BytesIO(writers.workbooks(writers.proof_rows(rows, totals), totals).first()["content"]))
    listed, notes = (ElementTree.fromstring(three.read(f"xl/worksheets/sheet{k}.xml")) for k in (2, 3))
    ns = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
    formulas = [[f.text for f in r.iter(f"{ns}f")] for r in listed.iter(f"{ns}row")][1:]
    assert formulas == [["Proof!A4", "Proof!D4", "Proof!E4", "C2-D2"], ["Proof!A6", "Proof!D6", "Proof!E6", "C3-D3"], ["Proof!A7", "Proof!D7"]]
    said = [t.text for t in notes.iter(f"{ns}t")]
    assert "Totals: 3" in said and "Agree: 2" in said and "Agree of those that can be checked: 100.0%" in said
    assert [e.get("name") for e in ElementTree.fromstring(three.read("xl/workbook.xml")).iter(f"{ns}sheet")] == ["Proof", "Reconciliation", "Notes"]
    book = writers.workbooks(writers.proof_rows(rows, reconcile.reconcile(rows))).first()
    with zipfile.ZipFile(io.BytesIO(book["content"])) as z:
        sheet = ElementTree.fromstring(z.read("xl/worksheets/sheet1.xml"))
        assert z.testzip() is None and {"[Content_Types].xml", "xl/workbook.xml"} <= set(z.namelist())
    assert [f.text for f in sheet.iter() if f.tag.endswith("}f")] == ["SUM(C1)", "SUM(C4,D3)", "0"] and "oak <1>" in [t.text for t in sheet.iter() if t.tag.endswith("}t")]
    assert sources.load_catalog(spark, str(tmp_path / "none")).count() == 0 and sources.enacted_prints(spark).count() == 16
    with pytest.raises(OSError):
        catalog_api.CatalogReader({"transport": "os:listdir", "congresses": "1", "wait": "0"})._page(lambda *_: (_ for _ in ()).throw(OSError("down")), "1", 0)


def test_next_rollup_and_chain_in_long_reports(spark):
    """One report of many blocks: in time that grows with its rows, and as a plain loop has it."""
    rng = random.Random(13)
    rows, state, want = [], None, {}
    for k in range(3_000):
        items = [rng.randrange(5) for _ in range(rng.randrange(1, 3))]
        carry = state if state is not None else 0
        printed = rng.choice([sum(items), sum(items) + carry, 77])
        name = f"Total, b{k}" if rng.random() < 0.9 else "Total"
        fits = name != "Total" and printed == sum(items) + carry
        for v in items:
            want[len(rows)] = f"b{k}" if fits else None
            rows.append((f"i{len(rows)}", False, v))
        rows.append((name, True, printed))
        state = printed if fits else None
    schema = "report_id string, row_ord int, line_item_text string, is_subtotal boolean, is_memo boolean, account string, prior_year_enacted long, budget_estimate long, committee_recommendation long"
    df = spark.createDataFrame([("r", i, t, s, False, None, None, None, v) for i, (t, s, v) in enumerate(rows)], schema)
    got = {r["row_ord"]: r["account_inferred"] for r in structure.infer_block_accounts(df).filter("NOT is_subtotal").collect()}
    assert got == want and len({v for v in want.values()}) > 500
    back = {r["row_ord"]: r["account_recovered"] for r in structure.next_rollup_account(df).filter("NOT is_subtotal").collect()}
    following = None
    for i in range(len(rows) - 1, -1, -1):
        if rows[i][1]:
            following = rows[i][0][7:] or None
        else:
            assert back[i] == following


def test_flow_and_accounts(spark):
    rows = query.with_defaults(sources.ledger(spark, SMALL))
    with pytest.raises(ValueError):
        query.flow(rows, levels=("account",))
    with pytest.raises(ValueError):
        query.compare(rows)
    nodes, links = query.flow(rows, levels=("subcommittee", "title_name", "account"), top=3)
    assert {r["level"] for r in nodes.collect()} == {"subcommittee", "account"}  # nothing but unspecified in between
    by_level = nodes.groupBy("level").agg(F.sum("total").alias("t")).collect()
    assert len({r["t"] for r in by_level}) == 1 == len({r["t"] for r in [links.agg(F.sum("value").alias("t")).first(), by_level[0]]})
    found = trace.accounts(rows.withColumn("account_key", F.col("code")))
    assert trace.list_accounts(found, kind="case").count() == 0 and trace.list_accounts(found, changed_only=True).count() > 0
    assert writers.title_change_rows(found, True).filter("kind <> 'reword'").count() == 0


def test_sinks_and_sources(spark, tmp_path):
    rows = sources.ledger(spark, SMALL).limit(50).cache()
    writers.write_release(rows, str(tmp_path / "out"), "fact")
    files = writers.manifest(spark, str(tmp_path / "out")).collect()
    assert {r["file"].split("/")[0] for r in files} == {"fact.csv", "fact.parquet"} and all(len(r["sha256"]) == 64 for r in files)
    back = sources.csv_fact(spark, str(tmp_path / "out" / "fact.csv"), ("committee_recommendation", "row_ord"), ("is_subtotal",))
    assert sorted(map(str, back.select("report_id", "row_ord", "committee_recommendation", "is_subtotal").collect())) == sorted(map(str, rows.select("report_id", F.col("row_ord").cast("long"), "committee_recommendation", "is_subtotal").collect()))
    assert sources.release(spark, str(tmp_path / "out" / "fact.parquet"), ["stage", "chamber"]).columns == ["stage", "chamber", "track"]
    packages = spark.createDataFrame([("CRPT-118hrpt553", "Agriculture Appropriations Bill, 2025", "HRPT", "118", "2024-01-01"), ("X", "Naming a post office", "HRPT", "118", "")], "package_id string, title string, doc_class string, congress string, date_issued string")
    assert [(r["report_number"], r["subcommittee"], r["fiscal_year"]) for r in sources.catalog(packages).collect()] == [(553, "Agriculture", 2025)]


def test_command_line(spark, tmp_path, capsys):
    rows = sources.ledger(spark, SMALL)
    rows.filter("fiscal_year = 1996").write.parquet(str(tmp_path / "fact"))
    writers.write_json(sources.enacted_prints(spark), str(tmp_path / "catalog"))
    run = lambda *args: (cli.main(list(args), spark), capsys.readouterr().out.splitlines())
    code, shown = run("reports", str(tmp_path / "catalog"), "--congress", "117", "--fiscal-year", "2023")
    assert code == 0 and [line.split("\t")[0] for line in shown] == ["CPRT-117HPRT50347", "CPRT-117HPRT50348"]
    assert run("reconcile", str(tmp_path / "fact"), "--fail-under", "0.99")[0] == 1 and run("reconcile", str(tmp_path / "fact"), "--fail-under", "0.01")[0] == 0
    assert len(run("compare", str(tmp_path / "fact"), "--account", "bolt")[1]) == 1 and run("facets", str(tmp_path / "fact"))[1] and run("status", str(tmp_path / "fact"))[1] and run("trace", str(tmp_path / "fact"))[0] == 0


def test_stream(spark, tmp_path):
    rows = sources.ledger(spark, SMALL).limit(200)
    rows.write.parquet(str(tmp_path / "in"))
    schema = spark.read.parquet(str(tmp_path / "in")).schema.simpleString().removeprefix("struct<").removesuffix(">")
    stream = refresh.landing(spark, str(tmp_path / "in"), ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in spark.read.parquet(str(tmp_path / "in")).schema) or schema)
    refresh.refresh(stream, str(tmp_path / "out"), str(tmp_path / "cp"))
    out = spark.read.parquet(str(tmp_path / "out"))
    assert out.count() == 200 and {r["status"] for r in out.select("status").distinct().collect()} <= {"pass", "fail", "unverifiable"}


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(registry.ORACLES) <= set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_names_above_typeset_accounts(spark):
    """Names over several lines, past notes and page numbers; none under totals, amounts, prose or at the top; marks after a total belong to nothing."""
    the = "The committee " + extract.ANCHOR + " it:"
    text = [the, "Road 1 2 +3", "TITLE III", "PROCUREMENT", "ARMY,", "NAVY & MARINES,", "", "AND AIR FORCE (NEW)", "12", "(INCLUDING TRANSFERS)", the, "012A Gun carriage 1,000 2,000 +1,000", "Short change 5", "TOTAL, PROCUREMENT 1,000 2,000 +1,000", "Late change 7", "lower,", "WATER", the,
            "The sum 1 2 3", "ABC Thing 1 2 3", "RDTE Thing 1 2 3", "Fund 1 2 3", the, "LESS REIMBURSABLES 5 -5", "SHIPS,", the, "Boat 1 2 3"]
    got = extract.typeset_statement(spark.createDataFrame([("r", i, t) for i, t in enumerate(text)], "report_id string, row_ord int, line string")).orderBy("row_ord").collect()
    assert [(r["title"], r["account"], r["code"], r["label"], r["kind"]) for r in got] == [
        (None, None, None, "Road", "value"),
        ("Title III", "ARMY, NAVY & MARINES, AND AIR FORCE (NEW)", "012A", "Gun carriage", "value"),
        ("Title III", "ARMY, NAVY & MARINES, AND AIR FORCE (NEW)", None, "Short change", "mark"),
        ("Title III", "ARMY, NAVY & MARINES, AND AIR FORCE (NEW)", None, "TOTAL, PROCUREMENT", "total"),
        ("Title III", "WATER", None, "ABC Thing", "value"),
        ("Title III", "WATER", "RDTE", "Thing", "value"),
        ("Title III", "WATER", None, "Fund", "value"),
        ("Title III", None, None, "LESS REIMBURSABLES", "value"),
        ("Title III", None, None, "Boat", "value"),
    ]


def test_prose_triples_against_one_pattern(spark):
    """Marks in any order, against a backtracking pattern over the whole text."""
    rng = random.Random(6)
    say = ["Appropriation, fiscal year 1996 .. $", "Budget request, fiscal year 1997 ", "Recommended in the bill...", "words. ", "- - - ", "Recommended in the bill none "]
    texts = [(k, "".join(rng.choice(say[:3]) + str(rng.randrange(99)) + rng.choice([" ", ",", ". Land  "]) if rng.random() < 0.8 else rng.choice(say[3:]) for _ in range(rng.randrange(30)))) for k in range(200)] + [(999, None), (1000, "<p>x</p>" * 50)]
    one = re.compile(r"Appropriation, fiscal year 1996[ .]*\$?([\d,]+|- - -).*?Budget request, fiscal year 1997[ .]*\$?([\d,]+|- - -).*?Recommended in the bill[ .]*\$?([\d,]+|- - -)")
    want = []
    for k, t in texts:
        t = re.sub(r"\s+", " ", re.sub(r"<[^>]+>", " ", t or ""))
        for n, m in enumerate(one.finditer(t), 1):
            amount = lambda x: int(x.replace(",", "")) if x.strip("-, ") else None
            want.append((k, n, t[max(0, m.start() - 120) : m.start()].strip().split(".")[0][-70:].strip(), *map(amount, m.groups())))
    got = verify.prose_triples(spark.createDataFrame(texts, "report_id int, text string"), 1997).collect()
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str) and len(want) > 100


def test_titles_in_many_rows(spark):
    """A title that many reference rows share meets a name once for each agency, and its rows still count."""
    agency = lambda k: f"alpha{k % 3} works"
    ref = spark.createDataFrame([(k, f"c{k}", "Old bolt steel", agency(k)) for k in range(3000)] + [(9000, "x", "Red gear", "alpha7 works"), (9001, "y", "Red gear wheel", "beta works")], "ref_ord int, code string, title string, agency string")
    labels = spark.createDataFrame([("old bolt", "alpha1 works"), ("old bolt steel", None), ("red gear", "beta works"), ("old bolt steol", "")], "name string, context string")
    found = crosswalk.match_accounts(labels, ref)
    got = {r["name"]: (r["match"], r["code"], r["title"]) for r in found.collect()}
    assert got == {"old bolt": ("ambiguous", None, None), "old bolt steel": ("ambiguous", None, None), "red gear": ("agency_scoped", "y", "Red gear wheel"), "old bolt steol": ("needs_review", "c0", "Old bolt steel")}
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert not re.search(r"^[\s:+-]*Window ", plan, re.M)  # a window would hold all rows of one name in a task


def test_titles_of_many_references_are_met_once(spark, monkeypatch):
    """Containment compares names with distinct titles, in both passes."""
    sizes, real = [], similar.contained_in
    monkeypatch.setattr(similar, "contained_in", lambda own, ref, a, b: sizes.append((own.count(), ref.count())) or real(own, ref, a, b))
    ref = spark.createDataFrame([(k, "s1", "Old bolt steel", f"a{k % 2}") for k in range(500)] + [(900, "s2", "Old bolt brass", "a5")], "ref_ord int, federal_account_symbol string, account_title string, agency string")
    labels = spark.createDataFrame([(n, b) for n in ("bolt steel", "old bolt") for b in ("p", "q")], "name string, bucket string")
    got = sorted(map(tuple, crosswalk.contained_twice(labels, ref).collect()))
    assert got == [(n, b, "s1", "Old bolt steel", "a0", k) for n, k in (("bolt steel", 1), ("old bolt", 2)) for b in ("p", "q")]
    assert sizes == [(2, 2), (1, 2)]


def test_accounts_are_looked_up_where_rows_are(spark):
    """Few verdicts go to the rows: no row is exploded, shuffled and joined back for its account, and names are taken along where they are given."""
    rows = sources.ledger(spark, SMALL).withColumn("account_inferred", F.lit("Fund of x")).withColumn("department", F.lit("d"))
    rows = workspace.stored(crosswalk.with_names(rows), "named")
    ref = spark.createDataFrame([(1, "c1", "fund of x", "d")], "ref_ord int, code string, title string, agency string")
    out = crosswalk.enrich_accounts(rows, ref)
    assert not set(crosswalk.ADDED) & set(out.columns)
    assert out.filter("NOT is_subtotal AND account_key = 'c1'").count() == rows.filter("NOT is_subtotal").count()
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "Generate" not in plan


def test_corroboration_has_every_item_as_a_record(spark):
    """Each line item is an inline record, so each is found at least by its own."""
    rows = sources.ledger(spark, SMALL).filter("NOT is_subtotal")
    assert registry.QUERIES["inline_corroboration"](spark, SMALL).count() == rows.count()


def test_prose_headings_across_marks(spark):
    """A heading that reaches over several marks right before it, each of the least length."""
    mark = "Recommended in the bill 1"
    text = "far words near " + mark * 6 + "Appropriation, fiscal year 1996 $2Budget request, fiscal year 1997 3" + mark
    (row,) = verify.prose_triples(spark.createDataFrame([(1, text)], "report_id int, text string"), 1997).collect()
    assert tuple(row) == (1, 1, (mark * 6)[-120:].split(".")[0][-70:].strip(), 2, 3, 1)


def test_prose_marks_leave_the_text_behind(spark):
    """What a mark carries doesn't grow with its text: no shuffle, sort or window has the whole text, and no frame runs to the end."""
    docs = spark.createDataFrame([(1, "x")], "report_id int, text string")
    plan = verify.prose_triples(docs, 1997)._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if re.match(r"[\s:+-]*Window ", line)]
    assert windows and not [line for line in windows if "_t#" in line or "unboundedfollowing" in line]


def test_rows_in_file_order(spark, tmp_path):
    """Several files, each read in many splits, in the order in which they were written."""
    rows = spark.range(20_000).select(F.concat(F.lit("r"), F.expr("lpad(id div 100, 4, '0')")).alias("report_id"), F.col("id").alias("row_ord"), F.repeat(F.lit("x"), (F.col("id") % 50).cast("int")).alias("pad"))
    rows.repartitionByRange(5, "row_ord").sortWithinPartitions("row_ord").write.option("header", True).option("maxRecordsPerFile", 3000).csv(str(tmp_path / "fact.csv"))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
        got = sources.csv_fact(spark, str(tmp_path / "fact.csv"), ("row_ord",), place="place", multiline=False)
        assert got.rdd.getNumPartitions() > 20
        found = got.agg(F.count_if(F.col("place") == F.col("row_ord")), F.count(F.lit(1)), F.count_distinct("place")).first()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert tuple(found) == (20_000, 20_000, 20_000)


def test_checksums_by_pieces(spark, tmp_path, monkeypatch):
    """A file of many pieces, hashed in a task; the sums file, an altered file, a missing one and one that isn't listed."""
    import hashlib

    monkeypatch.setattr(writers, "CHUNK", 1000)
    (tmp_path / "a").mkdir()
    contents = {"a/large.bin": bytes(range(256)) * 300, "small.csv": b"x\n", "_hidden": b"no"}
    for name, content in contents.items():
        (tmp_path / name).write_bytes(content)
    for whole in (0, 100, 1 << 30):
        got = {r["file"]: (r["bytes"], r["sha256"]) for r in writers.manifest(spark, str(tmp_path), whole).collect()}
        assert got == {n: (len(c), hashlib.sha256(c).hexdigest()) for n, c in contents.items() if n[0] != "_"}
    writers.write_sums(spark, str(tmp_path))
    assert (tmp_path / "SHA256SUMS").read_text().splitlines() == [f"{hashlib.sha256(contents[n]).hexdigest()}  {n}" for n in ("a/large.bin", "small.csv")]
    assert {r["state"] for r in writers.checked_sums(spark, str(tmp_path)).collect()} == {"intact"}
    (tmp_path / "small.csv").write_bytes(b"y\n")
    (tmp_path / "a/large.bin").rename(tmp_path / "new.bin")
    assert {r["file"]: r["state"] for r in writers.checked_sums(spark, str(tmp_path)).collect()} == {"small.csv": "altered", "a/large.bin": "missing", "new.bin": "unlisted"}


def test_versions_of_a_table(spark, tmp_path):
    path = str(tmp_path / "table")
    rows = spark.createDataFrame([(g, k, 10 * k) for g in (1, 2, None) for k in range(5)], "g int, k int, v int")
    keys = ["g", "k"]
    assert versions.latest(spark, path) == 0 and versions.create(rows.withColumn("g", F.coalesce("g", F.lit(3))), path, "g") == 1
    first = versions.read(spark, path, "g")
    old = first.collect()
    files = {p: p.stat().st_mtime_ns for p in (tmp_path / "table" / "parts").rglob("*.parquet")}
    after = first.withColumn("v", F.when((F.col("g") == 2) & (F.col("k") == 1), -1).otherwise(F.col("v")))
    changed, version = versions.change(after, path, "g", keys, ["v"], base=1, dry_run=True)
    assert changed.collect() == [(2, 1)] and version == 1 == versions.latest(spark, path)
    assert versions.change(after, path, "g", keys, ["v"], base=1)[1] == 2
    with pytest.raises(versions.Refused):
        versions.change(after.withColumn("v", F.lit(0)), path, "g", keys, ["v"], base=1)
    assert {p: p.stat().st_mtime_ns for p in files} == files  # what the first version wrote is still there
    assert {(r["g"], r["written_in"]) for r in versions.read(spark, path, "g", with_version=True).collect()} == {(1, 1), (2, 2), (3, 1)}
    assert sorted(versions.read(spark, path, "g", 1).collect()) == sorted(old) and sorted(versions.read(spark, path, "g").collect()) == sorted(after.collect())
    assert versions.change(versions.read(spark, path, "g"), path, "g", keys, ["v"], base=2)[1] == 2  # nothing changes
    (tmp_path / "table" / "log" / "3").write_bytes(b"")  # a writer that was stopped
    assert versions.latest(spark, path) == 2
    with pytest.raises(versions.Refused):
        versions.change(first, path, "g", keys, ["v"], base=2)
    versions.abandon(spark, path)
    assert versions.change(first, path, "g", keys, ["v"], base=2)[1] == 3 and sorted(versions.read(spark, path, "g").collect()) == sorted(old)
