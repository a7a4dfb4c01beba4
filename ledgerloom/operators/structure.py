"""Order-sensitive operators: islands, fills, block inference, headings, ranges. Every row carries (report_id, row_ord)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerloom.functions import text as fx
from ledgerloom.schema import BLOCK_ORDER

# What marks a closing summary table.
HEADING = r"(?i)comparison of amounts in the bill|projection of outlays|outlays? associated with|applicable (budget )?allocation|302\s*\([ab]\)"
YEAR = r"(?i)^(19|20)\d\d(\s*(and (future years|beyond|outyears)))?[.:]?$"
# Lines that can be headings.
TITLE_LINE = r"^\s{4,30}[A-Z][a-zA-Z\s,\-\(\)&']{4,}\s*$"
CAPS_LINE = r"^\s{0,30}[A-Z][A-Z\s,\-\(\)&]{4,}\s*$"
SUMMARY = r"(?i)^(discretionary|mandatory|defense|non-?defense)\b|^\("


def _order(report: str, ord_col: str):
    return W.partitionBy(report).orderBy(ord_col)


def summary_flags(df: DataFrame, report: str = "report_id", ord_col: str = "row_ord") -> DataFrame:
    """Adds is_summary: year rows, and the run of summary rows that a heading opens."""
    text = fx.strip(F.coalesce(F.col("line_item_text"), F.lit("")))
    year, heading = text.rlike(YEAR), text.rlike(HEADING)
    kind = year | heading | text.rlike(SUMMARY) | (text == "")
    out = df.withColumn("_kind", kind).withColumn("_island", F.sum(F.when(~kind, 1).otherwise(0)).over(_order(report, ord_col)))
    opened = F.max(heading).over(W.partitionBy(report, "_island").orderBy(ord_col))
    return out.withColumn("is_summary", F.col("_kind") & (year | opened)).drop("_kind", "_island")


def drop_summary_rows(df: DataFrame, report: str = "report_id", ord_col: str = "row_ord") -> DataFrame:
    return summary_flags(df, report, ord_col).filter(~F.col("is_summary")).drop("is_summary")


def next_rollup_account(df: DataFrame, report: str = "report_id", ord_col: str = "row_ord") -> DataFrame:
    """Adds account_recovered: for an unlabelled line item the name of the next total; a nameless total closes the block too. Memo and blank labels get none."""
    text = F.coalesce(F.col("line_item_text"), F.lit(""))
    roll = fx.is_rollup(F.col("is_subtotal"), text)
    # from the end backwards the frame only grows, so one pass does
    backwards = W.partitionBy(report).orderBy(F.desc(ord_col)).rowsBetween(W.unboundedPreceding, -1)
    after = F.last(F.when(roll, F.struct(fx.rollup_name(text).alias("name"))), ignorenulls=True).over(backwards)
    bare = (fx.strip(F.coalesce(F.col("account"), F.lit(""))) == "") & ~roll & ~fx.is_memo_label(text) & (fx.strip(text) != "")
    return df.withColumn("account_recovered", F.when(bare, after["name"]))


def _blocks(df: DataFrame, report: str, ord_col: str, paren: Column, *more: Column) -> tuple[DataFrame, DataFrame]:
    """The rows with their block, and one row for each block: its total's name and values, and for each column the count and sum of its line items, with and without those in parentheses. more: further aggregates."""
    text = F.coalesce(F.col("line_item_text"), F.lit(""))
    roll = fx.is_rollup(F.col("is_subtotal"), text)
    own = df.withColumn("_roll", roll).withColumn("_block", F.sum(F.when(roll, 1).otherwise(0)).over(_order(report, ord_col)) - F.when(roll, 1).otherwise(0))
    leaf = ~F.col("_roll") & (fx.strip(text) != "") & ~fx.is_memo_label(text)
    parts = []
    for c in BLOCK_ORDER:
        for tag, cond in (("all", leaf), ("net", leaf & ~paren)):
            parts += [F.count(F.when(cond, F.col(c))).alias(f"n_{tag}_{c}"), F.sum(F.when(cond, F.col(c))).alias(f"s_{tag}_{c}")]
        parts.append(F.max(F.when(F.col("_roll"), F.col(c))).alias(f"t_{c}"))
    return own, own.groupBy(report, "_block").agg(*parts, F.max(F.when(F.col("_roll"), fx.rollup_name(text))).alias("name"), F.max("_roll").alias("closed"), *more)


def _chain(blocks: DataFrame, report: str, keep_over: bool, *more: str) -> DataFrame:
    """The blocks that close, in order: report, _block, _name, _delta. A block that closes hands its total to the next as one addend; any other is a barrier.

    keep_over: instead the blocks that sum to more than their total, with the excess. Whether a block closes depends on the one before only, by
    one yes or no. So each block either settles that by itself, or passes on what it gets, or turns it round; a block's state is that of the
    last one settled, turned round as often as blocks since then do. more: further columns of the blocks to keep.
    """
    w = W.partitionBy(report).orderBy("_block")
    rows = blocks
    for c in BLOCK_ORDER:
        rows = rows.withColumn(f"carry_{c}", F.lag(f"t_{c}").over(w))
    named = F.coalesce(F.col("closed") & F.col("name").isNotNull(), F.lit(False))

    def outcome(carried: bool) -> tuple[Column, Column]:
        """Whether the block closes, and its excess, if the one before handed its total over or not."""
        fits, over = F.lit(False), F.lit(None).cast("bigint")
        for c in BLOCK_ORDER:
            carry, t = F.col(f"carry_{c}") if carried else F.lit(None).cast("bigint"), F.col(f"t_{c}")
            n, m = (F.col(f"n_{tag}_{c}") + F.when(carry.isNotNull(), 1).otherwise(0) for tag in ("all", "net"))
            total, net = (F.coalesce(f"s_{tag}_{c}", F.lit(0)) + F.coalesce(carry, F.lit(0)) for tag in ("all", "net"))
            fits |= F.coalesce((n > 0) & (total == t), F.lit(False))
            if not keep_over:
                fits |= F.coalesce((m > 0) & (m != n) & (net == t), F.lit(False))
            over = F.coalesce(over, F.when((n > 0) & t.isNotNull(), total - t))
        return named & fits, over

    (alone, over_alone), (after, over_after) = outcome(False), outcome(True)
    first = F.row_number().over(w) == 1
    rows = rows.select("*", alone.alias("_alone"), F.when(first, alone).otherwise(after).alias("_after"), over_alone.alias("_over_alone"), over_after.alias("_over_after"))
    settled = F.col("_alone") == F.col("_after")
    turns = F.when(F.col("_alone") & ~F.col("_after"), 1).otherwise(0)
    rows = rows.withColumn("_epoch", F.count_if(settled).over(w))
    rows = rows.withColumn("_since", F.sum(turns).over(W.partitionBy(report, "_epoch").orderBy("_block"))).withColumn("_base", F.last(F.when(settled, F.col("_alone")), ignorenulls=True).over(w))
    rows = rows.withColumn("_good", F.coalesce("_base", F.lit(False)) != (F.col("_since") % 2 == 1))
    over = F.when(F.coalesce(F.lag("_good").over(w), F.lit(False)), F.col("_over_after")).otherwise(F.col("_over_alone"))
    rows = rows.withColumn("_delta", over.cast("bigint"))
    rows = rows.filter(named & ~F.col("_good") & (F.col("_delta") > 0)) if keep_over else rows.filter("_good")
    return rows.select(report, "_block", F.col("name").alias("_name"), "_delta", *more)


def infer_block_accounts(df: DataFrame, report: str = "report_id", ord_col: str = "row_ord", raw: Column | None = None) -> DataFrame:
    """Sets account_inferred on line items without account whose block sums to its named total on any column, all or without amounts in parentheses."""
    own, blocks = _blocks(df, report, ord_col, fx.is_paren_amount(raw) if raw is not None else F.coalesce(F.col("is_memo"), F.lit(False)))
    found = _chain(blocks, report, False)
    text = F.coalesce(F.col("line_item_text"), F.lit(""))
    known = F.nullif(F.col("account_inferred"), F.lit("")) if "account_inferred" in df.columns else F.lit(None).cast("string")
    leaf = ~F.col("_roll") & (fx.strip(text) != "") & ~fx.is_memo_label(text) & (fx.strip(F.coalesce(F.col("account"), F.lit(""))) == "")
    return own.join(found, [report, "_block"], "left").withColumn("account_inferred", F.coalesce(known, F.when(leaf, F.col("_name")))).drop("_roll", "_block", "_name", "_delta")


def oversum_blocks(df: DataFrame, report: str = "report_id", ord_col: str = "row_ord") -> DataFrame:
    """Blocks whose line items sum to more than their named total on its first column: report, block, name, excess."""
    _, blocks = _blocks(df, report, ord_col, F.lit(False))
    return _chain(blocks, report, True).select(report, F.col("_block").alias("block"), F.col("_name").alias("name"), F.col("_delta").alias("excess"))


#: Characters of a label in a question.
SHOWN = 60


def indent_leaves(df: DataFrame, page: str = "page", report: str = "report_id", ord_col: str = "row_ord", carry: tuple[str, ...] = ()) -> DataFrame:
    """The line items of blocks that sum to more than their total: report, page, letter, leaf (from 1), ord_col, block, name, label, account, account_inferred, line item values and total of each column, and the columns `carry` of the line item's row.

    A block is on the page of its total. The blocks of a page have letters from A on, in order, and a block's line items are numbered; memos by their label
    are among them, without values. df: the ledger with a page column.
    """
    text = F.coalesce(F.col("line_item_text"), F.lit(""))
    known = F.col("account_inferred") if "account_inferred" in df.columns else F.lit(None).cast("string")
    counted = ~fx.is_memo_label(text)
    item = F.when(~F.col("_roll") & (fx.strip(text) != ""), F.struct(F.col(ord_col), fx.strip(text).alias("label"), "account", known.alias("account_inferred"), *[F.when(counted, F.col(c)).alias(c) for c in BLOCK_ORDER], *carry))
    # A block is one row with its line items inside, so they go along where blocks are judged and needn't be joined again.
    _, blocks = _blocks(df, report, ord_col, F.lit(False), F.collect_list(item).alias("_items"), F.max(F.when(F.col("_roll"), F.col(page))).alias("_page"))
    over = _chain(blocks, report, True, "_items", "_page", *[f"t_{c}" for c in BLOCK_ORDER])
    over = over.withColumn("letter", F.char(64 + F.row_number().over(W.partitionBy(report, "_page").orderBy("_block"))))
    items = over.select("*", F.posexplode(F.array_sort("_items")).alias("_pos", "_item"))
    of_item = [f"_item.{c}" for c in (ord_col, "label", "account", "account_inferred", *BLOCK_ORDER, *carry)]
    found = items.select(report, F.col("_page").alias(page), "letter", (F.col("_pos") + 1).alias("leaf"), F.col("_block").alias("block"), F.col("_name").alias("name"), *of_item, *[f"t_{c}" for c in BLOCK_ORDER])
    return found.select(report, page, "letter", "leaf", ord_col, "block", "name", "label", "account", "account_inferred", *BLOCK_ORDER, *[f"t_{c}" for c in BLOCK_ORDER], *carry)


def indent_questions(leaves: DataFrame, page: str = "page", report: str = "report_id") -> DataFrame:
    """One question a page (report, page, question), of indent_leaves(): which of the numbered lines of each lettered block are parts of the line above them."""
    column = F.coalesce(*[F.when(F.col(f"t_{c}").isNotNull(), c) for c in BLOCK_ORDER])
    of = lambda prefix: F.coalesce(*[F.when(column == c, F.col(f"{prefix}{c}")) for c in BLOCK_ORDER])
    line = F.concat(F.lit("  "), "leaf", F.lit(". "), F.left("label", F.lit(SHOWN)), F.lit(": "), F.coalesce(of("").cast("string"), F.lit("no amount")))
    head = F.concat(F.lit("Block "), "letter", F.lit(", total of "), "name", F.lit(" = "), of("t_").cast("string"))
    listed = lambda c: F.array_join(F.transform(F.sort_array(F.collect_list(c)), lambda x: x["said"]), "\n")
    blocks = leaves.groupBy(report, page, "block", head.alias("head")).agg(listed(F.struct("leaf", line.alias("said"))).alias("lines"))
    asked = blocks.groupBy(report, page).agg(listed(F.struct("block", F.concat("head", F.lit("\n"), "lines").alias("said"))).alias("blocks"))
    task = "Some lines of the blocks below are indented on the page: they break down the line above and must not be added. For each block give the numbers of such lines, as JSON only: letters with lists of numbers."
    return asked.select(report, page, F.concat(F.lit(f"{task}\n"), "blocks").alias("question"))


def indent_flags(answers: DataFrame, page: str = "page", report: str = "report_id") -> DataFrame:
    """answers (report, page, answer) as report, page, state and flags (letter to distinct line numbers).

    state: failed without an answer, malformed without a JSON object of lists in it, else read. Only numbers count, cut to whole ones; text around the object doesn't matter.
    """
    found = F.from_json(F.regexp_extract("answer", r"(?s)\{.*\}", 0), "map<string,array<variant>>")
    numbers = lambda xs: F.array_distinct(F.transform(F.filter(xs, lambda x: F.schema_of_variant(x).rlike("^(BIGINT|DOUBLE|DECIMAL)")), lambda x: F.try_variant_get(x, "$", "double").cast("int")))
    state = F.when(F.col("answer").isNull(), "failed").when(found.isNull(), "malformed").otherwise("read")
    return answers.select(report, page, state.alias("state"), F.transform_values(found, lambda _, xs: numbers(F.coalesce(xs, F.array().cast("array<variant>")))).alias("flags"))


def indent_accepted(leaves: DataFrame, flags: DataFrame, page: str = "page", report: str = "report_id", ord_col: str = "row_ord") -> DataFrame:
    """The second gate: of blocks with flags, those whose other line items sum exactly to the total on some column. report, ord_col, block, is_memo (flagged), account_inferred (the rest, where it has no account)."""
    said = flags.select(report, page, "flags")
    own = leaves.join(said, [report, page]).withColumn("_flags", F.coalesce(F.col("flags")[F.col("letter")], F.array().cast("array<int>"))).filter(F.size("_flags") > 0).withColumn("_out", F.array_contains("_flags", F.col("leaf")))
    w = W.partitionBy(report, "block")
    fits = F.lit(False)
    for c in BLOCK_ORDER:
        kept = F.when(~F.col("_out"), F.col(c))
        fits |= F.coalesce((F.count(kept).over(w) > 0) & (F.sum(kept).over(w) == F.col(f"t_{c}")), F.lit(False))
    blank = lambda c: fx.strip(F.coalesce(F.col(c), F.lit(""))) == ""
    label = F.when(~F.col("_out") & blank("account") & (F.coalesce(F.col("account_inferred"), F.lit("")) == ""), F.col("name"))
    return own.withColumn("_fits", fits).filter("_fits").select(report, ord_col, "block", F.col("_out").alias("is_memo"), label.alias("account_inferred"))


def indent_stats(leaves: DataFrame, flags: DataFrame, accepted: DataFrame, page: str = "page", report: str = "report_id") -> DataFrame:
    """One row: blocks that over-sum, pages asked about, of which failed and malformed, blocks recovered, rows labelled, lines marked. A page without an answer has failed."""
    pages = leaves.select(report, page).distinct().join(flags.select(report, page, "state"), [report, page], "left")
    one = leaves.agg(F.count_distinct(report, "block").alias("oversum_blocks"))
    two = pages.agg(F.count(F.lit(1)).alias("pages"), F.count_if(F.coalesce("state", F.lit("failed")) == "failed").alias("pages_failed"), F.count_if(F.col("state") == "malformed").alias("pages_malformed"))
    three = accepted.agg(F.count_distinct(report, "block").alias("blocks_recovered"), F.count("account_inferred").alias("rows_labeled"), F.count_if("is_memo").alias("lines_marked"))
    single = lambda d: d.withColumn("_k", F.lit(1))  # noqa: E731  one row each
    return single(one).join(single(two), "_k").join(single(three), "_k").drop("_k")


def recover_indent(df: DataFrame, flags: DataFrame, report: str = "report_id", ord_col: str = "row_ord", column: str = "committee_recommendation") -> DataFrame:
    """flags (report, row_ord): line items said to be non-adding. They are accepted for a block only if the rest sums to its total; then the rest gets the total's name and the flagged become memos."""
    own, _ = _blocks(df, report, ord_col, F.lit(False))
    marked = own.join(flags.select(report, ord_col).distinct().withColumn("_flag", F.lit(True)), [report, ord_col], "left").withColumn("_flag", F.coalesce("_flag", F.lit(False)))
    text = F.coalesce(F.col("line_item_text"), F.lit(""))
    sums = marked.groupBy(report, "_block").agg(F.sum(F.when(~F.col("_roll") & ~F.col("_flag"), F.col(column))).alias("_sum"), F.max(F.when(F.col("_roll"), F.col(column))).alias("_total"), F.max(F.when(F.col("_roll"), fx.rollup_name(text))).alias("_name"), F.max("_flag").alias("_any"))
    good = sums.filter("_any AND _name IS NOT NULL AND _sum = _total").select(report, "_block", "_name")
    out = marked.join(good, [report, "_block"], "left")
    hit = F.col("_name").isNotNull() & ~F.col("_roll")
    return out.withColumn("is_memo", F.when(hit & F.col("_flag"), True).otherwise(F.col("is_memo"))).withColumn("account_inferred", F.when(hit & ~F.col("_flag"), F.col("_name"))).drop("_roll", "_block", "_name", "_flag")


def fill_context(df: DataFrame, levels: list[tuple[str, Column]], report: str = "report_id", ord_col: str = "row_ord") -> DataFrame:
    """Carries each level's last value forward; a new value of an outer level resets the inner ones. levels: (name, value or null), outer first."""
    out, reset = df, []
    for name, value in levels:
        out = out.withColumn(f"_v_{name}", value)
    for name, _ in levels:
        epoch = W.partitionBy(report, *reset).orderBy(ord_col)
        out = out.withColumn(name, F.last(f"_v_{name}", ignorenulls=True).over(epoch.rowsBetween(W.unboundedPreceding, 0)))
        out = out.withColumn(f"_e_{name}", F.count(f"_v_{name}").over(epoch.rowsBetween(W.unboundedPreceding, 0)))
        reset.append(f"_e_{name}")
    return out.drop(*reset, *[f"_v_{n}" for n, _ in levels])


def compressed_ranges(df: DataFrame, value: str, *keys: str) -> DataFrame:
    """Whole numbers as 'a:b' runs and single ones, ascending, comma-joined in `ranges`."""
    runs = df.select(*keys, value).distinct().withColumn("_g", F.col(value) - F.row_number().over(W.partitionBy(*keys).orderBy(value)))
    runs = runs.groupBy(*keys, "_g").agg(F.min(value).alias("a"), F.max(value).alias("b"))
    shown = F.when(F.col("a") == F.col("b"), F.col("a").cast("string")).otherwise(F.concat_ws(":", "a", "b"))
    return runs.groupBy(*keys).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("a", shown.alias("s")))), lambda x: x["s"]), ",").alias("ranges"))


def nearest_heading(df: DataFrame, report: str = "report_id", ord_col: str = "row_ord") -> DataFrame:
    """Adds heading: the last title-case line of the 15 before, else the last all-caps line of the 30 before."""
    line = F.col("line")
    title, caps = line.rlike(TITLE_LINE), line.rlike(CAPS_LINE)
    # the last such line of all before, if it is near enough: the frame only grows, so one pass does
    w = _order(report, ord_col)
    before = lambda cond: F.last(F.when(cond, F.struct("_at", fx.strip(line).alias("text"))), ignorenulls=True).over(w.rowsBetween(W.unboundedPreceding, -1))
    out = df.withColumn("_at", F.row_number().over(w)).withColumn("_title", before(title)).withColumn("_caps", before(caps))
    near = lambda c, n: F.when(F.col("_at") - F.col(f"{c}._at") <= n, F.col(f"{c}.text"))
    return out.withColumn("heading", F.coalesce(near("_title", 15), near("_caps", 30))).drop("_at", "_title", "_caps")


def keep_first(df: DataFrame, *keys: str, ord_col: str = "row_ord") -> DataFrame:
    return df.withColumn("_n", F.row_number().over(W.partitionBy(*keys).orderBy(ord_col))).filter("_n = 1").drop("_n")


def merge_wrapped_totals(df: DataFrame, report: str = "report_id", ord_col: str = "row_ord") -> DataFrame:
    """A TOTAL line with fewer than three amounts takes in the line after it, which goes. In a chain every second line is taken in."""
    short = F.col("line").rlike("^TOTAL") & (F.size(fx.trailing_amounts(F.col("line"))) < 3)
    w = _order(report, ord_col)
    out = df.withColumn("_short", short).withColumn("_at", F.row_number().over(w))
    place = F.col("_at") - F.coalesce(F.max(F.when(~F.col("_short"), F.col("_at"))).over(w), F.lit(0)) - 1  # within the run of short ones
    out = out.withColumn("_takes", F.col("_short") & (place % 2 == 0))
    out = out.withColumn("_taken", F.coalesce(F.lag("_takes").over(w), F.lit(False)))
    joined = F.concat_ws(" ", F.rtrim("line"), fx.strip(F.lead("line").over(w)))
    return out.withColumn("line", F.when(F.col("_takes"), joined).otherwise(F.col("line"))).filter(~F.col("_taken")).drop("_short", "_at", "_takes", "_taken")
