"""Row-level verification and repair: delta identities, over-determined repair, magnitude, text matches, tiers."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerloom.functions import text as fx
from ledgerloom.schema import AMOUNTS, LEVELS

CEILING = 3_000_000_000_000
#: Characters of context that a text match shows on each side.
CONTEXT = 40
#: Characters of the longest block by which passages and sources are paired.
SEED = 32


def recovered_primary(pe: Column, be: Column, cr: Column, de: Column, dt: Column) -> Column:
    """The recommendation, or what its deltas say where they agree."""
    a, b = pe + de, be + dt
    return F.coalesce(cr, F.when(a.isNull(), b).when(b.isNull(), a).when(a == b, a))


def repair(df: DataFrame) -> DataFrame:
    """Adds repaired (the recommendation), repair_action (recovered, corrected or null) and corrected_from. Totals are left alone."""
    pe, be, cr, de, dt = map(F.col, AMOUNTS)
    a, b = pe + de, be + dt
    found = recovered_primary(pe, be, cr, de, dt)
    total = F.coalesce(F.col("is_subtotal"), F.lit(False))
    action = F.when(total, None).when(cr.isNull() & found.isNotNull(), "recovered").when((a == b) & (a != cr), "corrected")
    return df.withColumn("repair_action", action).withColumn("corrected_from", F.when(F.col("repair_action") == "corrected", cr)).withColumn("repaired", F.when(F.col("repair_action") == "corrected", a).when(F.col("repair_action") == "recovered", found).otherwise(cr))


def auto_repaired(pe: Column, be: Column, cr: Column, de: Column, dt: Column) -> Column:
    """The agreeing derivation where it differs from the recommendation, also from none; else null."""
    return F.when((pe + de == be + dt) & ~(pe + de).eqNullSafe(cr), pe + de)


def row_status(pe: Column, be: Column, cr: Column, de: Column, dt: Column) -> Column:
    """pass, fail or unverifiable, by every delta identity that can be expressed."""
    one, two = cr - pe == de, cr - be == dt
    return F.when(one.isNull() & two.isNull(), "unverifiable").when(F.coalesce(one, F.lit(True)) & F.coalesce(two, F.lit(True)), "pass").otherwise("fail")


def verify(df: DataFrame) -> DataFrame:
    """Auto-repair, then status; sets verified and verification_method."""
    own = tuple(map(F.col, AMOUNTS))
    fixed = auto_repaired(*own)
    out = df.withColumn("auto_repaired", fixed.isNotNull()).withColumn("committee_recommendation", F.coalesce(fixed, F.col("committee_recommendation")))
    status = row_status(*map(F.col, AMOUNTS))
    return out.withColumn("status", status).withColumn("verified", F.col("status") == "pass").withColumn("verification_method", F.when(F.col("status") == "pass", "delta_arithmetic").otherwise("none"))


def verify_summary(df: DataFrame, *by: str) -> DataFrame:
    """Counts of verify() by group; pass_rate is null where nothing can be verified."""
    count = lambda s: F.count_if(F.col("status") == s)
    return df.groupBy(*by).agg(count("pass").alias("passed"), count("fail").alias("failed"), count("unverifiable").alias("unverifiable"), F.count_if("auto_repaired").alias("auto_repaired")).withColumn("pass_rate", F.round(F.try_divide("passed", F.col("passed") + F.col("failed")), 6))


def reparsed_signs(df: DataFrame, *, paren_negative: bool = False) -> DataFrame:
    """Each amount record parsed anew from its raw text. Run it before repair(), whose recoveries have no raw text."""
    return df.withColumns({c: F.when(F.col(c).isNotNull(), fx.parse_dollar(F.coalesce(F.col(c)["raw_text"], F.lit("")), F.coalesce(F.col(c)["in_thousands"], F.lit(False)), paren_negative=paren_negative)) for c in AMOUNTS})


def check_deltas(df: DataFrame, *keys: str) -> DataFrame:
    """One row for each delta identity of a row: identity, expected, printed, holds. A missing delta counts as 0."""
    pe, be, cr, de, dt = map(F.col, AMOUNTS)
    row = lambda name, base, delta: F.struct(F.lit(name).alias("identity"), (cr - base).alias("expected"), F.coalesce(delta, F.lit(0)).cast("bigint").alias("printed"))
    out = df.select(*keys, F.explode(F.array(row("vs_enacted", pe, de), row("vs_estimate", be, dt))).alias("c")).select(*keys, "c.*")
    return out.filter("expected IS NOT NULL").withColumn("holds", F.col("expected") == F.col("printed"))


def check_subtotal(df: DataFrame, *keys: str, column: str = "committee_recommendation") -> DataFrame:
    """Sum of line items against printed total by group; missing amounts count as 0."""
    v = F.coalesce(F.col(column), F.lit(0))
    return df.groupBy(*keys).agg(F.sum(F.when(~F.col("is_subtotal"), v).otherwise(0)).alias("computed"), F.sum(F.when(F.col("is_subtotal"), v).otherwise(0)).alias("printed")).withColumn("holds", F.col("computed") == F.col("printed"))


def oversized(df: DataFrame, *keys: str, ceiling: int = CEILING) -> DataFrame:
    """One finding for each row with an amount beyond the ceiling: the first such column, its value, and the label's first 60 characters."""
    found = F.filter(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("value")) for c in LEVELS]), lambda x: F.abs(x["value"]) > ceiling)
    return df.withColumn("finding", F.get(found, 0)).filter("finding IS NOT NULL").select(*keys, F.substring("line_item_text", 1, 60).alias("label"), "finding.column", "finding.value")


def matched(raw: Column, source: Column) -> Column:
    """struct<tier, context>: exact, whitespace (runs as one space), spaceless, or failed; an empty amount fails. Context is for the first two tiers."""
    bare = F.coalesce(fx.strip(raw), F.lit(""))
    flat, flat_source = F.regexp_replace(bare, r"\s+", " "), F.regexp_replace(source, r"\s+", " ")
    none, none_source = F.regexp_replace(bare, r"\s+", ""), F.regexp_replace(source, r"\s+", "")
    around = lambda text, part: F.substr(text, F.greatest(F.position(part, text) - CONTEXT, F.lit(1)), F.length(part) + 2 * CONTEXT)
    tier = fx.first_of((bare == "", "failed"), (source.contains(bare), "exact"), (flat_source.contains(flat), "whitespace"), (none_source.contains(none), "spaceless"), otherwise="failed")
    return F.struct(tier.alias("tier"), F.when(tier == "exact", around(source, bare)).when(tier == "whitespace", around(flat_source, flat)).alias("context"))


def contained_passages(passages: DataFrame, sources: DataFrame, passage_id: str, source_id: str, text: str = "text") -> DataFrame:
    """Every passage against every whole source: (passage_id, source_id, tier) of all that match in some tier. Empty passages match nowhere.

    A match in any tier is one of the spaceless texts, so pairs are found there: a passage of 2k - 1 or more characters covers one
    whole block of k of the source's, cut one after another. k is the largest such power of two, SEED at most; the pairs that share
    a block are then matched in full.
    """
    bare = lambda c: F.regexp_replace(fx.strip(F.coalesce(F.col(c), F.lit(""))), r"\s+", "")
    blocks = lambda c, k: F.regexp_extract_all(c, F.lit(f"(?s).{{{k}}}"), F.lit(0))
    p = passages.select(F.col(passage_id).alias("p"), bare(text).alias("own")).filter("own <> ''")
    s = sources.filter(F.col(text).isNotNull()).select(F.col(source_id).alias("s"), F.regexp_replace(text, r"\s+", "").alias("own"))
    size, sizes = (F.length("own") + 1) / 2, [2**i for i in range(SEED.bit_length())]
    grams = lambda k: F.flatten(F.array(*[blocks(F.substr("own", F.lit(i + 1)), k) for i in range(k)]))
    least = lambda k: (size >= k) & ((size < 2 * k) | F.lit(k == SEED))
    used = p.agg(*[F.coalesce(F.bool_or(least(k)), F.lit(False)).alias(f"k{k}") for k in sizes]).first()
    pairs = None
    for k in (k for k in sizes if used[f"k{k}"]):
        asked = p.filter(least(k)).select("p", F.explode(F.array_distinct(grams(k))).alias("block"))
        found = s.select("s", F.explode(F.array_distinct(blocks(F.col("own"), k))).alias("block")).join(asked, "block").select("p", "s")
        pairs = found if pairs is None else pairs.unionByName(found)
    if pairs is None:
        pairs = p.select("p", F.lit(None).cast(dict(s.dtypes)["s"]).alias("s")).limit(0)  # no passage has any text
    raw = passages.select(F.col(passage_id).alias("_p"), F.col(text).alias("raw"))
    whole = sources.select(F.col(source_id).alias("_s"), F.col(text).alias("source"))
    met = pairs.distinct().join(whole, F.expr("s <=> _s")).join(raw, F.expr("p <=> _p"))
    return met.select(F.col("p").alias(passage_id), F.col("s").alias(source_id), matched(F.col("raw"), F.col("source"))["tier"].alias("tier")).filter("tier <> 'failed'")


def verified_items(items: DataFrame, *keys: str) -> DataFrame:
    """Items (keys, verified, raw_text, source_text; one row an amount): verified where all printed amounts are found, unchanged where none is printed."""
    printed = F.coalesce(fx.strip(F.col("raw_text")), F.lit("")) != ""
    found = F.when(printed, matched(F.col("raw_text"), F.col("source_text"))["tier"] != "failed")
    return items.groupBy(*keys).agg(F.coalesce(F.bool_and(found), F.first("verified")).alias("verified"))


def audit_report(results: DataFrame, *by: str) -> DataFrame:
    """Counts by tier and the success rate; 0.0 without results."""
    n = lambda t: F.count_if(F.col("tier") == t).alias(t)
    return results.groupBy(*by).agg(F.count("tier").alias("total"), *map(n, ("exact", "whitespace", "spaceless", "failed"))).withColumn("rate", F.coalesce(F.round(F.try_divide(F.col("total") - F.col("failed"), "total"), 6), F.lit(0.0)))


def verification_tier(verified: Column, method: Column, has_amount: Column, inferred: Column, corroborated: Column) -> Column:
    return fx.first_of((F.coalesce(verified, F.lit(False)), method), (~has_amount, "none"), (fx.strip(F.coalesce(inferred, F.lit(""))) != "", "block"), (F.coalesce(corroborated, F.lit(False)), "inline"), otherwise="none")


# The marks before a triple's amounts in running text, with the years they name, and the amount after each.
TRIPLE_MARKS = ("Appropriation, fiscal year {before}", "Budget request, fiscal year {year}", "Recommended in the bill")
_MARKED_AMOUNT = r"[ .]*\$?([\d,]+|- - -)"
#: Characters before a triple in which its heading is looked for, and of the heading.
HEADING_FROM, HEADING = 120, 70


def prose_triples(docs: DataFrame, year: int, key: str = "report_id", text: str = "text", before: int | None = None) -> DataFrame:
    """Triples stated in running text: key, triple_id (from 1), heading, prior_year_enacted, budget_estimate, recommendation columns as in the ledger.

    Markup goes, white space counts as one space. A triple is the first mark of the prior year, the first request after it and the first recommendation
    after that, whatever stands in between; the next one begins behind it. Only marks with an amount count; - - - is none. The heading is what stands
    before, up to its first full stop. Marks are found by one pass over the text and put together by windows over them, so a text without an end costs no more than its length.
    """
    flat = F.regexp_replace(F.regexp_replace(F.coalesce(F.col(text), F.lit("")), r"<[^>]+>", " "), r"\s+", " ")
    marks = [m.format(before=before if before is not None else year - 1, year=year) for m in TRIPLE_MARKS]
    pattern = f"(?:{'|'.join(marks)}){_MARKED_AMOUNT}"
    rows = docs.select(F.col(key), flat.alias("_t"))
    rows = rows.withColumn("_hits", F.regexp_extract_all("_t", F.lit(pattern), F.lit(0))).filter(F.size("_hits") >= len(marks)).withColumn("_gaps", F.split("_t", pattern, -1))
    # A mark takes along the end of what stands before it, never the text: a row for each mark with the whole text would be quadratic.
    tail = lambda c: F.right(F.col(c), F.lit(HEADING_FROM))
    placed = rows.select(key, F.posexplode(F.arrays_zip("_hits", "_gaps")).alias("_k", "_z")).filter("_z._hits IS NOT NULL")
    kind = F.when(F.col("_z._hits").startswith(marks[0]), "a").when(F.col("_z._hits").startswith(marks[1]), "b").otherwise("c")
    amount = F.translate(F.regexp_extract("_z._hits", _MARKED_AMOUNT + "$", 1), ",", "").try_cast("bigint")
    placed = placed.select(key, "_k", kind.alias("kind"), amount.alias("amount"), tail("_z._gaps").alias("_gap"), tail("_z._hits").alias("_hit"))
    w = W.partitionBy(key).orderBy("_k")
    # Marks are longer than their words, so no more of them than this begin within the heading's reach.
    near = -(-HEADING_FROM // min(map(len, marks)))
    before_it = [F.coalesce(F.lag(F.concat("_gap", "_hit"), n).over(w), F.lit("")) for n in range(near, 0, -1)]
    pre = fx.strip(F.right(F.concat(*before_it, "_gap"), F.lit(HEADING_FROM)))
    heading = F.element_at(F.split(pre, r"\."), 1)
    placed = placed.withColumn("heading", F.when(F.col("kind") == "a", fx.strip(F.substr(heading, F.greatest(F.length(heading) - HEADING, F.lit(0)) + 1, F.lit(HEADING))))).select(key, "_k", "kind", "amount", "heading")
    after = W.partitionBy(key).orderBy(F.desc("_k")).rowsBetween(W.unboundedPreceding, -1)  # from the end backwards the frame only grows, so one pass does
    placed = placed.withColumn("c", F.last(F.when(F.col("kind") == "c", F.struct("_k", "amount")), ignorenulls=True).over(after))
    placed = placed.withColumn("b", F.last(F.when((F.col("kind") == "b") & F.col("c").isNotNull(), F.struct("amount", F.col("c").alias("c"))), ignorenulls=True).over(after))
    # Each beginning with its end; those with one end are a group. A group whose beginnings all lie before the end of the group before is left out if that one is taken.
    begins = placed.filter("kind = 'a' AND b IS NOT NULL").select(key, F.col("_k").alias("begin"), F.col("b.c._k").alias("end"), "heading", F.col("amount").alias("x"), F.col("b.amount").alias("y"), F.col("b.c.amount").alias("z"))
    one = F.struct("begin", "heading", "x", "y", "z")
    groups = begins.groupBy(key, "end").agg(F.sort_array(F.collect_list(one)).alias("from"))
    v = W.partitionBy(key).orderBy("end")
    groups = groups.withColumn("last", F.coalesce(F.lag("end").over(v), F.lit(-1))).withColumn("later", F.filter("from", lambda x: x["begin"] > F.col("last")))
    groups = groups.withColumn("_free", F.size("later") > 0).withColumn("_island", F.sum(F.col("_free").cast("int")).over(v))
    nth = F.row_number().over(W.partitionBy(key, "_island").orderBy("end"))  # the free group itself is the first, and taken
    groups = groups.withColumn("_taken", nth % 2 == 1).withColumn("_after", F.coalesce(F.lag("_taken").over(v), F.lit(False))).filter("_taken")
    found = groups.withColumn("t", F.when(F.col("_after"), F.col("later")[0]).otherwise(F.col("from")[0])).withColumn("triple_id", F.row_number().over(v))
    return found.select(key, "triple_id", "t.heading", F.col("t.x").alias(LEVELS[0]), F.col("t.y").alias(LEVELS[1]), F.col("t.z").alias(LEVELS[2]))


def matched_triples(rows: DataFrame, triples: DataFrame, key: str = "report_id") -> DataFrame:
    """Independent triples (prior, estimate, recommendation with triple_id) against rows: EXACT, PARTIAL or MISSING, and the best row's score (equal columns; two missing amounts are equal)."""
    levels = [F.col(c).cast("bigint").alias(c) for c in LEVELS]
    both = rows.select(key, F.lit(None).cast(triples.schema["triple_id"].dataType).alias("triple_id"), *levels, F.lit(True).alias("_row")).unionByName(triples.select(key, "triple_id", *levels, F.lit(False).alias("_row")))
    return scored(both.repartition(key), key)


def scored(both: DataFrame, key: str = "report_id") -> DataFrame:
    """matched_triples() of rows and triples that lie together: key, triple_id, the three amounts, and _row, which a triple hasn't set.

    No row meets a triple: some row shares two or three amounts if it is in the triple's group by those amounts, and missing ones are a group too. Where
    reports lie in one partition, groups do.
    """
    hit = lambda *by: F.coalesce(F.max("_row").over(W.partitionBy(key, *by)), F.lit(False))
    sets = {3: [LEVELS], 2: list(combinations(LEVELS, 2)), 1: [(c,) for c in LEVELS]}
    out = both
    for n, columns in sets.items():
        for k, by in enumerate(columns):
            out = out.withColumn(f"_{n}{k}", hit(*by))
    score = F.when(F.col(key).isNull(), 0).when(F.col("_30"), 3).when(F.col("_20") | F.col("_21") | F.col("_22"), 2).when(F.col("_10") | F.col("_11") | F.col("_12"), 1).otherwise(0)
    out = out.filter(~F.col("_row")).select(key, "triple_id", score.alias("score"))
    return out.withColumn("verdict", F.when(F.col("score") == 3, "EXACT").when(F.col("score") >= 1, "PARTIAL").otherwise("MISSING"))
