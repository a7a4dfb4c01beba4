"""Account labels to stable identities: prefix matches, token containment, corroboration, recall."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from ledgerloom.functions import text as fx
from ledgerloom.operators import similar
from ledgerloom.schema import LEVELS
from ledgerloom.sources.workspace import stored

FUZZY, JACCARD, CONTEXT = 92.0, 0.7, 0.6


def common_subsequence(a: str, b: str) -> int:
    """The length of the longest common subsequence: one bit for each character of a, all of them at once."""
    places: dict[str, int] = {}
    for i, c in enumerate(a):
        places[c] = places.get(c, 0) | 1 << i
    free = every = (1 << len(a)) - 1
    for c in b:
        hit = free & places.get(c, 0)
        free = (free + hit | free - hit) & every
    return len(a) - free.bit_count()


def token_set_ratio(a: str | None, b: str | None) -> float:
    """0 to 100: the best of three comparisons of shared and remaining words, in alphabetical order. Two strings compare by twice their longest common subsequence over their lengths."""
    x, y = set((a or "").split()), set((b or "").split())
    if not x or not y:
        return 0.0
    both = " ".join(sorted(x & y))
    left, right = (" ".join([both, *sorted(s)]).strip() for s in (x - y, y - x))
    if both and (not x - y or not y - x):
        return 100.0
    ratio = lambda p, q: 200 * common_subsequence(p, q) / (len(p) + len(q)) if p and q else 0.0
    return max(ratio(both, left), ratio(both, right), ratio(left, right))


@F.pandas_udf(DoubleType())
def fuzzy(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([token_set_ratio(x, y) for x, y in zip(a, b, strict=True)], dtype=float)


def match_accounts(labels: DataFrame, reference: DataFrame) -> DataFrame:
    """labels (name, context) against reference (ref_ord, code, title, agency): name, context, match, code, title.

    A name matches titles that equal it or begin with it and a space: exact for one, agency_scoped if one of several has
    the most words in common with the context, else ambiguous. Without any, the best fuzzy match of 92 or more needs
    review, ties by ref_ord. Prefixes are exploded, so this is an equi-join; for the fuzzy match similar.candidates() gives the pairs that can reach the score.
    """
    keys = stored(labels.select("name", "context").distinct(), "labels")  # several branches start from it
    # A title may stand in many rows: those of one text and agency are one row with their number and the first of them, so no name meets them one by one.
    first = F.struct("ref_ord", "code", "title")
    ref = reference.withColumn("norm", fx.norm_title(F.col("title"))).groupBy("norm", "agency").agg(F.count(F.lit(1)).alias("n"), F.min(first).alias("first"))
    words = F.filter(F.split("norm", " "), lambda w: w != "")
    heads = ref.select("agency", "n", "first", F.explode(F.transform(F.sequence(F.lit(1), F.greatest(F.size(words), F.lit(1))), lambda k: F.array_join(F.slice(words, F.lit(1), k), " "))).alias("head"))
    heads = heads.groupBy("head", "agency").agg(F.sum("n").alias("n"), F.min("first").alias("first"))
    hits = keys.join(heads, F.col("name") == F.col("head")).withColumn("overlap", F.size(F.array_intersect(fx.tokens(F.col("agency"), "context"), fx.tokens(F.col("context"), "context"))))
    hits = hits.groupBy("name", "context", "overlap").agg(F.sum("n").alias("n"), F.min("first").alias("first"))
    hits = hits.groupBy("name", "context").agg(F.sum("n").alias("n"), F.max(F.struct("overlap", F.col("n").alias("n_most"), "first")).alias("b"))
    hits = hits.select("name", "context", "n", F.col("b.overlap").alias("most"), "b.n_most", "b.first.code", "b.first.title")
    kind = F.when(F.col("n") == 1, "exact").when((F.col("most") > 0) & (F.col("n_most") == 1), "agency_scoped").otherwise("ambiguous")
    sure = hits.withColumn("match", kind)
    sure = sure.select("name", "context", "match", F.when(F.col("match") != "ambiguous", F.col("code")).alias("code"), F.when(F.col("match") != "ambiguous", F.col("title")).alias("title"))
    rest = keys.join(sure.select("name", "context"), (keys["name"] == sure["name"]) & keys["context"].eqNullSafe(sure["context"]), "left_anti")
    rest = stored(rest, "open-labels")
    met = similar.candidates(rest.select("name").distinct(), ref.select("norm").distinct(), "name", "name", "norm", "norm", FUZZY)
    near = rest.join(met, "name").join(ref.select("norm", "agency", "first"), "norm")
    shares = (F.coalesce(F.col("context"), F.lit("")) == "") | F.arrays_overlap(fx.tokens(F.col("agency"), "context"), fx.tokens(F.col("context"), "context"))
    near = near.filter(shares)
    near = near.filter("sure").withColumn("score", F.lit(100.0)).unionByName(near.filter("NOT sure").withColumn("score", fuzzy(F.col("name"), F.col("norm")))).filter(F.col("score") >= FUZZY)
    best = near.groupBy("name", "context").agg(F.min(F.struct((-F.col("score")).alias("score"), "first"))["first"].alias("first")).select("name", "context", F.lit("needs_review").alias("match"), "first.code", "first.title")
    found = sure.unionByName(best)
    return keys.alias("k").join(found.alias("f"), F.expr("k.name = f.name AND k.context <=> f.context"), "left").select("k.name", "k.context", F.coalesce("f.match", F.lit("unmatched")).alias("match"), "f.code", "f.title")


#: The columns whose labels a row's account is sought by, in turn, and the helper columns of with_names().
ATTEMPTS = ("account", "account_inferred", "line_item_text")
ADDED = ("_sub", *[f"_name{i}" for i in range(len(ATTEMPTS))])


def with_names(df: DataFrame) -> DataFrame:
    """df with ADDED, what enrich_accounts() looks up: the subcommittee and the normalized names of a line item's labels; a fragment has none. For rows that are stored before."""
    name = lambda c: F.when((fx.strip(F.coalesce(F.col(c), F.lit(""))) != "") & ~fx.label_parts(F.col(c))["is_fragment"], F.nullif(fx.label_parts(F.col(c))["normalized"], F.lit("")))
    item = ~F.coalesce(F.col("is_subtotal"), F.lit(False))
    return df.withColumns({"_sub": F.coalesce("subcommittee", F.lit(""))} | {f"_name{i}": F.when(item, name(c)) for i, c in enumerate(ATTEMPTS)})


def enrich_accounts(df: DataFrame, reference: DataFrame, context: tuple[str, ...] = ("agency", "department")) -> DataFrame:
    """Adds account_key, account_key_title and account_match: of account, inferred account and label the first that matches surely, else the first attempt's verdict.

    context: the columns that give a row's context. The context of a (subcommittee, name) is that of its first row in (report_id, row_ord).
    """
    rows = (df if "_name0" in df.columns else with_names(df)).drop("account_key", "account_key_title", "account_match")
    names = F.array(*[f"_name{i}" for i in range(len(ATTEMPTS))])
    tried = rows.select("report_id", "row_ord", F.col("_sub").alias("sub"), F.concat_ws(" ", *context).alias("context"), F.posexplode(names).alias("pos", "name")).filter("name IS NOT NULL")
    first = stored(tried.groupBy("sub", "name").agg(F.min_by("context", F.struct("report_id", "row_ord", "pos")).alias("context")), "first-contexts")
    found = first.alias("f").join(match_accounts(first, reference).alias("m"), F.expr("f.name = m.name AND f.context <=> m.context")).select("f.sub", "f.name", "m.match", "m.code", "m.title")
    # Each attempt is looked up where its row is. Stored verdicts have a known size, so that few of them go to the rows and not the rows to them.
    found = stored(found, "verdicts")
    unsure = ~F.col("match").isin("exact", "agency_scoped")
    for i in range(len(ATTEMPTS)):
        rows = rows.join(found.select(F.col("sub").alias("_sub"), F.col("name").alias(f"_name{i}"), F.struct(unsure.alias("unsure"), F.lit(i).alias("pos"), "match", "code", "title").alias(f"_found{i}")), ["_sub", f"_name{i}"], "left")
    best = F.array_min(F.array(*[f"_found{i}" for i in range(len(ATTEMPTS))]))
    rows = rows.withColumn("_best", best)
    sure = lambda c: F.when(~F.col("_best.unsure"), F.col(f"_best.{c}"))
    out = {"account_match": F.col("_best.match"), "account_key": sure("code"), "account_key_title": sure("title")}
    return rows.select(*[c for c in df.columns if c not in out and c not in ADDED], *[v.alias(k) for k, v in out.items()])


def contained(labels: DataFrame, reference: DataFrame, scope: DataFrame | None = None) -> DataFrame:
    """labels (name, bucket) whose words (two or more) all stand in titles of one symbol: name, bucket, symbol, title, agency.

    scope: (bucket, agency) pairs that limit a bucket's references. A label meets the titles that have its rarest word.
    """
    # Whether a name is contained depends on its words and a title's alone: names meet titles once, whatever buckets and references share them.
    one = F.struct("ref_ord", "symbol", "title", "agency")
    ref = reference.select("ref_ord", F.col("federal_account_symbol").alias("symbol"), F.col("account_title").alias("title"), "agency").groupBy("symbol", "title", "agency").agg(F.min("ref_ord").alias("ref_ord"))
    titles = ref.select("title").distinct().withColumn("words", fx.tokens(F.col("title"), "title")).filter(F.size("words") >= 2)
    own = labels.select("name", "bucket").distinct()
    names = own.select("name").distinct().withColumn("mine", fx.tokens(F.col("name"), "title")).filter(F.size("mine") >= 2)
    met = similar.contained_in(names, titles, "mine", "words").select("name", "title")
    only = lambda found, *keys: found.groupBy(*keys).agg(F.min("symbol").alias("least"), F.max("symbol").alias("most"), F.min(one).alias("r")).filter("least = most").select(*keys, "r.symbol", "r.title", "r.agency")
    if scope is None:
        return own.join(only(met.join(ref, "title"), "name"), "name").select("name", "bucket", "symbol", "title", "agency")
    full = met.join(ref, "title").join(own, "name").join(scope.select("bucket", "agency").distinct(), ["bucket", "agency"], "left_semi")
    return only(full, "name", "bucket")


def contained_twice(labels: DataFrame, reference: DataFrame) -> DataFrame:
    """A first pass over all references teaches which agencies a bucket has; a second, within them, takes the names still open."""
    first = contained(labels, reference)
    left = labels.select("name", "bucket").distinct().join(first, ["name", "bucket"], "left_anti")
    second = contained(left, reference, first.select("bucket", "agency"))
    return first.withColumn("pass", F.lit(1)).unionByName(second.withColumn("pass", F.lit(2)))


def corroborated(rows: DataFrame, inline: DataFrame, label: tuple[str, ...] = ("account", "line_item_text")) -> DataFrame:
    """(report_id, row_ord) of rows that share an amount and a word of their label with the same inline record of their report. inline: report_id, amounts, label."""
    # Rows and records move to their report once, as they are; there those of an amount lie together, and no pair of them is made.
    mine = rows.select("report_id", "row_ord", F.lit(True).alias("own"), F.concat_ws(" ", *label).alias("text"), F.array(*[F.col(c).cast("bigint") for c in LEVELS]).alias("amounts"))
    theirs = inline.select("report_id", F.lit(None).cast(mine.schema["row_ord"].dataType).alias("row_ord"), F.lit(False).alias("own"), F.col("label").alias("text"), F.col("amounts").cast("array<bigint>").alias("amounts"))
    each = mine.unionByName(theirs).filter("report_id IS NOT NULL").repartition("report_id").withColumn("words", fx.tokens(F.col("text"), "tier"))
    each = each.select("report_id", "row_ord", "own", "words", F.explode(F.array_distinct("amounts")).alias("amount")).filter("amount IS NOT NULL")
    said = F.collect_set(F.when(~F.col("own"), F.col("words"))).over(Window.partitionBy("report_id", "amount"))
    return each.withColumn("said", said).filter(F.col("own") & F.arrays_overlap("words", F.flatten("said"))).select("report_id", "row_ord").distinct()


def audit_recall(rows: DataFrame, accounts: DataFrame) -> DataFrame:
    """accounts (report_id, account_id, name, value) with how the rows show them: value, name, contained, similar or missing. account_id is distinct within a report."""
    have = rows.select("report_id", fx.recall_name(F.col("line_item_text")).alias("row_name"), F.col("committee_recommendation").alias("row_value"))
    want = accounts.select("report_id", "account_id", "name", "value", fx.recall_name(F.col("name")).alias("norm"))
    # How a name is shown is the same for all accounts of the report that have it: names meet, not accounts, and only their sizes go along.
    words = lambda df, name: df.distinct().select("report_id", name, fx.tokens(F.col(name), "recall").alias("words")).select("report_id", name, F.size("words").alias(f"n_{name}"), F.explode("words").alias("word"))
    met = words(want.select("report_id", "norm"), "norm").join(words(have.select("report_id", "row_name"), "row_name"), ["report_id", "word"])
    met = met.groupBy("report_id", "norm", "row_name").agg(F.count(F.lit(1)).alias("both"), F.max("n_norm").alias("n"), F.max("n_row_name").alias("m"))
    inside = (F.col("n") >= 2) & (F.col("m") >= 2) & (F.col("norm").contains(F.col("row_name")) | F.col("row_name").contains(F.col("norm")))
    alike = F.col("both") / (F.col("n") + F.col("m") - F.col("both")) >= JACCARD
    by_words = met.select("report_id", "norm", F.when(inside, 3).when(alike, 4).alias("how")).filter("how IS NOT NULL")
    by_name = have.select("report_id", F.col("row_name").alias("norm"), F.lit(2).alias("how")).distinct()
    shown = by_words.unionByName(by_name).groupBy("report_id", "norm").agg(F.min("how").alias("how"))
    valued = have.select("report_id", F.col("row_value").alias("value"), F.lit(1).alias("_hit")).filter("value IS NOT NULL").distinct()
    asked = want.filter("value IS NULL").withColumn("_hit", F.lit(None).cast("int")).unionByName(want.filter("value IS NOT NULL").join(valued, ["report_id", "value"], "left"))
    how = F.element_at(F.array(*map(F.lit, ("value", "name", "contained", "similar"))), F.coalesce("_hit", "how"))
    return asked.join(shown, ["report_id", "norm"], "left").select("report_id", "account_id", "name", F.when(F.coalesce("_hit", "how").isNull(), "missing").otherwise(how).alias("found_by"))


def suspect_pages(missing: DataFrame, rows: DataFrame) -> DataFrame:
    """Pages whose rows hold 60 % or more of a missing account's context words. missing: report_id, account_id, context; rows: report_id, page, line_item_text."""
    want = missing.withColumn("words", fx.tokens(F.col("context"), "context")).filter(F.size("words") > 0)
    seen = rows.select("report_id", "page", fx.tokens(F.col("line_item_text"), "context").alias("own")).distinct()
    met = want.withColumn("word", F.explode("words")).join(seen.withColumn("word", F.explode("own")), ["report_id", "word"])
    return met.filter(F.size(F.array_intersect("words", "own")) / F.size("words") >= CONTEXT).select("report_id", "account_id", "page").distinct()


def replace_pages(rows: DataFrame, again: DataFrame) -> DataFrame:
    """rows with whole pages replaced by those read again, in page order."""
    kept = rows.join(again.select("report_id", "page").distinct(), ["report_id", "page"], "left_anti")
    return kept.unionByName(again)


def crosswalk_stats(matches: DataFrame) -> DataFrame:
    n = matches.groupBy("match").agg(F.count(F.lit(1)).alias("entities"))
    return n.withColumn("trusted", F.col("match").isin("exact", "agency_scoped"))
