"""Exact deduplication by a tree-merge of sorted digest runs.

Every row gets a digest of its (optionally case-folded) text. The rows of each input partition become a run: one entry for each digest, in
ascending order of digests, cut into shards by ranges of the digest (a shard of a run is one sorted array). Then runs are exchanged in
binomial rounds: in round k the runs whose k-th bit is set go to the run without it, shard by shard, and the two sorted arrays are merged in
order. Wherever the merge meets a digest in both, it keeps the better identifier (smallest or largest) and adds up the copies, if the
verification agrees too: byte length and a second, unrelated 64-bit hash. After log2(runs) rounds each shard has one sorted array left.

Its entries are joined to the digests of the first runs, and these to their rows. So a text that a third of all rows share is one entry of each run
on the way up, and on the way down a join key for each run, never one hot key. A shard's array has about SHARD entries at the end, whatever the input.

Only digests and identifiers (about 100 bytes a row) are shuffled, never texts. Arrays are merged by array_sort, which runs through presorted stretches in
one pass, and by higher-order functions; no Python runs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import cut, fold_ascii, free_name, power_at_least, shuffle_width

KEY = ["digest", "check", "bytes"]
#: Entries of a shard's array after the last round, about, and runs at most.
SHARD, RUNS_MOST = 1024, 1024


def _keyed(df: DataFrame, id_col: str, text_col: str, fold_case: bool) -> DataFrame:
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    text = fold_ascii(text) if fold_case else text
    return df.select(F.col(f"`{id_col}`").alias("id"), text.alias("t")).select(
        "id", F.unhex(F.sha2("t", 256)).alias("digest"), F.xxhash64("t").alias("check"), F.octet_length("t").alias("bytes")
    )


def merged(runs: Column, better) -> Column:
    """Sorted arrays of entries as one. Entries of equal digest, check and length become one, with the better identifier and the sum of copies.

    In each array a key occurs once, so at most as many equal neighbours meet as there are arrays.
    """

    def combine(m: Column) -> Column:
        same = lambda a, b: F.struct(*[a[k] for k in KEY]).eqNullSafe(F.struct(*[b[k] for k in KEY]))

        def entry(x: Column, i: Column) -> Column:
            after = F.get(m, i + 1)
            both = F.struct(*[x[k].alias(k) for k in KEY], better(x["best"], after["best"]).alias("best"), (x["n"] + after["n"]).alias("n"))
            return F.when((i > 0) & same(F.get(m, i - 1), x), F.lit(None)).when(same(after, x), both).otherwise(x)

        return F.filter(F.transform(m, entry), lambda x: x.isNotNull())

    # as a lambda's variable the sorted array is computed once
    return F.transform(F.array(F.array_sort(F.flatten(runs))), combine)[0]


def exact_groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "min", fold_case: bool = True, runs: int | None = None) -> DataFrame:
    """One row for each row of df: id, keep_id, group_size, kept, digest (binary).

    keep: "min" or "max", which identifier of a group stays. Null text counts as empty text. A null identifier
    stays only where its whole group has none. Rows that repeat identifier and text count as separate copies, of
    which exactly one is kept. Other columns of df, whatever their names, are ignored. An empty df gives no rows.
    """
    if keep not in ("min", "max"):
        raise ValueError(f"keep must be min or max, not {keep!r}")
    width = shuffle_width(df.sparkSession)
    runs = min(power_at_least(2, runs or width), RUNS_MOST)
    best, better = (F.max, F.greatest) if keep == "max" else (F.min, F.least)
    known = F.col("id").isNotNull() if keep == "max" else F.col("id").isNull()
    rows = _keyed(df, id_col, text_col, fold_case).withColumn("seq", F.monotonically_increasing_id()).withColumn("run", F.pmod(F.spark_partition_id(), F.lit(runs)))
    rows = cut(rows)
    shards = max(width, -(-rows.count() // SHARD))
    # the first 48 bits of a digest as a number, times shards: ascending ranges of digests
    shard = F.floor(F.conv(F.hex(F.substring("digest", 1, 6)), 16, 10).cast("decimal(20,0)") * shards / F.lit(1 << 48)).cast("int")

    first = rows.groupBy("run", *KEY).agg(best(F.struct(known.alias("known"), "id", "seq")).alias("best"), F.count(F.lit(1)).alias("n"))
    first = cut(first.withColumn("shard", shard))
    level = first.groupBy("run", "shard").agg(F.array_sort(F.collect_list(F.struct(*KEY, "best", "n"))).alias("entries"))
    left = runs
    while left > 1:
        left //= 2
        level = level.withColumn("run", F.expr("run div 2")).groupBy("run", "shard").agg(F.collect_list("entries").alias("runs")).select("run", "shard", merged(F.col("runs"), better).alias("entries"))
    answer = level.select(F.explode("entries").alias("e")).select("e.*")
    answer = first.select("run", *KEY).join(answer, KEY)
    return rows.join(answer, ["run", *KEY]).select(
        "id", F.col("best.id").alias("keep_id"), F.col("n").alias("group_size"), (F.col("seq") == F.col("best.seq")).alias("kept"), "digest"
    )


def drop_copies(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "max", fold_case: bool = True) -> DataFrame:
    """The rows of df that exact_groups keeps, with all columns of df; rows that repeat identifier and text stay once."""
    digest, keep_id, keep_digest = (free_name(df, n) for n in ("own_digest", "keep_id", "keep_digest"))
    kept = exact_groups(df, id_col, text_col, keep, fold_case).filter("kept").select(F.col("id").alias(keep_id), F.col("digest").alias(keep_digest))
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    own = df.withColumn(digest, F.unhex(F.sha2(fold_ascii(text) if fold_case else text, 256)))
    found = own.join(kept, own[f"`{id_col}`"].eqNullSafe(kept[keep_id]) & (own[digest] == kept[keep_digest]), "left_semi")
    return found.dropDuplicates([id_col, digest]).drop(digest)
