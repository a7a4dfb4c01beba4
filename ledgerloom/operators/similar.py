"""Which labels can be similar, by rare keys: candidates for the fuzzy score, and relational division.

Both joins meet on a label's rarest parts only. A key that many rows share is split into parts of SPLIT rows, so it doesn't end in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.sources.workspace import stored

#: Rows of the right side that one part of a key has.
SPLIT = 4096


def meet(left: DataFrame, right: DataFrame, key: str, most: int = SPLIT) -> DataFrame:
    """left joined with right on key; a key with more than `most` rows on the right is dealt over parts, each of which gets the key's left rows."""
    parts = right.groupBy(key).agg(F.ceil(F.count(F.lit(1)) / most).cast("int").alias("_parts"))
    split = right.join(parts.filter("_parts > 1"), key, "left").withColumn("_part", F.pmod(F.xxhash64(*right.columns), F.coalesce("_parts", F.lit(1))).cast("int")).drop("_parts")
    asked = left.join(parts, key).withColumn("_part", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1))).drop("_parts")
    return asked.join(split, [key, "_part"]).drop("_part")


def contained_in(own: DataFrame, ref: DataFrame, own_words: str, ref_words: str) -> DataFrame:
    """Rows of own and ref joined where every word of own stands in ref; own without words meets nothing. Both have columns of distinct words, and no other name in common.

    Only the word of own that is rarest in ref is a key, after words that ref hasn't at all have ruled own out.
    """
    words = ref.select(F.explode(ref_words).alias("_word"))
    often = words.groupBy("_word").agg(F.count(F.lit(1)).alias("_n"))
    each = own.select(*[c for c in own.columns], F.explode(own_words).alias("_word")).join(often, "_word")
    probe = each.groupBy(*own.columns).agg(F.count(F.lit(1)).alias("_known"), F.min(F.struct("_n", "_word"))["_word"].alias("_key")).filter(F.col("_known") == F.size(own_words)).drop("_known")
    return meet(probe, ref.withColumn("_key", F.explode(ref_words)), "_key").filter(F.size(F.array_except(own_words, ref_words)) == 0).drop("_key")


def _words(text: Column) -> Column:
    return F.array_distinct(F.filter(F.split(text, " "), lambda w: w != ""))


def _letters(words: Column) -> Column:
    return F.aggregate(words, F.lit(0), lambda n, w: n + F.length(w))


def _grams(words: Column) -> Column:
    """The three-character parts of the words between spaces, one around each character; of equal ones each has its number."""
    each = F.sort_array(F.flatten(F.transform(words, lambda w: F.transform(F.sequence(F.lit(1), F.length(w)), lambda i: F.substr(F.concat(F.lit(" "), w, F.lit(" ")), i, F.lit(3))))))
    return F.transform(each, lambda g, i: F.concat(g, (i.cast("bigint") - F.array_position(each, g)).cast("string")))


def _described(df: DataFrame, key: str, text: str) -> DataFrame:
    """key, words, letters, size (of the distinct words with a space between two of them)."""
    out = df.select(F.col(key).alias("key"), _words(F.col(text)).alias("words")).filter(F.size("words") > 0).withColumn("letters", _letters(F.col("words")))
    return out.withColumn("size", F.col("letters") + F.size("words") - 1)


def _rare_first(rows: DataFrame, often: DataFrame, item: str, kept: Column) -> DataFrame:
    """rows (key, item, ...): of each key the items that `kept` leaves of `items`, its (n, item) structs from rare to frequent."""
    grouped = rows.join(often, item).groupBy("key", "need").agg(F.sort_array(F.collect_list(F.struct("n", F.col(item).alias("item")))).alias("items"))
    return grouped.select("key", F.explode(kept).alias("_i")).select("key", F.col("_i.item").alias(item))


def candidates(left: DataFrame, right: DataFrame, left_key: str, left_text: str, right_key: str, right_text: str, score: float) -> DataFrame:
    """(left_key, right_key, sure) of all pairs whose token_set_ratio can be `score` (80 or more) and more; sure: it is 100. Texts are words with single spaces; keys are distinct.

    That score is the best of three. Let a and b be the strings of the distinct words of each side, |a| their length, r = score / (200 - score).

    1. One side's words are all among the other's: 100. 2. The shared words against all words of one side, say a: they are at least r|a|
    long, so less than (1 - r)|a| is lost with the words that are not shared. For both it's enough to look for a side's rarest words until they take more
    than (1 - r) of its length: one of them is shared.

    3. Shared and own words of a against those of b, by their longest common subsequence, which is 2c >= score% of |a| + |b|; so d = |a| + |b| - 2c characters
    are taken out of a or put in, d <= (1 - score%)(|a| + |b|), and r|a| <= |b| <= |a| / r. Take the three-character parts around each
    character of a that is no space: one for each of its n letters, within its word and the spaces at its ends, wherever the word stands. A character taken out spoils
    three of them at most, one put in between two characters spoils two. With x taken out and y put in, b has at least n - 3x - 2y of them; x + y = d and
    x - y = |a| - |b|. That is least where b is as short as it may be: n - 3(1 - r)|a|. So two sides that reach the score share that many
    parts, and if each orders its parts from rare to frequent in the same way, they share one among each side's first n - t + 1.
    """
    ratio = score / (200 - score)
    a, b = (stored(_described(df.select(k, t).distinct(), k, t), "labels") for df, k, t in ((left, left_key, left_text), (right, right_key, right_text)))
    both = a.select("words").unionByName(b.select("words"))
    count = lambda df, item: df.groupBy(item).agg(F.count(F.lit(1)).alias("n"))
    often_word = count(both.select(F.explode("words").alias("word")), "word")
    often_gram = count(both.select(F.explode(_grams(F.col("words"))).alias("gram")), "gram")
    # 1 and 2: words from rare to frequent until they take more than (1 - r) of the length
    taken = lambda items: F.aggregate(items, F.lit(0), lambda n, x: n + F.length(x["item"]) + 1)
    rarest = F.filter("items", lambda x, i: taken(F.slice("items", F.lit(1), i)) <= F.col("need"))
    some_words = lambda df: _rare_first(df.select("key", ((1 - ratio) * F.col("size")).alias("need"), F.explode("words").alias("word")), often_word, "word", rarest)
    every_word = lambda df, name: df.select(F.col("key").alias(name), F.explode("words").alias("word"))
    named = lambda df, name: df.withColumnRenamed("key", name)
    by_word = meet(named(some_words(a), "_a"), every_word(b, "_b"), "word").select("_a", "_b").unionByName(meet(named(some_words(b), "_b"), every_word(a, "_a"), "word").select("_a", "_b"))
    # 3: parts from rare to frequent, n - t + 1 of them
    least = lambda n, size: F.greatest(F.ceil(n - 3 * (1 - ratio) * size - 1e-9), F.lit(1))
    first = F.slice("items", F.lit(1), F.col("need").cast("int"))
    some_grams = lambda df: _rare_first(df.select("key", (F.col("letters") - least(F.col("letters"), F.col("size")) + 1).alias("need"), F.explode(_grams(F.col("words"))).alias("gram")), often_gram, "gram", first)
    by_gram = meet(named(some_grams(a), "_a"), named(some_grams(b), "_b"), "gram").select("_a", "_b")
    pairs = by_word.withColumn("_w", F.lit(True)).unionByName(by_gram.withColumn("_w", F.lit(False))).groupBy("_a", "_b").agg(F.max("_w").alias("_w"))
    x, y = (df.select(F.col("key").alias(k), F.col("words").alias(f"w{k}"), F.col("letters").alias(f"n{k}"), F.col("size").alias(f"s{k}")) for df, k in ((a, "_a"), (b, "_b")))
    met = pairs.join(x, "_a").join(y, "_b").withColumn("shared", F.array_intersect("w_a", "w_b"))
    k = F.size("shared")
    sure = (k > 0) & ((k == F.size("w_a")) | (k == F.size("w_b")))
    long = _letters(F.col("shared")) + k - 1
    mostly = (k > 0) & (long >= ratio * F.least("s_a", "s_b") - 1e-9)
    in_length = (F.col("s_a") >= ratio * F.col("s_b") - 1e-9) & (F.col("s_b") >= ratio * F.col("s_a") - 1e-9)
    in_common = F.size(F.array_intersect(_grams(F.col("w_a")), _grams(F.col("w_b"))))
    enough = F.greatest(least(F.col("n_a"), F.col("s_a")), least(F.col("n_b"), F.col("s_b")))
    fits = F.when(sure | mostly, True).when(in_length, in_common >= enough).otherwise(False)
    return met.withColumn("sure", sure).filter(fits).select(F.col("_a").alias(left_key), F.col("_b").alias(right_key), "sure")
