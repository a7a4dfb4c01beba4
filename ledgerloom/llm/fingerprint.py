"""Document fingerprints: a bottom-k sketch of word-shingle hashes.

A sketch is the sorted array of the k smallest distinct 64-bit shingle hashes. Sketches of parts merge into the
sketch of the whole (the k smallest of their union), and two sketches estimate resemblance, containment and the
number of distinct shingles. All expressions are built in; no row leaves the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerloom.llm.common import WORD_BREAKS, fold_ascii, free_name, shuffle_width

#: Hashes are kept as 48-bit numbers: short in a fingerprint string, and collisions within two documents stay negligible.
SPACE_BITS = 48
SKETCH_SIZE, SHINGLE = 128, 5


def shingle_hashes(text: Column, words: int = SHINGLE) -> Column:
    """48-bit hashes of all shingles (with repeats) of a text with A-Z lower-cased; fewer words make one shingle, none no shingle."""
    w = F.filter(F.split(fold_ascii(F.coalesce(text, F.lit(""))), WORD_BREAKS), lambda x: x != "")
    return F.transform(F.array(w), lambda a: _over(a, words))[0]


def _over(a: Column, words: int) -> Column:
    cut48 = lambda h: F.shiftrightunsigned(h, 64 - SPACE_BITS)
    whole = F.array(cut48(F.xxhash64(F.array_join(a, " "))))
    many = F.transform(F.sequence(F.lit(0), F.size(a) - words), lambda i: cut48(F.xxhash64(*[F.get(a, i + j) for j in range(words)])))
    return F.when(F.size(a) >= words, many).when(F.size(a) > 0, whole).otherwise(F.array().cast("array<bigint>"))


def bottom_k(hashes: Column, k: int = SKETCH_SIZE) -> Column:
    """The k smallest distinct hashes in ascending order.

    First only hashes below a bound are sorted, which in a long text almost always holds k of them; where it doesn't, all are.
    """

    def of(h: Column) -> Column:
        bound = F.lit(float(2**SPACE_BITS)) * F.lit(1.5 * k) / F.greatest(F.size(h), F.lit(1))
        few = F.transform(F.array(F.array_distinct(F.filter(h, lambda x: x < bound))), lambda f: F.when(F.size(f) >= k, f).otherwise(F.array_distinct(h)))[0]
        return F.slice(F.array_sort(few), 1, k)

    return F.transform(F.array(hashes), of)[0]


def sketch(text: Column, k: int = SKETCH_SIZE, words: int = SHINGLE) -> Column:
    return bottom_k(shingle_hashes(text, words), k)


def merge(a: Column, b: Column, k: int = SKETCH_SIZE) -> Column:
    """The sketch of the union of the two sets."""
    return F.slice(F.array_sort(F.array_union(a, b)), 1, k)


def resemblance(a: Column, b: Column, k: int = SKETCH_SIZE) -> Column:
    """Estimated Jaccard similarity: the share of the union's bottom-k that both sketches hold; two empty sets give 1."""
    both = F.size(F.array_intersect(merge(a, b, k), F.array_intersect(a, b)))
    return F.when((F.size(a) == 0) & (F.size(b) == 0), F.lit(1.0)).otherwise(both / F.size(merge(a, b, k)))


def distinct_shingles(a: Column, k: int = SKETCH_SIZE) -> Column:
    """Estimated number of distinct shingles; exact below k."""
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise(F.lit(float(k - 1)) * F.lit(float(2**SPACE_BITS)) / F.element_at(a, k))


def containment(a: Column, b: Column, k: int = SKETCH_SIZE) -> Column:
    """Estimated share of a's shingles that b has too, at most 1; an empty a is contained in everything."""
    share = resemblance(a, b, k) * distinct_shingles(merge(a, b, k), k) / distinct_shingles(a, k)
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.least(share, F.lit(1.0)))


def encoded(a: Column) -> Column:
    """A sketch as a string: base64 of its hashes, six bytes each."""
    packed = F.unhex(F.array_join(F.transform(a, lambda x: F.lpad(F.hex(x), SPACE_BITS // 4, "0")), ""))
    return F.replace(F.base64(packed), F.lit("\r\n"), F.lit(""))


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = SKETCH_SIZE, words: int = SHINGLE) -> DataFrame:
    """One row for each row of df: doc_id, n_chars, sketch, n_shingles (estimate). Null text is empty; repeated rows have the same sketch; an empty df gives no rows; other columns are ignored."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    return df.select(F.col(f"`{id_col}`").alias("doc_id"), F.length(text).cast("long").alias("n_chars"), sketch(text, k, words).alias("sketch")).withColumn("n_shingles", distinct_shingles(F.col("sketch"), k))


def with_next(df: DataFrame, id_col: str, columns: list[str], derive=lambda d: d, spread: int = 3) -> DataFrame:
    """derive(df) with `next`, a struct of `columns` of the row that follows in ascending id_col; the first row follows the last.

    The id range is cut at quantiles into buckets; each bucket is one window group, and a copy of the first row of
    the next bucket closes it, so no task sees more than a bucket. At most spread x shuffle partitions bounds and as
    many bucket heads are collected. Ties are ordered by `columns`; null ids come first. derive must keep all rows. Identifiers are
    numbers, as quantiles are taken of them; a column named next is overwritten.
    """
    spark = df.sparkSession
    bucket, ghost, head, to = (free_name(df, n) for n in ("bucket", "ghost", "head", "to"))
    n = max(2, spread * shuffle_width(spark))
    bounds = sorted(set(df.select(F.percentile_approx(F.col(id_col), [i / n for i in range(1, n)], 100 * n).alias("b")).first()["b"] or []))

    # how many bounds are at the id or below it, by binary search: the steps are powers of two, from the largest
    steps = F.lit([1 << k for k in range(len(bounds).bit_length() - 1, -1, -1)] or [1])
    array = F.lit(bounds) if bounds else F.array().cast(f"array<{dict(df.dtypes)[id_col]}>")
    place = F.aggregate(steps, F.lit(0), lambda at, step: F.when(F.get(array, at + step - 1) <= F.col(id_col), at + step).otherwise(at))
    dealt = df.withColumn(bucket, F.when(F.col(id_col).isNull(), F.lit(0)).otherwise(place)).withColumn(ghost, F.lit(0))
    first = F.min(F.struct(F.col(id_col).isNotNull().alias("known"), F.col(id_col).alias("id")))
    heads = dealt.groupBy(bucket).agg(first.alias("first")).orderBy(bucket).collect()  # one row for each bucket
    if not heads:
        return derive(df).withColumn("next", F.struct(*columns))
    before = [(heads[i]["first"]["id"], heads[i - 1][bucket]) for i in range(len(heads))]
    named = spark.createDataFrame(before, f"`{head}` {dict(df.dtypes)[id_col]}, `{to}` int")
    ghosts = dealt.join(F.broadcast(named), dealt[id_col].eqNullSafe(named[head])).withColumn(bucket, F.col(to)).withColumn(ghost, F.lit(1)).select(*dealt.columns)
    order = W.partitionBy(bucket).orderBy(ghost, id_col, *columns)
    return derive(dealt).unionByName(derive(ghosts)).withColumn("next", F.lead(F.struct(*columns)).over(order)).filter(F.col(ghost) == 0).drop(bucket, ghost)
