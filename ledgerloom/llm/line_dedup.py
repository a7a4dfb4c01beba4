"""Line deduplication by winnowing over line hashes.

A document is the sequence of its lines' hashes. A window is a shortest stretch of lines with at least min_words words,
from each line on and up to each line; of each window the line with the smallest hash is its fingerprint. Two documents
that share a run of min_words words share whole windows, and so their fingerprints: no such run is missed.

Fingerprints join by position with the first place (smallest document, then position) of the same hash and window. The window is part of the
key, since the same line may occur first where no run is shared: two later documents would then meet that place only, and not each other.
Each match is an alignment of two documents, along which runs of equal lines are extended both ways. Runs of min_words words or more
are deleted from the later document.

Each deleted line equals a line at an earlier place, so the first occurrence of everything stays.
Hashes shared by very many documents are first reduced within runs of rows, and the joins on them use run and hash. A document that very many
others align with is salted, and one that aligns with very many others has its alignments dealt over several groups.
"""

from __future__ import annotations

from collections import deque

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import free_name, shuffle_width, text_slices, written

MIN_WORDS = 50
#: Alignments with one document that share a join key.
SALT_AT = 2_000
#: At most so many salted documents are broadcast; beyond, they are joined.
HOT_MOST = 50_000
#: Alignments of one later document that are extended in one group.
ALIGNED_MOST = 500
_PRIME, _BASE = (1 << 61) - 1, 0x1F3D5B79A2C4E68B


def windows(words: list[int], min_words: int) -> list[tuple[int, int]]:
    """Shortest stretches [i, j) of min_words words or more from each line on, and up to each line; both ends ascend."""
    found, total, end = [], 0, 0
    for i in range(len(words)):
        while end < len(words) and total < min_words:
            total += words[end]
            end += 1
        if total < min_words:
            break
        found.append((i, end))
        total -= words[i]
    back, total, start = [], 0, 0
    for j in range(len(words)):
        total += words[j]
        while total - words[start] >= min_words:
            total -= words[start]
            start += 1
        if total >= min_words:
            back.append((start, j + 1))
    return sorted({*found, *back})


def fingerprints(hashes: list[int], words: list[int], min_words: int) -> list[tuple[int, int, int]]:
    """(start, place of the smallest hash, hash of the content) of each window; of equal hashes the last."""
    sums = [0]
    for h in hashes:
        sums.append((sums[-1] * _BASE + h) % _PRIME)
    out, ahead, end = [], deque(), 0
    for i, j in windows(words, min_words):
        while end < j:
            while ahead and hashes[ahead[-1]] >= hashes[end]:
                ahead.pop()
            ahead.append(end)
            end += 1
        while ahead[0] < i:
            ahead.popleft()
        best = ahead[0] if end == j else min(range(i, j), key=lambda k: (hashes[k], -k))
        out.append((i, best, (sums[j] - sums[i] * pow(_BASE, j - i, _PRIME)) % _PRIME))
    return out


def _lines(batches, min_words: int):
    import xxhash

    for batch in text_slices(batches):
        hashes, words, marks = [], [], []
        for text in batch.column(1).to_pylist():
            lines = (text or "").split("\n")
            own = [xxhash.xxh64_intdigest(line.encode()) - (1 << 63) for line in lines]
            count = [len(line.split()) for line in lines]
            hashes.append(own)
            words.append(count)
            marks.append([{"at": a, "low": k, "key": key} for a, k, key in fingerprints(own, count, min_words)])
        kinds = pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.struct([("at", pa.int32()), ("low", pa.int32()), ("key", pa.int64())]))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), *map(pa.array, (hashes, words, marks), kinds)], names=["doc", "version", "hashes", "words", "marks"])


def _removed(hashes: list[int], words: list[int], alignments, min_words: int) -> list[int]:
    """Positions in runs of at least min_words words along any (offset, hashes of the earlier document from offset `low` on)."""
    own, weight = np.array(hashes, np.int64), np.array(words, np.int64)
    gone = np.zeros(len(own), bool)
    for offset, low, other in alignments:
        start = low + offset  # the first own position that other covers
        n = min(len(own) - start, len(other))
        same = np.zeros(len(own) + 2, np.int8)
        same[start + 1 : start + 1 + n] = own[start : start + n] == np.array(other[:n], np.int64)
        edge = np.diff(same)
        for a, b in zip((edge == 1).nonzero()[0], (edge == -1).nonzero()[0], strict=True):
            if weight[a:b].sum() >= min_words:
                gone[a:b] = True
    return gone.nonzero()[0].tolist()


def repeated_lines(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """doc, version (a hash of the text) and `removed`, the positions of lines to delete, for each row with any."""
    kind = dict(df.dtypes)[id_col]
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    rows = df.select(F.col(f"`{id_col}`").alias("doc"), text.alias("text"), F.xxhash64(text).alias("version"))
    docs = written(rows.mapInArrow(lambda b: _lines(b, min_words), f"doc {kind}, version bigint, hashes array<bigint>, words array<int>, marks array<struct<at:int,low:int,key:bigint>>"), "lines")

    runs = shuffle_width(df.sparkSession)
    # fingerprints: the places of window minima, each with the contents of the windows whose minimum it is
    marks = docs.select("doc", "version", F.explode(F.transform("marks", lambda m: F.struct(m["low"].alias("low"), m["key"].alias("key"), F.get("hashes", m["low"]).alias("hash")))).alias("m"))
    marks = marks.select("doc", "version", "m.*", F.pmod(F.xxhash64("doc", "version"), F.lit(runs)).alias("run"))

    def places(rows: DataFrame, *key: str) -> DataFrame:
        """rows with the first fingerprint of their key, if there are several; reduced within runs first, and joined by run and key."""
        place = F.struct("doc", "version", "low")
        near = rows.groupBy("run", *key).agg(F.min(place).alias("first"), F.max(place).alias("last"))
        whole = near.groupBy(*key).agg(F.min("first").alias("first"), F.max("last").alias("last")).filter("first < last").select(*key, "first")
        return rows.join(near.select("run", *key).join(whole, [*key]), ["run", *key])

    # Fingerprints meet on their hash; of those that occur again, on hash and window, since the first place of a line may be in another context.
    met = places(places(marks, "hash").drop("first"), "hash", "key").select("doc", "version", "low", "first")
    met = met.filter(~(F.col("doc").eqNullSafe(F.col("first.doc")) & (F.col("version") == F.col("first.version")) & (F.col("low") == F.col("first.low"))))
    pairs = met.select("doc", "version", F.col("first.doc").alias("other"), F.col("first.version").alias("other_version"), (F.col("low") - F.col("first.low")).alias("offset")).distinct()

    pairs = written(pairs, "alignments")
    own = docs.select("doc", "version", F.size("hashes").alias("lines")).dropDuplicates(["doc", "version"])
    pairs = pairs.alias("p").join(own.alias("o"), F.expr("p.doc <=> o.doc AND p.version = o.version")).select("p.*", "lines")
    # The part of the other document that lies beside this one, from its line `low` on.
    pairs = pairs.withColumn("low", F.greatest(F.lit(0), -F.col("offset")))
    # Documents that many others align with get salts: their rows are repeated, and their alignments dealt over them.
    hot = pairs.groupBy(F.col("other").alias("h_doc"), F.col("other_version").alias("h_version")).agg(F.ceil(F.count(F.lit(1)) / SALT_AT).cast("int").alias("salts")).filter("salts > 1")
    if hot.limit(HOT_MOST + 1).count() <= HOT_MOST:
        hot = F.broadcast(hot)
    pairs = pairs.join(hot, F.expr("other <=> h_doc AND other_version = h_version"), "left").withColumn("salt", F.expr("pmod(xxhash64(doc, version, offset), coalesce(salts, 1))").cast("int")).drop("h_doc", "h_version", "salts")
    others = docs.select(F.col("doc").alias("o_doc"), F.col("version").alias("o_version"), F.col("hashes").alias("o_hashes")).dropDuplicates(["o_doc", "o_version"])
    others = others.join(hot, F.expr("o_doc <=> h_doc AND o_version = h_version"), "left").select("o_doc", "o_version", "o_hashes", F.explode(F.expr("sequence(0, coalesce(salts, 1) - 1)")).alias("o_salt"))
    beside = pairs.join(others, F.expr("other <=> o_doc AND other_version = o_version AND salt = o_salt"))
    beside = beside.select(F.col("doc").alias("b_doc"), F.col("version").alias("b_version"), F.col("other").alias("b_other"), F.col("other_version").alias("b_other_version"), "offset", "low", F.slice("o_hashes", (F.col("low") + 1).cast("int"), F.col("lines")).alias("beside"))
    # A document that aligns with very many others has its alignments dealt over several groups, each with the document's own lines.
    parts = pairs.groupBy("doc", "version").agg(F.ceil(F.count(F.lit(1)) / ALIGNED_MOST).cast("int").alias("parts"))
    beside = beside.alias("b").join(parts.alias("p"), F.expr("b.b_doc <=> p.doc AND b.b_version = p.version")).select("b.*", F.expr("pmod(xxhash64(b.b_other, b.b_other_version, b.offset), p.parts)").cast("int").alias("b_part")).drop("b_other", "b_other_version")
    lines = docs.select("doc", "version", "hashes", "words").dropDuplicates(["doc", "version"])
    touched = lines.alias("l").join(parts.alias("p"), F.expr("l.doc <=> p.doc AND l.version = p.version"))
    touched = touched.select(*[F.col(f"l.{c}").alias(f"t_{c}") for c in ("doc", "version", "hashes", "words")], F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("t_part"))

    def find(own: pa.Table, beside: pa.Table) -> pa.Table:
        found = []
        if beside.num_rows and own.num_rows:
            row = own.select(["t_hashes", "t_words"]).slice(0, 1).to_pylist()[0]
            found = _removed(row["t_hashes"], row["t_words"], zip(*(beside.column(c).to_pylist() for c in ("offset", "low", "beside")), strict=True), min_words)
        n = int(bool(found))
        return pa.table({"doc": own.column("t_doc").slice(0, n), "version": own.column("t_version").slice(0, n), "removed": pa.array([found] * n, pa.list_(pa.int32()))})

    found = touched.groupBy("t_doc", "t_version", "t_part").cogroup(beside.groupBy("b_doc", "b_version", "b_part")).applyInArrow(find, f"doc {kind}, version bigint, removed array<int>")
    return found.groupBy("doc", "version").agg(F.array_distinct(F.flatten(F.collect_list("removed"))).alias("removed"))


def dedup_lines(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """df with text_col cleaned, and n_lines, n_removed (both long).

    A line is what newlines separate; its words are what white space separates. Null text stays null and has no lines;
    a text that loses all its lines becomes empty. Rows that repeat identifier and text are one document, and all of
    them stay as they are. Columns of any other name pass through, those named n_lines and n_removed are overwritten; an empty df gives no rows.
    """
    doc, version, removed, own_version = (free_name(df, n) for n in ("gone_doc", "gone_version", "gone_lines", "own_version"))
    gone = repeated_lines(df, id_col, text_col, min_words).select(F.col("doc").alias(doc), F.col("version").alias(version), F.col("removed").alias(removed))
    text = F.col(f"`{text_col}`")
    own = df.withColumn(own_version, F.xxhash64(F.coalesce(text, F.lit(""))))
    joined = own.join(gone, own[f"`{id_col}`"].eqNullSafe(gone[doc]) & (own[own_version] == gone[version]), "left")
    lines = F.split(text, "\n", -1)
    kept = F.array_join(F.filter(lines, lambda x, i: ~F.coalesce(F.array_contains(removed, i), F.lit(False))), "\n")
    joined = joined.withColumn("n_lines", F.when(text.isNull(), F.lit(0)).otherwise(F.size(lines)).cast("long"))
    joined = joined.withColumn("n_removed", F.when(F.col(removed).isNull(), F.lit(0)).otherwise(F.size(removed)).cast("long"))
    return joined.withColumn(text_col, F.when(F.col(removed).isNull(), text).otherwise(kept)).drop(doc, version, removed, own_version)
