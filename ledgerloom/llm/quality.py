"""Quality classification by a character n-gram language model with interpolated modified Kneser-Ney smoothing.

The model is trained on trusted text. Counts, continuation counts, discounts and probabilities are tables keyed by
n-gram, made with joins and aggregates. Scoring is by sharded count joins: documents are dealt into blocks of about
BLOCK characters by a hash of identifier and text; a block asks once for each distinct n-gram it holds, the requests meet
the model's shards in a join on the n-gram, and the answers go back to the block, where every document's perplexity is
added up. So neither the model nor the documents are broadcast, and what is asked for is a small share of the text.

A document is rejected if the logarithm of its perplexity exceeds its language's limit plus allowance / sqrt(characters).
The limit is a quantile of the same figure (log perplexity less that allowance) over trusted documents of the language
that the model has not seen. The allowance is about one standard error: the log probability of a character of prose has a
standard deviation of about 2, so the mean over a short text strays further. Languages with few such documents use the
quantile over all.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import text_slices, written

ORDER, BLOCK = 4, 24_000_000
#: Bytes of text whose n-grams are in memory at once; the arrays take some eighty times as much.
SLICE = 500_000
#: Trusted rows: those that train the model, and those of fold 0 that only give the limits.
TRAIN, HELD, FOLDS = 1, 2, 5
#: Identifiers of at most so many trusted rows are broadcast; beyond, they are joined.
MARKS_BROADCAST = 1_000_000
#: Limits of at most so many languages are broadcast.
LANGUAGES = 10_000
#: Fills the places before a text's first character; in texts it is taken as a space.
PAD = "\x02"
_R = np.uint64(0x9E3779B97F4A7C15)


def _codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts, each behind ORDER - 1 pads; and the place of each text's first character, with the end."""
    own = [t.replace(PAD, " ") for t in texts]
    pad = PAD * (ORDER - 1)
    codes = np.frombuffer((pad + pad.join(own)).encode("utf-32-le", "surrogatepass"), np.uint32) if own else np.zeros(0, np.uint32)
    first = np.cumsum([0, *(len(t) + ORDER - 1 for t in own)]) + ORDER - 1
    return codes, first


def _keys(codes: np.ndarray, n: int, ends: np.ndarray) -> np.ndarray:
    """64-bit keys of the n code points that end at each of `ends`; never 0."""
    key = np.full(len(ends), n, np.uint64)
    for k in range(n - 1, -1, -1):
        key = (key ^ codes[ends - k].astype(np.uint64)) * _R
        key ^= key >> np.uint64(31)
    return key | np.uint64(1)


def _unique(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """np.unique with index and counts, mostly by one scatter into a table instead of a sort."""
    slot = (keys >> np.uint64(46)).astype(np.int64)  # 2**18 slots
    place = np.zeros(1 << 18, np.int64)
    place[slot] = np.arange(len(keys))
    same = keys == keys[place[slot]]
    count = np.bincount(slot[same], minlength=1 << 18)
    hit = count.nonzero()[0]
    rest = (~same).nonzero()[0]
    k, i, c = np.unique(keys[rest], return_index=True, return_counts=True)
    return np.concatenate([keys[place[hit]], k]), np.concatenate([place[hit], rest[i]]), np.concatenate([count[hit], c])


class _Distinct:
    """Distinct n-grams of full ORDER in a block, with their counts in the text that trains the model."""

    def __init__(self):
        self.keys, self.grams, self.counts = np.zeros(0, np.uint64), np.zeros((0, ORDER), np.uint32), np.zeros(0, np.int64)
        self.new, self.waiting = [], 0

    def add(self, texts: list[str], trusted: bool) -> None:
        codes, first = _codes(texts)
        inside = np.ones(len(codes), bool)
        for k in range(1, ORDER):
            inside[first[:-1] - k] = False
        ends = inside.nonzero()[0]
        keys, at, count = _unique(_keys(codes, ORDER, ends))
        grams = codes[ends[at][:, None] + np.arange(1 - ORDER, 1)]
        self.new.append((keys, grams, count if trusted else np.zeros_like(count)))
        self.waiting += len(keys)
        if self.waiting > 500_000:
            self.merge()

    def merge(self) -> None:
        keys, grams, counts = (np.concatenate(x) for x in zip((self.keys, self.grams, self.counts), *self.new, strict=True))
        self.keys, at, place = np.unique(keys, return_index=True, return_inverse=True)
        self.grams, self.counts = grams[at], np.bincount(place, counts, len(at)).astype(np.int64)
        self.new, self.waiting = [], 0

    def asked(self) -> tuple[list[str], np.ndarray]:
        """All grams whose probability or back-off weight a text of the block may need, those of full ORDER first, and their counts (0 for shorter ones).

        Shorter grams are ends of full ones, and contexts are their beginnings without the last character.
        """
        self.merge()
        every = self.grams.tobytes().decode("utf-32-le", "surrogatepass")
        full = [every[i : i + ORDER] for i in range(0, len(every), ORDER)]
        shorter = set()
        for n in range(1, ORDER):
            shorter.update({g[-n:] for g in full}, {g[ORDER - 1 - n : ORDER - 1] for g in full})
        return full + sorted(shorter), np.append(self.counts, np.zeros(len(shorter), np.int64))


def _requests(docs: pa.Table) -> pa.Table:
    out = _Distinct()
    for batch in text_slices(docs.select(["mark", "text"]).to_batches(), limit=SLICE):
        marks, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        for flag in (True, False):
            if part := [t for m, t in zip(marks, texts, strict=True) if t and (m == TRAIN) == flag]:
                out.add(part, flag)
    grams, counts = out.asked()
    return pa.table({"block": pa.array([docs.column("block")[0].as_py()] * len(grams), pa.int64()), "gram": pa.array(grams, pa.string()), "c": pa.array(counts)})


class _Scorer:
    """Log probabilities of a block's text, from the answers: gram, logp, bow (null: none)."""

    def __init__(self, answers: pa.Table, unknown: float):
        self.unknown = unknown
        self.by_n = {}
        grams = answers.column("gram").to_pylist()
        logp = answers.column("logp").to_numpy().astype(np.float64)
        bow = answers.column("bow").to_numpy().astype(np.float64)
        length = np.array([len(g) for g in grams], np.int64)
        for n in range(1, ORDER + 1):
            at = (length == n).nonzero()[0]
            codes = np.frombuffer("".join([grams[i] for i in at]).encode("utf-32-le", "surrogatepass"), np.uint32)
            keys = _keys(codes, n, np.arange(len(at)) * n + n - 1)
            order = np.argsort(keys)
            table = np.full(1 << 20, -1, np.int32)
            table[(keys[order] >> np.uint64(44)).astype(np.int64)] = np.arange(len(order))
            self.by_n[n] = keys[order], logp[at][order], bow[at][order], table

    def _find(self, n: int, keys: np.ndarray) -> np.ndarray:
        """The place of each key among the answers of n characters, or -1."""
        known, _, _, table = self.by_n[n]
        if not len(known):
            return np.full(len(keys), -1)
        at = table[(keys >> np.uint64(44)).astype(np.int64)]
        miss = ((at >= 0) & (known[at] != keys)).nonzero()[0]
        if len(miss):
            p = np.minimum(np.searchsorted(known, keys[miss]), len(known) - 1)
            at[miss] = np.where(known[p] == keys[miss], p, -1)
        return at

    def add_up(self, texts: list[str]) -> np.ndarray:
        codes, first = _codes(texts)
        total = np.zeros(len(codes))
        inside = np.ones(len(codes), bool)
        for k in range(1, ORDER):
            inside[first[:-1] - k] = False
        ends = inside.nonzero()[0]
        for n in range(ORDER, 0, -1):
            if not len(ends):
                break
            at = self._find(n, _keys(codes, n, ends))
            hit = at >= 0
            p = np.where(hit, self.by_n[n][1][at] if len(self.by_n[n][1]) else np.nan, np.nan)
            hit = ~np.isnan(p)
            total[ends[hit]] += p[hit]
            ends = ends[~hit]
            if n > 1 and len(ends):
                at = self._find(n - 1, _keys(codes, n - 1, ends - 1))
                b = np.where(at >= 0, self.by_n[n - 1][2][at] if len(self.by_n[n - 1][2]) else 0.0, 0.0)
                total[ends] += np.nan_to_num(b)
        total[ends] += self.unknown
        return np.add.reduceat(np.append(total, 0.0), np.minimum(first[:-1], len(total))) if len(texts) else np.zeros(0)


def kneser_ney(counts: DataFrame) -> tuple[DataFrame, float]:
    """The model of (gram, c), counts of all n-grams of full ORDER: a table gram, logp, bow, and an unknown character's log probability.

    logp is null for a gram that is only a context, bow is null for one that never is.
    """
    by_n = {ORDER: counts}
    for n in range(ORDER - 1, 0, -1):
        by_n[n] = by_n[n + 1].groupBy(F.substring("gram", 2, n).alias("gram")).agg(F.count(F.lit(1)).alias("c"))
    tallies = None
    for n, g in by_n.items():  # counts of counts: one row for each order
        row = g.agg(F.lit(n).alias("n"), F.count(F.lit(1)).alias("types"), *[F.count(F.when(F.col("c") == k, 1)).alias(f"n{k}") for k in (1, 2, 3, 4)])
        tallies = row if tallies is None else tallies.unionByName(row)
    stats = {r["n"]: r for r in tallies.collect()}
    vocabulary = stats[1]["types"] + 1

    def discounts(n: int) -> list[float]:
        n1, n2, n3, n4 = (stats[n][f"n{k}"] for k in (1, 2, 3, 4))
        if not (n1 and n2 and n3):  # too few counts to estimate them
            return [0.5, 0.75, 0.9]
        y = n1 / (n1 + 2 * n2)
        return [min(max(d, 0.05), k + 0.95) for k, d in enumerate((1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3))]

    lower, backoffs, unknown = None, {}, float(np.log(1 / vocabulary))
    out = []
    for n in range(1, ORDER + 1):
        d1, d2, d3 = discounts(n)
        minus = F.when(F.col("c") == 1, d1).when(F.col("c") == 2, d2).otherwise(d3)
        context = F.substring("gram", 1, n - 1) if n > 1 else F.lit("")
        grams = by_n[n].withColumn("context", context)
        sums = grams.groupBy("context").agg(F.sum("c").alias("s"), F.sum(minus).alias("held"))
        if n == 1:
            whole = sums.first()
            bow = whole["held"] / whole["s"] if whole else 1.0
            unknown = float(np.log(bow / vocabulary))
            p = grams.select("gram", ((F.col("c") - minus) / (whole["s"] if whole else 1) + bow / vocabulary).alias("p"))
        else:
            rest = lower.select(F.col("gram").alias("suffix"), F.col("p").alias("q"))
            p = grams.withColumn("suffix", F.substring("gram", 2, n - 1)).join(sums, "context").join(rest, "suffix")
            p = p.select("gram", ((F.col("c") - minus) / F.col("s") + F.col("held") / F.col("s") * F.col("q")).alias("p"))
            backoffs[n - 1] = sums.select(F.col("context").alias("gram"), F.log(F.col("held") / F.col("s")).alias("bow"))
        lower = p
        out.append(p.select("gram", F.log("p").alias("logp")))
    model = out[-1].withColumn("bow", F.lit(None).cast("double"))
    for n in range(1, ORDER):
        model = model.unionByName(out[n - 1].join(backoffs[n], "gram", "full_outer").select("gram", "logp", "bow"))
    return model, unknown


def _scored(df: DataFrame, marks: DataFrame, id_col: str, text_col: str, keep_cols: tuple[str, ...]) -> DataFrame:
    """perplexities(), where marks (id, mark) says which rows train the model; mark is null for a row without one."""
    q = lambda c: F.col(f"`{c}`")
    size = df.agg(F.sum(F.length(q(text_col)))).first()[0] or 0
    blocks = max(1, -(-size // BLOCK))
    kept = {c: "text" if c == text_col else f"keep_{i}" for i, c in enumerate(keep_cols)}  # text goes through Python once
    rows = df.select(q(id_col).alias("id"), q(text_col).alias("text"), *[q(c).alias(k) for c, k in kept.items() if k != "text"])
    marks = marks.groupBy("id").agg(F.min("mark").alias("mark"))
    if marks.limit(MARKS_BROADCAST + 1).count() <= MARKS_BROADCAST:
        marks = F.broadcast(marks)
    rows = rows.join(marks, "id", "left").withColumn("block", F.pmod(F.xxhash64("id", "text"), F.lit(blocks)).cast("long"))
    asked = written(rows.select("block", "mark", "text").groupBy("block").applyInArrow(_requests, "block bigint, gram string, c bigint"), "ngrams")
    model, unknown = kneser_ney(asked.filter(f"char_length(gram) = {ORDER} AND c > 0").groupBy("gram").agg(F.sum("c").alias("c")))
    answers = written(asked.select("block", "gram").join(model, "gram").select("block", "gram", "logp", "bow"), "answers")
    through = ["id", "mark", *dict.fromkeys(kept.values())]

    def score(docs: pa.Table, answers: pa.Table) -> pa.Table:
        scorer = _Scorer(answers, unknown)
        values, sizes = [], []
        for batch in text_slices(docs.select(["mark", "text"]).to_batches(), limit=SLICE):
            texts = [t or "" for t in batch.column(1).to_pylist()]
            values += iter_values(texts, scorer.add_up([t for t in texts if t]))
            sizes += map(len, texts)
        return pa.table({c: docs.column(c) for c in through} | {"log_perplexity": pa.array(values, pa.float64()), "n_chars": pa.array(sizes, pa.int64())})

    types = dict(rows.dtypes)
    out = rows.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(score, ", ".join(f"{c} {types[c]}" for c in through) + ", log_perplexity double, n_chars bigint")
    return out.select("id", "mark", "log_perplexity", "n_chars", *[F.col(k).alias(f"keep_{i}") for i, k in enumerate(kept.values())])


def perplexities(df: DataFrame, trusted: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep_cols: tuple[str, ...] = ()) -> DataFrame:
    """One row for each row of df: id, log_perplexity (null without text), n_chars, is_trusted, and keep_cols as keep_0, keep_1 and so on.

    trusted: identifiers (first column; repeats and nulls don't matter) of the rows of df that train the model. Mean log probability is over the
    characters of the whole text. Without any trusted text every character is equally unlikely.
    """
    marks = trusted.select(F.col(f"`{trusted.columns[0]}`").alias("id"), F.lit(TRAIN).alias("mark")).filter("id IS NOT NULL")
    out = _scored(df, marks, id_col, text_col, keep_cols)
    return out.withColumn("is_trusted", F.coalesce(F.col("mark") == TRAIN, F.lit(False))).drop("mark")


def iter_values(texts: list[str], sums: np.ndarray) -> list[float | None]:
    """-sum / length for each text, None for an empty one; sums are of the others."""
    rest = iter(sums.tolist())
    return [-next(rest) / len(t) if t else None for t in texts]


def _judged(df: DataFrame, trusted: DataFrame, id_col: str, text_col: str, lang_col: str, keep_cols: tuple[str, ...], quantile: float, allowance: float, least: int) -> DataFrame:
    """id, keep_0 (the language), keep_1 ..., log_perplexity, limit, kept."""
    good = trusted.select(F.col(f"`{trusted.columns[0]}`").alias("id")).filter("id IS NOT NULL")
    marks = good.withColumn("mark", F.when(F.crc32(F.col("id").cast("string")) % FOLDS == 0, HELD).otherwise(TRAIN))
    scored = written(_scored(df, marks, id_col, text_col, (lang_col, *keep_cols)), "scored")
    own = scored.filter((F.col("mark") == HELD) & F.col("log_perplexity").isNotNull())
    at = F.percentile_approx(F.col("log_perplexity") - allowance / F.sqrt("n_chars"), quantile, 10_000)
    limits = own.groupBy(F.col("keep_0").alias("lang")).agg(at.alias("l"), F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least).select("lang", "l")
    overall = own.agg(at.alias("l")).first()["l"]
    if limits.limit(LANGUAGES + 1).count() <= LANGUAGES:
        limits = F.broadcast(limits)
    joined = scored.join(limits, F.expr("keep_0 <=> lang"), "left")
    out = joined.withColumn("limit", F.coalesce(F.col("l"), F.lit(overall).cast("double")) + allowance / F.sqrt(F.greatest("n_chars", F.lit(1))))
    return out.withColumn("kept", F.coalesce(F.col("log_perplexity") <= F.col("limit"), F.lit(True)))


def classify(df: DataFrame, trusted: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", quantile: float = 0.995, allowance: float = 2.0, least: int = 50) -> DataFrame:
    """One row for each row of df: id_col, lang_col, log_perplexity, limit, kept.

    trusted: identifiers of trusted rows; those whose crc32 (as text) is divisible by FOLDS don't train the model but give the limits, so that a
    limit is not a quantile over what the model has seen. A language with fewer than `least` of them has the limit of all; without any, all is kept.
    A document without text has no perplexity and is kept. A null language is a language of its own. Repeated rows are scored alike, ties
    at the limit are kept. Other columns of df are ignored; an empty df gives no rows.
    """
    out = _judged(df, trusted, id_col, text_col, lang_col, (), quantile, allowance, least)
    return out.select(F.col("id").alias(id_col), F.col("keep_0").alias(lang_col), "log_perplexity", "limit", "kept")


def accepted(df: DataFrame, trusted: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", quantile: float = 0.995, allowance: float = 2.0, least: int = 50) -> DataFrame:
    """The rows of df that classify keeps, with all columns of df, whatever their names."""
    rest = tuple(c for c in df.columns if c not in (id_col, lang_col))
    out = _judged(df, trusted, id_col, text_col, lang_col, rest, quantile, allowance, least).filter("kept")
    names = {id_col: "id", lang_col: "keep_0"} | {c: f"keep_{i + 1}" for i, c in enumerate(rest)}
    return out.select(*[F.col(names[c]).alias(c) for c in df.columns])
