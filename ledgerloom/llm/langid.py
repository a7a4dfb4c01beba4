"""Language identification by error-correcting output codes over character n-grams.

Every language has a codeword. For each bit of the codewords a binary n-gram classifier (log ratio of the smoothed
n-gram probabilities on the two sides of the bit) gives a margin for a stretch of text. Decoding adds, over the bits, the
logistic loss of the margin against the codeword's bit, weighted by how surely that bit's classifier tells that
language's own text, and over the stretches; the language of least loss is predicted. Its mean share of the stretches'
likelihood is the score, so that a text of two languages is marked as ambiguous, however long it is.

Training counts all n-grams of all labelled texts, map-side first. Prediction is one pass without a shuffle.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import text_slices, written

FEATURE_BITS = 15
#: Features of the stretches that a text is decoded in, about; some 130 letters.
STRETCH = 256
#: Languages whose counts a training task holds before it passes them on.
LANGUAGES_AT_ONCE = 200
COUNTS = pa.schema([("lang", pa.string()), ("feature", pa.int64()), ("n", pa.int64())])
_NO_LETTER = re.compile(r"[\W\d_]+")
UNKNOWN = "und"


def letters_of(text: str | None) -> str:
    """The text's letters in lower case, runs of anything else as one space; empty where there is no letter."""
    own = _NO_LETTER.sub(" ", (text or "").lower()).strip(" ")
    return own if any(map(str.isalpha, own[:64])) or any(map(str.isalpha, own)) else ""


def features(text: str) -> np.ndarray:
    """Hashed byte bigrams and trigrams of one letters_of() text, with repeats; also a single letter has some."""
    raw = np.frombuffer(f" {text}  ".encode(), np.uint8).astype(np.uint32)
    two = raw[:-1] << np.uint32(8) | raw[1:]
    three = two[:-1] << np.uint32(8) | raw[2:]
    found = np.empty(len(two) + len(three), np.uint32)
    np.multiply(two, np.uint32(0x9E3779B1), out=found[: len(two)])
    np.multiply(three, np.uint32(0x85EBCA6B), out=found[len(two) :])
    found >>= np.uint32(32 - FEATURE_BITS)
    return found


def codewords(n: int, seed: int = 7) -> np.ndarray:
    """n rows of +1 and -1: every split of the languages up to 6 of them, else random words of about 10 log2(n) bits."""
    if n <= 1:
        return np.ones((n, 0), np.int8)
    if n <= 6:
        splits = range(1, 2 ** (n - 1))
        return np.array([[1 if i and s >> (i - 1) & 1 else -1 for s in splits] for i in range(n)], np.int8)
    rng, bits = np.random.default_rng(seed), int(np.ceil(10 * np.log2(n)))
    while True:
        words = rng.choice(np.array([-1, 1], np.int8), (n, bits))
        if len({w.tobytes() for w in words}) == n and (abs(words.sum(0)) < n).all():
            return words


class Model:
    """Languages in order, their codewords, a weight for each feature and bit, and how sure each bit's classifier is of each language's own text."""

    def __init__(self, languages: list[str], weights: np.ndarray, sure: np.ndarray):
        self.languages, self.code, self.weights = languages, codewords(len(languages)), weights.astype(np.float32)
        sure = 1 / (1 + np.exp(-20 * sure * self.code))
        self.sure = sure / np.maximum(sure.sum(1, keepdims=True), 1e-9)

    def predict(self, text: str | None, ambiguous_below: float = 0.8) -> tuple[str, float, bool]:
        """Language, score and ambiguity. The text is decoded in stretches of about STRETCH features; the least loss over all of them decides, and the score is the language's mean share of likelihood."""
        own = letters_of(text)
        if not own or not self.languages:
            return UNKNOWN, 0.0, True
        if len(self.languages) == 1:
            return self.languages[0], 1.0, False
        found = features(own)
        count = max(1, len(found) // STRETCH)
        edge = np.arange(count + 1) * len(found) // count
        margins = np.empty((count, self.weights.shape[1]))
        for at in range(0, count, 256):  # a long text's weights are not all there at once
            part = edge[at : at + 257]
            margins[at : at + 256] = np.add.reduceat(self.weights[found[part[0] : part[-1]]].astype(np.float64), part[:-1] - part[0], 0)
        # logistic loss of each stretch's margins against each codeword, without a stretches x languages x bits array
        loss = np.empty((count, len(self.languages)))
        for k, (word, weight) in enumerate(zip(self.code, self.sure, strict=True)):
            loss[:, k] = np.logaddexp(0, -margins * word) @ weight
        total = loss.sum(0)
        best = int(total.argmin())
        share = np.exp(loss.min(1, keepdims=True) - loss)
        score = float((share[:, best] / share.sum(1)).mean())
        return self.languages[best], score, score < ambiguous_below


def train(df: DataFrame, text_col: str = "text", lang_col: str = "lang", alpha: float = 0.5) -> Model:
    """Counts every row of df with a language and text; other columns are ignored. No such rows: a model that knows no language.

    Any number of languages: counts stay a table, of which each task takes some features, then some languages. What comes to the driver is a weight for each
    feature and bit, and a few numbers for each language.
    """

    def run(batches):
        found: dict[str, np.ndarray] = {}

        def rows():
            for lang, counts in found.items():
                at = counts.nonzero()[0]
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at)), pa.array(at), pa.array(counts[at])], names=["lang", "feature", "n"])
            found.clear()

        for batch in text_slices(batches):
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if own := letters_of(text):
                    if lang not in found:
                        found[lang] = np.zeros(1 << FEATURE_BITS, np.int64)
                    found[lang] += np.bincount(features(own), minlength=1 << FEATURE_BITS)
            if len(found) > LANGUAGES_AT_ONCE:
                yield from rows()
        yield from rows()

    given = df.select(F.col(f"`{lang_col}`").cast("string").alias("lang"), F.col(f"`{text_col}`").alias("text")).filter("lang IS NOT NULL AND text IS NOT NULL")
    counts = written(given.mapInArrow(run, "lang string, feature bigint, n bigint").groupBy("lang", "feature").agg(F.sum("n").alias("n")), "features")
    sums = counts.groupBy("lang").agg(F.sum("n").alias("n")).toPandas().sort_values("lang")
    languages, totals = sums["lang"].tolist(), sums["n"].to_numpy(float) + alpha * (1 << FEATURE_BITS)
    code, spark = codewords(len(languages)), df.sparkSession
    if code.shape[1] == 0:
        return Model(languages, np.zeros((1 << FEATURE_BITS, 0)), np.zeros((len(languages), 0)))
    shared = spark.sparkContext.broadcast((languages, totals, code))

    sides = [(alpha / totals) @ (code == s) for s in (1, -1)]  # of a feature that no text has
    size = [(code == s).sum(0) for s in (1, -1)]

    def weigh(batches):
        """Of each feature the log ratio of its mean probability on the two sides of each bit; languages count alike, however much text each has."""
        languages, totals, code = shared.value
        table = pa.Table.from_batches(list(batches), COUNTS)  # a task's features; at most languages x features in all
        feature = table.column("feature").to_numpy()
        order = np.argsort(feature, kind="stable")
        at = np.searchsorted(languages, table.column("lang").to_numpy()[order])
        share, feature = table.column("n").to_numpy()[order] / totals[at], feature[order]
        start = np.append(np.append(True, feature[1:] != feature[:-1]).nonzero()[0], len(feature)) if len(feature) else np.zeros(1, int)
        for k in range(0, len(start) - 1, 1_000):
            a, b = start[k], start[min(k + 1_000, len(start) - 1)]
            ones = [np.add.reduceat(share[a:b, None] * (code[at[a:b]] == s), start[k : k + 1_000][: len(start) - 1 - k] - a, 0) for s in (1, -1)]
            w = np.log((sides[0] + ones[0]) / size[0]) - np.log((sides[1] + ones[1]) / size[1])
            yield pa.RecordBatch.from_arrays([pa.array(feature[start[k : k + len(w)]]), pa.array([x.tobytes() for x in w], pa.binary())], names=["feature", "w"])

    weights = np.tile(np.log(sides[0] / size[0]) - np.log(sides[1] / size[1]), (1 << FEATURE_BITS, 1))
    for r in counts.repartition("feature").mapInArrow(weigh, "feature bigint, w binary").collect():
        weights[r["feature"]] = np.frombuffer(r["w"])
    known = spark.sparkContext.broadcast(weights)

    def tell(table: pa.Table) -> pa.Table:
        """The mean margin of each bit on one language's own text."""
        w, n = known.value, table.column("n").to_numpy() + alpha
        own = w[table.column("feature").to_numpy()]
        mean = (n @ own + alpha * (w.sum(0) - own.sum(0))) / (n.sum() + alpha * (len(w) - len(n)))
        return pa.table({"lang": table.column("lang")[:1], "m": pa.array([mean.tobytes()], pa.binary())})

    sure = {r["lang"]: np.frombuffer(r["m"]) for r in counts.groupBy("lang").applyInArrow(tell, "lang string, m binary").collect()}
    return Model(languages, weights, np.array([sure[x] for x in languages]))


def predict(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of df: id_col, lang_pred, score (0 to 1), ambiguous. Null text or no letter: und, 0.0, ambiguous.

    Of languages with equal loss the first in order is predicted. Repeated rows are predicted alike; the score of a text in two languages is near the larger
    part's share of it. Other columns are ignored; an empty df gives no rows.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in text_slices(batches):
            got = [shared.value.predict(t) for t in batch.column(1).to_pylist()]
            lang, score, doubt = zip(*got, strict=True) if got else ((), (), ())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(doubt, pa.bool_())], names=["id", "lang_pred", "score", "ambiguous"])

    out = df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text")).mapInArrow(run, f"id {dict(df.dtypes)[id_col]}, lang_pred string, score double, ambiguous boolean")
    return out.withColumnRenamed("id", id_col)
