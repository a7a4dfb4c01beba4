r"""Alignment of two tokenizers over the same bytes: groups of tokens between common ends, and which tokens go together corpus-wide.

A slice of an Arrow batch is laid out as one line of bytes, a document after the other. The ends of A tokens and of B
tokens on that line are counted by one bincount each; where both occur the line is cut. Every document's end is such a
cut, so groups stay within documents, and prefix sums over the line, taken at the documents' ends, give each document's
tokens, groups and links. A group links each of its A tokens with each of its B tokens.

How many documents hold a pair of ids linked is counted in two steps: each slice counts its own documents, Spark adds
the slices up. The slices, with their documents' pairs as places in the slice's own list of pairs, are a table below the
shared folder; the counts are joined to each slice's list, and a second pass over the slices sums them by document.
So what is shuffled is a row for each slice and distinct pair, not for each document and pair. A frequent pair has one row a
slice at most, and the slices are bounded by bytes, so no pair outweighs the rest.

Words between single spaces are encoded once in a worker (a bounded cache): the byte-level pattern always cuts before a
single space between visible characters, and no piece goes on over one. Both are tested when the files are loaded; without that property texts are encoded whole.

Null and empty texts, and texts whose joined A or B bytes aren't a space and the text, have no tokens: zeros, and ''.
Repeated rows give repeated results, and each counts as a document. Very long texts are a slice of their own.
"""

from __future__ import annotations

import hashlib
import json
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.bpe import byte_symbols, read_spec
from ledgerloom.llm.common import text_slices, written

#: Bytes of text in a slice, links that are listed at once, and words that a worker keeps.
SLICE, AT_ONCE, WORDS = 4_000_000, 4_000_000, 400_000
#: Words that a library gets as one text.
LOT = 100
_SINGLE = re.compile(r"(?<=\S) (?=\S)")
#: Where a text has it, not every space is a single one.
_RUN = re.compile(r"\s | \s|^\s| $")
_SPACE_MARK = "▁"


@dataclass(frozen=True)
class Side:
    """One tokenizer: encode gives lists of ids for texts that get a space before them; blob and starts hold the tokens' bytes."""

    encode: object
    blob: np.ndarray
    starts: np.ndarray
    length: np.ndarray
    joins_words: bool

    @property
    def size(self) -> int:
        return len(self.length)

    def bytes_of(self, ids: np.ndarray) -> np.ndarray:
        """The tokens' bytes, one after another."""
        length = self.length[ids]
        ends = np.cumsum(length)
        return self.blob[np.repeat(self.starts[ids] - (ends - length), length) + np.arange(ends[-1] if len(ends) else 0)]


def _side(encode, tokens: list[bytes], joins_words: bool) -> Side:
    starts = np.zeros(len(tokens) + 1, np.int64)
    np.cumsum([len(t) for t in tokens], out=starts[1:])
    return Side(encode, np.frombuffer(b"".join(tokens), np.uint8), starts, np.diff(starts), joins_words)


def byte_level_side(spec: str) -> Side:
    """A byte-level BPE file of the tokenizers library; special tokens' strings are plain text."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    from tokenizers import Tokenizer

    own = Tokenizer.from_str(spec)
    own.no_truncation(), own.no_padding()
    own.encode_special_tokens = True
    byte = {c: b for b, c in enumerate(byte_symbols())}
    names = {i: t for t, i in own.get_vocab(with_added_tokens=True).items()}
    decoded = lambda t: bytes(map(byte.__getitem__, t)) if all(c in byte for c in t) else t.encode()
    encode = lambda texts: [e.ids for e in own.encode_batch_fast([f" {t}" for t in texts], add_special_tokens=False)]
    before = json.loads(spec)["pre_tokenizer"] or {}
    return _side(encode, [decoded(names.get(i, "")) for i in range(max(names, default=-1) + 1)], (before.get("type"), before.get("use_regex", True), before.get("add_prefix_space")) != ("ByteLevel", True, False))


def piece_side(model: bytes) -> Side:
    """A sentencepiece model with byte fallback that adds a space before a text itself."""
    from sentencepiece import SentencePieceProcessor

    own = SentencePieceProcessor(model_proto=model)
    shown = lambda i: bytes([int(own.id_to_piece(i)[3:5], 16)]) if own.is_byte(i) else own.id_to_piece(i).replace(_SPACE_MARK, " ").encode()
    tokens = [shown(i) for i in range(own.get_piece_size())]
    return _side(lambda texts: own.encode(texts, num_threads=1), tokens, any(b" " in t.lstrip(b" ") for t in tokens))


def _flat(lists, dtype=np.int64) -> tuple[np.ndarray, np.ndarray]:
    from itertools import chain

    lists = list(lists)
    return np.fromiter(chain.from_iterable(lists), dtype), np.fromiter(map(len, lists), np.int64, len(lists))


class _Grown:
    """Lists of ids, one after another, in an array that grows."""

    def __init__(self):
        self.flat, self.ends = np.zeros(4096, np.int32), np.zeros(1024, np.int64)
        self.n = 0

    def add(self, ids: np.ndarray, lengths: np.ndarray) -> None:
        used, n = int(self.ends[self.n]), self.n
        while used + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        while n + len(lengths) >= len(self.ends):
            self.ends = np.concatenate([self.ends, np.zeros_like(self.ends)])
        self.flat[used : used + len(ids)] = ids
        self.ends[n + 1 : n + 1 + len(lengths)] = used + np.cumsum(lengths)
        self.n += len(lengths)

    def take(self, slots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the slots one after another, and each slot's number of ids."""
        start = self.ends[slots]
        length = self.ends[slots + 1] - start
        ends = np.cumsum(length)
        return self.flat[np.repeat(start - (ends - length), length) + np.arange(ends[-1] if len(ends) else 0)], length


class _Slots(dict):
    """word -> number; an unknown word gets the next one, and is noted in `new`."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        self.new.append(word)
        self[word] = n = len(self)
        return n


class Encoder:
    """Both tokenizers over texts. The first WORDS words between single spaces are kept; later ones are encoded anew in each slice."""

    def __init__(self, sides: tuple[Side, Side]):
        self.sides = sides
        self.whole = any(s.joins_words for s in sides)
        self.slot = _Slots()
        self.kept = [_Grown() for _ in self.sides]

    def _learn(self, words: list[str]) -> None:
        """Encodes new words: many as one text, cut apart by their bytes; a lot whose bytes don't fit goes word by word."""
        for at in range(0, len(words), LOT * 20):
            some = words[at : at + LOT * 20]
            lots = [some[i : i + LOT] for i in range(0, len(some), LOT)]
            texts = [" ".join(lot) for lot in lots]
            for side, kept in zip(self.sides, self.kept, strict=True):
                for lot, ids in zip(lots, side.encode(texts), strict=True):
                    ids = np.array(ids, np.int32)
                    ends = np.cumsum([len(w) if w.isascii() else len(w.encode()) for w in lot]) + np.arange(1, len(lot) + 1)
                    reached = np.cumsum(side.length[ids])
                    cut = np.searchsorted(reached, ends)
                    if len(reached) and reached[-1] == ends[-1] and (reached[cut] == ends).all():
                        kept.add(ids, np.diff(cut + 1, prepend=0))
                    else:
                        kept.add(*_flat(side.encode(lot)))

    def __call__(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each tokenizer the ids of all texts in a row, and each text's number of ids."""
        if self.whole:
            return [(ids.astype(np.int32), n) for ids, n in (_flat(s.encode(texts)) for s in self.sides)]
        words, sizes = [], []
        for t in texts:
            own = _SINGLE.split(t) if _RUN.search(t) else t.split(" ")
            words += own
            sizes.append(len(own))
        slots = np.fromiter(map(self.slot.__getitem__, words), np.int64, len(words))
        new, self.slot.new = self.slot.new, []
        self._learn(new)
        ends = np.cumsum(sizes)
        found = []
        for kept in self.kept:
            ids, length = kept.take(slots)
            found.append((ids, np.diff(np.append(0, np.cumsum(length))[ends], prepend=0)))
        if len(self.slot) > WORDS:
            for word in new[len(new) - (len(self.slot) - WORDS) :]:
                del self.slot[word]
            for kept in self.kept:
                kept.n = WORDS
        return found


def _runs(values: np.ndarray, most: int):
    """Neighbours whose values sum up to `most`, as (start, end); a larger value stands alone."""
    total, at = np.cumsum(values), 0
    while at < len(values):
        end = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + most, "right")))
        yield at, end
        at = end


class Aligner:
    def __init__(self, a: Side, b: Side):
        self.a, self.b = a, b
        self.encoder = Encoder((a, b))
        self.shown = [[np.array([f"{i}{end}" for i in range(s.size)], object) for end in ends] for s, ends in ((a, ",|"), (b, ",;"))]

    def slice(self, texts: list[str | None]) -> dict:
        """Results for each text, and the pairs of the slice.

        n_a, n_b, n_groups, n_links (arrays), groups_sha256 (list); codes: the slice's distinct pairs, a * size of B + b, in order;
        docs: how many of its texts hold each; at: for each text in turn its pairs, as places in codes; times: how often; held: pairs a text.
        """
        known = [t or "" for t in texts]
        (a, n_a), (b, n_b) = self.encoder(known)
        raw = [t.encode() for t in known]
        size = np.array([len(r) + 1 for r in raw], np.int64)
        right = np.array([bool(t) for t in known], bool) & (self._bytes(self.a, a, n_a) == size) & (self._bytes(self.b, b, n_b) == size)
        a, n_a = a[np.repeat(right, n_a)], np.where(right, n_a, 0)
        b, n_b = b[np.repeat(right, n_b)], np.where(right, n_b, 0)
        size = np.where(right, size, 0)
        line = np.frombuffer(b"".join(b" " + r for r, fits in zip(raw, right, strict=True) if fits), np.uint8)
        wrong = (self.a.bytes_of(a) != line) | (self.b.bytes_of(b) != line)
        if wrong.any():
            doc = np.repeat(np.arange(len(size)), size)
            right = right & ~(np.bincount(doc[wrong], minlength=len(size)) > 0)
            a, n_a = a[np.repeat(right, n_a)], np.where(right, n_a, 0)
            b, n_b = b[np.repeat(right, n_b)], np.where(right, n_b, 0)
            size = np.where(right, size, 0)
        return self._aligned(a, n_a, b, n_b, size)

    @staticmethod
    def _bytes(side: Side, ids: np.ndarray, n: np.ndarray) -> np.ndarray:
        total = np.append(0, np.cumsum(side.length[ids]))
        ends = np.cumsum(n)
        return total[ends] - total[ends - n]

    def _aligned(self, a, n_a, b, n_b, size) -> dict:
        width = int(size.sum())
        doc_end = np.cumsum(size)
        ends_a, ends_b = np.cumsum(self.a.length[a]), np.cumsum(self.b.length[b])
        cuts = (np.bincount(ends_a, minlength=width + 1) > 0) & (np.bincount(ends_b, minlength=width + 1) > 0)
        before = np.cumsum(cuts)  # cuts at or before a place
        group_a, group_b = before[ends_a - 1], before[ends_b - 1]
        n = int(before[-1])
        in_a, in_b = np.bincount(group_a, minlength=n), np.bincount(group_b, minlength=n)
        # prefix sums along the line, at the documents' ends
        groups_to = np.append(0, before[doc_end])
        links_to = np.append(0, np.cumsum(in_a * in_b))[groups_to]
        n_links = np.diff(links_to)
        out = {"n_a": n_a, "n_b": n_b, "n_groups": np.diff(groups_to), "n_links": n_links}
        out["groups_sha256"] = self._digests(a, n_a, b, n_b, group_a, group_b, in_a, in_b)
        doc_a = np.repeat(np.arange(len(size)), n_a)
        first_b = np.cumsum(in_b) - in_b
        a_to = np.append(0, np.cumsum(n_a))
        docs, codes, times = [], [], []
        for x, y in _runs(n_links, AT_ONCE):
            if n_links[x:y].sum() > 2 * AT_ONCE:
                got = [(np.full(len(c), x), c, t) for c, t in [self._large(a, b, groups_to[x], groups_to[x + 1], in_a, in_b)]]
            else:
                some = slice(a_to[x], a_to[y])
                each = in_b[group_a[some]]
                ends = np.cumsum(each)
                place = np.repeat(first_b[group_a[some]] - (ends - each), each) + np.arange(ends[-1] if len(ends) else 0)
                code = np.repeat(a[some].astype(np.int64), each) * self.b.size + b[place]
                key, t = np.unique(np.repeat(doc_a[some], each) * (self.a.size * self.b.size) + code, return_counts=True)
                got = [(*np.divmod(key, self.a.size * self.b.size), t)]
            for d, c, t in got:
                docs.append(d), codes.append(c), times.append(t)
        doc, code, times = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (docs, codes, times))
        distinct, at, held = np.unique(code, return_inverse=True, return_counts=True)
        return out | {"codes": distinct, "docs": held, "at": at.ravel(), "times": times, "held": np.bincount(doc.astype(np.int64), minlength=len(size))}

    def _large(self, a, b, g, h, in_a, in_b) -> tuple[np.ndarray, np.ndarray]:
        """Distinct pairs and how often, of a document with very many links: each group's distinct ids first, and groups in lots."""
        to_a, to_b = np.append(0, np.cumsum(in_a)), np.append(0, np.cumsum(in_b))
        codes, times, held = np.zeros(0, np.int64), np.zeros(0, np.int64), ([], [], 0)

        def merged():
            every, at = np.unique(np.concatenate([codes, *held[0]]), return_inverse=True)
            total = np.zeros(len(every), np.int64)
            np.add.at(total, at.ravel(), np.concatenate([times, *held[1]]))
            return every, total

        for k in range(g, h):
            x, n_x = np.unique(a[to_a[k] : to_a[k + 1]], return_counts=True)
            y, n_y = np.unique(b[to_b[k] : to_b[k + 1]], return_counts=True)
            held[0].append((x.astype(np.int64)[:, None] * self.b.size + y).ravel())
            held[1].append((n_x[:, None] * n_y).ravel())
            held = (held[0], held[1], held[2] + len(x) * len(y))
            if held[2] > AT_ONCE:
                codes, times = merged()
                held = ([], [], 0)
        return merged()

    def _digests(self, a, n_a, b, n_b, group_a, group_b, in_a, in_b) -> list[str]:
        """The digest of each document's groups, written as ids."""
        (a_on, a_last), (b_on, b_last) = self.shown
        parts = np.empty(len(a) + len(b), object)
        all_a, all_b = np.cumsum(in_a), np.cumsum(in_b)
        last_a, last_b = np.zeros(len(a), bool), np.zeros(len(b), bool)
        last_a[all_a - 1], last_b[all_b - 1] = True, True
        parts[np.arange(len(a)) + (all_b - in_b)[group_a]] = np.where(last_a, a_last[a], a_on[a])
        parts[np.arange(len(b)) + all_a[group_b]] = np.where(last_b, b_last[b], b_on[b])
        ends, out, at = np.cumsum(n_a + n_b).tolist(), [], 0
        parts = parts.tolist()
        for end in ends:
            out.append(hashlib.sha256("".join(parts[at:end])[:-1].encode()).hexdigest() if end > at else "")
            at = end
        return out


_LOADED: dict = {}


def _aligner(spec: str, model: bytes) -> Aligner:
    key = (hash(spec), hash(model))
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = Aligner(byte_level_side(spec), piece_side(model))
    return _LOADED[key]


def _packed(values: np.ndarray) -> bytes:
    return pa.compress(values.astype("<u4").tobytes(), codec="zstd", asbytes=True)


def _unpacked(data: bytes, n: int) -> np.ndarray:
    return np.frombuffer(pa.decompress(data, 4 * n, codec="zstd", asbytes=True), "<u4") if n else np.zeros(0, np.uint32)


_FIELDS = ("n_a", "n_b", "n_groups", "n_links")


def slices(df: DataFrame, byte_vocab: str, piece_model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a slice of documents, as a written table: `slice`, its documents' results as arrays, its pairs, and its documents' pairs packed."""
    spark = df.sparkSession
    with open(piece_model, "rb") as f:
        model = f.read(64 << 20)
    spec, model = spark.sparkContext.broadcast(read_spec(byte_vocab)), spark.sparkContext.broadcast(model)  # 64 MB each at most, whatever the corpus
    id_type = dict(df.dtypes)[id_col]
    lists = [*_FIELDS, "held", "codes", "docs"]

    def run(batches):
        aligner = _aligner(spec.value, model.value)
        number = TaskContext.get().partitionId() << 32
        for batch in text_slices(batches, limit=SLICE):
            got = aligner.slice(batch.column(1).to_pylist())
            arrays = [pa.array([number], pa.int64()), pa.ListArray.from_arrays([0, batch.num_rows], batch.column(0)), pa.array([got["groups_sha256"]], pa.list_(pa.string()))]
            arrays += [pa.ListArray.from_arrays([0, len(got[k])], pa.array(got[k].astype(np.int64))) for k in lists]
            arrays += [pa.array([_packed(got[k])], pa.binary()) for k in ("at", "times")]
            yield pa.RecordBatch.from_arrays(arrays, names=["slice", "ids", "groups_sha256", *lists, "at", "times"])
            number += 1

    schema = f"slice bigint, ids array<{id_type}>, groups_sha256 array<string>, " + ", ".join(f"{k} array<bigint>" for k in lists) + ", at binary, times binary"
    return written(df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text")).mapInArrow(run, schema), "aligned")


def align(df: DataFrame, byte_vocab: str, piece_model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of df: id_col, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256. Other columns are ignored; an empty df gives no rows."""
    with open(piece_model, "rb") as f:
        width = piece_side(f.read(64 << 20)).size
    id_type = dict(df.dtypes)[id_col]
    parts = slices(df, byte_vocab, piece_model, id_col, text_col)
    listed = parts.select("slice", F.posexplode(F.arrays_zip("codes", "docs")).alias("place", "p")).select("slice", "place", F.col("p.codes").alias("code"), F.col("p.docs").alias("docs"))
    counts = listed.groupBy("code").agg(F.sum("docs").alias("n"))
    of_a = Window.partitionBy(F.floor(F.col("code") / width))  # as many rows as B has ids at most
    counts = counts.select("code", (2 * F.col("n") + (F.col("n") == F.max("n").over(of_a)).cast("long")).alias("value"))
    values = listed.select("slice", "place", "code").join(counts, "code").groupBy("slice").agg(F.sort_array(F.collect_list(F.struct("place", "value"))).alias("found"))
    values = values.select("slice", F.col("found.value").alias("value"))

    def run(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                get = lambda k, r=row, x=batch: x.column(x.schema.get_field_index(k))[r].values
                held = get("held").to_numpy(zero_copy_only=False)
                n = int(held.sum())
                value = np.zeros(0, np.int64)
                if n:
                    value = get("value").to_numpy(zero_copy_only=False)[_unpacked(batch.column(batch.schema.get_field_index("at"))[row].as_py(), n)]
                times = _unpacked(batch.column(batch.schema.get_field_index("times"))[row].as_py(), n).astype(np.int64)
                ends = np.cumsum(held)
                upto = lambda x, e=ends, h=held: (c := np.append(0, np.cumsum(x)))[e] - c[e - h]
                yield pa.RecordBatch.from_arrays(
                    [get("ids"), *map(get, _FIELDS), pa.array(upto(times * (value & 1))), pa.array(upto(times * (value >> 1))), get("groups_sha256")],
                    names=["id", *_FIELDS, "n_best", "count_sum", "groups_sha256"],
                )

    ready = parts.select("slice", "ids", *_FIELDS, "groups_sha256", "held", "at", "times").join(values, "slice", "left").drop("slice")
    out = ready.mapInArrow(run, f"id {id_type}, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string")
    return out.withColumnRenamed("id", id_col)
