r"""Byte-level BPE with word ends: exact encoding by backtracking, decoding by an offset table.

A vocabulary file of the `tokenizers` JSON format is the parameter; nothing is trained. Encoding a word takes the
longest token that matches at each position (found by one Aho-Corasick pass), and accepts it if the pair it makes
with the token before is compatible, that is, if no merge
across their border comes while the symbols on both sides of it are still there. If not, the next shorter token is tried, and if none is left the token before is taken back; positions from
which no way leads on are marked, so that each is tried once. A sequence whose neighbours are all compatible is
the one that the merge rules give. Decoding looks tokens up in one string by offsets.

A text is cut at Unicode white space; a bounded cache maps each piece to its ids, so that frequent words are encoded once
in a worker. Null text is empty text and has no ids.
"""

from __future__ import annotations

import json
import re
import unicodedata
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import text_slices

#: Unicode White_Space; str.split() would also cut at four control characters that are not part of it.
_SPACE = re.compile("[\t-\r \x85\xa0  -     　]+")
_EXTRA_SPACE = re.compile("[\x1c-\x1f]")
#: Stands for the end-of-word mark in matching; no byte-level symbol is this character.
_LAST = "\0"
#: Entries of the caches of a worker; beyond them the first is thinned out, and the others start anew.
CACHE, WORDS, PAIRS = 600_000, 200_000, 500_000
#: New pieces that the encoder gets in one call.
AT_ONCE = 4_000
_NEVER = 1 << 60


def byte_symbols() -> list[str]:
    """The printable stand-in of each byte: itself where Latin-1 has a visible character, else the next from U+0100 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return [chr(b if b in shown else next(rest)) for b in range(256)]


class Bpe:
    def __init__(self, spec: str):
        import ahocorasick
        import regex

        spec_json = json.loads(spec)
        model, before = spec_json["model"], spec_json["pre_tokenizer"]["pretokenizers"]
        steps = [n["type"] for n in spec_json["normalizer"]["normalizers"]]
        if model["type"] != "BPE" or steps != ["NFC", "Replace", "Lowercase"] or [p["type"] for p in before] != ["Split", "ByteLevel"] or spec_json["decoder"]:
            raise ValueError("this kind of vocabulary file is not supported")
        end = model["end_of_word_suffix"]
        self.pattern = regex.compile(before[0]["pattern"]["Regex"])
        self.added = {t["content"]: t["id"] for t in spec_json["added_tokens"]}
        self.added_at = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")") if self.added else None
        self.symbols = byte_symbols()
        key = lambda t: t[: -len(end)] + _LAST if t.endswith(end) else t
        self.ids = {key(t): i for t, i in model["vocab"].items()}
        pairs = [tuple(map(key, m.split(" ") if isinstance(m, str) else m)) for m in model["merges"]]
        names = sorted(((i, t) for t, i in [*model["vocab"].items(), *self.added.items()]), reverse=True)
        self.offsets = np.zeros(names[0][0] + 2, np.int64)  # decoding: token i is blob[offsets[i]:offsets[i + 1]]
        by_id = {i: t for i, t in names}
        self.blob = "".join(by_id.get(i, "") for i in range(names[0][0] + 1))
        np.cumsum([len(by_id.get(i, "")) for i in range(names[0][0] + 1)], out=self.offsets[1:])
        self.pieces = [self.blob[a:b] for a, b in zip(self.offsets[:-1].tolist(), self.offsets[1:].tolist(), strict=True)]
        text_of = {i: t for t, i in self.ids.items()}
        self.length = {i: len(t) for i, t in text_of.items()}
        # What a token is merged from, and when. A merge comes after the merges that made its parts, so ranks are times.
        self.made: dict[int, int] = {}
        right: dict[int, list] = {i: [(i, _NEVER)] for i in text_of}
        left: dict[int, list] = {i: [(i, _NEVER)] for i in text_of}
        self.rank: dict[int, int] = {}
        self.right, self.left, self.pairs, self.words = right, left, {}, {}
        parts = {t for t in text_of.values() if len(t) == 1 or len(t) == 2 and t[1] == _LAST}
        own = {self.ids[t] for t in parts}
        for n, (x, y) in enumerate(pairs):
            a, b, c = self.ids[x], self.ids[y], self.ids[x + y]
            if max(self.made.get(a, -1), self.made.get(b, -1)) >= n:
                raise ValueError("a merge stands before those of its parts")
            if c not in own and a in own and b in own and self._undisturbed(a, b):  # else c can never come out
                own.add(c)
                self.made[c] = n
                right[c] = [(c, _NEVER), (b, n), *right[b][1:]]
                left[c] = [(c, _NEVER), (a, n), *left[a][1:]]
            self.rank[a << 20 | b] = n
        known = {text_of[i] for i in own}
        self.shorter = {i: next((self.ids[t[:n]] for n in range(len(t) - 1, 0, -1) if t[:n] in known), -1) for t, i in ((text_of[i], i) for i in own)}
        self.automaton = ahocorasick.Automaton()
        for i in own:
            self.automaton.add_word(text_of[i], i)
        self.automaton.make_automaton()

    def _undisturbed(self, a: int, b: int) -> bool:
        """No symbol at the end of a and symbol at the start of b merge while both are there; of equal ranks the left one is first."""
        rank = self.rank
        for x, x_until in self.right[a]:
            for y, y_until in self.left[b]:
                n = rank.get(x << 20 | y)
                if n is not None and n < x_until and n <= y_until:
                    return False
        return True

    def word(self, text: str) -> list[int]:
        """Ids of one word of byte symbols that ends with _LAST."""
        size, shorter, pairs = len(text), self.shorter, self.pairs
        longest = [-1] * size
        length = self.length
        for end, token in self.automaton.iter(text):
            longest[end - length[token] + 1] = token  # ends ascend, so the longest is the last
        out: list[int] = []
        dead = bytearray(size + 1)
        at, token, before = 0, longest[0], -1
        while at < size:
            while token >= 0:
                end = at + length[token]
                if not dead[end]:
                    if before < 0:
                        break
                    fine = pairs.get(before << 20 | token)
                    if fine is None:
                        if len(pairs) >= PAIRS:
                            pairs.clear()
                        fine = pairs[before << 20 | token] = self._undisturbed(before, token)
                    if fine:
                        break
                token = shorter[token]
            if token >= 0:
                out.append(token)
                before, at = token, end
                token = longest[at] if at < size else -1
            else:
                dead[at] = 1
                token = out.pop()
                before = out[-1] if out else -1
                at -= length[token]
                token = shorter[token]
        return out

    def piece(self, text: str) -> list[int]:
        """Ids of a piece of text without white space."""
        out: list[int] = []
        for part in self.added_at.split(text) if self.added_at else [text]:
            if part in self.added:
                out.append(self.added[part])
                continue
            part = part if part.isascii() else unicodedata.normalize("NFC", part).replace("Σ", "σ")  # capital sigma: lower-cased one by one
            for w in self.pattern.findall(part.lower()):
                ids = self.words.get(w)
                if ids is None:
                    if len(self.words) >= WORDS:
                        self.words.clear()
                    shown = w if w.isascii() and w.isalnum() else "".join([self.symbols[b] for b in w.encode()])
                    ids = self.words[w] = self.word(shown + _LAST)
                out += ids
        return out

    def decode(self, ids: np.ndarray) -> str:
        return " ".join(map(self.pieces.__getitem__, ids.tolist()))


class _Slots(dict):
    """piece -> number; an unknown piece gets the next one, and is noted in `new`."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, piece: str) -> int:
        self.new.append(piece)
        self[piece] = n = len(self)
        return n


class PieceCache:
    """Encodes texts through a bounded cache of pieces; encode_pieces gives the ids of new pieces, one after another, and how many each has."""

    def __init__(self, encode_pieces):
        self.encode_pieces = encode_pieces
        self.clear()

    def clear(self) -> None:
        self.slot = _Slots()
        self.starts, self.flat, self.used = np.zeros(1024, np.int64), np.zeros(4096, np.uint32), 0
        self.seen = np.zeros(1024, np.int64)

    def thin_out(self) -> None:
        """Keeps the pieces seen most often, half of CACHE at most, and halves their counts."""
        kept = np.argsort(-self.seen[: len(self.slot)], kind="stable")[: CACHE // 2]
        kept = np.sort(kept[self.seen[kept] > 1])
        pieces, length = list(self.slot), np.diff(self.starts[: len(self.slot) + 1])
        at = np.repeat(self.starts[kept] - np.append(0, np.cumsum(length[kept])[:-1]), length[kept]) + np.arange(int(length[kept].sum()))
        flat, seen = self.flat[at], self.seen[kept] // 2
        self.clear()
        self.slot.update((pieces[k], n) for n, k in enumerate(kept.tolist()))
        self.starts, self.flat, self.used = np.append(0, np.append(np.cumsum(length[kept]), 0)), np.append(flat, np.zeros(4096, np.uint32)), len(flat)
        self.seen = np.append(seen, 0)

    def _learn(self, pieces: list[str], n: int) -> None:
        """Adds the ids of new pieces, numbered from n on."""
        for at in range(0, len(pieces), AT_ONCE):
            ids, lengths = self.encode_pieces(pieces[at : at + AT_ONCE])
            while n + len(lengths) + 1 > len(self.starts):
                self.starts = np.concatenate([self.starts, np.zeros_like(self.starts)])
            while self.used + len(ids) > len(self.flat):
                self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
            self.flat[self.used : self.used + len(ids)] = ids
            self.starts[n + 1 : n + 1 + len(lengths)] = self.used + np.cumsum(lengths)
            self.used, n = self.used + len(ids), n + len(lengths)

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """The ids of each text; null has none."""
        if len(self.slot) > CACHE:
            self.thin_out()
        pieces, ends, known = [], [], len(self.slot)
        for t in texts:
            if t:
                pieces += [p for p in _SPACE.split(t) if p] if _EXTRA_SPACE.search(t) else t.split()
            ends.append(len(pieces))
        slots = np.fromiter(map(self.slot.__getitem__, pieces), np.int64, len(pieces))
        if self.slot.new:
            self._learn(self.slot.new, known)
            self.slot.new = []
        if len(self.slot) > len(self.seen):
            self.seen = np.append(self.seen, np.zeros(len(self.slot), np.int64))
        self.seen += np.bincount(slots, minlength=len(self.seen))
        start = self.starts[slots]
        length = self.starts[slots + 1] - start
        total = np.concatenate([np.zeros(1, np.int64), np.cumsum(length)])
        flat = self.flat[np.repeat(start - total[:-1], length) + np.arange(total[-1])]
        return np.split(flat, total[ends[:-1]]) if texts else []


def _side_by_side(ids) -> tuple[np.ndarray, np.ndarray]:
    """Lists of ids as one array, and their lengths."""
    ids = list(ids)
    return np.fromiter(chain.from_iterable(ids), np.uint32), np.fromiter(map(len, ids), np.int64, len(ids))


def in_lots(library, pieces: list[str], lot: int = 100) -> tuple[np.ndarray, np.ndarray]:
    """The library's ids of each piece, where it gets many as one text: a bar between white space stands between two pieces.

    White space ends words, so a piece has the ids there that it has alone. A piece with a bar in it goes alone.
    """
    encode = lambda texts: [e.ids for e in library.encode_batch_fast(texts, add_special_tokens=False)]
    (bar,) = encode(["|"])[0]
    barred = [k for k, p in enumerate(pieces) if "|" in p]
    plain = [p for p in pieces if "|" not in p] if barred else pieces
    lots = encode([" | ".join([*plain[k : k + lot], ""]) for k in range(0, len(plain), lot)])
    every = np.fromiter(chain.from_iterable(lots), np.uint32)
    ends = (every == bar).nonzero()[0]
    lengths = np.diff(ends, prepend=-1) - 1
    assert len(lengths) == len(plain)
    ids = every[every != bar]
    if not barred:
        return ids, lengths
    own = encode([pieces[k] for k in barred])
    parts, rest = np.split(ids, np.cumsum(lengths)[:-1]) if len(lengths) else [], iter(own)
    found, known = iter(parts), set(barred)
    return _side_by_side((next(rest) if k in known else next(found).tolist()) for k in range(len(pieces)))


_LOADED: dict = {}


def loaded(name: str, spec: str) -> tuple:
    """The encoder of a worker, made once: name "backtracking" for Bpe, "library" for the tokenizers library itself."""
    key = (name, hash(spec))
    if key not in _LOADED:
        _LOADED.clear()
        if name == "library":
            import os

            os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core; idle threads of a pool would only spin
            from tokenizers import Tokenizer

            own = Tokenizer.from_str(spec)
            own.no_truncation(), own.no_padding()
            _LOADED[key] = (own, PieceCache(lambda pieces: in_lots(own, pieces)))
        else:
            own = Bpe(spec)
            _LOADED[key] = (own, PieceCache(lambda pieces: _side_by_side(map(own.piece, pieces))))
    return _LOADED[key]


def read_spec(path: str, most: int = 64 << 20) -> str:
    """The vocabulary file's content, which is sent to the workers: at most `most` bytes, whatever the corpus."""
    with open(path, encoding="utf-8") as f:
        spec = f.read(most + 1)
    if len(spec) > most:
        raise ValueError(f"{path} has over {most} characters")
    return spec


def encode(df: DataFrame, vocab_path: str, id_col: str = "doc_id", text_col: str = "text", decoded: bool = False) -> DataFrame:
    """One row for each row of df: id_col, n_tokens, ids (binary: little-endian unsigned 32-bit) and, if asked for, `decoded`.

    Null text: no ids, empty binary. Repeated rows are encoded alike. Other columns are ignored; an empty df gives no rows. id_col is not
    named as an output.
    """
    shared = df.sparkSession.sparkContext.broadcast(read_spec(vocab_path))
    id_type = dict(df.dtypes)[id_col]

    def run(batches):
        bpe, cache = loaded("backtracking", shared.value)
        for batch in text_slices(batches, limit=1_000_000):
            ids = cache.encode(batch.column(1).to_pylist())
            columns = [batch.column(0), pa.array(map(len, ids), pa.int64()), pa.array((x.astype("<u4").tobytes() for x in ids), pa.binary())]
            if decoded:
                columns.append(pa.array(map(bpe.decode, ids), pa.string()))
            yield pa.RecordBatch.from_arrays(columns, names=["id", "n_tokens", "ids", "decoded"][: len(columns)])

    out = df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text")).mapInArrow(run, f"id {id_type}, n_tokens bigint, ids binary" + ", decoded string" * decoded)
    return out.withColumnRenamed("id", id_col)


def decode(df: DataFrame, vocab_path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """The texts of packed ids, as `decoded`: tokens with one space between; null ids give null. Repeated rows are decoded alike; other columns are ignored."""
    shared = df.sparkSession.sparkContext.broadcast(read_spec(vocab_path))

    def run(batches):
        bpe, _ = loaded("backtracking", shared.value)
        for batch in batches:
            texts = (None if x is None else bpe.decode(np.frombuffer(x, "<u4")) for x in batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["id", "decoded"])

    out = df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{ids_col}`").alias("ids")).mapInArrow(run, f"id {dict(df.dtypes)[id_col]}, decoded string")
    return out.withColumnRenamed("id", id_col)
