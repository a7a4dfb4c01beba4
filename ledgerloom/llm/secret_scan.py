"""Secret scans by grammar inference.

Three base rules give spans (assign, access, hex). Labelled credentials (the values that base rules find, or a given
table) train one probabilistic automaton for each kind with TRAIN_LEAST distinct credentials or more: a prefix tree of the credentials, written in character
classes, whose states merge while their outgoing frequencies are statistically compatible (a Hoeffding bound on every symbol, down the whole subtree): first
states of one depth, then, with evidence, states of different depths. Every other candidate of a text, a run of LEAST or more credential
characters, is scored by its likelihood per character under each automaton; above the
kind's threshold (a low quantile of labelled credentials' scores by automata that haven't seen them) it becomes a span of kind "format". A run has
no greatest length. If it is not accepted as a whole, what lies between any two of its ends and separators ("=", "/") is a
candidate too: all of them are scored in one pass backwards over the run, which keeps for each state of the automaton the
end of the largest excess over the threshold.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections import Counter, deque
from hashlib import blake2b
from math import log, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import text_slices, written

ASSIGN = re.compile(r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")  # of runs [0-9a-f]+, those of 32 or more
CANDIDATE = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{8,}")
SEPARATOR = re.compile(r"[=/]")
#: Characters of the shortest candidate, as many as the shortest assigned value; whether so short a string is of a format is for its likelihood to say.
LEAST = 8
KINDS = ("assign", "access", "hex")
#: Labelled credentials that one automaton is trained on, and the characters of each that it sees (scores are over whole candidates).
TRAIN_MOST, TRAIN_LENGTH = 400, 64
#: A kind with fewer distinct credentials gets no automaton: with so little evidence all states merge, and what is left accepts any order of the symbols seen.
TRAIN_LEAST = 8
#: How often a state must have been seen for its frequencies to count across depths, and for an end that never came to be none; the log likelihood of what was never seen.
EVIDENCE, UNSEEN = 20, -50.0

_CLASS = {c: ("h" if c in "abcdef" else "l") if c.islower() else "H" if c in "ABCDEF" else "U" if c.isupper() else "d" if c.isdigit() else c for c in map(chr, range(33, 127))}

_SIZE = Counter(_CLASS.values()) | Counter({"?": 1})


def classes(text: str) -> str:
    return "".join(_CLASS.get(c, "?") for c in text)


def base_spans(text: str) -> list[tuple[int, int, str, str]]:
    """(start, end, kind, credential) of the base rules, in code points, leftmost and without overlap within a kind; failing matches are dropped."""
    found = [(m.start(), m.end(), "assign", m[1]) for m in ASSIGN.finditer(text) if len(m[1]) >= 8]
    found += [(m.start(), m.end(), "access", m[0]) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    found += [(m.start(), m.end(), "hex", m[0]) for m in HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))


class Automaton:
    """A deterministic probabilistic automaton, inferred from strings; of one longer than `length` only so much is seen, and no end after it.

    It steps by character classes; within a class all characters count as equal. States of the prefix tree merge in two rounds. First those
    of one depth, from the root down, unless their frequencies differ: a place in the format gathers the evidence of all strings, which a
    single branch of the tree never has. Then those of different depths, only where both have been seen EVIDENCE times and all that follows is alike as far
    as there is evidence. So a fixed length, a prefix and what is special about a place stay, and repetition without a fixed number becomes a loop.
    """

    def __init__(self, strings: list[str], alpha: float = 0.05, length: int | None = None):
        self.length = length
        self.bound = sqrt(0.5 * log(2 / alpha))
        self.next: list[dict[str, int]] = [{}]
        self.count: list[Counter] = [Counter()]  # how often each class, or "" for the end, follows
        layers: list[list[int]] = [[0]]
        for s in strings:
            q = 0
            for depth, form in enumerate(classes(s[:length]), 1):
                self.count[q][form] += 1
                if form not in self.next[q]:
                    self.next[q][form] = len(self.next)
                    if depth == len(layers):
                        layers.append([])
                    layers[depth].append(len(self.next))
                    self.next.append({}), self.count.append(Counter())
                q = self.next[q][form]
            if s == s[:length]:
                self.count[q][""] += 1
        self.same = list(range(len(self.next)))
        self._merge_layers(layers)
        self._merge_depths()
        self._compact()
        self.total = [sum(c.values()) for c in self.count]
        self.lengths = self._lengths()
        self.low = min(map(self.seen_score, strings), default=0.0)

    def _of(self, q: int) -> int:
        while self.same[q] != q:
            self.same[q] = q = self.same[self.same[q]]
        return q

    def _alike(self, a: int, b: int, evidence: int) -> bool:
        """No pair of states below a and b differs in a frequency; pairs of which one was seen less than `evidence` times say nothing."""
        todo, met = [(self._of(a), self._of(b))], set()
        while todo:
            x, y = todo.pop()
            if x == y or (x, y) in met:
                continue
            met.add((x, y))
            n, m = sum(self.count[x].values()), sum(self.count[y].values())
            if min(n, m) < evidence:
                continue
            limit = self.bound * (1 / sqrt(n) + 1 / sqrt(m))
            if any(abs(self.count[x][c] / n - self.count[y][c] / m) > limit for c in {*self.count[x], *self.count[y]}):
                return False
            todo += [(self._of(self.next[x][c]), self._of(self.next[y][c])) for c in self.next[x].keys() & self.next[y].keys()]
        return True

    def _join(self, a: int, b: int) -> None:
        """Makes one state of a and b, and of what follows both on the same symbol."""
        todo = [(a, b)]
        while todo:
            x, y = map(self._of, todo.pop())
            if x == y:
                continue
            self.same[y] = x
            self.count[x] += self.count[y]
            for c, z in self.next[y].items():
                if c in self.next[x]:
                    todo.append((self.next[x][c], z))
                else:
                    self.next[x][c] = z

    def _merge_layers(self, layers: list[list[int]]) -> None:
        size = lambda q: sum(self.count[q].values())
        for layer in layers:
            kept: list[int] = []
            for q in sorted({self._of(q) for q in layer}, key=lambda q: (-size(q), q)):
                if self._of(q) != q:
                    continue
                if match := next((k for k in kept if self._alike(k, q, 1)), None):
                    self._join(match, q)
                else:
                    kept.append(q)

    def _merge_depths(self) -> None:
        red, blue = [0], deque((0, c) for c in sorted(self.next[0]))
        while blue:
            q, c = blue.popleft()
            b = self._of(self.next[self._of(q)][c])
            if b in map(self._of, red):
                continue
            n = sum(self.count[b].values())
            if not n:  # where strings were cut nothing is known, so it goes on as before
                self._join(q, b)
            elif n >= EVIDENCE and (r := next((r for r in red if sum(self.count[self._of(r)].values()) >= EVIDENCE and self._alike(r, b, EVIDENCE)), None)) is not None:
                self._join(r, b)
            else:
                red.append(b)
            red = sorted({self._of(r) for r in red})
            known = set(red)
            blue = deque((r, x) for r in red for x in sorted(self.next[r]) if self._of(self.next[r][x]) not in known)

    def _compact(self) -> None:
        """Numbers the states that can be reached, and drops the others."""
        place, order = {0: 0}, [0]
        if self._of(0) != 0:
            place, order = {self._of(0): 0}, [self._of(0)]
        for q in order:
            for z in map(self._of, self.next[q].values()):
                if z not in place:
                    place[z] = len(order)
                    order.append(z)
        self.next = [{c: place[self._of(z)] for c, z in self.next[q].items()} for q in order]
        self.count = [self.count[q] for q in order]
        del self.same

    def _lengths(self) -> set[int] | None:
        """The lengths of strings with an end; none if they are without number."""
        states, found = {0}, set()
        for n in range(len(self.next) + 1):
            if any(self.log_end(q) > UNSEEN for q in states):
                found.add(n)
            states = {z for q in states for z in self.next[q].values()}
            if not states:
                return found
        return None

    def log_step(self, q: int, char: str) -> float:
        """Log likelihood of a character: of its class in the state, and one of as many as the class has; UNSEEN if the state has no such step."""
        form = _CLASS.get(char, "?")
        if form not in self.next[q]:
            return UNSEEN
        return log(max(self.count[q][form], 0.5) / (self.total[q] + 1)) - log(_SIZE[form])

    def log_end(self, q: int) -> float:
        """Log likelihood of the end; UNSEEN in a state that went on EVIDENCE times and never ended."""
        k = self.count[q].get("", 0)
        return UNSEEN if not k and self.total[q] >= EVIDENCE else log(max(k, 0.5) / (self.total[q] + 1))

    def score(self, text: str, end: bool = True) -> float:
        """Mean log likelihood of a symbol, the end included if asked for; with anything UNSEEN it is no better than that."""
        q, total = 0, 0.0
        for c in text:
            step = self.log_step(q, c)
            if step <= UNSEEN:
                return UNSEEN
            total += step
            q = self.next[q][_CLASS.get(c, "?")]
        if end:
            if (last := self.log_end(q)) <= UNSEEN:
                return UNSEEN
            total += last
        return total / max(1, len(text) + end)

    def seen_score(self, text: str) -> float:
        """The score of what training sees of a string."""
        return self.score(text[: self.length], text == text[: self.length])

    def best_ends(self, text: str, low: float) -> dict[int, tuple[float, int]]:
        """For each start between separators the excess over low (score - low, times symbols) and the place of its best end, if that is accepted.

        Ends are before separators or at the end; what lies between has LEAST characters or more. Of equal ends the latest is taken.
        """
        size = len(self.next)
        cuts = [m.start() for m in SEPARATOR.finditer(text)]
        starts, ends = {0, *(c + 1 for c in cuts)}, {*cuts, len(text)}
        if not hasattr(self, "steps"):
            self.steps = {}
        seen = lambda x: np.where(x <= UNSEEN, -np.inf, x)
        stop = seen(np.array([self.log_end(q) for q in range(size)])) - low
        best, at, out = np.full(size, -np.inf), np.zeros(size, np.int64), {}
        for i in range(len(text), -1, -1):
            if i < len(text):
                c = text[i]
                if c not in self.steps:
                    self.steps[c] = seen(np.array([self.log_step(q, c) for q in range(size)])), np.array([following.get(_CLASS.get(c, "?"), 0) for following in self.next])
                step, to = self.steps[c]
                best, at = best[to] + (step - low), at[to]
            if i in ends:
                better = stop > best
                best[better], at[better] = stop[better], i
            start = i - LEAST
            if start in starts:
                q, total = 0, 0.0
                for k in range(start, i):
                    if (step := self.log_step(q, text[k])) <= UNSEEN:
                        break
                    total += step - low
                    q = self.next[q][_CLASS.get(text[k], "?")]
                else:
                    if total + best[q] >= 0:
                        out[start] = float(total + best[q]), int(at[q])
        return out


class Grammar:
    """An automaton and a threshold for each kind; labelled: kind -> credentials (repeats count once, unless they are known to be distinct beyond what is given of them)."""

    def __init__(self, labelled: dict[str, list[str]], quantile: float = 0.02, distinct: bool = False):
        self.kinds = {}
        for kind, found in sorted(labelled.items()):
            strings = [s[: TRAIN_LENGTH + 1] for s in sorted(found if distinct else set(found), key=lambda s: blake2b(s.encode()).digest())][:TRAIN_MOST]
            if len(strings) >= TRAIN_LEAST:
                automaton = Automaton(strings, length=TRAIN_LENGTH)
                # strings that an automaton has seen score better than others of their format: each half is scored by one trained on the other
                halves = strings[::2], strings[1::2]
                scores = sorted(x for k in (0, 1) for x in map(Automaton(halves[1 - k], length=TRAIN_LENGTH).seen_score, halves[k]))
                known = [x for x in scores if x > UNSEEN] or [automaton.low]  # rare ends or steps that one half lacks say nothing about likelihood
                self.kinds[kind] = (automaton, known[int(quantile * len(known))])
        each = [a.lengths for a, _ in self.kinds.values()]
        self.lengths = None if None in each else set().union(*each)
        self.known: dict[str | bytes, bool] = {}

    def accepts(self, text: str) -> bool:
        if self.lengths is not None and len(text) not in self.lengths:
            return False
        key = text if len(text) <= TRAIN_LENGTH else blake2b(text.encode()).digest()
        if key not in self.known:
            if len(self.known) > 100_000:
                self.known.clear()
            self.known[key] = any(a.score(text) >= low for a, low in self.kinds.values())
        return self.known[key]

    def parts(self, run: str) -> list[tuple[int, int]]:
        """The accepted candidates of a run, from left to right without overlap: the whole, or those between its ends and separators."""
        if len(run) < LEAST:
            return []
        if self.accepts(run):
            return [(0, len(run))]
        if not SEPARATOR.search(run):
            return []
        best = {}
        for automaton, low in self.kinds.values():
            for start, found in automaton.best_ends(run, low).items():
                best[start] = max(best.get(start, found), found)
        out = []
        for start, (_, end) in sorted(best.items()):
            if not out or start >= out[-1][1]:
                out.append((start, end))
        return out

    def spans(self, text: str) -> list[tuple[int, int, str, str]]:
        """All spans: the base ones, and candidates that an automaton accepts and no base span overlaps."""
        found = base_spans(text)
        taken = []  # disjoint
        for a, b, _, _ in found:
            if taken and a < taken[-1][1]:
                taken[-1] = taken[-1][0], max(b, taken[-1][1])
            else:
                taken.append((a, b))
        lengths, cut = self.lengths, SEPARATOR.search
        for m in CANDIDATE.finditer(text):
            if lengths is not None and m.end() - m.start() not in lengths and not cut(m[0]):
                continue  # no automaton has strings of that length
            for start, end in _free(text, m.start(), m.end(), taken):
                found += [(start + x, start + y, "format", text[start + x : start + y]) for x, y in self.parts(text[start:end])]
        return sorted(found, key=lambda s: (s[0], (*KINDS, "format").index(s[2])))


def _free(text: str, start: int, end: int, taken: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """A run without those of its parts between separators that a taken span overlaps; taken is sorted and disjoint."""
    taken = taken[bisect_right(taken, start, key=lambda t: t[1]) : bisect_left(taken, end, key=lambda t: t[0])]
    if not taken:
        return [(start, end)]
    out, at, k, reach = [], start, 0, 0
    for cut in [*(m.start() for m in SEPARATOR.finditer(text, start, end)), end]:
        part = at, cut
        while k < len(taken) and taken[k][0] < max(cut, at + 1):
            reach, k = max(reach, taken[k][1]), k + 1
        if reach <= at:
            if out and out[-1][1] + 1 == at:
                part = out.pop()[0], cut
            out.append(part)
        at = cut + 1
    return out


SPANS = "array<struct<start:bigint,end:bigint,kind:string,value:string>>"
_SPANS_ARROW = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string()), ("value", pa.string())]))


def _scanned(df: DataFrame, id_col: str, text_col: str, find, out: str) -> DataFrame:
    def run(batches):
        for batch in text_slices(batches):
            rows = [[dict(zip(("start", "end", "kind", "value"), s, strict=True)) for s in find(t or "")] for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, _SPANS_ARROW)], names=["id", out])

    return df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text")).mapInArrow(run, f"id {dict(df.dtypes)[id_col]}, {out} {SPANS}").withColumnRenamed("id", id_col)


def learn(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Grammar:
    """A grammar from the corpus' own base matches: for each kind the TRAIN_MOST distinct credentials of smallest hash.

    Repeated rows and credentials count once, so ties don't matter; null text is empty. An empty table, or one without credentials, gives a grammar that accepts
    nothing. Other columns are ignored.
    """
    found = _scanned(df, id_col, text_col, base_spans, "spans").select(F.explode("spans").alias("s")).select("s.kind", "s.value").distinct()
    found = written(found, "credentials")
    labelled = {k: [r["value"] for r in found.filter(F.col("kind") == k).select("value", F.xxhash64("value").alias("h")).orderBy("h", "value").limit(TRAIN_MOST).select(F.substring("value", 1, TRAIN_LENGTH + 1).alias("value")).collect()] for k in KINDS}
    return Grammar(labelled, distinct=True)


def scan(df: DataFrame, grammar: Grammar, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of df: id_col and spans (array of start, end, kind, value). Null text is empty; other columns are ignored.

    Spans are ordered by start, then kind as listed, with "format" last. Repeated rows have the same spans; an empty df gives no rows. id_col isn't named spans.
    """
    shared = df.sparkSession.sparkContext.broadcast(grammar)
    return _scanned(df, id_col, text_col, lambda t: shared.value.spans(t), "spans")


def redacted(text: str, spans: list[tuple[int, int, str, str]]) -> str:
    """The text with every span replaced by <secret:KIND>; overlapping spans become one, named after the first."""
    out, at = [], 0
    for start, end, kind, _ in sorted(spans):
        if start >= at:
            out += [text[at:start], f"<secret:{kind}>"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def redact(df: DataFrame, grammar: Grammar, text_col: str = "text", length_col: str | None = None) -> DataFrame:
    """df with secrets in text_col replaced, and length_col, if given, set to the new length in code points. Null text stays null; all other columns pass through, whatever their names. Repeated rows stay; an empty df gives no rows."""
    shared = df.sparkSession.sparkContext.broadcast(grammar)
    place = df.columns.index(text_col)

    def run(batches):
        for batch in text_slices(batches, place):
            texts = [None if t is None else redacted(t, shared.value.spans(t)) for t in batch.column(place).to_pylist()]
            yield batch.set_column(place, text_col, pa.array(texts, pa.string()))

    out = df.mapInArrow(run, df.schema)
    return out.withColumn(length_col, F.length(text_col).cast(dict(df.dtypes)[length_col])) if length_col else out
