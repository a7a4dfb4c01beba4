"""Sequence packing as vector bin packing.

Each example (a document's ids and an end id) demands three things of a sequence: tokens, one segment, and
loss-bearing tokens. Examples longer than a sequence are cut into full sequences and a rest. A rest goes into that
open sequence, among those it fits, whose free capacities have the largest dot product with its demands, each in
shares of the limit. If it fits nowhere and no more sequences may be open, its head fills the fullest one to the
last token and the remainder is placed anew. At the end of a partition open sequences are poured together, and what
is left over is cut into lengths that are powers of two, which need no padding.

All of it streams over the partitions as they are read: no shuffle, and memory for `open_most` sequences a task.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.bpe import loaded, read_spec
from ledgerloom.llm.common import text_slices


@dataclass(frozen=True)
class Limits:
    tokens: int = 4096
    segments: int = 512
    loss_tokens: int = 4096
    open_most: int = 32

    def __post_init__(self):
        if min(self.tokens, self.segments, self.loss_tokens, self.open_most) < 1:
            raise ValueError("every limit is 1 at least: else nothing could ever be placed")


class Packer:
    """Places (doc, start, ids, loss, total) pieces; `done` collects finished sequences as lists of pieces.

    loss is None (every token bears loss) or a boolean array as long as ids.
    """

    def __init__(self, limits: Limits):
        self.limits, self.done = limits, []
        self.caps = np.array([limits.tokens, limits.segments, limits.loss_tokens], float)
        self.free = np.zeros((0, 3))
        self.open: list[list] = []

    @staticmethod
    def _demand(piece) -> tuple[int, int, int]:
        n = len(piece[2])
        return n, 1, n if piece[3] is None else int(piece[3].sum())

    @staticmethod
    def _cut(piece, n: int):
        doc, start, ids, loss, total = piece
        return (doc, start, ids[:n], loss if loss is None else loss[:n], total), (doc, start + n, ids[n:], loss if loss is None else loss[n:], total)

    def _head(self, piece, room) -> int:
        """The most tokens of the piece that fit into `room`."""
        if room[1] < 1:
            return 0
        n = int(min(len(piece[2]), room[0]))
        if piece[3] is None:
            return int(min(n, room[2]))
        return int(np.searchsorted(np.cumsum(piece[3][:n]), room[2], "right"))

    def _close(self, i: int) -> None:
        self.done.append(self.open.pop(i))
        self.free = np.delete(self.free, i, 0)

    def _put(self, i: int, piece) -> None:
        self.open[i].append(piece)
        self.free[i] -= self._demand(piece)
        if self.free[i, 0] <= 0 or self.free[i, 1] <= 0:
            self._close(i)

    def add(self, piece) -> None:
        while len(piece[2]) >= self.limits.tokens and (n := self._head(piece, self.caps)) and n < len(piece[2]):
            head, piece = self._cut(piece, n)
            self.done.append([head])
        while len(piece[2]):
            need = np.array(self._demand(piece), float)
            fits = (self.free >= need).all(1)
            if fits.any():
                score = np.where(fits, (self.free / self.caps) @ (need / self.caps), -1.0)
                return self._put(int(score.argmax()), piece)
            if len(self.open) < self.limits.open_most:
                self.open.append([])
                self.free = np.vstack([self.free, self.caps])
                n = self._head(piece, self.caps)
                if n == len(piece[2]):
                    return self._put(len(self.open) - 1, piece)
                head, piece = self._cut(piece, n)
                self._put(len(self.open) - 1, head)
                continue
            i = int(self.free[:, 0].argmin())  # the fullest
            n = self._head(piece, self.free[i])
            if n:
                head, piece = self._cut(piece, n)
                self._put(i, head)
            if len(self.open) == self.limits.open_most and (not n or self.free[i, 2] <= 0):
                self._close(i)

    def finish(self) -> None:
        """Pours the emptier open sequences into the fuller ones and cuts the last ones into powers of two."""
        order = np.argsort(self.free[:, 0], kind="stable")
        rest = [p for i in order for p in self.open[i]]
        self.open, self.free = [], np.zeros((0, 3))
        current, room = [], self.caps.copy()
        for piece in rest:
            while len(piece[2]):
                n = self._head(piece, room)
                if n:
                    head, piece = self._cut(piece, n)
                    current.append(head)
                    room -= self._demand(head)
                if len(piece[2]) or room[0] <= 0:
                    self.done.append(current)
                    current, room = [], self.caps.copy()
        while current:
            size = 1 << (sum(len(p[2]) for p in current).bit_length() - 1)
            taken, left = [], size
            while left:
                head, tail = self._cut(current.pop(0), left)
                taken.append(head)
                left -= len(head[2])
                if len(tail[2]):
                    current.insert(0, tail)
            self.done.append(taken)


SCHEMA = "start bigint, length bigint, ids binary, loss_tokens bigint, doc_tokens bigint, sequence_id bigint, offset bigint, sequence_tokens bigint"


def pack(df: DataFrame, vocab_path: str, id_col: str = "doc_id", text_col: str = "text", loss_from_col: str | None = None, end_id: int = 2, limits: Limits = Limits()) -> DataFrame:
    """One row for each piece: id_col, start, length, ids (binary, little-endian unsigned 32-bit), loss_tokens, doc_tokens, sequence_id, offset, sequence_tokens.

    ids are those of the tokenizers library without special tokens, then end_id. loss_from_col: a column with the
    first token that bears loss (null or none: every token does). A sequence is padded to limits.tokens unless its
    length is a power of two. Null text: a document of end_id alone. Repeated rows are separate documents. Other
    columns are ignored; an empty df gives no rows. sequence_id is the partition's number and a count within it.
    """
    shared = df.sparkSession.sparkContext.broadcast(read_spec(vocab_path))
    id_type = dict(df.dtypes)[id_col]

    def run(batches):
        from pyspark import TaskContext

        _, cache = loaded("library", shared.value)
        packer, base, count, out_type = Packer(limits), TaskContext.get().partitionId() << 32, 0, pa.int64()

        def rows():
            nonlocal count
            out = [[] for _ in range(9)]
            for sequence in packer.done:
                at, total = 0, sum(len(p[2]) for p in sequence)
                for piece in sequence:
                    doc, start, ids, _, doc_tokens = piece
                    for column, value in zip(out, (doc, start, len(ids), ids.astype("<u4").tobytes(), packer._demand(piece)[2], doc_tokens, base + count, at, total), strict=True):
                        column.append(value)
                    at += len(ids)
                count += 1
            packer.done = []
            kinds = [out_type, *[pa.int64()] * 2, pa.binary(), *[pa.int64()] * 5]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], names=["id", "start", "length", "ids", "loss_tokens", "doc_tokens", "sequence_id", "offset", "sequence_tokens"])

        for batch in text_slices(batches, limit=1_000_000):
            out_type = batch.column(0).type
            encoded = cache.encode(batch.column(1).to_pylist())
            for doc, ids, first in zip(batch.column(0).to_pylist(), encoded, batch.column(2).to_pylist(), strict=True):
                ids = np.append(ids, np.uint32(end_id))
                packer.add((doc, 0, ids, None if first is None else np.arange(len(ids)) >= first, len(ids)))
            if packer.done:
                yield rows()
        packer.finish()
        if packer.done:
            yield rows()

    first = F.col(f"`{loss_from_col}`").cast("long") if loss_from_col else F.lit(None).cast("long")
    out = df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"), first.alias("first")).mapInArrow(run, f"id {id_type}, {SCHEMA}")
    return out.withColumnRenamed("id", id_col)
