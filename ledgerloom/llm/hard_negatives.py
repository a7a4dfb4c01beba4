r"""Hard negatives by ball trees: for each anchor and each of its best positives, the best rows of other labels within a window of scores.

A score is the inner product of integer vectors. The rows are dealt evenly; each partition packs its rows into trees of BLOCK rows
at most, and writes them as rows of a table. The anchors, a stated query set, are packed into blocks of ANCHORS likewise. A block of anchors
meets each tree once, as one row of a join on the partition's number, so a task holds one tree and one block of anchors at a
time, whatever the table's size.

A node of a tree is a ball: centre c, radius r. Its rows' products with q lie between c.q - r|q| and c.q + r|q|. A search
goes down depth first with the set of anchors for which the node is still open, the more promising child first. A node is closed
for an anchor if its upper bound is strictly below the current kth score (or equal to it, and no row of the node has a smaller identifier), if it lies
outside the anchor's windows, or if none of its labels will do. The bounds have a slack for rounding; what is returned are exact integers.

First search: positives, the best rows of the anchor's label. Second search: negatives, for each positive. Each tree gives
the best few of its own, which a window function merges.

Ties: the smaller identifier first. Rows with a null identifier, label or vector, or a null component, take no part. Rows with the
identifier of an anchor are never its positives or negatives; repeated rows count one by one, repeated anchors too. Vectors
of different lengths are compared as if the shorter one went on with zeros. Scores beyond 64 bits are set to the largest or least long.
An empty df, or one without anchors, gives no rows.
"""

from __future__ import annotations

import io
import math

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import written

#: Rows of a tree, rows of a leaf, anchors of a block, and rows of the join (a tree and a block of anchors each) that go to Python at once.
BLOCK, LEAF, ANCHORS, AT_ONCE = 8192, 64, 2048, 4
_LEAST, _MOST = -(1 << 63), (1 << 63) - 1


# ---- packing -----------------------------------------------------------------------------------------------------------


def _pack(**arrays: np.ndarray) -> bytes:
    out = io.BytesIO()
    np.savez(out, **arrays)
    return out.getvalue()


def _unpack(data: bytes) -> dict:
    with np.load(io.BytesIO(data)) as found:
        return dict(found)


def _narrow(x: np.ndarray) -> np.ndarray:
    """Whole numbers in the smallest of three types."""
    most = int(np.abs(x.astype(np.float64)).max(initial=0))
    return x.astype(np.int16 if most < 1 << 15 else np.int32 if most < 1 << 31 else np.int64)


def _matrix(vectors: pa.Array) -> np.ndarray:
    """A list column as a matrix; shorter vectors go on with zeros."""
    flat, ends = vectors.values.to_numpy(zero_copy_only=False), vectors.offsets.to_numpy()
    sizes = np.diff(ends)
    wide = int(sizes.max(initial=0))
    out = np.zeros((len(sizes), wide), np.int64)
    out[np.arange(wide) < sizes[:, None]] = flat[ends[0] : ends[-1]]
    return out


def _wide(x: np.ndarray, width: int) -> np.ndarray:
    return x if x.shape[1] == width else np.hstack([x, np.zeros((len(x), width - x.shape[1]), x.dtype)])


def products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact inner products of the rows of q with those of x."""
    most = float(np.abs(q.astype(np.float64)).max(initial=0)) * float(np.abs(x.astype(np.float64)).max(initial=0)) * max(1, q.shape[1])
    if most < 1 << 53:
        return (q.astype(np.float64) @ x.T.astype(np.float64)).astype(np.int64)  # whole numbers in a double's range
    found = q.astype(object) @ x.T.astype(object)
    return np.minimum(np.maximum(found, _LEAST), _MOST).astype(np.int64)


# ---- trees --------------------------------------------------------------------------------------------------------------


def build(ids: np.ndarray, labels: np.ndarray, x: np.ndarray, leaf: int = LEAF) -> dict:
    """A ball tree: rows in the order of the leaves, and for each node its rows, children, ball, smallest identifier and range of labels."""
    points, order = x.astype(np.float64), np.arange(len(ids))
    start, end, child, centre, radius = [], [], [], [], []

    def node(a: int, b: int) -> int:
        k = len(start)
        own = points[order[a:b]]
        c = own.mean(0)
        start.append(a), end.append(b), child.append((-1, -1)), centre.append(c)
        radius.append(math.sqrt(float(((own - c) ** 2).sum(1).max())))
        return k

    open_nodes = [node(0, len(ids))]
    while open_nodes:
        k = open_nodes.pop()
        a, b = start[k], end[k]
        if b - a <= leaf or radius[k] == 0:
            continue
        own = points[order[a:b]]
        far = own[np.argmax(((own - centre[k]) ** 2).sum(1))]
        other = own[np.argmax(((own - far) ** 2).sum(1))]
        half = (b - a) // 2
        order[a:b] = order[a:b][np.argpartition(own @ (other - far), half)]
        child[k] = (node(a, a + half), node(a + half, b))
        open_nodes += child[k]
    ids, labels = ids[order], labels[order]
    over = lambda f, v: np.array([f(v[a:b]) for a, b in zip(start, end, strict=True)])
    return {
        "ids": ids, "labels": labels, "x": _narrow(x[order]), "start": np.array(start), "end": np.array(end), "child": np.array(child), "centre": np.array(centre), "radius": np.array(radius),
        "first": over(np.min, ids), "label_from": over(np.min, labels), "label_to": over(np.max, labels),
    }


class Best:
    """The best k (score, identifier) of each of n queries so far."""

    def __init__(self, n: int, k: int):
        self.score, self.id = np.full((n, k), _LEAST), np.full((n, k), _MOST)
        self.k = k

    @property
    def kth(self) -> tuple[np.ndarray, np.ndarray]:
        return self.score[:, -1], self.id[:, -1]

    def add(self, query: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        if not len(query):
            return
        old = np.unique(query)
        query = np.concatenate([np.repeat(old, self.k), query])
        score, ids = np.concatenate([self.score[old].ravel(), score]), np.concatenate([self.id[old].ravel(), ids])
        order = np.lexsort((ids, ~score, query))  # ~ turns the order around, also at the least long
        query = query[order]
        rank = np.arange(len(query)) - np.searchsorted(query, query)
        kept = rank < self.k
        self.score[query[kept], rank[kept]], self.id[query[kept], rank[kept]] = score[order][kept], ids[order][kept]

    def rows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """query, score, identifier of what was found."""
        q, r = (self.id != _MOST).nonzero()
        return q, self.score[q, r], self.id[q, r]


def search(tree: dict, ids: np.ndarray, labels: np.ndarray, q: np.ndarray, k: int, same: bool, low: np.ndarray | None = None, high: np.ndarray | None = None) -> tuple[Best, int]:
    """The best k rows of the tree for each window of each anchor (query number: anchor * windows + window), and how many products it took.

    same: rows of the anchor's label, else of the others. low, high: windows of scores, a row for each anchor; none: one window without bounds.
    """
    if low is None:
        low, high = np.full((len(ids), 1), _LEAST), np.full((len(ids), 1), _MOST)
    windows = low.shape[1]
    best = Best(len(ids) * windows, k)
    if not len(ids) or not windows:
        return best, 0
    width = max(q.shape[1], tree["x"].shape[1])
    q, x = _wide(q, width), _wide(tree["x"], width)
    centre = _wide(tree["centre"], width)
    norm = np.sqrt((q.astype(np.float64) ** 2).sum(1))[:, None]
    middle = q.astype(np.float64) @ centre.T
    reach = norm * tree["radius"] + 1e-9 * norm * (np.sqrt((centre**2).sum(1)) + tree["radius"]) + 1e-6
    top = np.floor(np.clip(middle + reach, -9e18, 9e18)).astype(np.int64)
    bottom = np.ceil(np.clip(middle - reach, -9e18, 9e18)).astype(np.int64)
    used, todo = 0, [(0, np.arange(len(ids)))]
    while todo:
        node, active = todo.pop()
        a, b = tree["label_from"][node], tree["label_to"][node]
        own = labels[active]
        active = active[(own >= a) & (own <= b) if same else (own != a) | (own != b)]
        kth, kth_id = (v.reshape(len(ids), windows)[active] for v in best.kth)
        most = np.minimum(top[active, node][:, None], high[active])
        fits = (most >= low[active]) & (bottom[active, node][:, None] <= high[active]) & ((most > kth) | (most == kth) & (tree["first"][node] < kth_id))
        active = active[fits.any(1)]
        if not len(active):
            continue
        left, right = tree["child"][node]
        if left >= 0:
            nearer = middle[active, left].sum() >= middle[active, right].sum()
            todo += [(right, active), (left, active)] if nearer else [(left, active), (right, active)]
            continue
        rows = slice(tree["start"][node], tree["end"][node])
        for at in range(0, rows.stop - rows.start, 4 * LEAF):  # a leaf of equal vectors may be long
            some = slice(rows.start + at, min(rows.stop, rows.start + at + 4 * LEAF))
            score, row_ids = products(q[active], x[some]), tree["ids"][some]
            used += score.size
            right_label = (labels[active][:, None] == tree["labels"][some]) == same
            right_label &= ids[active][:, None] != row_ids
            for w in range(windows):
                query = active * windows + w
                kth, kth_id = (v[query][:, None] for v in best.kth)
                i, j = (right_label & (score >= low[active, w][:, None]) & (score <= high[active, w][:, None]) & ((score > kth) | (score == kth) & (row_ids < kth_id))).nonzero()
                best.add(query[i], score[i, j], row_ids[j])
    return best, used


# ---- Spark --------------------------------------------------------------------------------------------------------------


def _in_blocks(batches, most: int):
    """Arrow batches joined and cut to `most` rows."""
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= most:
            table = pa.Table.from_batches(held)
            while n >= most:
                yield table.slice(0, most)
                table, n = table.slice(most), n - most
            held = table.to_batches()
    if n:
        yield pa.Table.from_batches(held)


def _packed(rows: DataFrame, parts: int, most: int, name: str, tree: bool) -> DataFrame:
    """(part, block, data): the rows, dealt evenly over parts, in blocks of `most`; a written table."""

    def run(batches):
        part = TaskContext.get().partitionId()
        for k, table in enumerate(_in_blocks(batches, most)):
            ids, labels = (table.column(c).to_numpy() for c in (0, 1))
            x = _matrix(table.column(2).combine_chunks())
            data = _pack(**(build(ids, labels, x) if tree else {"ids": ids, "labels": labels, "x": _narrow(x)}))
            yield pa.RecordBatch.from_arrays([pa.array([part]), pa.array([part << 32 | k]), pa.array([data], pa.binary())], names=["part", "block", "data"])

    return written(rows.select("id", "label", "vector").repartition(parts).mapInArrow(run, "part bigint, block bigint, data binary"), name)


def _answers(trees: DataFrame, anchors: DataFrame, parts: int, name: str, k: int, windows: tuple[int, int] | None = None) -> DataFrame:
    """What each tree has for each block of anchors, as a written table. windows: percentages of the positives' scores, which anchors carry as arrays."""
    ask = anchors.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long"))))
    carried = [] if windows is None else ["place", "positive_id", "positive_score"]
    ready = ask.join(trees.select("part", F.col("data").alias("tree")), "part").select("block", "data", "tree", *carried)

    def run(batches):
        last: list = [None, None]
        for batch in batches:
            for row in range(batch.num_rows):
                block, data, tree = (batch.column(c)[row].as_py() for c in range(3))
                a = _unpack(data)
                if last[0] != tree:
                    last = [tree, _unpack(tree)]
                if windows is None:
                    best, _ = search(last[1], a["ids"], a["labels"], a["x"], k, same=True)
                    anchor, score, ids = best.rows()
                    columns = [pa.array(np.full(len(ids), block)), pa.array(anchor), pa.array(a["ids"][anchor])]
                else:
                    place, positive, positive_score = (batch.column(c)[row].values.to_numpy(zero_copy_only=False) for c in (3, 4, 5))
                    low, high, of = _windows(place, positive_score, len(a["ids"]), windows)
                    asked = np.unique(place)
                    best, _ = search(last[1], a["ids"][asked], a["labels"][asked], a["x"][asked], k, same=False, low=low[asked], high=high[asked])
                    found, score, ids = best.rows()
                    given = of[asked].ravel()[found]
                    columns = [pa.array(np.full(len(ids), block)), pa.array(given), pa.array(a["ids"][place[given]]), pa.array(positive[given]), pa.array(positive_score[given])]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(score), pa.array(ids)], names=names)

    names = ["block", "place", "anchor_id"] + ([] if windows is None else ["positive_id", "positive_score"]) + ["score", "id"]
    return written(ready.mapInArrow(run, ", ".join(f"{c} bigint" for c in names)), name, rows=AT_ONCE)


def _windows(place: np.ndarray, score: np.ndarray, n: int, bounds: tuple[int, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each of n anchors the windows of its positives, and which of the given rows each belongs to; an anchor with fewer has empty windows besides."""
    order = np.argsort(place, kind="stable")
    rank = np.empty(len(place), np.int64)
    rank[order] = np.arange(len(place)) - np.searchsorted(place[order], place[order])
    wide = int(rank.max(initial=-1)) + 1
    low, high, of = np.full((n, wide), _MOST), np.full((n, wide), _LEAST), np.zeros((n, wide), np.int64)
    exact = score.astype(object)
    low[place, rank] = np.array([-(-bounds[0] * s // 100) for s in exact], np.int64)
    high[place, rank] = np.array([bounds[1] * s // 100 for s in exact], np.int64)
    of[place, rank] = np.arange(len(place))
    return low, high, of


def mine(
    df: DataFrame, anchor: Column, id_col: str = "vec_id", vector_col: str = "vector", label_col: str = "label",
    positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95,
) -> DataFrame:
    """anchor_id, positive_id, rank (from 1), negative_id, positive_score, negative_score.

    df: whole-number identifiers and labels, and vectors of whole numbers. anchor: which rows are asked for. For each anchor and each of its first
    `positives` rows of the same label, the first `negatives` rows of other labels with low * positive_score <= 100 * negative_score <= high * positive_score.
    """
    vector = F.col(f"`{vector_col}`").cast("array<bigint>")
    rows = df.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), F.col(f"`{label_col}`").cast("bigint").alias("label"), vector.alias("vector"), F.coalesce(anchor, F.lit(False)).alias("anchor"))
    rows = rows.filter("id is not null and label is not null and vector is not null and not exists(vector, v -> v is null)")
    n, n_anchors = rows.agg(F.count("*"), F.count_if("anchor")).first()
    parts = max(1, -(-n // BLOCK))
    trees = _packed(rows, parts, BLOCK, "ball-trees", tree=True)
    anchors = _packed(rows.filter("anchor"), max(1, -(-n_anchors // ANCHORS)), ANCHORS, "anchors", tree=False).drop("part")
    found = _answers(trees, anchors, parts, "positives", positives)
    best = found.withColumn("rank", F.row_number().over(Window.partitionBy("block", "place").orderBy(F.desc("score"), "id"))).filter(F.col("rank") <= positives)
    asked = best.groupBy("block").agg(F.sort_array(F.collect_list(F.struct("place", "rank", "id", "score"))).alias("p"))  # a block has ANCHORS anchors at most
    asked = asked.select("block", F.col("p.place").alias("place"), F.col("p.id").alias("positive_id"), F.col("p.score").alias("positive_score"))
    near = _answers(trees, anchors.join(asked, "block"), parts, "negatives", negatives, (low, high))
    order = Window.partitionBy("block", "place").orderBy(F.desc("score"), "id")
    ranked = near.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= negatives)
    return ranked.select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
