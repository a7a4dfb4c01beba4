"""Exact n-gram Jaccard self-join by T-occurrence search: components and numbers of links.

Documents are sets of word shingles (64-bit hashes). Two sets x and y link if they share at least
T = ceil(s (|x| + |y|) / (1 + s)) shingles, s = 0.75. Steps:

1. An inverted index over all sets, sharded by shingle. Blocks of documents send each shard their distinct shingles as
   packed arrays; the shard tells each block how many shingles of each document occur in other sets too. A set with
   fewer than s |x| of those links with nothing and is done. (Shards compare 32 further bits of the hash: a chance
   hit only keeps a set in.) Equal sets are one class, of which the smallest identifier takes part from here on.
2. The classes that are left have their shingles counted, by shards again, and ordered: rare ones first. If x and y
   link, their first |x| - ceil(s|x|) + 1 and |y| - ceil(s|y|) + 1 shingles have a first one in common, and after it
   enough shingles are left in both. Documents that could link so are put into one cluster: first within a block, then,
   with one entry for all that a block has put together, within the shard of a shingle. Links never leave a cluster.
3. In each cluster a T-occurrence search, DivideSkip: a query document's inverted lists over the cluster are divided into
   the L longest and the rest; the rest is merged by a heap, documents that occur T - L times or more are looked up in the
   long lists by binary search, and those that reach T link. Clusters of over GROUP_MOST documents are divided into
   cells by size and a hash, and pairs of cells whose sizes allow links are searched, each in a task of its own.
   A search yields a row for each document: the copies it links with, and the smallest document connected to it there.
   So no row is made for a pair, and no list, class, cluster or component has to fit into one task.

Components are the connected components of those rows.
"""

from __future__ import annotations

from heapq import merge
from math import log2

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import give_back, text_slices, written
from ledgerloom.llm.components import components
from ledgerloom.llm.shingles import shingle_sets

SHINGLE, NUMERATOR, DENOMINATOR = 5, 75, 100
#: Bytes of text whose shingles are computed at once; the arrays take some forty times as much.
SLICE = 1_000_000
#: Shingles that a block of documents deals to the shards at once, and its documents, at most (one longer document apart).
BLOCK, BLOCK_DOCS = 1_000_000, 60_000
#: Shingles of one shard of the index, about; a shingle counts once for each block. A row has BLOCK * SHARD / all of them, so both grow with the
#: executors' memory where tables are very large (100 TB: 16 and 64 million), while partitions take several shards, one after another.
SHARD, PARTITIONS_MOST = 1_500_000, 20_000
#: Documents and shingles of a cluster, or of a cell of a larger one, that are searched in one group, about.
GROUP_MOST, GROUP_SHINGLES = 256, 500_000
#: Representatives that are left after step 1 are broadcast up to this number, 50 bytes each; beyond, they are joined.
BROADCAST_MOST = 1_000_000
#: Lists of more entries are put into clusters by a sweep, which may put more together than pairs could link.
SWEEP_FROM = 4_096
#: The weight of a binary probe against a step of the merge in DivideSkip.
MU = 0.01
_NOBODY = 0xFFFF


def needed(x: int, y: int) -> int:
    """The smallest overlap at which sets of x and y shingles link: 100 o >= 75 (x + y - o)."""
    return -(-NUMERATOR * (x + y) // (NUMERATOR + DENOMINATOR))


def least_partner(n):
    """The size of the smallest set that one of n shingles can link with, which is also the smallest overlap."""
    return -(-NUMERATOR * n // DENOMINATOR)


# ---- the search -----------------------------------------------------------------------------------------------------


class Index:
    """Inverted lists over some sets (sorted arrays without repeats), and the T-occurrence search in them."""

    def __init__(self, sets: list[np.ndarray]):
        self.size = np.array([len(s) for s in sets], np.int64)
        self.first = np.append(0, np.cumsum(self.size))
        flat = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
        owner = np.repeat(np.arange(len(sets)), self.size)
        order = np.argsort(flat, kind="stable")  # owners ascend within a list
        token, self.owner = flat[order], owner[order]
        start = np.append(True, token[1:] != token[:-1]) if len(token) else np.zeros(0, bool)
        self.rank = np.cumsum(start) - 1
        edge = np.append(start.nonzero()[0], len(token))
        self.end = edge[self.rank + 1] if len(token) else np.zeros(0, np.int64)
        self.place = np.empty(len(flat), np.int64)
        self.place[order] = np.arange(len(flat))
        self.probe = self.rank * max(1, len(sets)) + self.owner  # ascends: what binary search looks into
        self.list = self.owner.tolist()

    def search(self, query: int, among: int) -> list[int]:
        """The sets that link with set `query`, of those from number `among` on and after the query."""
        p = self.place[self.first[query] : self.first[query + 1]]
        end = self.end[p]
        begin = p + 1
        if among > query + 1:
            begin = np.searchsorted(self.probe, self.rank[p] * len(self.size) + among)
        length = end - begin
        has = length > 0
        n = int(self.size[query])
        T = needed(n, max(least_partner(n), int(self.size[max(among, query + 1) :].min(initial=1 << 40))))
        if has.sum() < T:
            return []
        begin, end, length, rank = begin[has], end[has], length[has], self.rank[p][has]
        skip = min(T - 1, int(T / (MU * log2(max(2, int(length.max()))) + 1)))
        order = np.argsort(length, kind="stable")
        short, long = order[: len(order) - skip], order[len(order) - skip :]
        count: dict[int, int] = {}
        for d in merge(*[self.list[a:b] for a, b in zip(begin[short].tolist(), end[short].tolist(), strict=True)]):
            count[d] = count.get(d, 0) + 1
        able = [d for d, c in count.items() if c + skip >= (t := needed(n, int(self.size[d]))) and t <= min(n, int(self.size[d]))]
        if not able:
            return []
        found = np.array([count[d] for d in able], np.int64)
        if len(long):
            wanted = rank[long][:, None] * len(self.size) + np.array(able, np.int64)
            at = np.minimum(np.searchsorted(self.probe, wanted), len(self.probe) - 1)
            found += (self.probe[at] == wanted).sum(0)
        return [d for d, c in zip(able, found.tolist(), strict=True) if c >= needed(n, int(self.size[d]))]


class Union:
    """Union-find over the places 0 to n - 1; the root is the smallest place."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, x: int) -> int:
        up = self.up
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    def join(self, x: int, y: int) -> None:
        x, y = self.root(x), self.root(y)
        if x != y:
            self.up[max(x, y)] = min(x, y)

    def roots(self) -> np.ndarray:
        return np.array([self.root(x) for x in range(len(self.up))], np.int64)


# ---- step 1: which sets share enough shingles with others at all ------------------------------------------------------


def _shard_of(token: np.ndarray, shards: int) -> np.ndarray:
    return ((token >> np.uint64(32)) * np.uint64(shards)) >> np.uint64(32)


_DEAL = "shard int, block bigint, docs boolean, a binary, b binary, c binary, d binary"


def _deal_row(*row) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, (pa.int32(), pa.int64(), pa.bool_(), *[pa.binary()] * 4), strict=True)], names=[x.split()[0] for x in _DEAL.split(", ")])


def _deal(batches, shards: int):
    """Blocks of documents: one row with identifiers, sizes, digests and local counts, and one for each shard with the shingles it gets and their owners."""
    import hashlib

    part, number, ids, sets = TaskContext.get().partitionId(), 0, [], []

    def block():
        nonlocal number
        number += 1
        key = part << 32 | number
        size = np.array([len(s) for s in sets], np.uint32)
        digests = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets]
        seen: dict[bytes, int] = {}
        first = [i for i, d in enumerate(digests) if seen.setdefault(d, i) == i and size[i]]
        token = np.concatenate([sets[i] for i in first]) if first else np.zeros(0, np.uint64)
        owner = np.repeat(np.array(first, np.uint16), size[first])
        every, at, times = np.unique(token, return_inverse=True, return_counts=True)
        several = times[at] > 1
        local = np.full(len(sets), -1, np.int32)  # of a repeated set only the first is counted
        local[first] = np.bincount(owner[several], minlength=len(sets))[first]
        yield _deal_row(key % shards, key, True, np.array(ids, np.int64).tobytes(), size.tobytes(), b"".join(digests), local.tobytes())
        shared = every[times > 1]  # goes once, as nobody's
        token, owner = np.concatenate([token[~several], shared]), np.concatenate([owner[~several], np.full(len(shared), _NOBODY, np.uint16)])
        to = _shard_of(token, shards)
        order = np.argsort(to.astype(np.uint16), kind="stable") if shards <= 0xFFFF else np.argsort(to, kind="stable")
        token, owner, to = (token[order] & np.uint64(0xFFFFFFFF)).astype(np.uint32), owner[order], to[order]
        edge = np.append(0, np.append((to[1:] != to[:-1]).nonzero()[0] + 1, len(to)))
        for a, b in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True):
            if b > a:  # owners ascend, so they go as runs
                own = owner[a:b]
                run = np.append(True, own[1:] != own[:-1]).nonzero()[0]
                yield _deal_row(int(to[a]), key, False, token[a:b].tobytes(), own[run].tobytes(), np.diff(np.append(run, b - a)).astype(np.uint32).tobytes(), None)

    held = 0
    for batch in text_slices(batches, limit=SLICE):
        for i, s in zip(batch.column(0).to_pylist(), shingle_sets(batch.column(1), SHINGLE), strict=True):
            ids.append(i)
            sets.append(s)
            held += len(s)
            if held >= BLOCK or len(ids) >= BLOCK_DOCS:
                yield from block()
                ids, sets, held = [], [], 0
    if ids:
        yield from block()


def _by_run(batches, keys: int):
    """Rows of sorted batches as lists, one for each run of equal values in the first `keys` columns."""
    now, run = None, []
    for batch in batches:
        key = list(zip(*[batch.column(k).to_pylist() for k in range(keys)], strict=True))
        rest = [batch.column(k) for k in range(keys, batch.num_columns)]
        for i, k in enumerate(key):
            if k != now and run:
                yield now, run
                run = []
            now = k
            run.append([c[i].as_py() for c in rest])
    if run:
        yield now, run
    run = None
    give_back()


def _count(batches):
    """In each shard: how many of an owner's shingles occur in another entry too. Rows about documents pass through."""
    none = b""
    for (shard,), rows in _by_run(batches, 1):
        for block, docs, *columns in rows:
            if docs:
                yield _deal_row(shard, block, True, *columns)
        rows = [r for r in rows if not r[1]]
        if not rows:
            continue
        token = np.concatenate([np.frombuffer(r[2], np.uint32) for r in rows])
        runs = np.concatenate([np.frombuffer(r[4], np.uint32) for r in rows])
        entry = np.repeat(np.arange(len(runs)), runs)
        order = np.argsort(token)
        token, entry = token[order], entry[order]
        same = token[1:] == token[:-1]
        shared = np.append(same, False) | np.append(False, same)
        count, at = np.bincount(entry[shared], minlength=len(runs)), 0
        for block, _, _, owners, lengths, _ in rows:
            own = np.frombuffer(owners, np.uint16)
            some = count[at : at + len(own)]
            at += len(own)
            hit = (some > 0) & (own != _NOBODY)
            if hit.any():
                yield _deal_row(shard, block, False, own[hit].tobytes(), some[hit].astype(np.uint32).tobytes(), none, none)


def _alive(table: pa.Table) -> pa.Table:
    """Of one block: id, n, digest, and whether the set shares enough shingles with others to link at all (null for a repeated set)."""
    rows = table.select(["docs", "a", "b", "c", "d"]).to_pylist()
    head = next(r for r in rows if r["docs"])
    size, local = np.frombuffer(head["b"], np.uint32).astype(np.int64), np.frombuffer(head["d"], np.int32)
    shared = local.astype(np.int64)
    for r in rows:
        if not r["docs"]:
            shared[np.frombuffer(r["a"], np.uint16)] += np.frombuffer(r["b"], np.uint32)
    return pa.table({
        "id": pa.array(np.frombuffer(head["a"], np.int64)), "n": pa.array(size), "digest": pa.array([head["c"][k : k + 16] for k in range(0, len(head["c"]), 16)], pa.binary()),
        "alive": pa.array(shared >= least_partner(size), pa.bool_(), mask=local < 0),
    })


# ---- step 2: clusters -------------------------------------------------------------------------------------------------


_ASK = "shard int, block bigint, token binary, times binary"


def _ask(batches, shards: int):
    """The distinct shingles of a block's sets (of as many as come at once), with their numbers, for the shards."""
    for (block,), rows in _by_run(batches, 1):
        token, times = np.unique(np.concatenate([np.frombuffer(r[-1], np.uint64) for r in rows]), return_counts=True)
        edge = np.searchsorted(_shard_of(token, shards), np.arange(shards + 1))
        some = [k for k in range(shards) if edge[k] < edge[k + 1]]
        parts = [slice(edge[k], edge[k + 1]) for k in some]
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array([block] * len(some), pa.int64()), pa.array([token[p].tobytes() for p in parts], pa.binary()), pa.array([times[p].astype(np.uint32).tobytes() for p in parts], pa.binary())], names=["shard", "block", "token", "times"])


def _answer(batches):
    """In each shard: to each block its shingles that occur in several sets, with their numbers (65,535 at most)."""
    for _, rows in _by_run(batches, 1):
        own = [np.frombuffer(t, np.uint64) for _, t, _ in rows]
        every, at = np.unique(np.concatenate(own), return_inverse=True)
        total = np.bincount(at, np.concatenate([np.frombuffer(n, np.uint32) for _, _, n in rows]), len(every)).astype(np.int64)
        where = np.append(0, np.cumsum([len(t) for t in own]))
        for k, (block, _, _) in enumerate(rows):
            times = total[at[where[k] : where[k + 1]]]
            several = times > 1
            if several.any():
                yield pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), pa.array([own[k][several].tobytes()], pa.binary()), pa.array([np.minimum(times[several], 0xFFFF).astype(np.uint16).tobytes()], pa.binary())], names=["block", "token", "times"])


def clustered(token: np.ndarray, who: np.ndarray, low: np.ndarray, high: np.ndarray, reach: np.ndarray, union: Union) -> None:
    """Joins the places in `who` whose entries in a list could link; rows are sorted by token.

    An entry stands for documents of low to high shingles, of which one can link with a set of up to `reach` shingles if
    this list's shingle is the first they share.
    """
    edge = np.append(0, np.append((token[1:] != token[:-1]).nonzero()[0] + 1, len(token)))
    length = np.diff(edge)

    def fit(x, y) -> np.ndarray:
        return (low[y] <= reach[x]) & (low[x] <= reach[y]) & (DENOMINATOR * high[x] >= NUMERATOR * low[y]) & (DENOMINATOR * high[y] >= NUMERATOR * low[x])

    two = edge[:-1][length == 2]
    two = two[fit(two, two + 1)]
    for x, y in set(zip(who[two].tolist(), who[two + 1].tolist(), strict=True)):
        union.join(x, y)
    for a, b in zip(edge[:-1][length > 2].tolist(), edge[1:][length > 2].tolist(), strict=True):
        left = np.arange(a, b)
        roots = [union.root(x) for x in who[a:b].tolist()]
        if len(set(roots)) == 1:
            continue
        if b - a > SWEEP_FROM:  # in order of size, as long as someone before reaches the next
            left = left[reach[left] >= -(-NUMERATOR * low[left] // DENOMINATOR)]
            left = left[np.argsort(low[left], kind="stable")]
            far = np.maximum.accumulate(np.minimum(reach[left], DENOMINATOR * high[left] // NUMERATOR))
            for k in (low[left[1:]] <= far[:-1]).nonzero()[0].tolist():
                union.join(int(who[left[k]]), int(who[left[k + 1]]))
            continue
        while len(left) > 1:  # from one entry to all that it fits, and on from those
            front, left = [int(left[0])], left[1:]
            while front and len(left):
                x = front.pop()
                hit = fit(x, left)
                for y in left[hit].tolist():
                    union.join(int(who[x]), int(who[y]))
                    front.append(y)
                left = left[~hit]


_ENTRY = "shard int, edges boolean, a binary, b binary, c binary, d binary, e binary"
_ENTRY_ARROW = (pa.int32(), pa.bool_(), *[pa.binary()] * 5)


def _entry_table(rows: list[tuple]) -> pa.Table:
    columns = list(zip(*rows, strict=True)) if rows else [()] * 7
    return pa.table({x.split()[0]: pa.array(c, t) for x, c, t in zip(_ENTRY.split(", "), columns, _ENTRY_ARROW, strict=True)})


def _prefixes(docs: pa.Table, answers: pa.Table, shards: int) -> pa.Table:
    """Of one block: its own clusters, as edges; and for each shingle in prefixes one entry for each of those clusters, packed by shard."""
    if not docs.num_rows:
        return _entry_table([])
    known = np.concatenate([np.frombuffer(t, np.uint64) for t in answers.column("token").to_pylist()] or [np.zeros(0, np.uint64)])
    times = np.concatenate([np.frombuffer(t, np.uint16) for t in answers.column("times").to_pylist()] or [np.zeros(0, np.uint16)])
    order = np.argsort(known)
    known, times = known[order], times[order]
    ids = docs.column("id").to_numpy()
    token, who, low, reach = [], [], [], []
    for k, raw in enumerate(docs.column("tokens").to_pylist()):
        s = np.frombuffer(raw, np.uint64)
        n = len(s)
        at = np.minimum(np.searchsorted(known, s), len(known) - 1) if len(known) else None
        often = np.where(known[at] == s, times[at], 1) if len(known) else np.ones(n, np.int64)
        order = np.lexsort((s, often))[: n - least_partner(n) + 1]
        place = (often[order] > 1).nonzero()[0]  # a shingle that no other set has brings nobody together
        token.append(s[order[place]])
        who.append(np.full(len(place), k))
        low.append(np.full(len(place), n))
        reach.append((NUMERATOR + DENOMINATOR) * (n - place) // NUMERATOR - n)
    token, who, low, reach = map(np.concatenate, (token, who, low, reach))
    order = np.argsort(token, kind="stable")
    token, who, low, reach = token[order], who[order], low[order], reach[order]
    union = Union(len(ids))
    clustered(token, who, low, low, reach, union)
    root = union.roots()
    other = (ids[root] != ids).nonzero()[0]
    rows = [(int(ids[0]) % shards, True, ids[other].tobytes(), ids[root[other]].tobytes(), None, None, None)] if len(other) else []
    label = root[who]
    order = np.lexsort((label, token))
    token, label, low, reach = token[order], label[order], low[order], reach[order]
    if len(token):
        start = np.append(True, (token[1:] != token[:-1]) | (label[1:] != label[:-1])).nonzero()[0]
        token, label = token[start], label[start]
        low, high, reach = np.minimum.reduceat(low, start), np.maximum.reduceat(low, start), np.maximum.reduceat(reach, start)
        edge = np.searchsorted(_shard_of(token, shards), np.arange(shards + 1))
        for k in range(shards):
            p = slice(edge[k], edge[k + 1])
            if edge[k] < edge[k + 1]:
                rows.append((k, False, token[p].tobytes(), ids[label[p]].tobytes(), low[p].astype(np.int64).tobytes(), high[p].astype(np.int64).tobytes(), reach[p].astype(np.int64).tobytes()))
    return _entry_table(rows)


def _clusters(batches):
    """In each shard: edges (u, v) that bring the entries together which could link; edges of blocks pass through."""
    for _, rows in _by_run(batches, 1):
        for _, a, b, *_ in [r for r in rows if r[0]]:
            yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(a, np.int64)), pa.array(np.frombuffer(b, np.int64))], names=["u", "v"])
        rows = [r for r in rows if not r[0]]
        if not rows:
            continue
        token = np.concatenate([np.frombuffer(r[1], np.uint64) for r in rows])
        label, low, high, reach = (np.concatenate([np.frombuffer(r[k], np.int64) for r in rows]) for k in (2, 3, 4, 5))
        order = np.argsort(token, kind="stable")
        ids, who = np.unique(label[order], return_inverse=True)
        union = Union(len(ids))
        clustered(token[order], who, low[order], high[order], reach[order], union)
        root = union.roots()
        other = (root != np.arange(len(ids))).nonzero()[0]
        yield pa.RecordBatch.from_arrays([pa.array(ids[other]), pa.array(ids[root[other]])], names=["u", "v"])


# ---- step 3 -------------------------------------------------------------------------------------------------------------


_GROUP = "struct<c:bigint,a:int,s:int,b:int,t:int,second:boolean>"


def _search(batches):
    """For each document of a group: the copies that it links with there, and the smallest identifier that is connected to it."""
    for (_, *one, size, salt), rows in _by_run(batches, 5):  # second, id, copies, tokens
        rows.sort(key=lambda r: (r[0], len(r[3]), r[1]))
        sets = [np.frombuffer(r[3], np.uint64) for r in rows]
        ids, copies = np.array([r[1] for r in rows], np.int64), [r[2] for r in rows]
        first = sum(not r[0] for r in rows)
        queries, among = (len(rows), 0) if one == [size, salt] else (first if first < len(rows) else 0, first)
        index, order = Index(sets), np.argsort(ids, kind="stable")
        place = np.empty(len(ids), np.int64)
        place[order] = np.arange(len(ids))  # by identifier, so that roots are smallest ones
        union, others = Union(len(ids)), [0] * len(ids)
        for q in range(queries):
            for d in index.search(q, among):
                others[q] += copies[d]
                others[d] += copies[q]
                union.join(int(place[q]), int(place[d]))
        some = [k for k in range(len(ids)) if others[k]]
        roots = ids[order][union.roots()[place]] if some else ids
        yield pa.RecordBatch.from_arrays([pa.array(ids[some]), pa.array(np.array(others, np.int64)[some]), pa.array(roots[some])], names=["id", "others", "root"])


class _Join:
    def __init__(self, df: DataFrame, id_col: str, text_col: str):
        text = df.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text"))
        self.text = text.filter("id IS NOT NULL AND text IS NOT NULL")

    def survey(self) -> tuple[DataFrame, DataFrame]:
        """(id, n, digest, alive) of all rows, and (digest, rep, n, copies, alive) of each class of equal sets."""
        size = self.text.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        shards = max(1, min(1 << 30, size // (6 * SHARD)))  # a word of prose takes some six bytes
        dealt = self.text.mapInArrow(lambda b: _deal(b, shards), _DEAL).repartition(min(2 * shards, PARTITIONS_MOST), "shard").sortWithinPartitions("shard")
        counted = written(dealt.mapInArrow(_count, _DEAL).drop("shard"), "counted")
        self.rows = written(counted.groupBy("block").applyInArrow(_alive, "id bigint, n bigint, digest binary, alive boolean"), "sets")
        found = self.rows.filter("n > 0").groupBy("digest")
        self.classes = found.agg(F.min("id").alias("rep"), F.first("n").alias("n"), F.count(F.lit(1)).alias("copies"), F.bool_and("alive").alias("alive"))
        return self.rows, self.classes

    def sets(self) -> None:
        """The whole sets of the classes that are left, with their number of shingles in all."""

        def whole(batches):
            import hashlib

            for batch in text_slices(batches, limit=SLICE):
                own = [s.tobytes() for s in shingle_sets(batch.column(1), SHINGLE)]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([hashlib.blake2b(s, digest_size=16).digest() for s in own], pa.binary()), pa.array(own, pa.binary())], names=["id", "digest", "tokens"])

        left = self.classes.filter("alive").select(F.col("rep").alias("id"), "digest", "copies", "n")
        few = left.agg(F.count(F.lit(1)).alias("k"), F.sum("n").alias("n")).first()
        hint = F.broadcast if few["k"] <= BROADCAST_MOST else lambda d: d
        self.shards = max(1, (few["n"] or 0) // SHARD)
        own = self.text.join(hint(left.select("id").distinct()), "id", "left_semi").mapInArrow(whole, "id bigint, digest binary, tokens binary")
        own = own.join(hint(left.drop("n")), ["id", "digest"])
        block = F.pmod(F.xxhash64("digest"), F.lit(max(1, (few["n"] or 0) // BLOCK))).cast("long")
        # a row may come twice with the same identifier and text
        self.whole = written(own.groupBy("digest").agg(F.first("id").alias("id"), F.first("copies").alias("copies"), F.first("tokens").alias("tokens")).select(block.alias("block"), "id", "copies", "tokens").repartition("block").sortWithinPartitions("block"), "whole")

    def clusters(self) -> DataFrame:
        """(node, component): documents that could link are in one component."""
        shards = self.shards
        asked = self.whole.select("block", "tokens").mapInArrow(lambda b: _ask(b, shards), _ASK).repartition(min(2 * shards, PARTITIONS_MOST), "shard").sortWithinPartitions("shard")
        answers = asked.mapInArrow(_answer, "block bigint, token binary, times binary")
        docs = self.whole.select("block", "id", "tokens")
        entries = docs.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(lambda d, a: _prefixes(d, a, shards), _ENTRY)
        edges = written(entries.repartition(min(2 * shards, PARTITIONS_MOST), "shard").sortWithinPartitions("shard").mapInArrow(_clusters, "u bigint, v bigint").distinct(), "edges")
        return components(edges.select(F.col("u").alias("a"), F.col("v").alias("b")))

    def links(self, clusters: DataFrame) -> DataFrame:
        """(id, others, root) for each document with links, once for each group where it has some."""
        n = F.expr("octet_length(tokens) div 8")
        # sizes of linked sets differ by a factor of 4/3 at most, so by one class at most
        members = self.whole.join(clusters.select(F.col("node").alias("id"), "component"), "id").withColumn("size", F.floor(F.log(n) / F.log(F.lit(1.34))).cast("int"))
        cells = members.groupBy("component", "size").agg(F.count(F.lit(1)).alias("docs"), F.sum(n).alias("shingles"))
        large = cells.groupBy("component").agg(F.sum("docs").alias("docs"), F.sum("shingles").alias("shingles")).filter((F.col("docs") > GROUP_MOST) | (F.col("shingles") > GROUP_SHINGLES)).select("component")
        k = F.greatest(F.ceil(F.col("docs") / GROUP_MOST), F.ceil(F.col("shingles") / GROUP_SHINGLES)).cast("int")
        cells = written(cells.join(large, "component").select("component", "size", k.alias("k")), "cells")
        step = lambda by: cells.select("component", (F.col("size") + by).alias("size"), F.col("k").alias("below" if by > 0 else "above"))
        cells = cells.join(step(1), ["component", "size"], "left").join(step(-1), ["component", "size"], "left")
        own = F.pmod(F.xxhash64("id"), F.col("k")).cast("int")
        members = members.join(cells, ["component", "size"], "left").withColumn("own", own)
        # a document meets its own cell, the others of its size, and those of the sizes next to it
        groups = f"""CASE WHEN k IS NULL THEN array(struct(component AS c, 0 AS a, 0 AS s, 0 AS b, 0 AS t, false AS second))
            ELSE concat(
              transform(sequence(0, k - 1), j -> struct(component AS c, size AS a, least(own, j) AS s, size AS b, greatest(own, j) AS t, own > j AS second)),
              CASE WHEN above IS NULL THEN array() ELSE transform(sequence(0, above - 1), j -> struct(component AS c, size AS a, own AS s, size + 1 AS b, j AS t, false AS second)) END,
              CASE WHEN below IS NULL THEN array() ELSE transform(sequence(0, below - 1), j -> struct(component AS c, size - 1 AS a, j AS s, size AS b, own AS t, true AS second)) END)
            END"""
        dealt = members.select(F.explode(F.expr(f"CAST({groups} AS array<{_GROUP}>)")).alias("g"), "id", "copies", "tokens")
        key = ["c", "a", "s", "b", "t"]
        dealt = dealt.select("g.*", "id", "copies", "tokens").repartition(*key).sortWithinPartitions(*key)
        return written(dealt.mapInArrow(_search, "id bigint, others bigint, root bigint"), "links")


def link_components(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of df: id_col, n_shingles, component_id (smallest identifier reachable by links), n_links.

    n_links is the number of other rows that a row links with, equal sets among them; every link counts, on both sides.
    Integer identifiers. Texts without words, and null texts, have no shingles and are linked with nothing. Rows that
    share an identifier share a component and are one document to the search, so they share links with other sets; for exact
    counts identifiers are distinct. A null identifier has its own row with a null component. Other columns are ignored;
    an empty df gives no rows.
    """
    join = _Join(df, id_col, text_col)
    rows, classes = join.survey()
    join.sets()
    links = join.links(join.clusters())
    member = rows.filter("n > 0").join(classes.select("digest", "rep"), "digest").select("id", "digest", "n", "rep")
    same_id = member.groupBy("id").agg(F.min("rep").alias("a"), F.max("rep").alias("b")).filter("a < b").select("a", "b")
    parts = components(links.filter("id <> root").select(F.col("id").alias("a"), F.col("root").alias("b")).unionByName(same_id))
    others = links.groupBy(F.col("id").alias("rep")).agg(F.sum("others").alias("others"))
    labels = classes.select("digest", F.col("rep").alias("node"), "copies", "rep").join(parts, "node", "left").join(others, "rep", "left")
    labels = labels.select("digest", F.coalesce("component", "node").alias("component"), (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"))
    with_words = rows.filter("n > 0").join(labels, "digest").select("id", "n", "component", "n_links")
    none = F.lit(0).cast("long")
    without = rows.filter("n = 0").select("id", "n", F.col("id").alias("component"), none.alias("n_links"))
    blank = df.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text")).filter("id IS NULL OR text IS NULL")
    blank = blank.select("id", none.alias("n"), F.col("id").alias("component"), none.alias("n_links"))
    out = with_words.unionByName(without).unionByName(blank)
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"), "n_links")
