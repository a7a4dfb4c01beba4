"""Sets of word shingles as sorted 64-bit hashes, computed on the UTF-8 bytes of a whole Arrow column at a time."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_rng = np.random.default_rng(20240229)
_LETTER = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_LETTER[65:91] = _LETTER[97:123]  # A-Z count as a-z
_BREAK = np.zeros(256, bool)
_BREAK[[32, *range(9, 14)]] = True
_R = 0x9E3779B97F4A7C15
_R_INVERSE = pow(_R, -1, 1 << 64)
_K = np.uint64(0xD6E8FEB86659FD93)
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        for i, base in enumerate((_R, _R_INVERSE)):
            p = np.full(n, base, np.uint64)
            p[0] = 1
            _powers[i] = np.multiply.accumulate(p)
    return _powers[0], _powers[1]


def _mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(32))
    h = h * _K
    return h ^ (h >> np.uint64(29))


def shingle_sets(column: pa.Array, words: int = 5) -> list[np.ndarray]:
    """For each text its distinct shingles' hashes, ascending. Fewer words than `words` make one shingle; null or no words: none."""
    column = column.cast(pa.large_string())
    n = len(column)
    if not n:
        return []
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + n + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    offsets = offsets - offsets[0]
    if not len(raw):
        return [np.zeros(0, np.uint64)] * n
    inside = ~_BREAK[raw]
    border = np.zeros(len(raw) + 1, bool)
    border[offsets] = True
    start = inside.copy()
    start[1:] &= ~inside[:-1] | border[1:-1]
    end = inside.copy()
    end[:-1] &= ~inside[1:] | border[1:-1]
    starts, ends = start.nonzero()[0], end.nonzero()[0] + 1
    power, inverse = _power(len(raw))
    total = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_LETTER[raw] * power[: len(raw)], out=total[1:])
    word = _mixed((total[ends] - total[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))
    at = np.searchsorted(starts, offsets)
    whole = np.zeros(0, np.uint64)
    if len(word) >= words:
        whole = word[: len(word) - words + 1].copy()
        for k in range(1, words):
            whole = _mixed(whole * np.uint64(_R) + word[k : k + len(whole)])
    out = []
    for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        if b - a >= words:
            out.append(np.unique(whole[a : b - words + 1]))
        elif b > a:
            h = word[a : a + 1].copy()
            for k in range(a + 1, b):
                h = _mixed(h * np.uint64(_R) + word[k : k + 1])
            out.append(_mixed(h + np.uint64(b - a)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out
