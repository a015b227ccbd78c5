"""Hashes of byte spans and sliding minima over numpy arrays.

A prefix sum of random byte values times falling powers of an odd base, modulo 2**64, gives the hash of any span of a block in
three operations. Two families with their own bases and byte values make hashes of 128 bits.
"""

from __future__ import annotations

import numpy as np

MASK64 = (1 << 64) - 1


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


_families: dict[int, tuple[int, int, np.ndarray]] = {}
_powers_cache: dict[int, np.ndarray] = {}


def _family(seed: int) -> tuple[int, int, np.ndarray]:
    if seed not in _families:
        rng = np.random.default_rng(seed)
        base = int(rng.integers(1 << 62, 1 << 63)) | 5
        _families[seed] = base, pow(base, -1, 1 << 64), rng.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return _families[seed]


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n - 1) modulo 2**64."""
    have = _powers_cache.get(base)
    if have is None or len(have) < n:
        out = np.empty(max(n, 1 << 12), dtype=np.uint64)
        out[0], done = 1, 1
        while done < len(out):
            more = min(done, len(out) - done)
            out[done : done + more] = out[:more] * np.uint64(pow(base, done, 1 << 64))
            done += more
        _powers_cache[base] = have = out
    return have[:n]


class Spans:
    """Hashes of the spans of a block of bytes (or of any uint64 codes)."""

    def __init__(self, data: np.ndarray, seed: int):
        self.base, back, values = _family(seed)
        codes = values[data] if data.dtype == np.uint8 else mix(data + np.uint64(seed))
        self.sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(codes * powers(back, len(data)), out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.sums[end] - self.sums[start]) * powers(self.base, len(self.sums))[start]

    def grams(self, k: int) -> np.ndarray:
        """Hash of every span of length k."""
        n = len(self.sums) - k
        return (self.sums[k:] - self.sums[:n]) * powers(self.base, len(self.sums))[:n]


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """min(x[i : i + w]) for every i."""
    out, have = x, 1
    while have * 2 <= w:
        out = np.minimum(out[:-have], out[have:])
        have *= 2
    return out if have == w else np.minimum(out[: len(x) - w + 1], out[w - have : w - have + len(x) - w + 1])


def ranges(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """All start[i] .. start[i] + length[i] - 1, one after another."""
    total = int(length.sum())
    out = np.ones(total, dtype=np.int64)
    if not total:
        return out
    keep = length > 0
    start, length = start[keep], length[keep]
    at = np.cumsum(length) - length
    out[at] = start
    out[at[1:]] -= start[:-1] + length[:-1] - 1
    return np.cumsum(out)


def merged(group: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Unions of the intervals [start, end) of each group; touching ones join. Sorted by group and start."""
    if not len(start):
        return group, start, end
    order = np.lexsort((start, group))
    group, start, end = group[order], start[order], end[order]
    fresh = np.ones(len(start), dtype=bool)
    # The running maximum of ends restarts at each group: ends are lifted by the group's rank.
    rank = np.cumsum(np.concatenate([[0], (group[1:] != group[:-1]).astype(np.int64)]))
    lift = rank * (int(end.max()) + 1)
    reach = np.maximum.accumulate(end + lift)
    fresh[1:] = start[1:] + lift[1:] > reach[:-1]
    at = np.flatnonzero(fresh)
    last = np.concatenate([at[1:] - 1, [len(start) - 1]])
    return group[at], start[at], reach[last] - lift[at]


def radix_groups(data: np.ndarray, at: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Most-significant-digit radix passes over the strings data[i : i + depth], i in at: digits are 8 bytes, the last one what is left.

    Returns the strings (as places in at) that have an equal, group by group, and the number of each one's group. After each pass the strings
    that stand alone leave; a group whose digits are all equal needs no sorting.
    """
    padded = np.concatenate([data, np.zeros(8, np.uint8)]).astype(np.uint64)
    eight = np.zeros(len(data) + 1, dtype=np.uint64)
    for i in range(8):
        eight = (eight << np.uint64(8)) | padded[i : i + len(eight)]
    live, group = np.arange(len(at)), np.zeros(len(at), dtype=np.int64)
    for d in range(0, depth, 8):
        if not len(live):
            break
        digit = eight[at[live] + d] >> np.uint64(max(0, 64 - 8 * (depth - d)))
        begin = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
        mixed = np.minimum.reduceat(digit, begin) != np.maximum.reduceat(digit, begin)
        some = np.flatnonzero(np.repeat(mixed, np.diff(np.append(begin, len(live)))))
        order = some[np.lexsort((digit[some], group[some]))]
        live[some], digit[some] = live[order], digit[order]
        new = np.concatenate([[True], (group[1:] != group[:-1]) | (digit[1:] != digit[:-1])])
        begin = np.flatnonzero(new)
        many = np.diff(np.append(begin, len(live)))
        keep = np.repeat(many > 1, many)
        live, group = live[keep], np.repeat(np.arange(int((many > 1).sum())), many[many > 1])
    return live, group
