"""Induced sorting of suffixes with priority queues that may lie on disk.

The order of all suffixes follows from that of the leftmost S-type ones (an S-type suffix is smaller
than its right neighbour, an L-type one larger): a queue hands out suffixes in order, and each
one popped induces its left neighbour, which is pushed with its own first symbol as key. One
ascending pass orders the L-type suffixes, one descending pass the S-type ones. The leftmost
S-type suffixes are ordered by recursion on the string of their names.

A pop takes as many keys at once as can induce nothing among themselves, so the loop runs over
batches of tuples, at every level and for every alphabet. The queue is a stack of sorted
runs that are merged as they grow alike; runs beyond ``memory_items`` are mapped files
in a private, unnamed temporary file, as any task's spill, and vanish with the task.

``depth`` limits the comparison: suffixes alike in their first ``depth`` symbols come out side by side
in any order. A name covers two symbols at least, so recursion ends after log2(depth) levels, or
earlier in a sort by prefix doubling, once a level has so many names that a batch holds few tuples.
"""

from __future__ import annotations

import tempfile

import numpy as np

MEMORY_ITEMS = 8_000_000
#: Fewer positions than this for each symbol end the recursion.
PER_SYMBOL = 64


class ExternalQueue:
    """A stable priority queue of (key, value) pairs, pushed and popped by arrays."""

    def __init__(self, memory_items: int = MEMORY_ITEMS):
        self.memory_items = memory_items
        self.runs: list[list] = []  # keys, values, next item

    def push(self, keys: np.ndarray, values: np.ndarray) -> None:
        if not len(keys):
            return
        order = np.argsort(keys, kind="stable")
        self.runs.append([keys[order], values[order], 0])
        while len(self.runs) > 1 and self._left(-2) <= 2 * self._left(-1):
            self._merge()

    def _left(self, k: int) -> int:
        keys, _, at = self.runs[k]
        return len(keys) - at

    def _merge(self) -> None:
        (k1, v1, a1), (k2, v2, a2) = self.runs[-2:]
        k1, v1, k2, v2 = k1[a1:], v1[a1:], k2[a2:], v2[a2:]
        first = np.arange(len(k1)) + np.searchsorted(k2, k1, side="left")
        second = np.arange(len(k2)) + np.searchsorted(k1, k2, side="right")
        keys, values = self._room(len(k1) + len(k2), k1.dtype), self._room(len(k1) + len(k2), v1.dtype)
        keys[first], keys[second] = k1, k2
        values[first], values[second] = v1, v2
        self.runs[-2:] = [[keys, values, 0]]

    def _room(self, n: int, kind: np.dtype) -> np.ndarray:
        if n <= self.memory_items:
            return np.empty(n, dtype=kind)
        with tempfile.TemporaryFile() as f:
            return np.memmap(f, dtype=kind, mode="w+", shape=(n,))

    def least(self) -> int | None:
        self.runs = [r for r in self.runs if r[2] < len(r[0])]
        return min((int(r[0][r[2]]) for r in self.runs), default=None)

    def below(self, limit: int, take: bool) -> tuple[np.ndarray, np.ndarray]:
        """All pairs with a smaller key in order, equal keys as they were pushed; removed if ``take``."""
        keys, values = [], []
        for r in self.runs:
            to = r[2] + int(np.searchsorted(r[0][r[2] :], limit, side="left"))
            if to > r[2]:
                keys.append(r[0][r[2] : to])
                values.append(r[1][r[2] : to])
                if take:
                    r[2] = to
        if not keys:
            return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
        key, value = np.concatenate(keys), np.concatenate(values)
        if len(keys) > 1:
            order = np.argsort(key, kind="stable")
            key, value = key[order], value[order]
        return key, value


def types(text: np.ndarray) -> np.ndarray:
    """Whether each suffix is S-type; the last symbol is the smallest and stands alone."""
    n = len(text)
    step = np.sign(text[1:].astype(np.int64) - text[:-1].astype(np.int64))
    known = np.where(step != 0, np.arange(n - 1), n)
    following = np.minimum.accumulate(known[::-1])[::-1]
    out = np.ones(n, dtype=bool)
    out[:-1] = np.where(following < n, step[np.minimum(following, n - 2)] > 0, False) if n > 1 else out[:-1]
    if n > 1:
        out[:-1][following >= n] = False
    return out


def _induce(seed_keys: np.ndarray, seeds: np.ndarray, text: np.ndarray, follows, key_of, memory_items: int) -> tuple[np.ndarray, np.ndarray]:
    """Pop seeds and induced positions in the order of their keys; (positions, whether induced)."""
    queue = ExternalQueue(memory_items)
    out, made, at, span = [], [], 0, 2
    while True:
        low = queue.least()
        if at < len(seeds):
            low = int(seed_keys[at]) if low is None else min(low, int(seed_keys[at]))
        if low is None:
            break
        high = low + span
        while True:
            queue_keys, own = queue.below(high, take=False)
            to = at + int(np.searchsorted(seed_keys[at:], high, side="left"))
            # a seed never shares its key with an induced position
            keys, positions = np.concatenate([queue_keys, seed_keys[at:to]]), np.concatenate([own, seeds[at:to]])
            before = positions - 1
            inner = before >= 0
            inner[inner] = follows(before[inner], positions[inner])
            pushed = key_of(text[before[inner]])
            close = pushed[pushed < high]
            if not len(close) or high == low + 1:
                break
            high = max(low + 1, int(close.min()))
            span = max(1, span // 2)
        queue.below(high, take=True)
        induced = np.zeros(len(positions), dtype=bool)
        induced[: len(own)] = True
        order = np.argsort(keys, kind="stable")
        out.append(positions[order])
        made.append(induced[order])
        inner = inner[order]
        before = (out[-1] - 1)[inner]
        queue.push(key_of(text[before]), before)
        at = to
        span = min(span * 2, 1 << 40)
    return np.concatenate(out), np.concatenate(made)


def name_substrings(text: np.ndarray, starts: np.ndarray, depth: int) -> np.ndarray:
    """Ranks of the substrings from each leftmost S-type position to the next, as far as ``depth`` symbols; equal ones share a rank.

    Where one substring ends and another goes on alike, the one that goes on is smaller.
    """
    size = np.minimum(np.append(np.diff(starts) + 1, 1), depth + 1)
    top = int(text.max()) + 1
    bits = max(1, top.bit_length())
    take = max(1, 62 // bits)
    rank = np.zeros(len(starts), dtype=np.int64)
    active, offset = np.arange(len(starts)), 0
    last = len(text) - 1
    while len(active):
        packed = np.zeros(len(active), dtype=np.int64)
        for k in range(take):
            inside = offset + k < size[active]
            packed = (packed << bits) | np.where(inside, text[np.minimum(starts[active] + offset + k, last)], top)
        order = np.lexsort((packed, rank[active]))
        r, p = rank[active][order], packed[order]
        group = np.concatenate([[True], r[1:] != r[:-1]])
        fresh = group | np.concatenate([[True], p[1:] != p[:-1]])
        place = np.arange(len(r))
        group_at = np.maximum.accumulate(np.where(group, place, 0))
        fresh_at = np.maximum.accumulate(np.where(fresh, place, 0))
        rank[active[order]] = r + (fresh_at - group_at)
        count = np.diff(np.append(np.flatnonzero(fresh), len(r)))
        many = np.repeat(count > 1, count)
        offset += take
        left = active[order][many]
        active = left[size[left] > offset]
        if len(active) < len(left):  # those that ended stay ahead of none: ranks are shared only by equals
            shared = rank[left]
            still = np.isin(shared, rank[active])
            active = left[still]
            if not (size[active] > offset).any():
                break
    return rank


def doubled_order(text: np.ndarray, depth: int) -> np.ndarray:
    """The same order by doubling the compared prefix; only what is still tied is sorted again."""
    order = np.argsort(text, kind="stable")
    first = np.concatenate([[True], text[order][1:] != text[order][:-1]])
    rank = np.empty(len(text) + 1, dtype=np.int64)
    rank[-1] = -1
    rank[order] = np.maximum.accumulate(np.where(first, np.arange(len(text)), 0))
    known = 1
    while known < depth:
        count = np.diff(np.append(np.flatnonzero(first), len(order)))
        tied = np.flatnonzero(np.repeat(count > 1, count))
        if not len(tied):
            break
        at = order[tied]
        own, following = rank[at], rank[np.minimum(at + known, len(text))]
        by = np.lexsort((following, own))
        at, own, following = at[by], own[by], following[by]
        order[tied] = at
        group = np.concatenate([[True], own[1:] != own[:-1]])
        fresh = group | np.concatenate([[True], following[1:] != following[:-1]])
        place = np.arange(len(at))
        rank[at] = own + np.maximum.accumulate(np.where(fresh, place, 0)) - np.maximum.accumulate(np.where(group, place, 0))
        first[tied] = fresh
        known *= 2
    return order


def suffix_order(text: np.ndarray, depth: int, memory_items: int = MEMORY_ITEMS, per_symbol: int = PER_SYMBOL) -> np.ndarray:
    """All positions of ``text`` in the order of their suffixes' first ``depth`` symbols at least.

    The last symbol must be 0 and occur nowhere else. Where a symbol has fewer than
    ``per_symbol`` positions on average, batches no longer pay and the recursion ends in a sort.
    """
    n = len(text)
    if depth <= 1 or n < 3 or n < per_symbol * int(text.max()):
        return doubled_order(text, depth)
    small = types(text)
    left_most = np.flatnonzero(small[1:] & ~small[:-1]) + 1
    if not len(left_most):  # only the last suffix is S-type: it stands at n - 1 and is found above unless n is 1
        left_most = np.array([n - 1])
    rank = name_substrings(text, left_most, depth)
    if len(np.unique(rank)) == len(rank):
        seeds = left_most[np.argsort(rank, kind="stable")]
    else:
        names = np.unique(rank, return_inverse=True)[1].astype(np.int64)
        seeds = left_most[suffix_order(names, -(-depth // 2), memory_items, per_symbol)]
    symbols = text.astype(np.int64)
    up, made = _induce(2 * symbols[seeds] + 1, seeds, symbols, lambda p, j: ~small[p], lambda s: 2 * s, memory_items)
    large = up[made][::-1]
    down, _ = _induce(-2 * symbols[large], large, symbols, lambda p, j: small[p], lambda s: -(2 * s + 1), memory_items)
    return np.concatenate([[n - 1], down[::-1]])


def common_prefix(words: np.ndarray, a: np.ndarray, b: np.ndarray, depth: int) -> np.ndarray:
    """Whether the ``depth`` bytes at ``a`` and ``b`` agree; ``words`` holds the eight bytes from each position."""
    alike = np.ones(len(a), dtype=bool)
    rest = np.arange(len(a))
    for offset in [*range(0, depth - 7, 8), max(0, depth - 8)]:
        same = words[a[rest] + offset] == words[b[rest] + offset]
        alike[rest[~same]] = False
        rest = rest[same]
        if not len(rest):
            break
    return alike
