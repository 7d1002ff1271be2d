"""Periodic runs of words inside documents, found by internal pattern matching, and texts without their repeats.

A run is a stretch of words that repeats with a smallest period *q*, at least ``power`` times over,
and that no neighbouring word extends. The words of a batch of documents become one string of
symbols in which no two documents share one. Then, for every power of two *h*:

* the string is cut into dyadic blocks of length *h*. A run with ``h <= q < 2 * h`` holds, within its first
  *h* positions, the start *b* of a block, and the block occurs again at ``b + q``;
* so the block is looked for in the neighbouring window that starts at ``b + h`` and is *h* positions wide. Its
  occurrences anywhere are an interval of the suffix array; a wavelet tree over that array answers range
  successor queries: how many of the interval lie in the window, and which are the first two;
* occurrences in such a window form an arithmetic progression. One or two are candidate periods as they
  are. Three or more lie in a finer run, as does the block; the run sought carries the end of one finer run to
  the end of the other, so the distance of these ends is the only candidate;
* a candidate is extended both ways by longest common extensions over the ranks that sorting left
  behind. Of candidates with one extent the smallest is the period.

The work is near-linear in words: sorting keeps only what still repeats in its document, and each block asks a
fixed number of queries. A document is worked on whole, in the task that read it: no shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.llm.common import slices, spare
from feedloom.llm.shingles import mixed, word_hashes

TEXT_BYTES = 2 << 20
#: The shortest run, in words, and the least length of a run in periods.
LEAST = 6
POWER = 4

RUN = "array<struct<start:bigint,length:bigint,period:bigint>>"
_RUN = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
_SALT = np.uint64(0xD1B54A32D192ED03)


class WaveletTree:
    """Order statistics of ranges of an integer array, for many ranges at once.

    One bit of the values a level, highest first; zeros are moved before ones from level to level, and each
    level keeps the zeros before every place.
    """

    def __init__(self, values: np.ndarray):
        self.bits = max(1, int(values.max()).bit_length()) if len(values) else 1
        self.zeros: list[np.ndarray] = []
        for bit in range(self.bits - 1, -1, -1):
            one = (values >> bit) & 1 == 1
            self.zeros.append(np.concatenate([[0], np.cumsum(~one, dtype=np.int32)]).astype(np.int32))
            values = np.concatenate([values[~one], values[one]])

    def below(self, left: np.ndarray, right: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """How many values of each range [left, right) are less than its bound."""
        size, count = right - left, np.zeros(len(left), dtype=np.int64)
        for bit, zeros in zip(range(self.bits - 1, -1, -1), self.zeros):
            zl, zr = zeros[left].astype(np.int64), zeros[right].astype(np.int64)
            one = (bound >> bit) & 1 == 1
            count += np.where(one, zr - zl, 0)
            left, right = np.where(one, zeros[-1] + left - zl, zl), np.where(one, zeros[-1] + right - zr, zr)
        return np.where(bound >> self.bits > 0, size, count)

    def smallest(self, left: np.ndarray, right: np.ndarray, nth: np.ndarray) -> np.ndarray:
        """The ``nth`` smallest value (from 0) of each range [left, right)."""
        value = np.zeros(len(left), dtype=np.int64)
        for zeros in self.zeros:
            zl, zr = zeros[left].astype(np.int64), zeros[right].astype(np.int64)
            one = nth >= zr - zl
            value = 2 * value + one
            nth = np.where(one, nth - (zr - zl), nth)
            left, right = np.where(one, zeros[-1] + left - zl, zl), np.where(one, zeros[-1] + right - zr, zr)
        return value


def _sorted_blocks(symbols: np.ndarray, top: int) -> tuple[list[np.ndarray], np.ndarray, list[tuple[np.ndarray, np.ndarray, np.ndarray]]]:
    """Ranks of all blocks of 2 ** k symbols for k up to ``top``, the suffixes by their first 2 ** top symbols, and queries.

    Equal ranks mean equal blocks; a block that runs over the end equals no other. The queries of a level are
    the dyadic blocks that occur at least three times, as (start, left, right): their occurrences are the suffixes [left, right).
    """
    n = len(symbols)
    order = np.argsort(symbols, kind="stable")
    same = symbols[order]
    heads = _heads(np.concatenate([[True], same[1:] != same[:-1]]))
    rank = np.full(n + 1, -1, dtype=np.int32)
    rank[order] = heads
    ranks, queries = [rank], []
    slots = np.arange(n)
    for k in range(top + 1):
        first = np.flatnonzero(np.diff(heads, prepend=-1))
        sizes = np.diff(np.append(first, len(heads)))
        if k:
            often = np.repeat(sizes >= 3, sizes) & (order[slots] & ((1 << k) - 1) == 0)
            at = np.flatnonzero(often)
            left = heads[at].astype(np.int64)
            queries.append((order[slots[at]].astype(np.int64), left, left + np.repeat(sizes, sizes)[at]))
        if k == top:
            break
        more = np.repeat(sizes >= 2, sizes)
        slots, heads = slots[more], heads[more]
        after = order[slots] + (1 << k)
        pair = (heads.astype(np.int64) << 32) | (ranks[-1][np.minimum(after, n)].astype(np.int64) + 1)
        by = np.argsort(pair, kind="stable")
        order[slots] = order[slots[by]]
        pair = pair[by]
        heads = slots[_heads(np.concatenate([[True], pair[1:] != pair[:-1]]))].astype(np.int32) if len(pair) else heads
        rank = ranks[-1].copy()
        rank[order[slots]] = heads
        ranks.append(rank)
    return ranks, order, queries


def _heads(fresh: np.ndarray) -> np.ndarray:
    """For each place the last place at or before it that begins a group."""
    return np.maximum.accumulate(np.where(fresh, np.arange(len(fresh), dtype=np.int32), 0))


def _ahead(ranks: list[np.ndarray], x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """How many symbols from ``x`` on equal those from ``y`` on; x < y."""
    out, last = np.zeros(len(x), dtype=np.int64), len(ranks[0]) - 1
    for k in range(len(ranks) - 1, -1, -1):
        at = np.arange(len(x))
        while len(at):
            at = at[ranks[k][np.minimum(x[at] + out[at], last)] == ranks[k][np.minimum(y[at] + out[at], last)]]
            at = at[y[at] + out[at] < last]
            out[at] += 1 << k
            if k < len(ranks) - 1:
                break
    return out


def _behind(ranks: list[np.ndarray], x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """How many symbols before ``x`` equal those before ``y``; x < y."""
    out = np.zeros(len(x), dtype=np.int64)
    for k in range(len(ranks) - 1, -1, -1):
        at = np.arange(len(x))
        while len(at):
            at = at[x[at] - out[at] >= 1 << k]
            at = at[ranks[k][x[at] - out[at] - (1 << k)] == ranks[k][y[at] - out[at] - (1 << k)]]
            out[at] += 1 << k
            if k < len(ranks) - 1:
                break
    return out


def find_runs(symbols: np.ndarray, longest: int | None = None, least: int = LEAST, power: int = POWER) -> np.ndarray:
    """Rows (start, length, period) of all runs of an array, by start, then period.

    ``longest`` bounds the length of any run, as a document's length does where its symbols are its own. Whole rounds of the
    period count for ``power``, which is 4 at least: blocks are placed for that.
    """
    if power < 4:
        raise ValueError("runs of less than four periods may hold no block and its next occurrence")
    n = len(symbols)
    longest = n if longest is None else longest
    if n < least or longest < power:
        return np.empty((0, 3), dtype=np.int64)
    top = max(0, (longest // power).bit_length() - 1)
    ranks, order, queries = _sorted_blocks(symbols, top)
    alike = np.flatnonzero(symbols[1:] == symbols[:-1])
    begins = alike[np.diff(alike, prepend=-2) > 1]  # period 1: blocks of one symbol, windows of one place
    starts, periods = [begins], [np.ones(len(begins), dtype=np.int64)]
    queries = [(1 << k, *q) for k, q in enumerate(queries, 1) if len(q[0])]
    if queries:
        inside = np.zeros(n, dtype=bool)  # suffixes that some query can ask for
        for _, _, left, right in queries:
            edge = np.zeros(n + 1, dtype=np.int32)
            np.add.at(edge, left, 1)
            np.add.at(edge, right, -1)
            inside |= np.cumsum(edge[:-1]) > 0
        place = np.concatenate([[0], np.cumsum(inside)])
        tree = WaveletTree(order[inside].astype(np.int64))
        for h, b, left, right in queries:
            left, right = place[left], place[right]
            begin = tree.below(left, right, b + h)
            times = tree.below(left, right, b + 2 * h) - begin
            for nth in (0, 1):
                at = np.flatnonzero((times > nth) & (times <= 2))
                starts.append(b[at])
                periods.append(tree.smallest(left[at], right[at], begin[at] + nth) - b[at])
            at = np.flatnonzero(times > 2)
            x, first, second = b[at], *(tree.smallest(left[at], right[at], begin[at] + nth) for nth in (0, 1))
            step = second - first
            far = first + _ahead(ranks, first, second) - x - _ahead(ranks, x, x + step)
            fits = (far >= h) & (far < 2 * h)
            starts.append(x[fits])
            periods.append(far[fits])
    b, d = np.concatenate(starts), np.concatenate(periods)
    start = b - _behind(ranks, b, b + d)
    end = b + d + _ahead(ranks, b, b + d)
    long = (end - start >= least) & (end - start >= power * d)
    start, end, d = start[long], end[long], d[long]
    by = np.lexsort((d, end, start))
    start, end, d = start[by], end[by], d[by]
    fresh = np.ones(len(start), dtype=bool)
    fresh[1:] = (start[1:] != start[:-1]) | (end[1:] != end[:-1])
    found = np.stack([start, end - start, d], axis=1)[fresh]
    return found[np.lexsort((found[:, 2], found[:, 0]))]


def runs_of_texts(texts: list[bytes], least: int = LEAST, power: int = POWER) -> list[np.ndarray]:
    """Per text its runs as rows (start, length, period), words numbered from 0."""
    hashes, counts = word_hashes(texts, fold=False)
    ends = np.cumsum(counts)
    document = np.repeat(np.arange(len(texts), dtype=np.uint64), counts)
    found = find_runs(mixed(hashes + document * _SALT), int(counts.max(initial=0)), least, power)
    bounds = np.searchsorted(found[:, 0], np.concatenate([[0], ends]))
    return [found[a:z] - [begin, 0, 0] if z > a else found[:0] for a, z, begin in zip(bounds[:-1], bounds[1:], (ends - counts).tolist())]


def _collapsed(text: bytes, runs: np.ndarray) -> bytes:
    """The words of a text joined by single spaces, without those that repeat what a run's first period says."""
    words = text.split()
    if len(runs):
        edge = np.zeros(len(words) + 1, dtype=np.int64)
        np.add.at(edge, runs[:, 0] + runs[:, 2], 1)
        np.add.at(edge, runs[:, 0] + runs[:, 1], -1)
        words = [words[i] for i in np.flatnonzero(np.cumsum(edge[:-1]) == 0).tolist()]
    return b" ".join(words)


def periodic_runs(docs: DataFrame, least: int = LEAST, power: int = POWER, runs: str = "runs", collapsed: str = "collapsed") -> DataFrame:
    """``docs`` with its texts' runs and the texts without what the runs repeat.

    ``runs`` is an array of (start, length, period) by start, then period, for stretches of at least ``least`` words and ``power``
    periods; ``collapsed`` holds the remaining words joined by one space. Words are runs of anything but ASCII white
    space, told apart by 64-bit hashes, in their case.

    A NULL or empty text has no word, no run and an empty collapsed text. Every row is kept, repeated ones too,
    an empty table stays empty, and columns already called as the new ones are replaced.
    """
    kept = [c for c in docs.columns if c.lower() not in (runs.lower(), collapsed.lower())]
    (raw,) = spare(docs, "raw")
    rows = docs.select(*[F.col(f"`{c}`") for c in kept], F.coalesce(F.col("text"), F.lit("")).cast("binary").alias(raw))
    schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema[:-1]], f"`{runs}` {RUN}", f"`{collapsed}` string"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, raw, TEXT_BYTES):
                texts = batch.column(raw).to_pylist()
                found = runs_of_texts(texts, least, power)
                offsets = np.concatenate([[0], np.cumsum([len(f) for f in found])]).astype(np.int32)
                flat = np.concatenate(found) if found else np.empty((0, 3), dtype=np.int64)
                fields = pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(flat[:, c])) for c in range(3)], fields=list(_RUN.value_type))
                lists = pa.ListArray.from_arrays(pa.array(offsets), fields)
                short = pa.array([_collapsed(t, f) for t, f in zip(texts, found)], pa.binary()).cast(pa.string())
                yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], lists, short], names=[*kept, runs, collapsed])

    return rows.mapInArrow(run, schema)
