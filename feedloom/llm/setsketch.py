"""Near copies by SetSketch registers: locality-sensitive bands, a joint likelihood, then exact sets.

A text's set of five-word shingles becomes M registers. Register *i* holds the least of one exponential
draw per shingle, on a scale of powers of BASE and truncated to a byte, so registers of parts of a set merge by their maximum.
The draws of a shingle are a Poisson process whose points carry a register each; points after the time by which every
register has surely got one are never made, and where one is empty all the same its text is drawn again, for longer.

* Bands: ROWS registers together are a bucket. Sets in the same bucket of any band meet. At a similarity of 0.85 a
  register agrees with probability 0.857, so a pair meets in no band in 3 cases of 10 million.
* Stars: each bucket's sets are paired with its least set alone, so a bucket of any size gives no more pairs than it has sets.
* Likelihood: registers of a pair that are greater, less and equal are trinomial given both sizes and the
  similarity. A pair goes if the maximum lies below the threshold and is 15 in logarithm more likely than the threshold is.
* Verification: parities of the sets' hashes give a number of elements in which they surely differ, which excludes most
  pairs just below the threshold; what is left is decided on the full sets.
* Rest: only in a bucket that then, without the least set that all have met, still holds more than one component do sets of
  different components meet each other, in blocks of bounded size: those outside its largest component against all. Each takes
  the nearest few that pass; those that have more take 32 times as many, until none has more: links merge components in between,
  so few pairs are ever made.
  Links are lost to none but the bands.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.llm.common import bitmap, slices, slots_set, stored
from feedloom.llm.components import components
from feedloom.llm.shingles import mixed, set_id, shingle_sets

TEXT_BYTES = 1 << 20
BANDS = 24
ROWS = 5
M = BANDS * ROWS
#: Registers count powers of this, from RATE on.
BASE = 1.2
RATE = 20.0
#: Twice this much logarithmic likelihood rejects a pair (a deviation of 5.5 standard errors).
CERTAIN = 15.0
#: With fewer equal registers no pair of similar sizes passes the likelihood; at the threshold 0.857 of them are equal.
HALF = M // 2
#: Slots of a set's parities.
SLOTS = 1024
#: How many of its nearest a set takes in each block at first, and how many times more from round to round.
WIDER = 32
#: Sets of a block of the rest.
BLOCK = 1000
#: Rows of the rest that a task looks at together, more if one cell has more, and pairs it compares at once.
CELL_ROWS = 4000
PAIRS = 50_000
#: Pairs of an Arrow batch that carries two texts each.
PAIR_ROWS = 64
BITMAP_BITS = 24
#: Slots of the bitmap of buckets that more than one set shares.
BUCKET_BITS = 26

_STEP = np.uint64(0x9E3779B97F4A7C15)
_SEED = np.uint64(0x3C6EF372FE94F82A)
#: Registers are surely all set after (ln M + SURE) / n, but for one text in exp(SURE).
SURE = 6.0

SKETCHES = "doc_id long, row long, n long, node long, sketch binary, parity binary, bytes binary"


def least_draws(sets: list[np.ndarray], sure: float = SURE) -> np.ndarray:
    """Per set (of distinct 64-bit hashes, none empty) and register the least draw of its elements."""
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    draws = np.full(len(sets) * M, np.inf)
    if not len(sets):
        return draws.reshape(0, M)
    state = mixed(np.concatenate(sets) ^ _SEED)
    owner = np.repeat(np.arange(len(sets)), sizes)
    until = (np.log(M) + sure) / sizes
    clock = np.zeros(len(state))
    done, chunk = 0, 1
    while len(state):
        points = mixed(state[:, None] + _STEP * np.arange(done + 1, done + 1 + chunk, dtype=np.uint64))
        waits = -np.log(((points >> np.uint64(32)).astype(np.float64) + 1) * 2.0**-32) / M
        times = clock[:, None] + np.cumsum(waits, axis=1)
        soon = times < until[owner][:, None]
        register = ((points & np.uint64(0xFFFFFFFF)) * np.uint64(M)) >> np.uint64(32)
        np.minimum.at(draws, (owner[:, None] * M + register.astype(np.int64))[soon], times[soon])
        on = soon[:, -1]
        state, owner, clock = state[on], owner[on], times[on, -1]
        done, chunk = done + chunk, min(2 * chunk, 256)
    draws = draws.reshape(-1, M)
    for i in np.flatnonzero(np.isinf(draws).any(axis=1)).tolist():
        draws[i] = least_draws([sets[i]], 2 * sure + 6)[0]
    return draws


def registers(sets: list[np.ndarray]) -> np.ndarray:
    """SetSketch registers, a row of M bytes per set."""
    value = np.floor(1 - np.log(least_draws(sets) / RATE) / np.log(BASE))
    return np.clip(value, 0, 255).astype(np.uint8)


def parities(hashes: np.ndarray) -> bytes:
    """Of each of SLOTS slots whether an odd number of elements falls there: sets differ in at least as many elements as these in bits."""
    odd = np.bincount((hashes >> np.uint64(20)).astype(np.int64) & (SLOTS - 1), minlength=SLOTS) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def surely_apart(x: np.ndarray, y: np.ndarray, first: np.ndarray, second: np.ndarray, percent: int) -> np.ndarray:
    """Pairs whose parities exclude that they are ``percent`` similar."""
    differ = np.bitwise_count(x ^ y).sum(axis=1, dtype=np.int64)
    return (100 + percent) * differ > (100 - percent) * (first + second)


def buckets(sketches: np.ndarray) -> np.ndarray:
    """Per sketch the names of its BANDS buckets."""
    rows = np.ascontiguousarray(sketches)
    names = [[xxhash.xxh3_64_intdigest(row[k : k + ROWS], seed=k) for k in range(0, M, ROWS)] for row in map(bytes, rows)]
    return np.array(names, dtype=np.uint64).reshape(len(rows), BANDS).view(np.int64)


def _power(x: np.ndarray) -> np.ndarray:
    """Chance that a register exceeds the other by what is its own part of the union."""
    return -np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / np.log(BASE)


def log_likelihood(j: np.ndarray, more: np.ndarray, less: np.ndarray, first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Of a similarity ``j``, for sets of ``first`` and ``second`` elements with so many greater and lesser registers."""
    u = first / (first + second)
    up, down = _power(u - (1 - u) * j), _power((1 - u) - u * j)
    tiny = 1e-12
    return more * np.log(up + tiny) + less * np.log(down + tiny) + (M - more - less) * np.log(np.maximum(1 - up - down, 0) + tiny)


def estimate(more: np.ndarray, less: np.ndarray, first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """The likeliest similarity: the log-likelihood is concave, so thirds close in on its maximum."""
    first, second = np.asarray(first, dtype=float), np.asarray(second, dtype=float)
    low, high = np.zeros(len(first)), np.minimum(first, second) / np.maximum(first, second)
    for _ in range(40):
        a, b = low + (high - low) / 3, high - (high - low) / 3
        better = log_likelihood(a, more, less, first, second) < log_likelihood(b, more, less, first, second)
        low, high = np.where(better, a, low), np.where(better, high, b)
    return (low + high) / 2


def plausible(more: np.ndarray, less: np.ndarray, first: np.ndarray, second: np.ndarray, percent: int) -> np.ndarray:
    """Pairs whose registers and sizes leave it possible that they are ``percent`` similar."""
    level = percent / 100
    sized = 100 * np.minimum(first, second) >= percent * np.maximum(first, second)
    best = estimate(more, less, first, second)
    at = np.minimum(level, np.minimum(first, second) / np.maximum(first, second))
    worse = log_likelihood(best, more, less, first, second) - log_likelihood(at, more, less, first, second)
    return sized & ((best >= level) | (worse <= CERTAIN))


def _sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in slices(whole, "bytes", TEXT_BYTES):
            sets = shingle_sets(batch.column("bytes").to_pylist())
            some = [i for i, s in enumerate(sets) if len(s)]
            sketches: list[bytes | None] = [None] * len(sets)
            odd = [parities(s) if len(s) else None for s in sets]
            for i, row in zip(some, registers([sets[i] for i in some])):
                sketches[i] = row.tobytes()
            nodes = [set_id(s) if len(s) else None for s in sets]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("row"), pa.array([len(s) for s in sets], pa.int64()), pa.array(nodes, pa.int64()), pa.array(sketches, pa.binary()), pa.array(odd, pa.binary()), batch.column("bytes")],
                names=["doc_id", "row", "n", "node", "sketch", "parity", "bytes"],
            )


def _banded(marked: np.ndarray | None = None):
    """Sketches to (bucket, node); with a bitmap of buckets, those in it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = buckets(_matrix(batch.column("sketch"))).reshape(-1)
            nodes = np.repeat(batch.column("node").to_numpy(), BANDS)
            if marked is not None:
                some = slots_set(marked, names.view(np.uint64) & np.uint64((1 << BUCKET_BITS) - 1))
                names, nodes = names[some], nodes[some]
            yield pa.RecordBatch.from_arrays([pa.array(names), pa.array(nodes)], names=["bucket", "node"])

    return run


def _matrix(values: pa.Array, width: int = M) -> np.ndarray:
    return np.frombuffer(b"".join(values.to_pylist()), dtype=np.uint8).reshape(-1, width)


def _compared(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = _matrix(batch.column("x")), _matrix(batch.column("y"))
            nx, ny = batch.column("nx").to_numpy(), batch.column("ny").to_numpy()
            good = plausible((x > y).sum(axis=1), (x < y).sum(axis=1), nx, ny, percent)
            good &= ~surely_apart(_matrix(batch.column("px"), SLOTS // 8), _matrix(batch.column("py"), SLOTS // 8), nx, ny, percent)
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(pa.array(good)), batch.column("b").filter(pa.array(good))], names=["a", "b"])

    return run


def _likely(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those of ``pairs(a, b)`` that the likelihood and the parities leave."""
    x = sets.select(F.col("node").alias("a"), F.col("n").alias("nx"), F.col("sketch").alias("x"), F.col("parity").alias("px"))
    y = sets.select(F.col("node").alias("b"), F.col("n").alias("ny"), F.col("sketch").alias("y"), F.col("parity").alias("py"))
    sized = 100 * F.least("nx", "ny") >= percent * F.greatest("nx", "ny")
    return pairs.join(x, "a").join(y, "b").where(sized).mapInArrow(_compared(percent), "a long, b long")


def _texts_of(rows: DataFrame, sets: DataFrame, pairs: DataFrame) -> DataFrame:
    """(node, bytes) for the sets that ``pairs`` name: the text of one row each.

    A bitmap of fixed size keeps most other rows in their task; the join decides.
    """
    nodes = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    wanted = stored(sets.select("node", "row").join(nodes, "node", "left_semi"), "sketch-wanted")
    marked = bitmap(wanted, F.col("row"), BITMAP_BITS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            slot = (batch.column("row").to_numpy() % (1 << BITMAP_BITS)).astype(np.uint64)
            yield batch.filter(pa.array(slots_set(marked, slot)))

    near = rows.select("row", "bytes").mapInArrow(run, "row long, bytes binary")
    return near.join(wanted, "row").select("node", "bytes")


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sizes of intersection and union of the sets of two texts; the first text's set is kept while it repeats."""
    name, held = None, np.empty(0, dtype=np.uint64)
    for batch in batches:
        shared, total = [], []
        for a, x, y in zip(*(batch.column(c).to_pylist() for c in ("a", "x", "y"))):
            if a != name:
                name, held = a, shingle_sets([x])[0]
            other = shingle_sets([y])[0]
            both = len(np.intersect1d(held, other, assume_unique=True))
            shared.append(both)
            total.append(len(held) + len(other) - both)
        yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(shared, pa.int64()), pa.array(total, pa.int64())], names=["a", "b", "shared", "total"])


def _verified(rows: DataFrame, sets: DataFrame, pairs: DataFrame, percent: int) -> DataFrame:
    """Those of ``pairs(a, b)`` whose full sets are ``percent`` similar, with shared and total."""
    texts = stored(_texts_of(rows, sets, pairs), "sketch-texts")
    y = texts.select(F.col("node").alias("b"), F.col("bytes").alias("y"))
    x = texts.select(F.col("node").alias("a"), F.col("bytes").alias("x"))
    both = pairs.join(y, "b").join(x, "a").select("a", "b", "x", "y")
    found = stored(both.mapInArrow(_measured, "a long, b long, shared long, total long"), "sketch-measured", PAIR_ROWS)
    return found.where(100 * F.col("shared") >= percent * F.col("total"))


def _grown(roots: DataFrame, found: DataFrame) -> DataFrame:
    """``roots(node, root)`` after further links: only components that these join are worked on."""
    of = lambda c: F.coalesce(F.col(f"{c}_root"), F.col(c)).alias(c)
    ends = found.select("a", "b")
    for c in ("a", "b"):
        ends = ends.join(roots.select(F.col("node").alias(f"{c}_node"), F.col("root").alias(f"{c}_root")), F.col(c) == F.col(f"{c}_node"), "left")
    joined = stored(components(ends.select(of("a"), of("b"))).select(F.col("node").alias("old"), F.col("root").alias("new")), "sketch-joined")
    lone = joined.join(roots, F.col("old") == F.col("node"), "left_anti").select(F.col("old").alias("node"), F.col("new").alias("root"))
    moved = roots.join(joined, F.col("root") == F.col("old"), "left").select("node", F.coalesce("new", "root").alias("root"))
    return stored(moved.union(lone), "sketch-roots")


def _open_rows(met: DataFrame, roots: DataFrame) -> DataFrame:
    """(bucket, node, root, guest, hosts, guests): the sets of the buckets of ``met(bucket, node)`` that hold more than one component.

    Guests are the sets outside the largest component of their bucket; hosts and guests are numbers of blocks.
    """
    rooted = met.join(roots, "node", "left").select("bucket", "node", F.coalesce("root", "node").alias("root"))
    sizes = rooted.groupBy("bucket", "root").agg(F.count(F.lit(1)).alias("size"))
    held = sizes.groupBy("bucket").agg(F.max_by("root", F.struct("size", "root")).alias("largest"), F.sum("size").alias("all"), F.max("size").alias("most"))
    held = held.where(F.col("all") > F.col("most")).select("bucket", "largest", _blocks(F.col("all")).alias("hosts"), _blocks(F.col("all") - F.col("most")).alias("guests"))
    return stored(rooted.join(held, "bucket").select("bucket", "node", "root", (F.col("root") != F.col("largest")).alias("guest"), "hosts", "guests"), "sketch-rest")


def _still_open(open_rows: DataFrame, roots: DataFrame, asking: DataFrame) -> DataFrame:
    """Rows of ``open_rows`` for the next round: guests are those of this round that ``asking(node)`` names, with the hosts of their buckets.

    Of two sets of different components one was a guest from the first round on; where it does not ask, the pair has been made.
    """
    rows = open_rows.select("bucket", "node", "guest").join(roots, "node", "left").join(asking.withColumn("asks", F.lit(True)), "node", "left")
    rows = rows.select("bucket", "node", F.coalesce("root", "node").alias("root"), (F.col("guest") & F.coalesce("asks", F.lit(False))).alias("guest"))
    held = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("all"), F.sum(F.col("guest").cast("int")).alias("asking"), F.min("root").alias("first"), F.max("root").alias("last"))
    held = held.where((F.col("asking") > 0) & (F.col("first") != F.col("last"))).select("bucket", _blocks(F.col("all")).alias("hosts"), _blocks(F.col("asking")).alias("guests"))
    return stored(rows.join(held, "bucket").select("bucket", "node", "root", "guest", "hosts", "guests"), "sketch-rest")


def _blocks(rows: Column) -> Column:
    return F.ceil(rows / BLOCK).cast("int")


def _rest(open_rows: DataFrame, sets: DataFrame, percent: int, most: int) -> DataFrame:
    """Pairs (a, b, more_a, more_b) of sets that share an open bucket but no component: the nearest ``most`` of each guest in each block, and which end is a guest that has more.

    The guests of a bucket meet all its sets, in blocks of about BLOCK x BLOCK. A set's sketch is fetched once for all its buckets.
    """
    places = open_rows.groupBy("node").agg(F.min("root").alias("root"), F.collect_list(F.struct("bucket", "guest", "hosts", "guests")).alias("places"))
    blocks = places.join(sets.select("node", "n", "sketch", "parity"), "node").withColumn("place", F.explode("places")).select("node", "root", "n", "sketch", "parity", "place.*")
    cell = F.pmod(F.xxhash64("node"), F.lit(1 << 30))
    host = blocks.withColumn("h", (cell % F.col("hosts")).cast("int")).withColumn("g", F.explode(F.sequence(F.lit(0), F.col("guests") - 1))).withColumn("guest", F.lit(False))
    guest = blocks.where("guest").withColumn("g", (cell % F.col("guests")).cast("int"))
    guest = guest.withColumn("h", F.explode(F.sequence(F.lit(0), F.col("hosts") - 1)))
    columns = ["bucket", "h", "g", "guest", "node", "root", "n", "sketch", "parity"]
    cells = host.select(*columns).union(guest.select(*columns)).repartition("bucket", "h", "g").sortWithinPartitions("bucket", "h", "g", "guest")
    pairs = cells.mapInArrow(_crossed(percent, most), "a long, b long, more_a boolean, more_b boolean")
    return pairs.groupBy("a", "b").agg(F.max("more_a").alias("more_a"), F.max("more_b").alias("more_b"))


def _crossed(percent: int, most: int):
    """Of each guest of a cell the ``most`` nearest hosts of other components that pass; rows come by cell, hosts first."""

    def met(cells: pa.Table) -> Iterator[pa.RecordBatch]:
        key = np.stack([cells.column(c).to_numpy() for c in ("bucket", "h", "g")])
        first = np.flatnonzero(np.concatenate([[True], (key[:, 1:] != key[:, :-1]).any(axis=0)]))
        cell = np.repeat(np.arange(len(first)), np.diff(np.append(first, key.shape[1])))
        guest = cells.column("guest").to_numpy()
        hosts = np.bincount(cell[~guest], minlength=len(first))
        node, root, n = (cells.column(c).to_numpy() for c in ("node", "root", "n"))
        sketch, parity = _matrix(cells.column("sketch").combine_chunks()), _matrix(cells.column("parity").combine_chunks(), SLOTS // 8)
        at = np.flatnonzero(guest)
        times = hosts[cell[at]]
        done = np.concatenate([[0], np.cumsum(times)])
        near: list[np.ndarray] = []
        for lo in range(0, int(done[-1]), PAIRS):
            k = np.arange(lo, min(lo + PAIRS, int(done[-1])))
            of = np.searchsorted(done, k, side="right") - 1
            x, y = first[cell[at[of]]] + k - done[of], at[of]
            open_pair = (root[x] != root[y]) & (100 * np.minimum(n[x], n[y]) >= percent * np.maximum(n[x], n[y]))
            x, y = x[open_pair], y[open_pair]
            able = ~surely_apart(parity[x], parity[y], n[x], n[y], percent)
            x, y = x[able], y[able]
            more, less = (sketch[x] > sketch[y]).sum(axis=1), (sketch[x] < sketch[y]).sum(axis=1)
            some = more + less <= M - HALF
            x, y, more, less = x[some], y[some], more[some], less[some]
            good = plausible(more, less, n[x], n[y], percent) if len(x) else np.zeros(0, dtype=bool)
            near.append(np.stack([y, more + less, node[x], node[y]])[:, good])
            if sum(p.shape[1] for p in near) > 4 * PAIRS:
                near = [_nearest(np.concatenate(near, axis=1), most + 1)]
        found = _nearest(np.concatenate(near, axis=1), most + 1) if near else np.empty((4, 0), dtype=np.int64)
        if found.shape[1]:
            places = _places(found[0])
            full = np.isin(found[0], found[0][places >= most])
            found, full = found[:, places < most], full[places < most]
            a, b = np.minimum(found[2], found[3]), np.maximum(found[2], found[3])
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (a, b, full & (a == found[3]), full & (b == found[3]))], names=["a", "b", "more_a", "more_b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) >= CELL_ROWS:
                cells = pa.Table.from_batches(held)
                key = np.stack([cells.column(c).to_numpy() for c in ("bucket", "h", "g")])
                last = int(np.argmax((key == key[:, -1:]).all(axis=0)))
                if last:
                    yield from met(cells.slice(0, last))
                    held = cells.slice(last).combine_chunks().to_batches()
        if held and sum(b.num_rows for b in held):
            yield from met(pa.Table.from_batches(held))

    return run


def _nearest(pairs: np.ndarray, most: int) -> np.ndarray:
    """Of columns (guest, distance, host's node, guest's node) the first ``most`` of each guest, by guest."""
    pairs = pairs[:, np.lexsort((pairs[2], pairs[1], pairs[0]))]
    return pairs[:, _places(pairs[0]) < most]


def _places(sorted_keys: np.ndarray) -> np.ndarray:
    """The place of each entry among those of its key."""
    fresh = np.concatenate([[True], sorted_keys[1:] != sorted_keys[:-1]])
    k = np.arange(len(sorted_keys))
    return k - np.maximum.accumulate(np.where(fresh, k, 0)) if len(k) else k


def near_copies(docs: DataFrame, percent: int = 85) -> tuple[DataFrame, DataFrame]:
    """Members and links of the texts of ``docs(doc_id, text)`` that are at least ``percent`` similar.

    * members: doc_id, n_shingles, node (the set's name; NULL for an empty one), component_id (the smallest doc_id
      that links reach, itself included), kept (whether the row's id is that one);
    * links: a, b (set names), shared, total: links between different sets, as many as connect what is connected.

    NULL and empty texts, and texts without words, have no set, link with nothing and are kept. Equal sets are one
    node; every row is returned, repeated ones too. A row without doc_id takes part but names no component: its
    component_id is NULL where no other row names it, and it is not kept unless its text is empty. An empty table gives
    empty tables; other columns are not read. ``percent`` below 80 would need longer sketches and is refused.
    """
    if not 80 <= percent <= 100:
        raise ValueError("the bands are laid out for 80 to 100 percent")
    raw = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.monotonically_increasing_id().alias("row"), F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("bytes"))
    rows = stored(raw.mapInArrow(_sketched, SKETCHES), "sketch-rows")
    named = rows.where(F.col("node").isNotNull()).groupBy("node")
    sets = stored(named.agg(F.min("doc_id").alias("least"), F.min("row").alias("row"), F.min("n").alias("n"), F.min("sketch").alias("sketch"), F.min("parity").alias("parity")), "sketch-sets")

    sketches, schema = sets.select("node", "sketch"), "bucket long, node long"
    each = sketches.mapInArrow(_banded(), schema).groupBy("bucket").agg(F.min("node").alias("center"), F.count(F.lit(1)).alias("size"))
    shared = stored(each.where(F.col("size") > 1).select("bucket", "center"), "sketch-shared")
    banded = sketches.mapInArrow(_banded(bitmap(shared, F.col("bucket"), BUCKET_BITS)), schema)
    met = stored(banded.join(shared, "bucket"), "sketch-buckets")
    stars = met.where(F.col("node") != F.col("center")).select(F.col("center").alias("a"), F.col("node").alias("b")).distinct()
    tested = stored(_likely(stars, sets, percent), "sketch-pairs")
    links = _verified(rows, sets, tested, percent)
    roots = stored(components(links), "sketch-roots")
    open_rows, most = _open_rows(met.where(F.col("node") != F.col("center")).select("bucket", "node"), roots), WIDER
    while not open_rows.isEmpty():
        near = stored(_rest(open_rows, sets, percent, most), "sketch-near")
        fresh = stored(near.select("a", "b").join(tested, ["a", "b"], "left_anti"), "sketch-pairs")
        found = _verified(rows, sets, fresh, percent)
        tested = tested.union(fresh)
        if not found.isEmpty():
            links, roots = links.union(found), _grown(roots, found)
        asking = near.where("more_a").select(F.col("a").alias("node")).union(near.where("more_b").select(F.col("b").alias("node"))).distinct()
        if asking.isEmpty():
            break
        most *= WIDER
        open_rows = _still_open(open_rows, roots, asking)

    grouped = sets.select("node", "least").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = grouped.groupBy("root").agg(F.min("least").alias("component_id"))
    component = grouped.join(least, "root").select(F.col("node").alias("_node"), "component_id")
    members = rows.select("doc_id", F.col("n").alias("n_shingles"), "node").join(component, F.col("node") == F.col("_node"), "left")
    of_row = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    members = members.select("doc_id", "n_shingles", "node", of_row.alias("component_id"))
    return members.withColumn("kept", _kept()), links


def _kept() -> Column:
    return F.col("node").isNull() | F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False))
