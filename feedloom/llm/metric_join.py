"""Exact join of texts whose word-shingle sets have a Jaccard similarity of at least 0.8.

Distance is one less similarity, a metric. Texts with equal sets are one point. Points
that may be near share a region: a region is made by a shingle that lies early in the sets
of all its points, where the order is a common one, rare shingles first, so that two
linked points always meet in one. How early follows from their sizes: of a set of *n*
shingles at most ``n // 9`` can be missing from a linked set as large or larger, ``n // 5`` from any.

Inside its regions the join is recursive:

* each region takes its most central point as pivot, and every distance to it is computed;
* points within the threshold of the pivot are its cell: all are linked to the pivot, so links
  between them need no test;
* points outside are tested against the rest: the cell's points that the triangle inequality
  lets reach one of them (the boundary) are copied along to the next level;
* at the next level the outside points are the pivots, a batch at a time, and each meets
  only the points in its window, those whose distance to the first pivot differs from its own by
  no more than the threshold and whose sketch (a projection that shortens distances) is near enough,
  until no outside point is left.

No pair of different sets within the threshold is missed; components follow from the
links. The number of distances is the points of a region times its pivots, not its square.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedloom.llm.common import bitmap, slices, slots_set, spare, stored
from feedloom.llm.components import components
from feedloom.llm.shingles import mixed, set_id, shingle_sets

TEXT_BYTES = 1 << 20
#: Sets of more shingles are represented by those with an even hash, up to a margin also whole.
WHOLE = 256
WHOLE_TOO = 320
#: A shingle counts as very common from this share of the rows on; then it comes last in the order.
COMMON_SHARE = 0.001
LOCALLY_COMMON = 8
FLUSH_TOKENS = 1_000_000
BUCKET_TOKENS = 1_000_000
PIVOTS = 64
#: Pairs of an Arrow batch; each carries two sets.
PAIR_ROWS = 64
#: Size of the bitmap of wanted sets.
BITMAP_BITS = 24
#: Slots of the parity sketch of a set.
SKETCH_BITS = 1024
#: Names one task remembers to pass a set on once.
SEEN = 200_000

_SPACE = np.uint64(0x5851F42D4C957F2D)

SHAPES = "doc_id long, text_hash long, n long, node long, common array<long>, times array<long>"
BLOBS = "bucket long, keys binary, at binary, nodes binary, sizes binary, spaces binary, cold binary"
SETS = "node long, shingles binary, sketch array<long>"
PLACES = "node long, space long, key long, df long, n long, cold long, rank long"


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    for whole in batches:
        for batch in slices(whole, "bytes", TEXT_BYTES):
            yield batch, shingle_sets(batch.column("bytes").to_pylist())


def _raw(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), _text_hash().alias("text_hash"), F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("bytes"))


def _text_hash() -> Column:
    return F.xxhash64(F.coalesce(F.col("text"), F.lit("")))


def _shapes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Size and name of each set, and now and then the shingles common among the last sets."""
    kept, size = [], 0

    def counted() -> tuple[list[int], list[int]]:
        values, times = np.unique(np.concatenate(kept), return_counts=True) if kept else (np.empty(0, np.uint64), np.empty(0, np.int64))
        often = times >= LOCALLY_COMMON
        return values[often].view(np.int64).tolist(), times[often].tolist()

    for batch, sets in _texts(batches):
        n = len(sets)
        nodes = [set_id(s) if len(s) else None for s in sets]
        kept += sets
        size += sum(map(len, sets))
        common, times = [None] * n, [None] * n
        if size >= FLUSH_TOKENS and n:
            common[0], times[0] = counted()
            kept, size = [], 0
        yield _batch(SHAPES, batch.column("doc_id"), batch.column("text_hash"), [len(s) for s in sets], nodes, common, times)
    if kept:
        common, times = counted()
        yield _batch(SHAPES, [None], [None], [-1], [None], [common], [times])


_KINDS = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64()), "double": pa.float64()}


def _batch(schema: str, *columns) -> pa.RecordBatch:
    fields = [f.split(" ") for f in schema.split(", ")]
    arrays = [c if isinstance(c, pa.Array) else pa.array(c, _KINDS[k]) for c, (_, k) in zip(columns, fields)]
    return pa.RecordBatch.from_arrays(arrays, names=[f for f, _ in fields])


def _views(shingles: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """The key spaces a set appears in: 0 for whole small sets, 1 for the even half of larger ones."""
    if len(shingles) <= WHOLE_TOO:
        yield 0, mixed(shingles ^ _SPACE)
    if len(shingles) > WHOLE:
        yield 1, shingles[(shingles & np.uint64(1)) == 0]


def _keyed(common: np.ndarray, n_buckets: int):
    """Sets to region keys, cut into buckets by key; very common shingles are left out where a set has enough others.

    A row holds the keys of many sets in one bucket (``at`` says whose each key is), or the
    very common keys that one set cannot do without (``at`` is NULL), sent anywhere.
    Keys of many sets go as byte planes of their steps in ascending order, what belongs to them as byte planes: high planes are nearly constant.
    """
    lasts = {space: np.sort(key) for space, key in ((0, mixed(common ^ _SPACE)), (1, common[(common & np.uint64(1)) == 0]))}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        keys: list[np.ndarray] = []
        views: list[tuple[int, int, int, int]] = []
        late: list[np.ndarray] = []
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            info = np.array(views, dtype="<i8").reshape(-1, 4)
            key, at = np.concatenate(keys), np.repeat(np.arange(len(keys)), [len(k) for k in keys])
            order = np.argsort(key)
            key, at = key[order], at[order]
            bounds = np.searchsorted(_bucket(key, n_buckets), np.arange(n_buckets + 1))
            for b, (a, z) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist())):
                if z > a:
                    used, local = np.unique(at[a:z], return_inverse=True)
                    some = info[used]
                    yield _batch(BLOBS, [b], [_planes(np.diff(key[a:z], prepend=np.uint64(0)), "<u8")], [_planes(local, "<u4")], *[[_planes(some[:, c], "<i8")] for c in range(4)])
            rows = [(view[0] % n_buckets, k.tobytes(), None, *[int(v).to_bytes(8, "little", signed=True) for v in view]) for view, k in zip(views, late) if len(k)]
            if rows:
                yield _batch(BLOBS, *zip(*rows))

        for _, sets in _texts(batches):
            for s in sets:
                node = set_id(s) if len(s) else None
                if node is None or node in seen:
                    continue
                if len(seen) >= SEEN:
                    seen.clear()
                seen.add(node)
                for space, key in _views(s):
                    last = lasts[space]
                    is_last = last[np.minimum(np.searchsorted(last, key), len(last) - 1)] == key if len(last) else np.zeros(len(key), dtype=bool)
                    cold = key[~is_last]
                    keys.append(cold)
                    views.append((node, len(s), space, len(cold)))
                    late.append(np.sort(key[is_last])[: max(0, len(s) // 5 + 1 - len(cold))])
                    size += len(key)
            if size >= FLUSH_TOKENS:
                yield from flush()
                keys, views, late, size = [], [], [], 0
        if keys:
            yield from flush()

    return run


def _planes(values: np.ndarray, kind: str) -> bytes:
    """All lowest bytes, then all second ones, and so on."""
    return np.ascontiguousarray(values, dtype=kind).view(np.uint8).reshape(len(values), -1).T.tobytes()


def _unplaned(planes: bytes, kind: str) -> np.ndarray:
    octets = np.frombuffer(planes, dtype=np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(octets.T).view(kind).reshape(-1)


def _bucket(key: np.ndarray, n_buckets: int) -> np.ndarray:
    """Ranges of keys, numbered in their order."""
    return ((key >> np.uint64(32)) * np.uint64(n_buckets)) >> np.uint64(32)


def _places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of the rows of one bucket after another: the keys that two or more sets hold, per set; very common keys once per set.

    Every task that meets a set sends its very common keys, all to the set's own bucket.
    """
    held: list[dict] = []
    late_bucket, passed = None, set()

    def closed() -> Iterator[pa.RecordBatch]:
        key = np.concatenate([np.cumsum(_unplaned(r["keys"], "<u8"), dtype=np.uint64) for r in held])
        own = {c: np.concatenate([_unplaned(r[c], "<i8")[_unplaned(r["at"], "<u4")] for r in held]) for c in ("nodes", "sizes", "spaces", "cold")}
        order = np.lexsort((own["nodes"], key))
        key, own = key[order], {c: v[order] for c, v in own.items()}
        fresh = np.ones(len(key), dtype=bool)
        fresh[1:] = (key[1:] != key[:-1]) | (own["nodes"][1:] != own["nodes"][:-1])
        key, own = key[fresh], {c: v[fresh] for c, v in own.items()}
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        times = np.diff(np.append(first, len(key)))
        df = np.repeat(times, times)
        two = np.flatnonzero(df >= 2)
        for a in range(0, len(two), 100_000):
            i = two[a : a + 100_000]
            yield _batch(PLACES, own["nodes"][i], own["spaces"][i], key[i].view(np.int64), df[i], own["sizes"][i], own["cold"][i], pa.nulls(len(i), pa.int64()))

    for batch in batches:
        for row in batch.to_pylist():
            if row["at"] is None:
                if row["bucket"] != late_bucket:
                    late_bucket, passed = row["bucket"], set()
                if (row["nodes"], row["spaces"]) in passed:
                    continue
                passed.add((row["nodes"], row["spaces"]))
                key = np.frombuffer(row["keys"], dtype="<i8")
                node, n, space, cold = (np.repeat(np.frombuffer(row[c], dtype="<i8"), len(key)) for c in ("nodes", "sizes", "spaces", "cold"))
                yield _batch(PLACES, node, space, key, pa.nulls(len(key), pa.int64()), n, cold, cold + 1 + np.arange(len(key)))
                continue
            if held and held[0]["bucket"] != row["bucket"]:
                yield from closed()
                held = []
            held.append(row)
    if held:
        yield from closed()


def _incidences(docs: DataFrame, base: DataFrame) -> DataFrame:
    """(node, key, n): the sets of every region that can hold a link."""
    totals = base.where(F.col("n") >= 0).agg(F.count(F.lit(1)).alias("rows"), F.sum("n").alias("shingles")).first()
    counts = base.where(F.col("common").isNotNull()).select(F.explode(F.arrays_zip("common", "times")).alias("c"))
    often = counts.groupBy(F.col("c.common").alias("h")).agg(F.sum("c.times").alias("t")).where(F.col("t") >= F.lit(max(2 * LOCALLY_COMMON, COMMON_SHARE * totals["rows"])))
    # Of these there are at most the mean set size over COMMON_SHARE, whatever the number of rows.
    common = np.array(often.select("h").toArrow().column("h").to_numpy(), dtype=np.int64).view(np.uint64)
    n_buckets = max(1, -(-(totals["shingles"] or 0) // BUCKET_TOKENS))
    blobs = _raw(docs).mapInArrow(_keyed(common, n_buckets), BLOBS)
    places = stored(blobs.repartition(n_buckets, "bucket").sortWithinPartitions("bucket").mapInArrow(_places, PLACES), "region-places")

    of_set = Window.partitionBy("node", "space")
    cold = places.where(F.col("rank").isNull()).withColumn("k", F.row_number().over(of_set.orderBy("df", "key"))).withColumn("all", F.count(F.lit(1)).over(of_set))
    cold = cold.withColumn("rank", F.col("cold") - F.col("all") + F.col("k"))
    early = cold.select("node", "key", "n", "rank").union(places.where(F.col("rank").isNotNull()).select("node", "key", "n", "rank"))
    early = stored(early.where(F.col("rank") <= F.floor(F.col("n") / 5) + 1), "region-early")
    short = F.when(F.col("rank") <= F.floor(F.col("n") / 9) + 1, F.col("n"))
    smallest = early.groupBy("key").agg(F.min(short).alias("least"), F.count(F.lit(1)).alias("size")).where(F.col("least").isNotNull() & (F.col("size") > 1))
    able = early.join(smallest, "key").where(9 * (F.col("n") - F.col("rank") + 1) >= 4 * (F.col("n") + F.col("least")))
    return able.select("key", "node", "n")


def _regions(able: DataFrame) -> DataFrame:
    """One of all regions with equal points: (region, node, n, weight, outside); weight is the regions a point lies in."""
    able = stored(able, "region-points")
    weight = able.groupBy("node").agg(F.count(F.lit(1)).alias("weight"))
    marks = able.groupBy("key").agg(F.count(F.lit(1)).alias("size"), F.bit_xor(F.xxhash64("node")).alias("x"), F.bit_xor(F.xxhash64("node", F.lit(1))).alias("y"))
    once = marks.where(F.col("size") > 1).groupBy("size", "x", "y").agg(F.min("key").alias("key")).select("key")
    return able.join(once, "key", "left_semi").join(weight, "node").select(F.col("key").alias("region"), "node", "n", "weight")


def _sets_of(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, shingles, sketch) of the named sets, from one more pass over the texts; shingles are byte planes of their steps.

    A bitmap of fixed size keeps most other sets in their task; the join decides.
    """
    marked = bitmap(nodes, F.col("node"), BITMAP_BITS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for _, sets in _texts(batches):
            rows = []
            for s in sets:
                node = set_id(s) if len(s) else None
                if node is None or node in seen or not slots_set(marked, np.array([node % (1 << BITMAP_BITS)], dtype=np.uint64))[0]:
                    continue
                if len(seen) >= SEEN:
                    seen.clear()
                seen.add(node)
                rows.append((node, _planes(np.diff(s, prepend=np.uint64(0)), "<u8"), parity_sketch(s)))
            if rows:
                yield _batch(SETS, *zip(*rows))

    found = _raw(docs).mapInArrow(run, SETS).join(nodes, "node", "left_semi")
    return stored(found.groupBy("node").agg(F.first("shingles").alias("shingles"), F.first("sketch").alias("sketch")), "region-sets")


def parity_sketch(shingles: np.ndarray) -> list[int]:
    """Parities of the shingles that fall into each of SKETCH_BITS slots.

    Two sets differ in at least as many shingles as their sketches in bits: the map to sketches
    shortens distances, so what it puts too far apart needs no look at the sets.
    """
    parity = np.bincount((shingles >> np.uint64(20)).astype(np.int64) & (SKETCH_BITS - 1), minlength=SKETCH_BITS) & 1
    return np.packbits(parity.astype(np.uint8)).view("<i8").tolist()


def _apart(a: str, b: str) -> Column:
    """Bits in which two sketches differ."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda n, x: n + x)


def _named(sets: DataFrame, pairs: DataFrame) -> DataFrame:
    """(node, shingles) of the sets that ``pairs(a, b)`` name, and a few others: a bitmap of fixed size keeps the rest in their task."""
    marked = bitmap(pairs.select(F.explode(F.array("a", "b")).alias("node")), F.col("node"), BITMAP_BITS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            slot = batch.column("node").to_numpy().view(np.uint64) & np.uint64((1 << BITMAP_BITS) - 1)
            yield batch.filter(pa.array(slots_set(marked, slot)))

    return sets.select("node", "shingles").mapInArrow(run, "node long, shingles binary")


def _measured(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b, shared, total) for ``pairs(a, b)``: sizes of intersection and union. Pairs are stored first, so that only sets they name are moved."""
    pairs = stored(pairs, "region-pairs")
    sets = _named(sets, pairs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shared, total = [], []
            for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist()):
                x, y = (np.cumsum(_unplaned(z, "<u8"), dtype=np.uint64) for z in (x, y))
                both = len(x) + len(y) - len(np.union1d(x, y)) if len(x) < 1 << 16 else len(np.intersect1d(x, y, assume_unique=True))
                shared.append(both)
                total.append(len(x) + len(y) - both)
            yield _batch("a long, b long, shared long, total long", batch.column("a"), batch.column("b"), shared, total)

    first = sets.select(F.col("node").alias("a"), F.col("shingles").alias("x"))
    second = sets.select(F.col("node").alias("b"), F.col("shingles").alias("y"))
    return pairs.join(first, "a").join(second, "b").select("a", "b", "x", "y").mapInArrow(run, "a long, b long, shared long, total long")


def _near(shared: Column, total: Column, percent: int) -> Column:
    return 100 * shared >= percent * total


def links_between_sets(docs: DataFrame, base: DataFrame, percent: int = 80) -> DataFrame:
    """Links (a, b, shared, total) that connect all linked sets, and every link of each pivot."""
    able = _regions(_incidences(docs, base))
    regions = stored(able, "regions")
    sets = _sets_of(docs, regions.select("node").distinct())
    central = regions.groupBy("region").agg(F.max_by(F.struct("node", "n"), F.struct("weight", "node")).alias("p")).select("region", F.col("p.node").alias("pivot"))
    met = regions.join(central, "region").where(F.col("node") != F.col("pivot"))
    measured = stored(_measured(met.select(F.col("node").alias("a"), F.col("pivot").alias("b")).distinct(), sets), "region-distances", PAIR_ROWS)
    found = [measured]
    radius = 1 - percent / 100
    at = met.join(measured.withColumnsRenamed({"a": "node", "b": "pivot"}), ["node", "pivot"])
    at = at.withColumn("outside", ~_near(F.col("shared"), F.col("total"), percent)).withColumn("away", 1 - F.col("shared") / F.col("total"))
    at = stored(at.select("region", "node", "n", "weight", "outside", "away"), "region-level")
    at = at.join(sets.select("node", "sketch"), "node")
    reach = at.where("outside").groupBy("region").agg(F.min("away").alias("nearest"))
    level = at.join(reach, "region").where(F.col("outside") | (F.col("away") >= F.col("nearest") - radius - 1e-9)).drop("nearest")
    level = stored(level, "region-level")
    while True:
        order = Window.partitionBy("region").orderBy(F.desc("weight"), "node")
        pivots = level.where("outside").withColumn("k", F.row_number().over(order)).where(F.col("k") <= PIVOTS)
        pivots = stored(pivots.select("region", F.col("node").alias("pivot"), F.col("n").alias("pivot_n"), F.col("away").alias("pivot_away"), F.col("sketch").alias("pivot_sketch")), "region-pivots")
        if pivots.isEmpty():
            break
        met = level.join(pivots, "region").where(F.col("node") != F.col("pivot"))
        window = (F.abs(F.col("away") - F.col("pivot_away")) <= radius + 1e-9) & (100 * F.least("n", "pivot_n") >= percent * F.greatest("n", "pivot_n"))
        # Linked sets differ in at most (100 - percent) of (100 + percent) parts of their sizes' sum.
        window = window & ((100 + percent) * _apart("sketch", "pivot_sketch") <= (100 - percent) * (F.col("n") + F.col("pivot_n")))
        pairs = met.where(window).select(F.least("node", "pivot").alias("a"), F.greatest("node", "pivot").alias("b")).distinct()
        found.append(stored(_measured(pairs, sets), "region-distances", PAIR_ROWS))
        rest = level.join(pivots.select("region", F.col("pivot").alias("node")), ["region", "node"], "left_anti")
        open_regions = rest.where("outside").select("region").distinct()
        level = stored(rest.join(open_regions, "region", "left_semi"), "region-level")
    links = found[0]
    for more in found[1:]:
        links = links.union(more)
    return links.where(_near(F.col("shared"), F.col("total"), percent)).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "shared", "total").distinct()


def join(docs: DataFrame, percent: int = 80) -> tuple[DataFrame, DataFrame]:
    """Members and links of the self-join of ``docs(doc_id, text)``.

    * members: doc_id, n_shingles, node (the set's name; NULL for an empty one), component_id:
      the smallest doc_id that links reach, itself included;
    * links: a, b (set names), shared, total: enough links between different sets to connect
      whatever is connected, and all links of every pivot.

    NULL and empty texts, and texts without words, have no set and link with nothing. Every row is kept:
    equal texts, also under one doc_id, are one set. A row without doc_id takes part but gives
    no name; its component is NULL where no other row names it. An empty table gives empty
    tables; other columns are not read.
    """
    members, links = _joined(docs, percent)
    return members.drop("text_hash"), links


def _joined(docs: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """``join``, whose members also have the text_hash that tells rows of one doc_id apart."""
    if percent != 80:
        raise ValueError("places in the regions are derived for 80 percent")
    base = stored(_raw(docs).mapInArrow(_shapes, SHAPES), "shapes")
    links = stored(links_between_sets(docs, base, percent), "links")
    rows = base.where(F.col("n") >= 0).select("doc_id", "text_hash", F.col("n").alias("n_shingles"), "node")
    named = rows.where(F.col("node").isNotNull()).groupBy("node").agg(F.min("doc_id").alias("least"))
    roots = components(links)
    grouped = named.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = grouped.groupBy("root").agg(F.min("least").alias("component_id"))
    component = grouped.join(least, "root").select(F.col("node").alias("_node"), "component_id")
    members = rows.join(component, F.col("node") == F.col("_node"), "left")
    return members.select("doc_id", "text_hash", "n_shingles", "node", F.coalesce("component_id", "doc_id").alias("component_id")), links


def representatives(docs: DataFrame, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` of which each stands for its component: one of each group stays.

    Rows without a set all stay, as do rows without doc_id that no component names; of rows
    that repeat a doc_id (or have none) and a text one stays. A row is judged by its own text, not
    by that of another row with its doc_id.
    """
    members, _ = _joined(docs, percent)
    own_id, own_hash, times, empty = spare(docs, "own_id", "own_hash", "times", "empty")
    kept = members.where(F.col("node").isNull() | F.col("component_id").isNull() | (F.col("doc_id") == F.col("component_id")))
    kept = kept.groupBy(F.col("doc_id").alias(own_id), F.col("text_hash").alias(own_hash)).agg(F.count(F.lit(1)).alias(times), F.max(F.col("node").isNull().cast("int")).alias(empty))
    same = F.col("doc_id").cast("long").eqNullSafe(F.col(own_id)) & (_text_hash() == F.col(own_hash))
    rows = docs.join(kept, same, "inner")
    columns = [F.col(f"`{c}`") for c in docs.columns]
    once = rows.where((F.col(times) == 1) | (F.col(empty) == 1)).select(*columns)
    again = rows.where((F.col(times) > 1) & (F.col(empty) == 0)).dropDuplicates(["doc_id", "text"]).select(*columns)
    return once.union(again)
