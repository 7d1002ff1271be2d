"""Removal of every byte that an earlier copy of a long string covers, over the whole corpus.

Every string of ``length`` bytes is named by the least hash of the short strings in it, so
equal strings have equal names wherever they lie. Runs of positions named by one short string are
segments; a segment holds all its strings in full. Names that occur in a single segment
have no second string and drop out. The others are dealt to shards by name, and each shard
orders the suffixes of its segments by induced sorting (see ``induced``); neighbours that
agree in ``length`` bytes form a class, and all but the earliest of a class are removed. Before it sorts, a shard leaves
out strings that cannot be alike: strings alike have the short string at one place and so share the longer stretch around it.

Copies are combined before they are moved: a text or segment that a task has met before, earlier in
the order, is settled there, and a shard sorts each distinct segment once. A text equal to that of
an earlier document is removed whole without being sorted.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.llm import shingles
from feedloom.llm.common import bitmap, slices, slots_set, stored
from feedloom.llm.induced import MEMORY_ITEMS, common_prefix, suffix_order

LENGTH = 100
#: Bytes of the short strings whose least hash names a long one.
SHORT = 24
TEXT_BYTES = 1 << 20
FLUSH_BYTES = 12 << 20
#: Names of one bucket while they are counted, and bytes of segments of one shard while they are sorted.
BUCKET_NAMES = 1_500_000
SHARD_BYTES = 8 << 20
#: Stretches, of most of a string each, by which a shard tells strings apart before it sorts them; and how often it does.
STRETCHES = 8
NARROWED = 2
#: Rows of an Arrow batch on their way to shards; each holds the segments of one flush.
SHARD_ROWS = 32
#: Size of the bitmap of repeated names: a filter before the shards, which decide.
NAME_BITS = 27
DOC_BITS = 24
#: Texts and segments one task remembers.
SEEN = 200_000

LAST = (1 << 63) - 1
NAMES = "bucket long, names binary"
WORDS = "w long, bits long, n long"
SEGMENTS = "bucket long, ids binary, hashes binary, starts binary, sizes binary, anchors binary, texts binary"
REMOVED = "order_id long, h long, start long, stop long"


def rows_of(docs: DataFrame) -> DataFrame:
    """order_id (NULL ids last), h (a hash of the text, which orders rows of one id), bytes."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("order_id"), F.xxhash64(text).alias("h"), text.cast("binary").alias("bytes"))


def _segments(text: bytes, length: int, short: int = SHORT) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Name, first position, number of positions and place of the short string, from the first position, of every segment of a text of at least ``length`` bytes.

    A segment is a run of strings whose leftmost least short string is the same one, not merely an
    equal one: so no string occurs twice in a segment, also in periodic texts.
    """
    raw = np.frombuffer(text, dtype=np.uint8)
    total = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(shingles._LETTER[raw] * np.multiply.accumulate(np.full(len(raw), shingles._BASE)))])
    back = np.multiply.accumulate(np.full(len(raw) - short + 1, shingles._BASE_INVERSE))
    value = shingles.mixed((total[short:] - total[:-short]) * back)
    least, at = value, np.arange(len(value), dtype=np.int32)
    window = length - short + 1
    for step in [*(1 << k for k in range(window.bit_length() - 1)), window - (1 << (window.bit_length() - 1))]:
        if not step:
            continue
        right = least[step:] < least[:-step]
        least, at = np.where(right, least[step:], least[:-step]), np.where(right, at[step:], at[:-step])
    first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    return least[first], first, np.diff(np.append(first, len(at))), at[first] - first


def _fresh_texts(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[tuple[int, int, bytes]]:
    """Rows long enough to hold a string, without texts this task has met at an earlier place in the order."""
    seen: dict[bytes, tuple[int, int]] = {}
    for whole in batches:
        for batch in slices(whole, "bytes", TEXT_BYTES):
            for order_id, h, text in zip(batch.column("order_id").to_pylist(), batch.column("h").to_pylist(), batch.column("bytes").to_pylist()):
                if len(text) < length:
                    continue
                name = xxhash.xxh3_128_digest(text)
                if name in seen and seen[name] <= (order_id, h):
                    continue
                if len(seen) >= SEEN:
                    seen.clear()
                seen[name] = (order_id, h)
                yield order_id, h, text


def _bucket(names: np.ndarray, n: int) -> np.ndarray:
    return (((shingles.mixed(names) >> np.uint64(32)) * np.uint64(n)) >> np.uint64(32)).astype(np.int64)


def repeated_names(rows: DataFrame, length: int) -> tuple[np.ndarray, int]:
    """A bitmap of the names that occur in two or more segments, and how many segments those are."""
    total = rows.agg(F.sum(F.octet_length("bytes"))).first()[0] or 0
    n_buckets = max(1, -(-total // (BUCKET_NAMES * (length - SHORT) // 2)))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            names = np.concatenate(held)
            bucket = _bucket(names, n_buckets)
            order = np.argsort(bucket, kind="stable")
            names, bounds = names[order], np.searchsorted(bucket[order], np.arange(n_buckets + 1))
            for b in np.flatnonzero(np.diff(bounds)).tolist():
                yield _batch(NAMES, [b], [names[bounds[b] : bounds[b + 1]].tobytes()])

        for _, _, text in _fresh_texts(batches, length):
            held.append(_segments(text, length)[0])
            size += len(held[-1])
            if size >= BUCKET_NAMES:
                yield from flush()
                held, size = [], 0
        if held:
            yield from flush()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[bytes] = []
        number = None

        def closed() -> Iterator[pa.RecordBatch]:
            names, times = np.unique(np.frombuffer(b"".join(held), dtype="<u8"), return_counts=True)
            slots = np.sort(names[times > 1] & np.uint64((1 << NAME_BITS) - 1))
            if len(slots):
                first = np.flatnonzero(np.concatenate([[True], slots[1:] >> np.uint64(6) != slots[:-1] >> np.uint64(6)]))
                bits = np.bitwise_or.reduceat(np.uint64(1) << (slots & np.uint64(63)), first)
                n = np.zeros(len(first), dtype=np.int64)
                n[0] = times[times > 1].sum()
                yield _batch(WORDS, (slots[first] >> np.uint64(6)).view(np.int64), bits.view(np.int64), n)

        for batch in batches:
            for b, names in zip(batch.column("bucket").to_pylist(), batch.column("names").to_pylist()):
                if number is not None and b != number:
                    yield from closed()
                    held = []
                number = b
                held.append(names)
        if held:
            yield from closed()

    counted = rows.mapInArrow(cut, NAMES).repartition(n_buckets, "bucket").sortWithinPartitions("bucket").mapInArrow(count, WORDS)
    words = counted.groupBy("w").agg(F.expr("bit_or(bits)").alias("bits"), F.sum("n").alias("n")).toArrow()
    marked = np.zeros(1 << (NAME_BITS - 6), dtype=np.int64)
    marked[words.column("w").to_numpy()] = words.column("bits").to_numpy()
    return marked.view(np.uint64), int(sum(words.column("n").to_pylist()))


_KINDS = {"long": pa.int64(), "binary": pa.binary(), "string": pa.string()}


def _batch(schema: str, *columns) -> pa.RecordBatch:
    fields = [f.split(" ") for f in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, _KINDS[k]) for c, (_, k) in zip(columns, fields)], names=[f for f, _ in fields])


def _joined(starts: list[int], stops: list[int]) -> list[tuple[int, int]]:
    """Intervals, ascending, with those that touch made one."""
    out: list[tuple[int, int]] = []
    for a, b in zip(starts, stops):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _dealt(marked: np.ndarray, n_shards: int, length: int):
    """Segments with repeated names, dealt to shards; those this task has met earlier in the order are removed at once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[bytes, tuple[int, int, int]] = {}
        held: list[tuple[int, int, int, int, int, int, bytes]] = []
        gone: list[tuple[int, int, int, int]] = []
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            bucket = np.array([s[0] for s in held], dtype=np.int64)
            order = np.argsort(bucket, kind="stable")
            bounds = np.searchsorted(bucket[order], np.arange(n_shards + 1))
            for b in np.flatnonzero(np.diff(bounds)).tolist():
                own = [held[i] for i in order[bounds[b] : bounds[b + 1]].tolist()]
                packed = [np.array([s[k] for s in own], dtype="<i8").tobytes() for k in range(1, 6)]
                yield _batch(SEGMENTS, [b], *[[p] for p in packed], [b"".join(s[6] for s in own)])
            if gone:
                packed = [np.array([g[k] for g in gone], dtype="<i8").tobytes() for k in range(4)]
                yield _batch(SEGMENTS, [gone[0][1] % n_shards], *[[p] for p in packed], [b""], [None])

        for order_id, h, text in _fresh_texts(batches, length):
            names, first, count, anchor = _segments(text, length)
            wanted = np.flatnonzero(slots_set(marked, names & np.uint64((1 << NAME_BITS) - 1)))
            shards = _bucket(names[wanted], n_shards).tolist()
            removed: tuple[list[int], list[int]] = ([], [])
            for b, a, n, m in zip(shards, first[wanted].tolist(), count[wanted].tolist(), anchor[wanted].tolist()):
                segment = text[a : a + n + length - 1]
                name = xxhash.xxh3_128_digest(segment)
                if seen.get(name, (LAST, LAST, LAST)) < (order_id, h, a):
                    removed[0].append(a)
                    removed[1].append(a + len(segment))
                    continue
                if len(seen) >= SEEN:
                    seen.clear()
                seen[name] = (order_id, h, a)
                held.append((b, order_id, h, a, n, m, segment))
                size += len(segment)
            gone += [(order_id, h, a, z) for a, z in _joined(*removed)]
            if size >= FLUSH_BYTES or len(gone) >= 100_000:
                yield from flush()
                held, gone, size = [], [], 0
        if held or gone:
            yield from flush()

    return run


def shard_removals(ids: np.ndarray, hashes: np.ndarray, starts: np.ndarray, sizes: np.ndarray, segments: list[bytes], length: int = LENGTH, memory_items: int = MEMORY_ITEMS) -> tuple[np.ndarray, np.ndarray]:
    """Which positions of distinct segments are removed: (number of the segment, position in its document)."""
    joined = np.frombuffer(b"".join(s + b"\0" for s in segments), dtype=np.uint8)
    lengths = sizes + length - 1
    begins = np.cumsum(lengths + 1) - (lengths + 1)
    text = np.empty(len(joined) + 1, dtype=np.uint16)
    text[:-1] = joined
    text[:-1] += 2
    text[begins + lengths] = 1
    text[-1] = 0
    order = suffix_order(text, length, memory_items)
    owner = np.searchsorted(begins, order, side="right") - 1
    offset = order - begins[owner]
    starting = (offset < sizes[owner]) & (order < len(joined))
    order, owner, offset = order[starting], owner[starting], offset[starting]
    if not len(order):
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    padded = np.concatenate([joined, np.zeros(8, dtype=np.uint8)])
    words = np.zeros(len(joined), dtype=np.uint64)
    for k in range(8):
        words |= padded[k : k + len(joined)].astype(np.uint64) << np.uint64(8 * k)
    alike = np.concatenate([[False], common_prefix(words, order[:-1], order[1:], length)])
    first = np.flatnonzero(~alike)
    place = np.lexsort((hashes, ids))
    rank = np.empty(len(ids), dtype=np.int64)
    rank[place] = np.cumsum(np.concatenate([[0], (ids[place][1:] != ids[place][:-1]) | (hashes[place][1:] != hashes[place][:-1])]))
    position = starts[owner] + offset
    when = (rank[owner] << 40) | position
    count = np.diff(np.append(first, len(order)))
    later = when > np.repeat(np.minimum.reduceat(when, first), count)
    return owner[later], position[later]


class _Distinct:
    """Distinct segments, each at its earliest place; those at later places are gone."""

    def __init__(self) -> None:
        self.known: dict[bytes, int] = {}
        self.places: list[tuple[int, int, int]] = []
        self.sizes: list[int] = []
        self.anchors: list[int] = []

    def add(self, segment: bytes, place: tuple[int, int, int], size: int, anchor: int) -> list[tuple[int, int, int, int]]:
        """What is removed: order_id, h, start and stop, at most one."""
        k = self.known.setdefault(segment, len(self.places))
        if k == len(self.places):
            self.places.append(place)
            self.sizes.append(size)
            self.anchors.append(anchor)
            return []
        if place < self.places[k]:
            place, self.places[k] = self.places[k], place
        return [(*place, place[2] + len(segment))] if place != self.places[k] else []

    def arrays(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        columns = np.array(self.places, dtype=np.int64).reshape(-1, 3).T
        return columns[0], columns[1], columns[2], np.array(self.sizes, dtype=np.int64)

    def narrowed(self, length: int) -> tuple[_Distinct, list[tuple[int, int, int, int]]]:
        """The parts of segments whose strings may occur in another, and what is removed as such a part is met again."""
        out, gone = _Distinct(), []
        segments = list(self.known)
        for k, at, n in zip(*(c.tolist() for c in _met_again(segments, np.array(self.sizes), np.array(self.anchors), length))):
            i, h, a = self.places[k]
            gone += out.add(segments[k][at : at + n + length - 1], (i, h, a + at), n, self.anchors[k] - at)
        return out, gone


def _met_again(segments: list[bytes], sizes: np.ndarray, anchors: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Number of the segment, first position and number of positions of every run of strings that may occur in another segment.

    A string that begins ``d`` bytes before its short string holds the stretch from the least to the most that such strings have in common
    for a range of ``d``; where no other segment has that stretch around its short string, no string of the range occurs there.
    """
    raw = np.frombuffer(b"".join(segments), dtype=np.uint8)
    begins = np.cumsum(sizes + length - 1) - (sizes + length - 1)
    step = (length - SHORT) // STRETCHES + 1
    low, high = anchors - sizes + 1, anchors
    ranges = high // step - low // step + 1
    of = np.repeat(np.arange(len(segments)), ranges)
    number = np.arange(len(of)) - np.repeat(np.cumsum(ranges) - ranges, ranges) + (low // step)[of]
    least, most = number * step, np.minimum(number * step + step - 1, length - SHORT)
    at = (begins + anchors)[of]
    stretch = shingles.mixed(shingles.span_hashes(raw, at - least, at - most + length) + number.astype(np.uint64))
    order = np.argsort(stretch)
    same = stretch[order][1:] == stretch[order][:-1]
    again = np.zeros(len(of), dtype=bool)
    again[order] = np.concatenate([same, [False]]) | np.concatenate([[False], same])
    of, number, least, most = of[again], number[again], np.maximum(least, low[of])[again], np.minimum(most, high[of])[again]
    first = np.flatnonzero(np.concatenate([[True], (of[1:] != of[:-1]) | (number[1:] != number[:-1] + 1)])[: len(of)])
    last = np.append(first[1:], len(of))[: len(first)] - 1
    return of[first], anchors[of[first]] - most[last], most[last] - least[first] + 1


def _sorted_shards(length: int, memory_items: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = _Distinct()
        gone: list[tuple[int, int, int, int]] = []
        number = None

        def closed() -> Iterator[pa.RecordBatch]:
            rest, found = held, gone
            for _ in range(NARROWED):
                if rest.known:
                    rest, more = rest.narrowed(length)
                    found = found + more
            if rest.known:
                arrays = rest.arrays()
                owner, position = shard_removals(*arrays, list(rest.known), length, memory_items)
                order = np.lexsort((position, arrays[1][owner], arrays[0][owner]))
                own_ids, own_hashes, position = arrays[0][owner][order], arrays[1][owner][order], position[order]
                new = np.ones(len(position), dtype=bool)
                new[1:] = (own_ids[1:] != own_ids[:-1]) | (own_hashes[1:] != own_hashes[:-1]) | (position[1:] > position[:-1] + length)
                first = np.flatnonzero(new)
                last = np.append(first[1:], len(position)) - 1
                yield _batch(REMOVED, own_ids[first], own_hashes[first], position[first], (position[last] if len(first) else position) + length)
            if found:
                yield _batch(REMOVED, *zip(*found))

        for batch in batches:
            for row in batch.to_pylist():
                columns = [np.frombuffer(row[c], dtype="<i8").tolist() for c in ("ids", "hashes", "starts", "sizes")]
                if row["texts"] is None:
                    gone += zip(*columns)
                    if len(gone) >= 100_000:
                        yield _batch(REMOVED, *zip(*gone))
                        gone = []
                    continue
                if number is not None and row["bucket"] != number:
                    yield from closed()
                    held, gone = _Distinct(), []
                number, at = row["bucket"], 0
                for i, h, a, n, m in zip(*columns, np.frombuffer(row["anchors"], dtype="<i8").tolist()):
                    segment = row["texts"][at : at + n + length - 1]
                    at += len(segment)
                    gone += held.add(segment, (i, h, a), n, m)
        yield from closed()

    return run


def repeated_spans(docs: DataFrame, length: int = LENGTH, memory_items: int = MEMORY_ITEMS) -> DataFrame:
    """(order_id, h, start, stop): stretches of bytes that earlier strings cover; they may overlap.

    Rows whose whole text occurs earlier may be absent: ``removal`` settles them.
    """
    rows = rows_of(docs)
    marked, n_segments = repeated_names(rows, length)
    mean = length - 1 + (length - SHORT) // 2
    n_shards = max(1, -(-n_segments * mean // SHARD_BYTES))
    dealt = rows.mapInArrow(_dealt(marked, n_shards, length), SEGMENTS).repartition(n_shards, "bucket").sortWithinPartitions("bucket")
    return stored(dealt.mapInArrow(_sorted_shards(length, memory_items), REMOVED).distinct(), "repeated-spans", SHARD_ROWS)


CUT = "order_id long, h long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<start:bigint,stop:bigint>>"


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    spans_type = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
    for whole in batches:
        for batch in slices(whole, "bytes", TEXT_BYTES):
            removed, n, kept, spans = [], [], [], []
            for text, found in zip(batch.column("bytes").to_pylist(), batch.column("found").to_pylist()):
                merged = _joined([f["start"] for f in found], [f["stop"] for f in found])
                digest, at = hashlib.sha256(), 0
                for a, z in merged:
                    digest.update(text[at:a])
                    at = z
                digest.update(text[at:])
                removed.append(sum(z - a for a, z in merged))
                n.append(len(merged))
                kept.append(digest.hexdigest())
                spans.append([{"start": a, "stop": z} for a, z in merged])
            yield pa.RecordBatch.from_arrays(
                [batch.column("order_id"), batch.column("h"), pa.array(removed, pa.int64()), pa.array(n, pa.int64()), pa.array(kept, pa.string()), pa.array(spans, spans_type)],
                names=["order_id", "h", "n_removed", "n_spans", "kept_sha256", "spans"],
            )


def removal(docs: DataFrame, length: int = LENGTH, memory_items: int = MEMORY_ITEMS) -> DataFrame:
    """Per row of ``docs(doc_id, text)``: doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans (bytes, stop exclusive).

    A byte is removed when a string of ``length`` bytes that covers it also starts earlier: in a smaller
    doc_id, or in the same document further left. NULL text is empty; texts shorter than
    ``length`` hold no string and lose nothing. NULL doc_ids come after all others; rows that
    share a doc_id are ordered by a hash of their text, and rows equal in both are one document, so
    they get equal results. Every row is kept, an empty table stays empty, other columns are not read.
    """
    if length <= SHORT:
        raise ValueError(f"length must be above {SHORT}")
    text = F.coalesce(F.col("text"), F.lit(""))
    base = docs.select(F.col("doc_id"), F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("order_id"), F.xxhash64(text).alias("h"), F.octet_length(text).cast("long").alias("n_bytes"), F.sha2(text, 256).alias("sha"))
    base = stored(base, "text-digests")
    firsts = base.groupBy(F.col("sha").alias("_sha")).agg(F.min("order_id").alias("_first"))
    base = base.join(firsts, F.col("sha") == F.col("_sha")).withColumn("copy", (F.col("order_id") > F.col("_first")) & (F.col("n_bytes") >= length))
    spans = repeated_spans(docs, length, memory_items)
    per_row = spans.groupBy("order_id", "h").agg(F.array_sort(F.collect_list(F.struct("start", "stop"))).alias("found"))
    copies = base.where("copy").select("order_id", "h").distinct()
    per_row = stored(per_row.join(copies, ["order_id", "h"], "left_anti"), "spans-by-row")
    marked = bitmap(per_row, F.col("h"), DOC_BITS)

    def touched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            slot = batch.column("h").to_numpy().view(np.uint64) & np.uint64((1 << DOC_BITS) - 1)
            yield batch.filter(pa.array(slots_set(marked, slot)))

    texts = rows_of(docs).mapInArrow(touched, "order_id long, h long, bytes binary").dropDuplicates(["order_id", "h"])
    cut = texts.join(per_row, ["order_id", "h"]).mapInArrow(_cut, CUT)
    rows = base.join(cut, ["order_id", "h"], "left")
    all_of_it = F.array(F.struct(F.lit(0).cast("bigint").alias("start"), F.col("n_bytes").alias("stop")))
    none = F.array().cast("array<struct<start:bigint,stop:bigint>>")

    def either(if_copy, name: str, otherwise):
        return F.when(F.col("copy"), if_copy).otherwise(F.coalesce(F.col(name), otherwise))

    return rows.select(
        "doc_id",
        "n_bytes",
        either(F.col("n_bytes"), "n_removed", F.lit(0).cast("bigint")).alias("n_removed"),
        either(F.lit(1).cast("bigint"), "n_spans", F.lit(0).cast("bigint")).alias("n_spans"),
        either(F.sha2(F.lit(""), 256), "kept_sha256", F.col("sha")).alias("kept_sha256"),
        either(all_of_it, "spans", none).alias("spans"),
    )
