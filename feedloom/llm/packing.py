"""Mixture-controlled packing: deficit round-robin over one queue per source.

Every window of ``window`` ids is made of ``window / granule`` slots. Queues are served in
proportion to their weights: queue *s* is due its granule *j* at time ``(j + 1/2) / weight``,
and slots go to granules in the order they fall due. That is deficit round-robin with a
quantum of one granule: after any number of windows the ids a queue has received differ from
its share by less than a granule, and that deficit is carried on. A queue that has run
dry is passed over, so the others share its slots by their weights.

The place of a granule has a closed form: over all queues *t*, count the granules of *t* due
earlier. So no task needs the state of another: deficits cross windows and partitions by
arithmetic alone, in exact integers.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feedloom.llm.common import gathered, slices, stored
from feedloom.llm.tokens import TEXT_BYTES, coder, default_tokenizer

WINDOW = 1024
GRANULE = 128
#: Queues of their own; smaller sources beyond share the last queue, in which they are packed whole as well.
QUEUES = 256
#: Weights are integers of at most this, so that their products with granule numbers are exact.
SCALE = 1 << 20

TOKENS = "doc_id long, source string, part long, local_start long, doc_tokens long, ids binary"
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, source string"


def tokenised(docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """Ids per document, with its place among the documents of its source in its task."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coded, part, sent = coder(tokenizer), TaskContext.get().partitionId(), {}
        for rows in gathered(batches, "text", TEXT_BYTES):
            flat, counts = coded.encode(rows.column("text"))
            flat = np.insert(flat, np.cumsum(counts), end_id).astype("<u4")
            ends = np.cumsum(counts + 1)
            sources, starts = rows.column("source").to_pylist(), []
            for source, n in zip(sources, (counts + 1).tolist()):
                starts.append(sent.get(source, 0))
                sent[source] = starts[-1] + n
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column("doc_id"),
                    rows.column("source"),
                    pa.array([part] * len(starts), pa.int64()),
                    pa.array(starts, pa.int64()),
                    pa.array(counts + 1, pa.int64()),
                    pa.array([_halves(flat[e - n : e]) for e, n in zip(ends.tolist(), (counts + 1).tolist())], pa.binary()),
                ],
                names=["doc_id", "source", "part", "local_start", "doc_tokens", "ids"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), F.col("source").cast("string").alias("source"))
    return rows.mapInArrow(encode, TOKENS)


def _halves(ids: np.ndarray) -> bytes:
    """All low halves, then all high halves: the latter are mostly zero and compress to nothing."""
    return ids.view("<u2").reshape(-1, 2).T.tobytes()


def _joined(halves: bytes) -> memoryview:
    return memoryview(np.ascontiguousarray(np.frombuffer(halves, dtype="<u2").reshape(2, -1).T).view(np.uint8).reshape(-1))


class Schedule:
    """Where each granule of each queue goes: the arrays of at most QUEUES queues."""

    def __init__(self, tokens: list[int], weights: list[int], slots: int, granule: int):
        self.slots, self.granule = slots, granule
        self.tokens = np.array(tokens, dtype=np.int64)
        self.granules = -(-self.tokens // granule)
        self.weights = np.array(weights, dtype=np.int64)
        last = np.maximum(self.granules - 1, 0)
        self.missing = self.granules * granule - self.tokens
        self.last_rank = np.array([self.rank(s, last[s : s + 1])[0] for s in range(len(tokens))], dtype=np.int64)

    def rank(self, queue: int, j: np.ndarray) -> np.ndarray:
        """How many granules of all queues are due before granule ``j`` of ``queue``."""
        due = (2 * j + 1) * np.int64(1)
        rank = np.zeros(len(j), dtype=np.int64)
        own = self.weights[queue]
        for t in range(len(self.weights)):
            # granules i of t with (2i + 1) / weight_t < due / own; equal times go to the smaller queue number
            scaled = due * self.weights[t]
            if t < queue:
                scaled = scaled + 1
            rank += np.clip(((scaled + own - 1) // own) // 2, 0, self.granules[t])
        return rank

    def place(self, queue: int, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The window of each granule, and its first position there: gapless after short granules."""
        rank = self.rank(queue, j)
        window, slot = rank // self.slots, rank % self.slots
        at = slot * self.granule
        for t in np.flatnonzero(self.missing):
            at = at - np.where((self.last_rank[t] // self.slots == window) & (self.last_rank[t] < rank), self.missing[t], 0)
        return window, at


def pack(docs: DataFrame, weights: dict[str, float] | None = None, tokenizer: str | None = None, window: int = WINDOW, granule: int = GRANULE, end_id: int = 0, max_queues: int = QUEUES) -> DataFrame:
    """Pieces of all documents, dealt to windows of ``window`` ids.

    ``weights`` names target shares per source; sources not named weigh as much together as
    their share of the ids; without it every source keeps its share of the corpus throughout.
    Every id lies in one piece. A window is full but where the last granule of a queue or
    the last window is short, so padding is below ``queues * granule + window`` ids in all.

    NULL text is empty and still ends with ``end_id``; NULL source is a queue; NULL or
    repeated doc_ids keep a row each; an empty table gives no rows; other columns are not read.
    """
    if window % granule:
        raise ValueError("granule must divide window")
    tokens = stored(tokenised(docs, tokenizer or default_tokenizer(), end_id), "packing-ids")
    key = F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit(""))
    parts = tokens.withColumn("key", key).groupBy("key", "part").agg(F.sum("doc_tokens").alias("n"))
    named = sorted(f"={s}" for s in weights or {})
    if len(named) >= max_queues:
        raise ValueError(f"at most {max_queues - 1} weights")
    totals = parts.groupBy("key").agg(F.sum("n").alias("n"))
    first = F.when(F.col("key").isin(named), 0).otherwise(1) if named else F.lit(1)
    largest = totals.orderBy(first, F.desc("n"), "key").limit(max_queues - 1).collect()
    names = sorted(r["key"] for r in largest)
    size = {r["key"]: r["n"] for r in largest}
    queue = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for i, k in enumerate(names) for x in (k, i)]), F.col("key")), F.lit(len(names))) if names else F.lit(0)
    based = parts.withColumn("queue", queue).withColumn("base", F.coalesce(F.sum("n").over(Window.partitionBy("queue").orderBy("part", "key").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    rest = totals.agg(F.sum("n")).first()[0] or 0
    counts = [size[k] for k in names] + [rest - sum(size.values())]
    schedule = Schedule(counts, _weights(names, counts, weights), window // granule, granule)
    rows = tokens.withColumn("key", key).join(based.select("key", "part", "queue", "base"), ["key", "part"])
    rows = rows.select("doc_id", "source", "queue", (F.col("base") + F.col("local_start")).alias("at"), "doc_tokens", "ids")
    return rows.mapInArrow(lambda batches: _cut(batches, schedule), PIECES)


def _weights(names: list[str], counts: list[int], weights: dict[str, float] | None) -> list[int]:
    total = max(1, sum(counts))
    given = {f"={k}": float(v) for k, v in (weights or {}).items()}
    if any(v <= 0 for v in given.values()):
        raise ValueError("weights must be positive")
    unnamed = sum(n for k, n in zip([*names, None], counts) if k not in given) / total
    scale = (1 - unnamed) / sum(given.values()) if given else 1.0
    shares = [given[k] * scale if k in given else n / total for k, n in zip([*names, None], counts)]
    return [max(1, round(s * SCALE)) for s in shares]


def _cut(batches: Iterator[pa.RecordBatch], schedule: Schedule) -> Iterator[pa.RecordBatch]:
    granule = schedule.granule
    for whole in batches:
        for batch in slices(whole, "ids"):
            queue = batch.column("queue").to_numpy().astype(np.int64)
            at = batch.column("at").to_numpy().astype(np.int64)
            size = batch.column("doc_tokens").to_numpy().astype(np.int64)
            n = (at + size - 1) // granule - at // granule + 1
            row = np.repeat(np.arange(len(n)), n)
            j = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n) + (at // granule)[row]
            start = np.maximum(j * granule, at[row])
            end = np.minimum((j + 1) * granule, (at + size)[row])
            window, offset = np.empty(len(row), np.int64), np.empty(len(row), np.int64)
            for q in np.unique(queue):
                own = queue[row] == q
                window[own], offset[own] = schedule.place(int(q), j[own])
            offset += start - j * granule
            follows = np.zeros(len(row), dtype=bool)
            follows[1:] = (row[1:] == row[:-1]) & (window[1:] == window[:-1]) & (offset[1:] == (offset + end - start)[:-1])
            head = np.flatnonzero(~follows)
            tail = np.append(head[1:], len(row)) - 1
            row, start, end = row[head], start[head] - at[row[head]], end[tail] - at[row[head]]
            ids = [_joined(x) for x in batch.column("ids").to_pylist()]
            crcs = [zlib.crc32(ids[r][4 * a : 4 * b]) for r, a, b in zip(row.tolist(), start.tolist(), end.tolist())]
            taken = pa.array(row)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(taken),
                    pa.array(start),
                    pa.array(end - start),
                    pa.array(crcs, pa.int64()),
                    pa.array(size[row]),
                    pa.array(window[head]),
                    pa.array(offset[head]),
                    batch.column("source").take(taken),
                ],
                names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "source"],
            )
