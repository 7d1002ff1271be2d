"""Masked pseudo-likelihood: every token is predicted from the tokens on both of its sides.

Tokens are words, hashed into a fixed number of buckets. For a position the network adds an
embedding of each of the two tokens before and after it (one table per place), takes the
hyperbolic tangent, and gives the masked token's probability in two steps: its class, then the
token within its class. The log-probabilities of all tokens of a document add up to its score.

Training is spread: every task runs stochastic gradient descent over its own texts from the
same weights, and the weights of all tasks are averaged by the tokens they saw; then comes the next
round. In a round every position of every document is predicted; a ``stride`` above 1 takes every ``stride``-th
of each document, from another offset each time. Every position of every text is scored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, fields

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.llm.common import slices, stored
from feedloom.llm.shingles import word_hashes

CLASSES, WITHIN, HIDDEN, SIDE = 64, 64, 24, 2
BATCH = 4_096
STRIDE = 1
ROUNDS = 2
RATE = 1.0
TEXT_BYTES = 1 << 20
PIECE = 1 << 14


@dataclass
class Network:
    """Weights: one embedding table per place (the last row stands for no token), class and within-class outputs."""

    tables: np.ndarray
    bias: np.ndarray
    class_out: np.ndarray
    class_bias: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray

    @classmethod
    def start(cls, seed: int = 11) -> Network:
        rng, v = np.random.default_rng(seed), CLASSES * WITHIN
        small = lambda *shape: rng.normal(0, 0.1, shape).astype(np.float32)
        zero = lambda *shape: np.zeros(shape, dtype=np.float32)
        return cls(small(2 * SIDE, v + 1, HIDDEN), zero(HIDDEN), small(HIDDEN, CLASSES), zero(CLASSES), small(CLASSES, HIDDEN, WITHIN), zero(CLASSES, WITHIN))

    def flat(self) -> np.ndarray:
        return np.concatenate([getattr(self, f.name).ravel() for f in fields(self)])

    @classmethod
    def from_flat(cls, values: np.ndarray) -> Network:
        like, at, parts = cls.start(), 0, []
        for f in fields(cls):
            shape = getattr(like, f.name).shape
            size = int(np.prod(shape))
            parts.append(values[at : at + size].reshape(shape).astype(np.float32))
            at += size
        return cls(*parts)


def tokens(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Token ids of all texts in a row, and the tokens of each."""
    hashes, counts = word_hashes(texts)
    return (hashes % np.uint64(CLASSES * WITHIN)).astype(np.int64), counts


def surroundings(ids: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The ids beside each position, [position, place]; beyond a text's ends the id of no token."""
    nothing = CLASSES * WITHIN
    gap = np.repeat(np.arange(len(counts)) * SIDE + SIDE, counts)
    at = np.arange(len(ids)) + gap
    padded = np.full(len(ids) + SIDE * (len(counts) + 1), nothing)
    padded[at] = ids
    return np.stack([padded[at + k] for k in (*range(-SIDE, 0), *range(1, SIDE + 1))], axis=1)


def _softmax(x: np.ndarray, target: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of logits to probabilities, in place, and the log-probability of one column of each."""
    rows = np.arange(len(x))
    least = x.max()  # one for all rows is cheaper; rows far below it are done again, each with its own
    x -= least
    own = x[rows, target]
    ones = np.ones(x.shape[1], dtype=x.dtype)
    far = np.flatnonzero(x.max(axis=1) < -60) if x.min() < -60 else ()
    if len(far):
        shift = x[far].max(axis=1, keepdims=True)
        x[far] -= shift
        own[far] -= shift[:, 0]
    np.exp(x, out=x)
    total = x @ ones
    x /= total[:, None]
    return x, own - np.log(total)


def _sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of the rows from each place in ``first`` to before the next, as differences of running sums."""
    running = np.cumsum(values, axis=0, dtype=np.float64)
    ends = running[np.append(first[1:], len(values)) - 1]
    ends[1:] -= ends[:-1].copy()
    return ends.astype(np.float32)


def _hidden(net: Network, around: np.ndarray) -> np.ndarray:
    total = net.tables[0].take(around[:, 0], axis=0)
    total += net.bias
    for p in range(1, 2 * SIDE):
        total += net.tables[p].take(around[:, p], axis=0)
    return np.tanh(total, out=total)


def _by_class(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """An order of tokens by class (16-bit numbers sort by digits), their classes, and where each class begins."""
    order = np.argsort((ids // WITHIN).astype(np.uint16), kind="stable")
    kind = ids[order] // WITHIN
    return order, kind, np.searchsorted(kind, np.arange(CLASSES + 1))


def log_probabilities(net: Network, ids: np.ndarray, around: np.ndarray) -> np.ndarray:
    """The log-probability of every token given its surroundings."""
    out = np.empty(len(ids), dtype=np.float64)
    for a in range(0, len(ids), BATCH):
        target = ids[a : a + BATCH]
        order, kind, bounds = _by_class(target)
        hidden, inner = _hidden(net, around[a : a + BATCH][order]), target[order] % WITHIN
        _, own = _softmax(hidden @ net.class_out + net.class_bias, kind)
        for k in range(CLASSES):
            i, j = bounds[k], bounds[k + 1]
            if j > i:
                own[i:j] += _softmax(hidden[i:j] @ net.out[k] + net.out_bias[k], inner[i:j])[1]
        out[a + order] = own
    return out


def train_batch(net: Network, ids: np.ndarray, around: np.ndarray, rate: float) -> float:
    """One step of gradient ascent on the mean log-probability; returns that mean."""
    n = len(ids)
    order, kind, bounds = _by_class(ids)
    around, inner, rows = around[order], ids[order] % WITHIN, np.arange(n)
    hidden = _hidden(net, around)
    error, own = _softmax(hidden @ net.class_out + net.class_bias, kind)
    total = float(own.sum())
    np.negative(error, out=error)
    error[rows, kind] += 1
    back = error @ net.class_out.T
    class_step, class_bias_step = hidden.T @ error, error.sum(axis=0)
    for k in range(CLASSES):
        i, j = bounds[k], bounds[k + 1]
        if j > i:
            error, own = _softmax(hidden[i:j] @ net.out[k] + net.out_bias[k], inner[i:j])
            total += float(own.sum())
            np.negative(error, out=error)
            error[rows[: j - i], inner[i:j]] += 1
            back[i:j] += error @ net.out[k].T
            scale = np.float32(rate / max(j - i, 16))
            net.out[k] += scale * (hidden[i:j].T @ error)
            net.out_bias[k] += scale * error.sum(axis=0)
    net.class_out += np.float32(rate / n) * class_step
    net.class_bias += np.float32(rate / n) * class_bias_step
    hidden *= hidden
    back *= np.subtract(1, hidden, out=hidden)
    net.bias += np.float32(rate / n) * back.sum(axis=0)
    for p in range(2 * SIDE):
        by = np.argsort(around[:, p].astype(np.uint16), kind="stable")
        names = around[by, p]
        first = np.flatnonzero(np.concatenate([[True], names[1:] != names[:-1]]))
        times = np.diff(np.append(first, n))
        net.tables[p][names[first]] += (rate / np.sqrt(times * 16.0)).astype(np.float32)[:, None] * _sums(back.take(by, axis=0), first)
    return total / n


def tokenised(docs: DataFrame) -> DataFrame:
    """``docs(doc_id, text)`` as stored rows (doc_id, ids): two bytes a token, so that the passes over the corpus need not read texts again."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "bytes", TEXT_BYTES):
                ids, counts = tokens(batch.column("bytes").to_pylist())
                raw, ends = ids.astype("<u2").tobytes(), (2 * np.cumsum(counts)).tolist()
                each = [raw[e - 2 * n : e] for e, n in zip(ends, counts.tolist())]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(each, pa.binary())], names=["doc_id", "ids"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("bytes"))
    return stored(rows.mapInArrow(run, "doc_id long, ids binary"), "token-ids")


def _ids_of(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    each = batch.column("ids").to_pylist()
    return np.frombuffer(b"".join(each), dtype="<u2").astype(np.int64), np.array([len(x) // 2 for x in each], dtype=np.int64)


def train(docs: DataFrame, rounds: int = ROUNDS, stride: int = STRIDE, rate: float = RATE) -> Network:
    """A network trained on all texts of ``docs(doc_id, text)``, or of ``tokenised`` ones; untrained where there are no tokens."""
    rows, net = docs if docs.columns == ["doc_id", "ids"] else tokenised(docs), Network.start()
    for number in range(rounds):
        begin = net.flat()

        def descend(batches: Iterator[pa.RecordBatch], begin: np.ndarray = begin, number: int = number) -> Iterator[pa.RecordBatch]:
            own, seen, held_ids, held_around, held = Network.from_flat(begin), 0, [], [], 0
            for whole in batches:
                for batch in slices(whole, "ids", TEXT_BYTES):
                    ids, counts = _ids_of(batch)
                    place = np.arange(len(ids)) - np.repeat(np.cumsum(counts) - counts, counts)
                    chosen = np.flatnonzero(place % stride == (number * stride) // max(rounds, 1))
                    held_ids.append(ids[chosen])
                    held_around.append(surroundings(ids, counts)[chosen])
                    held += len(chosen)
                    if held >= BATCH:
                        ids, around = np.concatenate(held_ids), np.concatenate(held_around)
                        full = held - held % BATCH
                        for a in range(0, full, BATCH):
                            train_batch(own, ids[a : a + BATCH], around[a : a + BATCH], rate)
                        seen += full
                        held_ids, held_around, held = [ids[full:]], [around[full:]], held - full
            if held:
                train_batch(own, np.concatenate(held_ids), np.concatenate(held_around), rate)
                seen += held
            if seen:
                flat = own.flat()
                for k, a in enumerate(range(0, len(flat), PIECE)):
                    yield pa.RecordBatch.from_pydict({"piece": [k], "seen": [seen], "values": [flat[a : a + PIECE].tobytes()]})

        def average(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums: dict[int, list] = {}
            for batch in batches:
                for r in batch.to_pylist():
                    held = sums.setdefault(r["piece"], [0, 0.0])
                    held[0] += r["seen"]
                    held[1] = held[1] + r["seen"] * np.frombuffer(r["values"], dtype=np.float32).astype(np.float64)
            for k, (seen, total) in sums.items():
                yield pa.RecordBatch.from_pydict({"piece": [k], "values": [(total / seen).astype(np.float32).tobytes()]})

        schema = "piece long, seen long, values binary"
        means = rows.select("ids").mapInArrow(descend, schema).repartition(len(begin) // PIECE + 1, "piece").mapInArrow(average, "piece long, values binary")
        pieces = sorted(means.collect(), key=lambda r: r["piece"])
        if pieces:
            net = Network.from_flat(np.concatenate([np.frombuffer(r["values"], dtype=np.float32) for r in pieces]))
    return net


def score(docs: DataFrame, net: Network) -> DataFrame:
    """Per row of ``docs(doc_id, text)``, or of ``tokenised`` ones: doc_id, n_tokens, log_likelihood (summed), mean_log_likelihood.

    NULL and empty texts have no tokens, a sum of 0 and no mean. Every row is kept, equal
    texts score alike, an empty table stays empty; other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "ids", TEXT_BYTES):
                ids, counts = _ids_of(batch)
                each = log_probabilities(net, ids, surroundings(ids, counts))
                ends = np.cumsum(counts)
                sums = [float(each[e - n : e].sum()) for e, n in zip(ends.tolist(), counts.tolist())]
                means = [s / n if n else None for s, n in zip(sums, counts.tolist())]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(sums), pa.array(means, pa.float64())], names=["doc_id", "n_tokens", "log_likelihood", "mean_log_likelihood"])

    rows = docs if docs.columns == ["doc_id", "ids"] else tokenised(docs)
    return rows.mapInArrow(run, "doc_id long, n_tokens long, log_likelihood double, mean_log_likelihood double")
