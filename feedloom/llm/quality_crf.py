"""Document quality from a linear-chain conditional random field over lines.

Each line is labelled good (1) or bad (0). A line's potentials come from its own shape and
from that of the lines beside it; transition potentials tie neighbouring labels. Forward and
backward messages give the probability that a line is good, and the mean of those over the
document, weighted by line length, is mapped by a fitted logistic curve to its score.

The chain is fitted by conditional likelihood on labelled documents, whose lines all carry
the document's label. Only the fit is bounded: by documents and by lines (parameters). Every
text is scored whole, one batch of documents at a time.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.llm.common import labelled_sample, slices, spare

#: Bounds of the fit: labelled documents in the order of a hash of their ids, and their lines.
FIT_DOCUMENTS = 4_000
FIT_LINES = 40_000

_SYMBOLS = re.compile(r"[^\w\s.,;:'\"()?!-]")
_CAPITALS = re.compile(r"[A-ZÀ-ÖØ-Þ]")
_DIGITS = re.compile(r"[0-9]")
_LETTERS = re.compile(r"[^\W\d_]")

#: Cut points of the shape measures below; a measure becomes indicators of the bins they make.
BINS = (
    ("words", (2, 4, 8, 16, 64)),
    ("word_length", (2.5, 3.5, 5, 7, 10)),
    ("letters", (0.5, 0.7, 0.8, 0.9)),
    ("capitals", (0.02, 0.1, 0.3, 0.6)),
    ("digits", (0.01, 0.05, 0.2)),
    ("symbols", (0.005, 0.02, 0.08, 0.2)),
    ("marks", (0.01, 0.04, 0.1)),
    ("distinct", (0.1, 0.3, 0.5, 0.75)),
    ("repeats", (0.02, 0.1, 0.3, 0.6)),
    ("seen", (0.5,)),
    ("ended", (0.5,)),
)
N_SHAPE = sum(len(cuts) + 1 for _, cuts in BINS)
#: Own shape, the shape of the line before and after (zero at the ends), whether there is one, and a constant.
N_FEATURES = 3 * N_SHAPE + 3


def measures(line: str, seen: set[str]) -> tuple[float, ...]:
    """What a line looks like; ``seen`` collects the lines of the document so far."""
    words = line.split()
    n, size = len(words) or 1, len(line) or 1
    key = line.strip()
    again = float(bool(key) and key in seen)
    seen.add(key)
    return (
        len(words),
        sum(map(len, words)) / n,
        len(_LETTERS.findall(line)) / size,
        len(_CAPITALS.findall(line)) / size,
        len(_DIGITS.findall(line)) / size,
        len(_SYMBOLS.findall(line)) / size,
        (line.count("!") + line.count("?")) / size,
        len(set(words)) / n,
        sum(map(str.__eq__, words, words[1:])) / n,
        again,
        float(key[-1:] in ".!?\"'"),
    )


def features(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Feature rows of all lines of all texts, the length of each line, and the lines of each text."""
    rows, lengths, counts = [], [], []
    for text in texts:
        lines, seen = text.split("\n"), set()
        counts.append(len(lines))
        for line in lines:
            rows.append(measures(line, seen))
            lengths.append(len(line) + 1)
    raw, count = np.array(rows, dtype=np.float32), np.array(counts)
    out = np.zeros((len(raw), N_FEATURES), dtype=np.float32)
    at = 0
    for k, (_, cuts) in enumerate(BINS):
        out[np.arange(len(raw)), at + np.searchsorted(cuts, raw[:, k], side="right")] = 1
        at += len(cuts) + 1
    last = np.cumsum(count) - 1
    first = last - count + 1
    before, after = np.ones(len(raw), dtype=bool), np.ones(len(raw), dtype=bool)
    before[first], after[last] = False, False
    shape = out[:, :N_SHAPE]
    out[1:, N_SHAPE : 2 * N_SHAPE] = shape[:-1] * before[1:, None]
    out[:-1, 2 * N_SHAPE : 3 * N_SHAPE] = shape[1:] * after[:-1, None]
    out[:, -3], out[:, -2], out[:, -1] = before, after, 1
    return out, np.array(lengths, dtype=np.float64), count


@dataclass
class Chain:
    """Weights of the good label (the bad label's are zero), and transition potentials [from, to]."""

    weights: np.ndarray
    transitions: np.ndarray
    slope: float = 1.0
    offset: float = 0.0

    def potentials(self, rows: np.ndarray) -> np.ndarray:
        good = rows @ self.weights.astype(rows.dtype)
        return np.stack([np.zeros_like(good), good], axis=1).astype(np.float64)


def _logsum(a: np.ndarray, axis: int) -> np.ndarray:
    top = a.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(a - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def forward_backward(potentials: np.ndarray, counts: np.ndarray, transitions: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Log messages of all chains at once, step by step over those that are long enough.

    Returns the messages forward (own potential included) and backward, and each chain's log partition.
    """
    order = np.argsort(-counts, kind="stable")
    first = (np.cumsum(counts) - counts)[order]
    length = counts[order]
    ahead, back = np.empty_like(potentials), np.zeros_like(potentials)
    going = int(np.count_nonzero(length))
    ahead[first[:going]] = potentials[first[:going]]
    for t in range(1, int(length[0]) if len(length) else 0):
        going = int(np.searchsorted(-length, -t, side="left"))
        at = first[:going] + t
        ahead[at] = potentials[at] + _logsum(ahead[at - 1][:, :, None] + transitions[None], axis=1)
    for t in range(int(length[0]) - 2 if len(length) else -1, -1, -1):
        going = int(np.searchsorted(-length, -(t + 1), side="left"))
        at = first[:going] + t
        back[at] = _logsum(transitions[None] + (potentials[at + 1] + back[at + 1])[:, None, :], axis=2)
    return ahead, back, _logsum(ahead[np.cumsum(counts) - 1], axis=1)


def marginals(chain: Chain, rows: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The probability of each line that it is good."""
    ahead, back, total = forward_backward(chain.potentials(rows), counts, chain.transitions)
    return np.exp(ahead[:, 1] + back[:, 1] - np.repeat(total, counts))


def fit_chain(rows: np.ndarray, counts: np.ndarray, labels: np.ndarray, steps: int = 100, ridge: float = 1e-3, rate: float = 0.1) -> Chain:
    """Maximise the mean conditional log-likelihood of the line labels by Adam on full batches."""
    if not len(counts):
        return Chain(np.zeros(N_FEATURES), np.zeros((2, 2)))
    line_labels = np.repeat(labels, counts)
    inside = np.ones(len(rows), dtype=bool)
    inside[np.cumsum(counts) - counts] = False
    to = np.flatnonzero(inside)
    seen_pairs = np.zeros((2, 2))
    np.add.at(seen_pairs, (line_labels[to - 1], line_labels[to]), 1)
    theta = np.zeros(N_FEATURES + 4)
    mean, square = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, steps + 1):
        chain = Chain(theta[:-4], theta[-4:].reshape(2, 2))
        potentials = chain.potentials(rows)
        ahead, back, total = forward_backward(potentials, counts, chain.transitions)
        each = np.repeat(total, counts)
        good = np.exp(ahead[:, 1] + back[:, 1] - each)
        pairs = np.exp(ahead[to - 1][:, :, None] + chain.transitions[None] + (potentials[to] + back[to])[:, None, :] - each[to, None, None])
        gradient = np.concatenate([rows.T @ (line_labels - good).astype(rows.dtype), (seen_pairs - pairs.sum(axis=0)).ravel()]) / len(rows) - ridge * theta
        mean = 0.9 * mean + 0.1 * gradient
        square = 0.999 * square + 0.001 * gradient**2
        theta = theta + rate * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
    return Chain(theta[:-4], theta[-4:].reshape(2, 2))


def scores(chain: Chain, texts: list[str]) -> np.ndarray:
    """Length-weighted means of the line marginals, mapped to the probability of the good label, one per text."""
    if not texts:
        return np.empty(0)
    rows, lengths, counts = features(texts)
    return 1 / (1 + np.exp(-(chain.slope * _log_odds(chain, rows, lengths, counts) + chain.offset)))


def _log_odds(chain: Chain, rows: np.ndarray, lengths: np.ndarray, counts: np.ndarray) -> np.ndarray:
    first = np.cumsum(counts) - counts
    good = marginals(chain, rows, counts)
    share = np.clip(np.add.reduceat(good * lengths, first) / np.add.reduceat(lengths, first), 1e-6, 1 - 1e-6)
    return np.log(share / (1 - share))


def calibrated(chain: Chain, rows: np.ndarray, lengths: np.ndarray, counts: np.ndarray, labels: np.ndarray, ridge: float = 1e-2) -> Chain:
    """The chain with a logistic map from a document's share of good lines to its label."""
    if not len(counts):
        return chain
    x = np.stack([_log_odds(chain, rows, lengths, counts), np.ones(len(counts))], axis=1)
    at, prior = np.array([1.0, 0.0]), np.array([1.0, 0.0])
    for _ in range(30):
        p = 1 / (1 + np.exp(-x @ at))
        slope = x.T @ (labels - p) - ridge * (at - prior)
        at = at + np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(2), slope)
    return Chain(chain.weights, chain.transitions, max(float(at[0]), 1e-3), float(at[1]))


def fit(docs: DataFrame, labels: DataFrame, documents: int = FIT_DOCUMENTS, lines: int = FIT_LINES) -> Chain:
    """A chain learned from the texts of ``docs(doc_id, text)`` that ``labels(doc_id, label)`` marks.

    Takes the ``documents`` labels first in a hash order of their ids, and of those as many as
    hold ``lines`` lines. NULL ids, labels and texts teach nothing.
    """
    sample = labelled_sample(docs, labels, documents, "crf-sample")
    ids, total = [], 0
    for r in sample.select("o", F.size(F.split("text", "\n", -1)).alias("n")).orderBy("o").collect():
        total += r["n"]
        if total > lines and ids:
            break
        ids.append(r["o"])
    if not ids:
        return fit_chain(np.empty((0, N_FEATURES)), np.empty(0, dtype=int), np.empty(0, dtype=int))
    packed = sample.where(F.col("o") <= ids[-1]).mapInArrow(_packed, "o long, n long, label int, lengths binary, bits binary").collect()
    packed.sort(key=lambda r: (r["o"], r["label"], r["n"], r["lengths"]))
    bits = np.concatenate([np.frombuffer(r["bits"], dtype=np.uint8).reshape(r["n"], -1) for r in packed])
    shapes, labels = np.unpackbits(bits, axis=1, count=N_FEATURES).astype(np.float32), np.array([r["label"] for r in packed])
    lengths, counts = np.concatenate([np.frombuffer(r["lengths"]) for r in packed]), np.array([r["n"] for r in packed])
    return calibrated(fit_chain(shapes, counts, labels), shapes, lengths, counts, labels)


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Features are indicators, so the driver gets them as bits; no text leaves the executors."""
    for whole in batches:
        for batch in slices(whole, "text"):
            rows, lengths, counts = features(batch.column("text").to_pylist())
            ends = np.cumsum(counts).tolist()
            bits = np.packbits(rows.astype(np.uint8), axis=1)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("o"),
                    pa.array(counts, pa.int64()),
                    batch.column("label"),
                    pa.array([lengths[e - n : e].tobytes() for e, n in zip(ends, counts.tolist())], pa.binary()),
                    pa.array([bits[e - n : e].tobytes() for e, n in zip(ends, counts.tolist())], pa.binary()),
                ],
                names=["o", "n", "label", "lengths", "bits"],
            )


def score(docs: DataFrame, chain: Chain, name: str = "score") -> DataFrame:
    """``docs`` with a column ``name``: the quality of each whole text, in 0 to 1.

    NULL text counts as empty, and an empty text is one empty line. Equal texts score alike;
    every row is kept, an empty table stays empty, and a column already called ``name`` is replaced.
    """
    kept = [c for c in docs.columns if c.lower() != name.lower()]
    (whole_text,) = spare(docs, "whole_text")
    rows = docs.select(*[F.col(f"`{c}`") for c in kept], F.coalesce(F.col("text"), F.lit("")).alias(whole_text))
    schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema[:-1]], f"`{name}` double"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, whole_text):
                found = scores(chain, batch.column(whole_text).to_pylist())
                yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], pa.array(found)], names=[*kept, name])

    return rows.mapInArrow(run, schema)
