"""Nearest neighbours by inner product with randomly rotated one-bit codes.

A vector is centred on the corpus mean, turned by a random rotation, and kept as the sign of
each coordinate: one packed bit a dimension, and two scalars (its length, and the cosine
between it and its code) that correct the bias of the sign code. The inner product of a
query with a code, divided by that cosine, estimates the true one, and its error is bounded
by the query's length and the code's cosine, with a probability that ``confidence`` sets. Vectors whose upper
bound reaches the best ``k`` lower bounds are reranked by the exact product in double precision.

Codes and queries are dealt to blocks of about equal, bounded size; every block of queries meets every
block of codes by its number, and only the best ``k`` of each meeting are shuffled. Every valid row is indexed; nothing is sampled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feedloom.llm.common import stored

#: Rows of a block of codes, and of a block of queries.
BLOCK = 4_096
QUERY_BLOCK = 256
#: Width of the error bound in standard deviations of a random rotation's error.
CONFIDENCE = 3.0
SEED = 7

FOUND = "query_id long, vec_id long, score double"


def rotation(dims: int, seed: int = SEED) -> np.ndarray:
    """A random orthogonal matrix."""
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((dims, dims)))
    return q * np.sign(np.diag(r))


def encode(vectors: np.ndarray, centre: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Packed sign bits, distance from the centre, and the cosine between vector and code."""
    residual = (vectors - centre) @ turn
    length = np.linalg.norm(residual, axis=1)
    unit = residual / np.where(length > 0, length, 1)[:, None]
    cosine = np.abs(unit).sum(axis=1) / np.sqrt(vectors.shape[1])
    return np.packbits(residual > 0, axis=1), length, np.where(length > 0, cosine, 1.0)


def estimate(queries: np.ndarray, codes: np.ndarray, length: np.ndarray, cosine: np.ndarray, centre: np.ndarray, turn: np.ndarray, confidence: float = CONFIDENCE) -> tuple[np.ndarray, np.ndarray]:
    """Estimated inner products [query, code], and the half width of their error bounds.

    The query stays in full precision, so a code's inner product is twice the sum of the
    query's coordinates at set bits less the sum of all.
    """
    dims = len(centre)
    turned = (queries @ turn).astype(np.float32)
    bits = np.unpackbits(codes, axis=1, count=dims).astype(np.float32)
    on_code = (2 * (turned @ bits.T) - turned.sum(axis=1)[:, None]) / np.sqrt(dims)
    guess = (queries @ centre)[:, None] + on_code * (length / cosine)[None, :]
    spread = length * np.sqrt(np.maximum(1 - cosine**2, 0)) / cosine / np.sqrt(max(dims - 1, 1))
    width = confidence * np.linalg.norm(queries, axis=1)[:, None] * spread[None, :]
    return guess, width + 1e-5 * (1 + np.abs(guess))


def exact(query: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Inner products in double precision, each summed alike whatever its row."""
    return (vectors.astype(np.float64) * query.astype(np.float64)).sum(axis=1)


def best_of_block(query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, vectors: np.ndarray, codes: np.ndarray, length: np.ndarray, cosine: np.ndarray, centre: np.ndarray, turn: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The best ``k`` rows of a block for each query, its own row left out, ties to the smaller id."""
    guess, width = estimate(queries, codes, length, cosine, centre, turn)
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for i, (query_id, query) in enumerate(zip(query_ids.tolist(), queries)):
        other = ids != query_id
        low = np.where(other, guess[i] - width[i], -np.inf)
        least = np.partition(low, len(low) - k)[len(low) - k] if len(low) > k else -np.inf
        chosen = np.flatnonzero(other & (guess[i] + width[i] >= least))
        score = exact(query, vectors[chosen])
        order = np.lexsort((ids[chosen], -score))[:k]
        out.append((np.full(len(order), query_id), ids[chosen][order], score[order]))
    return tuple(np.concatenate(c) for c in zip(*out))


def _rows_of(batch: pa.RecordBatch, dims: int) -> tuple[np.ndarray, np.ndarray]:
    ids = batch.column("vec_id").to_numpy()
    return ids, np.array(batch.column("embedding").flatten().to_numpy(zero_copy_only=False), dtype=np.float64).reshape(-1, dims)


def valid_vectors(vectors: DataFrame) -> DataFrame:
    """Rows that take part: not NULL, not empty, not zero, all components finite; once per (id, vector)."""
    x = F.col("embedding").cast("array<double>")
    fine = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf"))) & F.exists(x, lambda v: v != 0)
    return vectors.select(F.col("vec_id").cast("long").alias("vec_id"), x.alias("embedding")).where(F.col("vec_id").isNotNull() & F.coalesce(fine, F.lit(False)))


def nearest(vectors: DataFrame, every: int = 20, k: int = 20, block: int = BLOCK, query_block: int = QUERY_BLOCK) -> DataFrame:
    """The ``k`` rows with the largest inner product for each row whose vec_id ``every`` divides.

    Returns query_id, rank (from 1), vec_id, score. Ties go to the smaller vec_id; fewer
    rows than ``k`` are all returned. Vectors that are NULL, empty, zero, or hold NULL or non-finite
    components take no part, nor do rows without vec_id. A query's own row, that is every row with
    its vec_id, is no candidate of it; rows that repeat a vec_id are one query each vector, and the
    best of them counts. An empty table gives no rows. Vectors must agree in length.
    """
    rows = valid_vectors(vectors)
    size = F.size("embedding")
    shape = rows.agg(F.min(size).alias("least"), F.max(size).alias("most"), F.count(F.lit(1)).alias("n"), F.count_if(F.col("vec_id") % every == 0).alias("asked")).first()
    dims = shape["least"] or 0
    if shape["most"] != shape["least"]:
        raise ValueError("vectors differ in length")
    if not dims:
        return rows.select(F.col("vec_id").alias("query_id"), F.lit(0).alias("rank"), "vec_id", F.lit(0.0).alias("score")).limit(0)
    means = rows.select(F.posexplode("embedding").alias("p", "x")).groupBy("p").agg(F.avg("x").alias("m")).collect()
    centre = np.array([r["m"] for r in sorted(means, key=lambda r: r["p"])])
    turn = rotation(dims)

    n_blocks = max(1, -(-shape["n"] // block))
    n_asked = max(1, -(-shape["asked"] // query_block))

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [_rows_of(batch, dims) for batch in batches if batch.num_rows]
        if parts:
            ids, own = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
            values = (ids, own, *encode(own, centre, turn))
            yield pa.RecordBatch.from_pydict({"block": [TaskContext.get().partitionId()], "n": [len(ids)], **{c: [v.tobytes()] for c, v in zip(("ids", "vectors", "codes", "length", "cosine"), values)}})

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [_rows_of(batch, dims) for batch in batches if batch.num_rows]
        if parts:
            ids, own = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
            yield pa.RecordBatch.from_pydict({"query_ids": [ids.tobytes()], "queries": [own.tobytes()]})

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                ids, queries = np.frombuffer(r["query_ids"], dtype=np.int64), np.frombuffer(r["queries"]).reshape(-1, dims)
                own = np.frombuffer(r["vectors"]).reshape(r["n"], dims)
                codes = np.frombuffer(r["codes"], dtype=np.uint8).reshape(r["n"], -1)
                found = best_of_block(ids, queries, np.frombuffer(r["ids"], dtype=np.int64), own, codes, np.frombuffer(r["length"]), np.frombuffer(r["cosine"]), centre, turn, k)
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in found], names=["query_id", "vec_id", "score"])

    blocks = stored(rows.repartition(n_blocks).mapInArrow(index, "block long, n long, ids binary, vectors binary, codes binary, length binary, cosine binary"), "one-bit-codes")
    queries = rows.where(F.col("vec_id") % every == 0).repartition(n_asked).mapInArrow(ask, "query_ids binary, queries binary")
    each = queries.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_blocks - 1).cast("long"))))
    pairs = each.join(blocks, "block")
    found = pairs.select("query_ids", "queries", "n", "ids", "vectors", "codes", "length", "cosine").mapInArrow(meet, FOUND)
    once = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    ranked = once.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
