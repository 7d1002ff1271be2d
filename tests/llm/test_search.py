"""One-bit codes against exact search."""

import numpy as np
import pytest
from cases import SMALL

from feedloom.llm.onebit import encode, estimate, nearest, rotation
from feedloom.llm.queries import QUERIES


def exact_lists(ids, vectors, every, k):
    out = {}
    for i in np.flatnonzero(ids % every == 0):
        score = (vectors * vectors[i]).sum(axis=1)
        other = np.flatnonzero(ids != ids[i])
        order = other[np.lexsort((ids[other], -score[other]))][:k]
        out[int(ids[i])] = list(zip(ids[order].tolist(), score[order].tolist()))
    return out


def lists(rows):
    out = {}
    for r in sorted(rows, key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


def test_recall_on_the_table(spark):
    table = spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()
    ids, vectors = np.array([r["vec_id"] for r in table]), np.array([r["embedding"] for r in table], dtype=np.float64)
    expected, found = exact_lists(ids, vectors, 20, 20), lists(QUERIES["op8_one_bit_codes"](spark, SMALL).collect())
    hits = sum(len({v for v, _ in expected[q]} & {v for v, _ in found[q]}) for q in expected)
    assert hits >= 0.95 * sum(map(len, expected.values()))
    for q, own in found.items():
        truth = dict(zip(ids.tolist(), (vectors * vectors[ids == q][0]).sum(axis=1).tolist()))
        assert all(s == truth[v] for v, s in own)


def test_bounds_hold_for_almost_all_pairs():
    rng = np.random.default_rng(1)
    vectors, queries = rng.normal(size=(2000, 48)), rng.normal(size=(50, 48))
    centre, turn = vectors.mean(axis=0), rotation(48)
    assert np.allclose(turn @ turn.T, np.eye(48))
    guess, width = estimate(queries, *encode(vectors, centre, turn), centre, turn)
    error = np.abs(guess - queries @ vectors.T)
    assert (error <= width).mean() > 0.99 and error.mean() < width.mean()


def test_ties_small_tables_and_invalid_vectors(spark):
    rows = [(i, [1.0, 0.0]) for i in range(30)] + [(40, [0.5, 0.5]), (41, None), (42, [0.0, 0.0]), (43, [float("nan"), 1.0]), (44, [None, 1.0]), (45, [float("inf"), 1.0]), (None, [1.0, 1.0]), (60, [])]
    found = lists(nearest(spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<double>, score string"), block=8, query_block=2).collect())
    assert sorted(found) == [0, 20, 40]
    assert [v for v, _ in found[0]] == list(range(1, 21)) and [v for v, _ in found[20]] == list(range(20))
    few = spark.createDataFrame([(0, [1.0, 2.0]), (1, [2.0, 1.0])], "vec_id long, embedding array<double>")
    assert lists(nearest(few).collect()) == {0: [(1, 4.0)]}
    assert nearest(few.limit(0)).count() == 0
    with pytest.raises(ValueError):
        nearest(spark.createDataFrame([(0, [1.0]), (1, [2.0, 1.0])], "vec_id long, embedding array<double>"))
