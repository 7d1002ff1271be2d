"""Runs and collapsed texts against a plain search by period."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest
from cases import AWKWARD, SMALL

from feedloom.llm.periodic import WaveletTree, find_runs, periodic_runs
from feedloom.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_runs(words, least=6, power=4):
    """All runs: for each period, ascending, the stretches of words that equal the one a period later."""
    found, n = {}, len(words)
    for q in range(1, n // power + 1):
        i = 0
        while i + q < n:
            start = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            if i > start and i + q - start >= max(least, power * q):
                found.setdefault((start, i + q), q)
            i += 1
    return sorted(((s, e - s, q) for (s, e), q in found.items()), key=lambda r: (r[0], r[2]))


def plain_collapse(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def nested(rng, depth):
    """Repeats within repeats, some with a slip."""
    if not depth:
        return [rng.choice("abc")]
    return [w for _ in range(rng.randrange(1, 4)) for w in nested(rng, depth - 1) * rng.choice([1, 1, 2, 4, 5, 7])]


@pytest.mark.parametrize("seed", range(4))
def test_runs_of_nested_repeats(seed):
    rng = random.Random(seed)
    for _ in range(150):
        words = nested(rng, rng.randrange(1, 5))[:500]
        for _ in range(rng.choice([0, 0, 1, 3])):
            words[rng.randrange(len(words))] = rng.choice("abcd")
        got = [tuple(r) for r in find_runs(np.array([ord(w) for w in words], dtype=np.uint64)).tolist()]
        assert got == plain_runs(words)


@pytest.mark.parametrize("least, power", [(1, 4), (9, 5), (6, 7)])
def test_other_bounds(least, power):
    rng = random.Random(9)
    for _ in range(60):
        words = nested(rng, 3)[:300]
        got = [tuple(r) for r in find_runs(np.array([ord(w) for w in words], dtype=np.uint64), least=least, power=power).tolist()]
        assert got == plain_runs(words, least, power)
    with pytest.raises(ValueError):
        find_runs(np.zeros(9, dtype=np.uint64), power=3)


def test_wavelet_tree_answers_ranges():
    rng = np.random.default_rng(1)
    values = rng.integers(0, 1000, 300)
    tree = WaveletTree(values)
    left = rng.integers(0, 300, 200)
    right = left + rng.integers(1, 300, 200) % (301 - left)
    bound = rng.integers(0, 1300, 200)
    expected = [int((values[a:z] < b).sum()) for a, z, b in zip(left, right, bound)]
    assert tree.below(left, right, bound).tolist() == expected
    some = right > left
    nth = (right - left)[some] // 2
    assert tree.smallest(left[some], right[some], nth).tolist() == [int(np.sort(values[a:z])[k]) for a, z, k in zip(left[some], right[some], nth)]


def test_rows_with_their_runs(spark, texts):
    rows = [*AWKWARD, (8, "x " + "so it goes " * 9 + "end"), (9, "Ha ha " * 5), (10, "1 2 3 " * 4 + "1 2"), (11, "a b " * 7)]
    found = periodic_runs(texts(rows)).collect()
    assert len(found) == len(rows)
    assert set(found[0].asDict()) == {"doc_id", "text", "source", "score", "n", "runs", "collapsed"}
    by_text = {r["text"]: r for r in found}
    for _, text in rows:
        words = WORD.findall(text or "")
        runs = plain_runs(words) if len(words) < 1000 else [(0, len(words), 1)]
        assert [tuple(x) for x in by_text[text]["runs"]] == runs
        assert by_text[text]["collapsed"] == plain_collapse(words, runs)
    assert periodic_runs(texts([]).limit(0)).count() == 0
    again = periodic_runs(periodic_runs(texts(rows[-3:])))
    assert again.columns.count("runs") == 1


def test_long_text_takes_bounded_time():
    rng = random.Random(2)
    words = [rng.randrange(5) for _ in range(200_000)] + [1, 2, 3, 4, 5] * 40_000 + [7] * 100_000
    found = [tuple(r) for r in find_runs(np.array(words, dtype=np.uint64)).tolist()]
    assert (400_000, 100_000, 7) not in found and max(n for _, n, _ in found) >= 200_000
    assert any(q == 5 and n >= 200_000 for _, n, q in found) and any(q == 1 and n == 100_000 for _, n, q in found)


def test_query_against_the_contract(spark):
    expected = {}
    for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect():
        words, h = WORD.findall(r["text"] or ""), zlib.crc32(str(r["doc_id"]).encode())
        n, g = len(words), h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        runs = plain_runs(words)
        best = max(runs, key=lambda x: (Fraction(x[1], x[2]), -x[0], -x[2]), default=None)
        sha = [hashlib.sha256(x.encode()).hexdigest() for x in ("".join(f"{s},{k},{q}\n" for s, k, q in runs), plain_collapse(words, runs))]
        expected[r["doc_id"]] = (len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2], *sha)
    got = QUERIES["op12_periodic_runs"](spark, SMALL)
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert {r[0]: tuple(r)[1:] for r in got.collect()} == expected
    assert sum(1 for x in expected.values() if x[0]) > 5
