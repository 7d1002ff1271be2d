"""SetSketch near copies against all pairs, and the sketch against what it estimates."""

import random
from collections import defaultdict
from itertools import combinations

import numpy as np
import pytest
from cases import AWKWARD, SMALL
from test_joins import edited, plain_set, planted

from feedloom.llm import setsketch
from feedloom.llm.queries import QUERIES


def plain_members(rows, percent=85):
    """doc_id to (set size, component)."""
    members = defaultdict(list)
    for doc_id, text in rows:
        members[plain_set(text)].append(doc_id)
    sets = [s for s in members if s]
    holders, shared = defaultdict(list), defaultdict(int)
    for k, s in enumerate(sets):
        for x in s:
            holders[x].append(k)
    for own in holders.values():
        for pair in combinations(own, 2):
            shared[pair] += 1
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for (a, b), n in shared.items():
        if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
            root[find(a)] = find(b)
    least = {}
    for k, s in enumerate(sets):
        least[find(k)] = min([least.get(find(k), 1 << 62), *[i for i in members[s] if i is not None]])
    out = {i: (len(s), least[find(k)]) for k, s in enumerate(sets) for i in members[s]}
    return out | {i: (0, i) for i in members.get(frozenset(), [])}


def hashes(rng, n):
    return np.unique(rng.integers(0, 2**63, n, dtype=np.uint64))


def test_registers_merge_and_ignore_company():
    rng = np.random.default_rng(4)
    sets = [hashes(rng, n) for n in (1, 2, 7, 60, 500, 20_000)]
    together = setsketch.registers(sets)
    for s, row in zip(sets, together):
        assert (setsketch.registers([s])[0] == row).all()
    union = np.unique(np.concatenate(sets))
    assert (setsketch.registers([union])[0] == together.max(axis=0)).all()


@pytest.mark.parametrize("similarity, ratio", [(0.95, 1.0), (0.85, 0.9), (0.6, 1.0), (0.3, 0.7)])
def test_likelihood_estimates_the_similarity(similarity, ratio):
    rng = np.random.default_rng(7)
    first, second, found, equal = [], [], [], []
    for _ in range(60):
        n = 400
        m = int(n * ratio)
        both = int(similarity * (n + m) / (1 + similarity))
        pool = rng.permutation(hashes(rng, n + m))
        first.append(np.sort(pool[:n]))
        second.append(np.sort(np.concatenate([pool[:both], pool[n : n + m - both]])))
    x, y = setsketch.registers(first), setsketch.registers(second)
    more, less = (x > y).sum(axis=1), (x < y).sum(axis=1)
    sizes = np.array([len(s) for s in first]), np.array([len(s) for s in second])
    found = setsketch.estimate(more, less, *sizes)
    assert abs(found.mean() - similarity) < 0.02
    assert abs(1 - (more + less).mean() / setsketch.M - similarity) < 0.06
    good = setsketch.plausible(more, less, *sizes, 85)
    assert good.all() if similarity >= 0.85 else not good.any() if similarity < 0.5 else True


@pytest.mark.parametrize("seed, block", [(1, 1000), (2, 7), (3, 1000)])
def test_components_of_planted_groups(spark, texts, seed, block, monkeypatch):
    monkeypatch.setattr(setsketch, "BLOCK", block)
    rows = planted(seed)
    members, links = setsketch.near_copies(texts(rows))
    found = members.collect()
    assert len(found) == len(rows)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found} == plain_members(rows)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in found)
    for r in links.collect():
        assert 100 * r["shared"] >= 85 * r["total"]


def test_families_that_almost_link(spark, texts):
    """Two large families in the same buckets, joined by one chain: the rest of the buckets must find it."""
    rng = random.Random(6)
    base = [f"w{i}" for i in range(300)]
    other = base[:270] + [f"z{i}" for i in range(30)]
    rows = [edited(rng, base, rng.randrange(3)) for _ in range(60)] + [edited(rng, other, rng.randrange(3)) for _ in range(60)]
    for k in (282, 276):
        rows.append(" ".join(base[:k] + [f"z{i}" for i in range(k - 270, 30)]))
    apart = list(enumerate(rows[:-2]))
    expected = plain_members(apart)
    members, _ = setsketch.near_copies(texts(apart))
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in members.collect()} == expected
    chained = list(enumerate(rows))
    members, _ = setsketch.near_copies(texts(chained))
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in members.collect()}
    assert got == plain_members(chained)


def rounds_of(monkeypatch):
    """The rows that each round of the rest is given."""
    seen, rest = [], setsketch._rest

    def noted(open_rows, *others):
        seen.append(open_rows.collect())
        return rest(open_rows, *others)

    monkeypatch.setattr(setsketch, "_rest", noted)
    return seen


def test_pairs_that_met_as_stars_do_not_meet_again(texts, monkeypatch):
    rounds, rows = rounds_of(monkeypatch), []
    for k in range(30):
        base = [f"p{k}w{i}" for i in range(300)]
        rows += [" ".join(base), " ".join(base[:255] + [f"p{k}z{i}" for i in range(45)])]
    rows = list(enumerate(rows))
    members, _ = setsketch.near_copies(texts(rows))
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in members.collect()} == plain_members(rows)
    assert not rounds


@pytest.mark.parametrize("block", [1000, 7])
def test_only_guests_that_have_more_are_asked_again(texts, block, monkeypatch):
    monkeypatch.setattr(setsketch, "BLOCK", block)
    monkeypatch.setattr(setsketch, "WIDER", 2)
    rounds, rng = rounds_of(monkeypatch), random.Random(8)
    base = [f"w{i}" for i in range(300)]
    rows = []
    for family in range(5):
        words = base[: 300 - 24 * family] + [f"f{family}w{i}" for i in range(24 * family)]
        rows += [edited(rng, words, rng.randrange(4)) for _ in range(12)]
    rows = list(enumerate(rows))
    members, _ = setsketch.near_copies(texts(rows))
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in members.collect()} == plain_members(rows)
    assert rounds
    guests = [{(r["bucket"], r["node"]) for r in round if r["guest"]} for round in rounds]
    assert all(later < before for before, later in zip(guests, guests[1:]))


def test_query_on_the_table(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    got = QUERIES["op13_setsketch_copies"](spark, SMALL)
    assert got.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got.collect()} == plain_members(rows)


def test_awkward_rows(texts):
    rows = [*AWKWARD, (9, "a row without an id but with some words"), (7, "one")]
    members, links = setsketch.near_copies(texts(rows))
    found = sorted(((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in members.collect()), key=str)
    assert len(found) == len(rows)
    assert (None, 5, 9, False) in found and (9, 5, 9, True) in found
    assert found.count((4, 1, 4, True)) == 2 and (7, 1, 4, False) in found
    assert (1, 0, 1, True) in found and (5, 1, 5, True) in found
    assert links.count() == 0
    members, links = setsketch.near_copies(texts([]).limit(0))
    assert members.count() == links.count() == 0
    with pytest.raises(ValueError):
        setsketch.near_copies(texts(rows), 60)
