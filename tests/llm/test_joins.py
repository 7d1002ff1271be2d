"""Near copies and benchmark leaks against brute force."""

import random
from collections import defaultdict
from itertools import combinations

import numpy as np
import pytest
from cases import AWKWARD, SMALL

from feedloom.llm import metric_join, templates
from feedloom.llm.components import components
from feedloom.llm.queries import QUERIES
from feedloom.llm.shingles import shingle_sets


def plain_set(text):
    words = (text or "").encode().lower().split()
    return frozenset(b" ".join(words[i : i + 5]) for i in range(len(words) - 4)) if len(words) >= 5 else frozenset([b" ".join(words)] if words else [])


def plain_components(rows):
    """doc_id to (set size, component), and the links between different sets."""
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
    links = {(a, b) for (a, b), n in shared.items() if 100 * n >= 80 * (len(sets[a]) + len(sets[b]) - n)}
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        root[find(a)] = find(b)
    least = {}
    for k, s in enumerate(sets):
        least[find(k)] = min([least.get(find(k), 1 << 62), *[i for i in members[s] if i is not None]])
    out = {}
    for k, s in enumerate(sets):
        for i in members[s]:
            out[i] = (len(s), least[find(k)])
    for i in members.get(frozenset(), []):
        out[i] = (0, i)
    return out, {(sets[a], sets[b]) for a, b in links}


def edited(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        k = rng.randrange(len(words))
        match rng.randrange(3):
            case 0:
                words[k] = f"w{rng.randrange(10**6)}"
            case 1:
                words.insert(k, f"w{rng.randrange(10**6)}")
            case _ if len(words) > 6:
                del words[k]
    return " ".join(words)


def planted(seed):
    """Groups of near copies around bases, chains, copies, a common passage, short and long texts."""
    rng, rows = random.Random(seed), []
    passage = [f"p{rng.randrange(500)}" for _ in range(60)]
    for base in range(14):
        words = [f"v{rng.randrange(3000)}" for _ in range(rng.choice([3, 6, 20, 60, 150, 300, 420]))]
        if base % 3 == 0:
            words += passage
        for _ in range(rng.choice([1, 2, 12, 40])):
            rows.append(edited(rng, words, rng.randrange(0, 2 + len(words) // 15)))
        for _ in range(4):
            words = edited(rng, words, max(1, len(words) // 40)).split(" ")
            rows.append(" ".join(words))
    rows += rows[:25] + ["", " \n", None, "Alone", "ALONE"]
    rng.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("seed", [1, 2])
def test_components_of_planted_groups(spark, texts, seed, monkeypatch):
    monkeypatch.setattr(metric_join, "PIVOTS", 3)
    rows = planted(seed)
    expected, links = plain_components(rows)
    members, found = metric_join.join(texts(rows))
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in members.collect()}
    assert got == expected
    for r in found.collect():
        assert 100 * r["shared"] >= 80 * r["total"]
    assert 0 < found.count() <= len(links)


def test_components_of_the_table(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    expected, _ = plain_components(rows)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in QUERIES["op5_jaccard_regions"](spark, SMALL).collect()}
    assert got == expected


def test_awkward_rows_of_the_join(texts):
    rows = [*AWKWARD, (9, "a row without an id but with some words"), (7, "one")]
    members, _ = metric_join.join(texts(rows))
    got = sorted((r["doc_id"] or 0, r["n_shingles"], r["component_id"]) for r in members.collect())
    assert got == sorted([(0, 5, 9), (1, 0, 1), (2, 0, 2), (3, 0, 3), (4, 1, 4), (4, 1, 4), (5, 1, 5), (6, 3, 6), (9, 5, 9), (7, 1, 4)])
    kept = metric_join.representatives(texts(rows))
    assert sorted((r["doc_id"] or 0) for r in kept.collect()) == [1, 2, 3, 4, 5, 6, 9]
    empty, links = metric_join.join(texts([]))
    assert empty.count() == 0 and links.count() == 0


def test_rows_without_an_id_stand_for_themselves(texts):
    alone, copied = "a text that no other row has and that has no id", "some words that a row with an id has as well"
    rows = [(None, alone), (None, "yet another text without an id, which comes twice"), (None, "yet another text without an id, which comes twice"), (None, copied), (7, copied), (None, ""), (None, None), (8, copied), (8, "the second text under one id, unlike all the others")]
    kept = sorted((r["doc_id"] or 0, r["text"] or "") for r in metric_join.representatives(texts(rows)).collect())
    assert kept == sorted([(0, alone), (0, rows[1][1]), (7, copied), (0, ""), (0, ""), (8, rows[8][1])])
    assert metric_join.join(texts(rows))[0].columns == ["doc_id", "n_shingles", "node", "component_id"]


def test_families_copied_into_an_even_number_of_tasks(spark):
    """All their shingles are very common, so every task sends them for the same sets."""
    families = [[f"f{k}w{i}" for i in range(40)] for k in range(3)]
    variants = [" ".join(words[:n]) for words in families for n in (40, 39)]
    rows = [(task * 1000 + i, variants[i % len(variants)]) for task in range(8) for i in range(10 * len(variants))]
    docs = spark.createDataFrame(spark.sparkContext.parallelize(rows, 8), "doc_id long, text string")
    expected, links = plain_components(rows)
    members, found = metric_join.join(docs)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in members.collect()} == expected
    assert found.count() == len(links) == 3


def test_star_contraction_finds_least_nodes(spark):
    rng = random.Random(4)
    pairs = [(i, i + 1) for i in range(100, 160)] + [(500, k) for k in range(300, 400)] + [(rng.randrange(1000, 1100), rng.randrange(1000, 1100)) for _ in range(60)]
    found = {r["node"]: r["root"] for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    root = {x: x for p in pairs for x in p}
    for _ in range(200):
        for a, b in pairs:
            root[a] = root[b] = min(root[a], root[b])
    assert found == {x: r for x, r in root.items() if any(x in p and p[0] != p[1] for p in pairs)}


def test_shingles_on_bytes():
    rng = random.Random(2)
    parts = [b"a", b"B", b" ", b"\n", b"\t", "é".encode(), b"\x0b", b"x", b" y "]
    made = [b"".join(rng.choice(parts) for _ in range(rng.randint(0, 25))) for _ in range(2000)]
    same = defaultdict(set)
    for text, found in zip(made, shingle_sets(made)):
        words = text.lower().split()
        own = frozenset(b" ".join(words[i : i + 5]) for i in range(len(words) - 4)) if len(words) >= 5 else frozenset([b" ".join(words)] if words else [])
        assert len(own) == len(found) and (np.diff(found.view(np.uint64)) > 0).all()
        same[own].add(found.tobytes())
    assert all(len(v) == 1 for v in same.values()) and len({next(iter(v)) for v in same.values()}) == len(same)


ITEM = "If Mary Smith has 12 apples and gives 5 kg of apples to John then how many apples does Mary Smith keep in her basket today?"


def test_reworded_items_are_found(spark, texts):
    items = spark.createDataFrame([(1, ITEM), (2, "Tiny one here"), (3, None), (4, ""), (None, "an item without an id is still an item of some words")], "item_id long, text string")
    rows = [
        (10, f"Before it. {ITEM} After it."),
        (11, ITEM.upper()),
        (12, "xx. " + ITEM.replace("Mary Smith", "Anna Bell").replace("12", "30").replace("5 kg", "7 lb").replace("John", "Peter")),
        (13, ITEM.replace("Mary Smith keep", "Karl Marx keep").replace("Mary Smith", "Anna Bell").replace("John", "Peter")),
        (14, "nothing of this sort at all is here to be seen by any of us"),
        (15, " ".join(ITEM.split()[:9]) + " and then it goes on in quite another way than the item did before"),
        (16, "a tiny one here"),
        (17, "an item without an id is still an item of some words"),
        *AWKWARD,
        (None, ITEM),
        (10, f"Before it. {ITEM} After it."),
    ]
    found = {(r["doc_id"], r["item_id"]): r for r in templates.leaks(texts(rows), items).collect()}
    assert set(found) == {(10, 1), (11, 1), (12, 1), (16, 2), (17, None), (None, 1)}
    assert found[12, 1]["reworded"] and not found[10, 1]["reworded"] and found[10, 1]["coverage"] == 1
    kept = templates.without_leaks(texts(rows), items)
    assert sorted((r["doc_id"] or 0) for r in kept.collect()) == sorted([13, 14, 15, *[(i or 0) for i, _ in AWKWARD]])
    assert templates.leaks(texts([]), items).count() == 0
    assert templates.leaks(texts(rows), items.limit(0)).count() == 0


def test_number_heavy_and_partly_changed_items_are_found(spark, texts):
    sums = "Compute 12 + 7 - 30 * 4"
    twice = "We bought 5 red pens in the old town on a rainy day and then 5 blue pens near the harbour"
    two = "The red box holds 3 old coins while my blue box holds 5 old coins of hers"
    items = spark.createDataFrame([(1, sums), (2, twice), (3, two)], "item_id long, text string")
    rows = [
        (1, f"First this: {sums} and so on"),
        (2, "Compute 13 + 7 - 30 * 4"),
        (3, twice.replace("5 red", "7 red")),
        (4, two.replace("3", "4").replace("5", "4")),
        (5, "quite other words with 12 and 7 and 30 and 4 in them"),
    ]
    found = {(r["doc_id"], r["item_id"]): r for r in templates.leaks(texts(rows), items).collect()}
    assert set(found) == {(1, 1), (3, 2), (4, 3)}
    assert found[1, 1]["coverage"] == 1 and not found[1, 1]["reworded"]
    assert found[3, 2]["reworded"] and found[4, 3]["coverage"] == 1


def test_the_most_windows_that_agree_count():
    windows = [(0, [(1, "5", "7")]), (1, [(1, "5", "7"), (1, "3", "4")]), (2, [(1, "5", "8"), (1, "3", "4")]), (3, [(1, "5", "5")]), (4, [(1, "5", "7"), (1, "5", "5")])]
    places, reworded = templates.agreeing(windows)
    assert sorted(places) == [0, 1, 3] and reworded
    assert templates.agreeing([(0, [(3, "mary", "anna")]), (1, [(3, "mary", "karl")]), (2, [])]) == ([2], False)


def test_most_agreeing_against_all_choices():
    rng = random.Random(8)
    for _ in range(150):
        keys = rng.randrange(1, 5)
        windows = [(at, {k: rng.choice("xyz") for k in rng.sample(range(keys), rng.randrange(1, keys + 1))}) for at in range(rng.randrange(1, 9))]
        best = 0
        for chosen in range(1 << len(windows)):
            own, means = [w for i, w in enumerate(windows) if chosen >> i & 1], {}
            if all(means.setdefault(k, b) == b for _, m in own for k, b in m.items()):
                best = max(best, len(own))
        places, means = templates.most_agreeing(windows), {}
        assert len(places) == len(set(places)) == best
        assert all(means.setdefault(k, b) == b for at in places for k, b in windows[at][1].items())


def test_a_diagonal_of_very_many_values():
    """Five thousand values of two readings each, in windows of four values: each change costs the fewer of its windows."""
    reading = [{k: "b" if k % 50 == 25 and half else "a" for k in range(5_000)} for half in (0, 1)]
    windows = [(at, {k: reading[at % 2][k] for k in range(at // 2, at // 2 + 4) if k < 5_000}) for at in range(10_000)]
    places, means = templates.most_agreeing(windows), {}
    assert all(means.setdefault(k, b) == b for at in places for k, b in windows[at][1].items())
    assert len(places) == 10_000 - 100 * 4


def test_leaks_of_the_table_against_word_windows(spark):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    items = {r["item_id"]: r["text"] for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()}

    def windows(text):
        words = ["".join(c for c in w.lower() if c.isalnum()) for w in text.split()]
        words = [w for w in words if w]
        return {tuple(words[k : k + 8]) for k in range(len(words) - 7)}

    own = {i: windows(t) for i, t in items.items()}
    expected = {(d, i) for d, t in docs.items() for i, w in own.items() if w and len(w & windows(t)) >= len(w) / 2}
    found = {(r["doc_id"], r["item_id"]) for r in QUERIES["op2_template_leaks"](spark, SMALL).collect()}
    assert found == expected


def test_keys_go_as_planes_and_come_back():
    rng = np.random.default_rng(4)
    for n in (1, 2, 5000):
        key, at = np.sort(rng.integers(0, 2**64, n, dtype=np.uint64)), rng.integers(0, 300, n)
        packed = metric_join._planes(np.diff(key, prepend=np.uint64(0)), "<u8")
        assert (np.cumsum(metric_join._unplaned(packed, "<u8"), dtype=np.uint64) == key).all()
        assert (metric_join._unplaned(metric_join._planes(at, "<u4"), "<u4") == at).all()


def test_only_sets_that_pairs_name_are_moved(spark):
    steps = [metric_join._planes(np.diff(np.arange(100 + k, 150 + k, dtype="<u8"), prepend=np.uint64(0)), "<u8") for k in range(-20, 20)]
    sets = spark.createDataFrame(list(zip(range(-20, 20), steps)), "node long, shingles binary")
    pairs = spark.createDataFrame([(-4, 3), (3, 7)], "a long, b long")
    assert sorted(r["node"] for r in metric_join._named(sets, pairs).collect()) == [-4, 3, 7]
    found = metric_join._measured(pairs, sets).collect()
    assert sorted((r["a"], r["b"], r["shared"], r["total"]) for r in found) == [(-4, 3, 43, 57), (3, 7, 46, 54)]
    assert metric_join._measured(pairs.limit(0), sets).count() == 0
