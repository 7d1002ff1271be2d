"""Word counts with planted slips, near words and forms against plain searches."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from cases import AWKWARD, SMALL

from feedloom.llm import vgram
from feedloom.llm.queries import QUERIES

RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def plain_counts(rows, least=6, slips=199):
    found = Counter()
    for doc_id, text in rows:
        for run in RUN.findall(text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{doc_id}:{run}".encode())
            if slips and doc_id is not None and h % slips == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= least:
                found[run] += 1
    return found


def plain_near(words):
    """All pairs one edit apart, by what is left when one letter goes."""
    without = defaultdict(set)
    for w in words:
        for k in range(len(w)):
            without[w[:k] + w[k + 1 :]].add((k, w))
    near = defaultdict(set)
    for w in words:
        for _, longer in without.get(w, ()):
            near[w].add(longer)
            near[longer].add(w)
    for held in without.values():
        by_place = defaultdict(set)
        for k, w in held:
            by_place[k].add(w)
        for some in by_place.values():
            for w in some:
                near[w] |= some - {w}
    return near


def plain_variants(counts, factor=5):
    near, form = plain_near(counts), {}
    for w, n in counts.items():
        best = min(near[w], key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best and counts[best] >= factor * n else None
    out = {}
    for w, n in counts.items():
        root = w
        while form[root]:
            root = form[root]
        out[w] = (n, len(near[w]), form[w], form[w] and counts[form[w]], root)
    return out


def invented(rng, n, alphabet="aeinrst"):
    """Words of few letters, so that many are near, with counts of all sizes."""
    words = {}
    while len(words) < n:
        w = "".join(rng.choice(alphabet) for _ in range(rng.choice([6, 6, 7, 8, 11, 20])))
        words[w] = rng.choice([5, 6, 30, 200, 3000])
        for _ in range(rng.randrange(4)):
            k = rng.randrange(len(w) + 1)
            w = rng.choice([w[:k] + w[k + 1 :], w[:k] + rng.choice("aeé") + w[k:], w[:k] + rng.choice("xyö") + w[k + 1 :]])
            if len(w) >= 6:
                words.setdefault(w, rng.choice([5, 5, 7, 40, 900]))
    return words


def test_crc_of_joined_strings():
    rng = random.Random(1)
    pairs = [(rng.randbytes(rng.randrange(12)), rng.randbytes(rng.randrange(65))) for _ in range(300)]
    got = vgram.joined_crc32(np.array([zlib.crc32(a) for a, _ in pairs], np.uint32), np.array([zlib.crc32(b) for _, b in pairs], np.uint32), np.array([len(b) for _, b in pairs]))
    assert got.tolist() == [zlib.crc32(a + b) for a, b in pairs]


@pytest.mark.parametrize("rare", [0, 2, 40, 10**6])
def test_no_edit_reaches_all_grams(rare):
    """Whatever the dictionary, near words share one of their rarest grams at the right places."""
    rng = random.Random(rare)
    words = list(invented(rng, 400, "aei"))
    grams = Counter(vgram.marked(w)[i : i + q] for w in words for q in range(2, 9) for i in range(len(w) + 3 - q))
    frequent = {g: n for g, n in grams.items() if n > rare and (len(g) == 2 or grams[g[:-1]] > rare)}
    for a, others in plain_near(words).items():
        for b in others:
            if (len(a), a) < (len(b), b):
                cap, shift = vgram.cap_of(len(a)), {0, len(b) - len(a)}
                first, second = vgram.rarest(a, cap, frequent), set(vgram.rarest(b, cap, frequent))
                assert any((i + k, g) in second for i, g in first for k in shift), (a, b)


@pytest.mark.parametrize("seed, rare, least", [(1, 8, 6), (2, 1, 6), (3, 8, 2)])
def test_variants_of_invented_words(spark, seed, rare, least, monkeypatch):
    monkeypatch.setattr(vgram, "RARE", rare)
    counts = invented(random.Random(seed), 1500)
    if least < 6:
        counts |= {"".join(w): 5 + 7 * k for k, w in enumerate(["ab", "ba", "abc", "ac", "éa", "abab", "aa", "aaa", "bcd", "x" * 5_000, "x" * 5_001])}
    words = spark.createDataFrame(list(counts.items()), "word string, n long")
    got = {r["word"]: (r["n"], r["n_near"], r["form"], r["form_n"], r["root"]) for r in vgram.group_variants(words, least).collect()}
    assert got == plain_variants(counts)


def test_long_chains_end_in_their_root(spark):
    words = ["lantern", "lanterns", "lanternsk", "lanternsky", "lanternskyl", "lanternskyli", "lanternskylig"]
    counts = {w: 5 * 5**k for k, w in enumerate(words)}
    got = {r["word"]: r["root"] for r in vgram.group_variants(spark.createDataFrame(list(counts.items()), "word string, n long")).collect()}
    assert got == {w: words[-1] for w in words}


@pytest.mark.parametrize("slips", [None, 7])
def test_counts_of_awkward_rows(texts, slips):
    rows = [*AWKWARD, (8, "ÀÉÎ×÷ÿß Straße œuvre naïveté NAÏVETÉ naÏveté"), (9, "Ab" * 500 + " " + "z" * 70 + " z1z abcdef"), (9, "abcdef ABCDEF"), (10, "ends with é"), (11, "é")]
    expected = {w: n for w, n in plain_counts(rows, 3, slips).items() if n >= 2}
    got = vgram.vocabulary(texts(rows), 3, 2, slips).collect()
    assert {r["word"]: r["n"] for r in got} == expected and len(got) == len(expected)


def test_empty_tables(spark, texts):
    assert vgram.group_variants(vgram.vocabulary(texts([]).limit(0))).count() == 0
    with pytest.raises(ValueError):
        vgram.near_words(spark.createDataFrame([("a", 5)], "word string, n long"), 1)


def test_query_against_the_contract(spark):
    for sf_dir in (SMALL, SMALL.replace("0.001", "0.01")):
        rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
        expected = plain_variants({w: n for w, n in plain_counts(rows).items() if n >= 5})
        got = QUERIES["op11_variable_grams"](spark, sf_dir)
        assert got.columns == ["word", "n", "n_near", "form", "form_n", "root"]
        assert {r["word"]: (r["n"], r["n_near"], r["form"], r["form_n"], r["root"]) for r in got.collect()} == expected
        assert sum(1 for x in expected.values() if x[2]) > 10
