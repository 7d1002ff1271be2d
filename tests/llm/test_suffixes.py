"""Induced sorting and removal of repeated strings against brute force."""

import hashlib
import random

import numpy as np
import pytest
from cases import AWKWARD, SMALL

from feedloom.llm import suffix_dedup
from feedloom.llm.induced import ExternalQueue, suffix_order
from feedloom.llm.queries import QUERIES


@pytest.mark.parametrize("memory_items", [3, 1000])
def test_order_of_random_and_repetitive_strings(memory_items):
    rng = random.Random(memory_items)
    for _ in range(600):
        letters = rng.choice([1, 2, 3, 5, 26])
        own = [rng.randint(1, letters) for _ in range(rng.randint(0, 40))]
        if rng.random() < 0.4:
            own = own[: len(own) // 2] * 3
        text, depth = np.array([*own, 0]), rng.choice([1, 2, 3, 5, 8, 100])
        order = suffix_order(text, depth, memory_items, rng.choice([0, 2, 64]))
        assert sorted(order.tolist()) == list(range(len(text)))
        seen = [tuple(text[i : i + depth]) for i in order]
        assert seen == sorted(seen)


def test_the_queue_is_stable_and_spills():
    rng, queue, held = np.random.default_rng(0), ExternalQueue(memory_items=50), []
    for k in range(60):
        keys = rng.integers(0, 40, 20)
        values = np.arange(20) + 20 * k
        queue.push(keys, values)
        held += zip(keys.tolist(), values.tolist())
        if k % 7 == 0:
            limit = int(rng.integers(0, 40))
            got_keys, got = queue.below(limit, take=True)
            want = sorted((p for p in held if p[0] < limit), key=lambda p: p[0])
            assert list(zip(got_keys.tolist(), got.tolist())) == want
            held = [p for p in held if p[0] >= limit]
    assert any(isinstance(r[0], np.memmap) for r in queue.runs)
    assert queue.least() == min(k for k, _ in held)


def plain_removal(rows, length):
    seen, out = set(), {}
    for doc_id, text in rows:
        raw = (text or "").encode()
        gone = np.zeros(len(raw), dtype=bool)
        for k in range(len(raw) - length + 1):
            if raw[k : k + length] in seen:
                gone[k : k + length] = True
            seen.add(raw[k : k + length])
        kept = np.frombuffer(raw, dtype=np.uint8)[~gone].tobytes()
        out[doc_id] = (len(raw), int(gone.sum()), int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum()), hashlib.sha256(kept).hexdigest())
    return out


def found_in(df):
    return {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in df.collect()}


@pytest.mark.parametrize("shard_bytes", [8 << 20, 4_000])
def test_planted_repeats(spark, texts, monkeypatch, shard_bytes):
    monkeypatch.setattr(suffix_dedup, "SHARD_BYTES", shard_bytes)
    rng = random.Random(7)
    word = lambda n: " ".join("".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 8))) for _ in range(n))
    shared, rows = [word(30), word(45), "x" * 260, "ab" * 120], []
    for _ in range(60):
        parts = [word(rng.randint(0, 25)) for _ in range(3)]
        for _ in range(rng.randint(0, 3)):
            parts.insert(rng.randrange(len(parts)), rng.choice(shared)[rng.randrange(0, 40) :])
        rows.append("".join(parts))
    rows += rows[:12] + ["y" * 99, "y" * 99, "y" * 100, "y" * 101, "", None, "z" * 5_000]
    rng.shuffle(rows)
    rows = list(enumerate(rows))
    assert found_in(suffix_dedup.removal(texts(rows), memory_items=500)) == plain_removal(rows, 100)


def test_strings_that_share_a_short_string_alone_are_not_sorted(spark, texts, monkeypatch):
    rng, word = random.Random(3), lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    common, passage = word(40), word(160)
    rows = list(enumerate([word(150) + common + word(150) for _ in range(60)] + [word(80) + passage + word(80) for _ in range(5)]))

    def sized(ids, hashes, starts, sizes, segments, length, memory_items):
        assert sum(map(len, segments)) < 2_000, "segments are sorted that no other can match"
        return plain(ids, hashes, starts, sizes, segments, length, memory_items)

    plain = suffix_dedup.shard_removals
    monkeypatch.setattr(suffix_dedup, "shard_removals", sized)
    held = suffix_dedup._Distinct()
    for i, text in rows:
        raw = text.encode()
        for _, a, n, m in zip(*(c.tolist() for c in suffix_dedup._segments(raw, 100))):
            held.add(raw[a : a + n + 99], (i, 0, a), n, m)
    batch = suffix_dedup._batch(
        suffix_dedup.SEGMENTS,
        [0],
        *[[np.array(c, dtype="<i8").tobytes()] for c in (*held.arrays(), held.anchors)],
        [b"".join(held.known)],
    )
    spans = {(r["order_id"], r["start"], r["stop"]) for b in suffix_dedup._sorted_shards(100, 500)([batch]) for r in b.to_pylist()}
    gone = {i: sum(z - a for a, z in suffix_dedup._joined(*map(list, zip(*sorted((a, z) for j, a, z in spans if j == i))))) for i in {j for j, *_ in spans}}
    assert gone == {i: n for i, (_, n, _, _) in plain_removal(rows, 100).items() if n} and len(gone) == 4
    assert found_in(suffix_dedup.removal(texts(rows), memory_items=500)) == plain_removal(rows, 100)


@pytest.mark.parametrize("length", [25, 26, 31, 100, 140])
def test_narrowed_segments_keep_all_that_recurs(length):
    rng = random.Random(length)
    for _ in range(30):
        pieces = ["".join(rng.choice("ab") for _ in range(rng.randint(20, 160))) for _ in range(4)]
        rows = [(i, "".join(rng.choice(pieces)[rng.randrange(20) :] for _ in range(rng.randint(1, 5)))) for i in range(12)]
        held = suffix_dedup._Distinct()
        gone = []
        for i, text in rows:
            raw = text.encode()
            if len(raw) >= length:
                for _, a, n, m in zip(*(c.tolist() for c in suffix_dedup._segments(raw, length))):
                    gone += held.add(raw[a : a + n + length - 1], (i, 0, a), n, m)
        for _ in range(3):
            if held.known:
                held, more = held.narrowed(length)
                gone += more
        found = [np.zeros(len(t), dtype=bool) for _, t in rows]
        for i, _, a, z in gone:
            found[i][a:z] = True
        if held.known:
            ids, hashes, starts, sizes = held.arrays()
            owner, at = suffix_dedup.shard_removals(ids, hashes, starts, sizes, list(held.known), length, 500)
            for i, a in zip(ids[owner].tolist(), at.tolist()):
                found[i][a : a + length] = True
        assert [int(f.sum()) for f in found] == [plain_removal(rows, length)[i][1] for i, _ in rows]


def test_the_table(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SMALL}/documents.parquet").orderBy("doc_id").collect()]
    assert found_in(QUERIES["op4_induced_suffixes"](spark, SMALL)) == plain_removal(rows, 100)


def test_awkward_rows(texts):
    long = "a long passage of words that comes again and again in rows of every kind, and it has more than a hundred bytes"
    rows = [*AWKWARD, (None, long), (8, long), (8, long), (9, long + "!")]
    got = [(r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"]) for r in suffix_dedup.removal(texts(rows)).collect()]
    n = len(long.encode())
    for row in [(None, n, n, 1), (9, n + 1, n, 1), (1, 0, 0, 0), (2, 0, 0, 0), (5, 150_000, 149_995, 1)]:
        assert row in got
    assert got.count((8, n, 0, 0)) == 2 and len(got) == len(rows)
    assert suffix_dedup.removal(texts([])).count() == 0
    with pytest.raises(ValueError):
        suffix_dedup.removal(texts([]), length=10)
