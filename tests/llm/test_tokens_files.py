"""Token ids, plane files and packing against the tokenizers library itself."""

import random
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from cases import AWKWARD, SMALL
from tokenizers import Tokenizer

from feedloom.llm import tokens
from feedloom.llm.bitplane import PlaneReader, PlaneWriter, from_planes, read_token_files, to_planes, write_token_files
from feedloom.llm.common import gathered
from feedloom.llm.packing import Schedule, pack
from feedloom.llm.tokens import Coder, default_tokenizer


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(default_tokenizer())


def ids_of(library, text):
    return np.array(library.encode(text or "", add_special_tokens=False).ids + [0], dtype="<u4")


def test_ids_are_those_of_the_whole_text(library):
    rng = random.Random(1)
    parts = ["a", "B", " ", "  ", "\n", "\t", "'s", "1", "é", " ", "　", "!", "x y", "don't", "\x1c", "\x85", "😀", "<|endoftext|>", "\r\n", "中文", ",", ". "]
    made = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 14))) for _ in range(4000)] + [None, "", " "]
    flat, counts = Coder(default_tokenizer()).encode(pa.array(made, pa.string()))
    ends = np.cumsum(counts)
    for text, end, n in zip(made, ends, counts):
        assert list(flat[end - n : end]) == library.encode(text or "", add_special_tokens=False).ids, repr(text)


class Asked:
    """The library's model, and what it was asked for."""

    def __init__(self, model):
        self.model, self.words = model, []

    def tokenize(self, word):
        self.words.append(word)
        return self.model.tokenize(word)


def test_full_tables_keep_what_recurs_and_forget_nothing_else_of_the_ids(library, monkeypatch):
    monkeypatch.setattr(tokens, "CACHE_PIECES", 300)
    monkeypatch.setattr(tokens, "CACHE_WORDS", 200)
    rng, coder = random.Random(2), Coder(default_tokenizer())
    coder.model = asked = Asked(coder.model)
    letters = "abcdefghijklmnopqrstuvwxyzé"
    common = [f"zq{a}{b}" for a in letters[:8] for b in letters[:8]]
    for _ in range(30):
        rare = ["".join(rng.choice(letters) for _ in range(rng.randint(5, 9))) + rng.choice(["", ",", ".\nSo", "'s"]) for _ in range(100)]
        words = common + rare + ["x" * 90 + str(rng.random())]
        texts = [" ".join(rng.sample(words, len(words))), "", None, "two  spaces " + rare[0]]
        flat, counts = coder.encode(pa.array(texts, pa.string()))
        assert flat.tolist() == [i for t in texts for i in library.encode(t or "", add_special_tokens=False).ids]
        assert counts.tolist() == [len(library.encode(t or "", add_special_tokens=False).ids) for t in texts]
    assert max(asked.words.count("\u0120" + w) for w in common) == 1
    assert len(coder.pieces) <= 300 + 200


def test_batches_are_gathered_to_runs_of_texts():
    rows = [("a" * n if n is not None else None, i) for i, n in enumerate([3, 4, None, 9, 0, 1, 25, 2])]
    schema = pa.schema([("text", pa.string()), ("k", pa.int64())])
    batches = [pa.RecordBatch.from_pydict({"text": [t], "k": [k]}, schema=schema) for t, k in rows]
    found = [b.column("k").to_pylist() for b in gathered(iter(batches), "text", 10)]
    assert found == [[0, 1, 2], [3, 4, 5], [6], [7]]
    assert list(gathered(iter([]), "text", 10)) == []


@pytest.mark.parametrize("kind", ["byte", "bit"])
@pytest.mark.parametrize("n", [0, 1, 7, 8, 1000])
def test_planes_round_trip(kind, n):
    ids = np.random.default_rng(n).integers(0, 2**32, n, dtype=np.uint64).astype("<u4")
    assert (from_planes(to_planes(ids, kind), n, kind) == ids).all()


@pytest.mark.parametrize("kind", ["byte", "bit"])
def test_a_file_gives_back_blocks_and_documents(tmp_path, kind):
    rng, docs = np.random.default_rng(3), []
    with open(tmp_path / "f", "wb") as out:
        writer = PlaneWriter(out, kind, block_ids=100)
        for i in range(40):
            ids = rng.integers(0, 50_000, rng.integers(0, 90)).astype("<u4")
            docs.append((None if i == 3 else i * 10, ids))
            writer.add(docs[-1][0], len(ids))
            writer.ids(ids)
        writer.close()
    every = np.concatenate([d[1] for d in docs])
    with open(tmp_path / "f", "rb") as f:
        reader = PlaneReader(f, (tmp_path / "f").stat().st_size)
        assert (reader.block(2) == every[200:300]).all()
        at = 0
        for (name, ids), found in zip(docs, reader.documents(), strict=True):
            assert found == (name, at, len(ids), zlib.crc32(ids.tobytes()))
            at += len(ids)


def test_token_files_of_awkward_rows(texts, library):
    rows = sorted(AWKWARD, key=lambda r: (r[0] is not None, r[0] or 0))
    found = sorted(read_token_files(write_token_files(texts(AWKWARD))).collect(), key=lambda r: r["start"])
    at = 0
    assert len(found) == len(rows)
    for (doc_id, text), r in zip(rows, found):
        ids = ids_of(library, text)
        assert tuple(r) == (doc_id, at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)
    assert read_token_files(write_token_files(texts([]))).count() == 0


def check_pieces(pieces, expected, window=1024):
    by_doc, by_window = defaultdict(list), defaultdict(list)
    for r in pieces:
        by_doc[r["doc_id"]].append(r)
        by_window[r["sequence_id"]].append(r)
    for doc_id, ids in expected.items():
        at = 0
        for r in sorted(by_doc[doc_id], key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(ids)
            assert r["ids_crc32"] == zlib.crc32(ids[at : at + r["length"]].tobytes())
            at += r["length"]
        assert at == len(ids)
    for rows in by_window.values():
        at = 0
        for r in sorted(rows, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= window
    assert sorted(by_window) == list(range(len(by_window)))
    return by_window


def test_packing_covers_every_id_once_and_keeps_the_mixture(spark, library):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    expected = {r["doc_id"]: ids_of(library, r["text"]) for r in docs.collect()}
    source = {r["doc_id"]: r["source"] for r in docs.collect()}
    windows = check_pieces(pack(docs).collect(), expected)
    total = sum(map(len, expected.values()))
    assert sum(r["length"] for w in windows.values() for r in w) == total
    share = defaultdict(float)
    for doc_id, ids in expected.items():
        share[source[doc_id]] += len(ids) / total
    served = defaultdict(int)
    for k in sorted(windows)[: len(windows) * 9 // 10]:
        for r in windows[k]:
            served[r["source"]] += r["length"]
        for s, part in share.items():
            assert abs(served[s] - part * 1024 * (k + 1)) <= 128 * 2 + 1024 * 0.02, (k, s)


def test_target_weights_hold_until_a_queue_runs_dry(spark, texts, library):
    rows = [(i, f"text number {i} " * 120, "a" if i % 4 else "b") for i in range(80)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    pieces = pack(docs, {"a": 1.0, "b": 1.0}, window=256, granule=32).collect()
    windows = check_pieces(pieces, {i: ids_of(library, t) for i, t, _ in rows}, 256)
    first = [r for k in range(10) for r in windows[k]]
    assert abs(sum(r["length"] for r in first if r["source"] == "a") - 1280) <= 64
    with pytest.raises(ValueError):
        pack(docs, window=100, granule=32)


def test_packing_of_awkward_rows(texts, library):
    rows = [r for r in AWKWARD if r[0] != 4]
    check_pieces(pack(texts(rows)).collect(), {i: ids_of(library, t) for i, t in rows})
    assert pack(texts([])).count() == 0


def test_places_are_a_permutation():
    schedule = Schedule([1000, 17, 0, 4096, 333], [500, 9, 1, 2048, 166], 8, 16)
    ranks = np.concatenate([schedule.rank(s, np.arange(n)) for s, n in enumerate(schedule.granules.tolist())])
    assert sorted(ranks.tolist()) == list(range(len(ranks)))
