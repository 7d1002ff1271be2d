"""Token files made of bit or byte planes, and their reader.

A file holds the ids of a run of documents. Ids are cut into blocks of a fixed number of
ids; a block is transposed into planes (plane *k* of a byte plane file holds byte *k* of
every id, of a bit plane file bit *k*), each plane is compressed with zstandard by itself.
High planes are nearly constant and vanish. Layout, little-endian throughout:

    magic | planes of block 0 | planes of block 1 | ... | document index | chunk index | footer

* chunk index: per block its first byte, its ids, and the compressed size of each plane;
* document index: zstandard of the ids (int64, with a validity byte) and lengths of the documents;
* footer: where both indexes start, counts, plane kind, magic.

The writer sorts documents into files by range, one file per task; a file's name carries
the task attempt, and only files named by the stored manifest count, so a lost executor
or a repeated task leaves no trace in what is read.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feedloom.llm.common import gathered, stored
from feedloom.llm.tokens import TEXT_BYTES, coder, default_tokenizer
from feedloom.session import shared_folder

MAGIC = b"PLANES01"
FOOTER = struct.Struct("<QQQQIB7x8s")
BLOCK_IDS = 1 << 16
KINDS = {"byte": 4, "bit": 32}

MANIFEST = "path string, part long, n_docs long, n_ids long"
READ = "doc_id long, start long, n_tokens long, ids_crc32 long"


def to_planes(ids: np.ndarray, kind: str) -> list[bytes]:
    """The planes of one block, lowest first."""
    octets = ids.astype("<u4").view(np.uint8).reshape(-1, 4)
    if kind == "byte":
        return [octets[:, k].tobytes() for k in range(4)]
    bits = np.unpackbits(octets, axis=1, bitorder="little")
    return [np.packbits(bits[:, k], bitorder="little").tobytes() for k in range(32)]


def from_planes(planes: list[bytes], n: int, kind: str) -> np.ndarray:
    """The ids of one block again."""
    if kind == "byte":
        octets = np.stack([np.frombuffer(p, dtype=np.uint8, count=n) for p in planes], axis=1)
    else:
        bits = np.stack([np.unpackbits(np.frombuffer(p, dtype=np.uint8), bitorder="little", count=n) for p in planes], axis=1)
        octets = np.packbits(bits, axis=1, bitorder="little")
    return np.ascontiguousarray(octets).view("<u4").reshape(-1)


class PlaneWriter:
    """Writes one file; holds one block and the document index in memory."""

    def __init__(self, out, kind: str = "byte", block_ids: int = BLOCK_IDS, level: int = 3):
        self.out, self.kind, self.block_ids = out, kind, block_ids
        self.zstd = zstandard.ZstdCompressor(level=level)
        self.at = out.write(MAGIC)
        self.waiting: list[np.ndarray] = []
        self.n_waiting = self.n_ids = self.n_blocks = 0
        self.index: list[bytes] = []
        self.docs: list[tuple[int | None, int]] = []

    def _put(self, data: bytes) -> int:
        self.out.write(data)
        self.at += len(data)
        return len(data)

    def _block(self, ids: np.ndarray) -> None:
        at = self.at
        sizes = [self._put(self.zstd.compress(p)) for p in to_planes(ids, self.kind)]
        self.index.append(struct.pack(f"<QI{len(sizes)}I", at, len(ids), *sizes))
        self.n_blocks += 1

    def add(self, doc_id: int | None, n_tokens: int) -> None:
        self.docs.append((doc_id, n_tokens))

    def ids(self, ids: np.ndarray) -> None:
        self.waiting.append(ids)
        self.n_waiting += len(ids)
        self.n_ids += len(ids)
        if self.n_waiting >= self.block_ids:
            rest = np.concatenate(self.waiting)
            whole = len(rest) - len(rest) % self.block_ids
            for a in range(0, whole, self.block_ids):
                self._block(rest[a : a + self.block_ids])
            self.waiting, self.n_waiting = [rest[whole:].copy()], len(rest) - whole

    def close(self) -> None:
        if self.n_waiting:
            self._block(np.concatenate(self.waiting))
        docs_at = self.at
        valid = np.array([d is not None for d, _ in self.docs], dtype=np.uint8)
        names = np.array([d or 0 for d, _ in self.docs], dtype="<i8")
        sizes = np.array([n for _, n in self.docs], dtype="<i8")
        self._put(self.zstd.compress(valid.tobytes() + names.tobytes() + sizes.tobytes()))
        index_at = self.at
        self._put(b"".join(self.index))
        self._put(FOOTER.pack(docs_at, index_at, self.n_blocks, len(self.docs), self.n_ids % (1 << 32), KINDS[self.kind], MAGIC))


class PlaneReader:
    """Reads a file block by block, or any one block through the chunk index."""

    def __init__(self, file, size: int):
        self.file = file
        footer = self._get(size - FOOTER.size, FOOTER.size)
        docs_at, index_at, self.n_blocks, n_docs, _, planes, magic = FOOTER.unpack(footer)
        if magic != MAGIC:
            raise ValueError("not a plane file")
        self.kind = {n: k for k, n in KINDS.items()}[planes]
        entry = struct.Struct(f"<QI{planes}I")
        self.blocks = list(entry.iter_unpack(self._get(index_at, entry.size * self.n_blocks)))
        self.zstd = zstandard.ZstdDecompressor()
        raw = self.zstd.decompress(self._get(docs_at, index_at - docs_at), max_output_size=n_docs * 17 + 1)
        self.valid = np.frombuffer(raw, dtype=np.uint8, count=n_docs)
        self.names = np.frombuffer(raw, dtype="<i8", count=n_docs, offset=n_docs)
        self.sizes = np.frombuffer(raw, dtype="<i8", count=n_docs, offset=9 * n_docs)

    def _get(self, at: int, n: int) -> bytes:
        self.file.seek(at)
        return self.file.read(n)

    def block(self, k: int) -> np.ndarray:
        at, n, *sizes = self.blocks[k]
        raw, planes, a = self._get(at, sum(sizes)), [], 0
        most = n if self.kind == "byte" else (n + 7) // 8
        for size in sizes:
            planes.append(self.zstd.decompress(raw[a : a + size], max_output_size=most))
            a += size
        return from_planes(planes, n, self.kind)

    def documents(self) -> Iterator[tuple[int | None, int, int, int]]:
        """Per document its id, its first position in the file, its ids and their crc32."""
        k, block, at, start = 0, np.empty(0, dtype="<u4"), 0, 0
        for valid, name, size in zip(self.valid.tolist(), self.names.tolist(), self.sizes.tolist()):
            crc, left = 0, size
            while left:
                if at == len(block):
                    block, at, k = self.block(k), 0, k + 1
                some = block[at : at + left]
                crc = zlib.crc32(some, crc)
                at, left = at + len(some), left - len(some)
            yield (name if valid else None), start, size, crc
            start += size


def _opened(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path)


def write_token_files(docs: DataFrame, tokenizer: str | None = None, kind: str = "byte", end_id: int = 0, block_ids: int = BLOCK_IDS, folder: str | None = None) -> DataFrame:
    """Write the ids of ``docs(doc_id, text)`` in ascending doc_id order; the manifest of the files.

    Every document ends with ``end_id``. NULL text is empty; a NULL doc_id comes first;
    rows that share a doc_id are ordered by text and each keeps its own entry; an empty table
    writes no file; other columns are not read. Files go to ``folder`` (below the
    shared folder unless named), which every executor must reach.
    """
    tokenizer = tokenizer or default_tokenizer()
    spark = docs.sparkSession
    folder = folder or shared_folder(spark, "planes")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    rows = rows.withColumn("tie", F.xxhash64("text"))
    placed = rows.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie", "text")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        coded, writer, out, path = coder(tokenizer), None, None, ""
        for part in gathered(batches, "text", TEXT_BYTES):
            if writer is None:
                system, base = _opened(folder)
                system.create_dir(base, recursive=True)
                name = f"part-{task.partitionId():06d}-{task.taskAttemptId()}.planes"
                path, out = f"{folder}/{name}", system.open_output_stream(f"{base}/{name}")
                writer = PlaneWriter(out, kind, block_ids)
            flat, counts = coded.encode(part.column("text"))
            ends = np.cumsum(counts)
            writer.ids(np.insert(flat, ends, end_id).astype("<u4"))
            for doc_id, n in zip(part.column("doc_id").to_pylist(), counts.tolist()):
                writer.add(doc_id, n + 1)
        if writer is not None:
            writer.close()
            out.close()
            yield pa.RecordBatch.from_pydict({"path": [path], "part": [task.partitionId()], "n_docs": [len(writer.docs)], "n_ids": [writer.n_ids]})

    return stored(placed.mapInArrow(write, MANIFEST), "planes-manifest")


def read_token_files(manifest: DataFrame) -> DataFrame:
    """Per document what the files hold: doc_id, start (ids before it in all files), n_tokens, ids_crc32.

    One row per file decides its place; the ids themselves are read by tasks that take
    whole files each and hold one block at a time.
    """
    before = F.coalesce(F.sum("n_ids").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, at in zip(batch.column("path").to_pylist(), batch.column("before").to_pylist()):
                system, inner = _opened(path)
                with system.open_input_file(inner) as f:
                    rows = []
                    for doc_id, start, n, crc in PlaneReader(f, f.size()).documents():
                        rows.append((doc_id, at + start, n, crc))
                        if len(rows) >= 10_000:
                            yield _rows(rows)
                            rows = []
                    if rows:
                        yield _rows(rows)

    files = manifest.select("path", before.alias("before"))
    return files.repartition(max(1, manifest.count()), "path").mapInArrow(read, READ)


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())]
    return pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, (_, t) in zip(zip(*rows), kinds)], schema=pa.schema(kinds))
