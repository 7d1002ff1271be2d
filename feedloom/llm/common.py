"""Small helpers that several operators of this subpackage share."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.session import shared_folder

#: Texts taken from an Arrow batch at once, so that temporaries stay small beside long texts.
SLICE_BYTES = 4 << 20
#: Rows of an Arrow batch that may hold whole texts.
BATCH_ROWS = 500
ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, purpose: str, batch_rows: int = BATCH_ROWS) -> DataFrame:
    """Write a table below the shared folder and read it back: its lineage ends there.

    ``batch_rows`` bounds the Arrow batches of the writing, where rows are wide.
    """
    spark, path = df.sparkSession, shared_folder(df.sparkSession, purpose)
    with arrow_batches(spark, batch_rows):
        df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def arrow_batches(spark: SparkSession, rows: int) -> Iterator[None]:
    """At most ``rows`` rows in an Arrow batch: Spark bounds batches by rows, and texts may be long."""
    before = spark.conf.get(ARROW_ROWS)
    spark.conf.set(ARROW_ROWS, str(min(rows, int(before))))
    try:
        yield
    finally:
        spark.conf.set(ARROW_ROWS, before)


def spare(df: DataFrame, *names: str) -> list[str]:
    """The names, with underscores before them until no column of ``df`` is called so."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def held_out(key: Column) -> Column:
    """Rows that no fit may learn from: crc32 of the id as text, modulo 5, is 0.

    A NULL id counts as held out, so it is never learned from.
    """
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def labelled_sample(docs: DataFrame, labels: DataFrame, documents: int, purpose: str) -> DataFrame:
    """Texts for a fit, as (o, text, label): the first ``documents`` rows of ``labels(doc_id, label)`` in a hash order.

    Only ids are ordered; the chosen ones, at most ``documents``, are broadcast to one scan
    of the texts. NULL ids, labels and texts teach nothing; a repeated id teaches once per row.
    """
    known = labels.select("doc_id", F.col("label").cast("int").alias("label")).where(F.col("doc_id").isNotNull() & F.col("label").isNotNull())
    order = F.xxhash64("doc_id")
    chosen = known.withColumn("o", order).orderBy("o", "doc_id", "label").limit(documents).select(F.col("doc_id").alias("_id"), "o", "label")
    texts = docs.select("doc_id", "text").where(F.col("text").isNotNull())
    return stored(texts.join(F.broadcast(chosen), F.col("doc_id") == F.col("_id")).select("o", "text", "label"), purpose)


def bitmap(df: DataFrame, slot: Column, bits: int) -> np.ndarray:
    """Which of ``2 ** bits`` slots occur, as booleans packed in 64-bit words: its size does not depend on ``df``.

    Words are combined on the executors, so the driver gets ``2 ** (bits - 6)`` rows at most.
    """
    at = df.select(F.pmod(slot, F.lit(1 << bits)).alias("s"))
    words = at.groupBy(F.shiftright("s", 6).alias("w")).agg(F.expr("bit_or(shiftleft(1L, cast(s & 63 as int)))").alias("bits")).toArrow()
    out = np.zeros(1 << max(0, bits - 6), dtype=np.int64)
    out[words.column("w").to_numpy()] = words.column("bits").to_numpy()
    return out.view(np.uint64)


def slots_set(words: np.ndarray, slots: np.ndarray) -> np.ndarray:
    """Whether each of ``slots`` (unsigned) is set in a bitmap."""
    return (words[slots >> np.uint64(6)] >> (slots & np.uint64(63))) & np.uint64(1) != 0


def slices(batch: pa.RecordBatch, column: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows whose ``column`` holds about ``most`` bytes, one row at least."""
    at, size = 0, 0
    lengths = [0 if n is None else n for n in pc.binary_length(batch.column(column)).to_pylist()]
    for i, n in enumerate(lengths):
        if i > at and size + n > most:
            yield batch.slice(at, i - at)
            at, size = i, 0
        size += n
    if at < len(lengths):
        yield batch.slice(at)


def gathered(batches: Iterable[pa.RecordBatch], column: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of all batches, in order, in runs whose ``column`` holds about ``most`` bytes, one row at least."""
    held, size = [], 0
    for batch in batches:
        for part in slices(batch, column, most):
            n = pc.sum(pc.binary_length(part.column(column))).as_py() or 0
            if held and size + n > most:
                yield pa.concat_batches(held)
                held, size = [], 0
            held.append(part)
            size += n
    if held:
        yield pa.concat_batches(held)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Hand this package to the executors' Python, once per application, and bound Arrow batches.

    The catalogue calls it; a cluster that has the package installed needs only the bound.
    """
    spark.conf.set(ARROW_ROWS, str(min(BATCH_ROWS, int(spark.conf.get(ARROW_ROWS)))))
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    package = Path(__file__).resolve().parent.parent
    target = Path(tempfile.mkdtemp(prefix="feedloom-package-")) / f"{package.name}.zip"
    with zipfile.ZipFile(target, "w") as z:
        for file in sorted(package.rglob("*.py")):
            z.write(file, file.relative_to(package.parent))
    spark.sparkContext.addPyFile(str(target))
    _SHIPPED.add(app)
