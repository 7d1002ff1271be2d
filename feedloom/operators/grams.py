"""A rarest-gram index: which texts of a table hold which of very many words.

A word occurs only where each of its grams does, so the gram that the corpus has least often tells the
few places worth a look. Texts and words are compared as bytes, where a place is a number and a look at it costs the
word's length, whatever the text's:

1. the grams of all words that occur in the texts are counted, in one pass;
2. each word takes its rarest gram, with the gram's offset in the word; a word with a gram that never occurs is out;
3. in a second pass every place of a chosen gram gives (text, place) pairs, as integers;
4. the word is compared with the bytes at its place, beside the text.

The passes find places in tasks, on arrays of bytes; a bitmap of fixed size keeps places of other grams from becoming rows, and a join
decides on what it lets pass. The counts of step 1 say exactly how many places step 3 yields, so whether they can be broadcast to the
texts is known before it runs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.operators.joins import BROADCAST_BYTES, BROADCAST_ROWS, fits_broadcast, spread_join
from feedloom.session import shared_folder

#: Bytes of a gram; shorter words are one gram of their own length.
GRAM = 4
#: The bitmap has two to this power bits.
BITS = 18

_MIX = np.uint64(0x9E3779B97F4A7C15)


def grams_of(data: bytes, size: int) -> np.ndarray:
    """The grams of ``size`` bytes of a byte string, in their order, as numbers that also tell their size."""
    raw = np.frombuffer(data, dtype=np.uint8)
    n = len(raw) - size + 1
    if n < 1:
        return np.empty(0, dtype=np.int64)
    out = raw[:n].astype(np.int64)
    for k in range(1, size):
        out |= raw[k : n + k].astype(np.int64) << (8 * k)
    return out | (size << 32)


def _slots(grams: np.ndarray) -> np.ndarray:
    return (grams.view(np.uint64) * _MIX) >> np.uint64(64 - BITS)


def _marks(wanted: DataFrame) -> np.ndarray:
    """Which slots of the bitmap the grams of ``wanted(of)`` take."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(1 << BITS, dtype=bool)
        for batch in batches:
            held[_slots(batch.column("of").to_numpy())] = True
        yield pa.RecordBatch.from_pydict({"slot": pa.array(np.flatnonzero(held), pa.int64())})

    marks = np.zeros(1 << BITS, dtype=bool)
    marks[[r["slot"] for r in wanted.select("of").mapInArrow(run, "slot long").distinct().collect()]] = True
    return marks


def _word_grams(sized: DataFrame) -> DataFrame:
    """(word, at, gram) for ``sized(word, needle, size)``; places count from 1."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [grams_of(data, size) for data, size in zip(batch.column("needle").to_pylist(), batch.column("size").to_pylist())]
            of = np.repeat(np.arange(len(found)), [len(g) for g in found])
            at = np.concatenate([np.arange(1, len(g) + 1) for g in found]) if found else np.empty(0, np.int64)
            grams = np.concatenate(found) if found else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("word").take(pa.array(of, pa.int64())), pa.array(at, pa.int64()), pa.array(grams, pa.int64())], names=["word", "at", "gram"])

    return sized.select("word", "needle", "size").mapInArrow(run, "word string, at long, gram long")


def _scanned(texts: DataFrame, sizes: list[int], marks: np.ndarray, counting: bool) -> DataFrame:
    """Marked grams of ``texts(_text, data)``: (gram, times), combined by batch, or a row (_text, gram, at) per place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            grams, places, times = [np.empty(0, np.int64)], [np.empty(0, np.int64)], []
            for data in batch.column("data").to_pylist():
                of_text = 0
                for size in sizes:
                    every = grams_of(data, size)
                    at = np.flatnonzero(marks[_slots(every)])
                    grams.append(every[at])
                    places.append(at + 1)
                    of_text += len(at)
                times.append(of_text)
            found = np.concatenate(grams)
            if counting:
                kinds, n = np.unique(found, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(kinds), pa.array(n.astype(np.int64))], names=["gram", "n"])
            else:
                of = np.repeat(batch.column("_text").to_numpy(), times)
                yield pa.RecordBatch.from_arrays([pa.array(of), pa.array(found), pa.array(np.concatenate(places))], names=["_text", "gram", "at"])

    return texts.select("_text", "data").mapInArrow(run, "gram long, n long" if counting else "_text long, gram long, at long")


def _met(places: DataFrame, wanted: DataFrame, small: bool, spread_by: list[str]) -> DataFrame:
    """``places`` with the columns of ``wanted(of, ...)`` for their grams."""
    if small:
        return places.join(F.broadcast(wanted), F.col("gram") == F.col("of")).drop("of")
    return spread_join(places, wanted, {"gram": "of"}, "inner", spread_by).drop("of")


def words_in_texts(texts: DataFrame, needles: DataFrame) -> DataFrame:
    """(digest, word) pairs, each once: which of ``texts(digest, data)`` hold which of ``needles(word, needle)``.

    ``data`` and ``needle`` are binary, ``needle`` is never empty, ``digest`` stands for the text, and equal digests for equal texts.
    NULL texts hold nothing.
    """
    sized = needles.withColumn("size", F.least(F.octet_length("needle"), F.lit(GRAM)))
    sizes = sorted(r["size"] for r in sized.select("size").distinct().collect())
    nothing = texts.select("digest", F.lit("").alias("word")).where(F.lit(False))
    if not sizes:
        return nothing
    keyed = texts.where(F.col("data").isNotNull()).withColumn("_text", F.xxhash64("data"))  # a clash costs a look at one text more

    # 1. the words' grams, and how often the texts have each
    of_words = _word_grams(sized)
    wanted = of_words.select(F.col("gram").alias("of")).distinct()
    counts = _scanned(keyed, sizes, _marks(wanted), True).groupBy(F.col("gram").alias("of")).agg(F.sum("n").alias("times"))

    # 2. each word's rarest gram; stored, as the passes above must not run again for it
    times = F.coalesce("times", F.lit(0).cast("bigint"))
    per_word = of_words.join(counts, F.col("gram") == F.col("of"), "left").groupBy("word").agg(F.min(F.struct(times.alias("times"), "at", "gram")).alias("r"))
    rarest = per_word.where(F.col("r.times") > 0).select(F.col("word").alias("_word"), F.col("r.gram").alias("of"), F.col("r.at").alias("offset"), F.col("r.times").alias("times"))
    chosen = needles.join(rarest, F.col("word") == F.col("_word")).select("of", "word", "needle", "offset", "times")
    path = shared_folder(texts.sparkSession, "rarest-grams")
    chosen.write.parquet(path)
    chosen = texts.sparkSession.read.schema(chosen.schema).parquet(path)
    size = chosen.agg(F.count(F.lit(1)).alias("words"), F.sum("times").alias("places"), F.sum(F.col("times") * (F.octet_length("needle") + 48)).alias("bytes")).first()
    if not size["words"]:
        return nothing

    # 3. their places, 4. the look
    found = _scanned(keyed, sizes, _marks(chosen), False)
    places = _met(found, chosen.drop("times"), fits_broadcast(chosen), ["_text", "at"])
    places = places.select(F.col("_text").alias("_of"), "word", "needle", (F.col("at") - F.col("offset") + 1).cast("int").alias("_start")).where(F.col("_start") > 0)
    holds = F.substring("data", F.col("_start"), F.octet_length("needle")) == F.col("needle")
    if size["places"] <= BROADCAST_ROWS and size["bytes"] <= BROADCAST_BYTES:
        met = keyed.join(F.broadcast(places), (F.col("_text") == F.col("_of")) & holds)
    else:
        marked = keyed.join(places.select("_of").distinct(), F.col("_text") == F.col("_of"), "left_semi").dropDuplicates(["digest"])
        met = spread_join(places, marked, {"_of": "_text"}, "inner", ["word", "_start"]).where(holds)
    return met.select("digest", "word").distinct()
