"""Key sketches: which keys a stored batch may hold, in about ten bits a key.

A Bloom filter in blocks of 32,768 bits. A key belongs to one block of its group (here a day), and sets PROBES bits there; a key
that lacks one of them anywhere is new for sure. Bits are combined in the JVM, by aggregates; a look joins keys with
their blocks, so neither side is broadcast or collected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of a block, as the built-in bitmap aggregate makes them.
BLOCK_BITS = 32_768
BITS_PER_KEY = 10
PROBES = 6

SKETCH = "group string, blocks int, block int, bits binary"


def _block(key: Column, blocks: Column) -> Column:
    return F.pmod(F.xxhash64(key), blocks).cast("int")


def _probe(key: Column, n: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(n)), F.lit(BLOCK_BITS)).cast("int")


def key_sketch(keys: DataFrame) -> DataFrame:
    """``keys(group, key)`` to a row per group and block: group, blocks, block, bits. NULL keys are left out."""
    keys = keys.where(F.col("key").isNotNull()).select(F.coalesce("group", F.lit("")).alias("group"), "key")
    sizes = keys.groupBy(F.col("group").alias("_group")).agg(F.greatest(F.lit(1), F.ceil(F.count(F.lit(1)) * BITS_PER_KEY / BLOCK_BITS)).cast("int").alias("blocks"))
    placed = keys.join(sizes, F.col("group") == F.col("_group")).withColumn("block", _block(F.col("key"), F.col("blocks")))
    bits = placed.select("group", "blocks", "block", F.explode(F.array(*[_probe(F.col("key"), n) for n in range(PROBES)])).alias("bit"))
    return bits.groupBy("group", "blocks", "block").agg(F.bitmap_construct_agg("bit").alias("bits"))


def maybe_held(keys: DataFrame, sketches: DataFrame) -> DataFrame:
    """The distinct ``keys(group, key)`` that some row of ``sketches`` may hold, as (key, group); all others are new."""
    keys = keys.where(F.col("key").isNotNull()).select(F.coalesce("group", F.lit("")).alias("group"), "key").distinct()
    shapes = sketches.select(F.col("group").alias("_group"), F.col("blocks").alias("_blocks")).distinct()
    placed = keys.join(shapes, F.col("group") == F.col("_group")).withColumn("_block", _block(F.col("key"), F.col("_blocks")))
    held = sketches.select(F.col("group").alias("_of"), F.col("blocks").alias("_in"), "block", "bits")
    same = (F.col("group") == F.col("_of")) & (F.col("_blocks") == F.col("_in")) & (F.col("_block") == F.col("block"))
    met = placed.join(held, same)
    for n in range(PROBES):
        bit = _probe(F.col("key"), n)
        byte = F.conv(F.hex(F.substring("bits", F.shiftright(bit, 3) + 1, F.lit(1))), 16, 10).cast("int")
        met = met.where(F.getbit(byte, F.pmod(bit, F.lit(8))) == 1)
    return met.select("key", "group").distinct()
