"""Joins that hold when one key carries a large share of the rows.

Sides are broadcast only after a bounded count of rows and bytes. Past the limit, rows of hot keys are cut into
pieces: the large side picks one piece per row, the other side repeats the hot rows once
per piece. Nothing is dropped, and no task receives a whole hot key.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

INLINE_VALUES = 1_000
BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 64 << 20
ROWS_PER_PIECE = 1_000_000
HOT_KEYS = 20_000


def fits_broadcast(df: DataFrame, limit: int = BROADCAST_ROWS, most_bytes: int = BROADCAST_BYTES) -> bool:
    """Whether a table is small enough to broadcast; reads no more than ``limit + 1`` of its rows."""
    strings = [F.coalesce(F.octet_length(f.name), F.lit(0)) for f in df.schema if f.dataType.typeName() == "string"]
    width = reduce(Column.__add__, strings, F.lit(16 * len(df.columns)))
    size = df.limit(limit + 1).agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(width.cast("bigint")), F.lit(0)).alias("bytes")).first()
    return size["rows"] <= limit and size["bytes"] <= most_bytes


def key_load(df: DataFrame, *keys: str) -> DataFrame:
    """Rows per key, as the key columns and ``load``."""
    return df.where(_any_null(keys) == F.lit(False)).groupBy(*keys).agg(F.count(F.lit(1)).alias("load"))


def _any_null(keys: Sequence[str]) -> Column:
    return reduce(Column.__or__, [F.col(k).isNull() for k in keys])


def hot_keys(load: DataFrame, rows_per_piece: int = ROWS_PER_PIECE) -> DataFrame:
    """Keys with more rows than one task should take, and the pieces to cut each into.

    The threshold is at least ``total / HOT_KEYS``, so fewer than HOT_KEYS keys pass it:
    that bound is what makes the result safe to broadcast.
    """
    total = load.agg(F.coalesce(F.sum("load"), F.lit(0))).scalar()
    threshold = F.greatest(F.lit(rows_per_piece).cast("double"), total / F.lit(HOT_KEYS))
    keys = [c for c in load.columns if c != "load"]
    return load.where(F.col("load") > threshold).select(*keys, F.ceil(F.col("load") / threshold).alias("_pieces"))


def spread_join(
    left: DataFrame,
    right: DataFrame,
    on: dict[str, str],
    how: str,
    spread_by: Sequence[str],
    load: DataFrame | None = None,
    rows_per_piece: int = ROWS_PER_PIECE,
) -> DataFrame:
    """Equi-join whose hot left keys are cut into pieces.

    ``on`` maps left to right key columns; the names must not overlap. ``spread_by``
    names left columns that differ between rows of one key. NULL left keys match nothing
    and are spread as well. Right columns are part of the result only for inner and left
    joins. ``load`` is the row count per left key where the caller has it already.
    """
    loads = key_load(left, *on) if load is None else load
    hot = hot_keys(loads.withColumnsRenamed({k: f"_hot_{k}" for k in on}), rows_per_piece)
    hot = F.broadcast(hot)

    def with_pieces(df: DataFrame, keys: Sequence[str]) -> DataFrame:
        return df.join(hot, [F.col(k) == F.col(f"_hot_{of}") for k, of in zip(keys, on)], "left")

    slot = F.xxhash64(*spread_by)
    piece = (
        F.when(_any_null(list(on)), F.pmod(slot, F.lit(65_536)))
        .when(F.col("_pieces").isNotNull(), F.pmod(slot, F.col("_pieces")))
        .otherwise(F.lit(0).cast("bigint"))
    )
    copies = F.explode(F.sequence(F.lit(0).cast("bigint"), F.coalesce(F.col("_pieces"), F.lit(1)) - 1))
    spare = [*hot.columns]
    cut_left = with_pieces(left, list(on)).withColumn("_piece", piece).drop(*spare)
    cut_right = with_pieces(right, list(on.values())).withColumn("_copy", copies).drop(*spare)
    matched = [F.col(a) == F.col(b) for a, b in on.items()] + [F.col("_piece") == F.col("_copy")]
    return cut_left.join(cut_right, matched, how).drop("_piece", "_copy")


def _by_membership(df: DataFrame, key: str, members: DataFrame | Sequence, how: str, spread_by: Sequence[str]) -> DataFrame:
    if not isinstance(members, DataFrame):
        values = list(members)
        if len(values) <= INLINE_VALUES:
            inside = F.col(key).isin(*values) if values else F.lit(False)
            return df.where(inside if how == "left_semi" else ~F.coalesce(inside, F.lit(False)))
        members = df.sparkSession.createDataFrame([(v,) for v in values], f"member {df.schema[key].dataType.simpleString()}")
    named = members.select(F.col(members.columns[0]).alias("_member")).where(F.col("_member").isNotNull())
    if fits_broadcast(named):
        return df.join(F.broadcast(named), F.col(key) == F.col("_member"), how)
    return spread_join(df, named.distinct(), {key: "_member"}, how, spread_by)


def keep_members(df: DataFrame, key: str, members: DataFrame | Sequence, spread_by: Sequence[str] = ("id",)) -> DataFrame:
    """Rows whose key is listed. ``members`` is a list or a table (first column)."""
    return _by_membership(df, key, members, "left_semi", spread_by)


def drop_members(df: DataFrame, key: str, members: DataFrame | Sequence, spread_by: Sequence[str] = ("id",)) -> DataFrame:
    """Rows whose key is not listed; a NULL key is never listed, so its row stays."""
    return _by_membership(df, key, members, "left_anti", spread_by)


def keep_last(df: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """One row per key: the one with the greatest ``order``, which must be unique per key.

    ``max_by`` combines before the shuffle, so copies of one key never meet in one task.
    """
    rest = [c for c in df.columns if c not in keys]
    if len(rest) == 2:
        value = next(c for c in rest if c != order)
        return df.groupBy(*keys).agg(F.max_by(value, order).alias(value), F.max(order).alias(order)).select(*df.columns)
    latest = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("_row"))
    return latest.select(*[F.col(k) for k in keys], "_row.*").select(*df.columns)


def has_duplicates(df: DataFrame, key: str) -> Column:
    """Scalar flag: some key occurs more than once."""
    most = df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n"))
    return F.coalesce(most.scalar(), F.lit(0)) > 1
