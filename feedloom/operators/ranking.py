"""Ranking, top-k and positions. Ties break on id, so results repeat."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedloom.functions.values import SEED
from feedloom.session import shared_folder


def rank_by_score(posts: DataFrame) -> DataFrame:
    return posts.orderBy(F.desc("preds"), "id")


def top_n(posts: DataFrame, n: int) -> DataFrame:
    """The first ``n`` by score with their 1-based ``position``.

    The limit keeps ``n`` rows per task and then overall; positions are numbered on
    those ``n`` rows only.
    """
    order = Window.orderBy(F.desc("preds"), "id")
    return rank_by_score(posts).limit(n).withColumn("position", F.row_number().over(order).cast("bigint"))


def positions(posts: DataFrame) -> DataFrame:
    """All rows with their 1-based ``position`` by score, whatever their number.

    Rows are dealt out by ranges of (score, id), so that the score of a third of all rows is cut by id, and each task sorts
    its own range. The ranges are stored, with every row's place in its range; the driver gets a count per range, and their running
    sums turn places into positions. NULL scores come last; rows that share score and id stand beside each other in any order.
    """
    spark = posts.sparkSession
    part, place = spare_names(posts, "range", "place")
    dealt = posts.repartitionByRange(F.desc("preds"), "id").sortWithinPartitions(F.desc("preds"), "id")
    # the low 33 bits number the rows of a task
    dealt = dealt.select("*", F.spark_partition_id().alias(part), F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1).alias(place))
    path = shared_folder(spark, "positions")
    dealt.write.parquet(path)
    dealt = spark.read.schema(dealt.schema).parquet(path)
    starts, start = [], 0
    for r in sorted(dealt.groupBy(part).count().collect()):
        starts.append((r[0], start))
        start += r[1]
    of, begin = spare_names(dealt, "of", "begin")
    met = dealt.join(F.broadcast(spark.createDataFrame(starts, f"{of} int, {begin} bigint")), F.col(part) == F.col(of))
    return met.select(*posts.columns, (F.col(begin) + F.col(place) + 1).alias("position"))


def spare_names(df: DataFrame, *names: str) -> list[str]:
    """The names, with underscores before them until no column of ``df`` is called so."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name in taken:
            name = f"_{name}"
        out.append(name)
    return out


def page(positioned: DataFrame, number: int, size: int) -> DataFrame:
    """Page ``number`` (from 0) of rows with positions, ``size`` to a page, in order."""
    if number < 0 or size < 1:
        raise ValueError("a page has a number from 0 on and at least one row")
    return positioned.where(F.col("position").between(number * size + 1, (number + 1) * size)).orderBy("position")


def top_per_group(df: DataFrame, group: Sequence[str], order: Sequence[Column], k: int) -> DataFrame:
    """The first ``k`` rows of each group with their ``rank``.

    Each task keeps its own first ``k`` per group before the shuffle, so a group of any
    size moves at most ``k`` rows per task.
    """
    window = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn("rank", F.row_number().over(window)).where(F.col("rank") <= k).withColumn("rank", F.col("rank").cast("bigint"))


def stratified_fold(df: DataFrame, label: str, key: str, folds: int = 5, seed: int = SEED, slot_digits: int = 3) -> DataFrame:
    """Add ``fold``: each label dealt out evenly, in the order of a seeded hash.

    Rows are numbered in two steps, so a label is never sorted in one task: rows fall in
    hash slots, slots get their starting number from their counts (16**slot_digits rows
    per label), and each slot numbers its own rows.
    """
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))
    slotted = df.withColumn("_digest", digest).withColumn("_slot", F.substring("_digest", 1, slot_digits))
    before = Window.partitionBy(label).orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        slotted.groupBy(label, "_slot")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select(
            F.col(label).alias("_label"),
            F.col("_slot").alias("_of"),
            F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"),
        )
    )
    inside = Window.partitionBy(label, "_slot").orderBy("_digest", key)
    numbered = slotted.withColumn("_row", F.row_number().over(inside) - 1)
    placed = numbered.join(starts, (F.col(label) == F.col("_label")) & (F.col("_slot") == F.col("_of")))
    return placed.withColumn("fold", F.pmod(F.col("_start") + F.col("_row"), F.lit(folds)).cast("int")).select(*df.columns, "fold")


def release_unseen(delivery_log: DataFrame, batch: DataFrame, read_up_to: int) -> DataFrame:
    """The log without the batch's posts after position ``read_up_to``: they may return."""
    unread = batch.where(F.col("position") > read_up_to).select(F.col("post_id").alias("_unread"))
    return delivery_log.join(unread, F.col("post_id") == F.col("_unread"), "left_anti")
