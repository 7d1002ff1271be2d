"""Incremental jobs. Each takes a stream, works per micro-batch, and may be restarted.

A micro-batch writes a directory named after its batch id in overwrite mode, so replaying a batch gives the same
table. What has passed before is known from the stream's own state (scores, feed), kept in RocksDB with its changes in the
checkpoint folder, or from key sketches of the stored days (ingest); no micro-batch reads the table it appends to, but
for days in which a key may repeat.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from feedloom import schema
from feedloom.operators.filters import in_language, no_reposts
from feedloom.operators.joins import drop_members, keep_last
from feedloom.operators.lookups import drop_seen
from feedloom.operators.sketches import key_sketch, maybe_held
from feedloom.plans.scoring import Scorer, scorable
from feedloom.sources.sinks import DAY, append_batch, append_sketch, compact_batches, compacted, read_batch, read_batches, read_sketches, unsketched


def file_stream(spark: SparkSession, path: str, columns: StructType, files_per_trigger: int | None = None) -> DataFrame:
    """Parquet files as they land."""
    reader = spark.readStream.schema(columns)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


#: Settings of state that outgrows memory: RocksDB, of which a checkpoint stores the changes.
STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


@contextmanager
def _settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def run_available(stream: DataFrame, work, checkpoint: str) -> StreamingQuery:
    """Process what has landed, batch by batch, then stop."""
    with _settings(stream.sparkSession, STATE):
        query = (
            stream.writeStream.foreachBatch(work)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
    return query


def first_seen(stream: DataFrame, key: str) -> DataFrame:
    """The first row of every key over the whole stream, by keyed state; rows without a key are all kept."""
    once = stream.where(F.col(key).isNotNull()).dropDuplicates([key])
    return once.unionByName(stream.where(F.col(key).isNull()))


def _once(batch: DataFrame, key: str) -> DataFrame:
    """One row per key; rows without a key are all kept, here as against earlier batches."""
    return batch.where(F.col(key).isNotNull()).dropDuplicates([key]).unionByName(batch.where(F.col(key).isNull()))


def ingest(stream: DataFrame, key: str, path: str, checkpoint: str, event_time: str | None = None) -> StreamingQuery:
    """Append rows whose key has not landed before, however late they arrive.

    Keys are compared with what is stored, not with bounded state, so no late row is
    lost and no old one returns. Rows without a key cannot repeat one, so all are kept. Where
    a row's ``event_time`` never changes, naming it stores batches by day, and only the days that the batch holds count:
    a late row adds its own day, not all between. Each batch leaves a sketch of its keys; a batch is held against the sketches
    first, and the table is read only for days in which some key may repeat. ``compact`` merges stored batches.
    """
    columns = stream.schema

    def work(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        merged = compacted(spark, path)
        if merged is not None and batch_id <= merged:
            return  # replayed after it was merged: its rows are there
        day = F.to_date(event_time) if event_time else F.lit(None).cast("date")
        group = F.coalesce(day.cast("string"), F.lit(""))
        batch = batch.persist()
        try:
            once = _once(batch, key)
            keys = once.select(group.alias("group"), F.col(key).alias("key"))
            if unsketched(spark, path, batch_id):  # stored before there were sketches: all may repeat
                maybe = keys.select("key", "group").distinct().persist()
            else:
                maybe = maybe_held(keys, read_sketches(spark, path).where(F.col("batch_id") < batch_id)).persist()
            groups = [r["group"] for r in maybe.select("group").distinct().collect()]
            if groups:
                stored = read_batches(spark, path, columns, by_day=event_time is not None).where(F.col("batch_id") < batch_id)
                if event_time:
                    days = F.col(DAY).cast("string").isin([g for g in groups if g])
                    stored = stored.where(days | F.col(DAY).isNull() if "" in groups else days)
                known = stored.select(F.col(key).alias("_known")).join(maybe.select(F.col("key").alias("_maybe")), F.col("_known") == F.col("_maybe"), "left_semi")
                once = drop_members(once, key, known, spread_by=[key])
            append_batch(once, path, batch_id, event_time)
            written = read_batch(spark, path, columns, batch_id, event_time is not None)
            append_sketch(key_sketch(written.select(group.alias("group"), F.col(key).alias("key"))), path, batch_id)
            maybe.unpersist()
        finally:
            batch.unpersist()

    return run_available(stream, work, checkpoint)


def compact(spark: SparkSession, path: str, columns: StructType, upto: int, key: str, event_time: str | None = None) -> bool:
    """Merge the batches up to ``upto`` of an ``ingest`` table, and their sketches with them. Run it between batches."""
    if not compact_batches(spark, path, columns, upto, by_day=event_time is not None):
        return False
    day = F.to_date(event_time) if event_time else F.lit(None).cast("date")
    merged = read_batches(spark, path, columns, by_day=event_time is not None).where(F.col("batch_id") <= upto)
    append_sketch(key_sketch(merged.select(F.coalesce(day.cast("string"), F.lit("")).alias("group"), F.col(key).alias("key"))), path, upto, merged=True)
    return True


def ingest_within(stream: DataFrame, key: str, event_time: str, delay: str, path: str, checkpoint: str) -> StreamingQuery:
    """As ``ingest``, with state bounded by a watermark instead of a look at the table.

    Rows later than ``delay`` are outside the contract; pick a delay that covers the
    source, or use ``ingest``.
    """
    deduplicated = stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark([key])
    query = (
        deduplicated.writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(path)
    )
    query.awaitTermination()
    return query


def score(stream: DataFrame, scorer: Scorer, path: str, checkpoint: str, static_log: DataFrame | None = None, lang: str = "en") -> StreamingQuery:
    """Score eligible posts that have no score yet and append the scores.

    Eligible are those a batch run would score: no reposts, one language, not delivered. A post that becomes eligible later
    is scored then; one that was scored is known to the stream's state.
    """

    def work(batch: DataFrame, batch_id: int) -> None:
        append_batch(scorer(scorable(batch, static_log, lang)).select("id", "predicted"), path, batch_id)

    return run_available(first_seen(in_language(no_reposts(stream), lang), "id"), work, checkpoint)


def stored_scores(spark: SparkSession, path: str) -> DataFrame:
    """The current score per id."""
    return keep_last(read_batches(spark, path, schema.SCORES), ["id"], "batch_id").select("id", "predicted")


def feed(stream: DataFrame, static_log: DataFrame, path: str, checkpoint: str, lang: str = "en") -> StreamingQuery:
    """Append eligible posts to the delivery log once, skipping what any log holds. Only ids are moved; texts stay where they are."""

    def work(batch: DataFrame, batch_id: int) -> None:
        fresh = drop_seen(batch, static_log.select("post_id"))
        append_batch(fresh.select(F.col("id").alias("post_id"), F.lit("no_errors").alias("err_reason")), path, batch_id)

    return run_available(first_seen(in_language(no_reposts(stream), lang).select("id"), "id"), work, checkpoint)
