"""A keyed table whose upserts rewrite only the buckets they touch.

Rows lie in hash buckets of their key. A version is a small manifest: for every bucket that has rows, the version
whose folder holds it. An upsert merges the fresh rows with the touched buckets alone, writes those
under its own version, and points to a manifest that takes the others over as they were. Readers see one
manifest or the next, never a half-written one; earlier versions stay readable, as no folder is changed once it is written.

The number of buckets is fixed when a table is made and bounds the manifest: choose it so that a bucket is a
file of good size at the table's full size.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from feedloom.operators.quality import Check, enforce_metrics, measured
from feedloom.sources.sinks import POINTER, current_version, replace_text
from feedloom.sources.tables import empty

#: Buckets of a new table.
BUCKETS = 64
_BUCKET = "key_bucket"
_MANIFEST = "key_bucket int, held_by bigint, buckets int"


def bucket_of(key: str | Column, buckets: int) -> Column:
    """The bucket of a key; a NULL key has one too."""
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def manifest(spark: SparkSession, root: str, version: int | None = None) -> dict[int, int]:
    """Which version's folder holds each bucket of a version (the current one); empty before the first."""
    return {r["key_bucket"]: r["held_by"] for r in _manifest(spark, root, version) if r["held_by"] is not None}


def _manifest(spark: SparkSession, root: str, version: int | None) -> list:
    version = version or current_version(spark, root)
    return [] if version is None else spark.read.schema(_MANIFEST).json(f"{root}/manifest={version}").collect()


def read_buckets(spark: SparkSession, root: str, columns: StructType, version: int | None = None, only: set[int] | None = None) -> DataFrame:
    """A version's rows (the current one's), or those of some buckets."""
    held = manifest(spark, root, version)
    paths = [f"{root}/version={v}/{_BUCKET}={b}" for b, v in sorted(held.items()) if only is None or b in only]
    return spark.read.schema(columns).parquet(*paths) if paths else empty(spark, columns)


def upsert_buckets(
    fresh: DataFrame,
    root: str,
    key: str,
    merge: Callable[[DataFrame, DataFrame], DataFrame],
    columns: StructType,
    checks: tuple[Check, ...] = (),
    buckets: int = BUCKETS,
) -> int | None:
    """Publish the next version: ``merge(stored, fresh)`` in the buckets that ``fresh`` touches, all others as they are.

    ``merge`` must decide by key. ``checks`` are measured while the rows are written, key uniqueness by bucket; if one fails, nothing becomes
    current and the folder is left to the next attempt, which overwrites it. ``buckets`` counts only when the table is made. One writer at a time.
    Returns the version, or None where ``fresh`` has no rows.
    """
    spark = fresh.sparkSession
    before = current_version(spark, root)
    rows = _manifest(spark, root, before)
    buckets = rows[0]["buckets"] if rows else buckets
    held = {r["key_bucket"]: r["held_by"] for r in rows if r["held_by"] is not None}
    touched = {r["b"] for r in fresh.select(bucket_of(key, buckets).alias("b")).distinct().collect()}
    if not touched:
        return None
    stored = read_buckets(spark, root, columns, before, touched)
    version = (before or 0) + 1
    merged = merge(stored, fresh).select(*columns.names).withColumn(_BUCKET, bucket_of(key, buckets))
    watched, metrics = measured(merged.repartition(buckets, _BUCKET), checks, (_BUCKET,))
    # a failed attempt's buckets must not stay beside this one's
    watched.write.mode("overwrite").partitionBy(_BUCKET).parquet(f"{root}/version={version}")
    enforce_metrics(metrics, checks)
    written = {int(r[_BUCKET]) for r in spark.read.parquet(f"{root}/version={version}").select(_BUCKET).distinct().collect()}
    now = {**{b: v for b, v in held.items() if b not in touched}, **{b: version for b in written}}
    entries = [(b, v, buckets) for b, v in sorted(now.items())] or [(0, None, buckets)]
    spark.createDataFrame(entries, _MANIFEST).coalesce(1).write.mode("overwrite").json(f"{root}/manifest={version}")
    replace_text(spark, f"{root}/{POINTER}", str(version))
    return version
