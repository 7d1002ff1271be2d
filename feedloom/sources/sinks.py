"""Writers: append by batch, publish by version, fingerprint.

A batch is a directory written in overwrite mode, so a retried batch replaces itself. A
version is a new directory, checked before a pointer file is renamed over to make it current, so
readers never see a half-written or a failed table and the previous version stays as the backup.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, LongType, StructField, StructType

from feedloom.operators.quality import Check, enforce_metrics, measured
from feedloom.operators.sketches import SKETCH
from feedloom.schema import REJECTED_DUMP_ABOVE
from feedloom.session import shared_folder
from feedloom.sources.tables import empty, exists

POINTER = "CURRENT"
MERGED = "_MERGED"
DAY = "stored_day"
#: Mean size of a JSON array file, once an export is larger than one.
ARRAY_BYTES = 8 << 20
#: Strings of one array of an exported list.
LIST_STRINGS = 100_000


def append_batch(df: DataFrame, path: str, batch_id: int, day_of: str | None = None) -> None:
    """Write a batch into its own directory; by the day of a time column, where one is named."""
    target = f"{path}/batch_id={batch_id}"
    if day_of is None:
        df.write.mode("overwrite").parquet(target)
    else:
        df.withColumn(DAY, F.to_date(day_of)).write.mode("overwrite").partitionBy(DAY).parquet(target)


def read_batches(spark: SparkSession, path: str, columns: StructType, by_day: bool = False) -> DataFrame:
    """All batches with their ``batch_id`` (and their day, for batches written by day); empty before the first.

    Batches that ``compact_batches`` has merged are read from where it put them.
    """
    days = [StructField(DAY, DateType())] if by_day else []
    with_batch = StructType([*columns.fields, StructField("batch_id", LongType()), *days])
    if not exists(spark, path):
        return empty(spark, with_batch)
    upto = compacted(spark, path)
    if upto is None:
        return spark.read.schema(with_batch).parquet(path).select(*with_batch.names)
    merged = spark.read.schema(with_batch).parquet(_merged(path, upto)).select(*with_batch.names)
    fresh = _folders(spark, path, upto)
    if not fresh:
        return merged
    rest = spark.read.schema(with_batch).option("basePath", path).parquet(*fresh)
    return merged.unionByName(rest.select(*with_batch.names))


def read_batch(spark: SparkSession, path: str, columns: StructType, batch_id: int, by_day: bool = False) -> DataFrame:
    """One batch's own folder."""
    days = [StructField(DAY, DateType())] if by_day else []
    return spark.read.schema(StructType([*columns.fields, *days])).parquet(f"{path}/batch_id={batch_id}").select(*columns.names)


def append_sketch(sketch: DataFrame, path: str, batch_id: int, merged: bool = False) -> None:
    """Keep a batch's key sketch beside the batches; or, ``merged``, that of all batches up to it."""
    sketch.write.mode("overwrite").parquet(f"{path}/_sketches/{'upto' if merged else 'batch_id'}={batch_id}")


def read_sketches(spark: SparkSession, path: str) -> DataFrame:
    """The key sketches of all batches with their ``batch_id``; of merged batches their common one, if it was made."""
    columns = StructType.fromDDL(f"{SKETCH}, batch_id bigint")
    folder, merged = f"{path}/_sketches", compacted(spark, path)
    upto = merged if merged in _numbered(spark, folder, "upto") else None
    singles = [f"{folder}/batch_id={n}" for n in _numbered(spark, folder, "batch_id") if upto is None or n > upto]
    parts = spark.read.schema(columns).option("basePath", folder).parquet(*singles).select(*columns.names) if singles else empty(spark, columns)
    if upto is None:
        return parts
    common = spark.read.schema(SKETCH).parquet(f"{folder}/upto={upto}").withColumn("batch_id", F.lit(upto).cast("bigint"))
    return common.unionByName(parts)


def compacted(spark: SparkSession, path: str) -> int | None:
    """The last batch that has been merged with all before it."""
    pointer = f"{path}/{MERGED}"
    return int(read_text(spark, pointer)) if exists(spark, pointer) else None


def _merged(path: str, upto: int) -> str:
    return f"{path}/_merged-{upto}"


def _numbered(spark: SparkSession, path: str, kind: str) -> list[int]:
    """The numbers of the folders ``kind=number`` of a path."""
    if not exists(spark, path):
        return []
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    names = [f.getPath().getName().partition("=") for f in root.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(root)]
    return sorted(int(n) for k, _, n in names if k == kind)


def _folders(spark: SparkSession, path: str, after: int) -> list[str]:
    """Folders of the batches after one."""
    return [f"{path}/batch_id={n}" for n in _numbered(spark, path, "batch_id") if n > after]


def unsketched(spark: SparkSession, path: str, before: int) -> list[int]:
    """Batches before one whose keys no sketch holds."""
    folder, merged = f"{path}/_sketches", compacted(spark, path)
    upto = max([-1, *(n for n in _numbered(spark, folder, "upto") if merged is not None and n == merged)])
    held = {*_numbered(spark, folder, "batch_id"), *range(upto + 1)}
    missing = [n for n in _numbered(spark, path, "batch_id") if n < before and n not in held]
    return missing if merged is None or upto >= 0 or missing else [n for n in range(min(merged + 1, before)) if n not in held]


def compact_batches(spark: SparkSession, path: str, columns: StructType, upto: int, by_day: bool = False) -> bool:
    """Merge all batches up to ``upto`` into a few large files (per day, for batches by day); whether there was anything to merge.

    The merged rows keep their batch id and lie beside the batches until a pointer file is renamed over, so readers see
    each row once, before and after. A batch that is merged must not be written again: jobs ask ``compacted``. The
    folders that are no longer read are left to ``drop_merged``, as a reader may still hold them.
    """
    done = compacted(spark, path)
    if not exists(spark, path) or done is not None and done >= upto or not _folders(spark, path, -1 if done is None else done):
        return False
    rows = read_batches(spark, path, columns, by_day).where(F.col("batch_id") <= upto)
    if by_day:
        # a day's rows go to as many tasks as its size asks for
        rows.hint("rebalance", DAY).write.mode("overwrite").partitionBy(DAY).parquet(_merged(path, upto))
    else:
        rows.hint("rebalance").write.mode("overwrite").parquet(_merged(path, upto))
    replace_text(spark, f"{path}/{MERGED}", str(upto))
    return True


def drop_merged(spark: SparkSession, path: str) -> int:
    """Delete the folders of merged batches and of earlier merges; returns how many. No reader may be on them."""
    upto = compacted(spark, path)
    if upto is None:
        return 0
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs, gone = root.getFileSystem(spark._jsc.hadoopConfiguration()), 0
    for status in fs.listStatus(root):
        name = status.getPath().getName()
        kind, _, number = name.partition("=") if "=" in name else name.partition("-")
        if kind == "batch_id" and int(number) <= upto or kind == "_merged" and int(number) < upto:
            gone += fs.delete(status.getPath(), True)
    return gone


def current_version(spark: SparkSession, root: str) -> int | None:
    pointer = f"{root}/{POINTER}"
    if not exists(spark, pointer):
        return None
    return int(spark.read.text(pointer).first()["value"])


def publish_version(df: DataFrame, root: str, check: Callable[[DataFrame], None] | None = None, checks: tuple[Check, ...] = ()) -> int:
    """Write the next version, then point to it, if it passes. One writer at a time.

    ``checks`` are measured on the rows as they are written, so nothing is read again. ``check`` is for what a suite
    cannot say: it gets the written table and raises where that must not become current. After a failure the
    pointer stays where it was.
    """
    spark = df.sparkSession
    version = (current_version(spark, root) or 0) + 1
    path = f"{root}/version={version}"
    watched, metrics = measured(df, checks)
    watched.write.mode("overwrite").parquet(path)
    enforce_metrics(metrics, checks)
    if check is not None:
        check(spark.read.schema(df.schema).parquet(path))
    replace_text(spark, f"{root}/{POINTER}", str(version))
    return version


def replace_text(spark: SparkSession, path: str, text: str) -> None:
    """Set a small file's text: write beside the file and rename over it, so that a reader finds the old text or the new one."""
    fs, conf = spark._jvm.org.apache.hadoop.fs, spark._jsc.hadoopConfiguration()
    target, fresh = fs.Path(path), fs.Path(f"{path}.{uuid.uuid4().hex}")
    stream = fresh.getFileSystem(conf).create(fresh, False)
    stream.write(bytearray(text.encode()))
    stream.close()
    overwrite = spark.sparkContext._gateway.new_array(getattr(fs, "Options$Rename"), 1)
    overwrite[0] = getattr(fs, "Options$Rename").OVERWRITE
    qualified = target.getFileSystem(conf).makeQualified(target)
    fs.FileContext.getFileContext(qualified.toUri(), conf).rename(fresh, target, overwrite)


def read_text(spark: SparkSession, path: str) -> str:
    """A small file's text, also of a name that Spark's readers pass over."""
    file = spark._jvm.org.apache.hadoop.fs.Path(path)
    stream = file.getFileSystem(spark._jsc.hadoopConfiguration()).open(file)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def read_version(spark: SparkSession, root: str, columns: StructType, version: int | None = None) -> DataFrame:
    """The current version, or a named one (the backup is the one before)."""
    version = version or current_version(spark, root)
    if version is None:
        return empty(spark, columns)
    return spark.read.schema(columns).parquet(f"{root}/version={version}")


def write_json(df: DataFrame, path: str, layout: str = "lines") -> None:
    """Export as JSON records (label sets, member dumps, rejected ids).

    ``lines`` writes one record a line, in as many files as there are tasks. ``array`` writes
    JSON arrays, each a file of about ``ARRAY_BYTES``: a small export is one file, as other
    tools expect, and no task meets more than a few files' records.
    """
    if layout == "lines":
        df.write.mode("overwrite").json(path)
    elif layout == "array":
        _write_arrays(df.select(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("r")), path)
    else:
        raise ValueError(f"layout must be 'lines' or 'array', not {layout!r}")


def write_string_list(values: DataFrame, path: str) -> None:
    """Export the first column as JSON arrays of strings, of about ``LIST_STRINGS`` each; a short list is one array."""
    value = F.col(values.columns[0])
    arrays = -(-values.count() // LIST_STRINGS)
    dealt = values.where(value.isNotNull()).groupBy(F.pmod(F.xxhash64(value), F.lit(max(1, arrays))).alias("array")).agg(F.collect_list(value).alias("strings"))
    dealt.select(F.to_json("strings").alias("value")).write.mode("overwrite").option("maxRecordsPerFile", 1).text(path)


def _write_arrays(records: DataFrame, path: str) -> None:
    """Records are stored first, so that their places, which deal them out, stay the same when a task is retried."""
    spark = records.sparkSession
    held = shared_folder(spark, "array-records")
    records.write.parquet(held)
    records = spark.read.schema(records.schema).parquet(held)
    size = records.agg(F.sum(F.octet_length("r") + 2)).first()[0] or 0
    files = -(-size // ARRAY_BYTES)
    array = F.concat(F.lit("["), F.array_join(F.collect_list("r"), ",\n"), F.lit("]")).alias("value")
    if files > 1:
        dealt = records.withColumn("file", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(files)))
        # By ranges: the first task is never without rows, for which Spark would write an empty file.
        arrays = dealt.repartitionByRange(files, "file").groupBy("file").agg(array).select("value")
    else:
        arrays = records.agg(array)
    arrays.write.mode("overwrite").option("maxRecordsPerFile", 1).text(path)


def dump_rejected(rejected: DataFrame, folder: str, at: datetime, limit: int = REJECTED_DUMP_ABOVE) -> str | None:
    """Export the rejected ids under a time-stamped name once there are too many."""
    if rejected.count() <= limit:
        return None
    path = f"{folder}/{at:%Y_%m_%d_%H%M}_not_relevant_list"
    write_json(rejected, path)
    return path


def _hashed(df: DataFrame, *columns: str) -> DataFrame:
    """Two numbers per row from the digest of its cells, beside the row."""
    cells = [F.coalesce(F.col(c).cast("string"), F.lit("\x00")) for c in columns or df.columns]
    digest = F.md5(F.concat_ws("\x1f", *cells))
    return df.select(
        "*",
        F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint").alias("_wide"),
        F.conv(F.substring(digest, 17, 8), 16, 10).cast("bigint").alias("_narrow"),
    )


def _content() -> list:
    return [
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.bit_xor("_wide"), F.lit(0).cast("bigint")).alias("content_xor"),
        F.coalesce(F.sum(F.col("_narrow").cast("decimal(38,0)")), F.lit(0)).cast("string").alias("content_sum"),
    ]


def fingerprint(df: DataFrame, *columns: str) -> DataFrame:
    """Row count and two order-free content hashes; equal tables give equal rows.

    The xor alone would cancel pairs of equal rows; the sum does not.
    """
    return _hashed(df, *columns).agg(*_content())


#: Buckets of a digest tree.
TREE_BUCKETS = 256


def digest_tree(df: DataFrame, key: str, *columns: str, buckets: int = TREE_BUCKETS) -> DataFrame:
    """The fingerprint of each bucket of ``key``'s digest: bucket, rows, content_xor, content_sum.

    Trees of parts of a table merge to the tree of the whole, so an append needs only the tree of what it adds, and two versions
    are compared by their trees alone. There are ``buckets`` rows at most; a bucket without rows has none. A NULL key has a bucket too.
    """
    name = F.md5(F.coalesce(F.col(key).cast("string"), F.lit("\x00")))
    bucket = F.pmod(F.conv(F.substring(name, 1, 8), 16, 10).cast("bigint"), F.lit(buckets)).cast("int")
    return _hashed(df, *columns).groupBy(bucket.alias("bucket")).agg(*_content())


def merged_tree(*trees: DataFrame) -> DataFrame:
    """The tree of all rows of which ``trees`` are the parts' trees."""
    every = trees[0]
    for tree in trees[1:]:
        every = every.unionByName(tree)
    return every.groupBy("bucket").agg(*_merged_content())


def tree_root(tree: DataFrame) -> DataFrame:
    """The fingerprint of the whole table, from its tree."""
    return tree.agg(*_merged_content())


def _merged_content() -> list:
    return [
        F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
        F.coalesce(F.bit_xor("content_xor"), F.lit(0).cast("bigint")).alias("content_xor"),
        F.coalesce(F.sum(F.col("content_sum").cast("decimal(38,0)")), F.lit(0)).cast("string").alias("content_sum"),
    ]


def changed_buckets(before: DataFrame, after: DataFrame) -> DataFrame:
    """bucket, rows_before, rows_after of the buckets in which two trees differ: only there do the tables."""
    side = lambda tree, name: tree.select("bucket", F.struct("rows", "content_xor", "content_sum").alias(name))
    met = side(before, "b").join(side(after, "a"), "bucket", "full").where(~F.col("b").eqNullSafe(F.col("a")))
    return met.select("bucket", *[F.coalesce(F.col(f"{n}.rows"), F.lit(0).cast("bigint")).alias(f"rows_{w}") for n, w in (("b", "before"), ("a", "after"))])
