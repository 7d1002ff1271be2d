"""Readers. Every reader takes an explicit schema; optional inputs may be absent."""

from __future__ import annotations

import logging

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from feedloom import schema
from feedloom.functions.values import cutoff

log = logging.getLogger(__name__)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists on whatever file system it names."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop_path)


def empty(spark: SparkSession, columns: StructType) -> DataFrame:
    return spark.createDataFrame([], columns)


def read_posts(spark: SparkSession, path: str, fmt: str = "parquet", **options: str) -> DataFrame:
    """Posts in the stored schema, from any Spark source format."""
    return spark.read.format(fmt).schema(schema.POSTS).options(**options).load(path)


def posts_by_age(posts: DataFrame, as_of: str, days: int, latest: bool = False) -> DataFrame:
    """The ten post columns, strictly older than the cut-off day, or not older."""
    return within_age(posts, F.col("created_at"), as_of, days, latest).select(*schema.POSTS.names)


def within_age(df: DataFrame, when: Column, as_of: str, days: int, latest: bool = False) -> DataFrame:
    """Rows before (default) or from the cut-off on; rows without a time are dropped."""
    limit = cutoff(as_of, days)
    return df.where(when >= limit if latest else when < limit)


def read_likes(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schema.LIKES).parquet(path)


def read_delivery_log(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """The delivery log; a missing one is empty."""
    if not exists(spark, path):
        log.warning("no delivery log at %s", path)
        return empty(spark, schema.DELIVERY_LOG)
    reader = spark.read.schema(schema.DELIVERY_LOG)
    return reader.csv(path, header=True) if fmt == "csv" else reader.format(fmt).load(path)


def read_scores(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """The score table; a missing one is empty, so every post is unscored."""
    if not exists(spark, path):
        log.warning("no score table at %s", path)
        return empty(spark, schema.SCORES)
    if fmt == "csv":
        return spark.read.schema(schema.SCORES).csv(path, header=True, ignoreLeadingWhiteSpace=True)
    return spark.read.schema(schema.SCORES).format(fmt).load(path)


def read_string_list(spark: SparkSession, path: str) -> DataFrame:
    """A JSON array of strings (mute words, domains) as a one-column table."""
    whole = spark.read.text(path, wholetext=True)
    return whole.select(F.explode(F.from_json("value", "array<string>")).alias("word"))


def read_label_set(spark: SparkSession, path: str, layout: str = "lines") -> DataFrame:
    """Labelled posts in either layout of ``write_json``; an array may be spread over lines."""
    if layout not in ("lines", "array"):
        raise ValueError(f"layout must be 'lines' or 'array', not {layout!r}")
    return spark.read.schema(schema.LABEL_SET).json(path, multiLine=layout == "array")
