"""Session helpers: a configured builder, and the shared folder long jobs write to."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession

_LOCAL_BASE: dict[str, str] = {}


def build_session(app_name: str = "feedloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution, skew-join handling and UTC time."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new path below the folder the cluster names in ``spark.checkpoint.dir``.

    A local session without that setting gets a temporary folder. A cluster session
    without it is refused: a machine-local folder is lost with its machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        if not re.match(r"local(\[.*\])?$", spark.sparkContext.master):  # local-cluster has executors of its own
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        app = spark.sparkContext.applicationId
        base = _LOCAL_BASE.setdefault(app, "")
        if not base:
            base = _LOCAL_BASE[app] = tempfile.mkdtemp(prefix="feedloom-")
            spark.sparkContext.setCheckpointDir(base)
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def spread(df: DataFrame, *keys: str | Column) -> DataFrame:
    """Give CPU-heavy per-row work at least one task per core.

    A table stored in a few row groups is read by as few tasks. Tables with at least as many
    splits as there are cores pass through unchanged; one with fewer is shuffled whole, texts
    included, so it is for work that costs more than that. Use it on a plain scan: asking a
    plan with joins for its partitions would run them.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if splits(df) >= cores else df.repartition(cores, *keys)


def splits(scan: DataFrame) -> int:
    """Tasks that read a plain scan: they grow with its bytes."""
    return scan.rdd.getNumPartitions()
