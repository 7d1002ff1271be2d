"""The labelled dataset."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom import schema
from feedloom.operators.filters import in_language
from feedloom.operators.quality import LABEL_SET_SUITE, Check
from feedloom.sources.sinks import fingerprint, publish_version, read_version


def label_set(posts: DataFrame, positive: DataFrame, negative: DataFrame, lang: str = "en") -> DataFrame:
    """Posts in either id set with ``labels`` 1.0 or 0.0; positive wins, reposts stay.

    Both sets become one label per id before the join, so posts are joined once.
    """
    marked = positive.select("id", F.lit(1.0).alias("labels")).unionByName(negative.select("id", F.lit(0.0).alias("labels")))
    verdict = marked.groupBy(F.col("id").alias("_labelled")).agg(F.max("labels").alias("labels"))
    return in_language(posts, lang).join(verdict, F.col("id") == F.col("_labelled")).drop("_labelled")


def publish_label_set(labelled: DataFrame, root: str, suite: tuple[Check, ...] = LABEL_SET_SUITE) -> DataFrame:
    """Write the next version, checked as it is written, and return its fingerprint.

    A failed check stops the job, and the version before stays current.
    """
    version = publish_version(labelled.select(*schema.LABEL_SET.names), root, checks=suite)
    return fingerprint(read_version(labelled.sparkSession, root, schema.LABEL_SET, version))
