"""Counts, class balance and weights."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def frequencies(df: DataFrame, *columns: str) -> DataFrame:
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))


def collection_sizes(entries: DataFrame, collection: str, message_from: int) -> DataFrame:
    """Posts per collection, and whether it has reached the message size."""
    return frequencies(entries, collection).withColumn("over", F.col("n") >= message_from)


def class_balance(df: DataFrame, split: str, label: str) -> DataFrame:
    """Class counts per split, 0 where a class is absent, and the positive share."""
    counts = df.groupBy(split).agg(*[F.count_if(F.col(label) == c).alias(f"n{c}") for c in (0, 1)])
    return counts.withColumn("ratio", F.col("n1") / (F.col("n1") + F.col("n0")))


def positive_share(df: DataFrame, label: str) -> DataFrame:
    return df.agg(F.avg(F.col(label).cast("double")).alias("positive_share"))


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """Balanced weights ``n / (k * n_c)``. The second step sees one row per class."""
    per_class = frequencies(df, label)
    size = per_class.agg(F.sum("n")).scalar()
    classes = per_class.agg(F.count(F.lit(1))).scalar()
    return per_class.withColumn("weight", size / (classes * F.col("n")))


def weight_grid(df: DataFrame, label: str, below: float = 5.0, above: float = 15.0, steps: int = 60) -> DataFrame:
    """Evenly spaced class-weight ratios around the balanced one.

    Class 1 weighs 1 and class 0 weighs ``1 / ratio``; ratios that are not positive have
    no weight and are left out.
    """
    counts = df.agg(*[F.count_if(F.col(label) == c).alias(f"n{c}") for c in (0, 1)])
    balanced = F.col("n0") / F.col("n1")
    width = (below + above) / (steps - 1)
    return (
        counts.select(balanced.alias("balanced"), F.explode(F.sequence(F.lit(0), F.lit(steps - 1))).alias("step"))
        .withColumn("ratio", F.col("balanced") - below + F.col("step") * F.lit(width))
        .where(F.col("ratio") > 0)
        .select(F.col("step").cast("bigint").alias("step"), "ratio", (1 / F.col("ratio")).alias("weight_0"), F.lit(1.0).alias("weight_1"))
    )


def majority_class(df: DataFrame, label: str) -> DataFrame:
    """Add ``prediction``: the most frequent label, the smaller one on a tie."""
    return df.withColumn("prediction", df.agg(F.mode(label, deterministic=True)).scalar())
