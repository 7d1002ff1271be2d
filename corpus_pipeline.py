"""From raw documents to packed windows, in five stages.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before it kept:

1. quality classifier: documents the chain rejects go;
2. n-gram Jaccard join: one document of each group of near copies stays;
3. benchmark decontamination: documents into which a benchmark item leaks go;
4. secret scans: values that look live are replaced by a mark, documents stay;
5. packing: all documents become pieces of windows.

All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.llm import metric_join, ownership, packing, quality_crf, templates
from feedloom.llm.common import held_out, ship_package, spare, stored, table

#: Least quality score of a document that stays.
QUALITY = 0.3


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    labels = table(spark, sf_dir, "labels").where(~held_out(F.col("doc_id"))).select("doc_id", F.col("quality").alias("label"))
    chain = quality_crf.fit(docs, labels)
    (quality,) = spare(docs, "quality")
    return quality_crf.score(docs, chain, quality).where(F.col(quality) >= QUALITY).drop(quality)


def near_copy_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return metric_join.representatives(docs)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return templates.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ownership.redact(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return packing.pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_classifier", quality_stage),
    ("ngram_jaccard_join", near_copy_stage),
    ("benchmark_decontamination", benchmark_stage),
    ("secret_scans", secret_stage),
    ("packing", packing_stage),
]

#: A learned chain decides the first stage, so SQL cannot state the rows; tests compare the stages with plain versions.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of ``documents``; what each stage keeps is stored for the next."""
    docs = table(spark, sf_dir, "documents")
    for number, (name, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES):
            docs = stored(docs, f"stage-{number}-{name}")
    return docs
