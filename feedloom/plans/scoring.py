"""Scoring posts with the best run and keeping the score table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom import schema
from feedloom.functions.text import clean_text
from feedloom.operators.lookups import unscored, upsert_scores
from feedloom.operators.metrics import best_run
from feedloom.operators.quality import SCORES_SUITE
from feedloom.plans.feed import FeedRules, feed_batch
from feedloom.plans.training import load_run, positive_probability
from feedloom.sources.buckets import BUCKETS, read_buckets, upsert_buckets
from feedloom.sources.sinks import publish_version, read_version

Scorer = Callable[[DataFrame], DataFrame]


def model_scorer(model: PipelineModel) -> Scorer:
    """Posts to ``id, predicted`` with a saved pipeline over cleaned text."""
    return lambda posts: positive_probability(model.transform(posts.withColumn("text", clean_text(F.col("full_text")))))


def best_scorer(runs: DataFrame, experiment: str | None = None) -> Scorer:
    chosen = best_run(runs, experiment).first()
    if chosen is None:
        raise ValueError("no training run to score with")
    return model_scorer(load_run(chosen["model_path"]))


def scorable(posts: DataFrame, delivery_log: DataFrame | None, lang: str = "en") -> DataFrame:
    """Posts that a scoring run takes, in batch and in streaming alike.

    News stays in and mute lists do not apply; reposts, other languages and delivered posts are left out.
    """
    return feed_batch(posts, FeedRules(lang=lang, remove_news=False), delivery_log)


def score_posts(posts: DataFrame, scorer: Scorer, scores: DataFrame, delivery_log: DataFrame | None, mode: str = "append") -> DataFrame:
    """The next score table: fresh scores over stored ones, or fresh scores alone.

    ``append`` scores only posts without a score; ``overwrite`` scores the whole batch. An
    id that is scored twice in one run keeps its greatest score.
    """
    if mode not in ("append", "overwrite"):
        raise ValueError(f"mode must be 'append' or 'overwrite', not {mode!r}")
    batch = scorable(posts, delivery_log)
    if mode == "append":
        return upsert_scores(scores, scorer(unscored(batch, scores)))
    return scorer(batch).groupBy("id").agg(F.max("predicted").alias("predicted"))


def update_score_table(spark: SparkSession, root: str, posts: DataFrame, scorer: Scorer, delivery_log: DataFrame | None, mode: str = "append") -> int | None:
    """Publish the next version of the score table once it passes its checks.

    Nothing to score publishes nothing; a failed check leaves the version before current.
    """
    stored = read_version(spark, root, schema.SCORES)
    batch = scorable(posts, delivery_log)
    if (unscored(batch, stored) if mode == "append" else batch).isEmpty():
        return None
    fresh = score_posts(posts, scorer, stored, delivery_log, mode)
    return publish_version(fresh, root, checks=SCORES_SUITE)


def update_score_buckets(
    spark: SparkSession, root: str, posts: DataFrame, scorer: Scorer, delivery_log: DataFrame | None, mode: str = "append", buckets: int = BUCKETS
) -> int | None:
    """As ``update_score_table`` for a score table in buckets of its ids: only buckets that get a score are written.

    Of the stored table ``append`` reads the ids, to leave out what is scored, and the touched buckets. With ``overwrite`` fresh scores
    replace stored ones of their ids; others stay.
    """
    if mode not in ("append", "overwrite"):
        raise ValueError(f"mode must be 'append' or 'overwrite', not {mode!r}")
    batch = scorable(posts, delivery_log)
    if mode == "append":
        batch = unscored(batch, read_buckets(spark, root, schema.SCORES))
    fresh = scorer(batch).select("id", "predicted").persist()
    try:
        return upsert_buckets(fresh, root, "id", upsert_scores, schema.SCORES, SCORES_SUITE, buckets)
    finally:
        fresh.unpersist()
