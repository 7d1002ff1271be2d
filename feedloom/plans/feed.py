"""The feed batch and its delivery."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom import schema
from feedloom.operators import filters, lookups, ranking
from feedloom.operators.counts import frequencies
from feedloom.operators.joins import drop_members, keep_members
from feedloom.schema import REJECTED_DUMP_ABOVE
from feedloom.sources.sinks import append_batch, dump_rejected, read_batches
from feedloom.sources.tables import posts_by_age

Members = DataFrame | Sequence[int]


@dataclass(frozen=True)
class FeedRules:
    """What a batch keeps. Word and domain lists may be tables."""

    lang: str = "en"
    mute_words: Sequence[str] | DataFrame = ()
    mute_words_cs: Sequence[str] | DataFrame = ()
    news_domains: Sequence[str] | DataFrame = ()
    remove_news: bool = True
    min_likes: int = 0


@dataclass(frozen=True)
class Audience:
    """Whose posts may appear. ``None`` switches a rule off."""

    owner: int | None = None
    muted: Members | None = None
    friends: Members | None = None
    friends_only: bool = False
    not_friends_only: bool = False
    list_members: Members | None = None
    liked: DataFrame | None = field(default=None)


def from_audience(posts: DataFrame, audience: Audience) -> DataFrame:
    """Author rules, then posts the owner already liked."""
    if audience.owner is not None:
        posts = drop_members(posts, "user", [int(audience.owner)])
    if audience.muted is not None:
        posts = drop_members(posts, "user", audience.muted)
    if audience.friends is not None and audience.friends_only:
        posts = keep_members(posts, "user", audience.friends)
    if audience.friends is not None and audience.not_friends_only:
        posts = drop_members(posts, "user", audience.friends)
    if audience.list_members is not None:
        posts = keep_members(posts, "user", audience.list_members)
    if audience.liked is not None:
        posts = lookups.drop_liked(posts, audience.liked)
    return posts


def feed_batch(
    posts: DataFrame,
    rules: FeedRules,
    delivery_log: DataFrame | None = None,
    scores: DataFrame | None = None,
    on_duplicate: str = "dedup",
) -> DataFrame:
    """``id, user, full_text, preds`` of the posts a reader should see next.

    Cheap comparisons come first, then the text predicates, which run where the posts
    are read, so only surviving rows take part in the joins. Order is left to the
    caller: ``rank_by_score`` or ``top_n``.
    """
    kept = filters.in_language(filters.no_reposts(posts), rules.lang)
    if rules.min_likes > 0:
        kept = filters.on_likes(kept, rules.min_likes)
    kept = filters.drop_containing(kept, "full_text", rules.mute_words)
    kept = filters.drop_containing(kept, "full_text", rules.mute_words_cs, case_sensitive=True)
    if rules.remove_news:
        kept = filters.filter_news(kept, rules.news_domains)
    kept = kept.select("id", "user", "full_text")
    if delivery_log is not None:
        kept = lookups.drop_seen(kept, delivery_log)
    if scores is None:
        return kept.withColumn("preds", F.lit(0.0))
    return lookups.add_scores(kept, scores, on_duplicate)


def deliver(
    posts: DataFrame,
    rules: FeedRules,
    audience: Audience,
    log_path: str,
    batch_id: int,
    as_of: str,
    age_days: int = 21,
    latest: bool = False,
    size: int = 30,
    delivery_log: DataFrame | None = None,
    scores: DataFrame | None = None,
    rejected: DataFrame | None = None,
    dump_folder: str | None = None,
    dump_limit: int = REJECTED_DUMP_ABOVE,
) -> DataFrame:
    """Write the next batch to the delivery log and return its outcome counts.

    The batch is its own directory of the log. What counts as delivered is read here: the
    batches with smaller ids, and ``delivery_log`` where another log counts too. So a batch
    that runs again gets the same posts. A batch without posts raises and writes nothing. Once
    the rejected ids exceed ``dump_limit`` they are exported to ``dump_folder``, if that is named.
    """
    spark = posts.sparkSession
    seen = read_batches(spark, log_path, schema.DELIVERY_LOG).where(F.col("batch_id") < batch_id).select("post_id")
    if delivery_log is not None:
        seen = seen.unionByName(delivery_log.select("post_id"))
    aged = posts_by_age(posts, as_of, age_days, latest)
    batch = ranking.top_n(feed_batch(from_audience(aged, audience), rules, seen, scores), size)
    delivered = batch.select(F.col("id").alias("post_id"), F.lit("no_errors").alias("err_reason")).persist()
    append_batch(filters.raise_if_empty(delivered), log_path, batch_id)
    delivered.unpersist()
    if rejected is not None and dump_folder is not None:
        dump_rejected(rejected, dump_folder, datetime.now(timezone.utc), dump_limit)
    written = spark.read.schema(schema.DELIVERY_LOG).parquet(f"{log_path}/batch_id={batch_id}")
    return frequencies(written, "err_reason")
