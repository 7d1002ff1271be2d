"""Positive, negative and missing id sets, with the reason each id is in."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.operators.filters import flag_news, no_reposts, word_matches
from feedloom.operators.joins import keep_members
from feedloom.operators.lookups import with_thread_text


def muted_word_matches(posts: DataFrame, words: Sequence[str] | DataFrame, words_cs: Sequence[str] | DataFrame) -> DataFrame:
    """``(id, word, case_sensitive)``: one row per match, so an id may repeat."""
    folded = word_matches(posts, "full_text", words).withColumn("case_sensitive", F.lit(False))
    exact = word_matches(posts, "full_text", words_cs, case_sensitive=True).withColumn("case_sensitive", F.lit(True))
    return folded.unionByName(exact)


def muted_members(members: DataFrame, lists: Sequence[str]) -> DataFrame:
    """Members of the named lists; someone on two lists appears twice."""
    return members.where(F.col("list_name").isin(*lists)).select(F.col("user_id").alias("id"))


def muted_author_ids(posts: DataFrame, muted: DataFrame) -> DataFrame:
    return keep_members(posts, "user", muted).select("id")


def news_ids(posts: DataFrame, news_domains: Sequence[str] | DataFrame) -> DataFrame:
    """Posts that link to news themselves or through the post they answer or quote."""
    threads = with_thread_text(no_reposts(posts), lookup=posts)
    return flag_news(threads, news_domains).where(F.col("contains_news") == 1).select("id")


def negative_ids(**reasons: DataFrame) -> DataFrame:
    """Distinct ``(id, reason)`` over the given id tables."""
    tagged = [df.select("id", F.lit(reason).alias("reason")) for reason, df in reasons.items()]
    return reduce(DataFrame.unionByName, tagged).distinct()


def positive_ids(own_posts: DataFrame, likes: DataFrame, engagement: str = "stored") -> DataFrame:
    """Distinct ids the owner engaged with.

    ``stored`` takes own posts that lack a quote or lack a repost, plus likes;
    ``intended`` takes the quoted and the reposted posts themselves, plus likes.
    """
    if engagement == "stored":
        picked = own_posts.where(F.col("quoted_status").isNull() | F.col("retweeted_status").isNull()).select("id")
    elif engagement == "intended":
        targets = F.explode(F.array("quoted_status", "retweeted_status")).alias("id")
        picked = own_posts.select(targets).where(F.col("id").isNotNull())
    else:
        raise ValueError(f"engagement must be 'stored' or 'intended', not {engagement!r}")
    return picked.unionByName(likes.select(F.col("post_id").alias("id"))).distinct()


def missing_ids(requested: DataFrame, posts: DataFrame) -> DataFrame:
    """Requested ids that the data does not hold."""
    return requested.select("id").subtract(posts.select("id"))


def overflow(rejected: DataFrame, limit: int) -> DataFrame:
    """All rejected ids once there are more than ``limit``, else no rows."""
    return rejected.where(rejected.agg(F.count(F.lit(1))).scalar() > limit)
