"""Lookups by id: scores, texts of replied-to and quoted posts, delivered posts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.operators.joins import drop_members, has_duplicates, keep_last, spread_join


def drop_seen(posts: DataFrame, delivery_log: DataFrame, key: str = "id") -> DataFrame:
    """Posts not yet delivered. The log may repeat ids; posts without an id stay."""
    return drop_members(posts, key, delivery_log.select("post_id"), spread_by=[key])


def drop_liked(posts: DataFrame, likes: DataFrame) -> DataFrame:
    return drop_members(posts, "id", likes.select("post_id"))


def unscored(posts: DataFrame, scores: DataFrame) -> DataFrame:
    """Posts that have no row in the score table (a stored 0 counts as a score)."""
    return drop_members(posts, "id", scores.select("id"))


def add_scores(posts: DataFrame, scores: DataFrame, on_duplicate: str = "dedup") -> DataFrame:
    """Add ``preds``: the stored score, 0 when there is none.

    Duplicate ids in the score table are resolved to one row (``dedup``: the last by
    ``seq`` when that column exists, else the greatest score), or set every score to 0
    (``reset``).
    """
    if on_duplicate not in ("dedup", "reset"):
        raise ValueError(f"on_duplicate must be 'dedup' or 'reset', not {on_duplicate!r}")
    if "seq" in scores.columns:
        unique = keep_last(scores.select("id", "predicted", "seq"), ["id"], "seq").drop("seq")
    else:
        unique = scores.groupBy("id").agg(F.max("predicted").alias("predicted"))
    lookup = unique.select(F.col("id").alias("_scored"), "predicted")
    stored = F.coalesce(F.col("predicted"), F.lit(0.0))
    if on_duplicate == "reset":
        stored = F.when(has_duplicates(scores, "id"), F.lit(0.0)).otherwise(stored)
    return posts.join(lookup, F.col("id") == F.col("_scored"), "left").withColumn("preds", stored).drop("_scored", "predicted")


def upsert_scores(current: DataFrame, fresh: DataFrame) -> DataFrame:
    """The score table after an append: fresh rows win over stored ones.

    Of several rows of one id on the same side the greatest score stays.
    """
    both = current.select("id", "predicted", F.lit(0).alias("side")).unionByName(
        fresh.select("id", "predicted", F.lit(1).alias("side"))
    )
    return both.groupBy("id").agg(F.max_by("predicted", F.struct("side", "predicted")).alias("predicted"))


def with_thread_text(posts: DataFrame, lookup: DataFrame | None = None) -> DataFrame:
    """Append the replied-to and the quoted post's text; both separators always appear.

    Texts are looked up among ``posts`` or a wider ``lookup``, by link target: posts
    without an id get their thread, and posts that share an id each get their own. A NULL
    text counts as empty. Posts that link nowhere are finished where they are read. The
    others meet only the texts they link to; a target that many posts link to is cut into
    pieces. Of repeated target ids the latest text counts, of equally late ones the greatest.
    """
    lookup = posts if lookup is None else lookup
    reply, quote = F.col("in_reply_to_status_id"), F.col("quoted_status")
    linking = reply.isNotNull() | quote.isNotNull()
    linked_posts = posts.where(linking)
    targets = linked_posts.select(F.explode(F.array(reply, quote)).alias("target")).where(F.col("target").isNotNull())
    load = targets.groupBy("target").agg(F.count(F.lit(1)).alias("load"))
    candidates = lookup.select("id", "full_text", "created_at").join(load.select(F.col("target").alias("_wanted")), F.col("id") == F.col("_wanted"), "left_semi")
    written = F.coalesce(F.col("created_at"), F.lit("0001-01-01").cast("timestamp_ntz"))
    texts = candidates.groupBy(F.col("id").alias("_target")).agg(F.max_by("full_text", F.struct(written, "full_text")).alias("_linked"))
    threaded = linked_posts
    for column, name in (("in_reply_to_status_id", "_reply"), ("quoted_status", "_quote")):
        of_kind = texts.select(F.col("_target").alias(f"{name}_target"), F.col("_linked").alias(name))
        threaded = spread_join(threaded, of_kind, {column: f"{name}_target"}, "left", ["id", "full_text"], load.withColumnRenamed("target", column)).drop(f"{name}_target")
    parts = [F.coalesce(F.col(c), F.lit("")) for c in ("full_text", "_reply", "_quote")]
    threaded = threaded.withColumn("full_text", F.concat_ws(" ", *parts)).select(*posts.columns)
    alone = posts.where(~linking).withColumn("full_text", F.concat(F.coalesce(F.col("full_text"), F.lit("")), F.lit("  ")))
    return alone.unionByName(threaded)
