"""Post-shaped views of the benchmark tables.

The tables given for checks hold documents, pages, events and so on. These views read
them whole as posts, likes, logs, scores and lists; nothing is sampled or made up.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom import schema
from feedloom.operators import metrics
from feedloom.operators.joins import fits_broadcast
from feedloom.session import spread
from feedloom.sources.payloads import member_page

# Fixed values of the checks.
AS_OF = "2024-01-15"
OWNER = 8
MUTE_WORDS = ("token", "license", "under the", "🍿")
MUTE_WORDS_CS = ("MIT", "The hand", "Rep.")
MUTED_LISTS = ("MACHINERY", "FURNITURE")
NEWS_DOMAINS = ("example.com", "blog.ththan.example.net", "spam-farm.example.org", "therin.example.net")
STOP_WORDS = ("a", "an", "and", "are", "as", "at", "be", "by", "for", "from", "in", "is", "it", "of", "on", "or", "that", "the", "this", "to", "was", "were", "with")
THRESHOLDS = (0.2, 0.4, 0.6, 0.8)
#: Labels, a few numbers each, that may be broadcast; their bytes are bounded too.
LABELS = 4_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts_of(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table whose long texts are worked on per row."""
    return spread(table(spark, sf_dir, name))


def _missing() -> Column:
    return F.lit(None).cast("bigint")


def _minutes_after_start(minutes) -> Column:
    start = F.lit("2024-01-01").cast("timestamp_ntz")
    return start + F.make_dt_interval(F.lit(0), F.lit(0), minutes.cast("int"), F.lit(0))


def posts(spark: SparkSession, sf_dir: str, read=table) -> DataFrame:
    """Documents as posts; a text under 400 characters stands in for a repost."""
    return read(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("id"),
        F.regexp_extract("source", "([0-9]+)$", 1).try_cast("bigint").alias("user"),
        F.col("text").alias("full_text"),
        _minutes_after_start(F.col("n_chars")).alias("created_at"),
        "lang",
        F.when(F.col("n_chars") < 400, F.col("doc_id")).alias("retweeted_status"),
        _missing().alias("quoted_status"),
        F.lit(False).alias("is_quote_status"),
        _missing().alias("in_reply_to_status_id"),
        F.col("n_chars").alias("favorite_count"),
    )


def linked_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as posts, with the link of the page of the same number appended."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    joined = posts(spark, sf_dir, texts_of).join(pages, F.col("id") == F.col("page_id"), "left")
    return joined.withColumn("full_text", F.concat_ws(" ", "full_text", "url")).drop("page_id", "url")


def page_text() -> Column:
    """A page's link, its source, and its link again behind a cached-page wrapper."""
    bare = F.regexp_replace("url", "^https?://", "")
    return F.concat(F.col("url"), F.lit(" "), F.col("html"), F.lit(" https://www.google.com/amp/s/"), bare)


def page_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as posts with links; markers in the link stand in for reposts, replies and quotes."""
    has = lambda mark: F.contains("url", F.lit(mark))
    return texts_of(spark, sf_dir, "pages").select(
        F.col("page_id").alias("id"),
        F.regexp_extract("url", "/([0-9]+)", 1).try_cast("bigint").alias("user"),
        page_text().alias("full_text"),
        _minutes_after_start(F.col("page_id")).alias("created_at"),
        F.regexp_extract("url", "/([a-z]{2})/", 1).alias("lang"),
        F.when(has("utm_source"), F.col("page_id")).alias("retweeted_status"),
        F.when(has("#top"), F.col("page_id") - 2).alias("quoted_status"),
        has("#top").alias("is_quote_status"),
        F.when(has("?page=2"), F.col("page_id") - 1).alias("in_reply_to_status_id"),
        F.length("url").cast("bigint").alias("favorite_count"),
    )


def turn_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversation turns as posts: each answers the turn before, later ones quote the first."""
    c = table(spark, sf_dir, "conversations")
    first = F.col("conv_id") * 100
    here = first + F.col("turn")
    return c.select(
        here.alias("id"),
        F.col("conv_id").alias("user"),
        F.col("text").alias("full_text"),
        _minutes_after_start(F.col("turn")).alias("created_at"),
        F.lit("en").alias("lang"),
        F.when(F.col("role") == "system", here).alias("retweeted_status"),
        F.when(F.col("turn") > 1, first).alias("quoted_status"),
        (F.col("turn") > 1).alias("is_quote_status"),
        F.when(F.col("turn") > 0, here - 1).alias("in_reply_to_status_id"),
        F.length("text").cast("bigint").alias("favorite_count"),
    )


def own_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The owner's timeline: what the human side of the conversations and the system wrote."""
    roles = table(spark, sf_dir, "conversations").where(F.col("role") != "assistant")
    mine = roles.select((F.col("conv_id") * 100 + F.col("turn")).alias("_mine"))
    return turn_posts(spark, sf_dir).join(mine, F.col("id") == F.col("_mine"), "left_semi")


def event_ids(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    return table(spark, sf_dir, "events").where(F.col("event_type") == kind)


def likes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_ids(spark, sf_dir, "view").select(F.col("event_id").alias("post_id"), "user_id")


def rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_ids(spark, sf_dir, "error").select(F.col("event_id").alias("id"))


def friends(spark: SparkSession, sf_dir: str, owner: int = OWNER) -> DataFrame:
    """Who the owner follows: the ids in the payload of the owner's clicks."""
    clicks = event_ids(spark, sf_dir, "click").where(F.col("user_id") == owner)
    return clicks.select(F.from_json("props", "struct<k: bigint>")["k"].alias("friend_id"))


def members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as list members; a market segment is a list."""
    c = table(spark, sf_dir, "customer")
    return c.select(F.col("c_mktsegment").alias("list_name"), F.col("c_custkey").alias("user_id"), F.col("c_name").alias("screen_name"))


def member_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The members as landed JSON."""
    one = F.struct(F.col("user_id").alias("id"), "screen_name", F.col("list_name").alias("name"))
    return members(spark, sf_dir).select("list_name", member_page(one).alias("payload"))


def collection_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as landed collection pages; a page of views has no posts in it."""
    one_post = F.struct(F.create_map(F.col("event_id").cast("string"), F.col("props")).alias("tweets"))
    found = F.to_json(F.struct(one_post.alias("objects")))
    none = F.lit('{"objects": {}}')
    return table(spark, sf_dir, "events").select(
        "event_id", F.when(F.col("event_type") == "view", none).otherwise(found).alias("payload")
    )


def byte_score(key, position: int = 1) -> Column:
    """One byte of an id's md5 as a number in [0, 1): a repeatable stand-in score."""
    return F.conv(F.substring(F.md5(key.cast("string")), position, 2), 16, 10).cast("double") / 256


def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A score for every labelled document; the others have none."""
    return table(spark, sf_dir, "labels").select(F.col("doc_id").alias("id"), byte_score(F.col("doc_id")).alias("predicted"))


def delivery_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxic-labelled documents as delivered posts, each logged twice."""
    toxic = table(spark, sf_dir, "labels").where(F.col("toxic") == 1)
    reason = F.when(F.col("quality") == 1, "no_errors").otherwise("not_found")
    log = toxic.select(F.col("doc_id").alias("post_id"), reason.alias("err_reason"))
    return log.unionByName(log).select(*schema.DELIVERY_LOG.names)


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``id, label`` of every labelled document."""
    return table(spark, sf_dir, "labels").select(F.col("doc_id").alias("id"), F.col("quality").alias("label"))


def labelled_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``id, label, full_text`` of every labelled document; texts stay where they are read unless the labels are too many to broadcast."""
    texts = texts_of(spark, sf_dir, "documents").select(F.col("doc_id").alias("_doc"), F.col("text").alias("full_text"))
    labels = labelled(spark, sf_dir)
    if fits_broadcast(labels, LABELS):
        labels = F.broadcast(labels)
    return labels.join(texts, F.col("id") == F.col("_doc")).drop("_doc")


def run_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every labelled document judged by twelve runs: three experiments, four thresholds each."""
    base = labelled(spark, sf_dir)
    judged = F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(e).cast("bigint").alias("experiment_seq"),
                    F.lit(f"exp{e}-{i}").alias("run_id"),
                    (byte_score(F.col("id"), 2 * e + 1) >= t).cast("int").alias("prediction"),
                )
                for e in range(3)
                for i, t in enumerate(THRESHOLDS)
            ]
        )
    )
    return base.select("label", judged.alias("r")).select("label", "r.*")


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run records of those twelve runs; the last experiment is a re-evaluation, not training."""
    by = ["experiment_seq", "run_id"]
    measured = metrics.run_metrics(metrics.class_report(metrics.confusion(run_predictions(spark, sf_dir), by), by), by)
    kind = F.when(F.col("experiment_seq") == 2, "performance").otherwise("train")
    return measured.withColumns(
        {
            "experiment": F.concat(F.lit("exp"), F.col("experiment_seq").cast("string")),
            "tags": F.create_map(F.lit("type"), kind),
        }
    )
