"""Row filters on posts. Predicates that Parquet can evaluate stay plain comparisons."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.functions.text import contained_words, contains_any
from feedloom.functions.urls import news_flag, url_domains
from feedloom.operators.grams import words_in_texts
from feedloom.operators.joins import drop_members, fits_broadcast, keep_members, spread_join

INLINE_WORDS = 200
INLINE_DOMAINS = 500


def no_reposts(posts: DataFrame) -> DataFrame:
    return posts.where(F.col("retweeted_status").isNull())


def in_language(posts: DataFrame, lang: str = "en") -> DataFrame:
    return posts.where(F.col("lang") == lang)


def on_likes(posts: DataFrame, likes: int, less: bool = True) -> DataFrame:
    """Drop rows at or below ``likes`` (``less``), or at or above it."""
    count = F.col("favorite_count")
    return posts.where(count > likes if less else count < likes)


def drop_containing(posts: DataFrame, column: str, words: Sequence[str] | DataFrame, case_sensitive: bool = False) -> DataFrame:
    """Drop rows whose text holds any listed word as a substring; NULL text stays.

    Only the text decides: rows without an id and rows that share one are judged alike, and
    a list gives one answer whatever its length and whether it comes as a table.
    """
    if isinstance(words, DataFrame) or len(words) > INLINE_WORDS:
        hits = _words_by_text(posts, column, _listed(posts, words), case_sensitive).select("_digest").distinct()
        digested = posts.withColumn("_of_text", text_digest(F.col(column)))
        return drop_members(digested, "_of_text", hits, spread_by=[column]).drop("_of_text")
    return posts.where(~contains_any(F.col(column), words, case_sensitive))


def word_matches(posts: DataFrame, column: str, words: Sequence[str] | DataFrame, case_sensitive: bool = False, key: str = "id") -> DataFrame:
    """One ``(key, word)`` row for each row of ``posts`` and each listed word its text holds.

    A word listed twice counts twice; rows that share a key, or have none, count each.
    """
    if not isinstance(words, DataFrame) and len(words) <= INLINE_WORDS:
        hits = F.explode_outer(contained_words(F.col(column), words, case_sensitive)).alias("word")
        return posts.select(key, hits).where(F.col("word").isNotNull())
    found = _words_by_text(posts, column, _listed(posts, words), case_sensitive)
    rows = posts.select(key, text_digest(F.col(column)).alias("_of_text")).where(F.col("_of_text").isNotNull())
    met = spread_join(rows, found, {"_of_text": "_digest"}, "inner", [key])
    return met.select(key, "word", F.explode(F.array_repeat(F.lit(1), F.col("times").cast("int"))).alias("_one")).select(key, "word")


def text_digest(text: Column) -> Column:
    """Stands for a text in joins, so that texts themselves are not shuffled; NULL for NULL."""
    return F.md5(text)


def _listed(posts: DataFrame, words: Sequence[str] | DataFrame) -> DataFrame:
    if not isinstance(words, DataFrame):
        words = posts.sparkSession.createDataFrame([(w,) for w in words], "word string")
    named = words.select(F.col(words.columns[0]).alias("word")).where(F.col("word").isNotNull())
    return named.groupBy("word").agg(F.count(F.lit(1)).alias("times"))


def _words_by_text(posts: DataFrame, column: str, listed: DataFrame, case_sensitive: bool) -> DataFrame:
    """(_digest, word, times): which distinct texts hold which listed words, through the rarest gram of each word.

    An empty word is in every text.
    """
    fold = (lambda c: c) if case_sensitive else F.lower
    needles = listed.select("word", fold(F.col("word")).cast("binary").alias("needle"))
    texts = posts.select(text_digest(F.col(column)).alias("digest"), fold(F.col(column)).cast("binary").alias("data")).where(F.col("data").isNotNull())
    met = words_in_texts(texts, needles.where(F.octet_length("needle") > 0))
    if not needles.where(F.octet_length("needle") == 0).isEmpty():
        met = met.unionByName(texts.select("digest", F.lit("").alias("word")).distinct())
    times = listed.select(F.col("word").alias("_listed"), "times")
    if fits_broadcast(times):
        met = met.join(F.broadcast(times), F.col("word") == F.col("_listed"))
    else:
        met = spread_join(met, times, {"word": "_listed"}, "inner", ["digest"])
    return met.select(F.col("digest").alias("_digest"), "word", "times")


def flag_news(posts: DataFrame, news_domains: Sequence[str] | DataFrame, column: str = "full_text") -> DataFrame:
    """Add ``contains_news`` (0 or 1).

    A short list is tested in place. A long one, or a table, meets the domains of each
    text in a join of narrow rows, and the answer comes back by a digest of the text, so rows
    without an id and rows that share one are judged by their own text.
    """
    if not isinstance(news_domains, DataFrame) and len(news_domains) <= INLINE_DOMAINS:
        return posts.withColumn("contains_news", news_flag(F.col(column), news_domains))
    links = posts.select(text_digest(F.col(column)).alias("_digest"), F.explode_outer(url_domains(F.col(column))).alias("_domain"))
    links = links.where(F.col("_domain").isNotNull()).distinct()
    hits = keep_members(links, "_domain", news_domains, spread_by=["_digest"]).select(F.col("_digest").alias("_news")).distinct()
    digested = posts.withColumn("_of_text", text_digest(F.col(column)))
    if fits_broadcast(hits):
        flagged = digested.join(F.broadcast(hits), F.col("_of_text") == F.col("_news"), "left")
    else:
        flagged = spread_join(digested, hits, {"_of_text": "_news"}, "left", [column])
    return flagged.withColumn("contains_news", F.col("_news").isNotNull().cast("int")).drop("_news", "_of_text")


def filter_news(posts: DataFrame, news_domains: Sequence[str] | DataFrame, remove_news: bool = True) -> DataFrame:
    """Drop posts that link to a listed domain, or keep all with the flag added."""
    flagged = flag_news(posts, news_domains)
    return flagged.where(F.col("contains_news") == 0) if remove_news else flagged


def raise_if_empty(df: DataFrame, message: str = "nothing to add") -> DataFrame:
    """Guard for the edge of a job; runs the plan until the first row."""
    if df.isEmpty():
        raise ValueError(message)
    return df
