"""Every operator as a query over the benchmark tables.

Each entry reads its tables whole. Output columns are the ones the matching SQL in
``oracles`` names.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from feedloom import schema
from feedloom.functions import text as tx
from feedloom.functions import urls as ux
from feedloom.functions import values as vx
from feedloom.operators import counts, filters, idsets, lookups, metrics, quality, ranking, terms
from feedloom.operators.joins import drop_members, keep_members
from feedloom.plans import feed, labelling, rowspace, scoring, termblocks, training
from feedloom.session import shared_folder, splits
from feedloom.sources import buckets, payloads, sinks, tables
from feedloom.sources import standins as st
from feedloom.streaming import jobs

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
BRIEF = ("id", "user", "lang", "favorite_count")


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), 6) for c in columns})


# --- scans, sources, sinks -------------------------------------------------------------


@query
def scan_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    older = tables.posts_by_age(st.posts(spark, sf_dir), as_of="2024-01-03", days=1)
    return older.select("id", "user", "created_at", "lang", "retweeted_status", "favorite_count")


@query
def scan_likes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return st.likes(spark, sf_dir).select(F.col("post_id").alias("id"), "user_id")


@query
def csv_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The delivery log written as CSV and read back."""
    path = shared_folder(spark, "csv-log")
    st.delivery_log(spark, sf_dir).write.csv(path, header=True)
    return tables.read_delivery_log(spark, path, "csv")


@query
def csv_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_folder(spark, "csv-scores")
    st.scores(spark, sf_dir).write.csv(path, header=True)
    return tables.read_scores(spark, path, "csv")


@query
def json_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The distinct customer names as JSON arrays of strings, read back as a word list."""
    path = shared_folder(spark, "json-words")
    sinks.write_string_list(st.members(spark, sf_dir).select("screen_name").distinct(), path)
    return tables.read_string_list(spark, path)


def _labelled_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = st.labelled(spark, sf_dir).select(F.col("id").alias("_id"), F.col("label").cast("double").alias("labels"))
    return st.posts(spark, sf_dir, st.texts_of).join(labels, F.col("id") == F.col("_id")).select(*schema.LABEL_SET.names)


@query
def label_export_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_folder(spark, "label-array")
    sinks.write_json(_labelled_posts(spark, sf_dir), path, "array")
    return tables.read_label_set(spark, path, "array").select("id", "full_text", "created_at", "labels")


@query
def label_export_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_folder(spark, "label-lines")
    sinks.write_json(_labelled_posts(spark, sf_dir), path)
    return tables.read_label_set(spark, path).select("id", "full_text", "created_at", "labels")


@query
def member_dump(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_folder(spark, "members")
    sinks.write_json(idsets.muted_members(st.members(spark, sf_dir), st.MUTED_LISTS), path)
    return spark.read.schema("id bigint").json(path)


@query
def log_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two batches appended, the second one twice."""
    path, log = shared_folder(spark, "log"), st.delivery_log(spark, sf_dir)
    for batch_id, reason in ((0, "no_errors"), (1, "not_found"), (1, "not_found")):
        sinks.append_batch(log.where(F.col("err_reason") == reason), path, batch_id)
    return sinks.read_batches(spark, path, schema.DELIVERY_LOG)


@query
def version_backup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two versions of the score table, and a third that fails its check: the second is current, the first its backup."""
    root, scores = shared_folder(spark, "versions"), st.scores(spark, sf_dir)
    for table in (scores.where(F.col("predicted") < 0.5), scores):
        sinks.publish_version(table, root)
    try:
        sinks.publish_version(scores.withColumn("predicted", F.lit(2.0)), root, checks=quality.SCORES_SUITE)
    except quality.CheckFailed:
        pass
    current = sinks.current_version(spark, root)
    tagged = [sinks.read_version(spark, root, schema.SCORES, v).withColumn("version", F.lit(v).cast("bigint")) for v in (current, current - 1)]
    return tagged[0].unionByName(tagged[1])


@query
def reject_overflow(spark: SparkSession, sf_dir: str) -> DataFrame:
    return idsets.overflow(st.rejected(spark, sf_dir), schema.REJECTED_DUMP_ABOVE)


@query
def list_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    return payloads.list_members(st.member_pages(spark, sf_dir))


@query
def collection_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return payloads.collection_ids(st.collection_pages(spark, sf_dir))


@query
def table_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sinks.fingerprint(st.table(spark, sf_dir, "documents"), "doc_id", "text", "lang", "source", "n_chars")


def _two_versions(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The trees of two versions of the score table: low scores, then all, the tree of the latter from that of the former and the rows added."""
    scores = st.scores(spark, sf_dir)
    low, high = (sinks.digest_tree(scores.where(c), "id") for c in (F.col("predicted") < 0.9, F.col("predicted") >= 0.9))
    return low, sinks.merged_tree(low, high)


@query
def version_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The buckets in which the two versions differ."""
    return sinks.changed_buckets(*_two_versions(spark, sf_dir))


@query
def version_root(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fingerprint of the second version, from its merged tree."""
    return sinks.tree_root(_two_versions(spark, sf_dir)[1])


# --- filters ---------------------------------------------------------------------------


@query
def age_older(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.within_age(st.table(spark, sf_dir, "events"), F.col("ts"), st.AS_OF, 7).select("event_id", "ts")


@query
def age_newer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.within_age(st.table(spark, sf_dir, "events"), F.col("ts"), st.AS_OF, 7, latest=True).select("event_id", "ts")


@query
def no_reposts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.no_reposts(st.posts(spark, sf_dir)).select(*BRIEF)


@query
def lang_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.in_language(st.posts(spark, sf_dir)).select(*BRIEF)


@query
def likes_gt(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.on_likes(st.posts(spark, sf_dir), 1475).select(*BRIEF)


@query
def likes_lt(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.on_likes(st.posts(spark, sf_dir), 1475, less=False).select(*BRIEF)


@query
def mute_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.drop_containing(st.posts(spark, sf_dir, st.texts_of), "full_text", st.MUTE_WORDS).select("id")


@query
def mute_drop_cs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.drop_containing(st.posts(spark, sf_dir, st.texts_of), "full_text", st.MUTE_WORDS_CS, case_sensitive=True).select("id")


@query
def mute_any(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = filters.drop_containing(st.posts(spark, sf_dir, st.texts_of), "full_text", st.MUTE_WORDS)
    return filters.drop_containing(kept, "full_text", st.MUTE_WORDS_CS, case_sensitive=True).select("id")


@query
def mute_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return idsets.muted_word_matches(st.posts(spark, sf_dir, st.texts_of), st.MUTE_WORDS, st.MUTE_WORDS_CS)


def _long_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every customer name and every domain label of the pages."""
    names = st.members(spark, sf_dir).select(F.col("screen_name").alias("word"))
    hosts = st.table(spark, sf_dir, "pages").select(F.split_part(ux.url_domain(F.col("url")), F.lit("."), F.lit(1)).alias("word"))
    return names.unionByName(hosts).distinct()


@query
def mute_matches_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The long-list form, from a table of words."""
    return filters.word_matches(st.posts(spark, sf_dir, st.texts_of), "full_text", _long_words(spark, sf_dir))


@query
def mute_drop_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.drop_containing(st.posts(spark, sf_dir, st.texts_of), "full_text", _long_words(spark, sf_dir)).select("id")


@query
def news_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.filter_news(st.page_posts(spark, sf_dir), st.NEWS_DOMAINS).select("id")


@query
def author_exclude(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_members(st.posts(spark, sf_dir), "user", [3, 7, 11]).select(*BRIEF)


@query
def author_include(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keep_members(st.posts(spark, sf_dir), "user", [3, 7, 11]).select(*BRIEF)


@query
def muted_author_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    muted = idsets.muted_members(st.members(spark, sf_dir), st.MUTED_LISTS)
    return idsets.muted_author_ids(st.posts(spark, sf_dir), muted)


@query
def friends_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keep_members(st.posts(spark, sf_dir), "user", st.friends(spark, sf_dir)).select(*BRIEF)


@query
def non_friends(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_members(st.posts(spark, sf_dir), "user", st.friends(spark, sf_dir)).select(*BRIEF)


@query
def list_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    on_list = payloads.members_of(st.members(spark, sf_dir), "BUILDING")
    return keep_members(st.posts(spark, sf_dir), "user", on_list).select(*BRIEF)


@query
def anti_liked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookups.drop_liked(st.posts(spark, sf_dir), st.likes(spark, sf_dir)).select("id")


@query
def unscored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookups.unscored(st.posts(spark, sf_dir), st.scores(spark, sf_dir)).select("id")


# --- joins, lookups, dedup -------------------------------------------------------------


@query
def anti_seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookups.drop_seen(st.posts(spark, sf_dir), st.delivery_log(spark, sf_dir)).select("id")


@query
def score_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookups.add_scores(st.posts(spark, sf_dir).select("id"), st.scores(spark, sf_dir))


@query
def score_join_dup_reset(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = st.scores(spark, sf_dir)
    delivered = st.delivery_log(spark, sf_dir).select(F.col("post_id").alias("id"), F.lit(0.5).alias("predicted"))
    return lookups.add_scores(st.posts(spark, sf_dir).select("id"), stored.unionByName(delivered), on_duplicate="reset")


@query
def score_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = st.table(spark, sf_dir, "labels")
    current = labels.where(F.col("quality") == 1).select(F.col("doc_id").alias("id"), st.byte_score(F.col("doc_id")).alias("predicted"))
    again = labels.where((F.col("toxic") == 1) | (F.col("quality") == 0))
    fresh = again.select(F.col("doc_id").alias("id"), st.byte_score(F.col("doc_id"), 3).alias("predicted"))
    return lookups.upsert_scores(current, fresh)


@query
def score_upsert_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three upserts into a table in buckets, and a fourth that fails its checks; the third one's table is read."""
    root, labels = shared_folder(spark, "score-buckets"), st.table(spark, sf_dir, "labels")
    for position, rows in ((1, F.col("quality") == 1), (3, (F.col("toxic") == 1) | (F.col("quality") == 0)), (5, F.col("toxic") == 1)):
        fresh = labels.where(rows).select(F.col("doc_id").alias("id"), st.byte_score(F.col("doc_id"), position).alias("predicted"))
        buckets.upsert_buckets(fresh, root, "id", lookups.upsert_scores, schema.SCORES, quality.SCORES_SUITE)
    try:
        buckets.upsert_buckets(st.scores(spark, sf_dir).withColumn("predicted", F.lit(2.0)), root, "id", lookups.upsert_scores, schema.SCORES, quality.SCORES_SUITE)
    except quality.CheckFailed:
        pass
    return buckets.read_buckets(spark, root, schema.SCORES)


def _byte_scorer(posts: DataFrame) -> DataFrame:
    return posts.select("id", st.byte_score(F.col("id"), 5).alias("predicted"))


@query
def score_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    posts = st.posts(spark, sf_dir)
    log = st.delivery_log(spark, sf_dir)
    return scoring.score_posts(posts, _byte_scorer, st.scores(spark, sf_dir), log, mode="overwrite")


@query
def thread_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookups.with_thread_text(st.turn_posts(spark, sf_dir)).select("id", "full_text")


@query
def seen_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return st.delivery_log(spark, sf_dir).dropDuplicates()


@query
def runs_by_tag(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(metrics.runs_by_tag(st.runs(spark, sf_dir), "type", "train").select("run_id", "f1_class1"), "f1_class1")


# --- id sets ---------------------------------------------------------------------------


@query
def neg_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    posts = st.page_posts(spark, sf_dir)
    muted = idsets.muted_members(st.members(spark, sf_dir), st.MUTED_LISTS)
    return idsets.negative_ids(
        muted_word=idsets.muted_word_matches(posts, st.MUTE_WORDS, st.MUTE_WORDS_CS),
        muted_author=idsets.muted_author_ids(posts, muted),
        news=idsets.news_ids(posts, st.NEWS_DOMAINS),
        rejected=st.rejected(spark, sf_dir),
    )


@query
def pos_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return idsets.positive_ids(st.own_posts(spark, sf_dir), st.likes(spark, sf_dir))


@query
def pos_ids_intended(spark: SparkSession, sf_dir: str) -> DataFrame:
    return idsets.positive_ids(st.own_posts(spark, sf_dir), st.likes(spark, sf_dir), engagement="intended")


@query
def muted_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    return idsets.muted_members(st.members(spark, sf_dir), st.MUTED_LISTS)


@query
def missing_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return idsets.missing_ids(st.posts(spark, sf_dir), st.labelled(spark, sf_dir))


@query
def news_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return idsets.news_ids(st.page_posts(spark, sf_dir), st.NEWS_DOMAINS)


@query
def release_unseen(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = lookups.add_scores(st.posts(spark, sf_dir).select("id"), st.scores(spark, sf_dir))
    batch = ranking.top_n(scored, 30).select(F.col("id").alias("post_id"), "position")
    delivered = batch.select("post_id", F.lit("no_errors").alias("err_reason"))
    return ranking.release_unseen(st.delivery_log(spark, sf_dir).unionByName(delivered), batch, read_up_to=12)


@query
def label_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    posts = st.posts(spark, sf_dir, st.texts_of)
    muted = idsets.muted_members(st.members(spark, sf_dir), st.MUTED_LISTS)
    negative = idsets.negative_ids(
        muted_word=idsets.muted_word_matches(posts, st.MUTE_WORDS, st.MUTE_WORDS_CS),
        muted_author=idsets.muted_author_ids(posts, muted),
        news=idsets.news_ids(st.page_posts(spark, sf_dir), st.NEWS_DOMAINS),
        rejected=st.rejected(spark, sf_dir),
    )
    positive = idsets.positive_ids(st.own_posts(spark, sf_dir), st.likes(spark, sf_dir))
    return labelling.label_set(posts, positive, negative).select("id", "labels")


# --- aggregations ----------------------------------------------------------------------


@query
def delivery_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.col("o_orderstatus")
    reason = F.when(status == "O", "no_errors").when(status == "F", "not_found").otherwise("duplicate")
    return counts.frequencies(st.table(spark, sf_dir, "orders").select(reason.alias("err_reason")), "err_reason")


@query
def lang_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts.frequencies(st.posts(spark, sf_dir), "lang")


@query
def label_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts.frequencies(st.labelled(spark, sf_dir), "label")


@query
def class_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    split = st.labelled(spark, sf_dir).withColumn("split", vx.split_name(F.col("id")))
    return rounded(counts.class_balance(split, "split", "label"), "ratio")


@query
def positive_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(counts.positive_share(st.labelled(spark, sf_dir), "label"), "positive_share")


@query
def class_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(counts.class_weights(st.labelled(spark, sf_dir), "label"), "weight")


@query
def weight_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(counts.weight_grid(st.labelled(spark, sf_dir), "label"), "ratio", "weight_0")


@query
def collection_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = st.table(spark, sf_dir, "events").select(F.col("user_id").alias("collection"))
    return counts.collection_sizes(entries, "collection", schema.COLLECTION_MESSAGE_FROM)


def _clean_docs(spark: SparkSession, sf_dir: str, terms_of: Callable[[Column], Column]) -> DataFrame:
    """``id, label, terms`` of the labelled documents' cleaned text."""
    docs = st.labelled_texts(spark, sf_dir)
    cleaned = docs.select("id", "label", tx.clean_text(F.col("full_text")).alias("text"))
    return cleaned.select("id", "label", terms_of(F.col("text")).alias("terms"))


def _word_terms(spark: SparkSession, sf_dir: str, longest: int) -> DataFrame:
    words = _clean_docs(spark, sf_dir, lambda t: tx.without_stop_words(tx.word_tokens(t), st.STOP_WORDS))
    return words.withColumn("terms", tx.ngrams(F.col("terms"), longest))


@query
def top_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _clean_docs(spark, sf_dir, lambda t: F.filter(F.split(t, " "), lambda w: w != ""))
    return terms.top_terms(terms.class_term_counts(docs), 10)


@query
def top_ngrams(spark: SparkSession, sf_dir: str) -> DataFrame:
    return terms.top_terms(terms.class_term_counts(_word_terms(spark, sf_dir, 3)), 20)


@query
def top_tfidf(spark: SparkSession, sf_dir: str) -> DataFrame:
    weights = rounded(terms.class_tfidf(_word_terms(spark, sf_dir, 3)), "value")
    return terms.top_terms(weights, 20)


@query
def ngram_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return terms.term_counts(_word_terms(spark, sf_dir, 3))


def _judged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return st.labelled(spark, sf_dir).withColumn("prediction", (st.byte_score(F.col("id")) >= 0.5).cast("int"))


@query
def confusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.confusion(_judged(spark, sf_dir))


@query
def class_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(metrics.class_report(metrics.confusion(_judged(spark, sf_dir))), "precision", "recall", "f1")


@query
def majority_baseline(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = counts.majority_class(st.labelled(spark, sf_dir), "label")
    return rounded(metrics.class_report(metrics.confusion(judged)), "precision", "recall", "f1")


@query
def split_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return st.posts(spark, sf_dir).select("id", vx.split_name(F.col("id")).alias("split"))


@query
def fold_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.stratified_fold(st.labelled(spark, sf_dir), "label", "id")


# --- sorts, limits, top-k --------------------------------------------------------------

RULES = feed.FeedRules(mute_words=st.MUTE_WORDS, mute_words_cs=st.MUTE_WORDS_CS, news_domains=st.NEWS_DOMAINS, min_likes=500)


def _batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    posts = st.linked_posts(spark, sf_dir)
    return feed.feed_batch(posts, RULES, st.delivery_log(spark, sf_dir), st.scores(spark, sf_dir))


@query
def feed_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.rank_by_score(_batch(spark, sf_dir)).select("id", "user", "full_text", "preds")


@query
def feed_top_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole delivery: audience rules, batch, first thirty with positions."""
    audience = feed.Audience(
        owner=OWNER_AUTHOR,
        muted=idsets.muted_members(st.members(spark, sf_dir), st.MUTED_LISTS),
        friends=st.friends(spark, sf_dir),
        not_friends_only=True,
        liked=st.likes(spark, sf_dir),
    )
    posts = feed.from_audience(st.linked_posts(spark, sf_dir), audience)
    batch = feed.feed_batch(posts, RULES, st.delivery_log(spark, sf_dir), st.scores(spark, sf_dir))
    return ranking.top_n(batch.select("id", "user", "preds"), 30)


OWNER_AUTHOR = 17


@query
def deliver_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log after three deliveries, of which the second ran twice; age, owner and scores apply."""
    log = shared_folder(spark, "deliveries")
    for batch_id in (0, 1, 1, 2):
        feed.deliver(
            st.posts(spark, sf_dir, st.texts_of), feed.FeedRules(remove_news=False), feed.Audience(owner=OWNER_AUTHOR), log, batch_id,
            as_of="2024-01-03", age_days=1, size=10, scores=st.scores(spark, sf_dir),
        )
    return sinks.read_batches(spark, log, schema.DELIVERY_LOG)


@query
def top3_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.top_n(_batch(spark, sf_dir).select("id", "preds"), 3).select("preds", "position")


def _positioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = lookups.add_scores(st.posts(spark, sf_dir).select("id", "user"), st.scores(spark, sf_dir))
    return ranking.positions(scored)


@query
def feed_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every post's place by score."""
    return _positioned(spark, sf_dir).select("id", "preds", "position")


@query
def feed_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The third page of fifty."""
    return ranking.page(_positioned(spark, sf_dir), 2, 50).select("id", "preds", "position")


@query
def best_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(metrics.best_run(st.runs(spark, sf_dir)).select("run_id", "f1_class1"), "f1_class1")


@query
def runs_ordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = schema.RUN_METRICS
    return rounded(metrics.runs_ordered(st.runs(spark, sf_dir), "f1_class1"), *names).select("experiment_seq", "run_id", *names)


@query
def retrain_due(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(metrics.retrain_due(st.runs(spark, sf_dir)).select("run_id", "f1_class1"), "f1_class1")


# --- strings, arrays, values -----------------------------------------------------------


def _pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return st.texts_of(spark, sf_dir, "pages").select("page_id", "url", st.page_text().alias("text"))


@query
def extract_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = F.explode_outer(ux.extract_urls(F.col("text"))).alias("url")
    return _pages(spark, sf_dir).select("page_id", found).where(F.col("url").isNotNull())


@query
def url_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = F.posexplode_outer(ux.extract_urls(F.col("text"))).alias("position", "url")
    return _pages(spark, sf_dir).select("page_id", found).where(F.col("url").isNotNull()).select("page_id", "url", (F.col("position") + 1).cast("bigint").alias("position"))


@query
def url_domains(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = F.explode_outer(ux.url_domains(F.col("text"))).alias("domain")
    return _pages(spark, sf_dir).select("page_id", found).where(F.col("domain").isNotNull())


@query
def url_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    sized = _pages(spark, sf_dir).select(F.size(ux.url_domains(F.col("text"))).cast("bigint").alias("n"))
    return sized.agg(F.max("n").alias("most"), F.sum("n").alias("total"), F.count_if(F.col("n") > 0).alias("posts_with_links"))


@query
def clean_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    messy = F.concat(F.lit('"'), F.col("url"), F.lit(',)!"’s page'))
    return st.table(spark, sf_dir, "pages").select("page_id", ux.clean_url(messy).alias("url"))


STRIPPED_HOSTS = ("therha.example.com", "ththre.example.com", "spam-farm.example.org")


@query
def strip_host_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pages(spark, sf_dir).select("page_id", ux.strip_host_urls(F.col("text"), STRIPPED_HOSTS).alias("text"))


@query
def strip_short_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    once = ux.strip_short_links(F.col("text"), STRIPPED_HOSTS)
    return _pages(spark, sf_dir).select("page_id", ux.strip_short_links(once, STRIPPED_HOSTS).alias("text"))


@query
def url_domain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return st.table(spark, sf_dir, "pages").select("page_id", ux.url_domain(F.col("url")).alias("domain"))


@query
def drop_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = ux.drop_empty(F.split("url", "/"))
    return st.table(spark, sf_dir, "pages").select("page_id", F.array_join(parts, "|").alias("parts"))


@query
def news_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pages(spark, sf_dir).select("page_id", ux.news_flag(F.col("text"), st.NEWS_DOMAINS).alias("contains_news"))


@query
def news_flag_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table form: the domains of all campaign links are the news list."""
    pages = st.table(spark, sf_dir, "pages").where(F.contains("url", F.lit("utm_source")))
    campaign = pages.select(ux.url_domain(F.col("url")).alias("domain"))
    return filters.flag_news(_pages(spark, sf_dir), campaign, column="text").select("page_id", "contains_news")


def _texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return st.posts(spark, sf_dir, st.texts_of).select("id", "full_text")


@query
def clean_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _texts(spark, sf_dir).select("id", tx.clean_text(F.col("full_text")).alias("text"))


@query
def clean_text_neg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _texts(spark, sf_dir).select("id", tx.clean_text(F.col("full_text"), "expand").alias("text"))


@query
def treebank_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _texts(spark, sf_dir).select("id", F.array_join(tx.treebank_tokens(F.col("full_text")), " ").alias("tokens"))


@query
def word_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _texts(spark, sf_dir).select("id", F.array_join(tx.word_tokens(F.col("full_text")), " ").alias("text"))


@query
def ids_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = st.table(spark, sf_dir, "conversations").select("conv_id", "turn", (F.col("conv_id") * 100 + F.col("turn")).alias("id"))
    return payloads.id_batches(turns, "conv_id", "turn").select("conv_id", "batch", "ids")


@query
def null_sentinel(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = st.turn_posts(spark, sf_dir).select("id", vx.to_sentinel(F.col("in_reply_to_status_id")).alias("reply_text"))
    return stored.withColumn("reply_id", vx.from_sentinel(F.col("reply_text")))


# --- data quality ----------------------------------------------------------------------


@query
def dq_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    delivered = st.delivery_log(spark, sf_dir).select(F.col("post_id").alias("id"), F.lit(1.5).alias("predicted"))
    return quality.run_checks(
        st.scores(spark, sf_dir).unionByName(delivered),
        quality.RowCount(*schema.LABEL_SET_ROWS),
        quality.Between("predicted", *schema.SCORE_RANGE),
        quality.Unique("id"),
    )


@query
def dq_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = st.scores(spark, sf_dir)
    results = quality.run_checks(checked, *[quality.HasColumn(c) for c in ("id", "predicted", "labels")])
    return results.withColumn("rows_checked", checked.agg(F.count(F.lit(1))).scalar())


# --- learning --------------------------------------------------------------------------


def _learning_text(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    docs = st.labelled_texts(spark, sf_dir)
    cleaned = docs.select("id", F.col("label").cast("double").alias("label"), tx.clean_text(F.col("full_text")).alias("text"))
    split = cleaned.withColumn("split", vx.split_name(F.col("id")))
    return cleaned, split.where(F.col("split") == "train"), split.where(F.col("split") == "test")


@contextmanager
def _features(train: DataFrame, *others: DataFrame) -> Iterator[list[DataFrame]]:
    """Ready features of each table, every 1-3-gram of the training part counted, kept until the fits are done."""
    prepared = training.fit_features(train, stop_words=st.STOP_WORDS)
    ready = [prepared.transform(d).select("id", "label", "features").persist(StorageLevel.MEMORY_AND_DISK) for d in (train, *others)]
    try:
        yield ready
    finally:
        for df in ready:
            df.unpersist()


@query
def lr_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, train, test = _learning_text(spark, sf_dir)
    if blocks := training.fit_blocks(train, test, at_once=1, stop_words=st.STOP_WORDS):
        with blocks:
            points = [(0, 1.0 / training.trained_counts(blocks).balanced, 1.0)]
            rows = [cell for g in termblocks.fits(blocks, points) for _, *cell in termblocks.confusion(blocks, g)]
        return metrics.class_report(spark.createDataFrame(rows, "label int, prediction int, n bigint"))
    with _features(train, test) as (ready, held_out):
        counts_ = training.ClassCounts.of(ready)
        model = training.fit_weighted(training.compact(ready, counts_.rows), counts_, 1.0 / counts_.balanced, 1.0)
        rows = training.confusion_rows(model, held_out)
    return metrics.class_report(spark.createDataFrame(rows, "label int, prediction int, n bigint"))


@query
def weight_grid_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, train, test = _learning_text(spark, sf_dir)
    if blocks := training.fit_blocks(train, test, stop_words=st.STOP_WORDS):
        with blocks:
            return training.blocks_grid_report(blocks)
    with _features(train, test) as (ready, held_out):
        return training.weight_grid_report(ready, held_out)


@query
def cv_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, train, _ = _learning_text(spark, sf_dir)
    if blocks := training.fit_blocks(train, stop_words=st.STOP_WORDS):
        with blocks:
            return training.blocks_cv_scores(blocks, training.weight_range())
    with _features(train) as (ready,):
        return training.cv_scores(ready, training.weight_range())


#: Largest gradient entry, against the total weight, of a fit that counts as optimal.
OPTIMAL = 1e-7


def _kept(found: DataFrame) -> DataFrame:
    """A few rows per fit, computed now, while the features are there."""
    return found.sparkSession.createDataFrame(found.collect(), found.schema)


@query
def grid_certificate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every fit of the ratio grid: its ratio, its training rows, and whether the gradient vanishes at its coefficients."""
    _, train, test = _learning_text(spark, sf_dir)
    if blocks := training.fit_blocks(train, test, stop_words=st.STOP_WORDS):
        with blocks:
            ratios = training.ratio_grid(training.trained_counts(blocks))
            groups = termblocks.fits(blocks, [(0, 1.0 / r, 1.0) for r in ratios], tolerance=OPTIMAL)
            checked = [(round(ratios[k], 6), n, gradient <= OPTIMAL) for g in groups for k, n, gradient in termblocks.gradients(blocks, g)]
        return spark.createDataFrame(checked, "ratio double, rows bigint, optimal boolean")
    with _features(train, test) as (ready, held_out):
        ratios = training.ratio_grid(training.ClassCounts.of(ready))
        rows, fitted = training.grid_fits(ready, held_out, ratios)
        found = rowspace.certificates(rowspace.trained_on(fitted, rows), rowspace.coefficients(fitted, rows), rowspace.entries_of(rows.table))
        named = spark.createDataFrame(list(enumerate(ratios)), "_fit int, ratio double")
        met = found.join(F.broadcast(named), F.col("fit") == F.col("_fit"))
        return _kept(met.select(F.round("ratio", 6).alias("ratio"), "rows", (F.col("gradient") <= OPTIMAL).alias("optimal")))


@query
def cv_certificate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every weight of the search over 200 weights and 5 folds: its fits, their training rows, and whether all fits meet the optimality condition row by row."""
    _, train, _ = _learning_text(spark, sf_dir)
    if blocks := training.fit_blocks(train, stop_words=st.STOP_WORDS):
        with blocks:
            points = training.cv_points(training.weight_range())
            groups = termblocks.fits(blocks, points, tolerance=OPTIMAL)
            checked = [(points[k][1], n, residual) for g in groups for k, n, residual in termblocks.residuals(blocks, g)]
        found = spark.createDataFrame(checked, "weight_0 double, rows bigint, residual double")
        by_weight = found.groupBy(F.round("weight_0", 6).alias("weight_0"))
        return by_weight.agg(F.count(F.lit(1)).alias("fits"), F.sum("rows").alias("rows"), (F.max("residual") <= OPTIMAL).alias("optimal"))
    with _features(train) as (ready,):
        rows, fitted = training.cv_fits(ready, training.weight_range())
        found = rowspace.residuals(fitted, rows)
        named = fitted.select(F.col("fit").alias("_fit"), "weight_0")
        met = found.join(named, F.col("fit") == F.col("_fit")).groupBy(F.round("weight_0", 6).alias("weight_0"))
        return _kept(met.agg(F.count(F.lit(1)).alias("fits"), F.sum("rows").alias("rows"), (F.max("residual") <= OPTIMAL).alias("optimal")))


@query
def runs_reeval(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned, train, test = _learning_text(spark, sf_dir)
    records = training.train_runs(
        train, test, "grid", 0, shared_folder(spark, "models"), stop_words=st.STOP_WORDS
    )
    return training.reevaluate(spark, records, cleaned, tables.exists)


# --- streaming -------------------------------------------------------------------------


def _table_stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table as a stream; the pattern matches one name, whether it is a file or a folder."""
    return jobs.file_stream(spark, f"{sf_dir}/{name}.parque[t]", st.table(spark, sf_dir, name).schema)


def _event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table_stream(spark, sf_dir, "events")


def _post_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _as_posts(_table_stream(spark, sf_dir, "documents"))


def _as_posts(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.col("doc_id").alias("id"),
        F.regexp_extract("source", "([0-9]+)$", 1).try_cast("bigint").alias("user"),
        F.col("text").alias("full_text"),
        "lang",
        F.when(F.col("n_chars") < 400, F.col("doc_id")).alias("retweeted_status"),
    )


@query
def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, checkpoint = shared_folder(spark, "ingest"), shared_folder(spark, "ingest-state")
    events = _event_stream(spark, sf_dir).select("event_id", "ts", "user_id", "event_type")
    jobs.ingest(events, "event_id", out, checkpoint, event_time="ts")
    return sinks.read_batches(spark, out, events.schema).drop("batch_id")


@query
def stream_ingest_watermark(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, checkpoint = shared_folder(spark, "ingest"), shared_folder(spark, "ingest-state")
    events = _event_stream(spark, sf_dir).select("event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id", "event_type")
    jobs.ingest_within(events, "event_id", "ts", "60 days", out, checkpoint)
    return spark.read.schema(events.schema).parquet(out).withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@query
def stream_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``score_overwrite``, post by post as they land."""
    out, checkpoint = shared_folder(spark, "scores"), shared_folder(spark, "scores-state")
    jobs.score(_post_stream(spark, sf_dir), _byte_scorer, out, checkpoint, st.delivery_log(spark, sf_dir))
    return jobs.stored_scores(spark, out)


@query
def stream_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, checkpoint = shared_folder(spark, "feed"), shared_folder(spark, "feed-state")
    jobs.feed(_post_stream(spark, sf_dir), st.delivery_log(spark, sf_dir), out, checkpoint)
    return sinks.read_batches(spark, out, schema.DELIVERY_LOG).drop("batch_id")


#: Documents of a landed file, however few splits a cluster reads its table in.
LANDED_DOCS = 20_000


def _landing(spark: SparkSession, sf_dir: str, name: str, most: int | None = None) -> tuple[str, StructType, Callable[[int], None], int]:
    """An empty folder, the schema of a table, what lands the table there, and the files of a micro-batch.

    Each call lands a half, with some rows of the other half, in three files or as many as the table has splits, so no task writes more
    as the table grows; with ``most`` a file takes about so many rows of the table at most. A micro-batch takes two thirds of them: a half is two micro-batches at any size.
    """
    rows = st.table(spark, sf_dir, name)
    files = max(3, splits(rows), -(-rows.count() // most) if most else 0)
    folder, dealt = shared_folder(spark, f"landed-{name}"), F.pmod(F.xxhash64(rows.columns[0]), F.lit(12))

    def land(half: int) -> None:
        own = (dealt < 6) if half == 0 else (dealt >= 6)
        repeated = dealt.isin(7, 8) if half == 0 else dealt.isin(0, 1, 7)
        part = rows.where(own).unionByName(rows.where(repeated))
        part.repartition(files).write.mode("append").parquet(folder)

    return folder, rows.schema, land, -(-2 * files // 3)


@query
def stream_ingest_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events that land in six files, or more of a large table, with repeats, within a file and between them; a stop and a merge of the stored batches lie between the halves."""
    landed, columns, land, taken = _landing(spark, sf_dir, "events")
    out, checkpoint = shared_folder(spark, "ingest"), shared_folder(spark, "ingest-state")
    for half in (0, 1):
        land(half)
        events = jobs.file_stream(spark, landed, columns, files_per_trigger=taken).select("event_id", "ts", "user_id", "event_type")
        jobs.ingest(events, "event_id", out, checkpoint, event_time="ts")
        if half == 0:
            jobs.compact(spark, out, events.schema, 1, "event_id", "ts")
    return sinks.read_batches(spark, out, events.schema, by_day=True).select("event_id", "ts", "user_id", "event_type")


def _landed_posts(spark: SparkSession, landed: str, columns: StructType, files: int) -> DataFrame:
    return _as_posts(jobs.file_stream(spark, landed, columns, files_per_trigger=files))


@query
def stream_score_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``stream_score``, from six files, or more of a large table, with repeats and a stop after half of them."""
    landed, columns, land, taken = _landing(spark, sf_dir, "documents", LANDED_DOCS)
    out, checkpoint = shared_folder(spark, "scores"), shared_folder(spark, "scores-state")
    for half in (0, 1):
        land(half)
        jobs.score(_landed_posts(spark, landed, columns, taken), _byte_scorer, out, checkpoint, st.delivery_log(spark, sf_dir))
    return sinks.read_batches(spark, out, schema.SCORES).select("id", "predicted")


@query
def stream_feed_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``stream_feed``, from six files, or more of a large table, with repeats and a stop after half of them."""
    landed, columns, land, taken = _landing(spark, sf_dir, "documents", LANDED_DOCS)
    out, checkpoint = shared_folder(spark, "feed"), shared_folder(spark, "feed-state")
    for half in (0, 1):
        land(half)
        jobs.feed(_landed_posts(spark, landed, columns, taken), st.delivery_log(spark, sf_dir), out, checkpoint)
    return sinks.read_batches(spark, out, schema.DELIVERY_LOG).drop("batch_id")
