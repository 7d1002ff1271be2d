"""Edge tables: null ids and texts, duplicates, ties, empty input, hot keys."""

import random
from collections import Counter
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from feedloom import schema
from feedloom.operators import counts, filters, grams, idsets, joins, lookups, metrics, quality, ranking, terms
from feedloom.plans import feed, labelling
from feedloom.sources import payloads, tables


def make_posts(spark, rows):
    """Rows of (id, user, text) plus optional overrides."""
    base = dict(created_at=datetime(2024, 1, 1), lang="en", retweeted_status=None, quoted_status=None, is_quote_status=False, in_reply_to_status_id=None, favorite_count=1)
    full = []
    for id_, user, text, *rest in rows:
        row = {**base, "id": id_, "user": user, "full_text": text, **(rest[0] if rest else {})}
        full.append(tuple(row[c] for c in schema.POSTS.names))
    return spark.createDataFrame(full, schema.POSTS)


def ids(df, column="id"):
    return sorted((r[column] for r in df.select(column).collect()), key=lambda v: (v is None, v))


def test_age_is_typed_and_drops_missing_times(spark):
    posts = make_posts(
        spark,
        [
            (1, 1, "a", {"created_at": datetime(2024, 1, 7, 23, 59)}),
            (2, 1, "b", {"created_at": datetime(2024, 1, 8)}),
            (3, 1, "c", {"created_at": None}),
        ],
    )
    assert ids(tables.posts_by_age(posts, "2024-01-15", 7)) == [1]
    assert ids(tables.posts_by_age(posts, "2024-01-15", 7, latest=True)) == [2]


def test_likes_are_strict_both_ways(spark):
    posts = make_posts(spark, [(i, 1, "t", {"favorite_count": i}) for i in (4, 5, 6)])
    assert ids(filters.on_likes(posts, 5)) == [6]
    assert ids(filters.on_likes(posts, 5, less=False)) == [4]


def test_null_text_is_kept_by_mute_and_news(spark):
    posts = make_posts(spark, [(1, 1, None), (2, 1, "has COVID"), (3, 1, "http://cnn.com/x")])
    assert ids(filters.drop_containing(posts, "full_text", ["covid"])) == [1, 3]
    assert ids(filters.drop_containing(posts, "full_text", ["covid"], case_sensitive=True)) == [1, 2, 3]
    assert ids(filters.filter_news(posts, ["cnn.com"])) == [1, 2]
    assert filters.filter_news(posts.limit(0), ["cnn.com"]).count() == 0


def test_domain_table_equals_domain_list(spark):
    texts = [None, "x", "http://cnn.com/a http://edition.cnn.com/b", "https://www.bbc.co.uk/n", "http://t.co/x"]
    posts = make_posts(spark, [(i, 1, t) for i, t in enumerate(texts)])
    table = spark.createDataFrame([("cnn.com",), ("bbc.co.uk",), ("cnn.com",)], "domain string")
    flags = lambda df: {r["id"]: r["contains_news"] for r in df.collect()}
    expected = {0: 0, 1: 0, 2: 1, 3: 1, 4: 0}
    assert flags(filters.flag_news(posts, ["cnn.com", "bbc.co.uk"])) == expected
    assert flags(filters.flag_news(posts, table)) == expected
    many = ["cnn.com", "bbc.co.uk", *[f"d{i}.org" for i in range(1_200)]]
    assert flags(filters.flag_news(posts, many)) == expected


def test_long_word_lists_equal_brute_force(spark):
    texts = ["the Quick brown fox", "a", "", "x🍿y", None, "ab" * 50 + "needle" + "z" * 50, "É tude"]
    posts = make_posts(spark, [(i, 1, t) for i, t in enumerate(texts)])
    words = ["QUICK", "a", "🍿", "needle", "needles", "é", "ow", "bababa", "zzzz", "", "fox"]
    for cs in (False, True):
        table = spark.createDataFrame([(w,) for w in words], "word string")
        found = Counter((r["id"], r["word"]) for r in filters.word_matches(posts, "full_text", table, cs).collect())
        fold = (lambda s: s) if cs else str.lower
        expected = Counter((i, w) for i, t in enumerate(texts) if t is not None for w in words if fold(w) in fold(t))
        assert found == expected
        inline = Counter((r["id"], r["word"]) for r in filters.word_matches(posts, "full_text", words, cs).collect())
        assert inline == expected
    long_table = spark.createDataFrame([("needle",), ("quick",)], "word string")
    assert ids(filters.drop_containing(posts, "full_text", long_table)) == [1, 2, 3, 4, 6]
    assert filters.word_matches(posts, "full_text", table.limit(0)).count() == 0


@pytest.mark.parametrize("spread", [False, True])
def test_rarest_grams_find_what_a_scan_finds(spark, monkeypatch, spread):
    if spread:  # as beyond any broadcast
        for module in (grams, filters):
            monkeypatch.setattr(module, "fits_broadcast", lambda df: False)
        monkeypatch.setattr(grams, "BROADCAST_ROWS", 0)
    rng = random.Random(5)
    texts = ["".join(rng.choice("abAé ") for _ in range(rng.choice([0, 3, 60, 400]))) for _ in range(80)]
    words = {"".join(rng.choice("abé ") for _ in range(rng.choice([1, 2, 3, 4, 5, 8, 12]))) for _ in range(300)}
    words |= {t[5:40] for t in texts[:20] if len(t) > 50} | {"never seen", "é" * 7}
    posts = make_posts(spark, [(i, 1, t) for i, t in enumerate(texts)] + [(99, 1, None), (5, 1, texts[5])])
    table = spark.createDataFrame([(w,) for w in sorted(words)], "word string")
    for cs in (True, False):
        fold = (lambda s: s) if cs else str.lower
        expected = Counter((r["id"], w) for r in posts.collect() for w in words if r["full_text"] is not None and fold(w) in fold(r["full_text"]))
        assert Counter((r["id"], r["word"]) for r in filters.word_matches(posts, "full_text", table, cs).collect()) == expected
        kept = [r["id"] for r in filters.drop_containing(posts, "full_text", table.where("word <> ' '").where("length(word) > 3"), cs).collect()]
        dropped = {i for (i, w) in expected if len(w) > 3}
        assert sorted(kept) == sorted(i for i in [*range(80), 99, 5] if i not in dropped)


def test_a_long_word_in_a_long_text(spark):
    """Places are numbers: a word of 10 kB in texts of 1 MB costs a look, not a tail per place."""
    rng = random.Random(7)
    long_word = "".join(rng.choice("abcdef") for _ in range(10_000))
    filler = "".join(rng.choice("abcdef ") for _ in range(500_000))
    posts = make_posts(spark, [(1, 1, filler + long_word + filler), (2, 1, filler + long_word[:-1] + "g" + filler), (3, 1, filler * 2)])
    words = spark.createDataFrame([(long_word,), ("abcdefabcdefabcdef",)], "word string")
    assert [(r["id"], r["word"]) for r in filters.word_matches(posts, "full_text", words).collect()] == [(1, long_word)]


def test_filters_answer_alike_at_every_list_size(spark):
    posts = make_posts(spark, [(None, 1, "has covid"), (None, 1, "clean"), (1, 1, "has COVID"), (1, 1, "clean"), (2, 1, "clean"), (3, 1, None), (4, 1, "covid covid")])
    rows = lambda df: Counter((r["id"], r["full_text"]) for r in df.collect())
    kept, found, flags = None, None, None
    news = posts.withColumn("full_text", F.when(F.contains("full_text", F.lit("ovi")) | F.contains("full_text", F.lit("OVI")), F.lit("http://cnn.com/x")).otherwise(F.col("full_text")))
    for size in (1, 200, 201, 500, 501, 1_500):
        words = ["covid", "covid", *[f"zz{i}" for i in range(size - 1)]]
        domains = ["cnn.com", *[f"d{i}.org" for i in range(size - 1)]]
        for as_table in (False, True):
            w = spark.createDataFrame([(x,) for x in words], "word string") if as_table else words
            d = spark.createDataFrame([(x,) for x in domains], "domain string") if as_table else domains
            now_kept = rows(filters.drop_containing(posts, "full_text", w))
            now_found = Counter((r["id"], r["word"]) for r in filters.word_matches(posts, "full_text", w).collect())
            now_flags = Counter((r["id"], r["full_text"], r["contains_news"]) for r in filters.flag_news(news, d).collect())
            kept, found, flags = kept or now_kept, found or now_found, flags or now_flags
            assert now_kept == kept and now_found == found and now_flags == flags, (size, as_table)
    assert kept == Counter({(None, "clean"): 1, (1, "clean"): 1, (2, "clean"): 1, (3, None): 1})
    assert found == Counter({(None, "covid"): 2, (1, "covid"): 2, (4, "covid"): 2})
    assert sum(n for (_, _, f), n in flags.items() if f == 1) == 3


def test_threads_follow_links_not_ids(spark):
    posts = make_posts(spark, [
        (1, 1, "one"), (2, 1, "two"), (7, 1, "late"), (7, 1, "later"),
        (5, 1, "five", {"in_reply_to_status_id": 1}), (5, 1, "fifth", {"in_reply_to_status_id": 2}),
        (None, 1, "none", {"quoted_status": 1}), (6, 1, None, {"in_reply_to_status_id": 1, "quoted_status": 7}), (8, 1, None),
        (9, 1, "lost", {"in_reply_to_status_id": 404}),
    ])
    found = sorted(((r["id"] or 0, r["full_text"]) for r in lookups.with_thread_text(posts).collect()))
    assert found == sorted([
        (1, "one  "), (2, "two  "), (7, "late  "), (7, "later  "), (5, "five one "), (5, "fifth two "), (0, "none  one"), (6, " one later"), (8, "  "), (9, "lost  "),
    ])


def test_a_document_of_two_classes_is_one_in_each(spark):
    docs = spark.createDataFrame([(1, 0, ["a"]), (1, 1, ["a"]), (2, 1, ["b", "b"])], "id int, label int, terms array<string>")
    found = {(r["label"], r["term"]): r["value"] for r in terms.class_tfidf(docs).collect()}
    assert all(abs(v - 1) < 1e-9 for v in found.values()) and set(found) == {(0, "a"), (1, "a"), (1, "b")}


def test_anti_join_keeps_null_keys(spark):
    posts = make_posts(spark, [(None, None, "x"), (1, 7, "y"), (2, 8, "z")])
    log = spark.createDataFrame([(1, "no_errors"), (1, "no_errors"), (None, "no_errors")], schema.DELIVERY_LOG)
    assert ids(lookups.drop_seen(posts, log)) == [2, None]
    assert ids(joins.drop_members(posts, "user", [7])) == [2, None]
    assert ids(joins.keep_members(posts, "user", [7])) == [1]
    assert ids(joins.keep_members(posts, "user", [])) == []
    assert ids(joins.drop_members(posts, "user", range(5_000))) == [None]


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_spread_join_equals_plain_join(spark, how):
    rows = [(i, 1 if i % 3 == 0 else (None if i % 7 == 0 else i)) for i in range(600)]
    left = spark.createDataFrame(rows, "id bigint, k bigint")
    right = spark.createDataFrame([(i, f"v{i}") for i in range(0, 600, 2)] + [(1, "hot")], "rk bigint, v string")
    plain = left.join(right, F.col("k") == F.col("rk"), how)
    cut = joins.spread_join(left, right, {"k": "rk"}, how, ["id"], rows_per_piece=20)
    assert sorted(cut.columns) == sorted(plain.columns)
    assert Counter(map(tuple, cut.select(*plain.columns).collect())) == Counter(map(tuple, plain.collect()))


def test_hot_keys_are_cut_and_bounded(spark):
    left = spark.createDataFrame([(i, 1 if i % 3 == 0 else i) for i in range(3000)], "id bigint, k bigint")
    hot = joins.hot_keys(joins.key_load(left, "k"), rows_per_piece=100).collect()
    assert [(r["k"], r["_pieces"]) for r in hot] == [(1, 11)]


def test_large_membership_uses_the_spread_join(spark, monkeypatch):
    posts = make_posts(spark, [(i, i % 3, "t") for i in range(60)])
    members = spark.createDataFrame([(0,), (0,), (5,)], "m bigint")
    expected = [i for i in range(60) if i % 3 == 0]
    monkeypatch.setattr(joins, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(joins, "fits_broadcast", lambda df: False)
    assert ids(joins.keep_members(posts, "user", members)) == expected
    assert ids(joins.drop_members(posts, "user", members)) == [i for i in range(60) if i % 3]


def test_keep_last(spark):
    df = spark.createDataFrame([(1, 0.1, 0, "a"), (1, 0.2, 1, "b"), (2, 0.3, 0, "c")], "id int, p double, seq int, t string")
    assert sorted(map(tuple, joins.keep_last(df, ["id"], "seq").collect())) == [(1, 0.2, 1, "b"), (2, 0.3, 0, "c")]
    narrow = joins.keep_last(df.drop("t"), ["id"], "seq")
    assert sorted(map(tuple, narrow.collect())) == [(1, 0.2, 1), (2, 0.3, 0)]


def test_scores_missing_duplicate_and_reset(spark):
    posts = make_posts(spark, [(1, 1, "a"), (2, 1, "b")])
    scores = spark.createDataFrame([(1, 0.4)], schema.SCORES)
    as_map = lambda df: {r["id"]: r["preds"] for r in df.collect()}
    assert as_map(lookups.add_scores(posts, scores)) == {1: 0.4, 2: 0.0}
    duplicated = scores.union(spark.createDataFrame([(9, 0.1), (9, 0.2)], schema.SCORES))
    assert as_map(lookups.add_scores(posts, duplicated)) == {1: 0.4, 2: 0.0}
    assert as_map(lookups.add_scores(posts, duplicated, "reset")) == {1: 0.0, 2: 0.0}
    assert as_map(lookups.add_scores(posts, scores, "reset")) == {1: 0.4, 2: 0.0}
    with pytest.raises(ValueError):
        lookups.add_scores(posts, scores, "other")


def test_upsert_prefers_fresh(spark):
    old = spark.createDataFrame([(1, 0.1), (2, 0.2)], schema.SCORES)
    new = spark.createDataFrame([(2, 0.9), (3, 0.3)], schema.SCORES)
    assert sorted(map(tuple, lookups.upsert_scores(old, new).collect())) == [(1, 0.1), (2, 0.9), (3, 0.3)]


def test_thread_text_separators_and_missing_targets(spark):
    posts = make_posts(
        spark,
        [
            (1, 1, "a"),
            (2, 1, "b", {"in_reply_to_status_id": 1}),
            (3, 1, "c", {"in_reply_to_status_id": 1, "quoted_status": 2}),
            (4, 1, "d", {"quoted_status": 99}),
        ],
    )
    found = {r["id"]: r["full_text"] for r in lookups.with_thread_text(posts).collect()}
    assert found == {1: "a  ", 2: "b a ", 3: "c a b", 4: "d  "}


def test_thread_text_with_duplicate_target_ids(spark):
    posts = make_posts(
        spark,
        [(1, 1, "old"), (1, 1, "new", {"created_at": datetime(2024, 1, 2)}), (2, 1, "b", {"in_reply_to_status_id": 1})],
    )
    found = lookups.with_thread_text(posts)
    assert found.count() == 3
    assert found.where("id = 2").first()["full_text"] == "b new "


def test_top_n_breaks_ties_on_id(spark):
    df = spark.createDataFrame([(3, 0.5), (1, 0.5), (2, 0.9)], "id bigint, preds double")
    assert [(r["id"], r["position"]) for r in ranking.top_n(df, 2).orderBy("position").collect()] == [(2, 1), (1, 2)]


def test_positions_run_over_all_rows(spark):
    rng = random.Random(4)
    rows = [(i, rng.choice([0.0, 0.0, 0.25, 0.5, None]), "x") for i in range(500)] + [(None, 0.5, "n")]
    scored = spark.createDataFrame(rows, "id bigint, preds double, range string").repartition(7)
    found = ranking.positions(scored)
    assert found.columns == ["id", "preds", "range", "position"]
    order = sorted(rows, key=lambda r: (r[1] is None, -(r[1] or 0), r[0] is not None, r[0] or 0))
    assert [(r["id"], r["preds"]) for r in found.orderBy("position").collect()] == [r[:2] for r in order]
    assert sorted(r["position"] for r in found.collect()) == list(range(1, 502))
    assert [r["position"] for r in ranking.page(found, 3, 40).collect()] == list(range(121, 161))
    assert ranking.positions(scored.limit(0)).count() == 0
    plan = found._jdf.queryExecution().toString()
    assert "Window" not in plan and "SinglePartition" not in plan
    with pytest.raises(ValueError):
        ranking.page(found, 0, 0)


def test_release_unseen_returns_the_unread_part(spark):
    log = spark.createDataFrame([(i, "no_errors") for i in (1, 2, 3, 9)], schema.DELIVERY_LOG)
    batch = spark.createDataFrame([(1, 1), (2, 2), (3, 3)], "post_id bigint, position bigint")
    assert ids(ranking.release_unseen(log, batch, 2), "post_id") == [1, 2, 9]
    assert ids(ranking.release_unseen(log, batch, 3), "post_id") == [1, 2, 3, 9]


def test_stratified_folds_are_even_per_label(spark):
    df = spark.range(1000).select("id", (F.col("id") % 10 == 0).cast("int").alias("label"))
    sizes = ranking.stratified_fold(df, "label", "id").groupBy("label", "fold").count().collect()
    assert {(r["label"], r["count"]) for r in sizes} == {(0, 180), (1, 20)}


def test_id_sets(spark):
    own = make_posts(
        spark,
        [
            (1, 1, "plain"),
            (2, 1, "quote", {"quoted_status": 20}),
            (3, 1, "both", {"quoted_status": 30, "retweeted_status": 31}),
        ],
    )
    likes = spark.createDataFrame([(1, 5), (8, 5)], schema.LIKES)
    assert ids(idsets.positive_ids(own, likes)) == [1, 2, 8]
    assert ids(idsets.positive_ids(own, likes, "intended")) == [1, 8, 20, 30, 31]
    tagged = idsets.negative_ids(a=own.select("id"), b=likes.select(F.col("post_id").alias("id")))
    assert tagged.count() == 5
    assert ids(idsets.missing_ids(likes.select(F.col("post_id").alias("id")), own)) == [8]
    assert idsets.overflow(own.select("id"), 3).count() == 0
    assert idsets.overflow(own.select("id"), 2).count() == 3


def test_label_set_positive_wins(spark):
    posts = make_posts(spark, [(1, 1, "a"), (2, 1, "b"), (3, 1, "c"), (4, 1, "d", {"lang": "de"})])
    pos = spark.createDataFrame([(1,), (4,)], "id bigint")
    neg = spark.createDataFrame([(1,), (2,)], "id bigint")
    found = {r["id"]: r["labels"] for r in labelling.label_set(posts, pos, neg).collect()}
    assert found == {1: 1.0, 2: 0.0}


def test_feed_batch_rules(spark):
    posts = make_posts(
        spark,
        [
            (1, 1, "fine", {"favorite_count": 10}),
            (2, 1, "repost", {"retweeted_status": 9}),
            (3, 1, "german", {"lang": "de"}),
            (4, 1, "seen"),
            (5, 1, "MUTED word", {"favorite_count": 10}),
            (6, 1, "BREAKING", {"favorite_count": 10}),
            (7, 1, "http://cnn.com/x", {"favorite_count": 10}),
            (8, 1, "few likes", {"favorite_count": 2}),
            (9, 2, "scored", {"favorite_count": 10}),
        ],
    )
    log = spark.createDataFrame([(4, "no_errors")], schema.DELIVERY_LOG)
    scores = spark.createDataFrame([(9, 0.7)], schema.SCORES)
    rules = feed.FeedRules(mute_words=["muted"], mute_words_cs=["BREAKING"], news_domains=["cnn.com"], min_likes=2)
    batch = feed.feed_batch(posts, rules, log, scores)
    assert [tuple(r) for r in ranking.rank_by_score(batch).collect()] == [(9, 2, "scored", 0.7), (1, 1, "fine", 0.0)]
    assert ids(feed.from_audience(batch, feed.Audience(owner=2))) == [1]
    assert ids(feed.from_audience(batch, feed.Audience(friends=[2], friends_only=True))) == [9]
    assert ids(feed.from_audience(batch, feed.Audience(friends=[2], not_friends_only=True))) == [1]
    with pytest.raises(ValueError):
        filters.raise_if_empty(batch.limit(0))


def test_counts_and_weights(spark):
    df = spark.createDataFrame([("train", 0), ("train", 1), ("train", 1), ("test", 0)], "split string, label int")
    balance = {r["split"]: (r["n0"], r["n1"], r["ratio"]) for r in counts.class_balance(df, "split", "label").collect()}
    assert balance == {"train": (1, 2, 2 / 3), "test": (1, 0, 0.0)}
    weights = {r["label"]: r["weight"] for r in counts.class_weights(df, "label").collect()}
    assert weights == {0: 1.0, 1: 1.0}
    grid = counts.weight_grid(df, "label").collect()
    assert len(grid) == 48 and min(r["ratio"] for r in grid) > 0 and max(r["ratio"] for r in grid) == pytest.approx(16.0)
    assert {r["prediction"] for r in counts.majority_class(df, "label").collect()} == {0}


def test_tfidf_by_hand(spark):
    import math

    docs = spark.createDataFrame([(1, 1, ["a", "a", "b"]), (2, 1, ["a"]), (3, 0, ["b"])], "id int, label int, terms array<string>")
    found = {(r["label"], r["term"]): r["value"] for r in terms.class_tfidf(docs).collect()}
    idf_a, idf_b = math.log(3 / 3) + 1, math.log(3 / 2) + 1
    length = math.hypot(2 * idf_a, idf_b)
    assert found[(1, "a")] == pytest.approx(2 * idf_a / length + 1)
    assert found[(1, "b")] == pytest.approx(idf_b / length)
    assert found[(0, "b")] == pytest.approx(1.0)


def test_tfidf_is_the_same_when_frequent_terms_are_cut(spark, monkeypatch):
    rows = [(i // 2 if i < 6 else i, i % 2, ["w"] * (i % 4) + [f"t{i % 5}", None, "x" if i % 3 else "y"]) for i in range(40)] + [(None, 1, ["w"]), (77, None, ["w"]), (78, 1, [])]
    docs = spark.createDataFrame([*rows, (9, 1, ["w", "z"])], "id int, label int, terms array<string>")
    found = lambda **how: {(r["label"], r["term"]): round(r["value"], 9) for r in terms.class_tfidf(docs, **how).collect()}
    whole = found()
    assert len(whole) == 17 and found(together=0) == whole
    monkeypatch.setattr(terms, "BROADCAST_BYTES", 0)
    assert found() == whole


def test_term_counts_move_only_rows_whose_keys_repeat(spark, monkeypatch):
    schema_ = "id int, terms array<string>"
    single = spark.createDataFrame([(1, ["b", "a", "b", None]), (2, []), (3, None), (None, ["a"])], schema_)
    found = lambda df: sorted(((r["id"] or 0, r["term"], r["n"]) for r in terms.term_counts(df).collect()))
    assert found(single) == [(0, "a", 1), (1, "a", 1), (1, "b", 2)]
    shown = terms.term_counts(single)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in shown
    again = single.unionByName(spark.createDataFrame([(1, ["a", "c"]), (None, ["a", "a"]), (4, ["d"])], schema_))
    expected = [(0, "a", 3), (1, "a", 2), (1, "b", 2), (1, "c", 1), (4, "d", 1)]
    assert found(again) == expected
    monkeypatch.setattr(terms, "fits_broadcast", lambda df: False)
    assert found(again) == expected


def test_class_report_zero_division(spark):
    judged = spark.createDataFrame([(0, 0), (0, 0), (1, 0)], "label int, prediction int")
    report = {r["class"]: tuple(r)[1:] for r in metrics.class_report(metrics.confusion(judged)).collect()}
    assert report[1] == (0.0, 0.0, 0.0, 1)
    assert report[0] == (pytest.approx(2 / 3), 1.0, pytest.approx(0.8), 2)
    merged = metrics.run_metrics(metrics.class_report(metrics.confusion(judged.withColumn("run", F.lit(1)), ["run"]), ["run"]), ["run"]).first()
    assert merged["recall"] == pytest.approx(2 / 3) and merged["f1_class1"] == 0.0


def test_quality_suite(spark):
    scores = spark.createDataFrame([(1, 0.5), (1, 0.5), (2, 1.5), (3, None)], schema.SCORES)
    results = quality.run_checks(
        scores, quality.RowCount(1, 3), quality.Between("predicted", 0, 1), quality.Unique("id"), quality.HasColumn("nope")
    )
    assert {r["check"]: r["unexpected"] for r in results.collect()} == {
        "row_count_between": 1,
        "values_between": 1,
        "values_unique": 2,
        "column_exists": 1,
    }
    with pytest.raises(quality.CheckFailed):
        quality.enforce(results)
    quality.enforce(quality.run_checks(scores.where("id = 2"), quality.RowCount(1, 1)))
    assert quality.run_checks(scores.limit(0), quality.Unique("id")).first()["success"]


def test_payloads(spark):
    pages = spark.createDataFrame(
        [("l", '{"users": [{"id": 1, "screen_name": "a", "name": "A"}, {"id": 2, "screen_name": "b", "name": "B"}]}')],
        "list_name string, payload string",
    )
    assert [tuple(r) for r in payloads.list_members(pages).collect()] == [("l", 1, "a", "A"), ("l", 2, "b", "B")]
    big = 1354836528627904515
    bodies = spark.createDataFrame([(f'{{"objects": {{"tweets": {{"{big}": {{"x": 1}}}}}}}}',), ('{"objects": {}}',)], "payload string")
    assert ids(payloads.collection_ids(bodies)) == [big]
    directory = spark.createDataFrame([("c1", "feed")], "id string, name string")
    assert payloads.id_of_name(directory, "feed") == "c1"
    with pytest.raises(ValueError):
        payloads.id_of_name(directory, "other")
    members = spark.createDataFrame([("l", 1)], "list_name string, user_id bigint")
    with pytest.raises(ValueError):
        payloads.members_of(members, "other")
