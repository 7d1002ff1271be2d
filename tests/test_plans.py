"""What the plans look like: no Python in text work, bounded top-k, pushed filters."""

import pytest

from feedloom.catalog.queries import QUERIES

TEXT_QUERIES = ["clean_text", "treebank_tokens", "word_tokens", "news_flag", "url_domains", "strip_short_links", "mute_any", "mute_matches", "top_ngrams"]


def plan(df) -> str:
    return df._jdf.queryExecution().toString()


@pytest.mark.parametrize("name", TEXT_QUERIES)
def test_text_work_stays_in_the_jvm(name, spark, sf_dir):
    shown = plan(QUERIES[name](spark, sf_dir))
    assert "EvalPython" not in shown and "ArrowEval" not in shown


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {"lr_fit", "weight_grid_report", "cv_scores", "runs_reeval", "stream_score"}))
def test_no_cross_joins(name, spark, sf_dir):
    shown = plan(QUERIES[name](spark, sf_dir))
    assert "CartesianProduct" not in shown and "BroadcastNestedLoopJoin" not in shown


def test_top_n_is_a_bounded_sort(spark, sf_dir):
    assert "TakeOrderedAndProject" in plan(QUERIES["feed_top_n"](spark, sf_dir))


def test_top_terms_cut_each_task_before_the_shuffle(spark, sf_dir):
    for name in ("top_words", "top_ngrams", "top_tfidf"):
        assert "WindowGroupLimit" in plan(QUERIES[name](spark, sf_dir))


def test_filters_and_columns_reach_the_scan(spark, sf_dir):
    shown = plan(QUERIES["likes_gt"](spark, sf_dir))
    assert "GreaterThan(n_chars,1475)" in shown
    assert "text" not in shown.split("ReadSchema: ")[1].split("\n")[0]


def test_terms_are_computed_once_per_scan(spark, sf_dir):
    """The tokeniser must not be repeated in filters below the generator."""
    shown = plan(QUERIES["top_words"](spark, sf_dir)).split("== Physical Plan ==")[1]
    assert shown.count("lower(") <= 2


def test_texts_do_not_move_to_meet_bounded_labels(spark, sf_dir, monkeypatch):
    from feedloom.sources import standins as st

    monkeypatch.setattr(st, "fits_broadcast", lambda df, limit: spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1") or True)
    try:
        met = st.labelled_texts(spark, sf_dir)
        shown = plan(met)
        assert "BroadcastHashJoin" in shown and "SortMergeJoin" not in shown
        monkeypatch.setattr(st, "fits_broadcast", lambda df, limit: False)
        apart = st.labelled_texts(spark, sf_dir)
        assert "SortMergeJoin" in plan(apart)
        assert sorted(map(tuple, apart.select("id", "label").collect())) == sorted(map(tuple, met.select("id", "label").collect()))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_counts_move_once_by_the_words_that_terms_begin_with(spark):
    from feedloom.operators import terms

    docs = spark.createDataFrame([(1, 0, ["a", "a b", "a b c", "a b d", ""]), (2, 0, ["a b", "a b c", None]), (3, 1, ["x y z w"])], "id int, label int, terms array<string>")
    found = terms.class_tfidf(docs)
    shown = plan(found).split("== Physical Plan ==")[1]
    moved = [line for line in shown.split("\n") if "Exchange hashpartitioning" in line and ("term" in line or "_groupingexpression" in line or "_w0" in line)]
    assert moved and all("substring_index(term" in line and "REPARTITION_BY_COL" in line for line in moved), moved
    assert {(r["label"], r["term"]) for r in found.collect()} == {(0, "a"), (0, "a b"), (0, "a b c"), (0, "a b d"), (0, ""), (1, "x y z w")}


def test_partial_lengths_do_not_grow_with_the_partitions(spark):
    from feedloom.operators import terms

    spark.conf.set("spark.sql.shuffle.partitions", "40")
    try:
        docs = spark.createDataFrame([(i, 0, [f"w{k}" for k in range(60)]) for i in range(5)], "id int, label int, terms array<string>")
        found = terms.class_tfidf(docs)
        assert found.count() == 60
        tasks = terms.LENGTH_TASKS * spark.sparkContext.defaultParallelism
        assert f"Coalesce {tasks}" in plan(found).split("== Physical Plan ==")[1] and tasks < 40
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
