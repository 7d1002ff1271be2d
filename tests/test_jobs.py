"""Sinks, training, scoring and streaming, end to end on small tables."""

import json
import math
import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from feedloom import schema
from feedloom.catalog import queries
from feedloom.operators import lookups, quality
from feedloom.plans import feed, labelling, scoring, training
from feedloom.sources import sinks, tables
from feedloom.streaming import jobs
from test_operators import ids, make_posts


def test_missing_inputs_are_empty(spark, tmp_path):
    assert tables.read_delivery_log(spark, f"{tmp_path}/none").count() == 0
    assert tables.read_scores(spark, f"{tmp_path}/none").columns == ["id", "predicted"]


def test_text_sources(spark, tmp_path):
    (tmp_path / "words.txt").write_text('["breaking:", "🍿", "New Yorker"]')
    assert ids(tables.read_string_list(spark, str(tmp_path / "words.txt")), "word") == ["New Yorker", "breaking:", "🍿"]
    (tmp_path / "seen.csv").write_text("tweet_id,err_reason\n615449556961095680,no_errors\n")
    assert ids(tables.read_delivery_log(spark, str(tmp_path / "seen.csv"), "csv"), "post_id") == [615449556961095680]
    (tmp_path / "scores.csv").write_text("id,predicted\n615449556961095680, 0.12\n")
    assert tables.read_scores(spark, str(tmp_path / "scores.csv"), "csv").first()["predicted"] == 0.12


@pytest.mark.parametrize("layout", ["lines", "array"])
def test_label_set_round_trip(spark, tmp_path, layout):
    posts = make_posts(spark, [(1354836528627904515 + i, 1, t) for i, t in enumerate(["a", None, 'q"\n', "d", "e", "f"])])
    labelled = posts.withColumn("labels", F.lit(1.0)).repartition(3)
    sinks.write_json(labelled, f"{tmp_path}/set", layout)
    back = tables.read_label_set(spark, f"{tmp_path}/set", layout)
    order = lambda df: sorted(map(tuple, df.select(*schema.LABEL_SET.names).collect()))
    assert [r[0] for r in order(back)] == [1354836528627904515 + i for i in range(6)] and order(back) == order(labelled)
    (tmp_path / "array.json").write_text('[{"id": 1, "full_text": "a", "labels": 0.0},\n {"id": 2, "labels": 1.0}]')
    assert ids(tables.read_label_set(spark, str(tmp_path / "array.json"), "array")) == [1, 2]


def test_large_array_exports_are_several_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(sinks, "ARRAY_BYTES", 4_000, raising=False)
    posts = make_posts(spark, [(i, 1, "the same text " * 5) for i in range(300)]).withColumn("labels", F.lit(1.0)).repartition(3)
    sinks.write_json(posts, f"{tmp_path}/set", "array")
    files = [f.read_text() for f in (tmp_path / "set").glob("part-*")]
    assert len(files) > 5 and max(map(len, files)) < 12_000
    assert sorted(r["id"] for f in files for r in json.loads(f)) == list(range(300))
    assert ids(tables.read_label_set(spark, f"{tmp_path}/set", "array")) == list(range(300))
    sinks.write_json(posts.limit(0), f"{tmp_path}/none", "array")
    assert [f.read_text().strip() for f in (tmp_path / "none").glob("part-*")] == ["[]"]


def test_posts_reader_prunes_and_pushes(spark, tmp_path):
    make_posts(spark, [(1, 1, "a"), (2, 1, "b", {"lang": "de"})]).write.parquet(f"{tmp_path}/posts")
    posts = tables.read_posts(spark, f"{tmp_path}/posts").where("lang = 'en'").select("id")
    plan = posts._jdf.queryExecution().toString()
    assert "EqualTo(lang,en)" in plan and "full_text" not in plan.split("ReadSchema")[1]
    assert ids(posts) == [1]


def test_versions_keep_the_backup(spark, tmp_path):
    root = f"{tmp_path}/scores"
    assert sinks.read_version(spark, root, schema.SCORES).count() == 0
    for value in (0.1, 0.2):
        sinks.publish_version(spark.createDataFrame([(1, value)], schema.SCORES), root)
    assert sinks.read_version(spark, root, schema.SCORES).first()["predicted"] == 0.2
    assert sinks.read_version(spark, root, schema.SCORES, 1).first()["predicted"] == 0.1


def test_rejected_dump_waits_for_its_limit(spark, tmp_path):
    rejected = spark.range(3)
    at = datetime(2024, 1, 2, 3, 4)
    assert sinks.dump_rejected(rejected, str(tmp_path), at, limit=3) is None
    path = sinks.dump_rejected(rejected, str(tmp_path), at, limit=2)
    assert path.endswith("2024_01_02_0304_not_relevant_list") and spark.read.json(path).count() == 3


def test_a_failed_check_leaves_the_version_before_current(spark, tmp_path):
    posts, root = make_posts(spark, [(1, 1, "a")]).withColumn("labels", F.lit(1.0)), f"{tmp_path}/set"
    assert labelling.publish_label_set(posts, root, (quality.RowCount(1, 2),)).first()["rows"] == 1
    with pytest.raises(quality.CheckFailed):
        labelling.publish_label_set(posts.union(posts), root)
    assert sinks.current_version(spark, root) == 1 and sinks.read_version(spark, root, schema.LABEL_SET).count() == 1
    scores = f"{tmp_path}/scores"
    english = make_posts(spark, [(1, 1, "a"), (2, 1, "b")])
    good = lambda p: p.select("id", F.lit(0.5).alias("predicted"))
    bad = lambda p: p.select("id", F.lit(7.0).alias("predicted"))
    assert scoring.update_score_table(spark, scores, english, good, None) == 1
    with pytest.raises(quality.CheckFailed):
        scoring.update_score_table(spark, scores, english, bad, None, mode="overwrite")
    assert sinks.current_version(spark, scores) == 1
    assert not [f for f in os.listdir(scores) if f.startswith("CURRENT.")]


def test_a_suite_reports_columns_that_are_not_there(spark):
    table = spark.createDataFrame([(1,), (1,)], "id bigint")
    found = {(r["check"], r["column"]): (r["success"], r["unexpected"]) for r in quality.run_checks(table, *quality.SCORES_SUITE).collect()}
    assert found == {
        ("values_between", "predicted"): (False, 2), ("values_unique", "id"): (False, 2), ("column_exists", "id"): (True, 0), ("column_exists", "predicted"): (False, 1),
    }
    empty = quality.run_checks(table.limit(0).select(F.col("id").alias("x")), *quality.SCORES_SUITE)
    assert empty.where("success").count() == 0


def test_fingerprint_ignores_order_and_sees_change(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (2, None)], "id int, t string")
    first = sinks.fingerprint(df).first()
    assert first == sinks.fingerprint(df.orderBy(F.desc("id"))).first()
    assert first != sinks.fingerprint(df.withColumn("t", F.lit("a"))).first()
    assert sinks.fingerprint(df.where("t = 'a'")).first() != sinks.fingerprint(df).first()
    assert sinks.fingerprint(df.limit(0)).first()["rows"] == 0


def test_deliver_appends_and_replays_on_the_live_log(spark, tmp_path):
    posts, log = make_posts(spark, [(i, i, "t") for i in range(8)]), f"{tmp_path}/log"
    rejected = spark.range(3)
    run = lambda batch, **more: feed.deliver(
        posts, feed.FeedRules(), feed.Audience(owner=0), log, batch, as_of="2024-03-01", size=2, **more
    ).collect()
    held = lambda: {(r["batch_id"], r["post_id"]) for r in sinks.read_batches(spark, log, schema.DELIVERY_LOG).collect()}
    assert [tuple(r) for r in run(0)] == [("no_errors", 2)]
    run(1)
    first = held()
    run(1, rejected=rejected, dump_folder=f"{tmp_path}/dumps", dump_limit=2)
    assert held() == first and {p for _, p in first} == {1, 2, 3, 4}
    assert len(os.listdir(f"{tmp_path}/dumps")) == 1
    run(2)
    run(3, delivery_log=spark.createDataFrame([(7, "no_errors")], schema.DELIVERY_LOG).limit(0))
    with pytest.raises(ValueError):
        run(4)
    assert {p for _, p in held()} == set(range(1, 8)) and max(b for b, _ in held()) == 3


def test_scoring_a_stream_takes_what_a_batch_takes(spark, tmp_path):
    rows = [(1, 1, "a"), (2, 1, "b", {"lang": "de"}), (3, 1, "c", {"retweeted_status": 9}), (4, 1, "d"), (5, 1, "e"), (5, 1, "e")]
    posts = make_posts(spark, rows)
    log = spark.createDataFrame([(4, "no_errors")], schema.DELIVERY_LOG)
    scorer = lambda p: p.select("id", (F.col("id") / 10).alias("predicted"))
    for k, name in ((1, "one"), (3, "three")):
        landed, out = f"{tmp_path}/{name}", f"{tmp_path}/{name}-scores"
        posts.repartition(k).write.parquet(landed)
        jobs.score(jobs.file_stream(spark, landed, posts.schema, 1), scorer, out, f"{tmp_path}/{name}-state", log)
        batch = scoring.score_posts(posts, scorer, spark.createDataFrame([], schema.SCORES), log, "overwrite")
        assert sorted(map(tuple, jobs.stored_scores(spark, out).collect())) == sorted(map(tuple, batch.collect())) == [(1, 0.1), (5, 0.5)]


def test_ingest_keeps_rows_without_a_key(spark, tmp_path):
    columns = "id bigint, t string"
    for k, rows in enumerate([[(1, "a"), (1, "a"), (None, "x"), (None, "y")], [(1, "b"), (None, "z"), (2, "c")]]):
        spark.createDataFrame(rows, columns).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    stream = jobs.file_stream(spark, f"{tmp_path}/in", spark.createDataFrame([], columns).schema, 1)
    jobs.ingest(stream, "id", f"{tmp_path}/out", f"{tmp_path}/state")
    found = [(r["id"], r["t"]) for r in sinks.read_batches(spark, f"{tmp_path}/out", stream.schema).collect()]
    assert sorted(t for i, t in found if i is None) == ["x", "y", "z"] and sorted(i for i, _ in found if i) == [1, 2]


def test_ingest_by_day_reads_only_the_days_it_needs(spark, tmp_path):
    columns = "id bigint, ts timestamp_ntz"
    day = lambda d: datetime(2024, 1, d, 12)
    for rows in ([(1, day(1)), (2, day(9)), (3, None)], [(1, day(1)), (4, day(9)), (3, None), (5, day(5))]):
        spark.createDataFrame(rows, columns).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    stream = jobs.file_stream(spark, f"{tmp_path}/in", spark.createDataFrame([], columns).schema, 1)
    jobs.ingest(stream, "id", f"{tmp_path}/out", f"{tmp_path}/state", event_time="ts")
    stored = sinks.read_batches(spark, f"{tmp_path}/out", stream.schema, by_day=True)
    assert sorted(r["id"] for r in stored.collect()) == [1, 2, 3, 4, 5]
    shown = stored.where(F.col(sinks.DAY).isin(day(1).date()))._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(" in shown or "PartitionFilters: [(stored_day" in shown or "stored_day" in shown.split("PartitionFilters")[-1].split("]")[0]


def test_of_equal_claims_the_greatest_score_stays(spark):
    score = lambda *rows: spark.createDataFrame(rows, schema.SCORES)
    for fresh in ([(1, 0.1), (1, 0.9)], [(1, 0.9), (1, 0.1)]):
        merged = lookups.upsert_scores(score((1, 1.0), (2, 0.3)), score(*fresh))
        assert sorted(map(tuple, merged.collect())) == [(1, 0.9), (2, 0.3)]


@pytest.fixture(scope="module")
def labelled(spark):
    good = ["lovely sunny garden", "sunny walk garden", "lovely walk today", "garden lovely sunny walk"]
    bad = ["angry politics news", "politics breaking news", "angry breaking story", "news politics angry story"]
    rows = [(i, float(i % 2), (good if i % 2 else bad)[(i // 2) % 4]) for i in range(40)]
    return spark.createDataFrame(rows, "id bigint, label double, text string")


def test_regression_reaches_the_weighted_optimum(spark, labelled):
    """The gradient of  |w|^2/2 + C * sum(weight * log loss)  vanishes at the fit."""
    prepared = training.fit_features(labelled, longest=1, stop_words=[], size=1 << 10)
    train = prepared.transform(labelled).select("label", "features")
    counted = training.ClassCounts.of(train)
    model = training.fit_weighted(train, counted, 0.5, 2.0, max_iter=500)
    w, b = model.coefficients.toArray(), model.intercept
    gradient, bias = w.copy(), 0.0
    for r in train.collect():
        x = r["features"].toArray()
        p = 1 / (1 + math.exp(-(w @ x + b)))
        pull = (2.0 if r["label"] == 1 else 0.5) * (p - r["label"])
        gradient += pull * x
        bias += pull
    assert abs(gradient).max() < 1e-2 and abs(bias) < 1e-2


def test_grid_runs_save_score_and_reevaluate(spark, labelled, tmp_path):
    runs = training.train_runs(labelled, labelled, "exp", 0, str(tmp_path), steps=5, longest=2, stop_words=[], size=1 << 10, max_iter=20)
    assert runs.count() == 4  # the balanced ratio is 1: the first of -4, 1, 6, 11, 16 has no weight
    again = training.reevaluate(spark, runs, labelled, tables.exists).collect()
    assert len(again) == 4 and all(r["f1_class1"] == pytest.approx(r["orig_f1_class1"]) for r in again)
    gone = runs.withColumn("model_path", F.lit(f"{tmp_path}/nowhere"))
    assert training.reevaluate(spark, gone, labelled, tables.exists).count() == 0

    posts = make_posts(spark, [(1, 1, "sunny garden walk"), (2, 1, "angry politics news"), (3, 1, "x", {"lang": "de"})])
    scorer = scoring.best_scorer(runs)
    root = f"{tmp_path}/scores"
    assert scoring.update_score_table(spark, root, posts, scorer, None) == 1
    stored = {r["id"]: r["predicted"] for r in sinks.read_version(spark, root, schema.SCORES).collect()}
    assert set(stored) == {1, 2} and stored[1] > 0.5 > stored[2]
    assert scoring.update_score_table(spark, root, posts, scorer, None) is None
    assert scoring.update_score_table(spark, root, posts, scorer, None, mode="overwrite") == 2
    with pytest.raises(ValueError):
        scoring.score_posts(posts, scorer, sinks.read_version(spark, root, schema.SCORES), None, mode="x")


def test_tfidf_features_are_unit_length(labelled):
    from pyspark.ml.functions import vector_to_array

    out = training.fit_features(labelled, "tfidf", stop_words=[], size=1 << 10).transform(labelled)
    length = F.aggregate(vector_to_array("features"), F.lit(0.0), lambda a, v: a + v * v)
    assert all(r[0] == pytest.approx(1.0) for r in out.select(length).collect())


def test_ratio_grid_refuses_when_nothing_is_positive():
    with pytest.raises(ValueError):
        training.ratio_grid(training.ClassCounts(1, 10), below=20, above=-1)


def test_cv_scores(spark, labelled):
    ready = training.fit_features(labelled, longest=1, stop_words=[], size=64).transform(labelled)
    found = training.cv_scores(ready.select("id", "label", "features"), [0.5], folds=2, max_iter=10).first()
    assert found["mean_f1"] == pytest.approx(1.0)


def land(spark, path, parts):
    for part in parts:
        part.coalesce(1).write.mode("append").parquet(path)


@pytest.mark.parametrize("files", [1, 3])
def test_ingest_is_the_same_in_one_or_many_batches(spark, tmp_path, files):
    schema_ = "id bigint, v string"
    parts = [spark.createDataFrame([(i, "x") for i in ids_], schema_) for ids_ in ([1, 2], [2, 3], [3, 4, 4])]
    land(spark, f"{tmp_path}/in", parts)
    stream = jobs.file_stream(spark, f"{tmp_path}/in", parts[0].schema, files_per_trigger=None if files == 1 else 1)
    out, state = f"{tmp_path}/out", f"{tmp_path}/state"
    jobs.ingest(stream, "id", out, state)
    assert ids(sinks.read_batches(spark, out, parts[0].schema)) == [1, 2, 3, 4]
    jobs.ingest(stream, "id", out, state)
    assert ids(sinks.read_batches(spark, out, parts[0].schema)) == [1, 2, 3, 4]
    land(spark, f"{tmp_path}/in", [spark.createDataFrame([(1, "late"), (5, "x")], schema_)])
    jobs.ingest(stream, "id", out, state)
    assert ids(sinks.read_batches(spark, out, parts[0].schema)) == [1, 2, 3, 4, 5]


def test_ingest_looks_back_over_the_span_of_the_batch(spark, tmp_path):
    schema_ = "id bigint, t timestamp_ntz"
    day = lambda d: datetime(2024, 1, d)
    first = spark.createDataFrame([(1, day(1)), (2, day(5)), (3, None)], schema_)
    land(spark, f"{tmp_path}/in", [first, spark.createDataFrame([(2, day(5)), (3, None), (4, day(2))], schema_)])
    stream = jobs.file_stream(spark, f"{tmp_path}/in", first.schema, files_per_trigger=1)
    jobs.ingest(stream, "id", f"{tmp_path}/out", f"{tmp_path}/state", event_time="t")
    assert ids(sinks.read_batches(spark, f"{tmp_path}/out", first.schema)) == [1, 2, 3, 4]


def test_replaying_a_batch_changes_nothing(spark, tmp_path):
    posts = make_posts(spark, [(1, 1, "a"), (2, 1, "b")])
    land(spark, f"{tmp_path}/in", [posts])
    stream = jobs.file_stream(spark, f"{tmp_path}/in", schema.POSTS)
    scorer = lambda df: df.select("id", F.lit(0.5).alias("predicted"))
    for state in ("state1", "state2"):  # a lost checkpoint replays batch 0
        jobs.score(stream, scorer, f"{tmp_path}/scores", f"{tmp_path}/{state}")
    assert ids(jobs.stored_scores(spark, f"{tmp_path}/scores")) == [1, 2]


def test_feed_stream_skips_both_logs(spark, tmp_path):
    posts = make_posts(spark, [(1, 1, "a"), (2, 1, "b"), (3, 1, "c", {"lang": "de"}), (4, 1, "d", {"retweeted_status": 1})])
    land(spark, f"{tmp_path}/in", [posts, posts])
    log = spark.createDataFrame([(1, "no_errors")], schema.DELIVERY_LOG)
    stream = jobs.file_stream(spark, f"{tmp_path}/in", schema.POSTS, files_per_trigger=1)
    jobs.feed(stream, log, f"{tmp_path}/out", f"{tmp_path}/state")
    assert ids(sinks.read_batches(spark, f"{tmp_path}/out", schema.DELIVERY_LOG), "post_id") == [2]


def test_a_full_vocabulary_is_refused(spark, labelled):
    with pytest.raises(ValueError):
        training.fit_features(labelled, longest=2, stop_words=[], size=5)
    with pytest.raises(ValueError):
        training.fit_pipeline(labelled.where("label = 1"), stop_words=[])


def test_a_saved_run_is_features_and_model(spark, labelled, tmp_path):
    runs = training.train_runs(labelled, labelled, "one", 0, str(tmp_path), steps=2, longest=1, stop_words=[], vectoriser="hashed", size=256, max_iter=5)
    model = training.load_run(runs.first()["model_path"])
    assert model.transform(labelled).select("probability").count() == 40


def test_a_table_of_many_splits_lands_in_as_many_files_and_two_batches(spark, tmp_path):
    rows = spark.createDataFrame([(i, f"t{i}") for i in range(400)], "doc_id bigint, text string")
    rows.repartition(40).write.parquet(f"{tmp_path}/documents.parquet")
    before = spark.conf.get("spark.sql.files.openCostInBytes"), spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4000")
    try:
        folder, columns, land, taken = queries._landing(spark, str(tmp_path), "documents")
        land(0)
        files = [f for f in os.listdir(folder) if f.endswith(".parquet")]
        assert len(files) > 6 and taken < len(files) <= 2 * taken
        land(1)
        assert spark.read.parquet(folder).distinct().count() == 400 < spark.read.parquet(folder).count()
    finally:
        spark.conf.set("spark.sql.files.openCostInBytes", before[0])
        spark.conf.set("spark.sql.files.maxPartitionBytes", before[1])


def test_documents_land_in_files_of_bounded_rows_on_any_cluster(spark, tmp_path):
    rows = spark.createDataFrame([(i, f"t{i}") for i in range(100)], "doc_id bigint, text string")
    rows.coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    folder, columns, land, taken = queries._landing(spark, str(tmp_path), "documents", 10)
    land(0)
    assert len([f for f in os.listdir(folder) if f.endswith(".parquet")]) == 10 and taken == 7
    land(1)
    assert spark.read.parquet(folder).distinct().count() == 100


def test_a_feed_moves_ids_alone(spark, tmp_path, monkeypatch):
    posts = make_posts(spark, [(1, 1, "a"), (2, 1, "b"), (None, 1, "c"), (None, 1, "d")])
    land(spark, f"{tmp_path}/in", [posts, posts])
    seen, plain = [], jobs.drop_seen
    monkeypatch.setattr(jobs, "drop_seen", lambda batch, log: seen.append(batch.columns) or plain(batch, log))
    log = spark.createDataFrame([(1, "no_errors")], schema.DELIVERY_LOG)
    jobs.feed(jobs.file_stream(spark, f"{tmp_path}/in", schema.POSTS), log, f"{tmp_path}/out", f"{tmp_path}/state")
    stored = sinks.read_batches(spark, f"{tmp_path}/out", schema.DELIVERY_LOG)
    assert sorted(r["post_id"] or 0 for r in stored.collect()) == [0, 0, 0, 0, 2] and set(map(tuple, seen)) == {("id",)}
