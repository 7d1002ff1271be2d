"""Tables in buckets, observed checks, key sketches, merged batches, streams over several files."""

import os
import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from feedloom import schema
from feedloom.operators import lookups, quality, sketches
from feedloom.plans import scoring
from feedloom.sources import buckets, sinks
from feedloom.streaming import jobs
from test_operators import ids, make_posts


def scored(spark, rows):
    return spark.createDataFrame(rows, schema.SCORES)


def upsert(spark, root, rows, **more):
    return buckets.upsert_buckets(scored(spark, rows), root, "id", lookups.upsert_scores, schema.SCORES, quality.SCORES_SUITE, **more)


def files(root):
    return {os.path.relpath(os.path.join(d, f), root) for d, _, names in os.walk(root) for f in names if f.startswith("part-") and "version=" in d}


def test_an_upsert_rewrites_only_the_buckets_it_touches(spark, tmp_path):
    root = f"{tmp_path}/scores"
    assert buckets.read_buckets(spark, root, schema.SCORES).count() == 0
    assert upsert(spark, root, [(i, 0.25) for i in range(200)], buckets=16) == 1
    before, held = files(root), buckets.manifest(spark, root)
    assert len(held) == 16 and set(held.values()) == {1}
    assert upsert(spark, root, [(7, 0.5), (7, 0.75), (1_000, 1.0)]) == 2
    now = buckets.manifest(spark, root)
    touched = {r["b"] for r in scored(spark, [(7, 0.0), (1_000, 0.0)]).select(buckets.bucket_of("id", 16).alias("b")).collect()}
    assert {b for b, v in now.items() if v == 2} == touched and before <= files(root)
    assert {f.split("/")[1] for f in files(root) - before} == {f"key_bucket={b}" for b in touched}
    expected = {i: 0.25 for i in range(200)} | {7: 0.75, 1_000: 1.0}
    assert dict(map(tuple, buckets.read_buckets(spark, root, schema.SCORES).collect())) == expected
    assert buckets.read_buckets(spark, root, schema.SCORES, version=1).count() == 200
    assert ids(buckets.read_buckets(spark, root, schema.SCORES, only=touched)) == sorted(i for i in expected if i in {r["id"] for r in scored(spark, [(i, 0.0) for i in expected]).where(buckets.bucket_of("id", 16).isin(*touched)).collect()})


def test_a_failing_upsert_leaves_the_table(spark, tmp_path):
    root = f"{tmp_path}/scores"
    upsert(spark, root, [(1, 0.5), (2, 0.5)], buckets=4)
    with pytest.raises(quality.CheckFailed, match="values_between.predicted.: 1 unexpected"):
        upsert(spark, root, [(2, 7.0), (3, 0.5)])
    twice = lambda stored, fresh: stored.union(fresh)
    with pytest.raises(quality.CheckFailed, match="values_unique.id.: 2 unexpected"):
        buckets.upsert_buckets(scored(spark, [(2, 0.25)]), root, "id", twice, schema.SCORES, quality.SCORES_SUITE)
    assert sinks.current_version(spark, root) == 1 and dict(map(tuple, buckets.read_buckets(spark, root, schema.SCORES).collect())) == {1: 0.5, 2: 0.5}
    assert upsert(spark, root, []) is None
    assert upsert(spark, root, [(None, 0.5), (3, 0.25)]) == 2
    assert sorted(map(str, (r["id"] for r in buckets.read_buckets(spark, root, schema.SCORES).collect()))) == ["1", "2", "3", "None"]


def test_scores_in_buckets_follow_the_score_table(spark, tmp_path):
    posts = make_posts(spark, [(i, 1, "t") for i in range(40)] + [(50, 1, "x", {"lang": "de"})])
    scorer = lambda p: p.select("id", (F.col("id") / 100).alias("predicted"))
    other = lambda p: p.select("id", F.lit(0.5).alias("predicted"))
    for root, update in ((f"{tmp_path}/a", scoring.update_score_table), (f"{tmp_path}/b", scoring.update_score_buckets)):
        assert update(spark, root, posts.where("id < 20"), scorer, None) == 1
        assert update(spark, root, posts.where("id < 20"), scorer, None) is None
        assert update(spark, root, posts, other, None) == 2
    whole = sinks.read_version(spark, f"{tmp_path}/a", schema.SCORES)
    found = buckets.read_buckets(spark, f"{tmp_path}/b", schema.SCORES)
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, whole.collect())) and found.count() == 40
    with pytest.raises(ValueError):
        scoring.update_score_buckets(spark, f"{tmp_path}/b", posts, scorer, None, mode="replace")


def test_a_publish_reads_its_table_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    rows = scored(spark, [(i, i / 100) for i in range(100)]).mapInArrow(count, schema.SCORES)
    assert sinks.publish_version(rows, f"{tmp_path}/scores", checks=(quality.RowCount(1, 100), *quality.SCORES_SUITE)) == 1
    assert seen.value == 100
    for bad, checks in ((rows, (quality.RowCount(1, 99),)), (rows.union(rows.limit(1)), quality.SCORES_SUITE), (rows.select("id"), quality.SCORES_SUITE)):
        with pytest.raises(quality.CheckFailed):
            sinks.publish_version(bad, f"{tmp_path}/scores", checks=checks)
    assert sinks.current_version(spark, f"{tmp_path}/scores") == 1


def test_sketches_never_miss_a_key(spark):
    rng = random.Random(3)
    held = [(rng.choice(["a", "b", None]), rng.randrange(10**12)) for _ in range(20_000)]
    table = "group string, key bigint"
    sketch = sketches.key_sketch(spark.createDataFrame([*held, ("a", None)], table)).persist()
    assert {r["group"]: r["blocks"] for r in sketch.select("group", "blocks").distinct().collect()}.keys() == {"a", "b", ""}
    maybe = lambda rows: {(r["group"], r["key"]) for r in sketches.maybe_held(spark.createDataFrame(rows, table), sketch).collect()}
    assert maybe(held[:5_000]) == {(g or "", k) for g, k in held[:5_000]}
    fresh = [(rng.choice("ab"), -rng.randrange(10**12)) for _ in range(5_000)]
    assert len(maybe(fresh)) < 150 and maybe([("a", None), ("zz", held[0][1])]) == set()


EVENTS = "id bigint, ts timestamp_ntz, v string"


def event(i, day, v="x"):
    return (i, None if day is None else datetime(2024, 1, day, 5), v)


def land(spark, path, *parts):
    for rows in parts:
        spark.createDataFrame(rows, EVENTS).coalesce(1).write.mode("append").parquet(path)


@pytest.mark.parametrize("event_time", [None, "ts"])
def test_new_keys_are_told_by_sketches_alone(spark, tmp_path, monkeypatch, event_time):
    landed, out, state = (f"{tmp_path}/{n}" for n in ("in", "out", "state"))
    looks = []
    monkeypatch.setattr(jobs, "read_batches", lambda *a, **b: looks.append(a) or sinks.read_batches(*a, **b))

    def run():
        stream = jobs.file_stream(spark, landed, spark.createDataFrame([], EVENTS).schema, files_per_trigger=1)
        jobs.ingest(stream, "id", out, state, event_time)
        return ids(sinks.read_batches(spark, out, stream.schema, by_day=event_time is not None))

    land(spark, landed, [event(i, 1 + i % 3) for i in range(300)], [event(i, 1 + i % 3) for i in range(300, 500)])
    assert run() == list(range(500)) and len(looks) <= 1
    looks.clear()
    land(spark, landed, [event(7, 2, "again"), event(900, 2), event(None, None), event(901, None)])
    assert run() == [*range(500), 900, 901, None] and len(looks) == 1


def test_merged_batches_read_and_replay_the_same(spark, tmp_path):
    landed, out, state = (f"{tmp_path}/{n}" for n in ("in", "out", "state"))
    columns = spark.createDataFrame([], EVENTS).schema

    def run(checkpoint=state):
        jobs.ingest(jobs.file_stream(spark, landed, columns, files_per_trigger=1), "id", out, checkpoint, "ts")

    def rows():
        found = sinks.read_batches(spark, out, columns, by_day=True).collect()
        return sorted(((r["id"], r["batch_id"]) for r in found), key=str)

    assert sinks.drop_merged(spark, out) == 0 if os.path.exists(out) else True
    assert not jobs.compact(spark, out, columns, 5, "id", "ts")
    land(spark, landed, [event(1, 1), event(2, None), event(None, 3)], [event(1, 1), event(3, 2)], [event(4, 2)])
    run()
    before = rows()
    assert jobs.compact(spark, out, columns, 1, "id", "ts") and not jobs.compact(spark, out, columns, 1, "id", "ts")
    assert rows() == before and sinks.compacted(spark, out) == 1
    run(f"{tmp_path}/other-state")  # a lost checkpoint replays every batch
    assert rows() == before
    assert sinks.drop_merged(spark, out) == 2 and rows() == before
    land(spark, landed, [event(1, 1), event(2, None), event(4, 2), event(9, 1)])
    run()
    assert [i for i, _ in rows()].count(9) == 1 and len(rows()) == len(before) + 1
    assert jobs.compact(spark, out, columns, 3, "id", "ts") and sinks.drop_merged(spark, out) == 3
    assert len(rows()) == len(before) + 1 and len(sinks.read_batches(spark, out, columns).collect()) == len(before) + 1


def test_tables_stored_before_sketches_are_still_looked_at(spark, tmp_path):
    landed, out = f"{tmp_path}/in", f"{tmp_path}/out"
    columns = spark.createDataFrame([], EVENTS).schema
    sinks.append_batch(spark.createDataFrame([event(1, 1), event(2, 2)], EVENTS), out, -1, "ts")
    land(spark, landed, [event(1, 1), event(3, 1)])
    jobs.ingest(jobs.file_stream(spark, landed, columns), "id", out, f"{tmp_path}/state", "ts")
    assert ids(sinks.read_batches(spark, out, columns, by_day=True)) == [1, 2, 3]


@pytest.mark.parametrize("per_trigger", [None, 1])
def test_scores_and_feed_of_several_files_with_a_stop(spark, tmp_path, per_trigger):
    parts = [[(1, 1, "a"), (2, 1, "b"), (2, 1, "b")], [(2, 1, "b"), (3, 1, "c", {"lang": "de"}), (None, 1, "n")], [(3, 1, "c"), (1, 1, "a"), (4, 1, "d"), (None, 1, "m")]]
    scorer = lambda p: p.select("id", F.lit(0.5).alias("predicted"))
    log = spark.createDataFrame([(4, "no_errors")], schema.DELIVERY_LOG)
    landed = f"{tmp_path}/in"
    for stop in (parts[:2], parts[2:]):
        for rows in stop:
            make_posts(spark, rows).coalesce(1).write.mode("append").parquet(landed)
        stream = jobs.file_stream(spark, landed, schema.POSTS, per_trigger)
        jobs.score(stream, scorer, f"{tmp_path}/scores", f"{tmp_path}/score-state", log)
        jobs.feed(stream, log, f"{tmp_path}/feed", f"{tmp_path}/feed-state")
    assert ids(sinks.read_batches(spark, f"{tmp_path}/scores", schema.SCORES)) == [1, 2, 3, None, None]
    assert ids(sinks.read_batches(spark, f"{tmp_path}/feed", schema.DELIVERY_LOG), "post_id") == [1, 2, 3, None, None]
    assert [f for _, _, names in os.walk(f"{tmp_path}/score-state/state") for f in names if f.endswith((".changelog", ".zip"))]


def test_trees_merge_and_tell_which_buckets_differ(spark):
    rows = [(i, f"t{i}") for i in range(300)] + [(None, "n"), (5, None)]
    df = spark.createDataFrame(rows, "id bigint, t string")
    first, rest = df.where("id < 100 or id is null"), df.where("id >= 100")
    whole, parts = sinks.digest_tree(df, "id", buckets=16), sinks.merged_tree(sinks.digest_tree(first, "id", buckets=16), sinks.digest_tree(rest, "id", buckets=16))
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, parts.collect())) and whole.count() == 16
    assert sinks.tree_root(parts).first() == sinks.fingerprint(df).first()
    assert sinks.changed_buckets(whole, parts).count() == 0
    changed = df.where("id <> 7 or id is null").withColumn("t", F.when(F.col("id") == 9, F.lit("new")).otherwise(F.col("t")))
    found = sinks.changed_buckets(whole, sinks.digest_tree(changed, "id", buckets=16)).collect()
    assert 1 <= len(found) <= 2 and sum(r["rows_before"] - r["rows_after"] for r in found) == 1
    assert sinks.changed_buckets(whole.limit(0), whole).count() == 16 and sinks.tree_root(whole.limit(0)).first()["rows"] == 0
