"""Upserts by row version from a stream of files, and the sinks."""

import time

import pytest
from pyspark.sql import functions as F

from inuring.sources import sinks
from inuring.streaming import cdc


def test_stream_equals_batch(spark, tmp_path):
    rows = [(k % 7, v, k * 10 + v) for k in range(30) for v in range(3)]
    df = spark.createDataFrame(rows, "layer_id int, row_version long, value int")
    for k in range(3):
        df.where(f"value % 3 = {k}").write.parquet(str(tmp_path / "in" / f"batch={k}"))
    state = cdc.VersionedTable(spark, str(tmp_path / "state"), ["layer_id"])
    source = spark.read.parquet(str(tmp_path / "in")).drop("batch").schema
    cdc.stream_upserts(spark, str(tmp_path / "in" / "*"), source, state.apply, str(tmp_path / "check")).awaitTermination(120)
    expected = cdc.upsert(None, df, ["layer_id"])
    assert sorted(map(tuple, state.read().select(*df.columns).collect())) == sorted(map(tuple, expected.collect()))


def batches_of(spark, many):
    rows = [[(k, 1, n * 100 + k) for k in range(n, n + 6)] for n in range(many)]
    return [spark.createDataFrame([(k, v + n, x) for k, v, x in own], "layer_id int, row_version long, value int") for n, own in enumerate(rows)]


def rows_of(df):
    return sorted(map(tuple, df.collect()))


def test_replay_and_restart_keep_all_rows(spark, tmp_path):
    """A batch applied twice, a new object for each batch, and only touched buckets written."""
    frames, path = batches_of(spark, 4), str(tmp_path / "state")
    for number, df in enumerate(frames):
        cdc.VersionedTable(spark, path, ["layer_id"]).apply(df, number)
        cdc.VersionedTable(spark, path, ["layer_id"]).apply(df, number)
    state = cdc.VersionedTable(spark, path, ["layer_id"])
    expected = cdc.upsert(None, frames[0].union(frames[1]).union(frames[2]).union(frames[3]), ["layer_id"])
    assert rows_of(state.read()) == rows_of(expected)
    before = state.manifest()
    state.apply(frames[0].where("layer_id = 0"), 4)
    after = state.manifest()
    assert after["number"] == 4 and sum(after["folders"][b] != f for b, f in before["folders"].items()) == 1
    assert rows_of(state.read()) == rows_of(expected)


def test_unfinished_batch_is_not_seen(spark, tmp_path):
    df = spark.createDataFrame([(1, 1, "a")], "k int, row_version long, v string")
    state = cdc.VersionedTable(spark, str(tmp_path / "state"), ["k"])
    state.apply(df, 0)
    cut_off = df.withColumns({"row_version": F.lit(2).cast("long"), "v": F.lit("cut off")})
    cut_off.write.parquet(str(tmp_path / "state" / "data" / "1-0000" / "bucket=0"))  # its rows, but no manifest
    assert rows_of(state.read()) == [(1, 1, "a")]
    state.apply(df.withColumn("row_version", F.lit(3).cast("long")), 1)
    assert rows_of(state.read()) == [(1, 3, "a")] and not (tmp_path / "state" / "data" / "1-0000").exists()


def test_empty_state_and_empty_batch(spark, tmp_path):
    df = spark.createDataFrame([(1, 1, "a")], "k int, row_version long, v string")
    state = cdc.VersionedTable(spark, str(tmp_path / "state"), ["k"])
    assert rows_of(state.read(df.schema)) == []
    with pytest.raises(ValueError, match="no batch yet"):
        state.read()
    state.apply(df.limit(0), 0)
    assert rows_of(state.read()) == []
    state.apply(df, 1)
    state.apply(df.limit(0), 2)
    assert rows_of(state.read()) == [(1, 1, "a")]


def test_many_batches_list_one_manifest(spark, tmp_path, monkeypatch):
    """Forty batches leave the folders of the buckets that they last wrote; a read opens one manifest."""
    state = cdc.VersionedTable(spark, str(tmp_path / "state"), ["layer_id"], buckets=4)
    rows = [(k % 5, k, k) for k in range(40)]
    for number, row in enumerate(rows):
        state.apply(spark.createDataFrame([row], "layer_id int, row_version long, value int"), number)
    assert sorted(p.name for p in (tmp_path / "state" / "manifest").iterdir() if p.name.isdigit()) == ["38", "39"]
    assert len(list((tmp_path / "state" / "data").iterdir())) <= 2 * 4
    opened = []
    monkeypatch.setattr(cdc, "read_text", lambda s, path, own=cdc.read_text: (opened.append(path), own(s, path))[1])
    assert rows_of(state.read()) == [(k, 35 + k, 35 + k) for k in range(5)]
    assert len(opened) == 1


def test_buckets_grow_with_the_rows(spark, tmp_path):
    state = cdc.VersionedTable(spark, str(tmp_path / "state"), ["k"], buckets=1, rows_a_bucket=50)
    df = spark.range(400).select(F.col("id").cast("int").alias("k"), F.lit(1).cast("long").alias("row_version"))
    state.apply(df.where("k < 40"), 0)
    assert state.manifest()["buckets"] == 1
    state.apply(df.where("k >= 30"), 1)
    now = state.manifest()
    assert now["buckets"] >= 8 and sum(now["rows"].values()) == 400 and state.read().select("k").distinct().count() == 400
    state.apply(df.where("k < 5").withColumn("row_version", F.lit(2).cast("long")), 2)
    assert state.manifest()["buckets"] == now["buckets"] and state.read().where("row_version = 2").count() == 5


def test_refresh_runs_until_it_is_stopped(spark, tmp_path):
    """New files are taken while the job runs; what comes while it is stopped is taken after the next start."""
    frames = batches_of(spark, 3)
    state = cdc.VersionedTable(spark, str(tmp_path / "state"), ["layer_id"])
    frames[0].coalesce(1).write.parquet(str(tmp_path / "in"))
    job = cdc.Refresh(spark, str(tmp_path / "in"), frames[0].schema, state.apply, str(tmp_path / "check"), 0.2)
    job.start()
    job.start()
    wait_for(lambda: state.manifest() is not None and rows_of(state.read()) == rows_of(frames[0]))
    frames[1].coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    expected = cdc.upsert(None, frames[0].union(frames[1]), ["layer_id"])
    wait_for(lambda: rows_of(state.read()) == rows_of(expected))
    job.stop()
    assert not job.running
    frames[2].coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    again = cdc.Refresh(spark, str(tmp_path / "in"), frames[0].schema, cdc.VersionedTable(spark, str(tmp_path / "state"), ["layer_id"]).apply, str(tmp_path / "check"), 0.2)
    again.start()
    expected = cdc.upsert(None, frames[0].union(frames[1]).union(frames[2]), ["layer_id"])
    wait_for(lambda: rows_of(state.read()) == rows_of(expected))
    again.stop()


def test_a_failed_batch_ends_the_job(spark, tmp_path):
    df = batches_of(spark, 1)[0]
    df.coalesce(1).write.parquet(str(tmp_path / "in"))

    def fail(batch, number):
        raise ValueError("the disk is full")

    job = cdc.Refresh(spark, str(tmp_path / "in"), df.schema, fail, str(tmp_path / "check"), 0.2)
    job.start()
    wait_for(lambda: not job.running)
    with pytest.raises(Exception, match="the disk is full"):
        job.stop()


def wait_for(condition, seconds=60):
    until = time.monotonic() + seconds
    while not condition():
        assert time.monotonic() < until
        time.sleep(0.2)


def test_runs_get_the_next_id(spark, tmp_path):
    path, rows = str(tmp_path / "runs"), spark.createDataFrame([(1,), (2,)], "k int")
    assert [sinks.append_run(rows, path, "first"), sinks.append_run(rows.limit(1), path, "second")] == [1, 2]
    rows.write.parquet(f"{path}/rows/run_id=3")  # cut off before its header
    assert sorted((r.run_id, r.k) for r in sinks.read_runs(spark, path).collect())[:2] == [(1, 1), (1, 2)] and sinks.read_runs(spark, path).count() == 3
    assert sinks.append_run(rows.limit(0), path, "third") == 3


def test_joins_that_fail(spark):
    left, right = spark.createDataFrame([(1,), (2,)], "k int"), spark.createDataFrame([(1, "a")], "k int, v string")
    with pytest.raises(Exception, match="no partner"):
        sinks.join_or_fail(left, right, ["k"]).collect()
    assert [tuple(r) for r in sinks.join_or_fail(left.where("k = 1"), right, ["k"]).collect()] == [(1, "a")]
    assert [tuple(r) for r in sinks.missing_keys(left, right, ["k"]).collect()] == [(2, 1)]


def test_superseded_versions_are_archived(spark, tmp_path):
    rows = spark.createDataFrame([(1, 1, 5, 1, 3, 1), (1, 2, 6, 1, 3, 1), (1, 10, 8, 1, 3, 1), (2, 1, 7, 1, 3, 1)], "loss_analysis_id int, row_version long, day int, year int, peril_id int, event_id long")
    path, archive = str(tmp_path / "yelt"), str(tmp_path / "old")
    sinks.write_versioned(rows, path)
    assert sorted((r.loss_analysis_id, r.day) for r in sinks.read_latest(spark, path).collect()) == [(1, 8), (2, 7)]
    assert sinks.archive_superseded(spark, path, archive) == 2 and sinks.archive_superseded(spark, path, archive) == 0
    assert sorted(r.day for r in spark.read.parquet(archive).collect()) == [5, 6] and spark.read.parquet(path).count() == 2


def test_stale_version_changes_nothing(spark):
    old = spark.createDataFrame([(1, 5, "new")], "k int, row_version long, v string")
    late = spark.createDataFrame([(1, 4, "stale")], "k int, row_version long, v string")
    assert [tuple(r) for r in cdc.upsert(old, late, ["k"]).collect()] == [(1, 5, "new")]


def test_append_is_idempotent(spark):
    target = spark.createDataFrame([(1, "a")], "k int, v string")
    new = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    once = target.union(sinks.new_rows(new, target, ["k"]))
    assert once.union(sinks.new_rows(new, once, ["k"])).count() == 2


def test_next_id_of_empty_table(spark):
    assert sinks.next_id(spark.createDataFrame([], "k int"), "k").first().next_id == 1


def test_repeated_keys_fail(spark):
    df = spark.createDataFrame([(1,), (1,)], "k int")
    with pytest.raises(Exception, match="keys repeat"):
        sinks.unique_or_fail(df, ["k"]).collect()


def test_versioned_write_keeps_the_latest(spark, tmp_path):
    rows = spark.createDataFrame([(1, 1, 5, 1, 3, 1), (1, 2, 6, 1, 3, 1), (2, 1, 7, 1, 3, 1)], "loss_analysis_id int, row_version long, day int, year int, peril_id int, event_id long")
    path = str(tmp_path / "yelt")
    sinks.write_versioned(rows, path)
    sinks.write_versioned(rows.where("loss_analysis_id = 2").withColumn("day", F.lit(9)), path)
    assert sorted((r.loss_analysis_id, r.day) for r in sinks.read_latest(spark, path).collect()) == [(1, 6), (2, 9)]
