"""Streaming jobs: stream = batch replay, restart from checkpoint, idempotent batches."""

import json

import pytest
from pyspark.sql import functions as F

from logtide.operators import audit as audit_ops
from logtide.operators import lateness
from logtide.session import new_work_dir
from logtide.sources.dimension import live_table_provider, snapshot_table_provider
from logtide.streaming import jobs
from logtide.streaming.replay import replay
from logtide.streaming.sinks import commit, committed, expire_batch, read_latest, read_output, upsert
from test_lateness import HALF_HOUR, HAND_MADE


def audit_messages(spark, rows):
    def text(t):
        from datetime import datetime, timezone

        dt = datetime.fromtimestamp(t / 1000, tz=timezone.utc).strftime("%Y-%m-%d %H:%M:%S")
        return json.dumps({"dt": dt, "type": "gate", "username": "u", "area": "A"})

    data = [(str(i), text(t), b) for i, (b, t, _) in enumerate(rows)]
    return spark.createDataFrame(data, "key string, value string, batch_id long")


def test_report_stream_equals_batch_replay(spark):
    msgs = audit_messages(spark, HAND_MADE)
    work = new_work_dir(spark, "test-report-stream")
    out = replay(spark, msgs, work, lambda s, o, c, t: jobs.report_job(s, o, c, HALF_HOUR, t))
    got = sorted(tuple(r) for r in spark.read.parquet(f"{out}/firings").select(
        "window_start_ms", "type", "area", "fire_batch", "count", "time").collect())
    batch = lateness.firings(lateness.classify(audit_ops.accepted(audit_ops.parse_audit(msgs)), HALF_HOUR))
    want = sorted(tuple(r) for r in batch.select(
        "window_start_ms", "type", "area", "fire_batch", "count", "time").collect())
    assert got == want and len(got) == 3
    late = [r.line for r in spark.read.parquet(f"{out}/late").collect()]
    assert late == [f"{HAND_MADE[5][1]}\tgate\tA"]
    docs = sorted((r.doc_id, r["count"]) for r in read_latest(spark, out, "documents").collect())
    assert docs == [("2024-01-01_00:29:00-gate-A", 3), ("2024-01-01_00:31:00-gate-A", 3)]


def test_report_batch_replayed_gives_same_files(spark):
    msgs = audit_messages(spark, HAND_MADE)

    def run(batches):
        out = new_work_dir(spark, "test-idempotent")
        for b in batches:
            jobs.report_batch(spark, msgs.where(F.col("batch_id") == b).drop("batch_id"), b, out, HALF_HOUR)
        return sorted(tuple(r) for r in spark.read.parquet(f"{out}/firings").collect())

    # a failure after batch 2 makes the engine run batch 2 again, then go on
    assert run([0, 1, 2, 2, 3, 4]) == run(range(5))


def test_clean_stream_rereads_dimension_each_batch(spark):
    work = new_work_dir(spark, "test-clean-stream")
    dim = f"{work}/dim"
    spark.createDataFrame([(0, "AREA_A", "US"), (1, None, None), (2, "AREA_B", "US,TW")],
                          "version int, area string, countries string").write.parquet(dim)
    raw = '{"dt":"d","countryCode":"%s","data":[{"type":"s1"},{"type":"s2"}]}'
    msgs = spark.createDataFrame([("0", raw % "US", 0), ("1", raw % "US", 1), ("2", raw % "TW", 2),
                                  ("3", "not json", 2)], "key string, value string, batch_id long")
    provider = snapshot_table_provider(dim)
    out = replay(spark, msgs, work, lambda s, o, c, t: jobs.clean_job(s, provider, o, c, t))
    got = sorted((r.key, r.batch_id, r.area, r.type) for r in spark.read.parquet(f"{out}/clean").collect())
    assert got == [("0", 0, "AREA_A", "s1"), ("0", 0, "AREA_A", "s2"), ("1", 1, "AREA_A", "s1"),
                   ("1", 1, "AREA_A", "s2"), ("2", 2, "AREA_B", "s1"), ("2", 2, "AREA_B", "s2")]
    q = [(r.key, r.reason) for r in spark.read.parquet(f"{out}/quarantine").collect()]
    assert q == [("3", "malformed")]
    m = {r.batch_id: (r.items, r.unmapped_items) for r in spark.read.parquet(f"{out}/metrics").collect()}
    assert m == {0: (2, 0), 1: (2, 0), 2: (2, 0)}
    assert {r.batch_id: r.quarantined for r in spark.read.parquet(f"{out}/metrics").collect()} == {0: 0, 1: 0, 2: 1}


def test_empty_micro_batch_keeps_state(spark):
    """A batch whose rows are all rejected moves nothing and loses no window."""
    msgs = audit_messages(spark, HAND_MADE)
    bad = spark.createDataFrame([("x", '{"dt":"bad","type":"gate","area":"A"}')], "key string, value string")
    out = new_work_dir(spark, "test-empty-batch")
    seq = [msgs.where(F.col("batch_id") == b).drop("batch_id") for b in range(2)]
    seq.append(bad)  # batch 2: nothing accepted
    seq += [msgs.where(F.col("batch_id") == b).drop("batch_id") for b in range(2, 5)]
    for i, df in enumerate(seq):
        jobs.report_batch(spark, df, i, out, HALF_HOUR)
    fir = sorted((r.window_start_ms, r.fire_batch, r["count"]) for r in spark.read.parquet(f"{out}/firings").collect())
    assert [(f[1], f[2]) for f in fir] == [(1, 2), (3, 3), (5, 3)]
    assert [r.reason for r in spark.read.parquet(f"{out}/rejects").collect()] == ["bad_time"]


def test_builtin_watermark_path_emits_closed_windows_once(spark):
    """The plain withWatermark + append path: one row per closed window, late rows dropped."""
    work = new_work_dir(spark, "test-simple-stream")
    src = f"{work}/src"
    rows = spark.createDataFrame(
        [(b, t, "gate", "A") for b, t, _ in HAND_MADE], "batch_id long, time_ms long, type string, area string")
    schema = "time_ms long, type string, area string"
    for b in range(5):
        rows.where(F.col("batch_id") == b).drop("batch_id").write.mode("append").json(src)
        q = (jobs.simple_report_stream(spark.readStream.schema(schema).json(src), HALF_HOUR)
             .writeStream.outputMode("append").format("parquet")
             .option("path", f"{work}/out").option("checkpointLocation", f"{work}/ckpt")
             .trigger(availableNow=True).start())
        q.awaitTermination()
    got = spark.read.parquet(f"{work}/out").select("window.start", "count").collect()
    # Every window comes once, never refined, with no more rows than it has in all.
    whole = rows.groupBy(F.window(F.timestamp_millis("time_ms"), f"{HALF_HOUR} milliseconds").start.alias("start")).count().collect()
    whole = {r.start: r["count"] for r in whole}
    assert got and len(got) == len({r.start for r in got})
    assert all(0 < r["count"] <= whole[r.start] for r in got)
    assert min(whole) in {r.start for r in got}


def test_report_stream_metrics(spark):
    msgs = audit_messages(spark, HAND_MADE)
    out = new_work_dir(spark, "test-metrics")
    for b in range(5):
        jobs.report_batch(spark, msgs.where(F.col("batch_id") == b).drop("batch_id"), b, out, HALF_HOUR)
    m = {r.batch_id: (r.messages, r.rejected, r.late, r.fired_windows)
         for r in spark.read.parquet(f"{out}/metrics").collect()}
    assert m == {0: (2, 0, 0, 0), 1: (1, 0, 0, 1), 2: (2, 0, 0, 1), 3: (2, 0, 1, 0), 4: (1, 0, 0, 1)}


def latest(spark, out):
    rows = read_latest(spark, out, "docs")
    return None if rows is None else {r.doc_id: r["count"] for r in rows.collect()}


def test_upserts_are_read_as_of_the_last_marked_batch(spark):
    out = new_work_dir(spark, "test-upsert")
    rows = [(0, "a", 1), (0, "b", 1), (1, "a", 2), (2, "c", 1), (3, "b", 5), (4, "a", 9)]
    want = [{"a": 1, "b": 1}, {"a": 2, "b": 1}, {"a": 2, "b": 1, "c": 1}, {"a": 2, "b": 5, "c": 1}, {"a": 9, "b": 5, "c": 1}]
    assert latest(spark, out) is None
    for b in range(5):
        df = spark.createDataFrame([(k, v) for bb, k, v in rows if bb == b], "doc_id string, count long")
        for _ in range(2):  # a crash between the write and the mark: the batch runs again
            upsert(df, f"{out}/docs", "doc_id", b)
            assert latest(spark, out) == (want[b - 1] if b else None)
        commit(spark, out, b)
        assert latest(spark, out) == want[b] and committed(spark, out) == b
    with pytest.raises(RuntimeError, match="state of batch 7"):
        upsert(df, f"{out}/docs", "doc_id", 8)


def half_written(spark, path, batch, finished=False):
    """What a crash in mid-write leaves: a folder with the writer's own files, or with some of the parts."""
    folder = f"{path}/batch_id={batch}"
    if finished:
        spark.createDataFrame([("other",)], "strange string").write.mode("overwrite").parquet(folder)
    fs = spark._jvm.org.apache.hadoop.fs.Path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    fs.create(spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/_temporary/0/part-0"), True).close()


@pytest.mark.parametrize("finished", [False, True])
def test_report_goes_on_after_a_crash_in_mid_write(spark, finished):
    msgs = audit_messages(spark, HAND_MADE)
    out = new_work_dir(spark, "test-crash-report")
    seen = []
    for b in range(5):
        for name in ("rejects", "late", "firings", "state", "metrics"):
            half_written(spark, f"{out}/{name}", b, finished)
        if b:  # readers see the whole batches before
            assert [r.batch_id for r in read_output(spark, out, "metrics").orderBy("batch_id").collect()] == list(range(b))
            assert read_output(spark, out, "firings").count() == seen[-1]
        jobs.report_batch(spark, msgs.where(F.col("batch_id") == b).drop("batch_id"), b, out, HALF_HOUR)
        seen.append(read_output(spark, out, "firings").count())
    assert seen == [0, 1, 2, 2, 3]
    assert [r.line for r in read_output(spark, out, "late").collect()] == [f"{HAND_MADE[5][1]}\tgate\tA"]
    docs = sorted((r.doc_id, r["count"]) for r in read_latest(spark, out, "documents").collect())
    assert docs == [("2024-01-01_00:29:00-gate-A", 3), ("2024-01-01_00:31:00-gate-A", 3)]


def test_clean_goes_on_after_a_crash_in_mid_write(spark):
    out = new_work_dir(spark, "test-crash-clean")
    raw = '{"dt":"d","countryCode":"US","data":[{"type":"s1"}]}'
    msgs = spark.createDataFrame([("0", raw)], "key string, value string")
    work = new_work_dir(spark, "test-crash-mapping")
    spark.createDataFrame([("A", "US")], "area string, countries string").write.parquet(f"{work}/live")
    provider = live_table_provider(f"{work}/live", f"{work}/state")
    for b in range(2):
        half_written(spark, f"{work}/state", b)
        for name in ("clean", "quarantine", "metrics"):
            half_written(spark, f"{out}/{name}", b)
        jobs.clean_batch(spark, msgs, b, provider, out)
        jobs.clean_batch(spark, msgs.limit(0), b, provider, out)  # marked: left as it is
    assert [(r.batch_id, r.area) for r in read_output(spark, out, "clean").orderBy("batch_id").collect()] == [(0, "A"), (1, "A")]


def test_missing_state_is_an_error(spark):
    msgs = audit_messages(spark, HAND_MADE)
    out = new_work_dir(spark, "test-missing-state")
    jobs.report_batch(spark, msgs.where("batch_id = 0").drop("batch_id"), 0, out, HALF_HOUR)
    expire_batch(spark, f"{out}/state", 0)
    with pytest.raises(RuntimeError, match="state of batch 0"):
        jobs.report_batch(spark, msgs.where("batch_id = 1").drop("batch_id"), 1, out, HALF_HOUR)


def test_live_mapping_keeps_the_last_one_that_was_not_empty(spark):
    work = new_work_dir(spark, "test-live")

    def publish(rows):
        spark.createDataFrame(rows, "area string, countries string").write.mode("overwrite").parquet(f"{work}/live")

    def provide(batch):  # a new provider each time, as after a restart
        return sorted(tuple(r) for r in live_table_provider(f"{work}/live", f"{work}/state")(spark, batch).select(
            "country_code", "area").collect())

    publish([])
    assert provide(0) == []
    publish([("A", "US,TW")])
    assert provide(7) == [("TW", "A"), ("US", "A")]
    publish([])
    assert provide(8) == [("TW", "A"), ("US", "A")]
    publish([("B", "US")])
    assert provide(8) == [("TW", "A"), ("US", "A")]  # run again: as before
    assert provide(9) == [("US", "B")]


def test_polled_snapshots_go_on_at_the_stored_offset(spark):
    """Restarts take only new snapshots; an empty one, one without a mark, and no new one change nothing."""
    from logtide.sources.snapshots import read_snapshots
    from logtide.sources.topics import read_staged, stage

    work = new_work_dir(spark, "test-polled")
    raw = '{"dt":"d","countryCode":"US","data":[{"type":"s"}]}'

    def publish(version, rows):
        spark.createDataFrame(rows, "area string, countries string").write.parquet(f"{work}/snapshots/version={version}")

    def batch(n):
        stage(spark.createDataFrame([(str(n), raw)], "key string, value string"), f"{work}/src")
        q = jobs.connected_clean_job(read_staged(spark, f"{work}/src"), read_snapshots(spark, f"{work}/snapshots"),
                                     f"{work}/out", f"{work}/ckpt", {"availableNow": True})
        q.awaitTermination()

    batch(0)  # no snapshot yet
    publish(3, [("A", "US")])
    publish(4, [("B", "US,TW")])
    batch(1)
    publish(6, [])
    batch(2)
    half_written(spark, f"{work}/snapshots", 0)
    spark._jvm.org.apache.hadoop.fs.Path(work).getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(
        spark._jvm.org.apache.hadoop.fs.Path(f"{work}/snapshots/version=8"))
    batch(3)
    publish(9, [("C", "US")])
    batch(4)
    rows = read_output(spark, f"{work}/out", "clean").collect()
    assert sorted((r.key, r.area) for r in rows) == [("0", None), ("1", "B"), ("2", "B"), ("3", "B"), ("4", "C")]


def test_listener_counts_each_batch_once(spark, sf001):
    from logtide.plans.catalog import QUERIES

    rows = QUERIES["stream_file_counters"](spark, sf001).collect()
    assert len({(r.batch_id, r.metric) for r in rows}) == len(rows) == 14
    assert sum(r.value for r in rows if r.metric == "items") == QUERIES["stream_clean_files"](spark, sf001).count()


def test_replay_refuses_gaps(spark):
    msgs = spark.createDataFrame([("0", "x", 0), ("1", "y", 2)], "key string, value string, batch_id long")
    with pytest.raises(ValueError, match="gap"):
        replay(spark, msgs, new_work_dir(spark, "test-gap"), lambda *a: None)


def test_shared_folder_must_be_named_on_a_cluster(monkeypatch):
    from logtide import session

    class Conf:
        def get(self, key, default=None):
            return {"spark.master": "local-cluster[2,1,1024]"}.get(key, default)

    class Fake:
        conf = Conf()

        class sparkContext:
            @staticmethod
            def getCheckpointDir():
                return None

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_dir(Fake())


def test_repeated_queries_leave_no_growing_set_of_folders(spark, sf001):
    import os

    from logtide.plans.catalog import QUERIES
    from logtide.session import KEEP_RUNS, shared_dir

    count = lambda: len(os.listdir(shared_dir(spark)))
    sizes = []
    for _ in range(KEEP_RUNS + 2):
        QUERIES["late_rows"](spark, sf001)
        sizes.append(count())
    assert sizes[-1] == sizes[-2]
