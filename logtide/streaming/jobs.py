"""The streaming jobs; those that keep state between batches are built on ``foreachBatch``.

They run the batch operators on each micro-batch. Everything a batch writes
lives under folders named by its batch id and is written in overwrite mode; the
batch counts from its mark on, which is written last. A batch that is run again
after a crash replaces what it had written; one that had got its mark is left as
it is, so readers never see it change. The only state carried between batches
(the previous batch's ledger row, its table of live windows and the documents) is
read from those folders. An output folder belongs to one checkpoint.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from logtide.functions.text import doc_id, late_line
from logtide.functions.timefmt import format_time_ms
from logtide.operators import audit as audit_ops
from logtide.operators import clean as clean_ops
from logtide.operators.area import enrich_area, invert_mapping, latest_nonempty_version
from logtide.operators.lateness import with_window
from logtide.schemas import ALLOWED_LATENESS_MS, OUT_OF_ORDERNESS_MS, REPORT_WINDOW_MS
from logtide.sources.dimension import Provider
from logtide.streaming.sinks import TYPE_FOLDER, by_type, commit, committed, expire_batch, read_batch, upsert, write_batch

# Batches whose state is kept; a batch that is run again needs the one before it.
KEEP_STATE = 3


def _start(source: DataFrame, fn, checkpoint: str, trigger: dict | None) -> StreamingQuery:
    w = source.writeStream.foreachBatch(fn).option("checkpointLocation", checkpoint)
    w = w.trigger(**(trigger or {"processingTime": "60 seconds"}))
    return w.start()


def _done(spark: SparkSession, out: str, batch_id: int) -> bool:
    """Whether the batch has its mark."""
    last = committed(spark, out)
    return last is not None and batch_id <= last


def clean_batch(spark: SparkSession, messages: DataFrame, batch_id: int, provider: Provider, out: str) -> None:
    """One micro-batch of the clean job.

    The mapping is read before the batch runs, so records never see an empty
    mapping at start-up; the snapshot guard keeps empty snapshots out.
    """
    if _done(spark, out, batch_id):
        return
    country_area = provider(spark, batch_id)
    parsed = clean_ops.parse_messages(messages).persist()
    try:
        obs = Observation(f"clean_{batch_id}")
        items = enrich_area(clean_ops.flatten(parsed), country_area).observe(
            obs, F.count(F.lit(1)).alias("items"),
            F.count_if(F.col("area").isNull()).alias("unmapped_items"))
        write_batch(by_type(clean_ops.finish(items)), f"{out}/clean", batch_id, partition_by=[TYPE_FOLDER])
        bad_obs = Observation(f"quarantine_{batch_id}")
        q = clean_ops.quarantine(parsed).select("key", "value", "reason")
        write_batch(q.observe(bad_obs, F.count(F.lit(1)).alias("quarantined")), f"{out}/quarantine", batch_id)
        m = obs.get
        metrics = spark.createDataFrame(
            [(int(m.get("items", 0)), int(m.get("unmapped_items", 0)), int(bad_obs.get.get("quarantined", 0)))],
            "items long, unmapped_items long, quarantined long")
        write_batch(metrics, f"{out}/metrics", batch_id)
        commit(spark, out, batch_id)
    finally:
        parsed.unpersist()


def clean_job(source: DataFrame, provider: Provider, out: str, checkpoint: str,
              trigger: dict | None = None) -> StreamingQuery:
    """Raw log stream -> clean records (split by type), quarantine, counters."""

    def run(df: DataFrame, batch_id: int) -> None:
        clean_batch(df.sparkSession, df, batch_id, provider, out)

    return _start(source, run, checkpoint, trigger)


def connect(messages: DataFrame, snapshots: DataFrame) -> DataFrame:
    """Messages and dimension snapshots as one stream: rows of either have nulls in the other's columns."""
    return messages.select("key", "value").unionByName(
        snapshots.select("version", "area", "countries"), allowMissingColumns=True)


def connected_clean_job(messages: DataFrame, snapshots: DataFrame, out: str, checkpoint: str,
                        trigger: dict | None = None) -> StreamingQuery:
    """The clean job with the mapping as a second stream (version, area, countries) of the same query.

    Both sources' offsets are in one checkpoint. A batch takes the newest non-empty snapshot that came with it,
    else the mapping that the batch before used, which is stored under ``out``/mapping.
    """

    def run(df: DataFrame, batch_id: int) -> None:
        spark = df.sparkSession
        if _done(spark, out, batch_id):
            return
        df = df.persist()  # feeds the mapping and the messages, so both sources are read once
        try:
            came = df.where(F.col("version").isNotNull()).select("version", "area", "countries")
            now = latest_nonempty_version(came)
            if now is None:
                before = _previous(spark, out, "mapping", batch_id)
                now = invert_mapping(came) if before is None else before
            write_batch(now, f"{out}/mapping", batch_id)
            in_force = read_batch(spark, f"{out}/mapping", batch_id).drop("batch_id")
            clean_batch(spark, df.where(F.col("version").isNull()).select("key", "value"), batch_id, lambda *_: in_force, out)
            expire_batch(spark, f"{out}/mapping", batch_id - KEEP_STATE)
        finally:
            df.unpersist()

    return _start(connect(messages, snapshots), run, checkpoint, trigger)


def clean_file_job(source: DataFrame, country_area: DataFrame, out: str, checkpoint: str,
                   trigger: dict | None = None) -> StreamingQuery:
    """Raw log stream -> clean records by type, through Spark's own file sink: its log names the files of whole
    batches, and Spark's readers take only those. ``country_area`` is the mapping at the start of the query.

    Counters are observed on the way (``clean_files``); a ``Counters`` listener receives them.
    """
    parsed = clean_ops.parse_messages(source)
    items = enrich_area(clean_ops.flatten(parsed), country_area).observe(
        "clean_files", F.count(F.lit(1)).alias("items"), F.count_if(F.col("area").isNull()).alias("unmapped_items"))
    writer = (by_type(clean_ops.finish(items)).writeStream.format("parquet").outputMode("append").partitionBy(TYPE_FOLDER)
              .option("path", out).option("checkpointLocation", checkpoint))
    return writer.trigger(**(trigger or {"processingTime": "60 seconds"})).start()


def _previous(spark: SparkSession, out: str, name: str, batch_id: int) -> DataFrame | None:
    """Rows the previous micro-batch stored (batch ids are consecutive); None before the first.

    They must be there: without them, open windows and the watermark would be lost in silence.
    """
    if batch_id == 0:
        return None
    path = f"{out}/{name}"
    try:
        if not _done(spark, out, batch_id - 1):
            raise RuntimeError(f"state of batch {batch_id - 1} under {path} is not committed")
        return read_batch(spark, path, batch_id - 1).drop("batch_id")
    except AnalysisException as err:
        raise RuntimeError(f"state of batch {batch_id - 1} under {path} is missing or unreadable; "
                           f"batch {batch_id} cannot go on without it") from err


def report_batch(spark: SparkSession, messages: DataFrame, batch_id: int, out: str,
                 size_ms: int = REPORT_WINDOW_MS, out_of_orderness_ms: int = OUT_OF_ORDERNESS_MS,
                 lateness_ms: int = ALLOWED_LATENESS_MS) -> None:
    """One micro-batch of the report job: rejects, late rows, firings, documents, state, metrics.

    State between batches is two small tables written by the previous batch:
    its metrics row (which holds the max event time so far) and the live windows
    (counts of windows not yet past their lateness). Reading only batch N-1's
    state keeps the work per batch bounded by the live windows, not by the
    stream's age. Firings carry their document id; the documents are a keyed
    state that each batch's firings update.
    """
    if _done(spark, out, batch_id):
        return
    parsed = audit_ops.parse_audit(messages).persist()  # feeds rows and rejects
    try:
        # The rejects write also yields the batch's message count and max
        # accepted event time (observed on the way, no extra job).
        seen_obs = Observation(f"report_seen_{batch_id}")
        ok = (F.col("time_ms") != 0) & F.col("type").isNotNull() & F.col("area").isNotNull()
        observed = parsed.observe(seen_obs, F.count(F.lit(1)).alias("messages"),
                                  F.max(F.when(ok, F.col("time_ms"))).alias("mx"),
                                  F.count_if(~ok).alias("rejected"))
        write_batch(audit_ops.rejects(observed), f"{out}/rejects", batch_id)
        seen = seen_obs.get
        mx = seen.get("mx")
        rows = with_window(audit_ops.accepted(parsed), size_ms)

        # Watermark before this batch: max event time of earlier batches.
        prev_metrics = _previous(spark, out, "metrics", batch_id)
        prev = prev_metrics.first()["upto"] if prev_metrics is not None else None
        known = [v for v in (prev, mx) if v is not None]
        upto = max(known) if known else None
        wm_before = max(prev or 0, 0) - out_of_orderness_ms
        wm_after = max(upto or 0, 0) - out_of_orderness_ms

        end1 = F.col("window_end_ms") - F.lit(1)
        flagged = rows.withColumn("is_late", end1 + F.lit(lateness_ms) <= F.lit(wm_before))
        late_obs = Observation(f"report_late_{batch_id}")
        late = flagged.where("is_late").select(
            "key", "time_ms", "type", "area", late_line(F.col("time_ms"), F.col("type"), F.col("area")).alias("line"))
        write_batch(late.observe(late_obs, F.count(F.lit(1)).alias("late")), f"{out}/late", batch_id)

        keys = ["window_start_ms", "window_end_ms", "type", "area"]
        parts = flagged.where(~F.col("is_late")).groupBy(*keys).agg(
            F.count(F.lit(1)).alias("n"), F.max("time_ms").alias("mx")).withColumn("touched", F.lit(True))
        live_before = _previous(spark, out, "state", batch_id)
        if live_before is not None:
            parts = parts.unionByName(live_before.select(*keys, "n", "mx", F.lit(False).alias("touched")))
        totals = parts.groupBy(*keys).agg(
            F.sum("n").alias("n"), F.max("mx").alias("mx"), F.max("touched").alias("touched")).persist()

        # Windows that fire now: closed by this batch's watermark, and either
        # closed just now or refined by rows of this batch.
        fires = (end1 <= F.lit(wm_after)) & ((end1 > F.lit(wm_before)) | F.col("touched"))
        fired = totals.where(fires).select(
            "window_start_ms", "type", "area", F.lit(batch_id).cast("long").alias("fire_batch"),
            F.col("n").cast("long").alias("count"), format_time_ms(F.col("mx")).alias("time"))
        fired = fired.withColumn("doc_id", doc_id(F.col("time"), F.col("type"), F.col("area")))
        fired_obs = Observation(f"report_fired_{batch_id}")
        write_batch(fired.observe(fired_obs, F.count(F.lit(1)).alias("fired")), f"{out}/firings", batch_id)
        documents = read_batch(spark, f"{out}/firings", batch_id).groupBy("doc_id").agg(
            *[F.max_by(c, "window_start_ms").alias(c) for c in ("time", "type", "area", "count")])
        upsert(documents, f"{out}/documents", "doc_id", batch_id)
        # Windows past their lateness can never change again: drop them from state.
        live = totals.where(end1 + F.lit(lateness_ms) > F.lit(wm_after)).select(*keys, "n", "mx")
        write_batch(live, f"{out}/state", batch_id)
        totals.unpersist()

        metrics = spark.createDataFrame(
            [(int(seen.get("messages", 0)), int(seen.get("rejected", 0)), int(late_obs.get.get("late", 0)),
              int(fired_obs.get.get("fired", 0)), wm_after, mx, upto)],
            "messages long, rejected long, late long, fired_windows long, watermark_ms long, mx long, upto long")
        write_batch(metrics, f"{out}/metrics", batch_id)
        commit(spark, out, batch_id)
        expire_batch(spark, f"{out}/state", batch_id - KEEP_STATE)
    finally:
        parsed.unpersist()


def report_job(source: DataFrame, out: str, checkpoint: str, size_ms: int = REPORT_WINDOW_MS,
               trigger: dict | None = None, out_of_orderness_ms: int = OUT_OF_ORDERNESS_MS,
               lateness_ms: int = ALLOWED_LATENESS_MS) -> StreamingQuery:
    """Audit stream -> firings, documents (keyed upserts of the firings), late rows, rejects, counters."""

    def run(df: DataFrame, batch_id: int) -> None:
        report_batch(df.sparkSession, df, batch_id, out, size_ms, out_of_orderness_ms, lateness_ms)

    return _start(source, run, checkpoint, trigger)


def simple_report_stream(rows: DataFrame, size_ms: int = REPORT_WINDOW_MS,
                         out_of_orderness_ms: int = OUT_OF_ORDERNESS_MS) -> DataFrame:
    """Built-in path: watermark + windowed count in append mode.

    Emits each window once after it closes; it cannot refine within lateness
    or keep late rows (Spark drops them), which ``report_job`` does.
    """
    ts = F.timestamp_millis(F.col("time_ms"))
    return (rows.withColumn("event_time", ts)
            .withWatermark("event_time", f"{out_of_orderness_ms} milliseconds")
            .groupBy(F.window("event_time", f"{size_ms} milliseconds"), "type", "area")
            .agg(F.count(F.lit(1)).alias("count"), F.max("time_ms").alias("max_ms")))


def append_report_job(source: DataFrame, out: str, checkpoint: str, size_ms: int = REPORT_WINDOW_MS,
                      trigger: dict | None = None, out_of_orderness_ms: int = OUT_OF_ORDERNESS_MS) -> StreamingQuery:
    """Audit stream -> report of closed windows, each once, by the built-in path and the file sink."""
    report = simple_report_stream(audit_ops.accepted(audit_ops.parse_audit(source)), size_ms, out_of_orderness_ms).select(
        F.unix_millis("window.start").alias("window_start_ms"), "type", "area", "count", format_time_ms(F.col("max_ms")).alias("time"))
    writer = (report.writeStream.format("parquet").outputMode("append")
              .option("path", out).option("checkpointLocation", checkpoint))
    return writer.trigger(**(trigger or {"processingTime": "60 seconds"})).start()
