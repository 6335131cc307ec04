"""Registry of runnable queries: name -> (spark, sf_dir) -> DataFrame, with SQL oracles.

Queries set the session's time zone to UTC and leave it so: their frames run later,
and the text times of both logs are UTC.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logtide.functions.json_items import item_string
from logtide.operators import area as area_ops
from logtide.operators import audit as audit_ops
from logtide.operators import clean as clean_ops
from logtide.operators import lateness
from logtide.operators import report as report_ops
from logtide.operators.once import computed_once
from logtide.plans import fixtures as fx
from logtide.plans import oracles as o
from logtide.schemas import REPORT_WINDOW_MS, SHORT_WINDOW_MS
from logtide.session import checkpointed, new_work_dir, query_run, session_id, use_utc
from logtide.sources.dimension import empty_snapshots, snapshot_table_provider
from logtide.sources.snapshots import read_snapshots
from logtide.streaming import jobs
from logtide.streaming.counters import Counters
from logtide.streaming.replay import replay
from logtide.streaming.sinks import TYPE_FOLDER, read_by_type, read_latest, read_output, write_by_type

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def wrap(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            use_utc(spark)
            with query_run(spark, name):
                return fn(spark, sf_dir)

        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = oracle.strip()
        return run

    return wrap


# ----------------------------------------------------------------- clean job

def _mapping(spark, sf_dir, **kw) -> DataFrame:
    return area_ops.invert_mapping(fx.area_mapping(spark, sf_dir, **kw))


def _reread(records: DataFrame, *more: Column) -> DataFrame:
    """Fields read back from the clean JSON text (key order does not matter)."""
    r, back = F.col("record"), F.col("_back")
    # Its fields are read from one parse, not one each.
    read = computed_once(records, _back=F.from_json(r, "type string, score double, level string, area string, dt string, "
                                                       "meta struct<line string>"))
    return read.select(
        "key", "item_pos",
        F.array_join(F.array_sort(F.json_object_keys(r)), ",").alias("keys"),
        back["type"].alias("type"), back["score"].alias("score"), back["level"].alias("level"),
        back["area"].alias("area"), back["dt"].alias("dt"), back["meta"]["line"].alias("meta_line"),
        *more,
    )


@register("clean_flatten_enrich", f"""
WITH {o.ITEMS}
SELECT i.key, i.item_pos, i.dt, i.country_code, {o.AREA_OF_REGION} AS area, i.type, i.score, i.level
FROM items i JOIN region r ON i.n_regionkey = r.r_regionkey""")
def clean_flatten_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parse nested logs, one row per item, area from the country mapping."""
    recs = clean_ops.clean_records(fx.raw_log(spark, sf_dir), _mapping(spark, sf_dir))
    return recs.select("key", "item_pos", "dt", "country_code", "area", "type", "score", "level")


@register("clean_json_records", f"""
WITH {o.DIRTY_ITEMS}
SELECT i.key, i.item_pos,
       CASE WHEN i.l_linenumber IS NULL THEN 'area,dt,type' WHEN i.dirty_case = 7 THEN 'area,dt,level,meta,score,type'
            WHEN i.dirty_case = 8 THEN 'area,dt,score,type' ELSE 'area,dt,level,score,type' END AS keys,
       i.type, i.score, CASE WHEN i.dirty_case = 8 THEN NULL ELSE i.level END AS level,
       {o.AREA_OF_REGION} AS area, i.dt,
       CASE WHEN i.dirty_case = 7 THEN CAST(i.l_linenumber AS VARCHAR) END AS meta_line,
       CASE WHEN i.dirty_case = 7 THEN '{{"deep":{{}},"line":' || i.l_linenumber || ',"tags":["a",null,"\\\\",":null,"]}}' END AS meta
FROM good_items i JOIN region r ON i.n_regionkey = r.r_regionkey""")
def clean_json_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean JSON records of the dirty log, read back field by field; nested objects have no null keys."""
    recs = clean_ops.clean_records(fx.raw_log(spark, sf_dir, dirty=True), _mapping(spark, sf_dir))
    return _reread(recs, F.get_json_object("record", "$.meta").alias("meta"))


@register("clean_overwrite_keys", f"""
WITH {o.DIRTY_ITEMS}
SELECT i.key, i.item_pos, CASE WHEN i.dirty_case = 5 THEN 'stale' END AS input_area,
       CASE WHEN i.dirty_case = 5 THEN 'stale' END AS input_dt,
       {o.AREA_OF_REGION} AS area, i.dt
FROM good_items i JOIN region r ON i.n_regionkey = r.r_regionkey""")
def clean_overwrite_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items that already hold area/dt get them overwritten; other keys stay."""
    items = clean_ops.flatten(clean_ops.parse_messages(fx.raw_log(spark, sf_dir, dirty=True)))
    items = area_ops.enrich_area(items, _mapping(spark, sf_dir))
    items = items.withColumn("input_area", item_string(F.col("item"), "area")).withColumn(
        "input_dt", item_string(F.col("item"), "dt"))
    recs = clean_ops.finish(items)
    return recs.select("key", "item_pos", "input_area", "input_dt",
                       F.get_json_object("record", "$.area").alias("area"),
                       F.get_json_object("record", "$.dt").alias("dt"))


@register("clean_empty_and_null", f"""
WITH {o.ITEMS}
SELECT i.key, i.item_pos, i.country_code, {o.AREA_OF_REGION} AS area
FROM items i LEFT JOIN (SELECT * FROM region WHERE r_regionkey <> 4) r ON i.n_regionkey = r.r_regionkey""")
def clean_empty_and_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders without items emit nothing; countries of a dropped region keep a NULL area."""
    recs = clean_ops.clean_records(fx.raw_log(spark, sf_dir), _mapping(spark, sf_dir, drop_region=4))
    return recs.select("key", "item_pos", "country_code", "area")


@register("clean_quarantine", f"""
WITH {o.DIRTY_ITEMS} SELECT key, reason FROM messages JOIN faults USING (dirty_case)""")
def clean_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records that cannot be cleaned go to quarantine with a reason; the job goes on."""
    q = clean_ops.quarantine(clean_ops.parse_messages(fx.raw_log(spark, sf_dir, dirty=True)))
    return q.select("key", "reason")


@register("area_mapping", """
SELECT n_name AS country_code, max('AREA_' || r_name) AS area FROM (
  SELECT n.n_name, r.r_name FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey
  UNION ALL
  SELECT n.n_name, r.r_name FROM nation n JOIN region r ON (n.n_regionkey + 1) % 5 = r.r_regionkey
  WHERE n.n_nationkey = 0)
GROUP BY n_name""")
def area_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Invert area -> "C1,C2," rows into country -> area (empty pieces dropped)."""
    return _mapping(spark, sf_dir, quirks=True)


@register("area_as_of_version", f"""
WITH {o.ITEMS}, {o.VERSIONS}
SELECT i.key, i.item_pos, i.batch_id, i.country_code, v.area
FROM items i JOIN inforce f ON i.batch_id = f.batch_id
LEFT JOIN vmap v ON v.version = f.version AND v.country_code = i.country_code""")
def area_as_of_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each batch uses the newest non-empty mapping snapshot published at or before it."""
    recs = clean_ops.clean_records_as_of(fx.raw_log(spark, sf_dir), fx.mapping_versions(spark, sf_dir))
    return recs.select("key", "item_pos", "batch_id", "country_code", "area")


# ---------------------------------------------------------------- report job

def _dirty_audit(spark, sf_dir) -> DataFrame:
    return audit_ops.parse_audit(fx.audit_log(spark, sf_dir, dirty=True).drop("event_id"))


@register("audit_parse", f"WITH {o.DIRTY_AUDIT} SELECT key, time_ms, type, area FROM parsed")
def audit_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Audit JSON -> (time_ms, type, area); a failed time parse gives 0."""
    return _dirty_audit(spark, sf_dir).select("key", "time_ms", "type", "area")


@register("audit_filter", f"WITH {o.DIRTY_AUDIT} SELECT key, time_ms, type, area FROM accepted")
def audit_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit_ops.accepted(_dirty_audit(spark, sf_dir)).select("key", "time_ms", "type", "area")


@register("audit_rejects", f"WITH {o.DIRTY_AUDIT} SELECT key, reason FROM rejected")
def audit_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit_ops.rejects(_dirty_audit(spark, sf_dir)).select("key", "reason")


@register("audit_quarantine", f"WITH {o.DIRTY_AUDIT} SELECT key, value, reason FROM rejected WHERE fault IS NOT NULL")
def audit_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Audit messages that are no sound JSON object, with their raw text."""
    return audit_ops.rejects(_dirty_audit(spark, sf_dir)).where(F.col("reason").isin("empty", "malformed")).select(
        "key", "value", "reason")


@register("report_30m", f"WITH {o.DIRTY_AUDIT} {o.report(REPORT_WINDOW_MS, 'accepted')}")
def report_30m(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Count per 30-minute window, type and area; time = latest event in the group."""
    return report_ops.tumbling_report(audit_ops.accepted(_dirty_audit(spark, sf_dir)), REPORT_WINDOW_MS)


@register("report_30s", f"WITH {o.DIRTY_AUDIT} {o.report(SHORT_WINDOW_MS, 'accepted')}")
def report_30s(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report_ops.tumbling_report(audit_ops.accepted(_dirty_audit(spark, sf_dir)), SHORT_WINDOW_MS)


@register("report_documents_id", f"""WITH {o.DIRTY_AUDIT}, rep AS ({o.report(REPORT_WINDOW_MS, 'accepted')})
SELECT replace(time, ' ', '_') || '-' || type || '-' || area AS doc_id, time, type, area, count,
       '{{"time":"' || time || '","type":"' || type || '","area":"' || area || '","count":' || CAST(count AS VARCHAR) || '}}' AS doc
FROM rep""")
def report_documents_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Search documents of the 30-minute report with their time-type-area ids."""
    return report_ops.documents(report_30m(spark, sf_dir))


def _late_classified(spark, sf_dir) -> DataFrame:
    rows = audit_ops.accepted(audit_ops.parse_audit(fx.late_audit_log(spark, sf_dir).drop("event_id")))
    return lateness.classify(rows, REPORT_WINDOW_MS)


@register("late_rows", f"""WITH {o.LATE_AUDIT}, {o.ledger_rows('src', REPORT_WINDOW_MS)}
SELECT key, batch_id, time_ms, type, area FROM cls WHERE is_late""")
def late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows whose window is past its allowed lateness at arrival (side output)."""
    return lateness.late_rows(_late_classified(spark, sf_dir)).select("key", "batch_id", "time_ms", "type", "area")


@register("late_lines", f"""WITH {o.LATE_AUDIT}, {o.ledger_rows('src', REPORT_WINDOW_MS)}
SELECT key, CAST(time_ms AS VARCHAR) || chr(9) || type || chr(9) || area AS line FROM cls WHERE is_late""")
def late_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Late rows as tab-separated text lines."""
    return lateness.late_rows(_late_classified(spark, sf_dir)).select("key", "line")


@register("report_accepted", f"""WITH {o.LATE_AUDIT}, {o.ledger_rows('src', REPORT_WINDOW_MS)},
okrows AS (SELECT * FROM cls WHERE NOT is_late)
{o.report(REPORT_WINDOW_MS, 'okrows')}""")
def report_accepted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 30-minute report over rows that were not late."""
    rows = audit_ops.accepted(audit_ops.parse_audit(fx.late_audit_log(spark, sf_dir).drop("event_id")))
    return lateness.accepted_report(lateness.classify_groups(rows, REPORT_WINDOW_MS))


def _compressed_classified(spark, sf_dir) -> DataFrame:
    rows = audit_ops.accepted(audit_ops.parse_audit(fx.compressed_audit_log(spark, sf_dir)))
    return lateness.classify(rows, SHORT_WINDOW_MS)


def _compressed_groups(spark, sf_dir) -> DataFrame:
    rows = audit_ops.accepted(audit_ops.parse_audit(fx.compressed_audit_log(spark, sf_dir)))
    return lateness.classify_groups(rows, SHORT_WINDOW_MS)


_FIRINGS_SQL = f"WITH {o.COMPRESSED}, {o.ledger_rows('src', SHORT_WINDOW_MS)} {o.FIRED}"


@register("report_firings", f"""{_FIRINGS_SQL}
SELECT window_start_ms, type, area, fire_batch, count, {o.fmt('cmx')} AS time FROM firings""")
def report_firings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every window firing (on close and on each refinement within lateness)."""
    return lateness.firings(_compressed_groups(spark, sf_dir))


@register("report_final", f"""{_FIRINGS_SQL}
SELECT CAST(ws AS BIGINT) AS window_start_ms, type, area, count(*) AS count, {o.fmt('max(time_ms)')} AS time
FROM fired GROUP BY ws, type, area""")
def report_final(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Last firing per window and key."""
    return lateness.final_report(_compressed_groups(spark, sf_dir))


@register("report_documents", f"""{_FIRINGS_SQL},
f2 AS (SELECT *, {o.fmt('cmx')} AS time FROM firings)
SELECT replace(time, ' ', '_') || '-' || type || '-' || area AS doc_id, time, type, area,
       arg_max(count, fire_batch) AS count
FROM f2 GROUP BY time, type, area""")
def report_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents after keyed upserts of all firings (last write per id wins)."""
    return lateness.firing_documents(lateness.firings(_compressed_groups(spark, sf_dir)))


_INPUT_FIRINGS = f"WITH {o.MULTI_INPUT}, {o.input_ledger_rows('src', SHORT_WINDOW_MS, lateness.IDLE_BATCHES)} {o.FIRED}"


def _multi_input_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit_ops.accepted(audit_ops.parse_audit(fx.multi_input_audit_log(spark, sf_dir)))


@register("report_multi_source", f"""{_INPUT_FIRINGS}
SELECT window_start_ms, type, area, fire_batch, count, {o.fmt('cmx')} AS time FROM firings""")
def report_multi_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every window firing under the least watermark of three inputs, one of them silent at times."""
    return lateness.firings(lateness.classify_groups(_multi_input_rows(spark, sf_dir), SHORT_WINDOW_MS, input_col="input"))


@register("late_multi_source", f"""WITH {o.MULTI_INPUT}, {o.input_ledger_rows('src', SHORT_WINDOW_MS, lateness.IDLE_BATCHES)}
SELECT key, batch_id, time_ms, type, area FROM cls WHERE is_late""")
def late_multi_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows too late for the least watermark of three inputs."""
    return lateness.late_rows(lateness.classify(_multi_input_rows(spark, sf_dir), SHORT_WINDOW_MS, input_col="input")).select(
        "key", "batch_id", "time_ms", "type", "area")


# ------------------------------------------------------------ sinks, quality

@register("store_by_type", f"""
WITH {o.ITEMS} SELECT i.type, i.key, i.item_pos, i.dt, i.score, i.level, {o.AREA_OF_REGION} AS area
FROM items i JOIN region r ON i.n_regionkey = r.r_regionkey""")
def store_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean records stored in one folder per type; each type read back from its own folder."""
    recs = clean_ops.clean_records(fx.raw_log(spark, sf_dir), _mapping(spark, sf_dir))
    path = new_work_dir(spark, "store-by-type")
    write_by_type(recs, path)
    types = [r[0] for r in spark.read.parquet(path).select("type", TYPE_FOLDER).groupBy(TYPE_FOLDER).agg(
        F.first("type")).select("first(type)").collect()]  # one row per type
    parts = [_reread(read_by_type(spark, path, t)) for t in types]
    out = parts[0] if parts else _reread(spark.read.parquet(path))
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select("type", "key", "item_pos", "dt", "score", "level", "area")


@register("quality_counts", f"""
WITH {o.DIRTY_ITEMS}, {o.DIRTY_AUDIT}, {o.VERSIONS}
SELECT 'messages_' || coalesce(f.reason, 'ok') AS metric, count(*) AS value
FROM messages m LEFT JOIN faults f USING (dirty_case) GROUP BY 1
UNION ALL SELECT 'items', count(*) FROM good_items
UNION ALL SELECT 'unmapped_items', count(*) FROM good_items WHERE n_regionkey = 4
UNION ALL SELECT 'unmapped_countries', count(DISTINCT country_code) FROM good_items WHERE n_regionkey = 4
UNION ALL SELECT 'rejected_' || reason, count(*) FROM rejected GROUP BY 1
UNION ALL SELECT 'empty_snapshots', count(*) FROM (VALUES (0), (2), (3), (4), (6)) s(version)
          WHERE version NOT IN (SELECT version FROM published)""")
def quality_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Data-quality counters as (metric, value) rows: quarantine reasons, items,
    unmapped items and countries, audit rejects, empty mapping snapshots.

    One pass over the messages: a message has one country, so counts per reason
    and country hold everything; the mapping meets those few rows.
    """
    parsed = clean_ops.parse_messages(fx.raw_log(spark, sf_dir, dirty=True))
    items = F.when(F.col("reason").isNull(), F.size("_rec.data")).otherwise(0)
    per = parsed.groupBy(F.coalesce("reason", F.lit("ok")).alias("reason"), F.col("_rec.countryCode").alias("country_code")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(items.cast("long")).alias("items"))
    per = area_ops.enrich_area(per, _mapping(spark, sf_dir, drop_region=4))
    unmapped = F.col("area").isNull()
    pair = lambda m, v: F.struct(m.alias("metric"), v.cast("long").alias("value"))
    counted = per.select(F.explode(F.array(
        pair(F.concat(F.lit("messages_"), F.col("reason")), F.col("n")),
        pair(F.lit("items"), F.col("items")),
        pair(F.lit("unmapped_items"), F.when(unmapped, F.col("items")).otherwise(0)),
        pair(F.lit("unmapped_countries"), (unmapped & (F.col("items") > 0)).cast("int")))).alias("x")).select("x.*")
    msgs = counted.groupBy("metric").agg(F.sum("value").alias("value"))
    rej = audit_ops.rejects(_dirty_audit(spark, sf_dir)).groupBy(
        F.concat(F.lit("rejected_"), F.col("reason")).alias("metric")).agg(F.count(F.lit(1)).alias("value"))
    empty = empty_snapshots(fx.mapping_versions(spark, sf_dir)).agg(F.count(F.lit(1)).alias("value")).select(
        F.lit("empty_snapshots").alias("metric"), "value")
    return msgs.unionByName(rej).unionByName(empty)


# ------------------------------------------------------------ streaming jobs

_REPLAYS: dict[tuple, str] = {}


def _replayed(spark: SparkSession, sf_dir: str, name: str, build) -> str:
    """Run a stream replay once per session and input folder; return its output folder.

    The folder's tables are taken not to change while the session lasts.
    """
    key = (session_id(spark), sf_dir, name)
    if key not in _REPLAYS:
        _REPLAYS[key] = build()
    return _REPLAYS[key]


def _clean_stream_out(spark: SparkSession, sf_dir: str) -> str:
    def build() -> str:
        work = new_work_dir(spark, "clean-stream", keep=True)
        dim = f"{work}/dimension"
        fx.mapping_versions(spark, sf_dir).write.mode("overwrite").parquet(dim)
        provider = snapshot_table_provider(dim)
        return replay(spark, fx.raw_log(spark, sf_dir), work,
                      lambda src, out, ckpt, trig: jobs.clean_job(src, provider, out, ckpt, trig))

    return _replayed(spark, sf_dir, "clean", build)


def _live_stream_out(spark: SparkSession, sf_dir: str) -> str:
    def build() -> str:
        work = new_work_dir(spark, "live-stream", keep=True)
        polled = f"{work}/snapshots"
        versions = fx.mapping_versions(spark, sf_dir)

        def publish(batch: int) -> None:
            """What keeps the dimension: a new snapshot now and then, which may be empty."""
            if batch in fx.VERSION_BATCHES:
                versions.where((F.col("version") == batch) & F.col("area").isNotNull()).select(
                    "area", "countries").write.mode("overwrite").parquet(f"{polled}/version={batch}")

        return replay(spark, fx.raw_log(spark, sf_dir), work, lambda src, out, ckpt, trig: jobs.connected_clean_job(
            src, read_snapshots(spark, polled), out, ckpt, trig), before=publish)

    return _replayed(spark, sf_dir, "live", build)


_COUNTERS: dict[str, Counters] = {}


def _file_stream_out(spark: SparkSession, sf_dir: str) -> str:
    """Replay of the clean job through the file sink; each start of the query takes the mapping then in force."""

    def build() -> str:
        work = new_work_dir(spark, "file-stream", keep=True)
        versions = checkpointed(fx.mapping_versions(spark, sf_dir), "mapping-versions")
        counters = Counters("clean_files")
        starts = iter(range(1 << 30))

        def job(src, out, ckpt, trig):
            q = jobs.clean_file_job(src, area_ops.latest_nonempty_version(versions, next(starts)), out, ckpt, trig)
            q.awaitTermination()
            counters.wait(q.runId)
            return q

        spark.streams.addListener(counters)
        try:
            out = replay(spark, fx.raw_log(spark, sf_dir), work, job)
        finally:
            spark.streams.removeListener(counters)
        _COUNTERS[out] = counters
        return out

    return _replayed(spark, sf_dir, "files", build)


def _report_stream_out(spark: SparkSession, sf_dir: str) -> str:
    def build() -> str:
        work = new_work_dir(spark, "report-stream", keep=True)
        return replay(spark, fx.stream_audit_log(spark, sf_dir).drop("event_id"), work,
                      lambda src, out, ckpt, trig: jobs.report_job(src, out, ckpt, REPORT_WINDOW_MS, trig))

    return _replayed(spark, sf_dir, "report", build)


_STREAM_ITEMS = f"""
WITH {o.ITEMS}, {o.VERSIONS}
SELECT i.key, i.item_pos, i.batch_id, i.country_code, v.area, i.type, i.dt, i.score, i.level
FROM items i JOIN inforce f ON i.batch_id = f.batch_id
LEFT JOIN vmap v ON v.version = f.version AND v.country_code = i.country_code"""


def _stream_records(spark: SparkSession, out: str) -> DataFrame:
    """What the clean job wrote: all fields but the country read back from the JSON record."""
    return _fields(read_output(spark, out, "clean"), "key", "item_pos", F.col("batch_id").cast("int").alias("batch_id"), "country_code")


def _fields(rows: DataFrame, *columns) -> DataFrame:
    back = F.col("_back")
    read = computed_once(rows, _back=F.from_json("record", "type string, score double, level string, area string, dt string"))
    return read.select(*columns, back["area"].alias("area"), back["type"].alias("type"), back["dt"].alias("dt"),
                       back["score"].alias("score"), back["level"].alias("level"))


@register("stream_clean", _STREAM_ITEMS)
def stream_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean job as a stream: one micro-batch per order year, mapping re-read per batch."""
    return _stream_records(spark, _clean_stream_out(spark, sf_dir))


@register("stream_clean_live", _STREAM_ITEMS)
def stream_clean_live(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with the mapping as a second stream, polled from snapshots that are empty at times."""
    return _stream_records(spark, _live_stream_out(spark, sf_dir))


@register("stream_clean_files", f"""
WITH {o.ITEMS}, {o.VERSIONS}
SELECT i.key, i.item_pos, i.country_code, v.area, i.type, i.dt, i.score, i.level
FROM items i JOIN inforce f ON i.batch_id = f.batch_id
LEFT JOIN vmap v ON v.version = f.version AND v.country_code = i.country_code""")
def stream_clean_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean job through Spark's file sink, restarted once per order year; files of whole batches only."""
    rows = spark.read.parquet(_file_stream_out(spark, sf_dir))
    return _fields(rows, "key", "item_pos", "country_code")


@register("stream_file_counters", f"""
WITH {o.ITEMS}, {o.VERSIONS},
mapped AS (SELECT i.batch_id, v.area FROM items i JOIN inforce f ON i.batch_id = f.batch_id
           LEFT JOIN vmap v ON v.version = f.version AND v.country_code = i.country_code)
SELECT CAST(batch_id AS BIGINT) AS batch_id, 'items' AS metric, count(*) AS value FROM mapped GROUP BY batch_id
UNION ALL SELECT batch_id, 'unmapped_items', count(*) FILTER (area IS NULL) FROM mapped GROUP BY batch_id""")
def stream_file_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counters of the running file job, as its listener received them: one row per batch and counter."""
    rows = _COUNTERS[_file_stream_out(spark, sf_dir)].rows()
    return spark.createDataFrame([r[1:] for r in rows], "batch_id long, metric string, value long")


_STREAM_FIRINGS = f"WITH {o.STREAM_AUDIT}, {o.ledger_rows('src', REPORT_WINDOW_MS)} {o.FIRED}"


@register("stream_report", f"""{_STREAM_FIRINGS}
SELECT window_start_ms, type, area, fire_batch, count, {o.fmt('cmx')} AS time FROM firings""")
def stream_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Report job as a stream: every firing written by the micro-batches."""
    out = _report_stream_out(spark, sf_dir)
    return read_output(spark, out, "firings").select(
        "window_start_ms", "type", "area", "fire_batch", "count", "time")


@register("stream_late", f"""WITH {o.STREAM_AUDIT}, {o.ledger_rows('src', REPORT_WINDOW_MS)}
SELECT key, batch_id, CAST(time_ms AS VARCHAR) || chr(9) || type || chr(9) || area AS line FROM cls WHERE is_late""")
def stream_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Late side output of the streaming report job."""
    out = _report_stream_out(spark, sf_dir)
    return read_output(spark, out, "late").select("key", F.col("batch_id").cast("long").alias("batch_id"), "line")


@register("stream_documents", f"""{_STREAM_FIRINGS},
f2 AS (SELECT *, {o.fmt('cmx')} AS time FROM firings)
SELECT replace(time, ' ', '_') || '-' || type || '-' || area AS doc_id, time, type, area,
       arg_max(count, fire_batch) AS count
FROM f2 GROUP BY time, type, area""")
def stream_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Search documents after the stream's keyed upserts (last write per id), as of the last whole batch."""
    out = _report_stream_out(spark, sf_dir)
    return read_latest(spark, out, "documents").select("doc_id", "time", "type", "area", "count")


@register("stream_report_append", f"""WITH {o.STREAM_AUDIT}, {o.ledger_rows('src', REPORT_WINDOW_MS)},
shut AS (SELECT * FROM cls WHERE we > wm_before AND we <= (SELECT max(wm_after) FROM led))
{o.report(REPORT_WINDOW_MS, 'shut')}""")
def stream_report_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Closed windows by the built-in watermark in append mode: each once, without rows that came after its close."""
    def build() -> str:
        work = new_work_dir(spark, "append-stream", keep=True)
        return replay(spark, fx.stream_audit_log(spark, sf_dir).drop("event_id"), work,
                      lambda src, out, ckpt, trig: jobs.append_report_job(src, out, ckpt, REPORT_WINDOW_MS, trig))

    return spark.read.parquet(_replayed(spark, sf_dir, "append", build))


@register("stream_metrics", f"""
WITH {o.ITEMS}, {o.VERSIONS}, {o.STREAM_AUDIT}, {o.ledger_rows('src', REPORT_WINDOW_MS)} {o.FIRED},
mapped AS (SELECT i.batch_id, v.area FROM items i JOIN inforce f ON i.batch_id = f.batch_id
           LEFT JOIN vmap v ON v.version = f.version AND v.country_code = i.country_code)
SELECT 'clean' AS job, CAST(batch_id AS BIGINT) AS batch_id, 'items' AS metric, count(*) AS value FROM mapped GROUP BY ALL
UNION ALL SELECT 'clean', batch_id, 'unmapped_items', count(*) FILTER (area IS NULL) FROM mapped GROUP BY batch_id
UNION ALL SELECT 'clean', batch_id, 'quarantined', 0 FROM mapped GROUP BY batch_id
UNION ALL SELECT 'report', batch_id, 'messages', count(*) FROM src GROUP BY batch_id
UNION ALL SELECT 'report', batch_id, 'rejected', 0 FROM src GROUP BY batch_id
UNION ALL SELECT 'report', batch_id, 'late', count(*) FILTER (is_late) FROM cls GROUP BY batch_id
UNION ALL SELECT 'report', b.batch_id, 'fired_windows', count(f.fire_batch)
          FROM (SELECT DISTINCT batch_id FROM src) b LEFT JOIN firings f ON f.fire_batch = b.batch_id GROUP BY b.batch_id""")
def stream_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Progress counters of both streaming jobs, one row per batch and counter."""
    clean = read_output(spark, _clean_stream_out(spark, sf_dir), "metrics")
    report = read_output(spark, _report_stream_out(spark, sf_dir), "metrics")

    def long_form(df: DataFrame, job: str, names: list[str]) -> DataFrame:
        return df.unpivot("batch_id", names, "metric", "value").select(
            F.lit(job).alias("job"), F.col("batch_id").cast("long").alias("batch_id"), "metric", "value")

    return long_form(clean, "clean", ["items", "unmapped_items", "quarantined"]).unionByName(
        long_form(report, "report", ["messages", "rejected", "late", "fired_windows"]))
