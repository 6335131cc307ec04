"""Watermark ledger, late-row split and window firings (replay of a stream).

Rows carry the micro-batch they arrived in (``batch_id``). The watermark
moves only between batches:

    wm_after(b)  = max(0, max event time over batches <= b) - out_of_orderness
    wm_before(b) = wm_after of the previous batch (-out_of_orderness at start)

A window [start, end) first fires in the first batch whose wm_after reaches
end - 1 ms. A row is late when its window's end - 1 ms + lateness is already
reached by wm_before of its batch; lateness is per window, not per row. A row
that arrives after its window fired (within lateness) fires the window again
with the full cumulative contents.

With several inputs (``input_col``) each has its own highest event time, 0 before its first
row, and the watermark is the least of them. An input without rows for more than
``idle_batches`` batches is idle and doesn't count until it has rows again, so that a silent
input can't hold the others up for ever. The watermark never goes back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from logtide.functions.text import doc_id, late_line
from logtide.functions.timefmt import format_time_ms
from logtide.operators.joins import join_dimension
from logtide.operators.report import window_start_ms
from logtide.operators.scans import asof_lookup, prefix_max
from logtide.schemas import ALLOWED_LATENESS_MS, OUT_OF_ORDERNESS_MS
from logtide.session import checkpointed

# Batches without a row after which an input no longer holds the watermark back.
IDLE_BATCHES = 3


def with_window(rows: DataFrame, size_ms: int) -> DataFrame:
    ws = window_start_ms(F.col("time_ms"), size_ms)
    return rows.withColumn("window_start_ms", ws).withColumn("window_end_ms", ws + F.lit(size_ms))


def _least_of_inputs(rows: DataFrame, batch_col: str, input_col: str, idle_batches: int) -> DataFrame:
    """(batch, mx): for each batch with rows, the least of the inputs' highest times so far, without idle inputs.

    A row (input, batch) counts for the batches up to ``idle_batches`` after it; of the rows of an input that
    count for a batch the last has the highest running maximum. One row for each input and batch at most.
    """
    cells = rows.groupBy(input_col, batch_col).agg(F.max("time_ms").alias("time_ms"))
    start = cells.agg((F.min(batch_col) - 1).alias(batch_col)).scalar()  # the batch before the first
    unseen = cells.select(input_col).distinct().select(input_col, start.alias(batch_col), F.lit(0).cast("bigint").alias("time_ms"))
    cells = cells.unionByName(unseen)
    run = prefix_max(cells, batch_col, "time_ms", inclusive_col="high", exclusive_col="_before", by=(input_col,))
    counts = run.select(input_col, F.explode(F.sequence(F.col(batch_col), F.col(batch_col) + idle_batches)).alias(batch_col), "high")
    counts = counts.groupBy(input_col, batch_col).agg(F.max("high").alias("high"))
    least = counts.groupBy(batch_col).agg(F.min("high").alias("mx"))
    return least.join(rows.select(batch_col).distinct(), batch_col, "left_semi")


def ledger(rows: DataFrame, batch_col: str = "batch_id", out_of_orderness_ms: int = OUT_OF_ORDERNESS_MS,
           input_col: str | None = None, idle_batches: int = IDLE_BATCHES) -> DataFrame:
    """One row per batch: (batch_id, mx, wm_before, wm_after); mx: highest time, of several inputs the least one."""
    if input_col is None:
        per_batch = rows.groupBy(batch_col).agg(F.max("time_ms").alias("mx"))
    else:
        per_batch = _least_of_inputs(rows, batch_col, input_col, idle_batches)
    run = prefix_max(per_batch, batch_col, "mx", inclusive_col="_upto", exclusive_col="_before")
    zero = F.lit(0).cast("bigint")
    return run.select(
        batch_col, "mx",
        (F.greatest(F.col("_before"), zero) - F.lit(out_of_orderness_ms)).alias("wm_before"),
        (F.greatest(F.col("_upto"), zero) - F.lit(out_of_orderness_ms)).alias("wm_after"),
    )


def window_schedule(cells: DataFrame, led: DataFrame, batch_col: str = "batch_id",
                    lateness_ms: int = ALLOWED_LATENESS_MS) -> DataFrame:
    """Per distinct window end: the batch that first fires it and the batch
    after which its rows are late (NULL = not reached yet).

    Both thresholds of a window go through one as-of lookup and come back
    with one join and a pivot, so the lookup runs once.
    """
    end1 = F.col("window_end_ms") - F.lit(1)
    points = cells.select("window_end_ms").distinct().select(
        "window_end_ms",
        F.explode(F.array(
            F.struct(F.lit(0).alias("kind"), end1.alias("x")),
            F.struct(F.lit(1).alias("kind"), (end1 + F.lit(lateness_ms)).alias("x")),
        )).alias("p")).select("window_end_ms", "p.kind", "p.x")
    hit = asof_lookup(points, "x", led, "wm_after", batch_col, "b", forward=True)
    return points.join(hit, "x", "left").groupBy("window_end_ms").agg(
        F.max(F.when(F.col("kind") == 0, F.col("b"))).alias("close_batch"),
        F.max(F.when(F.col("kind") == 1, F.col("b"))).alias("late_batch"),
    )


def _stored_schedule(cells: DataFrame, batch_col: str, out_of_orderness_ms: int, lateness_ms: int,
                     input_col: str | None, idle_batches: int) -> DataFrame:
    """Ledger (one row per batch) and window schedule (one row per window), each stored once."""
    led = checkpointed(ledger(cells, batch_col, out_of_orderness_ms, input_col, idle_batches), "ledger")
    return checkpointed(window_schedule(cells, led, batch_col, lateness_ms), "window-schedule")


def _late_flag(batch_col: str, out_of_orderness_ms: int, lateness_ms: int):
    before_start = (F.col("window_end_ms") - F.lit(1) + F.lit(lateness_ms)) <= F.lit(-out_of_orderness_ms)
    return before_start | (F.col("late_batch").isNotNull() & (F.col(batch_col) > F.col("late_batch")))


def classify(rows: DataFrame, size_ms: int, batch_col: str = "batch_id",
             out_of_orderness_ms: int = OUT_OF_ORDERNESS_MS, lateness_ms: int = ALLOWED_LATENESS_MS,
             input_col: str | None = None, idle_batches: int = IDLE_BATCHES) -> DataFrame:
    """Accepted audit rows -> rows with window bounds, close/late batches and ``is_late``.

    Two passes over the rows: one aggregation to (batch, window end) -> max
    time, which is small and stored in the shared folder, and one broadcast
    join of the rows with the per-window schedule derived from it. The rows
    themselves are never shuffled. The ledger (one row per batch) and the
    schedule (one row per window) are stored too, so each is computed once.
    """
    windowed = with_window(rows, size_ms)
    by = [batch_col] if input_col is None else [batch_col, input_col]
    cells = checkpointed(windowed.groupBy(*by, "window_end_ms").agg(F.max("time_ms").alias("time_ms")),
                         "ledger-cells")
    sched = _stored_schedule(cells, batch_col, out_of_orderness_ms, lateness_ms, input_col, idle_batches)
    return join_dimension(windowed, sched, "window_end_ms", "inner").withColumn(
        "is_late", _late_flag(batch_col, out_of_orderness_ms, lateness_ms))


def classify_groups(rows: DataFrame, size_ms: int, batch_col: str = "batch_id",
                    keys: tuple[str, ...] = ("type", "area"),
                    out_of_orderness_ms: int = OUT_OF_ORDERNESS_MS, lateness_ms: int = ALLOWED_LATENESS_MS,
                    input_col: str | None = None, idle_batches: int = IDLE_BATCHES) -> DataFrame:
    """Like ``classify`` but per (batch, window, key) group instead of per row.

    Lateness and firing depend only on (batch, window), so counts per group
    are enough for firings, finals, documents and the accepted report. One
    pass over the rows (combined map-side) builds the stored group table;
    everything after it reads that table, never the rows again.
    """
    windowed = with_window(rows, size_ms)
    by = [batch_col] if input_col is None else [batch_col, input_col]
    groups = checkpointed(windowed.groupBy(*by, "window_start_ms", "window_end_ms", *keys).agg(
        F.count(F.lit(1)).alias("n"), F.max("time_ms").alias("mx")), "ledger-groups")
    cells = groups.groupBy(*by, "window_end_ms").agg(F.max("mx").alias("time_ms"))
    sched = _stored_schedule(cells, batch_col, out_of_orderness_ms, lateness_ms, input_col, idle_batches)
    return join_dimension(groups, sched, "window_end_ms", "inner").withColumn(
        "is_late", _late_flag(batch_col, out_of_orderness_ms, lateness_ms))


def _as_groups(classified: DataFrame) -> DataFrame:
    """Row-level input counts as groups of one."""
    if "n" in classified.columns:
        return classified
    return classified.withColumn("n", F.lit(1).cast("long")).withColumn("mx", F.col("time_ms"))


def late_rows(classified: DataFrame, batch_col: str = "batch_id") -> DataFrame:
    """Side output: rows too late for their window, with their text line."""
    keep = [c for c in ("key", batch_col) if c in classified.columns]
    return classified.where("is_late").select(
        *keep, "time_ms", "type", "area",
        late_line(F.col("time_ms"), F.col("type"), F.col("area")).alias("line"))


def on_time(classified: DataFrame) -> DataFrame:
    return classified.where(~F.col("is_late"))


def _fired(classified: DataFrame, batch_col: str) -> DataFrame:
    return on_time(_as_groups(classified)).where(F.col("close_batch").isNotNull()).withColumn(
        "fire_batch", F.greatest(F.col(batch_col), F.col("close_batch")))


def firings(classified: DataFrame, batch_col: str = "batch_id") -> DataFrame:
    """One row per window firing: cumulative count and latest time so far.

    Rows are first combined per (window, key, firing batch), so the running
    window below sees one row per firing, not one per event.
    """
    keys = ["window_start_ms", "type", "area"]
    per = _fired(classified, batch_col).groupBy(*keys, "fire_batch").agg(
        F.sum("n").alias("n"), F.max("mx").alias("mx"))
    run = Window.partitionBy(*keys).orderBy("fire_batch").rowsBetween(Window.unboundedPreceding, 0)
    return per.select(
        *keys, "fire_batch",
        F.sum("n").over(run).cast("long").alias("count"),
        format_time_ms(F.max("mx").over(run)).alias("time"),
    )


def final_report(classified: DataFrame, batch_col: str = "batch_id") -> DataFrame:
    """Last firing of every fired (window, key); open windows emit nothing."""
    keys = ["window_start_ms", "type", "area"]
    return _fired(classified, batch_col).groupBy(*keys).agg(
        F.sum("n").cast("long").alias("count"), format_time_ms(F.max("mx")).alias("time"))


def firing_documents(fired: DataFrame) -> DataFrame:
    """Keyed upsert of firings into documents: the last write per id wins.

    The id holds the latest event time, so a refinement that raises it makes
    a new document and leaves the old one.
    """
    docs = fired.withColumn("doc_id", doc_id(F.col("time"), F.col("type"), F.col("area")))
    return docs.groupBy("doc_id", "time", "type", "area").agg(
        F.max_by("count", "fire_batch").alias("count"))


def accepted_report(classified: DataFrame) -> DataFrame:
    """Tumbling report over the rows that were not late (from rows or groups)."""
    keys = ["window_start_ms", "type", "area"]
    return on_time(_as_groups(classified)).groupBy(*keys).agg(
        F.sum("n").cast("long").alias("count"), format_time_ms(F.max("mx")).alias("time"))
