"""Distributed ordered scans: prefix max and as-of lookup.

Both split the order axis into chunks. Work inside a chunk is a window
partitioned by the chunk (bounded by the chunk width); across chunks only one
summary row per chunk is scanned, so no step sees all rows in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Batch ids per chunk for prefix scans over a batch ledger.
LEDGER_CHUNK = 65_536
# Width of an as-of chunk on a millisecond axis: one hour.
TIME_CHUNK_MS = 3_600_000


def prefix_max(df: DataFrame, order_col: str, value_col: str, *, inclusive_col: str,
               exclusive_col: str, chunk: int = LEDGER_CHUNK, by: tuple[str, ...] = ()) -> DataFrame:
    """Add running max of ``value_col`` over rows ordered by ``order_col``, within each value of ``by``.

    ``inclusive_col`` covers rows <= the current one, ``exclusive_col`` rows
    strictly before it (NULL for the first). ``order_col`` must be unique (with ``by``).
    """
    d = df.withColumn("_chunk", F.floor(F.col(order_col) / F.lit(chunk)).cast("long"))
    per_chunk = d.groupBy(*by, "_chunk").agg(F.max(value_col).alias("_chunk_max"))
    before = Window.partitionBy(*by).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    carry = per_chunk.select(*by, "_chunk", F.max("_chunk_max").over(before).alias("_carry"))
    within = Window.partitionBy(*by, "_chunk").orderBy(order_col)
    out = d.join(carry, [*by, "_chunk"]).select(
        *df.columns,
        F.greatest(F.max(value_col).over(within.rowsBetween(Window.unboundedPreceding, 0)),
                   F.col("_carry")).alias(inclusive_col),
        F.greatest(F.max(value_col).over(within.rowsBetween(Window.unboundedPreceding, -1)),
                   F.col("_carry")).alias(exclusive_col),
    )
    return out


def asof_lookup(points: DataFrame, point_col: str, events: DataFrame, event_col: str,
                value_col: str, out_col: str, *, forward: bool,
                chunk: int = TIME_CHUNK_MS) -> DataFrame:
    """For each distinct point p, the value of the nearest event on the key axis.

    forward=True: nearest event with key >= p (events sharing a key keep the
    min value); forward=False: nearest event with key <= p (max value).
    Returns (point_col, out_col); out_col is NULL when there is no such event.
    """
    vtype = events.schema[value_col].dataType
    pick = F.min if forward else F.max
    ev = events.groupBy(F.col(event_col).alias("_t")).agg(pick(value_col).alias("_v"))
    pts = points.select(F.col(point_col).alias("_t")).distinct()
    both = (
        pts.select("_t", F.lit(0).alias("_k"), F.lit(None).cast(vtype).alias("_v"))
        .unionByName(ev.select("_t", F.lit(1).alias("_k"), "_v"))
        .withColumn("_c", F.floor(F.col("_t") / F.lit(chunk)).cast("long"))
    )
    # Scan toward the side where the wanted event lies; at an equal key the
    # event is ordered first so that it counts (>= / <=).
    t_order = F.col("_t").desc() if forward else F.col("_t").asc()
    within = (Window.partitionBy("_c").orderBy(t_order, F.col("_k").desc())
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    near = both.withColumn("_near", F.last("_v", ignorenulls=True).over(within)).where("_k = 0")

    edge_pick = F.min_by if forward else F.max_by
    edges = ev.groupBy(F.floor(F.col("_t") / F.lit(chunk)).cast("long").alias("_c")).agg(
        edge_pick("_v", "_t").alias("_edge"))
    chunks = both.select("_c").distinct().join(edges, "_c", "left")
    c_order = F.col("_c").desc() if forward else F.col("_c").asc()
    beyond = Window.orderBy(c_order).rowsBetween(Window.unboundedPreceding, -1)
    carry = chunks.select("_c", F.last("_edge", ignorenulls=True).over(beyond).alias("_carry"))
    return near.join(carry, "_c").select(
        F.col("_t").alias(point_col), F.coalesce("_near", "_carry").alias(out_col))
