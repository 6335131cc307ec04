"""Replay a table of messages through a streaming job, one micro-batch per batch id.

Messages are kept once, partitioned by batch id; each batch is then appended
to a staged-file source and the query runs with ``availableNow`` from the same
checkpoint, so every run is one micro-batch and every run after the first is a
restart from the checkpoint.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from logtide.sources.topics import read_staged, stage

JobFactory = Callable[[DataFrame, str, str, dict], StreamingQuery]


def replay(spark: SparkSession, messages: DataFrame, work: str, job: JobFactory,
           batch_col: str = "batch_id", before: Callable[[int], None] | None = None) -> str:
    """Run ``job`` over ``messages`` batch by batch; returns the output folder.

    Batch ids must be 0, 1, 2, ... without a gap, since they stand for the
    engine's own numbers of micro-batches. ``before`` is called ahead of each.
    """
    held = f"{work}/held"
    messages.select("key", "value", batch_col).write.mode("overwrite").partitionBy(batch_col).parquet(held)
    kept = spark.read.parquet(held)
    batch_ids = [r[0] for r in kept.select(batch_col).distinct().orderBy(batch_col).collect()]
    if batch_ids != list(range(len(batch_ids))):
        raise ValueError(f"batch ids must run from 0 without a gap, got {batch_ids[:10]}")
    src, out, ckpt = f"{work}/src", f"{work}/out", f"{work}/checkpoint"
    for b in batch_ids:
        if before:
            before(b)
        stage(kept.where(F.col(batch_col) == b), src)
        q = job(read_staged(spark, src), out, ckpt, {"availableNow": True})
        q.awaitTermination()
        if q.exception() is not None:
            raise RuntimeError(str(q.exception()))
    return out
