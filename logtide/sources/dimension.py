"""Area-mapping dimension providers, asked once in every micro-batch.

* a table of snapshots (version, area, countries): the version is the batch at
  which a snapshot was taken;
* a live table (area, countries) that holds the current mapping only.

With both, an empty snapshot never replaces the mapping in force.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logtide.operators.area import invert_mapping, latest_nonempty_version
from logtide.streaming.sinks import commit, committed, expire_batch, read_batch, write_batch

Provider = Callable[[SparkSession, int], DataFrame]

# Mappings of earlier batches that the live provider keeps.
KEEP_MAPPINGS = 3


def snapshot_table_provider(path: str) -> Provider:
    """Provider reading the snapshot table at ``path`` on each call."""

    def provide(spark: SparkSession, batch_id: int) -> DataFrame:
        return latest_nonempty_version(spark.read.parquet(path), batch_id)

    return provide


def live_table_provider(path: str, state: str) -> Provider:
    """Provider reading the current mapping (area, countries) at ``path`` on each call.

    The mapping that a batch used is stored under ``state``; while the table is
    empty, the newest stored one stays in force, also after a restart. A batch
    that is run again uses the mapping of its first run.
    """

    def provide(spark: SparkSession, batch_id: int) -> DataFrame:
        last = committed(spark, state)
        if last is None or batch_id > last:
            now = invert_mapping(spark.read.parquet(path))
            if last is not None and now.isEmpty():
                now = read_batch(spark, state, last).drop("batch_id")
            write_batch(now, state, batch_id)
            commit(spark, state, batch_id)
            expire_batch(spark, state, batch_id - KEEP_MAPPINGS)
        return read_batch(spark, state, batch_id).drop("batch_id")

    return provide


def empty_snapshots(versions: DataFrame) -> DataFrame:
    """Versions that hold no country at all (kept out of force by the guard)."""
    inv = invert_mapping(versions, by=["version"]).select("version").distinct()
    return versions.select("version").distinct().join(inv, "version", "left_anti")
