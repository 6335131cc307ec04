"""Dimension joins that broadcast only a side whose size was checked."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Size up to which the optimiser's own estimate is enough to broadcast.
MAX_BROADCAST_BYTES = 64 << 20
# Where the estimate is larger or unknown, rows are counted. A dimension row is small (a code
# and a name): 2M rows take a few hundred MB of executor memory at most.
MAX_BROADCAST_ROWS = 2_000_000


def estimated_bytes(df: DataFrame) -> int:
    """Size by the statistics of the optimised plan (no job)."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def fits_broadcast(dim: DataFrame, max_rows: int = MAX_BROADCAST_ROWS, max_bytes: int = MAX_BROADCAST_BYTES) -> bool:
    """By estimated bytes, else by counting at most ``max_rows + 1`` rows (a bounded action)."""
    return estimated_bytes(dim) <= max_bytes or dim.limit(max_rows + 1).count() <= max_rows


def join_dimension(fact: DataFrame, dim: DataFrame, on, how: str = "left",
                   max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Many-to-one join of a fact table with a dimension.

    Broadcast (no shuffle of the fact side) when the dimension is small by
    estimate or has at most ``max_rows`` rows; otherwise a plain shuffle join
    that AQE may still re-plan at run time.
    """
    side = F.broadcast(dim) if fits_broadcast(dim, max_rows) else dim
    return fact.join(side, on, how)
