"""Arrow batches cut to blocks by their bytes of text, so that scratch memory doesn't follow row counts."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

from logtide.llm import bytes_np

#: Bytes of text in a block; a longer text is a block of its own.
BLOCK_BYTES = 4 << 20


def byte_blocks(batch: pa.RecordBatch, column: str = "text", most: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batch with at most ``most`` bytes of text each (one row at least)."""
    text = batch.column(column)
    width = np.int64 if pa.types.is_large_string(text.type) else np.int32
    n = batch.num_rows
    if not n:
        return
    ends = np.frombuffer(text.buffers()[1], width)[text.offset:text.offset + n + 1].astype(np.int64)
    at = 0
    while at < n:
        upto = max(at + 1, int(np.searchsorted(ends, ends[at] + most, "right")) - 1)
        yield batch.slice(at, upto - at)
        at = upto


def give_back() -> None:
    """At the end of a task, unused memory goes back to the system: a worker waits for its next task with what it needs only."""
    bytes_np._powers.cache_clear()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # not the C library of GNU
        return


def giving_back(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """The task function ``run`` (batches to batches), with ``give_back`` at its end, also when it fails."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            give_back()

    return task
