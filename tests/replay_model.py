"""Record-by-record Python model of the report rules, used as a test oracle.

Batches are processed in order; rows of a batch all see the watermark as it
was before the batch, and the watermark moves at the end of the batch.
"""

from __future__ import annotations


def replay(rows, size_ms, ooo_ms=10_000, lateness_ms=30_000, inputs=None, idle=3):
    """rows: iterable of (batch, time_ms, key). Returns (late, firings).

    ``inputs``: the input of each row; the watermark is the least of theirs, without those that are idle.

    late: set of row indexes; firings: list of (window_start, key, batch, count, max_time).
    """
    rows = list(rows)
    inputs = inputs or [0] * len(rows)
    high = dict.fromkeys(inputs, 0)
    seen = dict.fromkeys(inputs, min((b for b, _, _ in rows), default=0) - 1)
    by_batch = {}
    for i, (b, t, k) in enumerate(rows):
        by_batch.setdefault(b, []).append((i, t, k))
    seen_max = 0
    wm = seen_max - ooo_ms
    state = {}
    late, firings = set(), []
    for b in sorted(by_batch):
        touched = set()
        for i, t, k in by_batch[b]:
            ws = t - (t % size_ms)
            end = ws + size_ms
            high[inputs[i]] = max(high[inputs[i]], t)
            seen[inputs[i]] = b
            if end - 1 + lateness_ms <= wm:
                late.add(i)
                continue
            st = state.setdefault((ws, k), [0, None])
            st[0] += 1
            st[1] = t if st[1] is None else max(st[1], t)
            touched.add((ws, k))
        seen_max = max(seen_max, min(high[i] for i in high if b - seen[i] <= idle))
        wm_new = seen_max - ooo_ms
        for (ws, k), (n, mx) in state.items():
            end = ws + size_ms
            if end - 1 <= wm_new and ((ws, k) in touched or end - 1 > wm):
                firings.append((ws, k, b, n, mx))
        wm = wm_new
    return late, firings
