"""Progress counters of running queries, received by a listener."""

from __future__ import annotations

import threading

from pyspark.sql.streaming import StreamingQueryListener


class Counters(StreamingQueryListener):
    """Collects the observed metrics of every batch: ``rows`` gives (observation, batch_id, metric, value).

    A batch that is run again after a restart counts once, as it was last seen. ``observations``: the names
    to collect, of one query each; all where none is given.
    """

    def __init__(self, *observations: str):
        self._wanted = set(observations)
        self._seen: dict[tuple, int] = {}
        self._ended: set[str] = set()
        self._change = threading.Condition()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        with self._change:
            for name, row in p.observedMetrics.items():
                if not self._wanted or name in self._wanted:
                    for metric, value in row.asDict().items():
                        self._seen[name, p.batchId, metric] = int(value or 0)

    def onQueryTerminated(self, event) -> None:
        with self._change:
            self._ended.add(str(event.runId))
            self._change.notify_all()

    def wait(self, run_id: str, seconds: float = 60.0) -> None:
        """Until all events of the run have come: they are delivered in order, its end last."""
        with self._change:
            if not self._change.wait_for(lambda: str(run_id) in self._ended, seconds):
                raise TimeoutError(f"no end of query run {run_id} within {seconds} s")

    def rows(self) -> list[tuple[str, int, str, int]]:
        with self._change:
            return sorted((*k, v) for k, v in self._seen.items())
