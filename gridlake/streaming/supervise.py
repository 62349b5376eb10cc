"""Several streaming queries as one job: any of them ending ends it, with its error."""

from __future__ import annotations

import contextlib
from collections.abc import Callable, Sequence

from pyspark.errors import StreamingQueryException
from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

POLL_SECONDS = 1.0


class Progress(StreamingQueryListener):
    """Hands every finished micro-batch to ``tell``: query, batch_id, rows, rows_per_second and
    lag_ms (from the trigger to the end of the batch); and every end: query, error (or None)."""

    def __init__(self, tell: Callable[[dict], None]):
        self.tell = tell
        self.names: dict[str, str] = {}

    def onQueryStarted(self, event):
        self.names[str(event.id)] = event.name

    def onQueryProgress(self, event):
        p = event.progress
        self.tell({
            "query": p.name, "batch_id": p.batchId, "rows": p.numInputRows, "rows_per_second": p.processedRowsPerSecond,
            "lag_ms": dict(p.durationMs).get("triggerExecution"),
        })

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        self.tell({"query": self.names.get(str(event.id)), "error": event.exception})


def run_together(
    spark: SparkSession, queries: Sequence[StreamingQuery], timeout: float | None = None, to_the_end: bool = False
) -> None:
    """Wait until one of the queries ends (or ``timeout`` seconds), stop the others, and raise the
    error if it had one. ``to_the_end``: queries over what is there now (``availableNow``) end well
    at different times; only an error stops the others."""
    waited = 0.0
    while timeout is None or waited < timeout:
        active = [q for q in queries if q.isActive]
        failed = any(q.exception() is not None for q in queries)
        if failed or not active or (len(active) < len(queries) and not to_the_end):
            break
        with contextlib.suppress(StreamingQueryException):  # it is raised below, with the query's name
            active[0].awaitTermination(POLL_SECONDS)
        waited += POLL_SECONDS
    for q in queries:
        if q.isActive:
            q.stop()
    for q in queries:
        if q.exception() is not None:
            raise RuntimeError(f"stream {q.name} failed: {q.exception()}") from q.exception()
