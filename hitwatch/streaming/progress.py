"""Batch summaries from the progress of the alert query."""

from __future__ import annotations

import logging
from collections.abc import Callable

from pyspark.sql.streaming.listener import (
    QueryIdleEvent,
    QueryProgressEvent,
    QueryStartedEvent,
    QueryTerminatedEvent,
    StreamingQueryListener,
)

log = logging.getLogger("hitwatch")


class BatchLog(StreamingQueryListener):
    """Writes one line per batch with its totals, which the query observes while it
    computes the alerts, and one with the number of rows that came too late for the state
    they would have gone to; no job of its own is needed."""

    def __init__(self, write: Callable[[str], None] = log.info) -> None:
        self._write = write

    def onQueryStarted(self, event: QueryStartedEvent) -> None:
        pass

    def onQueryProgress(self, event: QueryProgressEvent) -> None:
        progress = event.progress
        seen = progress.observedMetrics.get("requests")
        if seen is not None and seen["total"]:
            self._write(
                f"batch {progress.batchId}: {seen['errors']} errors in {seen['total']} requests"
            )

        late = sum(
            state.numRowsDroppedByWatermark for state in getattr(progress, "stateOperators", None) or ()
        )
        if late:
            self._write(f"batch {progress.batchId}: {late} late rows dropped")

    def onQueryIdle(self, event: QueryIdleEvent) -> None:
        pass

    def onQueryTerminated(self, event: QueryTerminatedEvent) -> None:
        pass
