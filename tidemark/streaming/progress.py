"""Progress of streaming queries as structured log lines."""

from __future__ import annotations

import json
import logging

from pyspark.sql.streaming.listener import StreamingQueryListener

log = logging.getLogger("tidemark.streaming")


class JsonProgress(StreamingQueryListener):
    """One JSON object a line: event, query, batch, rows and rates; errors with their text."""

    def _say(self, event: str, **facts) -> None:
        log.log(logging.ERROR if facts.get("error") else logging.INFO, json.dumps({"event": event, **facts}, default=str, sort_keys=True))

    def onQueryStarted(self, event) -> None:
        self._say("query_started", query=event.id, name=event.name)

    def onQueryProgress(self, event) -> None:
        p = event.progress
        self._say("query_progress", query=p.id, name=p.name, batch=p.batchId, rows=p.numInputRows, rows_per_second=p.processedRowsPerSecond)

    def onQueryIdle(self, event) -> None:
        self._say("query_idle", query=event.id)

    def onQueryTerminated(self, event) -> None:
        self._say("query_terminated", query=event.id, error=event.exception)
