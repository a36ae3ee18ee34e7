"""Progress of running streams as a table: input, rates, durations, watermark, state and lag of every micro-batch."""

from __future__ import annotations

import threading
from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from wardlake.sources.tables import TableStore

TABLE = "stream_progress"
LAG = "lag"
SCHEMA = """query string, run_id string, batch_id bigint, started_at timestamp, input_rows bigint,
    input_rows_per_second double, processed_rows_per_second double, batch_ms bigint, watermark timestamp,
    state_rows bigint, max_lag_s bigint"""


def with_lag(events: DataFrame, event_ts: str = "event_ts", arrival: str = "arrival_ts") -> DataFrame:
    """The same rows; every micro-batch reports the largest seconds from event to arrival in its progress."""
    seconds = F.unix_timestamp(arrival) - F.unix_timestamp(event_ts)
    return events.observe(LAG, F.max(seconds).alias("max_lag_s"))


def _time(text: str | None) -> datetime | None:
    return None if not text else datetime.fromisoformat(text.replace("Z", "+00:00")).astimezone(timezone.utc)


class ProgressLog(StreamingQueryListener):
    """Appends the progress of all streams of the session to a table, ``every`` batches and when a stream ends.

    Add it with ``spark.streams.addListener``. Batches without input are left out.
    """

    def __init__(self, store: TableStore, name: str = TABLE, every: int = 50):
        self.store, self.name, self.every = store, name, every
        self._rows: list[tuple] = []
        self._ended: set[str] = set()
        self._changed = threading.Condition()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        if not p.numInputRows:
            return
        lag = p.observedMetrics.get(LAG)
        row = (p.name, str(p.runId), p.batchId, _time(p.timestamp), p.numInputRows, p.inputRowsPerSecond,
               p.processedRowsPerSecond, p.batchDuration, _time((p.eventTime or {}).get("watermark")),
               sum(s.numRowsTotal for s in p.stateOperators), lag["max_lag_s"] if lag else None)
        with self._changed:
            self._rows.append(row)
            full = len(self._rows) >= self.every
        if full:
            self.flush()

    def onQueryTerminated(self, event) -> None:
        self.flush()
        with self._changed:
            self._ended.add(str(event.runId))
            self._changed.notify_all()

    def flush(self) -> None:
        with self._changed:
            rows, self._rows = self._rows, []
        if rows:
            self.store.append(self.store.spark.createDataFrame(rows, SCHEMA).coalesce(1), self.name)

    def wait(self, queries: list[StreamingQuery], seconds: float = 60) -> None:
        """Until the progress of ended ``queries`` is in the table; listeners hear of it a little later."""
        wanted = {str(q.runId) for q in queries}
        with self._changed:
            if not self._changed.wait_for(lambda: wanted <= self._ended, seconds):
                raise TimeoutError(f"no end of {sorted(wanted - self._ended)} within {seconds} s")
