"""Progress and failures of running queries, as rows of a table."""

import threading

from pyspark.sql.streaming import StreamingQueryListener

PROGRESS = (
    "query string, run string, batch_id long, at string, input_rows long, state_rows long, batch_ms long, error string")
HELD = 100  # rows held before they are written


class ProgressLog(StreamingQueryListener):
    """Writes a row per batch of every query of the session, and one per query that ended, with its
    error if it failed, to a table under ``path``. Add it with spark.streams.addListener."""

    def __init__(self, spark, path, held=HELD):
        self.spark, self.path, self.held = spark, path, held
        self.names, self.rows, self.lock, self.ended = {}, [], threading.Lock(), threading.Condition()
        self.ends = 0

    def onQueryStarted(self, event):
        self.names[str(event.runId)] = event.name

    def onQueryProgress(self, event):
        p = event.progress
        state = sum(s.numRowsTotal for s in p.stateOperators)
        took = p.durationMs.get("triggerExecution", 0)
        self._add((p.name, str(p.runId), p.batchId, p.timestamp, p.numInputRows, state, took, None))

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        run = str(event.runId)
        self._add((self.names.get(run), run, None, None, 0, None, None, event.exception), last=True)

    def _add(self, row, last=False):
        with self.lock:
            self.rows.append(row)
            full = len(self.rows) >= self.held
        if last or full:
            self.flush()
        if last:
            with self.ended:
                self.ends += 1
                self.ended.notify_all()

    def flush(self):
        """Write what is held."""
        with self.lock:
            rows, self.rows = self.rows, []
        if rows:
            self.spark.createDataFrame(rows, PROGRESS).coalesce(1).write.mode("append").parquet(self.path)

    def wait(self, ends, timeout=60):
        """Wait until the ends of so many queries are written; events come after the queries' own end."""
        with self.ended:
            return self.ended.wait_for(lambda: self.ends >= ends, timeout)


def read_progress(spark, path):
    return spark.read.schema(PROGRESS).parquet(path)
