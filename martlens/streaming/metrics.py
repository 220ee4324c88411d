"""Counts of every micro-batch of every app.

Jobs observe what they read and reject (``<app>_input``) and report the rows
left after each step to a ``Steps`` callable.  One listener joins both with the
progress that Spark reports when the batch is done.
"""

from __future__ import annotations

import logging
import threading
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming.listener import StreamingQueryListener

#: Gets a batch id and the rows left after the steps of that batch.
Steps = Callable[[int, dict[str, int]], None]
log = logging.getLogger("martlens.metrics")
SUFFIX = "_input"


def observe_input(rows: DataFrame, app: str, rejected: Column) -> DataFrame:
    """``rows`` with their number and that of the ``rejected`` ones reported as progress."""
    return rows.observe(f"{app}{SUFFIX}", F.count(F.lit(1)).alias("rows"), F.count(F.when(rejected, 1)).alias("rejected"))


def counted(rows: DataFrame) -> tuple[DataFrame, Observation]:
    """``rows``, and an observation that has their number once they were written."""
    n = Observation()
    return rows.observe(n, F.count(F.lit(1)).alias("rows")), n


def logged(record: dict) -> None:
    log.info("%s batch %d: %s", record["app"], record["batch"],
             ", ".join(f"{k} {v}" for k, v in record.items() if k not in ("app", "batch")))


class RunMetrics(StreamingQueryListener):
    """``spark.streams.addListener(metrics)``; ``write`` gets a dict per batch and
    app: app, batch, read, rejected, seconds, state_rows, and the app's steps."""

    def __init__(self, write: Callable[[dict], None] = logged):
        self.write = write
        self._steps: dict[tuple[str, int], dict[str, int]] = {}
        self._lock = threading.Lock()

    def steps(self, app: str) -> Steps:
        """For the ``counts`` of a job."""
        def report(batch_id: int, counts: dict[str, int]) -> None:
            with self._lock:
                self._steps[app, int(batch_id)] = dict(counts)
        return report

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        inputs = {k.removesuffix(SUFFIX): v for k, v in p.observedMetrics.items() if k.endswith(SUFFIX)}
        for app, seen in inputs.items():
            with self._lock:
                steps = self._steps.pop((app, p.batchId), {})
            # a step may have a name of these: what the batch read comes first
            self.write({**steps, "app": app, "batch": p.batchId, "read": seen["rows"], "rejected": seen["rejected"],
                        "seconds": p.batchDuration / 1000, "state_rows": sum(s.numRowsTotal for s in p.stateOperators)})

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass
