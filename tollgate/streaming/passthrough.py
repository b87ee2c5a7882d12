"""Rules that pass through a stream unchanged, and are counted on the way by an
observed metric, which a query listener receives after every micro-batch."""

from __future__ import annotations

import threading
import time

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

METRIC = "rules_seen"


def counted(rules: DataFrame) -> DataFrame:
    """The same rows, with their number observed as ``rules_seen``."""
    return rules.observe(METRIC, F.count(F.lit(1)).alias("n_rules"))


class RuleCounts(StreamingQueryListener):
    """Keeps, of every query with the metric, the rules of each micro-batch."""

    def __init__(self):
        self._lock, self._counts, self._ended = threading.Lock(), {}, set()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        row = p.observedMetrics.get(METRIC)
        if row is not None:
            with self._lock:
                self._counts.setdefault(str(p.runId), {})[p.batchId] = row["n_rules"]

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        with self._lock:
            self._ended.add(str(event.runId))

    def of(self, query: StreamingQuery, wait_s: float = 30.0) -> list[tuple[int, int]]:
        """(micro-batch, rules) of an ended query, in order; those without rules
        are left out. Events come on a thread of their own: waits for the last."""
        run, until = str(query.runId), time.monotonic() + wait_s
        while time.monotonic() < until:
            with self._lock:
                if run in self._ended:
                    break
            time.sleep(0.05)
        with self._lock:
            return sorted((b, n) for b, n in self._counts.get(run, {}).items() if n)
