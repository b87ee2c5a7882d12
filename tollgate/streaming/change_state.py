"""The current rows of a table from a stream of its change events.

Every micro-batch is parsed, and its events are merged by id into a keyed table
that remembers each id's newest event, deletes included, so that an event which
comes late (of a lower log position) changes nothing. A truncate is an event of
the whole table: it is kept as the row without an id, and ends all events before
it. Malformed events go, as text, to a folder of their own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tollgate.sinks.keyed_table import KeyedTable
from tollgate.sources.cdc import cdc_read, current_rows, newest_by_id

CHANGE_STATE = "id string, lsn long, ts_ms long, op string, from_id string, to_id string, pool_id string, amount double, timestamp long"


def change_state(spark: SparkSession, path: str, buckets: int = 64) -> KeyedTable:
    """One row an id (and one for truncates), the newest by position and time."""
    return KeyedTable(spark, path, CHANGE_STATE, key=["id"], order=["lsn", "ts_ms"], buckets=buckets)


def keep_current_state(events: DataFrame, state: KeyedTable, malformed: str, checkpoint: str, value_col: str = "value", trigger: dict | None = None):
    """Start the fold of a stream of change events into ``state``. Malformed
    events of a micro-batch go to a folder of its own under ``malformed``; a
    replayed micro-batch replaces it, and merges the same events again, which
    changes nothing."""

    def body(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            good, bad = cdc_read(batch, value_col)
            bad.write.mode("overwrite").parquet(f"{malformed.rstrip('/')}/batch_id={batch_id}")
            state.merge(newest_by_id(good))
        finally:
            batch.unpersist()

    w = events.writeStream.foreachBatch(body).option("checkpointLocation", checkpoint)
    return w.trigger(**(trigger or {"processingTime": "10 seconds"})).start()


def read_current_state(state: KeyedTable) -> DataFrame:
    """The table's rows as of the last merged micro-batch."""
    return current_rows(state.read())
