"""Throttle and previous request in order of event time, on ``transformWithState``.

A request waits in its sender's state (RocksDB, on the executor's disk) until
the watermark has passed its time; then nothing earlier can come any more, and
what waits is decided in the order of (time, id). Results are those of the batch
operators however the requests were dealt over micro-batches, as long as none is
later than the watermark's delay (Spark drops those and counts them as
``numRowsDroppedByWatermark``; so does it with times up to the epoch).

Senders are dealt by hash to ``buckets``, the groups that Spark keeps state of: a
call has all due requests of a bucket, in place of a call, and some messages to
the state store, for every sender. Requests wait as frames. In Python only keys,
times and ids of one bucket's due requests are gathered; the frames come from the
state and go out again one by one. A timer wakes a bucket when its next request
is due or its next sender is to be forgotten: the throttle forgets a sender a
cooldown after its last allowed time, since every later request is allowed with
or without it. What a bucket remembers of its senders (``memory``, a row a sender)
is read and written whole, so choose ``buckets`` for the number of senders. It
belongs to the state: keep it for as long as a checkpoint is used.

A row without an id is a clock tick: it moves the watermark and is not returned.
The session must use the RocksDB state store
(``spark.sql.streaming.stateStore.providerClass``).
"""

from __future__ import annotations

import pickle
import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from tollgate.operators.chain import allowed_by_key, previous_by_key

cloudpickle.register_pickle_by_value(sys.modules[__name__])

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Groups of senders that state is kept of.
BUCKETS = 256
#: Columns of a request's sender, as text, and of its bucket.
SENDER, BUCKET = "in_order_sender", "in_order_bucket"


class InOrder(StatefulProcessor):
    """Holds rows until the watermark passes them. Subclasses decide them."""

    def __init__(self, schema: T.StructType, out: str, ts: str, id_col: str, memory: str):
        self.names, self.out, self.memory_schema = schema.names, out, f"sender string, {memory}"
        self.ts, self.id = ts, id_col

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.memory = handle.getListState("memory", self.memory_schema)
        self.waiting = handle.getListState("waiting", "first long, last long, rows binary")
        self.timer = handle.getValueState("timer", "at long")

    def held(self, f: pd.DataFrame) -> tuple[int, int, bytes]:
        return int(f[self.ts].min()), int(f[self.ts].max()), pickle.dumps(f, protocol=5)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        first = []
        for f in rows:
            f = f[f[self.id].notna()]
            if len(f):
                chunk = self.held(f[[*self.names, SENDER]])
                self.waiting.appendValue(chunk)
                first.append(chunk[0])
        if first:
            set_for = self.timer.get()[0] if self.timer.exists() else None
            if set_for is None or min(first) < set_for:
                if set_for is not None:
                    self.handle.deleteTimer(set_for)
                self.wake(min(first))
        return iter(())

    def wake(self, at: int) -> None:
        self.handle.registerTimer(at)
        self.timer.update((at,))

    def due(self, now: int) -> Iterator[tuple[pd.DataFrame, np.ndarray]]:
        """The waiting frames with due rows, and which of their rows are due."""
        for first, _, rows in self.waiting.get():
            if first <= now:
                f = pickle.loads(rows)
                yield f, (f[self.ts] <= now).to_numpy()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentWatermarkInMs()
        memory = {r[0]: self.remembered(r[1:]) for r in self.memory.get()} if self.memory.exists() else {}
        later = []
        if self.waiting.exists():
            due = [(f[SENDER].to_numpy(object)[ready], f[self.ts].to_numpy(np.int64)[ready], f[self.id].to_numpy(object)[ready]) for f, ready in self.due(now)]
            if due:
                values, at = self.decide(*(np.concatenate(c) for c in zip(*due)), memory), 0
                for f, ready in self.due(now):
                    n = int(ready.sum())
                    yield f.loc[ready, self.names].assign(**{self.out: values[at:at + n]})
                    at += n
                for first, last, rows in self.waiting.get():
                    if first > now:
                        later.append((first, last, rows))
                    elif last > now:
                        f = pickle.loads(rows)
                        later.append(self.held(f[f[self.ts] > now]))
                self.waiting.clear()
                if later:
                    self.waiting.put(later)
            else:
                later = [(first, last, None) for first, last, _ in self.waiting.get()]
        memory = {k: m for k, m in memory.items() if self.ends(m) is None or self.ends(m) > now}
        self.memory.clear()
        if memory:
            self.memory.put([(k, *self.row(m)) for k, m in memory.items()])
        ends = [e for e in map(self.ends, memory.values()) if e is not None]
        self.timer.clear()
        if later or ends:
            self.wake(min([c[0] for c in later] + ends))

    def close(self) -> None:
        pass


class Throttle(InOrder):
    """Remembers a sender's last allowed time."""

    def __init__(self, schema, out, ts, id_col, cooldown_ms: int):
        super().__init__(schema, out, ts, id_col, "at long")
        self.cooldown = cooldown_ms

    def remembered(self, row):
        return row[0]

    def row(self, at):
        return (at,)

    def decide(self, senders, t, ids, memory):
        return allowed_by_key(senders, t, ids, self.cooldown, memory)

    def ends(self, at):
        return at + self.cooldown


class LastRequest(InOrder):
    """Remembers a sender's last (id, time)."""

    def __init__(self, schema, out, ts, id_col, expire_ms: int | None):
        super().__init__(schema, out, ts, id_col, "id string, at long")
        self.expire = expire_ms

    def remembered(self, row):
        return tuple(row)

    def row(self, last):
        return last

    def decide(self, senders, t, ids, memory):
        return previous_by_key(senders, t, ids, memory)

    def ends(self, last):
        return None if self.expire is None else last[1] + self.expire


def _run(stream: DataFrame, processor: InOrder, kind: T.DataType, key: str, ts: str, delay: str, buckets: int) -> DataFrame:
    timed = stream.withColumn("_event", F.timestamp_millis(F.col(ts))).withWatermark("_event", delay)
    dealt = timed.withColumns({SENDER: F.col(key).cast("string"), BUCKET: F.pmod(F.xxhash64(key), F.lit(buckets))})
    out = T.StructType([*stream.schema.fields, T.StructField(processor.out, kind)])
    return dealt.groupBy(BUCKET).transformWithStateInPandas(processor, out, "Append", "EventTime")


def throttle_in_order(stream: DataFrame, cooldown_ms: int, delay: str = "0 seconds", key: str = "from_id", ts: str = "timestamp", id_col: str = "id", buckets: int = BUCKETS) -> DataFrame:
    """The input rows plus ``allowed``, as the watermark passes them. A sender's
    state is removed once the watermark is a cooldown past its last allowed request."""
    return _run(stream, Throttle(stream.schema, "allowed", ts, id_col, int(cooldown_ms)), T.BooleanType(), key, ts, delay, buckets)


def last_request_in_order(stream: DataFrame, delay: str = "0 seconds", expire_ms: int | None = None, key: str = "from_id", ts: str = "timestamp", id_col: str = "id", buckets: int = BUCKETS) -> DataFrame:
    """The input rows plus ``last_id``. ``expire_ms``: a sender is forgotten once
    the watermark is so long past its last request."""
    return _run(stream, LastRequest(stream.schema, "last_id", ts, id_col, expire_ms), T.StringType(), key, ts, delay, buckets)
