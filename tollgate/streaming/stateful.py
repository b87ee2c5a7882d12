"""Throttle and previous request as stateful operators on Spark's state store.

``groupBy(bucket).applyInPandasWithState``: senders are dealt by hash to
``buckets``, and Spark keeps one state row per bucket, checkpointed with the
query, that has an entry for each of its senders; a call for every sender would
cost more than its few requests. Each micro-batch hands a bucket's new requests
to one call, in chunks. Only senders, times and ids are gathered to be put in
order; the rows themselves go out chunk by chunk, a chunk as one row of arrays
(Spark fills up its state columns to the number of rows that go out, and looks
at each of these), from which they are unpacked. A request older than the
remembered allowed one is refused (it counts as late). The previous request is
that of the batch before, then by time within a batch: what came later in an
earlier batch does not matter.

The state of a bucket is read and written whole: choose ``buckets`` for the
number of senders, and keep it for as long as a checkpoint is used.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tollgate.operators.chain import allowed_by_key, previous_by_key
from tollgate.schema import DEFAULT_COOLDOWN_MS

# The per-sender functions run in Python workers: ship this module's code by
# value, so workers need only numpy/pandas, not this package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


#: Groups of senders that state is kept of.
BUCKETS = 256
#: Columns of a request's sender, as text, and of its bucket.
SENDER, BUCKET = "_sender", "_bucket"


def _dealt(stream: DataFrame, key: str, buckets: int):
    return stream.withColumns({SENDER: F.col(key).cast("string"), BUCKET: F.pmod(F.xxhash64(key), F.lit(buckets))}).groupBy(BUCKET)


def _gathered(frames: list[pd.DataFrame], ts: str, id_col: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Senders, times and ids of all chunks."""
    keys = np.concatenate([f[SENDER].to_numpy(object) for f in frames])
    t = np.concatenate([f[ts].astype("int64").to_numpy() for f in frames])
    return keys, t, np.concatenate([f[id_col].astype(object).to_numpy() for f in frames])


#: Types of columns that go out as arrays; with any other, rows go out as they are.
PLAIN = (T.StringType, T.BooleanType, T.IntegerType, T.LongType, T.DoubleType)


def _chunks(frames: list[pd.DataFrame], cols: list[str], name: str, values: np.ndarray, packed: bool) -> Iterator[pd.DataFrame]:
    at = 0
    for f in frames:
        out = f[cols].assign(**{name: values[at:at + len(f)]})
        at += len(f)
        yield pd.DataFrame({c: [_array(out[c])] for c in out.columns}) if packed else out


def _array(s: pd.Series) -> np.ndarray:
    none = s.isna()
    return (s.astype(object).where(~none, None) if none.any() else s).to_numpy()


def _packed(schema: T.StructType) -> bool:
    names = [f.name.lower() for f in schema.fields]
    return all(isinstance(f.dataType, PLAIN) for f in schema.fields) and len(set(names)) == len(names)


def _arrays(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, T.ArrayType(f.dataType)) for f in schema.fields])


def _unpacked(df: DataFrame) -> DataFrame:
    return df.select(F.inline(F.arrays_zip(*[F.col(f"`{c}`") for c in df.columns])).alias(*df.columns))


def throttle_with_state(
    stream: DataFrame,
    cooldown_ms: int = DEFAULT_COOLDOWN_MS,
    key: str = "from_id",
    ts: str = "timestamp",
    id_col: str = "id",
    expire_ms: int | None = None,
    buckets: int = BUCKETS,
) -> DataFrame:
    """Streaming throttle: the input rows plus ``allowed``, appended per batch.

    ``expire_ms``: forget a sender that has been quiet for so long by the wall
    clock (at least the cooldown; for live streams, whose timestamps follow the
    clock; such a query runs batches for ever, whatever its trigger). Without
    it, as for a replay of old requests, state is kept."""
    c = int(cooldown_ms)
    if expire_ms is not None and expire_ms < c:
        raise ValueError("a state that expires within the cooldown would let requests through")
    out_schema = T.StructType(stream.schema.fields + [T.StructField("allowed", T.BooleanType())])
    cols, packed = [f.name for f in stream.schema.fields], _packed(out_schema)

    def step(k: tuple, pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        frames = [] if state.hasTimedOut else [f for f in pdfs if len(f)]
        if not frames and not state.hasTimedOut:
            return
        last, seen, ok = {}, {}, None
        if state.exists:
            senders, at, when = state.get
            last, seen = dict(zip(senders, at)), dict(zip(senders, when))
        now = state.getCurrentProcessingTimeMs()
        if frames:
            keys, t, ids = _gathered(frames, ts, id_col)
            ok = allowed_by_key(keys, t, ids, c, last)
            seen |= dict.fromkeys(set(keys), now)
        if expire_ms is not None:
            last = {s: at for s, at in last.items() if seen[s] + expire_ms > now}
        if last:
            state.update((list(last), list(last.values()), [seen[s] for s in last]))
            if expire_ms is not None:
                state.setTimeoutDuration(min(seen[s] for s in last) + int(expire_ms) - now)
        elif state.exists:
            state.remove()
        if frames:
            yield from _chunks(frames, cols, "allowed", ok, packed)

    timeout = GroupStateTimeout.NoTimeout if expire_ms is None else GroupStateTimeout.ProcessingTimeTimeout
    held = "senders array<string>, last_allowed array<long>, seen array<long>"
    done = _dealt(stream, key, buckets).applyInPandasWithState(step, _arrays(out_schema) if packed else out_schema, held, "append", timeout)
    return _unpacked(done) if packed else done


def last_request_with_state(
    stream: DataFrame,
    key: str = "from_id",
    ts: str = "timestamp",
    id_col: str = "id",
    buckets: int = BUCKETS,
) -> DataFrame:
    """Streaming previous request per sender: the input rows plus ``last_id``,
    by arrival (batch after batch, within one by ``(ts, id)``); no expiry."""
    out_schema = T.StructType(stream.schema.fields + [T.StructField("last_id", T.StringType())])
    cols, packed = [f.name for f in stream.schema.fields], _packed(out_schema)

    def step(k: tuple, pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        frames = [f for f in pdfs if len(f)]
        if not frames:
            return
        keys, t, ids = _gathered(frames, ts, id_col)
        last = {s: (i, at) for s, i, at in zip(*state.get)} if state.exists else {}
        before = previous_by_key(keys, t, ids, last)
        state.update((list(last), [i for i, _ in last.values()], [at for _, at in last.values()]))
        yield from _chunks(frames, cols, "last_id", before, packed)

    held = "senders array<string>, ids array<string>, at array<long>"
    done = _dealt(stream, key, buckets).applyInPandasWithState(step, _arrays(out_schema) if packed else out_schema, held, "append", GroupStateTimeout.NoTimeout)
    return _unpacked(done) if packed else done
