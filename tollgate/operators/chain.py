"""Greedy chains over sorted times, for Python workers (shipped by value).

``allowed_chain`` walks one stretch; ``exits`` makes of a stretch the map from
the state on entry (the last allowed time before it) to the state on exit, so
that stretches can be folded apart and composed afterwards.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Steps that leave a task in one batch.
STEPS = 1 << 15


def allowed_chain(ts: np.ndarray, cooldown_ms: int, last_allowed: int | None) -> np.ndarray:
    """``ts`` sorted ascending (ties already ordered by id). Returns the
    allowed mask of the greedy chain, starting after ``last_allowed``."""
    n = len(ts)
    ok = np.zeros(n, dtype=bool)
    nxt = np.searchsorted(ts, ts + cooldown_ms, side="left")
    i = 0 if last_allowed is None else int(np.searchsorted(ts, last_allowed + cooldown_ms, side="left"))
    while i < n:
        ok[i] = True
        i = int(nxt[i])
    return ok


def key_runs(keys: np.ndarray, ts: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """The order of rows by (key, time, id), and the bounds of each key's run in it."""
    code = pd.factorize(keys, use_na_sentinel=False)[0]
    order = np.lexsort((ids.astype(str), ts, code))
    code = code[order]
    first = np.flatnonzero(np.r_[True, code[1:] != code[:-1]]).tolist()
    return order, list(zip(first, [*first[1:], len(order)]))


#: Rows of a key up to which its chain is walked together with the other keys'.
SHORT = 256


def allowed_by_key(keys: np.ndarray, ts: np.ndarray, ids: np.ndarray, cooldown_ms: int, last: dict[str | None, int]) -> np.ndarray:
    """The allowed mask of rows of several keys in any order. ``last``: the last
    allowed time of each key, which is brought up to date. Short runs are walked
    side by side, a row of each at a time; a long one by itself."""
    ok = np.zeros(len(ts), dtype=bool)
    order, runs = key_runs(keys, ts, ids)
    times, hit = ts[order], np.zeros(len(ts), dtype=bool)
    short = []
    for a, b in runs:
        if b - a > SHORT:
            hit[a:b] = allowed_chain(times[a:b], cooldown_ms, last.get(keys[order[a]]))
        else:
            short.append((b - a, a))
    if short:
        size, first = np.array(sorted(short, reverse=True)).T
        held = [last.get(keys[k]) for k in order[first]]
        free = np.array([h is None for h in held])
        before = np.array([0 if h is None else h for h in held], dtype=np.int64)
        for k in range(size[0]):
            n = np.count_nonzero(size > k)  # runs by falling size: those that go on
            now = times[first[:n] + k]
            yes = free[:n] | (now >= before[:n] + cooldown_ms)
            hit[first[:n] + k] = yes
            before[:n][yes] = now[yes]
            free[:n] &= ~yes
    ok[order] = hit
    code = np.repeat(np.arange(len(runs)), [b - a for a, b in runs])
    at = np.full(len(runs), -1)
    at[code[hit]] = np.flatnonzero(hit)  # the last one of a run stays
    last.update((keys[order[i]], int(times[i])) for i in at[at >= 0])
    return ok


def previous_by_key(keys: np.ndarray, ts: np.ndarray, ids: np.ndarray, last: dict[str | None, tuple[str, int]]) -> np.ndarray:
    """The id before each row among those of its key, by (time, id). ``last``:
    each key's last (id, time), which is brought up to date."""
    before = np.empty(len(ts), dtype=object)
    order, runs = key_runs(keys, ts, ids)
    before[order[1:]] = ids[order[:-1]]
    for a, b in runs:
        key, end = keys[order[a]], order[b - 1]
        before[order[a]] = last[key][0] if key in last else None
        last[key] = (str(ids[end]), int(ts[end]))
    return before


def exits(ts: np.ndarray, cooldown_ms: int) -> tuple[np.ndarray, np.ndarray]:
    """The exit of a stretch as a step function of the first time that may be
    allowed: the exit is ``last[i]`` for the least i with time <= ``upto[i]``,
    and the entry's own state beyond the last step. That first time lies less
    than a cooldown after the stretch's first, or the stretch is entered free."""
    n = len(ts)
    nxt = np.searchsorted(ts, ts + cooldown_ms, side="left")
    end = np.where(nxt < n, nxt, np.arange(n))
    while True:  # pointer jumping: to the end of every point's chain
        further = end[end]
        if (further == end).all():
            break
        end = further
    m = min(n, int(np.searchsorted(ts, ts[0] + cooldown_ms, side="left")) + 1)
    step = np.flatnonzero(np.r_[end[1:m] != end[:m - 1], True])
    return ts[step], ts[end[step]]


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, list[tuple[int, int]]]]:
    """A sorted partition, and the bounds of each key's run in it."""
    held = [b for b in batches if b.num_rows]
    if held:
        t = pa.Table.from_batches(held).combine_chunks()
        code = t.column("_k").combine_chunks().dictionary_encode(null_encoding="encode").indices.to_numpy()
        first = np.flatnonzero(np.r_[True, code[1:] != code[:-1]])
        yield t, list(zip(first.tolist(), [*first[1:].tolist(), len(code)]))


def edge_stretches(cooldown_ms: int):
    """Arrow function: sorted points to the steps (``upto``, ``last``; a row
    each) of the first and the last run of the partition, the only ones that
    another partition may go on with."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, runs in _runs(batches):
            ts, keys, ranges = t.column("_t").to_numpy(), t.column("_k").combine_chunks(), t.column("_r").combine_chunks()
            for a, b in dict.fromkeys([runs[0], runs[-1]]):
                upto, last = exits(ts[a:b], cooldown_ms)
                for at in range(0, len(upto), STEPS):
                    n = min(STEPS, len(upto) - at)
                    same = pa.array(np.full(n, a))
                    yield pa.RecordBatch.from_arrays([keys.take(same), ranges.take(same), pa.array(upto[at:at + n]), pa.array(last[at:at + n])], ["_k", "_r", "upto", "last"])

    return run


def allowed_points(cooldown_ms: int, entry: dict[int, int]):
    """Arrow function: sorted points to the allowed ones. ``entry``: by
    partition, the last allowed time of its first run before it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, runs in _runs(batches):
            ts = t.column("_t").to_numpy()
            ok = np.zeros(len(ts), dtype=bool)
            before = entry.get(t.column("_r")[0].as_py())
            for k, (a, b) in enumerate(runs):
                ok[a:b] = allowed_chain(ts[a:b], cooldown_ms, before if k == 0 else None)
            yield from t.filter(pa.array(ok)).select(["_k", "_t", "_win"]).combine_chunks().to_batches()

    return run
