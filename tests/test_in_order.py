"""Throttle and previous request on transformWithState: equal to the batch
operators for any dealing of the rows, and states that end."""

import random

import pytest

from tollgate.schema import TRANSFER, TRANSFER_COLUMNS
from tollgate.session import work_dir
from tollgate.streaming import in_order as I
from tollgate.streaming.queries import rocksdb_state

from test_throttle_property import brute

NAMES = list(TRANSFER_COLUMNS)


def run(spark, batches, op):
    """Write each batch as a file, in order, and run ``op`` over one file a micro-batch."""
    from tollgate.streaming.queries import _order_by_name, _until_done

    src, out, ck = (work_dir(spark, n) for n in ("order-src", "order-out", "order-ck"))
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, TRANSFER).coalesce(1).write.parquet(f"{src}/b{i:03d}")
    _order_by_name(spark, src)
    with rocksdb_state(spark):
        stream = spark.readStream.schema(TRANSFER).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(src)
        q = op(stream).writeStream.format("parquet").option("path", out).option("checkpointLocation", ck).trigger(availableNow=True).start()
        _until_done(q)
    return spark.read.parquet(out).collect(), q, ck


def rows_of(seed, n=160):
    rnd = random.Random(seed)
    rows = [(f"id{i:04d}", f"s{min(rnd.randrange(6), 3)}", "t", "coro", "easy", 1.0, rnd.randrange(500, 200_000, 500)) for i in range(n)]
    batches = [[] for _ in range(6)]
    for r in rows:  # within 40 s of its place in time, in any order
        batches[min(5, max(0, (r[6] + rnd.randrange(-20_000, 20_000)) // 34_000))].append(r)
    for b in batches:
        rnd.shuffle(b)
    return rows, [b for b in batches if b]


def tick(at):
    return [(None, "clock", None, None, None, None, at)]


@pytest.mark.parametrize("cooldown", [2_000, 30_000])
def test_throttle_equals_brute_force(spark, cooldown):
    rows, batches = rows_of(cooldown)
    got, _, _ = run(spark, [*batches, tick(500_000)], lambda s: I.throttle_in_order(s, cooldown, delay="60 seconds"))
    assert sorted(r.id for r in got) == sorted(r[0] for r in rows)
    assert {r.id for r in got if r.allowed} == brute(rows, cooldown)
    by = {r[0]: r for r in rows}
    assert all(tuple(r)[:7] == by[r.id] for r in got)


def test_state_ends(spark):
    """Once the watermark is a cooldown past the last allowed request, nothing of a sender is left."""
    rows, batches = rows_of(3)
    _, q, ck = run(spark, [*batches, tick(290_000)], lambda s: I.throttle_in_order(s, 60_000, delay="60 seconds"))
    with rocksdb_state(spark):
        held = lambda ck: spark.read.format("statestore").option("stateVarName", "memory").load(ck).count()
        allowed = brute(rows, 60_000)
        last = {s: max(r[6] for r in rows if r[1] == s and r[0] in allowed) for s in {r[1] for r in rows}}
        assert held(ck) == sum(t + 60_000 > 230_000 for t in last.values()) > 0  # the tick less the delay
        _, _, done = run(spark, [*batches, tick(290_000), tick(900_000)], lambda s: I.throttle_in_order(s, 60_000, delay="60 seconds"))
        assert held(done) == 0


def test_last_request_and_expiry(spark):
    rows, batches = rows_of(5)
    want = {}
    for s in {r[1] for r in rows}:
        prev = None
        for r in sorted((r for r in rows if r[1] == s), key=lambda r: (r[6], r[0])):
            want[r[0]], prev = prev, r[0]
    got, _, _ = run(spark, [*batches, tick(500_000)], lambda s: I.last_request_in_order(s, delay="60 seconds"))
    assert {r.id: r.last_id for r in got} == want
    late = [("late", "s0", "t", "coro", "easy", 1.0, 2_000_000)]
    got, _, _ = run(spark, [*batches, tick(500_000), tick(1_500_000), late, tick(3_000_000)], lambda s: I.last_request_in_order(s, delay="60 seconds", expire_ms=300_000))
    assert {r.id: r.last_id for r in got} == want | {"late": None}


def test_rows_later_than_the_delay_are_counted(spark):
    rows = [("a", "s", "t", "coro", "easy", 1.0, 100_000)], [("b", "s", "t", "coro", "easy", 1.0, 200_000)], [("c", "s", "t", "coro", "easy", 1.0, 1_000)], tick(900_000)
    got, q, _ = run(spark, list(rows), lambda s: I.throttle_in_order(s, 10, delay="1 seconds"))
    assert {r.id for r in got} == {"a", "b"}
    assert sum(o.numRowsDroppedByWatermark for p in q.recentProgress for o in p.stateOperators) == 1
