"""State and calls of the stream operators are per bucket of senders, and the
results still per sender."""

import random

import pytest

from tollgate.schema import TRANSFER
from tollgate.session import work_dir
from tollgate.streaming import in_order as I
from tollgate.streaming.queries import rocksdb_state
from tollgate.streaming.stateful import last_request_with_state, throttle_with_state

from test_in_order import run, tick
from test_throttle_property import brute

SENDERS, BUCKETS, COOLDOWN = 60, 3, 5_000


def many_senders():
    """Rows in the order of their times, senders without an id among them."""
    rnd = random.Random(7)
    rows = [(f"id{i:04d}", None if s == 0 else f"s{s}", "t", "coro", "easy", 1.0, 1_000 + i * 50 // 10 * 10)
            for i, s in enumerate(rnd.randrange(SENDERS) for _ in range(900))]
    return rows, [rows[i:i + 300] for i in range(0, 900, 300)]


def previous(rows):
    last, out = {}, {}
    for r in sorted(rows, key=lambda r: (r[6], r[0])):
        out[r[0]], last[r[1]] = last.get(r[1]), r[0]
    return out


def groups(spark, ck, **options):
    state = spark.read.format("statestore").options(**options).load(ck)
    return state.select("key.*").distinct().count()


def test_in_order_keeps_state_of_buckets(spark):
    rows, batches = many_senders()
    got, _, ck = run(spark, [*batches, tick(30_000)], lambda s: I.throttle_in_order(s, COOLDOWN, delay="20 seconds", buckets=BUCKETS))
    with rocksdb_state(spark):
        assert 0 < groups(spark, ck, stateVarName="memory") <= BUCKETS
        assert 0 < groups(spark, ck, stateVarName="waiting") <= BUCKETS
    got, _, _ = run(spark, [*batches, tick(500_000)], lambda s: I.throttle_in_order(s, COOLDOWN, delay="20 seconds", buckets=BUCKETS))
    assert {r.id: r.allowed for r in got} == {r[0]: r[0] in brute(rows, COOLDOWN) for r in rows}
    got, _, ck = run(spark, [*batches, tick(500_000)], lambda s: I.last_request_in_order(s, delay="20 seconds", buckets=BUCKETS))
    assert {r.id: r.last_id for r in got} == previous(rows) and len(got) == len(rows)
    with rocksdb_state(spark):
        memory = spark.read.format("statestore").option("stateVarName", "memory").load(ck)
        assert memory.count() == SENDERS and memory.select("key.*").distinct().count() <= BUCKETS


@pytest.mark.parametrize("op", ["throttle", "previous"])
def test_stateful_keeps_state_of_buckets(spark, op):
    rows, batches = many_senders()
    src, out, ck = (work_dir(spark, f"buckets-{n}") for n in ("src", "out", "ck"))
    for b in batches:
        spark.createDataFrame(b, TRANSFER).write.mode("append").parquet(src)
        stream = spark.readStream.schema(TRANSFER).parquet(src)
        done = throttle_with_state(stream, COOLDOWN, buckets=BUCKETS) if op == "throttle" else last_request_with_state(stream, buckets=BUCKETS)
        done.writeStream.format("parquet").option("path", out).option("checkpointLocation", ck).trigger(availableNow=True).start().awaitTermination()
    got = spark.read.parquet(out).collect()
    assert len(got) == len(rows)
    if op == "throttle":
        assert {r.id for r in got if r.allowed} == brute(rows, COOLDOWN)
    else:
        assert {r.id: r.last_id for r in got} == previous(rows)
    assert 0 < groups(spark, ck) <= BUCKETS
