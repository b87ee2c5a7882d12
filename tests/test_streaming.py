"""Stream = batch; state, totals and topics of the job."""

from tollgate.plans import catalog
from tollgate.session import work_dir
from tollgate.sources import events as EV
from tollgate.streaming import driver as D
from tollgate.streaming import queries as SQ

SF = "/root/testdata/sf0.001"


def rows(df, cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_throttle_stream_equals_batch(spark):
    s = SQ.q_throttle_stream(spark, SF)
    b = catalog.queries()["throttle"](spark, SF)
    assert rows(s, ["id", "allowed"]) == rows(b, ["id", "allowed"])


def test_last_request_stream_equals_batch(spark):
    s = SQ.q_last_request_stream(spark, SF)
    b = catalog.queries()["last_request"](spark, SF)
    assert rows(s, ["id", "last_id"]) == rows(b, ["id", "last_id"])


def test_ledger_ingest(spark):
    got = SQ.q_ledger_ingest(spark, SF)
    assert got.count() == EV.transfers(spark, SF).count()


def test_replayed_batch_replaces_its_files(spark):
    from tollgate.streaming import job as J

    out = work_dir(spark, "t-topic")
    df = spark.createDataFrame([("k", "v", "t")], "key string, value string, topic string")
    for batch_id in (0, 1, 1):
        J._put(df, out, batch_id, "parquet", None)
    assert spark.read.parquet(out).count() == 2


def test_totals_are_sums_of_the_ledger_topic(spark):
    """Rows that arrive later, from anyone, count; NULL stays apart from 0."""
    from tollgate.operators.ledger import account_totals
    from tollgate.schema import TRANSFER
    from tollgate.streaming import job as J

    src, ck = work_dir(spark, "t-ledger"), work_dir(spark, "t-totals")
    first = spark.createDataFrame([("1", "a", "b", "coro", "easy", 0.004, 1), ("2", "a", "c", "coro", "easy", 2.5, 2)], TRANSFER)
    second = spark.createDataFrame([("3", "b", "a", "coro", "easy", 1.25, 3)], TRANSFER)
    for rows in (first, second):
        rows.write.mode("append").parquet(src)
        J.keep_totals(spark.readStream.schema(TRANSFER).parquet(src), ck, {"availableNow": True}).awaitTermination()
    key = lambda r: r["account"]
    got = sorted(J.read_totals(spark, ck).collect(), key=key)
    want = sorted(account_totals(first.unionByName(second)).collect(), key=key)
    assert [tuple(r) for r in got] == [tuple(r) for r in want]


def test_previous_request_is_by_arrival(spark):
    """A request that comes late is the previous one of what follows it."""
    from tollgate.schema import TRANSFER
    from tollgate.streaming.stateful import last_request_with_state

    src, out, ck = (work_dir(spark, n) for n in ("t-arrivals", "t-arrivals-out", "t-arrivals-ck"))
    for i, t in (("r1", 100), ("r2", 50), ("r3", 200)):
        spark.createDataFrame([(i, "s", "x", "coro", "easy", 1.0, t)], TRANSFER).write.mode("append").parquet(src)
        stream = last_request_with_state(spark.readStream.schema(TRANSFER).parquet(src))
        stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", ck).trigger(availableNow=True).start().awaitTermination()
    assert {r["id"]: r["last_id"] for r in spark.read.parquet(out).collect()} == {"r1": None, "r2": "r1", "r3": "r2"}


def test_state_may_not_expire_within_the_cooldown(spark):
    import pytest

    from tollgate.streaming.stateful import throttle_with_state

    with pytest.raises(ValueError):
        throttle_with_state(EV.transfers(spark, SF), 1000, expire_ms=999)


def test_stateful_throttle_stream_equals_batch(spark):
    s = SQ.q_throttle_stateful_stream(spark, SF)
    b = catalog.queries()["throttle"](spark, SF)
    assert rows(s, ["id", "allowed"]) == rows(b, ["id", "allowed"])


def test_allowed_chain_with_state_and_late_rows():
    import numpy as np

    from tollgate.operators.chain import allowed_chain

    ts = np.array([0, 5000, 19999, 20000, 20000, 39000, 40000])
    assert allowed_chain(ts, 20000, None).tolist() == [True, False, False, True, False, False, True]
    # remembered allowed time 15000: everything before 35000 is refused
    assert allowed_chain(ts, 20000, 15000).tolist() == [False, False, False, False, False, True, False]


def test_ledger_ingest_quarantines_malformed(spark):
    src, sink, ck, bad = (work_dir(spark, n) for n in ("q-src", "q-sink", "q-ck", "q-bad"))
    good = EV.transfers(spark, SF).limit(50)
    from tollgate.sources.messages import transfer_messages

    msgs = transfer_messages(good).unionByName(
        spark.createDataFrame([("k", "{broken", "transfers_4", 0, 1, None)], "key string, value string, topic string, partition int, offset long, timestamp timestamp")
    )
    msgs.write.mode("overwrite").json(src)
    q1, q2 = D.ledger_ingest(spark, src, sink, ck, fmt="json", trigger={"availableNow": True}, quarantine=bad)
    q1.awaitTermination()
    q2.awaitTermination()
    assert spark.read.parquet(sink).count() == 50
    assert [r["value"] for r in spark.read.parquet(bad).collect()] == ["{broken"]


def test_point_lookup_pushed_to_table_scan(spark):
    import uuid

    from tollgate.operators import filters
    from tollgate.sinks import ledger_table as LT

    name = f"t_lookup_{uuid.uuid4().hex[:8]}"
    LT.create_ledger(spark, name, work_dir(spark, "t-lookup"))
    LT.insert_ledger(spark, name, EV.ledger(spark, SF))
    df = filters.ledger_point_lookup(LT.read_ledger(spark, name), "123")
    p = df._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(id,123)" in p
    assert df.count() == 1
    LT.drop_ledger(spark, name)


def test_stateful_last_request_stream_equals_batch(spark):
    s = SQ.q_last_request_stateful_stream(spark, SF)
    b = catalog.queries()["last_request"](spark, SF)
    assert rows(s, ["id", "last_id"]) == rows(b, ["id", "last_id"])
