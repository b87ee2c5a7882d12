"""Keyed tables, as-of joins, rule updates and change state: odd rows, replays, hot keys."""

import random

import pytest
from pyspark.errors import PySparkException

from tollgate.operators.asof import as_of
from tollgate.session import work_dir
from tollgate.sinks import ledger_table as LT
from tollgate.sinks.keyed_table import KeyedTable
from tollgate.sources import cdc
from tollgate.streaming import change_state as C
from tollgate.streaming import rule_updates as U

SCHEMA = "id string, at long, v string"


def rows(table):
    return sorted((tuple(r) for r in table.read().collect()), key=str)


def test_merge_keeps_one_row_a_key_and_bears_replay(spark):
    t = KeyedTable(spark, work_dir(spark, "keyed"), SCHEMA, key=["id"], order=["at"], buckets=4)
    assert rows(t) == []
    first = [(f"k{i % 20}", i, "a") for i in range(60)] + [(None, 1, "n"), (None, 2, "m"), ("tie", 5, "x"), ("tie", 5, "y"), ("none", None, None)]
    t.merge(spark.createDataFrame(first, SCHEMA))
    want = {f"k{i}": (40 + i, "a") for i in range(20)} | {None: (2, "m"), "tie": (5, "y"), "none": (None, None)}
    assert {r[0]: r[1:] for r in rows(t)} == want and len(rows(t)) == len(want)
    later = spark.createDataFrame([("k1", 3, "late"), ("k2", 99, "new"), ("k99", 1, "new")], SCHEMA)
    t.merge(later)
    want |= {"k2": (99, "new"), "k99": (1, "new")}
    assert {r[0]: r[1:] for r in rows(t)} == want
    for again in (later, spark.createDataFrame(first, SCHEMA), later.limit(0)):
        t.merge(again)
        assert {r[0]: r[1:] for r in rows(t)} == want and len(rows(t)) == len(want)


def test_merge_rewrites_only_touched_buckets(spark):
    import glob
    import os

    t = KeyedTable(spark, work_dir(spark, "keyed"), SCHEMA, key=["id"], order=["at"], buckets=8)
    t.merge(spark.createDataFrame([(f"k{i}", 1, "a") for i in range(100)], SCHEMA))
    at = t.path.removeprefix("file:")
    before = {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{at}/bucket=*/*.parquet")}
    one = spark.createDataFrame([("k5", 2, "b")], SCHEMA)
    t.merge(one)
    bucket = t.in_buckets(one).first().bucket
    after = {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{at}/bucket=*/*.parquet")}
    assert {f for f in before if f"bucket={bucket}/" not in f} == {f for f, m in after.items() if before.get(f) == m}
    assert sum(f"bucket={bucket}/" in f for f in after) == 1


def test_as_of_equals_plain(spark):
    rnd = random.Random(2)
    left = [(f"r{i}", rnd.choice(["hot"] * 5 + ["b", "c", None]), rnd.randrange(1000)) for i in range(900)] + [(f"s{i}", "hot", 500) for i in range(300)]
    right = [(k, rnd.randrange(1000), float(rnd.randrange(50))) for k in ["hot", "b", None] for _ in range(40)]
    got = as_of(spark.createDataFrame(left, "id string, k string, t long"), spark.createDataFrame(right, "k string, since long, v double"), "k", "t", "since", ["v"])
    assert got.columns == ["id", "k", "t", "v"]
    want = {}
    for i, k, t in left:
        before = [(s, v) for kk, s, v in right if k is not None and kk == k and s <= t]
        want[i] = max(before)[1] if before else None
    assert {r.id: r.v for r in got.collect()} == want and got.count() == len(left)


def test_rules_hold_by_arrival(spark):
    req = spark.createDataFrame([("a", "easy", 10, 5.0), ("b", "easy", 20, 5.0), ("c", "easy", 30, 5.0), ("d", "hard", 30, 5.0), ("e", "easy", 40, None)],
                                "id string, pool_type string, arrival long, balance double")
    rules = spark.createDataFrame([("easy", -1, 0.0), ("easy", 20, 9.0), ("easy", 25, 4.0), ("hard", -1, 5.0)], "pool_type string, arrival long, min_balance double")
    got = {r.id: (r.min_balance, r.error) for r in U.split_by_rules(req, rules).collect()}
    low = "INSUFFICIENT_BALANCE"
    assert got == {"a": (0.0, None), "b": (9.0, low), "c": (4.0, None), "d": (5.0, low), "e": (4.0, low)}
    unknown = spark.createDataFrame([("x", "other", 1, 5.0)], req.schema)
    with pytest.raises(PySparkException, match="no rule for pool type other"):
        U.split_by_rules(unknown, rules).collect()
    assert U.split_by_rules(unknown, rules, on_missing_rule="refuse").first().error == low


def test_rule_state_bears_replay(spark):
    """A micro-batch that is run again finds the rules as they were."""
    state = U.rule_state(spark, work_dir(spark, "rules"))
    batch = spark.createDataFrame([("easy", 20, 9.0)], U.RULE_UPDATE)
    state.merge(spark.createDataFrame([("easy", -1, 0.0)], U.RULE_UPDATE))
    req = spark.createDataFrame([("a", "easy", 10, 5.0), ("b", "easy", 30, 5.0)], "id string, pool_type string, arrival long, balance double")
    once = sorted(tuple(r) for r in U.split_by_rules(req, state.read().unionByName(batch)).select("id", "min_balance").collect())
    state.merge(batch)
    again = sorted(tuple(r) for r in U.split_by_rules(req, state.read().unionByName(batch)).select("id", "min_balance").collect())
    assert once == again == [("a", 0.0), ("b", 9.0)]


def event(op, lsn, i=None, amount=1.0, ts=0):
    row = f'{{"id":"{i}","_from":"f","_to":"t","pool_id":"p","amount":{amount},"timestamp":5}}' if i else "null"
    before, after = (row, "null") if op == "d" else ("null", row)
    return f'{{"op":"{op}","ts_ms":{ts},"source":{{"lsn":{lsn},"table":"transfers"}},"before":{before},"after":{after}}}'


GOOD = [event("c", 1, "x"), event("c", 2, "gone"), event("t", 3), event("c", 4, "y"), event("u", 6, "y", 2.0), event("c", 5, "z"), event("d", 7, "z"), event("c", "null", "old", ts=9)]
BAD = ["plain garbage", '{"op":"c","ts_ms":1,"sou', '{"op":"q","ts_ms":1}', event("c", 8), event("d", 8), "", "[]", '{"op":"c","ts_ms":"text"}']


def test_malformed_events_and_truncates(spark):
    df = spark.createDataFrame([(v,) for v in [*GOOD, *BAD, None]], "value string")
    good, bad = cdc.cdc_read(df)
    assert good.count() == len(GOOD) and sorted(r[0] for r in bad.collect()) == sorted(BAD)
    assert [(r.id, r.amount) for r in cdc.cdc_current_state(good).collect()] == [("y", 2.0)]
    assert cdc.cdc_current_state(good.limit(0)).count() == 0
    no_truncate = good.filter("op <> 't'")
    assert sorted(r.id for r in cdc.cdc_current_state(no_truncate).collect()) == ["gone", "old", "x", "y"]


@pytest.mark.parametrize("seed", [1, 2])
def test_change_state_in_any_order(spark, seed):
    """Micro-batches in any order, one of them twice: the same rows."""
    rnd = random.Random(seed)
    events = GOOD + [event(rnd.choice("cud"), 10 + i, f"k{rnd.randrange(6)}", float(i)) for i in range(30)]
    df = spark.createDataFrame([(v,) for v in events], "value string")
    want = sorted(tuple(r) for r in cdc.cdc_current_state(cdc.cdc_parse(df)).collect())
    rnd.shuffle(events)
    state = C.change_state(spark, work_dir(spark, "changes"), buckets=4)
    parts = [events[i::4] for i in range(4)]
    for part in [*parts, parts[1]]:
        state.merge(cdc.newest_by_id(cdc.cdc_parse(spark.createDataFrame([(v,) for v in part], "value string"))))
    assert sorted(tuple(r) for r in C.read_current_state(state).collect()) == want


def test_stream_sets_malformed_apart(spark):
    src, bad, ck = (work_dir(spark, n) for n in ("ev", "bad", "ck"))
    for i, part in enumerate(([*GOOD[:4], *BAD[:4]], [*GOOD[4:], *BAD[4:]])):
        spark.createDataFrame([(v,) for v in part], "value string").coalesce(1).write.mode("append").parquet(src)
    state = C.change_state(spark, work_dir(spark, "st"), buckets=2)
    stream = spark.readStream.schema("value string").option("maxFilesPerTrigger", 1).parquet(src)
    C.keep_current_state(stream, state, bad, ck, trigger={"availableNow": True}).awaitTermination()
    assert [r.id for r in C.read_current_state(state).collect()] == ["y"]
    assert sorted(r[0] for r in spark.read.parquet(bad).select("_corrupt").collect()) == sorted(BAD)


def test_ledger_insert_has_a_defined_winner(spark):
    import uuid

    from tollgate.schema import TRANSFER

    name = f"ledger_{uuid.uuid4().hex[:10]}"
    LT.create_ledger(spark, name, work_dir(spark, "ledger-table"))
    try:
        batch = [("a", "s", "t", "coro", "easy", 1.0, 9), ("a", "s", "t", "coro", "easy", 2.0, 5), ("a", "r", "t", "coro", "easy", 2.0, 5)] + [(f"i{i}", "s", "t", "coro", "easy", 1.0, i) for i in range(50)]
        df = spark.createDataFrame(batch, TRANSFER)
        LT.insert_ledger(spark, name, df.limit(20))  # as an attempt that wrote a part would leave it
        for _ in range(2):
            LT.insert_ledger(spark, name, df)
        LT.insert_ledger(spark, name, spark.createDataFrame([("a", "z", "t", "coro", "easy", 3.0, 1)], TRANSFER))
        got = LT.read_ledger(spark, name)
        assert got.count() == 51 and [tuple(r) for r in got.filter("id = 'a'").select("from_id", "amount", "timestamp").collect()] == [("r", 2.0, 5)]
        plan = spark.table(name).filter("bucket in (1, 2)").select("id")._jdf.queryExecution().toString()
        assert "PartitionFilters: [bucket" in plan
    finally:
        LT.drop_ledger(spark, name)


def test_repeats_and_late_rows_of_a_stream(spark):
    from tollgate.schema import TRANSFER
    from tollgate.streaming.driver import once_each
    from tollgate.streaming.queries import _order_by_name, _to_parquet

    src, out, ck = (work_dir(spark, n) for n in ("rep-src", "rep-out", "rep-ck"))
    row = lambda i, t: (i, "s", "t", "coro", "easy", 1.0, t)
    for n, part in enumerate(([row("a", 1000), row("b", 2000), row("a", 1000)], [row("b", 2000), row("c", 90_000)], [row("d", 95_000)], [row("late", 3000)])):
        spark.createDataFrame(part, TRANSFER).coalesce(1).write.parquet(f"{src}/b{n}")
    _order_by_name(spark, src)
    stream = spark.readStream.schema(TRANSFER).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(src)
    q = _to_parquet(once_each(stream, delay="10 seconds"), out, ck)
    q.awaitTermination()
    assert sorted(r.id for r in spark.read.parquet(out).collect()) == ["a", "b", "c", "d"]
    assert sum(o.numRowsDroppedByWatermark for p in q.recentProgress for o in p.stateOperators) == 1
