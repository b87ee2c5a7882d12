"""Component behaviour: quarantine,
missing rules, ledger table primary key, JDBC options, pipeline modes."""

import pytest
from pyspark.sql import functions as F

from tollgate.operators import rules as R
from tollgate.plans.pipeline import transfer_pipeline
from tollgate.schema import TRANSFER
from tollgate.session import work_dir
from tollgate.sinks import ledger_table as LT
from tollgate.sources import events as EV
from tollgate.sources.jdbc import jdbc_read_options
from tollgate.sources.messages import parse_transfers, quarantine
from tollgate.sources.rules import rules_table

SF = "/root/testdata/sf0.001"


def test_quarantine_malformed_json(spark):
    good = '{"id":"a","fromId":"x","toId":"y","poolId":"coro","poolType":"easy","amount":1.5,"timestamp":7}'
    wrong = good.replace("1.5", '"abc"')
    df = spark.createDataFrame([(good,), ("{not json",), ('{"fromId":"x"}',), (wrong,), (None,)], "value string")
    ok, bad = quarantine(parse_transfers(df))
    assert [r["id"] for r in ok.collect()] == ["a"]
    assert sorted(r["_corrupt"] for r in bad.collect()) == sorted(["", '{"fromId":"x"}', "{not json", wrong])


def test_small_amounts_are_not_rounded(spark):
    from tollgate.operators import ledger as L

    df = spark.createDataFrame([(str(i), "a", "b", "coro", "easy", 0.004, i) for i in range(1000)], TRANSFER)
    assert L.sent_by_account(df).collect()[0]["credit"] == -4.0


def test_rules_without_an_order_are_refused(spark):
    rows = [("easy", 1.0, None), ("hard", 2.0, 3)]
    df = spark.createDataFrame(rows, "pool_type string, min_balance double, seq long")
    with pytest.raises(Exception, match="without an order"):
        R.rules_latest(df).collect()
    with pytest.raises(Exception, match="several rules"):
        R.rules_latest(df.unionByName(df).drop("seq")).collect()
    assert {r["pool_type"]: r["min_balance"] for r in R.rules_latest(df.drop("seq")).collect()} == {"easy": 1.0, "hard": 2.0}


def test_change_events_as_emitted(spark):
    from tollgate.sources import cdc

    row = '{"id":"%s","_from":"a","_to":"b","pool_id":"coro","amount":%s,"timestamp":1}'
    ev = '{"op":"%s","ts_ms":%d,"source":{"lsn":%s,"table":"transfers"},"before":null,"after":%s}'
    sent = [("1", '"A+g="', 10.0), ("2", '"/Bg="', -10.0), ("3", "12.5", 12.5), ("4", '"12.50"', 12.5), ("5", "7", 7.0), ("6", '"AA=="', 0.0)]
    values = [(ev % ("c", 5, "9", row % (i, a)),) for i, a, _ in sent] + [(None,), (ev % ("r", 1, "null", row % ("7", "1.0")),),
              (ev % ("c", 1, "null", row % ("8", "1.0")),), (ev % ("u", 2, "null", row % ("8", "2.0")),)]
    parsed = cdc.cdc_parse(spark.createDataFrame(values, "value string"))
    got = {r["id"]: r["amount"] for r in cdc.cdc_current_state(parsed).collect()}
    assert got == {**{i: x for i, _, x in sent}, "7": 1.0, "8": 2.0}


def test_repeated_ledger_ids_do_not_multiply(spark):
    from tollgate.operators import insync

    df = spark.createDataFrame([("r", "x", 5, 1), ("s", None, 5, None)], "id string, last_id string, timestamp long, last_ts long")
    ids = spark.createDataFrame([("x",), ("x",), (None,)], "id string")
    assert sorted((r["id"], r["in_sync"]) for r in insync.ledger_in_sync(df, ids).collect()) == [("r", True), ("s", True)]


def test_print_sink_prints_every_row(spark, capfd):
    from tollgate.sinks.messages import print_sink

    print_sink(spark.range(50).withColumnRenamed("id", "offset"))
    assert capfd.readouterr().out.split() == [str(i) for i in range(50)]


def test_message_writers(spark):
    from tollgate.sinks import messages as S

    out = work_dir(spark, "t-messages")
    rows = spark.createDataFrame([("u", "x", "y", "coro", "easy", 1.5, 1)], TRANSFER)
    S.write_ledger(rows, f"{out}/ledger")
    S.write_errors(rows.withColumn("error", F.lit("TOO_MANY_REQUESTS")), f"{out}/errors")
    got = spark.read.parquet(f"{out}/ledger").collect()
    assert [(r["key"], r["topic"]) for r in got] == [("x", "transfers_4")] and '"amount":1.5' in got[0]["value"]
    got = spark.read.parquet(f"{out}/errors").collect()
    assert [(r["key"], r["topic"]) for r in got] == [(None, "houston")] and got[0]["value"].startswith("TOO_MANY_REQUESTS>Transfer(id=u,")


def test_rule_passthrough_and_event_time(spark):
    from tollgate.operators.filters import rule_passthrough
    from tollgate.streaming.driver import with_event_time

    same, seen = rule_passthrough(rules_table(spark))
    assert sorted(map(tuple, same.collect())) == sorted(map(tuple, rules_table(spark).collect()))
    assert seen.get["n_rules"] == 3
    df = with_event_time(spark.createDataFrame([(1_705_320_000_123,)], "timestamp long"))
    assert df.selectExpr("unix_millis(event_ts) as ms").collect()[0]["ms"] == 1_705_320_000_123


def test_work_folders_need_a_shared_place_off_local_masters(monkeypatch):
    from types import SimpleNamespace as N

    from tollgate.session import ensure_checkpoint_dir

    sc = N(master="spark://host:7077", getCheckpointDir=lambda: None, getConf=lambda: {})
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(N(sparkContext=sc, conf={}))


def test_missing_rule_fails_by_default(spark):
    df = spark.createDataFrame([("u", "x", "y", "coro", "unknown", 1.0, 1)], TRANSFER).withColumn("balance", F.lit(5.0))
    with pytest.raises(Exception):
        R.balance_rule_split(df, rules_table(spark)).collect()


def test_ledger_table_keeps_one_row_per_id(spark):
    name = "t_ledger_pk"
    LT.drop_ledger(spark, name)
    LT.create_ledger(spark, name, work_dir(spark, "t-ledger-table"))
    rows = spark.createDataFrame([("1", "a", "b", "coro", "easy", 1.0, 5), ("1", "a", "b", "coro", "easy", 1.0, 5),
                                  ("2", "b", "c", "coro", "easy", 2.5, 6)], TRANSFER)
    LT.insert_ledger(spark, name, rows)
    LT.insert_ledger(spark, name, rows)
    got = sorted((r["id"], r["amount"]) for r in LT.read_ledger(spark, name).collect())
    assert got == [("1", 1.0), ("2", 2.5)]
    LT.drop_ledger(spark, name)


def test_jdbc_options():
    o = jdbc_read_options("jdbc:x://h/db", lower_bound=10, upper_bound=20, num_partitions=5)
    assert o["partitionColumn"] == "timestamp" and o["numPartitions"] == "5" and o["dbtable"] == "transfers"


@pytest.mark.parametrize("mode,ledger_from", [("account", "balanced"), ("wired", "in_sync")])
def test_pipeline_modes(spark, mode, ledger_from):
    res = transfer_pipeline(EV.requests(spark, SF), EV.ledger(spark, SF), rules_table(spark),
                            cooldown_ms=6 * 3_600_000, balance_mode=mode, ledger_from=ledger_from)
    out = res.outcomes.groupBy("error").count().collect()
    n = sum(r["count"] for r in out)
    assert n == EV.requests(spark, SF).filter("from_id <> to_id").count()
    assert res.ledger_records.count() == (res.balanced if ledger_from == "balanced" else res.in_sync).count()
