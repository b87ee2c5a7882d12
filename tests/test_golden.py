"""Golden rows from the reference's README/sample data and hand-derived cases."""

from pyspark.sql import types as T

from tollgate.functions.columns import error_message, key_greeting, transfer_json
from tollgate.operators import filters, history, insync, ledger as L, rules as R, throttle as TH
from tollgate.schema import TRANSFER
from tollgate.sources import cdc
from tollgate.sources.rules import rules_table

WITH_BALANCE = T.StructType(TRANSFER.fields + [T.StructField("balance", T.DoubleType())])

# The ledger rows and the sample requests must equal the documented examples.
LEDGER_ROWS = [
    ("foo", "a", "b", "coro", None, 10.00, 1234567890),
    ("abcdef", "a", "b", "coro", None, 3.00, 1234567890),
    ("ghijkl", "b", "c", "coro", None, 5.00, 1234567890),
    ("mnopqr", "c", "a", "coro", None, 4.00, 1234567890),
]


def ledger(spark, extra=()):
    return spark.createDataFrame(LEDGER_ROWS + list(extra), TRANSFER)


def as_map(df, k, v):
    return {r[k]: r[v] for r in df.collect()}


def test_account_balance(spark):
    got = as_map(L.balance_sum(ledger(spark)), "account", "balance")
    assert got == {"a": -9.0, "b": 8.0, "c": 1.0}


def test_account_balance_unknown_is_null(spark):
    req = spark.createDataFrame([("r", "zz", "a", "coro", "easy", 1.0, 1)], TRANSFER)
    row = L.balance_per_account(req, ledger(spark)).collect()[0]
    assert row["balance"] is None and row["balance_text"] is None


def test_account_balance_text(spark):
    req = spark.createDataFrame([("r", "a", "b", "coro", "easy", 1.0, 1)], TRANSFER)
    row = L.balance_per_account(req, ledger(spark)).collect()[0]
    assert row["balance"] == -9.0 and row["balance_text"] == "-9.00"


def test_cross_account(spark):
    # 'aaaa' never sent, 'a' received 4
    req = spark.createDataFrame([("r", "aaaa", "a", "coro", "easy", 1.0, 1)], TRANSFER)
    assert L.balance_cross_account(req, ledger(spark)).collect()[0]["balance"] == 4.0


def test_volume_union(spark):
    assert as_map(L.volume_union(ledger(spark)), "account", "volume") == {"a": 17.0, "b": 18.0, "c": 9.0}


def test_volume_union_equal_sides_kept_once(spark):
    extra = [("q", "c", "a", "coro", None, 1.00, 1234567890)]
    got = as_map(L.volume_union(ledger(spark, extra)), "account", "volume")
    assert got["c"] == 5.0  # sent 5 = received 5, UNION keeps one


def test_wired_balance(spark):
    reqs = spark.createDataFrame(
        [
            ("1", "a", "b", "coro", "easy", 1.0, 1),
            ("2", "b", "c", "coro", "easy", 1.0, 1),
            ("3", "c", "a", "coro", "easy", 1.0, 1),
            ("4", "a", "c", "coro", "easy", 1.0, 1),
            ("5", "b", "a", "coro", "easy", 1.0, 1),
            ("6", "c", "b", "coro", "easy", 1.0, 1),
            ("7", "zz", "yy", "coro", "easy", 1.0, 1),
        ],
        TRANSFER,
    )
    got = as_map(L.balance_per_request(reqs, ledger(spark)), "id", "balance")
    assert got == {"1": 0.0, "2": 0.0, "3": 0.0, "4": -8.0, "5": -1.0, "6": 9.0, "7": 0.0}


def test_count_and_point_lookup(spark):
    assert L.ledger_count(ledger(spark)).collect()[0]["n_rows"] == 4
    rows = filters.ledger_point_lookup(ledger(spark), "ghijkl").collect()
    assert len(rows) == 1 and (rows[0]["from_id"], rows[0]["to_id"], rows[0]["amount"]) == ("b", "c", 5.0)


def test_latest_first_order(spark):
    extra = [("new", "a", "b", "coro", None, 1.0, 2000000000)]
    ids = [r["id"] for r in L.ledger_latest_first(ledger(spark, extra)).collect()]
    assert ids == ["new", "abcdef", "foo", "ghijkl", "mnopqr"]


def test_rules_strict_boundary(spark):
    rows = [
        ("m0", "x", "y", "coro", "medium", 1.0, 1, 0.0),
        ("m1", "x", "y", "coro", "medium", 1.0, 1, 0.01),
        ("e0", "x", "y", "coro", "easy", 1.0, 1, -40.0),
        ("h1", "x", "y", "coro", "hard", 1.0, 1, 40.01),
    ]
    df = spark.createDataFrame(rows, WITH_BALANCE)
    got = as_map(R.balance_rule_split(df, rules_table(spark)), "id", "error")
    assert got == {"m0": "INSUFFICIENT_BALANCE", "m1": None, "e0": "INSUFFICIENT_BALANCE", "h1": None}


def test_rules_upsert_last_write_wins(spark):
    rules = spark.createDataFrame([("easy", -40.0, 1), ("easy", -10.0, 2)], "pool_type string, min_balance double, seq long")
    assert as_map(R.rules_latest(rules), "pool_type", "min_balance") == {"easy": -10.0}


def test_missing_rule_refuse(spark):
    df = spark.createDataFrame([("u", "x", "y", "coro", "unknown", 1.0, 1, 100.0)], WITH_BALANCE)
    row = R.balance_rule_split(df, rules_table(spark), on_missing_rule="refuse").collect()[0]
    assert row["error"] == "INSUFFICIENT_BALANCE"


def test_throttle_golden(spark):
    ts = [0, 5000, 19999, 20000, 39000, 40000]
    df = spark.createDataFrame([(f"r{i}", "s", "t", "coro", "easy", 1.0, t) for i, t in enumerate(ts)], TRANSFER)
    got = as_map(TH.throttle(df, 20000), "timestamp", "allowed")
    assert [got[t] for t in ts] == [True, False, False, True, False, True]


def test_throttle_ties_and_independent_senders(spark):
    rows = [("b", "s", "t", "coro", "easy", 1.0, 40000), ("a", "s", "t", "coro", "easy", 1.0, 40000),
            ("c", "s", "t", "coro", "easy", 1.0, 40000), ("z", "other", "t", "coro", "easy", 1.0, 40000)]
    got = as_map(TH.throttle(spark.createDataFrame(rows, TRANSFER), 20000), "id", "allowed")
    assert got == {"a": True, "b": False, "c": False, "z": True}


def test_last_request_and_in_sync(spark):
    reqs = spark.createDataFrame(
        [(f"r{i}", "s", "t", "coro", "easy", 1.0, 1000 * i) for i in (1, 2, 3)], TRANSFER
    )
    led = spark.createDataFrame([("r1", "s", "t", "coro", "easy", 1.0, 1000)], TRANSFER)
    lr = history.last_request(reqs, ts_out_col="last_ts")
    out = insync.in_progress_split(lr, insync.visible_ids(led))
    got = {r["id"]: (r["last_id"], r["in_sync"], r["error"]) for r in out.collect()}
    assert got == {"r1": (None, True, None), "r2": ("r1", True, None), "r3": ("r2", False, "TRANSFER_IN_PROGRESS")}


def test_last_request_across_buckets(spark):
    # previous request lies several (empty) buckets back
    reqs = spark.createDataFrame(
        [("x1", "s", "t", "coro", "easy", 1.0, 10), ("x2", "s", "t", "coro", "easy", 1.0, 10 * 3_600_000 + 5)], TRANSFER
    )
    got = as_map(history.last_request(reqs), "id", "last_id")
    assert got == {"x1": None, "x2": "x1"}


def test_self_transfer_dropped(spark):
    df = spark.createDataFrame([("1", "a", "a", "coro", "easy", 1.0, 1), ("2", "a", "b", "coro", "easy", 1.0, 1)], TRANSFER)
    assert [r["id"] for r in filters.not_self_transfer(df).collect()] == ["2"]


def test_message_texts(spark):
    df = spark.createDataFrame([("foo", "me", "you", "coro", "easy", 12.34, 1620050945000)], TRANSFER)
    r = df.select(transfer_json().alias("j"), error_message("TOO_MANY_REQUESTS").alias("e")).collect()[0]
    assert r["j"] == ('{"id":"foo","fromId":"me","toId":"you","poolId":"coro","poolType":"easy",'
                      '"amount":12.34,"timestamp":1620050945000}')
    assert r["e"] == ("TOO_MANY_REQUESTS>Transfer(id=foo, fromId=me, toId=you, poolId=coro, poolType=easy, "
                      "amount=12.34, timestamp=1620050945000)")


def test_key_greeting(spark):
    df = spark.createDataFrame([("a",), (None,)], "key string")
    assert [r[0] for r in df.select(key_greeting("key")).collect()] == ["Hi a", None]


def test_sample_json_lines(spark, tmp_path):
    from tollgate.sources.messages import read_transfers_file

    p = tmp_path / "transfers_stream.txt"
    p.write_text(
        '{    "id": "foo",    "fromId": "me",    "toId": "you",    "poolId": "coro", "poolType": "easy", "amount": 12.34,   "timestamp": 1620050945000}\n'
        '{    "id": "bar",    "fromId": "you",    "toId": "me",    "poolId": "coro", "poolType": "easy", "amount": 12.35,   "timestamp": 1620050945001}\n'
    )
    rows = read_transfers_file(spark, str(p))[0].orderBy("timestamp").collect()
    assert [(r["id"], r["from_id"], r["amount"]) for r in rows] == [("foo", "me", 12.34), ("bar", "you", 12.35)]


def test_cdc_current_state(spark):
    import json

    def ev(op, lsn, before, after, wrap=False):
        e = {"op": op, "ts_ms": lsn, "source": {"lsn": lsn, "table": "transfers"}, "before": before, "after": after}
        return json.dumps({"schema": {"type": "struct"}, "payload": e} if wrap else e)

    def img(i, amt):
        return {"id": i, "_from": "a", "_to": "b", "pool_id": "coro", "amount": amt, "timestamp": 1}

    vals = [ev("c", 1, None, img("x", 1.0)), ev("u", 2, img("x", 1.0), img("x", 2.0), wrap=True),
            ev("c", 3, None, img("y", 3.0)), ev("d", 4, img("y", 3.0), None, wrap=True)]
    df = spark.createDataFrame([(v,) for v in vals], "value string")
    state = cdc.cdc_current_state(cdc.cdc_parse(df)).collect()
    assert [(r["id"], r["amount"]) for r in state] == [("x", 2.0)]
