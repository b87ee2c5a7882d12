"""A sender holding a third of all rows and never idle for a cooldown: results
must equal brute force."""

import random

from tollgate.operators import history, throttle as TH
from tollgate.schema import TRANSFER

from test_throttle_property import brute


def skewed_rows(seed=11):
    rnd = random.Random(seed)
    rows, t = [], 0
    for i in range(1500):  # hot sender: a request every 100..700 ms
        t += rnd.randrange(100, 700)
        rows.append((f"h{i:05d}", "hot", "x", "coro", "easy", 1.0, t))
    for i in range(1200):
        rows.append((f"c{i:05d}", f"u{rnd.randrange(300)}", "x", "coro", "easy", 1.0, rnd.randrange(t)))
    return rows


def test_hot_sender_throttle(spark):
    rows = skewed_rows()
    c = 1000  # the hot sender is never idle for a cooldown: one chain over all its rows
    df = spark.createDataFrame(rows, TRANSFER)
    got = {r["id"] for r in TH.throttle(df, c).filter("allowed").collect()}
    assert got == brute(rows, c)


def test_hot_sender_last_request(spark):
    rows = skewed_rows()
    df = spark.createDataFrame(rows, TRANSFER)
    got = {r["id"]: r["last_id"] for r in history.last_request(df).collect()}
    expect = {}
    by = {}
    for r in rows:
        by.setdefault(r[1], []).append(r)
    for rs in by.values():
        prev = None
        for r in sorted(rs, key=lambda r: (r[6], r[0])):
            expect[r[0]] = prev
            prev = r[0]
    assert got == expect
