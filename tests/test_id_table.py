"""The bucketed id table: no exchange of the ledger side, repeats, nulls."""

from __future__ import annotations

import re
import uuid

import pytest

from tollgate.operators import insync
from tollgate.session import work_dir
from tollgate.sinks.id_table import IdTable


@pytest.fixture
def ids(spark):
    t = IdTable(spark, f"ids_{uuid.uuid4().hex[:8]}", work_dir(spark, "ids"), buckets=4)
    yield t
    spark.sql(f"DROP TABLE IF EXISTS {t.name}")


def _in_sync(df, ids):
    return {(r.id, r.in_sync) for r in insync.ledger_in_sync(df, ids).select("id", "in_sync").collect()}


def test_repeats_and_nulls(spark, ids):
    ids.append(spark.createDataFrame([("1",), ("2",), ("2",), (None,)], "id string"))
    ids.append(spark.createDataFrame([("2",), ("3",)], "id string"))
    assert sorted(r.id for r in ids.read().collect()) == ["1", "2", "3"]
    df = spark.createDataFrame([("a", "1"), ("b", "9"), ("c", None), ("d", "2")], "id string, last_id string").selectExpr("*", "0L AS timestamp", "0L AS last_ts")
    assert _in_sync(df, ids.read()) == {("a", True), ("b", False), ("c", True), ("d", True)}


def test_spread_rows_without_a_previous_id_never_match(spark, ids):
    df = spark.createDataFrame([("c", None)], "id string, last_id string").selectExpr("*", "0L AS timestamp", "0L AS last_ts")
    key = df.selectExpr("CAST(hash(id, last_id, timestamp, last_ts) AS string) AS id")
    ids.append(key)
    assert insync.lookup_row_count(df, ids.read()).first().row_count == 0


def test_ledger_side_is_not_exchanged(spark, ids):
    ids.append(spark.range(1000).selectExpr("CAST(id AS string) AS id"))
    df = spark.range(100_000).selectExpr("CAST(id AS string) AS id", "CAST(id + 500 AS string) AS last_id", "0L AS timestamp", "0L AS last_ts")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = insync.ledger_in_sync(df, ids.read())._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 1, plan
    assert re.search(r"Exchange hashpartitioning\(_key", plan), plan
    assert "Bucketed: true" in plan or "SelectedBucketsCount: 4 out of 4" in plan, plan
