"""Segments close by rows or age, replays add nothing, readers see a swap whole."""

from __future__ import annotations

import uuid

import pytest
from pyspark.sql import functions as F

from tollgate.session import work_dir
from tollgate.sinks.ledger_segments import LedgerSegments

DAY = 86_400_000
SCHEMA = "id string, from_id string, to_id string, pool_id string, pool_type string, amount double, timestamp long, partition int, offset long"


def _rows(spark, offsets, day=0, partition=0):
    data = [(f"r{o}", "a", "b", "p", "easy", 1.0, None if day is None else day * DAY + o, partition, o) for o in offsets]
    return spark.createDataFrame(data, SCHEMA)


@pytest.fixture
def table(spark):
    now = [0]
    name = f"segments_{uuid.uuid4().hex[:8]}"
    t = LedgerSegments(spark, name, work_dir(spark, "segments"), flush_rows=10, flush_ms=1000, clock=lambda: now[0])
    t.now = now
    yield t
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def _ids(t):
    return sorted(r.id for r in t.read().select("id").collect())


def _files(t, day, segment):
    return {r.f for r in t.spark.table(t.name).filter((F.col("day") == day) & (F.col("segment") == segment)).select(F.input_file_name().alias("f")).collect()}


def test_closed_by_rows(spark, table):
    for b in range(4):
        table.append(_rows(spark, range(b * 4, b * 4 + 4)), b)
    # 4 + 4 + 4 rows lie in segment 0 when the fourth batch comes
    assert table.segments() == [("1970-01-01", 0, True), ("1970-01-01", 1, False)]
    assert _ids(table) == sorted(f"r{o}" for o in range(16))
    assert len(_files(table, "1970-01-01", 0)) == 2  # 12 rows, 10 a file
    assert table.sweep() == 1 and table.sweep() == 0
    assert _ids(table) == sorted(f"r{o}" for o in range(16))


def test_closed_by_age(spark, table):
    table.append(_rows(spark, [1]), 0)
    table.now[0] = 999
    table.append(_rows(spark, [2]), 1)
    assert table.segments() == [("1970-01-01", 0, False)]
    table.now[0] = 1000
    table.append(_rows(spark, [3], day=1), 2)
    assert table.segments() == [("1970-01-01", 0, True), ("1970-01-02", 0, False)]
    assert _ids(table) == ["r1", "r2", "r3"]


def test_replay_adds_only_what_is_missing(spark, table):
    table.append(_rows(spark, range(12)), 0)
    table.append(_rows(spark, range(12)), 0)  # due by rows, but it is this batch's own
    assert table.segments() == [("1970-01-01", 0, False)]
    table.append(_rows(spark, [12, 13]), 1)  # a part of batch 1 ...
    table.append(_rows(spark, range(12, 16)), 1)  # ... and all of it
    assert table.segments() == [("1970-01-01", 0, True), ("1970-01-01", 1, False)]
    assert _ids(table) == sorted(f"r{o}" for o in range(16))


def test_same_offset_in_another_partition_or_day_is_another_row(spark, table):
    table.append(_rows(spark, [5]).unionByName(_rows(spark, [5], partition=1)).unionByName(_rows(spark, [5], day=None, partition=2)), 0)
    assert table.read().count() == 3
    assert {s[0] for s in table.segments()} == {"1970-01-01", "none"}


def test_a_reader_that_began_before_a_close(spark, table):
    table.append(_rows(spark, range(10)), 0)
    before = table.read()
    n = before.count()
    table.close_due(everything=True)
    assert before.count() == n == table.read().count() == 10


def test_empty_batch(spark, table):
    table.append(_rows(spark, [1]).limit(0), 0)
    assert table.segments() == [] and table.read().count() == 0


def test_day_filter_prunes_folders(spark, table):
    table.append(_rows(spark, [1]).unionByName(_rows(spark, [2], day=3)), 0)
    plan = table.read().filter("day = '1970-01-04'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan
