"""Change events and keyed tables: tasks and files grow in number, not in size."""

from datetime import datetime, timedelta

import pytest

from tollgate.session import work_dir
from tollgate.sinks.keyed_table import KeyedTable
from tollgate.sources import events as EV
from tollgate.staging.change_events import change_events, with_faults
from tollgate.streaming import queries as SQ
from tollgate.sources.cdc import cdc_current_state, cdc_read


@pytest.fixture
def small_tasks(spark):
    """Adaptive execution as it acts on large data."""
    name = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(name, "16k")
    yield
    spark.conf.unset(name)


def test_change_events_are_staged_in_files_by_size(spark, small_tasks, monkeypatch):
    d = work_dir(spark, "t-spread")
    kinds = ["click", "purchase", "error"]
    rows = [(i, datetime(2024, 1, 1) + timedelta(minutes=i), i % 37, kinds[i % 3], i / 4, "{}") for i in range(6000)]
    spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string").write.parquet(f"{d}/events.parquet")
    files, order = [], SQ._order_by_name
    monkeypatch.setattr(SQ, "_order_by_name", lambda *a: files.append(order(*a)) or files[-1])
    got = sorted(map(tuple, SQ.q_cdc_state_stream(spark, d).collect()))
    assert files and files[0] > 6
    t = EV.transfers(spark, d)
    good, bad = cdc_read(with_faults(change_events(t), t))
    assert got and got == sorted(map(tuple, cdc_current_state(good).collect()))
    assert sorted(r[0] for r in SQ.q_cdc_malformed_stream(spark, d).collect()) == sorted(r[0] for r in bad.collect())


def test_large_bucket_is_written_by_several_tasks(spark, small_tasks):
    path = work_dir(spark, "t-large-bucket")
    table = KeyedTable(spark, path, "id string, at long, note string", key=["id"], order=["at"], buckets=1)
    rows = spark.range(20_000).selectExpr("cast(id as string) id", "id at", "sha2(cast(id as string), 256) note")
    table.merge(rows)
    table.merge(rows.selectExpr("id", "at + 1 at", "note").limit(500))
    assert len(spark.read.parquet(path).inputFiles()) > 1
    assert table.read().count() == 20_000
    assert table.read().selectExpr("sum(at - cast(id as long))").first()[0] == 500
