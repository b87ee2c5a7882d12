"""Transfers derived from the driver's ``events`` table.

Mapping (stable across scale factors):
  id        = event_id as text
  from_id   = user_id as text
  to_id     = (event_id * 31 + 7) mod n as text, n = max(user_id) + 1
  pool_id   = 'coro'
  pool_type = click/view -> easy, purchase/signup -> medium, error -> hard
  amount    = value
  timestamp = epoch ms of ts
Where a query needs both sides, the ledger is the first half of the events'
time span and the requests are the rest; the split point comes from the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tollgate.functions.columns import epoch_ms_ntz
from tollgate.schema import DEFAULT_POOL_ID


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def transfers_from_events(events: DataFrame, where=None) -> DataFrame:
    """Project ``events`` onto the transfer schema (one row per event).

    ``where`` filters the physical ``ts`` column before projecting, so the
    filter reaches the Parquet scan; ``n`` is always taken over all events.
    """
    # n is a scalar subquery: one tiny aggregate job, its value inlined.
    n = events.select((F.max("user_id") + 1).alias("n")).scalar()
    if where is not None:
        events = events.filter(where)
    pool_type = (
        F.when(F.col("event_type").isin("click", "view"), F.lit("easy"))
        .when(F.col("event_type").isin("purchase", "signup"), F.lit("medium"))
        .when(F.col("event_type") == "error", F.lit("hard"))
    )
    return events.select(
        F.col("event_id").cast("string").alias("id"),
        F.col("user_id").cast("string").alias("from_id"),
        ((F.col("event_id") * 31 + 7) % n).cast("string").alias("to_id"),
        F.lit(DEFAULT_POOL_ID).alias("pool_id"),
        pool_type.alias("pool_type"),
        F.col("value").alias("amount"),
        epoch_ms_ntz("ts").alias("timestamp"),
    )


def transfers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transfers_from_events(read_table(spark, sf_dir, "events"))


def split_ms(spark: SparkSession, sf_dir: str) -> int:
    """Epoch ms halfway between the first and the last event (one small
    aggregate; 0 for an empty table)."""
    ts = epoch_ms_ntz("ts")
    r = read_table(spark, sf_dir, "events").agg(F.min(ts).alias("a"), F.max(ts).alias("b")).first()
    return 0 if r.a is None else (r.a + r.b) // 2


def _at(ms: int):
    """The wall clock of an epoch ms, as a literal that reaches the scan."""
    from datetime import datetime, timedelta

    return F.lit(str(datetime(1970, 1, 1) + timedelta(milliseconds=ms))).cast("timestamp_ntz")


def ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger side of a two-sided query: events before the split."""
    # ts < split  <=>  floor(epoch ms) < split, since the split is whole ms
    return transfers_from_events(read_table(spark, sf_dir, "events"), F.col("ts") < _at(split_ms(spark, sf_dir)))


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The request side of a two-sided query: events from the split on."""
    return transfers_from_events(read_table(spark, sf_dir, "events"), F.col("ts") >= _at(split_ms(spark, sf_dir)))
