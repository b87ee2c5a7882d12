"""Previous request of the same sender (``last_request``).

A plain ``lag`` over ``Window.partitionBy(sender)`` puts a hot sender's whole
history into one task. Instead the rows are range-partitioned by (sender, time,
id) and written once with their range's number; the window runs inside (sender,
range), and only the first row of a range takes its predecessor from a small
table of one row per (sender, range). A range holds about as many rows as any
other, however they fall on senders and minutes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def last_request(
    df: DataFrame,
    key: str = "from_id",
    ts: str = "timestamp",
    id_col: str = "id",
    out_col: str = "last_id",
    seeds: DataFrame | None = None,
    only: str | None = None,
    ts_out_col: str | None = None,
) -> DataFrame:
    """Attach the id of the sender's previous request in ``(ts, id)`` order;
    the first request of a sender gets NULL (or the seed's id: ``seeds`` has
    columns ``key, last_id`` carried from earlier micro-batches).

    ``only``: name of a boolean column; then only rows where it is true count
    as requests to remember (the others still get the previous one attached).
    ``ts_out_col``: also attach the previous request's timestamp (seeds then
    need a ``last_ts`` column). Building the plan runs one job: the rows are
    checkpointed with their ranges, which must not change between two reads."""
    dealt = df.repartitionByRange(key, ts, id_col).withColumn("_lb", F.spark_partition_id().cast("long"))
    d = dealt.checkpoint(eager=True)
    keep = F.lit(True) if only is None else F.col(only)
    # previous request as (ts, id) struct: carries its time along with its id
    cand = F.when(keep, F.struct(F.col(ts).alias("t"), F.col(id_col).alias("i")))
    d = d.withColumn("_cand", cand)
    w_in = (
        Window.partitionBy(key, "_lb").orderBy(F.col(ts), F.col(id_col)).rowsBetween(Window.unboundedPreceding, -1)
    )
    d = d.withColumn("_prev_in", F.last("_cand", ignorenulls=True).over(w_in))

    # the struct orders by (ts, id): max is the range's last request
    per_bucket = d.groupBy(key, "_lb").agg(F.max("_cand").alias("_bucket_last"))
    if seeds is not None:
        seed_ts = F.col("last_ts") if "last_ts" in seeds.columns else F.lit(None).cast(df.schema[ts].dataType)
        seed_rows = seeds.select(
            F.col(key),
            F.lit(-(2**62)).cast("long").alias("_lb"),
            F.struct(seed_ts.alias("t"), F.col("last_id").alias("i")).alias("_bucket_last"),
        )
        per_bucket = per_bucket.unionByName(seed_rows)
    w_b = Window.partitionBy(key).orderBy("_lb").rowsBetween(Window.unboundedPreceding, -1)
    prev_bucket = per_bucket.select(
        key, "_lb", F.last("_bucket_last", ignorenulls=True).over(w_b).alias("_prev_bucket")
    )
    out = d.join(prev_bucket, [key, "_lb"], "left").withColumn(
        "_prev", F.coalesce(F.col("_prev_in"), F.col("_prev_bucket"))
    )
    out = out.withColumn(out_col, F.col("_prev.i"))
    if ts_out_col:
        out = out.withColumn(ts_out_col, F.col("_prev.t"))
    return out.drop("_lb", "_cand", "_prev_in", "_prev_bucket", "_prev")
