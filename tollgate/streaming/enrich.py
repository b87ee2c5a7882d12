"""Ordered enrichment of a stream by lookups that may not be there yet.

Requests and lookup rows arrive on one stream. A request asks for the lookup row
of its id. If it is there, or comes within the timeout, the request is enriched
with it; else it goes out with ``LOOKUP_TIMEOUT``. Every micro-batch asks again
for all that still wait, by one join, so retries need no timer a row. Requests
leave in order of arrival: one that is decided waits behind an earlier one that
is not. What waits is bounded by the requests of one timeout.

Time is the stream's own: the greatest arrival seen. Outcomes do not depend on
how rows fall on micro-batches, since a lookup counts by when it arrived. A row
of kind ``tick`` moves the clock and nothing else.

State is written as files of each micro-batch (what waits, how many went out)
and a keyed table of lookups; a replayed micro-batch starts from the state of
the one before it, and replaces what it wrote.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tollgate.sinks.keyed_table import KeyedTable

LOOKUP_TIMEOUT = "LOOKUP_TIMEOUT"
LOOKUPS = "id string, since long, value double"


def lookup_table(spark: SparkSession, path: str, buckets: int = 16) -> KeyedTable:
    """The first lookup row that came for every id."""
    return KeyedTable(spark, path, LOOKUPS, key=["id"], order=["since", "value"], buckets=buckets, keep="least")


def decide(asked: DataFrame, lookups: DataFrame, now: int, timeout_ms: int) -> DataFrame:
    """Add ``value`` and ``outcome`` (``FOUND``, ``LOOKUP_TIMEOUT``, NULL: waits)."""
    l = lookups.select(F.col("id").alias("_lid"), "since", F.col("value").alias("_value"))  # noqa: E741
    deadline = F.col("arrival") + F.lit(timeout_ms)
    found = F.coalesce(F.col("since") <= deadline, F.lit(False))
    outcome = F.when(found, "FOUND").when(F.col("since").isNotNull() | (deadline < F.lit(now)), LOOKUP_TIMEOUT)
    j = asked.join(l, F.col("id") == F.col("_lid"), "left")
    return j.select(*asked.columns, F.when(found, F.col("_value")).alias("value"), outcome.alias("outcome"))


def numbered(rows: DataFrame, order: list[str], start: int, out: str = "position") -> DataFrame:
    """Number rows from ``start`` in order, by ranges: no task holds them all."""
    dealt = rows.repartitionByRange(*order).withColumn("_p", F.spark_partition_id()).checkpoint(eager=True)
    sizes = dealt.groupBy("_p").agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("_n")  # a row a range
    own = F.row_number().over(Window.partitionBy("_p").orderBy(*order))
    return dealt.withColumn("_own", own).join(sizes.select("_p", before.alias("_before")), "_p").withColumn(
        out, F.lit(start - 1) + F.col("_before") + F.col("_own")).drop("_p", "_own", "_before")


def enrich_in_order(stream: DataFrame, lookups: KeyedTable, state: str, out: str, checkpoint: str, timeout_ms: int, trigger: dict | None = None):
    """Start the enrichment. ``stream``: ``kind`` (``request``, ``lookup``,
    ``tick``), ``arrival``, ``id``, ``value`` (of lookups), and any columns of
    requests. ``out`` gets requests with ``value``, ``outcome``, ``position``."""
    columns = [c for c in stream.columns if c not in ("kind", "value")]

    def body(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch = batch.persist()
        try:
            now = batch.agg(F.max("arrival")).first()[0]
            lookups.merge(batch.filter("kind = 'lookup'").select("id", F.col("arrival").alias("since"), "value"))
            asked, sent = batch.filter("kind = 'request'").select(*columns), 0
            if batch_id:
                asked = asked.unionByName(spark.read.schema(asked.schema).parquet(f"{state}/waiting/batch_id={batch_id - 1}"))
                sent = spark.read.parquet(f"{state}/sent/batch_id={batch_id - 1}").first().sent
            decided = decide(asked, lookups.read(), now, timeout_ms).checkpoint(eager=True)
            first = decided.filter("outcome is null").agg(F.min(F.struct("arrival", "id")).alias("m")).first().m
            ready = F.lit(True) if first is None else F.struct("arrival", "id") < F.struct(F.lit(first.arrival).alias("arrival"), F.lit(first.id).alias("id"))
            leaving = numbered(decided.filter(ready), ["arrival", "id"], sent + 1)
            leaving.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")
            decided.filter(~ready).select(*columns).write.mode("overwrite").parquet(f"{state}/waiting/batch_id={batch_id}")
            n = decided.filter(ready).count()
            spark.range(1).select(F.lit(sent + n).cast("long").alias("sent")).write.mode("overwrite").parquet(f"{state}/sent/batch_id={batch_id}")
        finally:
            batch.unpersist()

    w = stream.writeStream.foreachBatch(body).option("checkpointLocation", checkpoint)
    return w.trigger(**(trigger or {"processingTime": "10 seconds"})).start()
