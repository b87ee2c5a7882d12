"""The validation job on streams, from the request topic to the ledger topic
and the errors topic. All state is Spark's own:

- ``keep_totals``: the ledger topic's sums per account, a streaming aggregate.
  Its state is the table of totals; ``read_totals`` reads it with Spark's state
  source, one row per account, whatever the length of the ledger. Rows that
  others put on the topic count like the job's own.
- ``validate``: request topic -> throttle (stateful) -> balance -> pool rule.
  Refused requests go to the errors topic, balanced ones to the ledger topic.
  Rules and totals are read anew for every micro-batch, so a rule that changes
  while the stream runs holds from the next micro-batch on.
- ``check_in_sync``: balanced requests -> previous request of the sender
  (stateful, in order of arrival) -> is that one in the ledger table? Late ones
  go to the errors topic.
- ``tollgate.streaming.driver.ledger_ingest`` fills the ledger table.

Each topic may be a folder of message files (its twin). Files of a micro-batch
go to a folder of their own and replace what an earlier attempt at the same
batch left, so a replay changes nothing; a real topic gets them at least once.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tollgate.functions.columns import money
from tollgate.operators.filters import not_self_transfer
from tollgate.operators.insync import in_progress_split
from tollgate.operators.ledger import balance_per_account, balance_per_request
from tollgate.operators.rules import balance_rule_split
from tollgate.schema import DEFAULT_COOLDOWN_MS, MONEY, TOO_MANY_REQUESTS, TRANSFER_COLUMNS
from tollgate.sinks.messages import error_records, ledger_records, write_messages
from tollgate.streaming.stateful import last_request_with_state, throttle_with_state

_TC = list(TRANSFER_COLUMNS)
_EVERY = {"processingTime": "10 seconds"}


def keep_totals(ledger: DataFrame, checkpoint: str, trigger: dict | None = None):
    """Start the sums per account of a stream of ledger rows."""
    nothing = F.lit(None).cast(MONEY)
    sides = F.array(
        F.struct(F.col("from_id").alias("account"), money("amount").alias("sent"), nothing.alias("received")),
        F.struct(F.col("to_id").alias("account"), nothing.alias("sent"), money("amount").alias("received")),
    )
    totals = ledger.select(F.explode(sides).alias("leg")).select("leg.*").groupBy("account").agg(F.sum("sent"), F.sum("received"))
    w = totals.writeStream.outputMode("update").format("noop").option("checkpointLocation", checkpoint)
    return w.trigger(**(trigger or _EVERY)).start()


def read_totals(spark: SparkSession, checkpoint: str) -> DataFrame:
    """``(account, sent, received)`` as of the last finished micro-batch of
    ``keep_totals``; NULL where an account has no such rows."""
    state = spark.read.format("statestore").load(checkpoint)
    total = T.DecimalType(38, MONEY.scale)
    fields = [T.StructField(n, t) for n, t in (("sent", total), ("no_sent", T.BooleanType()), ("received", total), ("no_received", T.BooleanType()))]
    values = state.select("key.account", F.col("value").cast(T.StructType(fields)).alias("v"))
    return values.select(
        "account", F.when(~F.col("v.no_sent"), F.col("v.sent")).alias("sent"), F.when(~F.col("v.no_received"), F.col("v.received")).alias("received"))


def _put(records: DataFrame, target: str, batch_id: int, fmt: str, options: dict | None) -> None:
    """Records of a micro-batch to a topic, or to the batch's own files."""
    if fmt == "kafka":
        write_messages(records, target, fmt, options)
    else:
        records.write.mode("overwrite").format(fmt).options(**(options or {})).save(f"{target.rstrip('/')}/batch_id={batch_id}")


_ADAPTIVE = "spark.sql.adaptive.enabled"


def _each_batch(stream: DataFrame, body: Callable[[DataFrame, int], None], checkpoint: str, trigger: dict | None):
    """Run ``body`` for every micro-batch. Spark turns adaptive execution off in
    a stream's session, for the state's sake; what the body makes of a batch is
    batch work, and gets it back where the caller's session has it (the few rules
    would else be joined by a shuffle to a task a pool type)."""
    adaptive = stream.sparkSession.conf.get(_ADAPTIVE)

    def run(batch: DataFrame, batch_id: int) -> None:
        conf = batch.sparkSession.conf
        stream_has = conf.get(_ADAPTIVE)
        conf.set(_ADAPTIVE, adaptive)
        batch = batch.persist()
        try:
            body(batch, batch_id)
        finally:
            batch.unpersist()
            conf.set(_ADAPTIVE, stream_has)

    return stream.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint).trigger(**(trigger or _EVERY)).start()


def validate(
    requests: DataFrame,
    rules: Callable[[SparkSession], DataFrame],
    totals: Callable[[SparkSession], DataFrame],
    ledger_topic: str,
    errors_topic: str,
    checkpoint: str,
    cooldown_ms: int = DEFAULT_COOLDOWN_MS,
    expire_ms: int | None = None,
    balance_mode: str = "wired",
    on_missing_rule: str = "fail",
    fmt: str = "parquet",
    options: dict | None = None,
    trigger: dict | None = None,
):
    """Start the first half of the chain. ``rules`` and ``totals`` are called
    for every micro-batch. ``expire_ms``: see ``throttle_with_state``."""
    balance = {"wired": balance_per_request, "account": balance_per_account}[balance_mode]

    def body(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        refused = batch.filter(~F.col("allowed")).select(*_TC, F.lit(TOO_MANY_REQUESTS).alias("error"))
        known = totals(spark).persist()  # joined on both sides
        ruled = balance_rule_split(balance(batch.filter("allowed").select(*_TC), None, totals=known), rules(spark), on_missing_rule=on_missing_rule)
        ruled = ruled.select(*_TC, "error").persist()
        try:
            _put(ledger_records(ruled.filter("error is null")), ledger_topic, batch_id, fmt, options)
            _put(error_records(refused.unionByName(ruled.filter("error is not null"))), errors_topic, batch_id, fmt, options)
        finally:
            ruled.unpersist()
            known.unpersist()

    throttled = throttle_with_state(not_self_transfer(requests.select(*_TC)), cooldown_ms, expire_ms=expire_ms)
    return _each_batch(throttled, body, checkpoint, trigger)


def check_in_sync(
    balanced: DataFrame,
    ledger_ids: Callable[[SparkSession], DataFrame],
    accepted_topic: str,
    errors_topic: str,
    checkpoint: str,
    fmt: str = "parquet",
    options: dict | None = None,
    trigger: dict | None = None,
):
    """Start the second half: accepted transfers, and TRANSFER_IN_PROGRESS
    errors. ``ledger_ids`` is called for every micro-batch and gives a frame
    with the ledger's ``id``s as they are then."""

    def body(batch: DataFrame, batch_id: int) -> None:
        checked = in_progress_split(batch.withColumn("last_ts", F.lit(None).cast("long")), ledger_ids(batch.sparkSession))
        checked = checked.select(*_TC, "error").persist()
        try:
            _put(ledger_records(checked.filter("error is null")), accepted_topic, batch_id, fmt, options)
            _put(error_records(checked.filter("error is not null")), errors_topic, batch_id, fmt, options)
        finally:
            checked.unpersist()

    return _each_batch(last_request_with_state(balanced.select(*_TC)), body, checkpoint, trigger)
