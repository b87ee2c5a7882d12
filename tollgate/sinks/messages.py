"""Message sinks: ledger records (key = sender, value = transfer JSON) and
error messages (text) — as DataFrames with the topic frame columns, plus
writers for a real topic or its file twin."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tollgate.functions.columns import error_message, transfer_json
from tollgate.schema import TOPIC_ERRORS, TOPIC_TRANSFERS


def ledger_records(df: DataFrame, topic: str = TOPIC_TRANSFERS) -> DataFrame:
    """``(key, value, topic)``: key = sender id, value = transfer JSON."""
    return df.select(
        F.col("from_id").alias("key"), transfer_json().alias("value"), F.lit(topic).alias("topic")
    )


def error_records(errors: DataFrame, topic: str = TOPIC_ERRORS, error_col: str = "error") -> DataFrame:
    """``(key, value, topic)``: no key, value = ``CODE>Transfer(...)``."""
    return errors.select(
        F.lit(None).cast("string").alias("key"),
        error_message(F.col(error_col)).alias("value"),
        F.lit(topic).alias("topic"),
    )


def write_messages(records: DataFrame, target: str, fmt: str = "parquet", options: dict | None = None) -> None:
    """Write a ``(key, value, topic)`` frame once (batch).

    ``fmt="kafka"`` writes to the topic named per row (needs the connector on
    the classpath and ``kafka.bootstrap.servers`` in ``options``); any file
    format appends files under ``target`` instead (at-least-once, like the
    topic sink)."""
    opts = dict(options or {})
    if fmt == "kafka":
        records.select("key", "value", "topic").write.format("kafka").options(**opts).save()
    else:
        records.write.mode("append").format(fmt).options(**opts).save(target)


def write_errors(errors: DataFrame, target: str, fmt: str = "parquet", options: dict | None = None) -> None:
    """The three error outputs arrive as one frame: a single sink."""
    write_messages(error_records(errors), target, fmt, options)


def write_ledger(df: DataFrame, target: str, fmt: str = "parquet", options: dict | None = None) -> None:
    write_messages(ledger_records(df), target, fmt, options)


def print_sink(df: DataFrame, order_by: str | None = "offset", trigger: dict | None = None):
    """Print every row (debugging), in the order of ``order_by`` if there is such
    a column. Rows come to the driver one partition at a time, none is left
    out. A stream prints each micro-batch so; its query is returned."""
    if df.isStreaming:
        body = df.writeStream.foreachBatch(lambda batch, _: print_sink(batch, order_by))
        return body.trigger(**(trigger or {"processingTime": "10 seconds"})).start()
    if order_by and order_by in df.columns:
        df = df.orderBy(order_by)
    for row in df.toLocalIterator():
        print(*row, sep="\t", flush=True)
