"""Event time for streams, and the ledger's ingestion: topic (or message files)
-> Parquet ledger, appended. The validation chain is ``tollgate.streaming.job``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tollgate.functions.columns import event_time
from tollgate.schema import TRANSFER_COLUMNS
from tollgate.sinks.ledger_segments import POSITION, LedgerSegments
from tollgate.sources.messages import parse_transfers, read_messages

_TC = list(TRANSFER_COLUMNS)


def with_event_time(df: DataFrame, ms_col: str = "timestamp", out_col: str = "event_ts", delay: str = "0 seconds") -> DataFrame:
    """Event time from the epoch-ms column, with a watermark for in-order
    (monotonous) timestamps; see :func:`once_each`."""
    return df.withColumn(out_col, event_time(ms_col)).withWatermark(out_col, delay)


def once_each(stream: DataFrame, id_col: str = "id", ms_col: str = "timestamp", delay: str = "1 hour") -> DataFrame:
    """Each request once: topics deliver at least once. Ids are remembered until
    the watermark, ``delay`` behind the newest time, has passed them by as much;
    a repeat within that is dropped, and so is a row that comes later than the
    watermark of the micro-batch before (Spark counts these as
    ``numRowsDroppedByWatermark``)."""
    return with_event_time(stream, ms_col, "_event", delay).dropDuplicatesWithinWatermark([id_col]).drop("_event")


def _messages(spark: SparkSession, source: str, fmt: str, options: dict | None, max_per_trigger: int | None) -> DataFrame:
    opts = dict(options or {})
    if max_per_trigger:  # files are the unit of file sources
        opts.setdefault("maxOffsetsPerTrigger" if fmt == "kafka" else "maxFilesPerTrigger", str(max_per_trigger))
    return read_messages(spark, source, fmt, opts, starting_offsets="earliest" if fmt == "kafka" else None, streaming=True)


def ledger_ingest(
    spark: SparkSession,
    source: str,
    sink: str,
    checkpoint: str,
    fmt: str = "json",
    options: dict | None = None,
    trigger: dict | None = None,
    max_per_trigger: int | None = None,
    quarantine: str | None = None,
):
    """Continuously append the topic's JSON transfers to a Parquet ledger,
    from the earliest offset. ``fmt="kafka"``: ``source`` is the topic;
    otherwise ``source`` is a folder of message files (format ``fmt``).
    Rows become queryable per micro-batch (default trigger 10 s, as many
    messages as there are unless ``max_per_trigger`` says how many); pass
    ``trigger={"availableNow": True}`` for a catch-up run.

    Malformed messages are never dropped: a second query on the same source,
    with its own checkpoint, appends their text to ``quarantine`` (default: the
    sink's path with ``-quarantine``); both file sinks are exactly-once. Returns
    ``(ledger_query, quarantine_query)``."""
    parsed = parse_transfers(_messages(spark, source, fmt, options, max_per_trigger))

    def start(df: DataFrame, path: str, ck: str):
        w = df.writeStream.format("parquet").option("path", path).option("checkpointLocation", ck).outputMode("append")
        return w.trigger(**(trigger or {"processingTime": "10 seconds"})).start()

    main_q = start(parsed.filter(F.col("_corrupt").isNull()).select(*_TC), sink, checkpoint)
    quarantine = quarantine or sink.rstrip("/") + "-quarantine"
    bad = parsed.filter(F.col("_corrupt").isNotNull()).select(F.col("_corrupt").alias("value"))
    return main_q, start(bad, quarantine, checkpoint.rstrip("/") + "-quarantine")


def ledger_ingest_segments(
    spark: SparkSession,
    source: str,
    table: LedgerSegments,
    quarantine: str,
    checkpoint: str,
    fmt: str = "json",
    options: dict | None = None,
    trigger: dict | None = None,
    max_per_trigger: int | None = None,
):
    """As :func:`ledger_ingest`, into a table in day partitions whose segments
    close by rows or by age. A replayed micro-batch adds nothing. Malformed
    messages go to ``quarantine``, a folder for each micro-batch, which a replay
    writes anew. Returns the query."""
    parsed = parse_transfers(_messages(spark, source, fmt, options, max_per_trigger), keep=POSITION)

    def add(batch: DataFrame, batch_id: int) -> None:
        # Parsed once for both outputs.
        batch = batch.checkpoint(eager=True)
        bad = batch.filter(F.col("_corrupt").isNotNull()).select(F.col("_corrupt").alias("value"))
        bad.write.mode("overwrite").parquet(f"{quarantine.rstrip('/')}/batch_id={batch_id}")
        table.append(batch.filter(F.col("_corrupt").isNull()).drop("_corrupt"), batch_id)

    w = parsed.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint)
    return w.trigger(**(trigger or {"processingTime": "10 seconds"})).start()
