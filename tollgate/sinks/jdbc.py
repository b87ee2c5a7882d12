"""Batched JDBC insert of accepted transfers (per micro-batch in streaming).

Not exercised in this repository's tests: that needs a database, and none
is started here. The written timestamp is the transfer's own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from tollgate.sinks.ledger_table import to_ledger_rows

# Column types of the relational ledger for tables Spark creates.
LEDGER_COLUMN_TYPES = (
    "id VARCHAR(50), _from VARCHAR(50), _to VARCHAR(50), pool_id VARCHAR(50), "
    "amount DECIMAL(6,2), timestamp BIGINT"
)


def jdbc_write_options(url: str, table: str = "transfers", batch_size: int = 1000, **extra: str) -> dict:
    opts = {
        "url": url,
        "dbtable": table,
        "batchsize": str(batch_size),
        "createTableColumnTypes": LEDGER_COLUMN_TYPES,
        "isolationLevel": "READ_COMMITTED",
    }
    opts.update({k: str(v) for k, v in extra.items()})
    return opts


def write_ledger_jdbc(transfers: DataFrame, url: str, num_partitions: int | None = None, **kw) -> None:
    """Append transfers; each task opens one connection and inserts in
    batches of ``batch_size``. Failed tasks are retried by Spark (the
    primary key makes a replayed insert fail rather than duplicate)."""
    rows = to_ledger_rows(transfers)
    if num_partitions:
        rows = rows.coalesce(num_partitions)
    rows.write.format("jdbc").mode("append").options(**jdbc_write_options(url, **kw)).save()


def foreach_batch_jdbc(url: str, **kw):
    """``writeStream.foreachBatch`` callback appending each micro-batch."""

    def _write(batch: DataFrame, batch_id: int) -> None:
        write_ledger_jdbc(batch, url, **kw)

    return _write
