"""Has the sender's previous request reached the ledger? (mark join)

``in_sync`` is true when there is no previous request, else true iff a
visible ledger row carries the previous request's id. The ledger snapshot
is always visible; a request this job itself sent to the ledger becomes
visible ``ingest_delay_ms`` after its own timestamp (the ledger ingests the
topic with a delay). The previous request's timestamp comes with its id
from ``last_request``, so no self join of the requests is needed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tollgate.operators.filters import split_flag
from tollgate.schema import TRANSFER_IN_PROGRESS


def visible_ids(ledger: DataFrame) -> DataFrame:
    """Distinct ids of the ledger snapshot (one shuffle of the narrow id column,
    map-side deduplicated)."""
    return ledger.select("id").distinct()


def _marked(df: DataFrame, ledger_ids: DataFrame, last_col: str) -> DataFrame:
    """Mark rows whose previous id is in the ledger. Ids may repeat: they are
    made distinct. Rows without a previous id would be one hot null key: they are
    spread by a hash of the row, and never match. The ids are joined on nothing
    but the id, so that a bucketed table of them stays in place."""
    ids = ledger_ids.select(F.col("id").alias("_sid")).distinct().withColumn("_in_ledger", F.lit(True))
    known = F.col(last_col).isNotNull()
    keyed = df.withColumns({"_has": known, "_key": F.when(known, F.col(last_col)).otherwise(F.hash(*df.columns).cast("string"))})
    return keyed.join(ids, (F.col("_key") == F.col("_sid")) & F.col("_has"), "left").drop("_key", "_has", "_sid")


def _pending_visible(last_ts: str, ts: str, ingest_delay_ms: int | None):
    """The previous request was written to the ledger by this job; it can be
    read back ``ingest_delay_ms`` after its own time (None: not in this batch)."""
    if ingest_delay_ms is None:
        return F.lit(False)
    return F.coalesce(F.col(last_ts) + F.lit(int(ingest_delay_ms)) <= F.col(ts), F.lit(False))


def lookup_row_count(
    df: DataFrame,
    ledger_ids: DataFrame,
    last_col: str = "last_id",
    ts: str = "timestamp",
    last_ts: str = "last_ts",
    ingest_delay_ms: int | None = None,
) -> DataFrame:
    """Per request: how many visible ledger rows carry ``last_id`` (ids are
    unique, so 0 or 1; the existence test of the in-sync check)."""
    m = _marked(df, ledger_ids, last_col)
    seen = F.col(last_col).isNotNull() & (
        F.coalesce(F.col("_in_ledger"), F.lit(False)) | _pending_visible(last_ts, ts, ingest_delay_ms)
    )
    return m.select("id", last_col, F.when(seen, 1).otherwise(0).cast("long").alias("row_count"))


def ledger_in_sync(
    df: DataFrame,
    ledger_ids: DataFrame,
    last_col: str = "last_id",
    ts: str = "timestamp",
    last_ts: str = "last_ts",
    ingest_delay_ms: int | None = None,
    out_col: str = "in_sync",
) -> DataFrame:
    """Attach ``in_sync``: ``last_id IS NULL``, or the ledger has a row with that
    id, or (with an ingest delay) the previous request is old enough to have
    been ingested."""
    m = _marked(df, ledger_ids, last_col)
    ok = (
        F.col(last_col).isNull()
        | F.coalesce(F.col("_in_ledger"), F.lit(False))
        | _pending_visible(last_ts, ts, ingest_delay_ms)
    )
    return m.withColumn(out_col, ok).drop("_in_ledger")


def in_progress_split(df: DataFrame, ledger_ids: DataFrame, error_col: str = "error", **kw) -> DataFrame:
    """``ledger_in_sync`` then route: not in sync -> ``TRANSFER_IN_PROGRESS``."""
    return split_flag(ledger_in_sync(df, ledger_ids, **kw), "in_sync", TRANSFER_IN_PROGRESS, error_col)
