"""The ledger's ids as a bucketed table of the session's catalog.

Ids lie in buckets by Spark's own hash of the id, so that a join or a distinct on
``id`` reads them in place: only the other side of the in-sync check moves. Ids
are appended as the ledger grows; an id that is appended again, as by a replayed
micro-batch, does no harm, since the reader makes ids distinct within buckets.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


class IdTable:
    """``buckets`` belongs to the files: about the ids' final bytes / 200 MB, and a
    multiple of it is a good number of shuffle partitions. ``location``: a shared
    folder, or None for the warehouse."""

    def __init__(self, spark: SparkSession, name: str, location: str | None = None, buckets: int = 64):
        self.spark, self.name, self.buckets = spark, name, buckets
        place = f" LOCATION '{location}'" if location else ""
        spark.sql(f"CREATE TABLE IF NOT EXISTS {name} (id STRING) USING parquet CLUSTERED BY (id) SORTED BY (id) INTO {buckets} BUCKETS{place}")

    def append(self, rows: DataFrame) -> None:
        """Add the ids of ledger rows; null ids are left out, they match nothing.
        Rows are dealt by bucket first: one file a bucket and append."""
        ids = rows.select("id").filter("id IS NOT NULL").distinct().repartition(self.buckets, "id")
        ids.write.insertInto(self.name)

    def read(self) -> DataFrame:
        """The ids, each once; no exchange."""
        return self.spark.table(self.name).distinct()
