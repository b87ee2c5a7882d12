"""The ledger in day partitions, in segments that close by rows or by age.

A table of the session's catalog, partitioned by (day, segment). Micro-batches
append small files to the open segment of each of their days, so that rows can be
read at once. When an open segment has enough rows, or its oldest row has waited
long enough, it is closed: its rows are written anew in files of about
``flush_rows``, and ``ALTER TABLE ... SET LOCATION`` points the partition at them in
one step; a reader finds the small files or the large ones, never both. The day's
next rows open the next segment. One writer at a time.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tollgate.schema import TRANSFER_COLUMNS

#: Where a message lies in its topic: what a replay is known by.
POSITION = ("partition", "offset")
FLUSH_ROWS = 50_000
FLUSH_MS = 3_600_000


def _now_ms() -> int:
    return int(time.time() * 1000)


class LedgerSegments:
    """``location``: a shared folder. ``clock``: epoch ms now, for ages."""

    def __init__(self, spark: SparkSession, name: str, location: str, flush_rows: int = FLUSH_ROWS, flush_ms: int = FLUSH_MS, clock: Callable[[], int] = _now_ms):
        if flush_rows < 1 or flush_ms < 0:
            raise ValueError("flush_rows must be positive, flush_ms not negative")
        self.spark, self.name, self.location = spark, name, location.rstrip("/")
        self.flush_rows, self.flush_ms, self.clock = flush_rows, flush_ms, clock
        cols = "id STRING, from_id STRING, to_id STRING, pool_id STRING, pool_type STRING, amount DOUBLE, timestamp BIGINT"
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} ({cols}, `partition` INT, `offset` BIGINT, batch BIGINT, ingested_ms BIGINT, "
            f"day STRING, segment INT) USING parquet PARTITIONED BY (day, segment) LOCATION '{self.location}'"
        )

    def read(self) -> DataFrame:
        """Transfers with their day (UTC); filters on ``day`` prune folders."""
        return self.spark.table(self.name).select(*TRANSFER_COLUMNS, "day")

    def segments(self) -> list[tuple[str, int, bool]]:
        """(day, segment, closed) of each segment, from the catalog."""
        out = []
        for row in self.spark.sql(f"SHOW PARTITIONS {self.name}").collect():
            day, segment = (p.split("=", 1)[1] for p in row.partition.split("/"))
            out.append((day, int(segment), self._is_closed(day, int(segment))))
        return sorted(out)

    def _spec(self, day: str, segment: int) -> str:
        return f"PARTITION (day='{day}', segment={segment})"

    def _is_closed(self, day: str, segment: int) -> bool:
        rows = self.spark.sql(f"DESCRIBE TABLE EXTENDED {self.name} {self._spec(day, segment)}").collect()
        return "/closed/" in next(r.data_type for r in rows if r.col_name == "Location")

    def _open(self) -> list[tuple[str, int]]:
        """The last segment of each day, where it is not closed."""
        self.spark.catalog.refreshTable(self.name)
        last: dict[str, int] = {}
        for row in self.spark.sql(f"SHOW PARTITIONS {self.name}").collect():
            day, segment = (p.split("=", 1)[1] for p in row.partition.split("/"))
            last[day] = max(last.get(day, -1), int(segment))
        self._last = last
        return [(d, s) for d, s in last.items() if not self._is_closed(d, s)]

    def append(self, rows: DataFrame, batch_id: int) -> None:
        """Close what is due, then add a micro-batch: transfers with the columns of
        ``POSITION``. A batch that is appended again, after a whole or a partial
        attempt, adds only the rows that are missing. Segments are closed before
        rows are added, so that a replayed batch never lies in a closed one."""
        open_now = self.close_due(batch_id)
        day = F.date_format(F.timestamp_millis("timestamp"), "yyyy-MM-dd")
        new = rows.withColumns({"batch": F.lit(batch_id).cast("long"), "ingested_ms": F.lit(self.clock()).cast("long"), "day": F.coalesce(day, F.lit("none"))})
        new = new.checkpoint(eager=True)
        days = {r.day for r in new.select("day").distinct().collect()}  # the days of one micro-batch
        if not days:
            return
        target = {d: self._last[d] + (d not in open_now) if d in self._last else 0 for d in days}
        table = self.spark.createDataFrame(sorted(target.items()), "day string, segment int")
        new = new.join(F.broadcast(table), "day")  # a row a day of the batch
        again = [d for d in days if d in open_now]
        if again:
            there = self.spark.table(self.name).filter(F.col("day").isin(again) & (F.col("batch") == batch_id))
            new = new.join(there.select("day", "segment", *POSITION), ["day", "segment", *POSITION], "left_anti")
        cols = self.spark.table(self.name).columns
        new.select(*cols).repartitionByRange("day", *POSITION).write.insertInto(self.name)
        # A micro-batch has a session of its own: this one would go on with the files it knew.
        self.spark.catalog.refreshTable(self.name)

    def close_due(self, before: int | None = None, everything: bool = False) -> dict[str, int]:
        """Close open segments with ``flush_rows`` rows or a row older than
        ``flush_ms`` (``everything``: all). One that has rows of the batch
        ``before`` stays open: that batch is being appended again. Returns the
        segments left open, by day."""
        open_now = dict(self._open())
        if not open_now:
            return {}
        where = self.spark.table(self.name).filter(F.col("day").isin(list(open_now)))
        keys = self.spark.createDataFrame(sorted(open_now.items()), "day string, segment int")
        held = where.join(F.broadcast(keys), ["day", "segment"])  # a row an open segment
        of_replay = F.max("batch") >= (before if before is not None else 2**62)
        sizes = held.groupBy("day", "segment").agg(F.count("*").alias("n"), F.min("ingested_ms").alias("since"), of_replay.alias("replayed"))
        due = sizes.filter(~F.col("replayed") & (F.lit(everything) | (F.col("n") >= self.flush_rows) | (self.clock() - F.col("since") >= self.flush_ms)))
        due_now = [(r.day, r.segment, r.n) for r in due.collect()]  # a row an open segment at most
        if not due_now:
            return open_now
        chunks = self.spark.createDataFrame([(d, s, -(-n // self.flush_rows)) for d, s, n in due_now], "day string, segment int, chunks long")
        closed = f"{self.location}/closed/{uuid.uuid4().hex[:12]}"
        # A day may be hot: its rows are dealt to as many tasks as they make files.
        dealt = where.join(F.broadcast(chunks), ["day", "segment"]).withColumn("chunk", F.pmod(F.xxhash64(*POSITION), F.col("chunks")))
        dealt.repartition("day", "segment", "chunk").drop("chunk", "chunks").write.option("maxRecordsPerFile", self.flush_rows).partitionBy("day", "segment").parquet(closed)
        for day, segment, _ in due_now:
            self.spark.sql(f"ALTER TABLE {self.name} {self._spec(day, segment)} SET LOCATION '{closed}/day={day}/segment={segment}'")
            del open_now[day]
        self.spark.catalog.refreshTable(self.name)
        return open_now

    def sweep(self) -> int:
        """Delete the small files of closed segments, once no reader that began
        before their closing is left. Returns the number of folders deleted."""
        jvm, n = self.spark._jvm, 0
        for day, segment, closed in self.segments():
            old = jvm.org.apache.hadoop.fs.Path(f"{self.location}/day={day}/segment={segment}")
            fs = old.getFileSystem(self.spark._jsc.hadoopConfiguration())
            if closed and fs.exists(old):
                n += bool(fs.delete(old, True))
        return n
