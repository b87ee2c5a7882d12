"""The relational ledger as a Spark table: create, insert, read, drop.

Column names follow the relational form (``_from``, ``_to``, amount
``DECIMAL(6,2)``, no pool type). Spark does not enforce the primary key:
``insert_ledger`` does. The table is partitioned by a hash of the id, so that an
insert looks for present ids only in the partitions that it has ids of.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tollgate.schema import LEDGER_TABLE_DDL


#: Partitions of the table, by a hash of the id; fixed for a table's lifetime.
BUCKETS = 16


def create_ledger(spark: SparkSession, name: str, location: str | None = None) -> None:
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({LEDGER_TABLE_DDL}, bucket INT) USING parquet PARTITIONED BY (bucket){loc}")


def drop_ledger(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def to_ledger_rows(transfers: DataFrame) -> DataFrame:
    return transfers.select(
        "id",
        F.col("from_id").alias("_from"),
        F.col("to_id").alias("_to"),
        "pool_id",
        F.col("amount").cast("decimal(6,2)").alias("amount"),
        "timestamp",
    )


def insert_ledger(spark: SparkSession, name: str, transfers: DataFrame) -> None:
    """Append the transfers whose id the table does not have. Of several with
    one id, the earliest stays (of equal times, the least in all columns).

    Replaying an insert, whole or in part, changes nothing: Spark commits the
    files of an insert together, and rows that are there are not written again.
    One writer at a time."""
    cols = [c for c in spark.table(name).columns if c != "bucket"]
    rest = [c for c in cols if c not in ("id", "timestamp")]
    one = to_ledger_rows(transfers).groupBy("id").agg(F.min(F.struct("timestamp", *rest)).alias("_row")).select("id", "_row.*")
    new = one.select(*cols, F.pmod(F.xxhash64("id"), F.lit(BUCKETS)).cast("int").alias("bucket")).checkpoint(eager=True)
    touched = [r.bucket for r in new.select("bucket").distinct().collect()]  # a number a bucket at most
    there = spark.table(name).filter(F.col("bucket").isin(touched)).select("bucket", "id")
    new.join(there, ["bucket", "id"], "left_anti").select(*cols, "bucket").repartition("bucket").write.insertInto(name)


def read_ledger(spark: SparkSession, name: str) -> DataFrame:
    """The table in our column names (amount back to double)."""
    return spark.table(name).select(
        "id",
        F.col("_from").alias("from_id"),
        F.col("_to").alias("to_id"),
        "pool_id",
        F.col("amount").cast("double").alias("amount"),
        "timestamp",
    )
