"""Partitioned JDBC scan of the relational ledger.

Not exercised in this repository's tests: that needs a database, and none
is started here (not even an embedded one).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def jdbc_read_options(
    url: str,
    lower_bound: int,
    upper_bound: int,
    table: str = "transfers",
    partition_column: str = "timestamp",
    num_partitions: int = 5,
    fetch_size: int = 10_000,
    **extra: str,
) -> dict:
    """Options for a parallel scan: ``num_partitions`` range queries on the
    numeric ``partition_column``. The bounds only set the stride and no row is
    lost, but they must be near the column's least and greatest value, or one
    task reads nearly everything: they have no default."""
    opts = {
        "url": url,
        "dbtable": table,
        "partitionColumn": partition_column,
        "lowerBound": str(lower_bound),
        "upperBound": str(upper_bound),
        "numPartitions": str(num_partitions),
        "fetchsize": str(fetch_size),
        "pushDownPredicate": "true",
        "pushDownAggregate": "true",
    }
    opts.update({k: str(v) for k, v in extra.items()})
    return opts


def scan_ledger_jdbc(spark: SparkSession, url: str, **kw) -> DataFrame:
    """Ledger rows from a JDBC table (``id, _from, _to, pool_id, amount,
    timestamp``) in our column names; filters on them are pushed down."""
    df = spark.read.format("jdbc").options(**jdbc_read_options(url, **kw)).load()
    return df.select(
        F.col("id").cast("string").alias("id"),
        F.col("_from").cast("string").alias("from_id"),
        F.col("_to").cast("string").alias("to_id"),
        F.col("pool_id").cast("string").alias("pool_id"),
        F.col("amount").cast("double").alias("amount"),
        F.col("timestamp").cast("long").alias("timestamp"),
    )
