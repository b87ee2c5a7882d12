"""A table with one row a key on plain Parquet files, merged batch by batch.

Rows lie in folders by a hash of the key (``bucket=n``). A merge reads and
replaces only the buckets that the batch has keys of; Spark's dynamic partition
overwrite swaps each of them at commit. Which row of a key stays depends on the
rows alone (the greatest in the order columns, then in all others), so that
merging a batch twice, or after a later one, changes nothing: a replayed
micro-batch, or one whose commit was cut short, is merged again and the table is
the same. One writer at a time; a reader during a swap may see some buckets
before and some after it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


class KeyedTable:
    """``schema``: the columns, DDL or StructType. ``key``: columns that identify
    a row (null is a value like others). ``order``: columns that decide which row
    of a key stays. ``keep``: ``"greatest"`` or ``"least"`` of that order.
    ``buckets`` belongs to the files: choose it for the table's final size (a
    bucket is rewritten whole) and keep it."""

    def __init__(self, spark: SparkSession, path: str, schema: str | T.StructType, key: Sequence[str], order: Sequence[str], buckets: int = 64, keep: str = "greatest"):
        if keep not in ("greatest", "least"):
            raise ValueError("keep must be 'greatest' or 'least'")
        self.spark, self.path, self.buckets, self.keep = spark, path.rstrip("/"), buckets, keep
        self.schema = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
        self.key, self.order = list(key), list(order)
        where = spark._jvm.org.apache.hadoop.fs.Path(self.path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(where)

    def _files(self) -> DataFrame:
        return self.spark.read.schema(self.schema.add("bucket", T.IntegerType()) if "bucket" not in self.schema.names else self.schema).parquet(self.path)

    def read(self) -> DataFrame:
        return self._files().select(*self._columns())

    def _columns(self) -> list[str]:
        return [n for n in self.schema.names if n != "bucket"]

    def in_buckets(self, rows: DataFrame) -> DataFrame:
        """Rows with the number of their key's bucket."""
        return rows.withColumn("bucket", F.pmod(F.xxhash64(*self.key), F.lit(self.buckets)).cast("int"))

    def _one_a_key(self, rows: DataFrame) -> DataFrame:
        """The row of each key that stays; pre-aggregated, so a hot key is no hot task."""
        rest = [c for c in self._columns() if c not in self.key and c not in self.order]
        order = [c for c in self.order if c not in self.key]
        pick = F.max if self.keep == "greatest" else F.min
        one = rows.groupBy("bucket", *self.key).agg(pick(F.struct(F.lit(0).alias("_"), *order, *rest)).alias("_row"))
        return one.select("bucket", *self.key, *[F.col(f"_row.{c}").alias(c) for c in (*order, *rest)])

    def merge(self, rows: DataFrame) -> None:
        """Insert rows with new keys; of rows with a known key, keep one."""
        new = self._one_a_key(self.in_buckets(rows.select(*self._columns()))).checkpoint(eager=True)
        touched = [r.bucket for r in new.select("bucket").distinct().collect()]  # a number a bucket at most
        if not touched:
            return
        old = self._files().filter(F.col("bucket").isin(touched))
        # Written before the files it was read from are replaced.
        merged = self._one_a_key(old.unionByName(new)).checkpoint(eager=True)
        # A large bucket is written by several tasks, small ones by one.
        out = merged.select(*self._columns(), "bucket").hint("rebalance", "bucket")
        out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(self.path)
