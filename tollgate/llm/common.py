"""Helpers shared by the operators: written intermediate tables, streaming of
sorted Arrow batches group by group, and connected components."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tollgate.session import work_dir

#: Bytes of text that one Python chunk gathers before it hands rows on.
CHUNK_BYTES = 32 << 20


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


class Written:
    """A table written once under the shared checkpoint folder. Lineage ends
    here, so a lost executor costs a re-read and not a recomputation."""

    def __init__(self, df: DataFrame, name: str):
        self.spark = df.sparkSession
        self.path = f"{work_dir(self.spark, 'llm')}/{name}"
        self.schema = df.schema
        df.write.parquet(self.path)

    @property
    def df(self) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(self.path)

    def drop(self) -> None:
        """Delete the files; only once no later plan reads them."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def text_bytes(col: str):
    """The UTF-8 bytes of a text column; null counts as empty."""
    return F.coalesce(F.col(f"`{col}`").cast("binary"), F.lit(b""))


def crc_bucket(id_col: str, mod: int):
    """crc32 of the id's decimal text, modulo ``mod``; a null id is the empty text."""
    return F.crc32(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")).cast("binary")) % mod


def partitions_for(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def by_groups(batches: Iterator[pa.RecordBatch], keys: list[str], at_least: int) -> Iterator[pa.Table]:
    """Cut batches that are sorted by ``keys`` into tables of whole groups, of
    ``at_least`` rows where more follow. Holds one table and one group."""
    held: list[pa.RecordBatch] = []
    rows = 0
    for b in batches:
        if not b.num_rows:
            continue
        held.append(b)
        rows += b.num_rows
        if rows < at_least:
            continue
        t = pa.Table.from_batches(held).combine_chunks()
        last = [t.column(k)[t.num_rows - 1].as_py() for k in keys]
        lo, hi = 0, t.num_rows - 1  # first row of the last group, by bisection
        while lo < hi:
            mid = (lo + hi) // 2
            if [t.column(k)[mid].as_py() for k in keys] == last:
                hi = mid
            else:
                lo = mid + 1
        if lo:
            yield t.slice(0, lo)
            t = t.slice(lo).combine_chunks()
        held, rows = t.to_batches(), t.num_rows
    if rows:
        yield pa.Table.from_batches(held).combine_chunks()


def components(edges: DataFrame, name: str, watch: Callable[[int], None] | None = None) -> Written:
    """Connected components by alternating large-star and small-star steps.

    ``edges`` has columns ``a`` and ``b`` of one orderable type. Returns rows
    ``(node, root)`` for every node of an edge, with root the smallest node
    reachable (the root itself included). Each round is written to the shared
    folder; only two numbers a round come to the driver. Nodes with very many
    edges: both steps take minima with map-side combination, and the joins are
    plain inner joins that adaptive execution can split.
    """
    def star(df: DataFrame) -> DataFrame:
        return df.filter("a <> b").distinct()

    def mark(df: DataFrame):
        return df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()

    cur = Written(star(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))), f"{name}-0")
    seen, step = mark(cur.df), 0
    while True:
        step += 1
        e = cur.df
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # Written, so that the join can be split at a node with very many edges.
        least = Written(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")), f"{name}-m{step}")
        least, least_files = least.df, least
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        # Every node keeps a link to its smallest neighbour, itself excluded.
        large = Written(star(large.unionByName(least.select("a", F.col("m").alias("b")))), f"{name}-l{step}")
        e = large.df
        low = e.groupBy("a").agg(F.min("b").alias("m"))
        small = e.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        nxt = Written(star(small.unionByName(low.select("a", F.col("m").alias("b")))), f"{name}-s{step}")
        now = mark(nxt.df)
        for t in (large, cur, least_files):
            t.drop()
        cur = nxt
        if watch:
            watch(step)
        if now == seen:
            break
        seen = now
    e = cur.df
    out = Written(e.select(F.col("a").alias("node"), F.col("b").alias("root"))
                  .unionByName(e.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()), f"{name}-out")
    cur.drop()
    return out
