"""As-of join: to each row the newest row of another table at or before it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def as_of(left: DataFrame, right: DataFrame, by: str, left_time: str, right_time: str, values: Sequence[str]) -> DataFrame:
    """Add to every row of ``left`` the columns ``values`` of the row of
    ``right`` with the same ``by`` and the greatest ``right_time`` at or before
    ``left_time`` (NULL where there is none; of equal times, the greatest
    values). A null ``by`` meets no row.

    Both sides are dealt by ranges of (key, time) together, written once, and
    filled within (key, range); what a range begins with comes from a table of
    one row for each key and range. A key with most of the rows is spread like
    any other, and no row meets more than one row of the other side.
    """
    v = F.struct(*[F.col(c) for c in values])
    kind = right.select(v.alias("v")).schema["v"].dataType
    rows = left.select(
        F.col(by).alias("_k"), F.col(left_time).alias("_t"), F.lit(1).alias("_kind"), F.lit(None).cast(kind).alias("_v"),
        F.struct(*[F.col(f"`{c}`") for c in left.columns]).alias("_row"))
    rows = rows.withColumn("_tie", F.xxhash64("_row"))  # rows of one time need not share a range
    news = right.filter(F.col(by).isNotNull()).select(
        F.col(by).alias("_k"), F.col(right_time).alias("_t"), F.lit(0).alias("_kind"), v.alias("_v"),
        F.lit(None).cast(rows.schema["_row"].dataType).alias("_row"), F.lit(0).cast("long").alias("_tie"))
    dealt = rows.unionByName(news).repartitionByRange("_k", "_t", "_kind", "_tie")
    dealt = dealt.withColumn("_p", F.spark_partition_id()).checkpoint(eager=True)
    so_far = Window.partitionBy("_k", "_p").orderBy("_t", "_kind", "_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    earlier = Window.partitionBy("_k").orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    newest = F.max(F.when(F.col("_kind") == 0, F.struct("_t", "_v")))
    heads = dealt.groupBy("_k", "_p").agg(newest.alias("_newest")).select(
        F.col("_k").alias("_hk"), F.col("_p").alias("_hp"), F.last("_newest", ignorenulls=True).over(earlier).alias("_head")).checkpoint(eager=True)
    filled = dealt.withColumn("_found", F.last("_v", ignorenulls=True).over(so_far)).filter("_kind = 1")
    out = filled.join(heads, (F.col("_k") == F.col("_hk")) & (F.col("_p") == F.col("_hp")), "left")
    found = F.coalesce(F.col("_found"), F.col("_head._v"))
    return out.select("_row.*", *[found.getField(c).alias(c) for c in values])
