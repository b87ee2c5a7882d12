"""Change events as a database would emit them, made from transfers: test
input for ``tollgate.sources.cdc``, not part of the library's sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def unscaled_base64(amount: Column, scale: int = 2) -> Column:
    """A decimal as base64 of its unscaled value's big-endian bytes: four bytes,
    two's complement."""
    cents = F.round(amount * 10**scale).cast("long")
    return F.base64(F.unhex(F.lpad(F.hex(F.pmod(cents, F.lit(1 << 32))), 8, "0")))


def change_events(transfers: DataFrame, table: str = "transfers") -> DataFrame:
    """Column ``value``: JSON change events. A create per row (a snapshot read
    for every fifth id, without a log position for every tenth), an update
    doubling the amount of every ``medium`` row, a delete of every ``hard`` row
    followed by a tombstone (null value). Every second id's events are wrapped
    under ``payload``; every third id's amounts are base64 of the unscaled value,
    the others numbers."""
    n = F.col("id").cast("long")

    def image(amount: Column) -> Column:
        number = F.round(amount, 2).cast("string")
        text = F.when(n % 3 == 0, F.concat(F.lit('"'), unscaled_base64(amount), F.lit('"'))).otherwise(number)
        body = F.to_json(F.struct("id", F.col("from_id").alias("_from"), F.col("to_id").alias("_to"), "pool_id", "timestamp"))
        return F.concat(F.substring(body, 1, 1), F.lit('"amount":'), text, F.lit(","), F.substr(body, F.lit(2)))

    def event(op: Column, ts_ms: Column, lsn: Column, before: Column, after: Column) -> Column:
        return F.concat(
            F.lit('{"op":"'), op, F.lit('","ts_ms":'), ts_ms.cast("string"), F.lit(',"source":{"lsn":'),
            F.coalesce(lsn.cast("string"), F.lit("null")), F.lit(f',"table":"{table}"}},"before":'), before, F.lit(',"after":'), after, F.lit("}"))

    old, new, none = image(F.col("amount")), image(F.col("amount") * 2), F.lit("null")
    op = F.when(n % 5 == 0, "r").otherwise("c")
    position = F.when(n % 10 != 0, n * 4)
    kinds = F.array(
        F.struct(F.lit(True).alias("is"), event(op, F.col("timestamp"), position, none, old).alias("e")),
        F.struct((F.col("pool_type") == "medium").alias("is"), event(F.lit("u"), F.col("timestamp") + 1000, n * 4 + 1, old, new).alias("e")),
        F.struct((F.col("pool_type") == "hard").alias("is"), event(F.lit("d"), F.col("timestamp") + 2000, n * 4 + 2, old, none).alias("e")),
        F.struct((F.col("pool_type") == "hard").alias("is"), F.lit(None).cast("string").alias("e")),
    )
    events = transfers.select(n.alias("n"), F.explode(kinds).alias("k")).filter("k.is")
    wrapped = F.concat(F.lit('{"schema":{"type":"struct"},"payload":'), F.col("k.e"), F.lit("}"))
    return events.select(F.when(F.col("n") % 2 == 0, wrapped).otherwise(F.col("k.e")).alias("value"))


def with_faults(events: DataFrame, transfers: DataFrame, table: str = "transfers") -> DataFrame:
    """Change events among which every seventh id's creation is cut short, every
    eleventh id adds garbage and an event of an unknown operation, and the last
    id but 99 truncates the table."""
    n = F.col("id").cast("long")
    cut = events.withColumn("n", F.get_json_object("value", "$.after.id").cast("long")).withColumn(
        "value", F.when((F.col("n") % 7 == 0) & F.col("value").startswith('{"op":"c"'), F.substring("value", 1, 40)).otherwise(F.col("value"))).select("value")
    extra = F.array(F.concat(F.lit("not json "), F.col("id")), F.concat(F.lit('{"op":"x","ts_ms":'), F.col("id"), F.lit("}")))
    garbage = transfers.filter(n % 11 == 0).select(F.explode(extra).alias("value"))
    last = transfers.agg((F.max(n) - 99).alias("n"))
    truncate = last.select(F.concat(F.lit('{"op":"t","ts_ms":0,"source":{"lsn":'), (F.col("n") * 4).cast("string"), F.lit(f',"table":"{table}"}},"before":null,"after":null}}')).alias("value"))
    return cut.unionByName(garbage).unionByName(truncate)
