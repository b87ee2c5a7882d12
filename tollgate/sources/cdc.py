"""Change events of the relational ledger table (``public.transfers``).

Events arrive as JSON text (from a topic or landed files), bare or wrapped
as ``{"schema": ..., "payload": {...}}``. ``cdc_parse`` flattens them;
``cdc_current_state`` folds them to the table's current rows, and
``tollgate.streaming.change_state`` does so batch by batch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tollgate.schema import CHANGE_MESSAGE

ROW_COLUMNS = (("id", "id"), ("_from", "from_id"), ("_to", "to_id"), ("pool_id", "pool_id"), ("amount", "amount"), ("timestamp", "timestamp"))


#: Operations that carry a row after the event, before it, and none.
AFTER, BEFORE, TRUNCATE = ("c", "r", "u"), ("d",), "t"


def cdc_read(events: DataFrame, value_col: str = "value", scale: int = 2) -> tuple[DataFrame, DataFrame]:
    """JSON change events -> (events, malformed).

    Events: ``op, ts_ms, lsn, table`` and the row image (``after`` for
    create/update/read, ``before`` for delete, nulls for truncate) in our column
    names. Accepts the envelope bare or under ``payload``. ``scale``: decimals
    of the amount column, for amounts sent as unscaled base64.

    Malformed (column ``_corrupt``, the text as it came): no JSON or a field of
    another type, an unknown operation, a row event without a row or without its
    id. Null values (tombstones, which end a key after its delete) are neither."""
    schema = T.StructType(CHANGE_MESSAGE.fields + [T.StructField("_bad", T.StringType())])
    raw = F.col(value_col).cast("string")
    m = F.from_json(raw, schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"})
    # Filters do not move below a projection with a random column: each event is parsed once.
    e = events.filter(F.col(value_col).isNotNull()).select(raw.alias("_raw"), m.alias("_m"), F.rand().alias("_once"))
    env = F.when(F.col("_m.payload").isNotNull(), F.col("_m.payload")).otherwise(
        F.struct(*[F.col(f"_m.{f}").alias(f) for f in ("op", "ts_ms", "source", "before", "after")])
    )
    e = e.select("_raw", F.col("_m._bad").alias("_bad"), env.alias("_e"), "_once")
    op = F.col("_e.op")
    image = F.when(op.isin(*BEFORE), F.col("_e.before")).otherwise(F.col("_e.after"))
    e = e.select("_raw", "_bad", "_e", image.alias("_i"), "_once")
    fine = F.col("_bad").isNull() & ((op.isin(*AFTER, *BEFORE) & F.col("_i.id").isNotNull()) | (op == TRUNCATE))
    e = e.withColumn("_fine", F.coalesce(fine, F.lit(False)) & (F.col("_once") >= 0))
    row = F.when(op != TRUNCATE, F.col("_i"))
    good = e.filter("_fine").select(
        op.alias("op"),
        F.col("_e.ts_ms").alias("ts_ms"),
        F.col("_e.source.lsn").alias("lsn"),
        F.col("_e.source.table").alias("table"),
        row.alias("_i"),
        F.rand().alias("_once"),
    ).filter("_once >= 0")
    amount = good.select("*", amount_parts(F.col("_i.amount")).alias("_a"), F.rand().alias("_again")).filter("_again >= 0")
    good = amount.select("op", "ts_ms", "lsn", "table", *[(decimal_of("_a", scale) if dst == "amount" else F.col(f"_i.{src}")).alias(dst) for src, dst in ROW_COLUMNS])
    return good, e.filter("not _fine").select(F.col("_raw").alias("_corrupt"))


def cdc_parse(events: DataFrame, value_col: str = "value", scale: int = 2) -> DataFrame:
    """The well-formed events of :func:`cdc_read`, which also has the others."""
    return cdc_read(events, value_col, scale)[0]


def amount_parts(amount: Column) -> Column:
    """An amount, a variant, as struct (number, digits): a JSON number or
    text with a decimal point has ``number``; text without one is base64, and
    ``digits`` are its bytes as hex."""
    text = F.try_variant_get(amount, "$", "string")
    number = F.try_variant_get(amount, "$", "double")
    coded = (F.schema_of_variant(amount) == "STRING") & ~text.contains(".")
    return F.struct(F.when(~coded, number).alias("number"), F.when(coded, F.hex(F.unbase64(text))).alias("digits"))


def decimal_of(parts: str, scale: int) -> Column:
    """An amount as emitted (:func:`amount_parts`): a number, or the unscaled
    value's big-endian two's complement bytes (up to eight), the connector's
    default for decimals."""
    digits = F.col(f"{parts}.digits")
    unsigned = F.conv(digits, 16, 10).cast("decimal(20,0)")
    negative = F.conv(F.substring(digits, 1, 1), 16, 10).cast("int") >= 8
    wrap = F.pow(F.lit(2.0), (F.length(digits) * 4).cast("double")).cast("decimal(20,0)")
    signed = F.when(negative, unsigned - wrap).otherwise(unsigned)
    return F.when(digits.isNull(), F.col(f"{parts}.number")).otherwise(signed.cast("double") / F.lit(10.0**scale))


def newest_by_id(events: DataFrame) -> DataFrame:
    """The newest event of every id by log position, then by time (of equal
    ones, the greatest in all columns), and the newest truncate, whose id is
    null. Partial aggregation per id, so a hot id is no hot task."""
    rest = ["op", *[dst for _, dst in ROW_COLUMNS if dst != "id"]]
    newest = events.groupBy("id").agg(F.max(F.struct(F.coalesce("lsn", F.lit(-1)).alias("lsn"), F.coalesce("ts_ms", F.lit(-1)).alias("ts_ms"), *rest)).alias("_n"))
    return newest.select("id", *[F.col(f"_n.{c}").alias(c) for c in ("lsn", "ts_ms", *rest)])


def current_rows(newest: DataFrame) -> DataFrame:
    """From the newest event of every id to the table's rows: without deleted
    ids, and without those whose newest event is not after the last truncate."""
    position = F.struct("lsn", "ts_ms")
    cut = newest.filter(F.col("op") == TRUNCATE).agg(F.max(position).alias("p")).select("p").scalar()
    rows = newest.filter(~F.col("op").isin(TRUNCATE, *BEFORE)).filter(cut.isNull() | (position > cut))
    return rows.select(*[dst for _, dst in ROW_COLUMNS])


def cdc_current_state(parsed: DataFrame) -> DataFrame:
    """The table's rows after all events. Events without a log position come
    before those with one; deleted ids and, after a truncate, all older rows are
    gone."""
    return current_rows(newest_by_id(parsed))
