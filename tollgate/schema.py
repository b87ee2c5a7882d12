"""Record schemas, error codes and fixed values.

Schemas are explicit ``StructType`` constants: nothing is inferred.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values (must equal the reference's for right results) -----------
# Error codes, in declaration order.
TOO_MANY_REQUESTS = "TOO_MANY_REQUESTS"
INSUFFICIENT_BALANCE = "INSUFFICIENT_BALANCE"
TRANSFER_IN_PROGRESS = "TRANSFER_IN_PROGRESS"
ERROR_CODES = (TOO_MANY_REQUESTS, INSUFFICIENT_BALANCE, TRANSFER_IN_PROGRESS)

# Pool rules: pool type -> minimum balance (strictly greater is required).
DEFAULT_RULES = (("easy", -40.00), ("medium", 0.00), ("hard", 40.00))

# Request cooldown per sender, in milliseconds (20 s).
DEFAULT_COOLDOWN_MS = 20_000

# Topic names of the ledger records and of the error messages.
TOPIC_TRANSFERS = "transfers_4"
TOPIC_ERRORS = "houston"

# Default pool id of generated transfers.
DEFAULT_POOL_ID = "coro"

# What a keyed read puts before the message key.
GREETING = "Hi "

# JSON field names of a request, in wire order (camelCase on the wire), with ours.
TRANSFER_JSON_FIELDS = (
    ("id", "id"),
    ("fromId", "from_id"),
    ("toId", "to_id"),
    ("poolId", "pool_id"),
    ("poolType", "pool_type"),
    ("amount", "amount"),
    ("timestamp", "timestamp"),
)
# --- end of fixed values ------------------------------------------------------

# Internal column order of a transfer request / ledger row.
TRANSFER_COLUMNS = ("id", "from_id", "to_id", "pool_id", "pool_type", "amount", "timestamp")

TRANSFER = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("from_id", T.StringType()),
        T.StructField("to_id", T.StringType()),
        T.StructField("pool_id", T.StringType()),
        T.StructField("pool_type", T.StringType()),
        T.StructField("amount", T.DoubleType()),
        T.StructField("timestamp", T.LongType()),
    ]
)

TRANSFER_JSON = T.StructType(
    [T.StructField(wire, TRANSFER[col].dataType) for wire, col in TRANSFER_JSON_FIELDS]
)

RULE = T.StructType(
    [
        T.StructField("pool_type", T.StringType()),
        T.StructField("min_balance", T.DoubleType()),
    ]
)

# A message as read from / written to a topic, or its file twin.
MESSAGE = T.StructType(
    [
        T.StructField("key", T.StringType()),
        T.StructField("value", T.StringType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
    ]
)

# Relational ledger table: sender/receiver are `_from`/`_to`, no pool type,
# amount is a fixed decimal.
LEDGER_TABLE_DDL = (
    "id STRING NOT NULL, _from STRING NOT NULL, _to STRING NOT NULL, "
    "pool_id STRING NOT NULL, amount DECIMAL(6,2) NOT NULL, `timestamp` BIGINT NOT NULL"
)

# Exact type of every sum: amounts are doubles, and keep 15 decimals here, so
# that sums neither round amounts nor depend on order.
MONEY = T.DecimalType(28, 15)
# How the text form of a balance is written.
MONEY_TEXT = T.DecimalType(38, 2)

# Change event: row image of the relational ledger.
_ROW_IMAGE = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("_from", T.StringType()),
        T.StructField("_to", T.StringType()),
        T.StructField("pool_id", T.StringType()),
        # a number, or text: see sources.cdc.decimal_of
        T.StructField("amount", T.VariantType()),
        T.StructField("timestamp", T.LongType()),
    ]
)
_ENVELOPE_FIELDS = [
    T.StructField("op", T.StringType()),
    T.StructField("ts_ms", T.LongType()),
    T.StructField(
        "source",
        T.StructType([T.StructField("lsn", T.LongType()), T.StructField("table", T.StringType())]),
    ),
    T.StructField("before", _ROW_IMAGE),
    T.StructField("after", _ROW_IMAGE),
]
CHANGE_ENVELOPE = T.StructType(_ENVELOPE_FIELDS)
# An envelope may come bare or wrapped as {"schema": ..., "payload": {...}}.
CHANGE_MESSAGE = T.StructType(
    _ENVELOPE_FIELDS + [T.StructField("payload", T.StructType(_ENVELOPE_FIELDS))]
)
ROW_IMAGE = _ROW_IMAGE
