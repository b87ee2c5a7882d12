"""Request sources: message topics (or their file twins) and JSON-lines files.

A message frame has columns ``key, value, topic, partition, offset,
timestamp``. The topic connector is used when ``fmt="kafka"``; otherwise
the same columns are read from files, which is what tests do.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tollgate.functions.columns import key_greeting, transfer_json
from tollgate.schema import MESSAGE, TOPIC_TRANSFERS, TRANSFER_JSON, TRANSFER_JSON_FIELDS

CORRUPT_COL = "_corrupt"


def _from_wire(parsed: str) -> list:
    return [F.col(f"{parsed}.{wire}").alias(col) for wire, col in TRANSFER_JSON_FIELDS]


def parse_transfers(messages: DataFrame, value_col: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """JSON request text -> transfer columns. A value that is no JSON, that has
    a field of another type, or no id, keeps its text in ``_corrupt`` (see
    ``quarantine``); a null value counts as the empty text."""
    raw = F.coalesce(F.col(value_col).cast("string"), F.lit(""))
    schema = T.StructType(TRANSFER_JSON.fields + [T.StructField("_bad", T.StringType())])
    parsed = F.from_json(raw, schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"})
    # Filters do not move below a projection with a random column, so that the
    # text is parsed once, after whatever spread the rows.
    out = messages.select(*keep, raw.alias("_raw"), parsed.alias("_p"), F.rand().alias("_once"))
    bad = (F.col("_p").isNull() | F.col("_p.id").isNull() | F.col("_p._bad").isNotNull()) & (F.col("_once") >= 0)
    return out.select(*keep, *_from_wire("_p"), F.when(bad, F.col("_raw")).alias(CORRUPT_COL))


def quarantine(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split parsed requests into (good, malformed)."""
    good = parsed.filter(F.col(CORRUPT_COL).isNull()).drop(CORRUPT_COL)
    bad = parsed.filter(F.col(CORRUPT_COL).isNotNull()).select(CORRUPT_COL)
    return good, bad


def read_messages(
    spark: SparkSession,
    source: str,
    fmt: str = "parquet",
    options: dict | None = None,
    starting_offsets: str | None = None,
    streaming: bool = False,
) -> DataFrame:
    """Message frame from a topic (``fmt="kafka"``, ``source`` = topic name,
    ``options`` with ``kafka.bootstrap.servers`` and the group) or from files
    under ``source`` with the message columns. A topic is read from its latest
    offsets as a stream and from the earliest in a batch, unless given."""
    opts = dict(options or {})
    reader = spark.readStream if streaming else spark.read
    if fmt == "kafka":
        opts.setdefault("subscribe", source)
        opts.setdefault("startingOffsets", starting_offsets or ("latest" if streaming else "earliest"))
        df = reader.format("kafka").options(**opts).load()
        return df.select(
            F.col("key").cast("string").alias("key"),
            F.col("value").cast("string").alias("value"),
            "topic",
            "partition",
            "offset",
            "timestamp",
        )
    return reader.format(fmt).schema(MESSAGE).options(**opts).load(source)


def read_transfers_json(messages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Value-only read: (the JSON request of each message, the malformed values)."""
    return quarantine(parse_transfers(messages))


def read_keyed_transfers(messages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Key and value: (the request plus ``greeting = "Hi " + key``, the malformed
    values). A NULL key gives a NULL greeting, and the row is kept."""
    good, bad = quarantine(parse_transfers(messages, keep=("key",)))
    return good.select(*[c for _, c in TRANSFER_JSON_FIELDS], key_greeting("key").alias("greeting")), bad


def read_transfers_file(spark: SparkSession, path: str, streaming: bool = False) -> tuple[DataFrame, DataFrame]:
    """Newline-delimited JSON requests with the explicit schema (no inference):
    (requests, malformed lines)."""
    reader = spark.readStream if streaming else spark.read
    return quarantine(parse_transfers(reader.text(path)))


def transfer_messages(transfers: DataFrame, topic: str = TOPIC_TRANSFERS, partitions: int = 10) -> DataFrame:
    """Transfers as the messages a producer would write: key = sender,
    value = JSON, partition by key hash, offset = the numeric id."""
    return transfers.select(
        F.col("from_id").alias("key"),
        transfer_json().alias("value"),
        F.lit(topic).alias("topic"),
        F.pmod(F.hash("from_id"), F.lit(partitions)).cast("int").alias("partition"),
        F.col("id").cast("long").alias("offset"),
        F.timestamp_millis("timestamp").alias("timestamp"),
    )
