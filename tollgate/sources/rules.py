"""Pool rules source: the fixed three rules, or a rules table from storage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pyspark.sql import types as T

from tollgate.schema import DEFAULT_RULES, RULE

RULE_SEQ = T.StructType(RULE.fields + [T.StructField("seq", T.LongType())])


def rules_table(spark: SparkSession, rules=DEFAULT_RULES) -> DataFrame:
    """``(pool_type, min_balance, seq)``; ``seq`` is the write order used by
    ``rules_latest`` (last write wins)."""
    rows = [(p, float(m), i) for i, (p, m) in enumerate(rules)]
    return spark.createDataFrame(rows, RULE_SEQ)


def read_rules(spark: SparkSession, path: str, fmt: str = "parquet", streaming: bool = False) -> DataFrame:
    """Rules kept in storage (columns ``pool_type, min_balance, seq``); a stream
    of rule updates when ``streaming``. Rows without ``seq`` are refused by
    ``rules_latest``, unless it is told that there is no order."""
    reader = spark.readStream if streaming else spark.read
    df = reader.format(fmt).schema(RULE_SEQ).load(path)
    return df.select("pool_type", F.col("min_balance").cast("double"), "seq")
