"""Minimum-balance rules as a second stream beside the requests.

Both arrive on one stream, each row with its place of arrival. A request is held
against the newest rule of its pool type that arrived before it, also where the
rule came between two requests of one micro-batch. Rules are state: every update
is merged into a keyed table (pool type, arrival), which later micro-batches
read. The table keeps superseded rules, so that a replayed micro-batch finds the
rules as they were and writes the same results again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tollgate.operators.asof import as_of
from tollgate.operators.filters import min_balance_predicate, split_flag
from tollgate.schema import INSUFFICIENT_BALANCE
from tollgate.sinks.keyed_table import KeyedTable

RULE_UPDATE = "pool_type string, arrival long, min_balance double"


def rule_state(spark: SparkSession, path: str, buckets: int = 8) -> KeyedTable:
    return KeyedTable(spark, path, RULE_UPDATE, key=["pool_type", "arrival"], order=["min_balance"], buckets=buckets)


def split_by_rules(requests: DataFrame, rules: DataFrame, arrival: str = "arrival", balance_col: str = "balance", on_missing_rule: str = "fail", error_col: str = "error") -> DataFrame:
    """Attach the ``min_balance`` in force when each request arrived and require
    ``balance > min_balance``; others get ``INSUFFICIENT_BALANCE``. Of updates of
    a pool type with one arrival, the highest balance holds. A rule that arrives
    together with a request holds for it."""
    if on_missing_rule not in ("fail", "refuse"):
        raise ValueError("on_missing_rule must be 'fail' or 'refuse'")
    news = rules.select("pool_type", F.col("arrival").alias("_since"), "min_balance")
    j = as_of(requests, news, "pool_type", arrival, "_since", ["min_balance"])
    ok = min_balance_predicate(balance_col, "min_balance")
    if on_missing_rule == "fail":
        name = F.coalesce(F.col("pool_type"), F.lit("null"))
        ok = F.when(F.col("min_balance").isNull(), F.raise_error(F.concat(F.lit("no rule for pool type "), name))).otherwise(ok)
    return split_flag(j, ok, INSUFFICIENT_BALANCE, error_col)


def enforce_rules(
    stream: DataFrame,
    state: KeyedTable,
    out: str,
    checkpoint: str,
    with_balance: Callable[[DataFrame], DataFrame],
    on_missing_rule: str = "fail",
    trigger: dict | None = None,
):
    """Start the check. ``stream``: request columns and ``arrival``,
    ``min_balance``; a rule update has a ``min_balance`` and of the others only
    ``pool_type`` and ``arrival``. ``with_balance`` adds ``balance`` to requests.
    Results go to ``out``, a folder a micro-batch, which a replay replaces."""
    columns = [c for c in stream.columns if c != "min_balance"]

    def body(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            updates = batch.filter("min_balance is not null").select("pool_type", "arrival", "min_balance")
            requests = with_balance(batch.filter("min_balance is null").select(*columns))
            rules = state.read().unionByName(updates)
            result = split_by_rules(requests, rules, on_missing_rule=on_missing_rule)
            result.write.mode("overwrite").parquet(f"{out.rstrip('/')}/batch_id={batch_id}")
            state.merge(updates)
        finally:
            batch.unpersist()

    w = stream.writeStream.foreachBatch(body).option("checkpointLocation", checkpoint)
    return w.trigger(**(trigger or {"processingTime": "10 seconds"})).start()
