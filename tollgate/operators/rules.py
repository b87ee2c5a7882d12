"""Per-pool minimum-balance rules: newest rule per pool type, joined to each
request (adaptive execution broadcasts the one row per pool type where it is
small), strict comparison."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tollgate.operators.filters import min_balance_predicate, split_flag
from tollgate.schema import INSUFFICIENT_BALANCE


def rules_latest(rules: DataFrame, seq_col: str | None = "seq") -> DataFrame:
    """Keyed upsert, last write wins per ``pool_type``. ``seq_col`` orders the
    writes and may not be null; without such a column the rules must be one row
    per pool type. Both are errors otherwise: no order says which rule holds."""
    if seq_col is None or seq_col not in rules.columns:
        one = rules.groupBy("pool_type").agg(F.count(F.lit(1)).alias("n"), F.first("min_balance").alias("min_balance"))
        checked = F.when(F.col("n") > 1, F.raise_error(F.concat(F.lit("several rules without an order for pool type "), _name()))).otherwise(F.col("min_balance"))
        return one.select("pool_type", checked.alias("min_balance"))
    newest = rules.groupBy("pool_type").agg(
        F.max_by("min_balance", F.col(seq_col)).alias("min_balance"), F.count_if(F.col(seq_col).isNull()).alias("unordered")
    )
    checked = F.when(F.col("unordered") > 0, F.raise_error(F.concat(F.lit("a rule without an order for pool type "), _name()))).otherwise(F.col("min_balance"))
    return newest.select("pool_type", checked.alias("min_balance"))


def _name():
    return F.coalesce(F.col("pool_type"), F.lit("null"))


def balance_rule_split(
    df: DataFrame,
    rules: DataFrame,
    balance_col: str = "balance",
    on_missing_rule: str = "fail",
    seq_col: str | None = "seq",
    error_col: str = "error",
) -> DataFrame:
    """Attach the current rule of each request's pool type and require
    ``balance > min_balance``; failures get ``INSUFFICIENT_BALANCE``.

    ``on_missing_rule``: ``"fail"`` raises for a request whose pool type has
    no rule; ``"refuse"`` routes it to ``INSUFFICIENT_BALANCE``.
    """
    if on_missing_rule not in ("fail", "refuse"):
        raise ValueError("on_missing_rule must be 'fail' or 'refuse'")
    latest = rules_latest(rules, seq_col).select(F.col("pool_type").alias("_rule_pool"), F.col("min_balance").alias("_min_balance"))
    j = df.join(latest, F.col("pool_type") == F.col("_rule_pool"), "left")
    ok = min_balance_predicate(balance_col, "_min_balance")
    if on_missing_rule == "fail":
        ok = F.when(
            F.col("_rule_pool").isNull(),
            F.raise_error(F.concat(F.lit("no rule for pool type "), F.coalesce(F.col("pool_type"), F.lit("null")))),
        ).otherwise(ok)
    return split_flag(j, ok, INSUFFICIENT_BALANCE, error_col).drop("_rule_pool").withColumnRenamed(
        "_min_balance", "min_balance"
    )
