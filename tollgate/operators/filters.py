"""Projections, filters, predicates and routing (split by flag)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tollgate.functions.columns import not_self


def not_self_transfer(df: DataFrame, from_col: str = "from_id", to_col: str = "to_id") -> DataFrame:
    """Drop requests whose sender is the receiver (silently; no error record).
    A row with a null side is dropped too."""
    return df.filter(not_self(from_col, to_col))


def with_sender_key(df: DataFrame, key_col: str = "key", from_col: str = "from_id") -> DataFrame:
    """Pair each transfer with its sender id as message key."""
    return df.withColumn(key_col, F.col(from_col))


def ledger_point_lookup(ledger: DataFrame, transfer_id: str, id_col: str = "id") -> DataFrame:
    """All columns of the ledger rows with ``id = transfer_id`` (pushed to the scan)."""
    return ledger.filter(F.col(id_col) == F.lit(transfer_id))


def min_balance_predicate(balance: str | Column = "balance", minimum: str | Column = "min_balance") -> Column:
    """``balance > min_balance``, strict: a balance equal to the minimum fails."""
    b = F.col(balance) if isinstance(balance, str) else balance
    m = F.col(minimum) if isinstance(minimum, str) else minimum
    return b > m


def split_flag(df: DataFrame, flag: str | Column, code: str, error_col: str = "error") -> DataFrame:
    """Route by a boolean: true keeps ``error`` as is, false (or null) sets it
    to ``code`` unless an earlier stage already set one. Main output is
    ``error IS NULL``, side output ``error IS NOT NULL`` (see ``main``/``side``)."""
    f = F.col(flag) if isinstance(flag, str) else flag
    failed = ~F.coalesce(f, F.lit(False))
    prior = F.col(error_col) if error_col in df.columns else F.lit(None).cast("string")
    return df.withColumn(error_col, F.coalesce(prior, F.when(failed, F.lit(code))))


def main(df: DataFrame, error_col: str = "error") -> DataFrame:
    return df.filter(F.col(error_col).isNull())


def side(df: DataFrame, error_col: str = "error") -> DataFrame:
    return df.filter(F.col(error_col).isNotNull())


def rule_passthrough(rules: DataFrame, name: str = "rules"):
    """Identity on the rules stream that records how many rules went by.

    Returns ``(rules, observation)``; ``observation.get`` holds ``{"n_rules": n}``
    once an action has run on the returned frame (batch), or see the
    query's progress (streaming)."""
    from pyspark.sql import Observation

    obs = Observation(name)
    return rules.observe(obs, F.count(F.lit(1)).alias("n_rules")), obs
