"""The whole validation chain as one batch plan:

not-self filter -> throttle -> balance -> pool rule -> previous request ->
in-sync -> outputs.

Rows leave the chain where they are refused: each stage works only on what the
stage before let through, and the outcomes are the union of the refused rows of
every stage and the rest. What two later parts read is written once to the
shared checkpoint folder, so no stage runs twice; building the plan therefore
runs the stages up to the last of them. A streaming job calls the same function
once per micro-batch (``tollgate.streaming``).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tollgate.operators.filters import not_self_transfer
from tollgate.operators.history import last_request
from tollgate.operators.insync import ledger_in_sync, visible_ids
from tollgate.operators.ledger import balance_per_account, balance_per_request
from tollgate.operators.rules import balance_rule_split
from tollgate.operators.throttle import throttle
from tollgate.schema import (
    DEFAULT_COOLDOWN_MS,
    TOO_MANY_REQUESTS,
    TRANSFER_COLUMNS,
    TRANSFER_IN_PROGRESS,
)
from tollgate.sinks.messages import error_records, ledger_records


@dataclass
class PipelineResult:
    balanced: DataFrame  # passed throttle and pool rule (fed to the ledger topic)
    in_sync: DataFrame  # additionally in sync with the ledger (final accepts)
    errors: DataFrame  # transfer columns + error code, all three stages
    outcomes: DataFrame  # every non-self request once, error NULL = accepted
    ledger_records: DataFrame  # key/value messages for the ledger topic
    error_records: DataFrame  # text messages for the errors topic


def transfer_pipeline(
    requests: DataFrame,
    ledger: DataFrame,
    rules: DataFrame,
    cooldown_ms: int = DEFAULT_COOLDOWN_MS,
    balance_mode: str = "wired",
    on_missing_rule: str = "fail",
    ingest_delay_ms: int | None = None,
    ledger_from: str = "balanced",
    throttle_seeds: DataFrame | None = None,
    last_request_seeds: DataFrame | None = None,
    rules_seq_col: str | None = "seq",
    totals: DataFrame | None = None,
    ledger_ids: DataFrame | None = None,
) -> PipelineResult:
    """Validate ``requests`` against a ``ledger`` snapshot and ``rules``.

    ``balance_mode``: ``"wired"`` = -sent(sender) + received(receiver);
    ``"account"`` = the sender's account balance (UNION form, NULL refused).
    ``ingest_delay_ms``: balanced requests reach the ledger this long after
    their timestamp (None: not within this batch).
    ``ledger_from``: ``"balanced"`` (ledger topic fed before the in-sync
    check) or ``"in_sync"``.
    ``totals`` / ``ledger_ids``: account totals (``account, sent, received``)
    and visible ledger ids given directly instead of derived from ``ledger``
    (a streaming job carries them as state; ``ledger`` may then be None).
    """
    if balance_mode not in ("wired", "account"):
        raise ValueError("balance_mode must be 'wired' or 'account'")
    if ledger_from not in ("balanced", "in_sync"):
        raise ValueError("ledger_from must be 'balanced' or 'in_sync'")
    cols = list(TRANSFER_COLUMNS)
    reqs = not_self_transfer(requests.select(*cols))

    throttled = throttle(reqs, cooldown_ms, seeds=throttle_seeds).checkpoint(eager=True)
    allowed = throttled.filter("allowed").drop("allowed")

    if balance_mode == "wired":
        with_bal = balance_per_request(allowed, ledger, totals=totals)
    else:
        with_bal = balance_per_account(allowed, ledger, totals=totals).drop("balance_text")
    ruled = balance_rule_split(with_bal, rules, on_missing_rule=on_missing_rule, seq_col=rules_seq_col)
    ruled = ruled.select(*cols, "error").checkpoint(eager=True)
    balanced = ruled.filter(F.col("error").isNull()).select(*cols)

    with_last = last_request(balanced, seeds=last_request_seeds, ts_out_col="last_ts")
    ids = ledger_ids if ledger_ids is not None else visible_ids(ledger)
    synced = ledger_in_sync(with_last, ids, ingest_delay_ms=ingest_delay_ms)
    late = F.when(~F.col("in_sync"), F.lit(TRANSFER_IN_PROGRESS)).alias("error")

    refused = throttled.filter(~F.col("allowed")).select(*cols, F.lit(TOO_MANY_REQUESTS).alias("error"))
    poor = ruled.filter(F.col("error").isNotNull())
    outcomes = refused.unionByName(poor).unionByName(synced.select(*cols, late))
    in_sync = synced.filter("in_sync").select(*cols)
    errors = outcomes.filter(F.col("error").isNotNull())
    to_ledger = balanced if ledger_from == "balanced" else in_sync
    return PipelineResult(
        balanced=balanced,
        in_sync=in_sync,
        errors=errors,
        outcomes=outcomes,
        ledger_records=ledger_records(to_ledger),
        error_records=error_records(errors),
    )
