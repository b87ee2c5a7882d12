"""Ledger questions and balances, as set-based aggregates and joins.

All sums run on exact decimals that keep the amounts' digits (``MONEY``) and
are cast to double at the end, so results do not depend on summation order. "Sent" is the sum of
amounts an account sent, "received" the sum it received; both are NULL (not
0) for an account without such rows, which keeps "no rows" apart from
"sum is 0" as SQL does.

Scale: per account, the ledger is reduced by hash aggregates with map-side
partial aggregation, so a hot account costs no more than others. Where both
sides of one account are needed, one scan is exploded into
``(account, sent, received)`` legs and aggregated once; where the two sides
join on different keys (wired balance), each side gets its own narrow
aggregate. Request-side joins carry no hint: AQE picks a broadcast at
run time when the account table is small, and sort-merge (with skew-split
partitions) otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tollgate.functions.columns import money
from tollgate.operators.joins import union_distinct as _union_distinct
from tollgate.schema import MONEY, MONEY_TEXT


def _none() -> Column:
    return F.lit(None).cast(MONEY)


def account_totals(
    ledger: DataFrame, from_col: str = "from_id", to_col: str = "to_id", amount_col: str = "amount"
) -> DataFrame:
    """One ledger scan -> ``(account, sent, received)`` (DECIMAL, NULL if none)."""
    amt = money(amount_col)
    legs = ledger.select(
        F.explode(
            F.array(
                F.struct(F.col(from_col).alias("account"), amt.alias("sent"), _none().alias("received")),
                F.struct(F.col(to_col).alias("account"), _none().alias("sent"), amt.alias("received")),
            )
        ).alias("leg")
    ).select("leg.*")
    return legs.groupBy("account").agg(F.sum("sent").alias("sent"), F.sum("received").alias("received"))


def sent_by_account(ledger: DataFrame, from_col: str = "from_id", amount_col: str = "amount") -> DataFrame:
    """``-1 * sum(amount)`` per sender ("credit")."""
    return ledger.groupBy(F.col(from_col).alias("account")).agg(
        (-F.sum(money(amount_col))).cast("double").alias("credit")
    )


def received_by_account(ledger: DataFrame, to_col: str = "to_id", amount_col: str = "amount") -> DataFrame:
    """``sum(amount)`` per receiver ("debit")."""
    return ledger.groupBy(F.col(to_col).alias("account")).agg(
        F.sum(money(amount_col)).cast("double").alias("debit")
    )


def union_sum(x: Column, y: Column) -> Column:
    """``SUM`` over ``(SELECT x UNION SELECT y)``: UNION keeps one of two equal
    values (NULLs count as equal), SUM skips NULLs, all NULL gives NULL."""
    return (
        F.when(x.isNull(), y)
        .when(y.isNull(), x)
        .when(x == y, x)
        .otherwise(x + y)
    )


def balance_sum(ledger: DataFrame, **cols) -> DataFrame:
    """Per account, the same account on both sides:
    ``sum(-sent UNION received)`` -> ``(account, balance)``."""
    t = account_totals(ledger, **cols)
    return t.select("account", union_sum(-F.col("sent"), F.col("received")).cast("double").alias("balance"))


def volume_union(ledger: DataFrame, **cols) -> DataFrame:
    """Per account, without negation: ``sum(sent UNION received)``; when sent
    equals received, UNION leaves one of them."""
    t = account_totals(ledger, **cols)
    return t.select("account", union_sum(F.col("sent"), F.col("received")).cast("double").alias("volume"))


def ledger_count(ledger: DataFrame) -> DataFrame:
    return ledger.agg(F.count(F.lit(1)).alias("n_rows"))


def _attach(requests: DataFrame, totals: DataFrame, on: str, prefix: str, cols: tuple[str, ...]) -> DataFrame:
    side = totals.select(
        F.col("account").alias(f"_{prefix}_account"), *[F.col(c).alias(f"_{prefix}_{c}") for c in cols]
    )
    return requests.join(side, F.col(on) == F.col(f"_{prefix}_account"), "left").drop(f"_{prefix}_account")


def sent_totals(ledger: DataFrame) -> DataFrame:
    """``(account, sent)`` by sender: one partial aggregate, no explode."""
    return ledger.groupBy(F.col("from_id").alias("account")).agg(F.sum(money("amount")).alias("sent"))


def received_totals(ledger: DataFrame) -> DataFrame:
    """``(account, received)`` by receiver."""
    return ledger.groupBy(F.col("to_id").alias("account")).agg(F.sum(money("amount")).alias("received"))


def balance_per_request(
    requests: DataFrame, ledger: DataFrame | None, out_col: str = "balance", totals: DataFrame | None = None
) -> DataFrame:
    """Wired balance of each request: ``-sent(from_id) + received(to_id)``,
    each side 0 when the account has no rows. The two sides join on different
    keys, so each gets its own narrow aggregate (sender / receiver), unless
    ``totals`` (``account, sent, received``, e.g. carried streaming state)
    is given."""
    sent = totals.select("account", "sent") if totals is not None else sent_totals(ledger)
    received = totals.select("account", "received") if totals is not None else received_totals(ledger)
    r = _attach(requests, sent, "from_id", "f", ("sent",))
    r = _attach(r, received, "to_id", "t", ("received",))
    bal = -F.coalesce(F.col("_f_sent"), F.lit(0).cast(MONEY)) + F.coalesce(F.col("_t_received"), F.lit(0).cast(MONEY))
    return r.withColumn(out_col, bal.cast("double")).drop("_f_sent", "_t_received")


def balance_per_account(
    requests: DataFrame, ledger: DataFrame | None, out_col: str = "balance", totals: DataFrame | None = None
) -> DataFrame:
    """Account balance of each request's sender: ``sum(-sent UNION received)``,
    both for ``from_id``; NULL when the account has no rows. Also gives the
    text form (``balance_text``, two decimals)."""
    t = totals if totals is not None else account_totals(ledger)
    r = _attach(requests, t, "from_id", "a", ("sent", "received"))
    bal = union_sum(-F.col("_a_sent"), F.col("_a_received"))
    return (
        r.withColumn(out_col, bal.cast("double"))
        .withColumn(f"{out_col}_text", bal.cast(MONEY_TEXT).cast("string"))
        .drop("_a_sent", "_a_received")
    )


def balance_cross_account(requests: DataFrame, ledger: DataFrame, out_col: str = "balance") -> DataFrame:
    """``sum(-sent(from_id) UNION received(to_id))`` per request: the account
    balance with the two accounts differing."""
    r = _attach(requests, sent_totals(ledger), "from_id", "f", ("sent",))
    r = _attach(r, received_totals(ledger), "to_id", "t", ("received",))
    bal = union_sum(-F.col("_f_sent"), F.col("_t_received"))
    return r.withColumn(out_col, bal.cast("double")).drop("_f_sent", "_t_received")


def signed_account_amounts(ledger: DataFrame) -> DataFrame:
    """``(account, amount)`` rows of ``-sum sent`` and of ``sum received`` with
    UNION (set) semantics: the inner query of the balance SQL, for all accounts."""
    credits = ledger.groupBy(F.col("from_id").alias("account")).agg((-F.sum(money("amount"))).alias("amount"))
    debits = ledger.groupBy(F.col("to_id").alias("account")).agg(F.sum(money("amount")).alias("amount"))
    return _union_distinct(credits, debits).select("account", F.col("amount").cast("double").alias("amount"))


def ledger_latest_first(ledger: DataFrame) -> DataFrame:
    """All rows, newest first (ties by id). A global sort: range-partitioned,
    so it spreads over all tasks."""
    return ledger.orderBy(F.col("timestamp").desc(), F.col("id").asc())


def ledger_latest_n(ledger: DataFrame, n: int = 100) -> DataFrame:
    """The ``n`` newest rows (top-k: per-task heaps, then one merge of k rows)."""
    return ledger_latest_first(ledger).limit(n)
