"""Registered queries and their independent SQL oracles.

Every query reads the driver's ``events`` table in full, as transfers (see
``tollgate.sources.events``). Queries that need a ledger and requests take the
first half of the time span as the ledger and the rest as requests, split at a
point that comes from the data. Oracle SQL is written for DuckDB against the
same parquet files and recomputes each result from ``events`` on its own
(recursive CTE for the throttle, UNION subqueries for the balances, window
``lag`` for the previous request).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tollgate.operators import filters, history, insync, ledger as L, rules as R, throttle as TH
from tollgate.operators.partitioning import spread
from tollgate.plans.pipeline import transfer_pipeline
from tollgate.sinks import ledger_table as LT
from tollgate.sinks.messages import error_records
from tollgate.sources import cdc, events as EV, messages as M
from tollgate.staging.change_events import change_events, with_faults
from tollgate.sources.rules import rules_table

# Parameters of the registered queries (the API defaults stay those of the
# reference: 20 s cooldown). The median gap between two requests of one
# sender in the test data is hours, so 20 s would refuse nothing.
COOLDOWN_MS = 6 * 3_600_000
DENSE_COOLDOWN_MS = 5 * 86_400_000
#: Longer than the time span of the data: a sender's first request is its only one.
SPAN_COOLDOWN_MS = 40 * 86_400_000
INGEST_DELAY_MS = 12 * 3_600_000
LOOKUP_ID = "1234"
LATEST_N = 100

Query = Callable[[SparkSession, str], DataFrame]


# --- queries -----------------------------------------------------------------

def q_not_self_transfer(spark, d):
    return filters.not_self_transfer(EV.transfers(spark, d))


def q_sent_by_account(spark, d):
    return L.sent_by_account(EV.transfers(spark, d))


def q_received_by_account(spark, d):
    return L.received_by_account(EV.transfers(spark, d))


def q_balance_sum(spark, d):
    return L.balance_sum(EV.transfers(spark, d))


def q_volume_union(spark, d):
    return L.volume_union(EV.transfers(spark, d))


def q_ledger_count(spark, d):
    return L.ledger_count(EV.transfers(spark, d))


def q_balance_per_request(spark, d):
    return L.balance_per_request(EV.requests(spark, d), EV.ledger(spark, d))


def q_balance_per_account(spark, d):
    return L.balance_per_account(EV.requests(spark, d), EV.ledger(spark, d))


def q_balance_cross_account(spark, d):
    return L.balance_cross_account(EV.requests(spark, d), EV.ledger(spark, d))


def q_union_distinct(spark, d):
    return L.signed_account_amounts(EV.transfers(spark, d))


def q_ledger_latest_first(spark, d):
    return L.ledger_latest_first(EV.transfers(spark, d))


def q_ledger_latest_n(spark, d):
    return L.ledger_latest_n(EV.transfers(spark, d), LATEST_N)


def q_ledger_point_lookup(spark, d):
    return filters.ledger_point_lookup(EV.transfers(spark, d), LOOKUP_ID)


def q_throttle(spark, d):
    t = TH.throttle(EV.transfers(spark, d), COOLDOWN_MS)
    return t.select("id", "from_id", "timestamp", "allowed")


def q_throttle_dense(spark, d):
    """A cooldown within which every sender is busy: one chain a sender."""
    return TH.throttle(EV.transfers(spark, d), DENSE_COOLDOWN_MS).select("id", "from_id", "timestamp", "allowed")


def q_throttle_span(spark, d):
    """A cooldown over the whole time span: every step of a chain leaves it."""
    return TH.throttle(EV.transfers(spark, d), SPAN_COOLDOWN_MS).select("id", "from_id", "timestamp", "allowed")


def q_throttle_split(spark, d):
    return TH.throttle_split(EV.transfers(spark, d), COOLDOWN_MS).select("id", "from_id", "timestamp", "error")


def q_split_flag(spark, d):
    t = TH.throttle_split(EV.transfers(spark, d), COOLDOWN_MS)
    return filters.side(t).select("id", "error")


def q_error_message(spark, d):
    t = filters.side(TH.throttle_split(EV.transfers(spark, d), COOLDOWN_MS))
    return error_records(t).select("value")


def q_last_request(spark, d):
    return history.last_request(EV.transfers(spark, d)).select("id", "from_id", "last_id")


def q_balance_rule_split(spark, d):
    b = L.balance_per_request(EV.requests(spark, d), EV.ledger(spark, d))
    return R.balance_rule_split(b, rules_table(spark)).select("id", "pool_type", "balance", "min_balance", "error")


def _with_last(spark, d):
    return history.last_request(EV.requests(spark, d), ts_out_col="last_ts")


def _ids(spark, d):
    return insync.visible_ids(EV.ledger(spark, d))


def q_ledger_in_sync(spark, d):
    s = insync.ledger_in_sync(_with_last(spark, d), _ids(spark, d), ingest_delay_ms=INGEST_DELAY_MS)
    return s.select("id", "last_id", "in_sync")


def q_in_sync_bucketed(spark, d):
    """The in-sync check against a bucketed table of the ledger's ids, appended
    in two parts that overlap."""
    from tollgate.session import work_dir
    from tollgate.sinks.id_table import IdTable

    place = work_dir(spark, "ledger-ids")
    ids, ledger = IdTable(spark, "ledger_ids_" + place[-12:], place, buckets=16), EV.ledger(spark, d)
    ids.append(ledger.filter(F.pmod(F.xxhash64("id"), F.lit(3)) != 0))
    ids.append(ledger.filter(F.pmod(F.xxhash64("id"), F.lit(3)) != 1))
    s = insync.ledger_in_sync(_with_last(spark, d), ids.read(), ingest_delay_ms=INGEST_DELAY_MS)
    return s.select("id", "last_id", "in_sync")


def q_lookup_row_count(spark, d):
    return insync.lookup_row_count(_with_last(spark, d), _ids(spark, d), ingest_delay_ms=INGEST_DELAY_MS)


def q_in_progress_split(spark, d):
    s = insync.in_progress_split(_with_last(spark, d), _ids(spark, d), ingest_delay_ms=INGEST_DELAY_MS)
    return s.select("id", "error")


def _pipeline(spark, d):
    return transfer_pipeline(
        EV.requests(spark, d), EV.ledger(spark, d), rules_table(spark),
        cooldown_ms=COOLDOWN_MS, ingest_delay_ms=INGEST_DELAY_MS,
    )


def q_transfer_pipeline(spark, d):
    return _pipeline(spark, d).outcomes.select("id", "from_id", "to_id", "amount", "timestamp", "error")


def q_ledger_records(spark, d):
    return _pipeline(spark, d).ledger_records


def q_write_errors(spark, d):
    return _pipeline(spark, d).error_records


def q_with_sender_key(spark, d):
    return filters.with_sender_key(EV.transfers(spark, d)).select("id", "key")


def _messages(spark, d):
    return M.transfer_messages(spread(EV.transfers(spark, d)))


def q_read_transfers_json(spark, d):
    good, _ = M.read_transfers_json(_messages(spark, d))  # q_read_transfers_quarantine has the others
    return good


def _with_malformed(messages):
    """Messages of which some are cut short and some have text as the amount."""
    n = F.col("offset") % 10
    cut_short = F.substring("value", 1, 30)
    wrong = F.regexp_replace("value", '"amount":[^,]*,', '"amount":"abc",')
    return messages.withColumn("value", F.when(n == 3, cut_short).when(n == 7, wrong).otherwise(F.col("value")))


def q_read_transfers_quarantine(spark, d):
    good, bad = M.read_transfers_json(_with_malformed(_messages(spark, d)))
    return good.select("id", F.lit(None).cast("string").alias("malformed")).unionByName(
        bad.select(F.lit(None).cast("string").alias("id"), F.col(M.CORRUPT_COL).alias("malformed")))


def q_balance_sum_fine(spark, d):
    """Amounts far below a cent: none is rounded away."""
    return L.balance_sum(EV.transfers(spark, d).withColumn("amount", F.col("amount") / 1000))


def q_read_keyed_transfers(spark, d):
    return M.read_keyed_transfers(_messages(spark, d))[0]


def q_key_greeting(spark, d):
    return M.read_keyed_transfers(_messages(spark, d))[0].select("id", "greeting")


def q_cdc_parse(spark, d):
    return cdc.cdc_parse(change_events(spread(EV.transfers(spark, d))))


def q_cdc_current_state(spark, d):
    return cdc.cdc_current_state(cdc.cdc_parse(change_events(spread(EV.transfers(spark, d)))))


def _faulty_changes(spark, d):
    t = EV.transfers(spark, d)
    return with_faults(change_events(spread(t)), t)


def q_cdc_faults_state(spark, d):
    """The batch fold with malformed events and a truncate among the events."""
    return cdc.cdc_current_state(cdc.cdc_parse(_faulty_changes(spark, d)))


def q_cdc_malformed(spark, d):
    return cdc.cdc_read(_faulty_changes(spark, d))[1].select(F.col("_corrupt").alias("malformed"))


def q_read_transfers_file(spark, d):
    from tollgate.session import work_dir

    path = work_dir(spark, "requests-json")
    EV.transfers(spark, d).select(M.transfer_json().alias("value")).write.mode("overwrite").text(path)
    return M.read_transfers_file(spark, path)[0]


def q_ledger_table(spark, d):
    import uuid

    from tollgate.session import work_dir

    name = f"ledger_{uuid.uuid4().hex[:10]}"
    LT.create_ledger(spark, name, work_dir(spark, "ledger-table"))
    for _ in range(2):  # the second time as after a failure: nothing is added
        LT.insert_ledger(spark, name, EV.transfers(spark, d))
    return LT.read_ledger(spark, name)


def _streaming_queries() -> dict[str, Query]:
    from tollgate.streaming import queries as SQ

    names = ("ledger_ingest", "ledger_ingest_quarantine", "ledger_segments_stream", "throttle_stream", "throttle_stateful_stream", "last_request_stream",
             "last_request_stateful_stream", "transfer_pipeline_stream", "rules_latest_stream", "throttle_in_order_stream", "last_request_in_order_stream",
             "rule_updates_stream", "once_each_stream", "rule_passthrough_stream", "enrich_ordered_stream", "cdc_state_stream", "cdc_malformed_stream")
    return {n: getattr(SQ, f"q_{n}") for n in names if hasattr(SQ, f"q_{n}")}


def queries() -> dict[str, Query]:
    q = {
        "not_self_transfer": q_not_self_transfer,
        "sent_by_account": q_sent_by_account,
        "received_by_account": q_received_by_account,
        "balance_sum": q_balance_sum,
        "volume_union": q_volume_union,
        "ledger_count": q_ledger_count,
        "balance_per_request": q_balance_per_request,
        "balance_per_account": q_balance_per_account,
        "balance_cross_account": q_balance_cross_account,
        "union_distinct": q_union_distinct,
        "ledger_latest_first": q_ledger_latest_first,
        "ledger_latest_n": q_ledger_latest_n,
        "ledger_point_lookup": q_ledger_point_lookup,
        "throttle": q_throttle,
        "throttle_dense": q_throttle_dense,
        "throttle_span": q_throttle_span,
        "throttle_split": q_throttle_split,
        "split_flag": q_split_flag,
        "error_message": q_error_message,
        "last_request": q_last_request,
        "balance_rule_split": q_balance_rule_split,
        "ledger_in_sync": q_ledger_in_sync,
        "in_sync_bucketed": q_in_sync_bucketed,
        "lookup_row_count": q_lookup_row_count,
        "in_progress_split": q_in_progress_split,
        "transfer_pipeline": q_transfer_pipeline,
        "ledger_records": q_ledger_records,
        "write_errors": q_write_errors,
        "with_sender_key": q_with_sender_key,
        "read_transfers_json": q_read_transfers_json,
        "read_transfers_quarantine": q_read_transfers_quarantine,
        "balance_sum_fine": q_balance_sum_fine,
        "read_keyed_transfers": q_read_keyed_transfers,
        "key_greeting": q_key_greeting,
        "read_transfers_file": q_read_transfers_file,
        "cdc_parse": q_cdc_parse,
        "cdc_current_state": q_cdc_current_state,
        "cdc_faults_state": q_cdc_faults_state,
        "cdc_malformed": q_cdc_malformed,
        "ledger_table": q_ledger_table,
    }
    q.update(_streaming_queries())
    return q


# --- oracle SQL (DuckDB) -----------------------------------------------------------

# Through text: the shortest digits of the double, as the decimals are made in Spark.
_MONEY = "CAST(CAST(amount AS VARCHAR) AS DECIMAL(28,15))"

_BASE = """
WITH RECURSIVE transfers AS (
  SELECT CAST(event_id AS VARCHAR) AS id,
         CAST(user_id AS VARCHAR) AS from_id,
         CAST((event_id * 31 + 7) % (SELECT max(user_id) + 1 FROM events) AS VARCHAR) AS to_id,
         'coro' AS pool_id,
         CASE WHEN event_type IN ('click', 'view') THEN 'easy'
              WHEN event_type IN ('purchase', 'signup') THEN 'medium'
              WHEN event_type = 'error' THEN 'hard' END AS pool_type,
         value AS amount,
         epoch_us(ts) // 1000 AS "timestamp"
  FROM events
),
cut AS (SELECT (min("timestamp") + max("timestamp")) // 2 AS ms FROM transfers),
ledger AS (SELECT * FROM transfers WHERE "timestamp" < (SELECT ms FROM cut)),
requests AS (SELECT * FROM transfers WHERE "timestamp" >= (SELECT ms FROM cut)),
s AS (SELECT from_id AS account, sum({money}) AS sent FROM ledger GROUP BY from_id),
r AS (SELECT to_id AS account, sum({money}) AS received FROM ledger GROUP BY to_id),
sa AS (SELECT from_id AS account, sum({money}) AS sent FROM transfers GROUP BY from_id),
ra AS (SELECT to_id AS account, sum({money}) AS received FROM transfers GROUP BY to_id),
rules(pool_type, min_balance) AS (VALUES ('easy', -40.0::DOUBLE), ('medium', 0.0::DOUBLE), ('hard', 40.0::DOUBLE))
""".replace("{money}", _MONEY)


def _throttle_ctes(src: str, cooldown_ms: int) -> str:
    # Greedy chain per sender by recursion: start at the first point, follow
    # "first point at least a cooldown later"; among equal times the smallest id.
    return f""",
pts AS (SELECT from_id, "timestamp" AS t, min(id) AS win FROM {src} GROUP BY from_id, "timestamp"),
nx AS (
  SELECT p.from_id, p.t,
         (SELECT min(q.t) FROM pts q WHERE q.from_id = p.from_id AND q.t >= p.t + {cooldown_ms}) AS nt
  FROM pts p
),
chain(from_id, t) AS (
  SELECT from_id, min(t) FROM pts GROUP BY from_id
  UNION ALL
  SELECT c.from_id, n.nt FROM chain c JOIN nx n ON n.from_id = c.from_id AND n.t = c.t WHERE n.nt IS NOT NULL
),
thr AS (
  SELECT q.*, (c.t IS NOT NULL AND q.id = p.win) AS allowed
  FROM {src} q
  LEFT JOIN (SELECT DISTINCT from_id, t FROM chain) c ON c.from_id = q.from_id AND c.t = q."timestamp"
  LEFT JOIN pts p ON p.from_id = q.from_id AND p.t = q."timestamp"
)"""


def _union_sum(x: str, y: str) -> str:
    return f"(SELECT sum(v) FROM (SELECT {x} AS v UNION SELECT {y}) u)"


_LAST = """,
lr AS (SELECT q.*, lag(id) OVER (PARTITION BY from_id ORDER BY "timestamp", id) AS last_id FROM requests q),
vis AS (SELECT id, NULL::BIGINT AS visible_at FROM ledger
        UNION ALL SELECT id, "timestamp" + {delay} FROM requests),
sy AS (
  SELECT l.*, (l.last_id IS NULL OR EXISTS (
      SELECT 1 FROM vis v WHERE v.id = l.last_id AND (v.visible_at IS NULL OR v.visible_at <= l."timestamp"))) AS in_sync
  FROM lr l
)""".replace("{delay}", str(INGEST_DELAY_MS))

_OWN_ROWS = f"""
        UNION ALL SELECT id, "timestamp" + {INGEST_DELAY_MS} FROM balanced"""

_PIPE = (
    _BASE.replace("requests AS (", "requests0 AS (")
    + """,
requests AS (SELECT * FROM requests0 WHERE from_id <> to_id)"""
    + _throttle_ctes("requests", COOLDOWN_MS)
    + """,
bal AS (
  SELECT t.*, CAST(-coalesce(s.sent, 0) + coalesce(r.received, 0) AS DOUBLE) AS balance
  FROM thr t LEFT JOIN s ON s.account = t.from_id LEFT JOIN r ON r.account = t.to_id
  WHERE t.allowed
),
rl AS (
  SELECT b.*, CASE WHEN b.balance > ru.min_balance THEN NULL ELSE 'INSUFFICIENT_BALANCE' END AS error2
  FROM bal b LEFT JOIN rules ru ON ru.pool_type = b.pool_type
),
balanced AS (SELECT id, from_id, to_id, pool_id, pool_type, amount, "timestamp" FROM rl WHERE error2 IS NULL),
lr AS (SELECT b.*, lag(id) OVER (PARTITION BY from_id ORDER BY "timestamp", id) AS last_id FROM balanced b),
vis AS (SELECT id, NULL::BIGINT AS visible_at FROM ledger
        UNION ALL SELECT id, "timestamp" + {delay} FROM balanced),
sy AS (
  SELECT l.*, (l.last_id IS NULL OR EXISTS (
      SELECT 1 FROM vis v WHERE v.id = l.last_id AND (v.visible_at IS NULL OR v.visible_at <= l."timestamp"))) AS in_sync
  FROM lr l
),
outcomes AS (
  SELECT id, from_id, to_id, pool_id, pool_type, amount, "timestamp", 'TOO_MANY_REQUESTS' AS error FROM thr WHERE NOT allowed
  UNION ALL
  SELECT id, from_id, to_id, pool_id, pool_type, amount, "timestamp", error2 FROM rl WHERE error2 IS NOT NULL
  UNION ALL
  SELECT id, from_id, to_id, pool_id, pool_type, amount, "timestamp",
         CASE WHEN in_sync THEN NULL ELSE 'TRANSFER_IN_PROGRESS' END FROM sy
)
""".replace("{delay}", str(INGEST_DELAY_MS))
)

_TEXT = (
    "error || '>Transfer(id=' || id || ', fromId=' || from_id || ', toId=' || to_id || ', poolId=' || pool_id"
    " || ', poolType=' || coalesce(pool_type, 'null') || ', amount=' || CAST(amount AS VARCHAR)"
    " || ', timestamp=' || CAST(\"timestamp\" AS VARCHAR) || ')'"
)
_JSON = (
    "'{\"id\":\"' || id || '\",\"fromId\":\"' || from_id || '\",\"toId\":\"' || to_id || '\",\"poolId\":\"' || pool_id"
    " || '\",\"poolType\":' || coalesce('\"' || pool_type || '\"', 'null') || ',\"amount\":' || CAST(amount AS VARCHAR)"
    " || ',\"timestamp\":' || CAST(\"timestamp\" AS VARCHAR) || '}'"
)

_CDC = """,
ev AS (
  SELECT CASE WHEN CAST(id AS BIGINT) % 5 = 0 THEN 'r' ELSE 'c' END AS op, "timestamp" AS ts_ms,
         CASE WHEN CAST(id AS BIGINT) % 10 <> 0 THEN CAST(id AS BIGINT) * 4 END AS lsn, 'transfers' AS "table",
         id, from_id, to_id, pool_id, round(amount, 2) AS amount, "timestamp" FROM transfers
  UNION ALL
  SELECT 'u', "timestamp" + 1000, CAST(id AS BIGINT) * 4 + 1, 'transfers',
         id, from_id, to_id, pool_id, round(amount * 2, 2), "timestamp" FROM transfers WHERE pool_type = 'medium'
  UNION ALL
  SELECT 'd', "timestamp" + 2000, CAST(id AS BIGINT) * 4 + 2, 'transfers',
         id, from_id, to_id, pool_id, round(amount, 2), "timestamp" FROM transfers WHERE pool_type = 'hard'
)
"""


def oracle_sql() -> dict[str, str]:
    b = _BASE
    o = {
        "not_self_transfer": b + "SELECT * FROM transfers WHERE from_id <> to_id",
        "sent_by_account": b + "SELECT account, CAST(-sent AS DOUBLE) AS credit FROM sa",
        "received_by_account": b + "SELECT account, CAST(received AS DOUBLE) AS debit FROM ra",
        "balance_sum": b
        + ", accts AS (SELECT account FROM sa UNION SELECT account FROM ra)\n"
        + f"SELECT a.account, CAST({_union_sum('-s.sent', 'r.received')} AS DOUBLE) AS balance\n"
        + "FROM accts a LEFT JOIN sa s ON s.account = a.account LEFT JOIN ra r ON r.account = a.account",
        "volume_union": b
        + ", accts AS (SELECT account FROM sa UNION SELECT account FROM ra)\n"
        + f"SELECT a.account, CAST({_union_sum('s.sent', 'r.received')} AS DOUBLE) AS volume\n"
        + "FROM accts a LEFT JOIN sa s ON s.account = a.account LEFT JOIN ra r ON r.account = a.account",
        "ledger_count": b + "SELECT count(*) AS n_rows FROM transfers",
        "balance_per_request": b
        + "SELECT q.*, CAST(-coalesce(s.sent, 0) + coalesce(r.received, 0) AS DOUBLE) AS balance\n"
        + "FROM requests q LEFT JOIN s ON s.account = q.from_id LEFT JOIN r ON r.account = q.to_id",
        "balance_per_account": b
        + f"SELECT q.*, CAST({_union_sum('-s.sent', 'r.received')} AS DOUBLE) AS balance,\n"
        + f"       CAST(CAST({_union_sum('-s.sent', 'r.received')} AS DECIMAL(38,2)) AS VARCHAR) AS balance_text\n"
        + "FROM requests q LEFT JOIN s ON s.account = q.from_id LEFT JOIN r ON r.account = q.from_id",
        "balance_cross_account": b
        + f"SELECT q.*, CAST({_union_sum('-s.sent', 'r.received')} AS DOUBLE) AS balance\n"
        + "FROM requests q LEFT JOIN s ON s.account = q.from_id LEFT JOIN r ON r.account = q.to_id",
        "union_distinct": b
        + "SELECT account, CAST(amount AS DOUBLE) AS amount FROM (\n"
        + "  SELECT from_id AS account, -sum(" + _MONEY + ") AS amount FROM transfers GROUP BY from_id\n"
        + "  UNION\n"
        + "  SELECT to_id AS account, sum(" + _MONEY + ") AS amount FROM transfers GROUP BY to_id) x",
        "ledger_latest_first": b + 'SELECT * FROM transfers ORDER BY "timestamp" DESC, id',
        "ledger_latest_n": b + f'SELECT * FROM transfers ORDER BY "timestamp" DESC, id LIMIT {LATEST_N}',
        "ledger_point_lookup": b + f"SELECT * FROM transfers WHERE id = '{LOOKUP_ID}'",
        "throttle": b + _throttle_ctes("transfers", COOLDOWN_MS)
        + '\nSELECT id, from_id, "timestamp", allowed FROM thr',
        "throttle_dense": b + _throttle_ctes("transfers", DENSE_COOLDOWN_MS)
        + '\nSELECT id, from_id, "timestamp", allowed FROM thr',
        "throttle_span": b + _throttle_ctes("transfers", SPAN_COOLDOWN_MS)
        + '\nSELECT id, from_id, "timestamp", allowed FROM thr',
        "throttle_split": b + _throttle_ctes("transfers", COOLDOWN_MS)
        + "\nSELECT id, from_id, \"timestamp\", CASE WHEN allowed THEN NULL ELSE 'TOO_MANY_REQUESTS' END AS error FROM thr",
        "split_flag": b + _throttle_ctes("transfers", COOLDOWN_MS)
        + "\nSELECT id, 'TOO_MANY_REQUESTS' AS error FROM thr WHERE NOT allowed",
        "error_message": b + _throttle_ctes("transfers", COOLDOWN_MS)
        + f"\nSELECT {_TEXT} AS value FROM (SELECT *, 'TOO_MANY_REQUESTS' AS error FROM thr WHERE NOT allowed) e",
        "last_request": b
        + 'SELECT id, from_id, lag(id) OVER (PARTITION BY from_id ORDER BY "timestamp", id) AS last_id FROM transfers',
        "balance_rule_split": b
        + ", bal AS (SELECT q.*, CAST(-coalesce(s.sent, 0) + coalesce(r.received, 0) AS DOUBLE) AS balance\n"
        + "  FROM requests q LEFT JOIN s ON s.account = q.from_id LEFT JOIN r ON r.account = q.to_id)\n"
        + "SELECT b.id, b.pool_type, b.balance, ru.min_balance,\n"
        + "       CASE WHEN b.balance > ru.min_balance THEN NULL ELSE 'INSUFFICIENT_BALANCE' END AS error\n"
        + "FROM bal b LEFT JOIN rules ru ON ru.pool_type = b.pool_type",
        "ledger_in_sync": b + _LAST + "\nSELECT id, last_id, in_sync FROM sy",
        "lookup_row_count": b + _LAST
        + "\nSELECT l.id, l.last_id, (SELECT count(*) FROM vis v WHERE v.id = l.last_id\n"
        + '   AND (v.visible_at IS NULL OR v.visible_at <= l."timestamp")) AS row_count FROM lr l',
        "in_progress_split": b + _LAST
        + "\nSELECT id, CASE WHEN in_sync THEN NULL ELSE 'TRANSFER_IN_PROGRESS' END AS error FROM sy",
        "transfer_pipeline": _PIPE + 'SELECT id, from_id, to_id, amount, "timestamp", error FROM outcomes',
        "ledger_records": _PIPE + f"SELECT from_id AS key, {_JSON} AS value, 'transfers_4' AS topic FROM balanced",
        "write_errors": _PIPE
        + f"SELECT CAST(NULL AS VARCHAR) AS key, {_TEXT} AS value, 'houston' AS topic FROM outcomes WHERE error IS NOT NULL",
        "with_sender_key": b + "SELECT id, from_id AS key FROM transfers",
        "read_transfers_json": b + "SELECT id, from_id, to_id, pool_id, pool_type, amount, \"timestamp\" FROM transfers",
        "read_transfers_quarantine": b
        + "SELECT CASE WHEN CAST(id AS BIGINT) % 10 NOT IN (3, 7) THEN id END AS id,\n"
        + f"  CASE CAST(id AS BIGINT) % 10 WHEN 3 THEN substr({_JSON}, 1, 30) WHEN 7 THEN regexp_replace({_JSON}, '\"amount\":[^,]*,', '\"amount\":\"abc\",') END AS malformed\n"
        + "FROM transfers",
        "balance_sum_fine": b.replace("value AS amount", "value / 1000 AS amount")
        + ", accts AS (SELECT account FROM sa UNION SELECT account FROM ra)\n"
        + f"SELECT a.account, CAST({_union_sum('-s.sent', 'r.received')} AS DOUBLE) AS balance\n"
        + "FROM accts a LEFT JOIN sa s ON s.account = a.account LEFT JOIN ra r ON r.account = a.account",
        "read_keyed_transfers": b
        + "SELECT id, from_id, to_id, pool_id, pool_type, amount, \"timestamp\", 'Hi ' || from_id AS greeting FROM transfers",
        "key_greeting": b + "SELECT id, 'Hi ' || from_id AS greeting FROM transfers",
        "read_transfers_file": b + "SELECT * FROM transfers",
        "cdc_parse": b + _CDC + 'SELECT op, ts_ms, lsn, "table", id, from_id, to_id, pool_id, amount, "timestamp" FROM ev',
        "cdc_current_state": b + _CDC
        + ", newest AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY coalesce(lsn, -1) DESC, ts_ms DESC) AS rn FROM ev)\n"
        + 'SELECT id, from_id, to_id, pool_id, amount, "timestamp" FROM newest WHERE rn = 1 AND op <> \'d\'',
        "ledger_table": b
        + 'SELECT id, from_id, to_id, pool_id, CAST(CAST(amount AS DECIMAL(6,2)) AS DOUBLE) AS amount, "timestamp" FROM transfers',
        "ledger_ingest": b + "SELECT * FROM transfers",
        "ledger_ingest_quarantine": None,
        "throttle_stream": None,
        "last_request_stream": None,
    }
    # The job's ledger stands still: only rows of the base ledger are visible.
    frozen = _PIPE.replace(_OWN_ROWS, "")
    records = f"SELECT from_id AS key, {_JSON} AS value, 'transfers_4' AS topic"
    o["transfer_pipeline_stream"] = (
        frozen + records + " FROM balanced\nUNION ALL " + records + " FROM outcomes WHERE error IS NULL\n"
        + f"UNION ALL SELECT CAST(NULL AS VARCHAR), {_TEXT}, 'houston' FROM outcomes WHERE error IS NOT NULL"
    )
    # Four day files a micro-batch; the third has new rules.
    o["rules_latest_stream"] = (
        _PIPE + ", days AS (SELECT d, row_number() OVER (ORDER BY d) AS n FROM (SELECT DISTINCT \"timestamp\" // 86400000 AS d FROM requests0))\n"
        + records + " FROM thr JOIN days ON d = \"timestamp\" // 86400000 JOIN rules ru USING (pool_type) WHERE allowed AND n <= 8 AND 0.0 > ru.min_balance"
    )
    cut = " AND ".join(f"CAST(id AS BIGINT) % {m} {r}" for m, r in ((2, "= 1"), (5, "<> 0"), (7, "= 0")))
    o["cdc_faults_state"] = b + _CDC + f"""
, truncated AS (SELECT (max(CAST(id AS BIGINT)) - 99) * 4 AS lsn FROM transfers)
, newest AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY coalesce(lsn, -1) DESC, ts_ms DESC) AS rn FROM ev WHERE NOT (op = 'c' AND {cut}))
SELECT n.id, from_id, to_id, pool_id, amount, "timestamp" FROM newest n, truncated t
WHERE rn = 1 AND op <> 'd' AND (coalesce(n.lsn, -1) > t.lsn OR (n.lsn = t.lsn AND ts_ms > 0))"""
    o["cdc_malformed"] = b + f"""
SELECT substr('{{"op":"c","ts_ms":' || "timestamp" || ',"source":{{"lsn":' || CAST(id AS BIGINT) * 4 || ',"table":"transfers"', 1, 40) AS malformed FROM transfers WHERE {cut}
UNION ALL SELECT 'not json ' || id FROM transfers WHERE CAST(id AS BIGINT) % 11 = 0
UNION ALL SELECT '{{"op":"x","ts_ms":' || id || '}}' FROM transfers WHERE CAST(id AS BIGINT) % 11 = 0"""
    o["cdc_state_stream"], o["cdc_malformed_stream"] = o["cdc_faults_state"], o["cdc_malformed"]
    o["rule_updates_stream"] = (
        b + ", updates AS (SELECT pool_type, (\"timestamp\" // 86400000) * 86400000 + 43200000 AS since, min(amount) AS min_balance FROM requests GROUP BY 1, 2\n"
        + "  UNION ALL SELECT pool_type, -1, min_balance FROM rules),\n"
        + "bal AS (SELECT q.*, CAST(-coalesce(s.sent, 0) + coalesce(r.received, 0) AS DOUBLE) AS balance\n"
        + "  FROM requests q LEFT JOIN s ON s.account = q.from_id LEFT JOIN r ON r.account = q.to_id)\n"
        + "SELECT b.id, b.pool_type, b.balance, u.min_balance, CASE WHEN b.balance > u.min_balance THEN NULL ELSE 'INSUFFICIENT_BALANCE' END AS error\n"
        + "FROM bal b ASOF JOIN updates u ON u.pool_type = b.pool_type AND u.since <= b.\"timestamp\""
    )
    o["throttle_in_order_stream"] = o["throttle"]
    o["enrich_ordered_stream"] = (
        b + "SELECT row_number() OVER (ORDER BY \"timestamp\", id) AS position, id,\n"
        + "  CASE WHEN CAST(id AS BIGINT) % 24 <= 12 THEN amount END AS value,\n"
        + "  CASE WHEN CAST(id AS BIGINT) % 24 <= 12 THEN 'FOUND' ELSE 'LOOKUP_TIMEOUT' END AS outcome FROM requests"
    )
    o["once_each_stream"] = b + "SELECT * FROM transfers"
    o["rule_passthrough_stream"] = (
        b + ", days AS (SELECT \"timestamp\" // 86400000 AS d, count(DISTINCT pool_type) AS n FROM requests GROUP BY 1)\n"
        + "SELECT (rk - 1) // 4 AS batch_id, CAST(sum(n) AS BIGINT) AS n_rules FROM (SELECT *, row_number() OVER (ORDER BY d) AS rk FROM days) GROUP BY 1"
    )
    o["last_request_in_order_stream"] = o["last_request"]
    o["in_sync_bucketed"] = o["ledger_in_sync"]
    o["ledger_segments_stream"] = (
        "WITH every AS (" + o["read_transfers_quarantine"] + "), t AS (" + b + "SELECT * FROM transfers)\n"
        + "SELECT t.*, strftime(make_timestamp(t.\"timestamp\" * 1000), '%Y-%m-%d') AS day, CAST(NULL AS VARCHAR) AS malformed FROM every JOIN t USING (id)\n"
        + "UNION ALL SELECT NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, malformed FROM every WHERE malformed IS NOT NULL"
    )
    o["throttle_stream"] = o["throttle"]
    o["ledger_ingest_quarantine"] = o["read_transfers_quarantine"]
    o["throttle_stateful_stream"] = o["throttle"]
    o["last_request_stream"] = o["last_request"]
    o["last_request_stateful_stream"] = o["last_request"]
    return o
