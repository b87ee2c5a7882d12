"""Scalar column functions. All are built-in Spark expressions (JVM side,
whole-stage codegen); none is a Python UDF."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tollgate.schema import GREETING, MONEY, TRANSFER_JSON_FIELDS

_MS_PER_DAY = 86_400_000


def col_(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def epoch_ms_ntz(ts: str | Column) -> Column:
    """Epoch milliseconds of a ``timestamp_ntz`` wall clock read as UTC,
    floored, independent of the session time zone."""
    t = col_(ts)
    day_ms = F.unix_date(t.cast("date")).cast("long") * F.lit(_MS_PER_DAY)
    hm_ms = F.hour(t).cast("long") * 3_600_000 + F.minute(t).cast("long") * 60_000
    sec_ms = F.floor(F.extract(F.lit("SECOND"), t) * 1000).cast("long")
    return day_ms + hm_ms + sec_ms


def event_time(ms: str | Column) -> Column:
    """Epoch-ms long -> timestamp (the declared ``1:MILLISECONDS:EPOCH`` time)."""
    return F.timestamp_millis(col_(ms))


def money(c: str | Column) -> Column:
    """Exact decimal amount, so that sums do not depend on order."""
    return col_(c).cast(MONEY)


def not_self(from_col: str = "from_id", to_col: str = "to_id") -> Column:
    """True when sender and receiver differ; a null side is not kept."""
    return F.coalesce(F.col(from_col) != F.col(to_col), F.lit(False))


def key_greeting(key: str | Column) -> Column:
    """``"Hi " + key``; a null key gives null."""
    return F.concat(F.lit(GREETING), col_(key).cast("string"))


def transfer_struct_json() -> Column:
    """Struct of a transfer with wire (camelCase) names, in wire order."""
    return F.struct(*[F.col(c).alias(w) for w, c in TRANSFER_JSON_FIELDS])


def transfer_json() -> Column:
    """Transfer -> JSON text, nulls written as ``null`` like a bean mapper."""
    return F.to_json(transfer_struct_json(), {"ignoreNullFields": "false"})


def transfer_text() -> Column:
    """Generated data-class text form of a transfer."""
    parts = []
    for i, (wire, c) in enumerate(TRANSFER_JSON_FIELDS):
        sep = "" if i == 0 else ", "
        parts += [F.lit(f"{sep}{wire}="), F.coalesce(F.col(c).cast("string"), F.lit("null"))]
    return F.concat(F.lit("Transfer("), *parts, F.lit(")"))


def error_message(code: str | Column) -> Column:
    """``CODE>Transfer(id=..., ...)`` as sent to the errors topic. ``code`` is
    a literal error code, or a Column holding one."""
    code_c = F.lit(code) if isinstance(code, str) else code
    return F.concat(code_c, F.lit(">"), transfer_text())
