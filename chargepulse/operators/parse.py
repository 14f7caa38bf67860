"""Record parsing and base projections (PRJ1-PRJ8, FLT1, FLT2).

All parsers take a DataFrame with a string ``value`` column (what a topic,
socket or text-file source yields) and return typed columns.  Malformed
records are never fatal: ``*_quarantine`` returns them for inspection and
``require_clean`` raises when a caller wants the reference's fail-fast
behaviour.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ip import with_ip_num
from ..functions.timefmt import compact_ts_millis, prefix

# Fixed values that must equal the source system's: the accepted interface
# name (compared case-insensitively) and the success result code.
TOPUP_SERVICE = "reChargeNotifyReq"
SUCCESS_CODE = "0000"

TOPUP_JSON_SCHEMA = (
    "serviceName string, bussinessRst string, chargefee string, "
    "requestId string, receiveNotifyTime string, provinceCode string"
)
PAYMENT_JSON_SCHEMA = "date string, phoneNum string, money string"

FEE_TYPE = "decimal(18,2)"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def _parsed_json(df: DataFrame, value_col, schema: str, keep: Sequence[str] = ()) -> DataFrame:
    """One ``from_json`` per record, as a column of its own: fields selected
    from the column are not rewritten into a parse of their own each."""
    return df.select(F.from_json(_c(value_col), schema).alias("_j"), *keep)


# --------------------------------------------------------------------------
# Top-up notifications (PRJ1, FLT1, PRJ4-PRJ6, PRJ8)
# --------------------------------------------------------------------------

def parse_topup_json(df: DataFrame, value_col: str = "value", keep: Sequence[str] = ()) -> DataFrame:
    """JSON text -> typed top-up record columns (PRJ1), and the columns ``keep`` as they are.

    Every field is read as a string (numbers arrive fine as strings; a
    DOUBLE field would turn a quoted number into NULL) and converted with
    ``try_cast``.  Only the six used fields are parsed.
    """
    df = _parsed_json(df, value_col, TOPUP_JSON_SCHEMA, keep)
    j = F.col("_j")
    rid = j["requestId"]
    req_ms = compact_ts_millis(rid)
    return df.select(
        j["serviceName"].alias("service_name"),
        j["bussinessRst"].alias("result_code"),
        j["chargefee"].try_cast(FEE_TYPE).alias("fee"),
        rid.alias("request_id"),
        j["provinceCode"].alias("province_code"),
        req_ms.alias("request_ms"),
        compact_ts_millis(j["receiveNotifyTime"]).alias("receive_ms"),
        *keep,
    )


def is_topup_notification(service_col="service_name") -> Column:
    """FLT1: interface name equals ``reChargeNotifyReq`` ignoring case."""
    return F.lower(_c(service_col)) == F.lit(TOPUP_SERVICE.lower())


def _topup_valid() -> Column:
    success = F.col("result_code") == SUCCESS_CODE
    return F.coalesce(
        F.col("request_ms").isNotNull() & F.col("result_code").isNotNull()
        & (~success | (F.col("fee").isNotNull() & F.col("receive_ms").isNotNull())), F.lit(False))


def topup_kpi_base(parsed: DataFrame) -> DataFrame:
    """Notification rows -> KPI base rows (PRJ4-PRJ6, PRJ8).

    Columns: ``day`` (8 digits), ``hour`` (10), ``minute`` (12) string
    buckets of the request id, ``province_code``, ``orders`` (=1), ``succ``
    (1 for result ``0000``), ``fee`` and ``cost_ms`` (only for successes,
    else 0), plus ``event_time`` (request time) for event-time use, and
    ``written`` if the parsed rows have the time they arrived (``timestamp``).
    """
    success = F.col("result_code") == SUCCESS_CODE
    rid = F.col("request_id")
    return (
        parsed.where(is_topup_notification() & _topup_valid())
        .select(
            prefix(rid, 8).alias("day"),
            prefix(rid, 10).alias("hour"),
            prefix(rid, 12).alias("minute"),
            F.col("province_code"),
            F.lit(1).cast("bigint").alias("orders"),
            F.when(success, 1).otherwise(0).cast("bigint").alias("succ"),
            F.when(success, F.col("fee")).otherwise(F.lit(0).cast(FEE_TYPE))
            .cast(FEE_TYPE).alias("fee"),
            F.when(success, F.col("receive_ms") - F.col("request_ms"))
            .otherwise(0).cast("bigint").alias("cost_ms"),
            F.timestamp_millis(F.col("request_ms")).alias("event_time"),
            *([F.col("timestamp").alias("written")] if "timestamp" in parsed.columns else []),
        )
    )


def topup_quarantine(parsed: DataFrame) -> DataFrame:
    """Rows that cannot be turned into KPI rows: notifications with missing or
    unreadable fields, and records without JSON or service name.  Base,
    quarantine and the rows of other interfaces add up to the input."""
    return parsed.where(F.col("service_name").isNull() | (is_topup_notification() & ~_topup_valid()))


def topup_part(parsed: DataFrame) -> DataFrame:
    """Adds ``part``: where a row goes, ``base``, ``quarantine`` or ``other``."""
    return parsed.withColumn("part", F.when(F.col("service_name").isNull(), "quarantine").when(
        ~is_topup_notification(), "other").when(_topup_valid(), "base").otherwise("quarantine"))


def other_interfaces(parsed: DataFrame) -> DataFrame:
    """Rows of other interfaces, neither base nor quarantine."""
    return parsed.where(~is_topup_notification())


def parse_topups(df: DataFrame, value_col: str = "value") -> DataFrame:
    """JSON notifications -> KPI base rows (parse + filter + project)."""
    return topup_kpi_base(parse_topup_json(df, value_col))


# --------------------------------------------------------------------------
# Order lines (PRJ3)
# --------------------------------------------------------------------------

def parse_order_lines(df: DataFrame, value_col: str = "value", keep: Sequence[str] = ()) -> DataFrame:
    """Space-delimited ``time ip goods_type detail money`` -> typed columns, and ``keep``.

    Adds ``ip_num`` (strict dotted-quad conversion, NULL when malformed) and
    ``ok`` (at least five fields and an integer amount).
    """
    parts = df.select(F.split(_c(value_col), " ").alias("_p"), *keep)
    money = F.get("_p", 4).try_cast("bigint")
    rec = parts.select(
        F.get("_p", 0).alias("time"),
        F.get("_p", 1).alias("ip"),
        F.get("_p", 2).alias("goods_type"),
        F.get("_p", 3).alias("detail"),
        money.alias("money"),
        F.coalesce(money.isNotNull() & (F.size("_p") >= 5), F.lit(False)).alias("ok"), *keep,
    )
    return with_ip_num(rec, "ip", "ip_num")


def orders_base(df: DataFrame, value_col: str = "value") -> DataFrame:
    return parse_order_lines(df, value_col).where("ok").drop("ok")


def orders_quarantine(df: DataFrame, value_col: str = "value") -> DataFrame:
    return parse_order_lines(df, value_col).where(~F.col("ok"))


# --------------------------------------------------------------------------
# Payments (PRJ2)
# --------------------------------------------------------------------------

def parse_payment_json(df: DataFrame, value_col: str = "value", keep: Sequence[str] = ()) -> DataFrame:
    """JSON ``{date, phoneNum, money}`` -> month (7 chars), day (10 chars),
    phone, money BIGINT, and ``ok``."""
    df = _parsed_json(df, value_col, PAYMENT_JSON_SCHEMA, keep)
    j = F.col("_j")
    d = j["date"]
    money = F.trim(j["money"]).try_cast("bigint")
    return df.select(
        prefix(d, 7).alias("month"),
        prefix(d, 10).alias("day"),
        j["phoneNum"].alias("phone"),
        money.alias("money"),
        F.coalesce(money.isNotNull() & d.rlike(r"^\d{4}-\d{2}-\d{2}")
                   & F.try_to_date(prefix(d, 10), "yyyy-MM-dd").isNotNull()
                   & j["phoneNum"].isNotNull(), F.lit(False)).alias("ok"), *keep,
    )


def payments_base(df: DataFrame, value_col: str = "value") -> DataFrame:
    return parse_payment_json(df, value_col).where("ok").drop("ok")


def payments_quarantine(df: DataFrame, value_col: str = "value") -> DataFrame:
    return parse_payment_json(df, value_col).where(~F.col("ok"))


def require_clean(bad: DataFrame, what: str) -> None:
    """Fail-fast mode: raise if ``bad`` has any row (one bounded action)."""
    sample = bad.limit(5).collect()
    if sample:
        raise ValueError(f"malformed {what} records, e.g. {sample[:3]}")
