"""Indicators (AGG1-AGG11, AGG14, TOP1) as additive metric specs.

A :class:`MetricSpec` splits every indicator in two:

* ``delta(base, ctx)`` -- aggregate a batch of base rows to the metric's keys
  and *additive* measures (sums, counts, or maxima for the offset ledger);
* ``result(sums, ctx)`` -- turn accumulated measures into the published
  columns (name lookups, rates, averages, top-k, decimal -> double).

A batch query is ``result(delta(base))``.  A stream accumulates ``delta`` of
each micro-batch into a keyed state table (``streaming.state``) and applies
``result`` on read, so rates and averages are always recomputed from totals.
Aggregation is partial (map side) then final, so hot keys are pre-combined
before any shuffle.  Dimension lookups run on the aggregated rows, never on
raw events.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.rates import pct_one_decimal
from ..functions.text import java_split_tokens
from .lookup import code_name_lookup, floor_lookup
from .parse import FEE_TYPE

Ctx = dict


@dataclass(frozen=True)
class MetricSpec:
    name: str
    keys: tuple[str, ...]
    measures: dict[str, str]                      # column -> state SQL type
    delta: Callable[[DataFrame, Ctx], DataFrame]
    result: Callable[[DataFrame, Ctx], DataFrame]
    combine: dict[str, str] = field(default_factory=dict)   # column -> "sum"|"max"|"or"
    state_name: str | None = None    # metrics with the same delta share one state
    key_types: dict[str, str] = field(default_factory=dict)  # of keys that are no strings

    @property
    def store(self) -> str:
        return self.state_name or self.name

    def batch(self, base: DataFrame, ctx: Ctx | None = None) -> DataFrame:
        ctx = ctx or {}
        return self.result(self.delta(base, ctx), ctx)


def _sum(col: str, typ: str, alias: str | None = None):
    return F.sum(col).cast(typ).alias(alias or col)


def _dbl(col: str):
    return F.col(col).cast("double").alias(col)


# --------------------------------------------------------------------------
# Top-up indicators
# --------------------------------------------------------------------------

def _daily_delta(base: DataFrame, ctx: Ctx) -> DataFrame:
    return base.groupBy("day").agg(
        _sum("orders", "bigint", "total"), _sum("succ", "bigint"),
        _sum("fee", FEE_TYPE, "money"), _sum("cost_ms", "bigint"))


def _daily_result(s: DataFrame, ctx: Ctx) -> DataFrame:
    return s.select("day", "total", "succ", _dbl("money"), "cost_ms")


DAILY_OVERVIEW = MetricSpec(
    "daily_overview", ("day",),
    {"total": "bigint", "succ": "bigint", "money": FEE_TYPE, "cost_ms": "bigint"},
    _daily_delta, _daily_result)


def _minute_delta(base: DataFrame, ctx: Ctx) -> DataFrame:
    return base.groupBy("day", "hour", "minute").agg(
        _sum("orders", "bigint", "total"), _sum("succ", "bigint"))


MINUTE_TREND = MetricSpec(
    "minute_trend", ("day", "hour", "minute"), {"total": "bigint", "succ": "bigint"},
    _minute_delta, lambda s, ctx: s.select("day", "hour", "minute", "total", "succ"))


def _by_city(s: DataFrame, ctx: Ctx, keys: list[str], measures: list[str]) -> DataFrame:
    """Resolve ``province_code`` to a city name (fallback: the code) and
    re-aggregate, since several codes may resolve to one name."""
    named = code_name_lookup(s, ctx["city_dim"], "province_code", "city")
    return named.groupBy("city", *keys).agg(*[F.sum(m).cast("bigint").alias(m) for m in measures])


def _failures_delta(base: DataFrame, ctx: Ctx) -> DataFrame:
    return (base.where(F.col("succ") == 0)
            .groupBy("province_code", "hour").agg(_sum("orders", "bigint", "fail_count")))


def _failures_result(s: DataFrame, ctx: Ctx) -> DataFrame:
    return _by_city(s, ctx, ["hour"], ["fail_count"]).select("city", "hour", "fail_count")


HOURLY_PROVINCE_FAILURES = MetricSpec(
    "hourly_province_failures", ("province_code", "hour"), {"fail_count": "bigint"},
    _failures_delta, _failures_result)


def _province_delta(base: DataFrame, ctx: Ctx) -> DataFrame:
    return base.groupBy("province_code").agg(
        _sum("orders", "bigint"), _sum("succ", "bigint", "succ_orders"))


def _province_result(s: DataFrame, ctx: Ctx) -> DataFrame:
    c = _by_city(s, ctx, [], ["orders", "succ_orders"])
    return c.select("city", "orders", "succ_orders",
                    pct_one_decimal("succ_orders", "orders").alias("succ_pct"))


PROVINCE_SUCCESS = MetricSpec(
    "province_success", ("province_code",), {"orders": "bigint", "succ_orders": "bigint"},
    _province_delta, _province_result)


def _top10_result(s: DataFrame, ctx: Ctx) -> DataFrame:
    """TOP1: ten cities with most orders (ties by name); a sort+limit that
    plans as TakeOrderedAndProject (per-partition top-k, then merge)."""
    k = ctx.get("top_k", 10)
    return _province_result(s, ctx).orderBy(F.desc("orders"), F.asc("city")).limit(k)


PROVINCE_TOP10 = MetricSpec(
    "province_top10", ("province_code",), {"orders": "bigint", "succ_orders": "bigint"},
    _province_delta, _top10_result, state_name="province_success")


def _hourly_amount_delta(base: DataFrame, ctx: Ctx) -> DataFrame:
    return base.groupBy("hour").agg(_sum("succ", "bigint", "succ_orders"),
                                    _sum("fee", FEE_TYPE, "amount"))


HOURLY_AMOUNT = MetricSpec(
    "hourly_amount", ("hour",), {"succ_orders": "bigint", "amount": FEE_TYPE},
    _hourly_amount_delta, lambda s, ctx: s.select("hour", "succ_orders", _dbl("amount")))


# --------------------------------------------------------------------------
# Order indicators (AGG6-AGG8)
# --------------------------------------------------------------------------

ORDER_TOTAL = MetricSpec(
    "order_total", (), {"amount": "bigint"},
    lambda b, ctx: b.agg(_sum("money", "bigint", "amount")),
    lambda s, ctx: s.select("amount"))

ORDER_BY_CATEGORY = MetricSpec(
    "order_by_category", ("goods_type",), {"amount": "bigint"},
    lambda b, ctx: b.groupBy("goods_type").agg(_sum("money", "bigint", "amount")),
    lambda s, ctx: s.select("goods_type", "amount"))


def _order_province_delta(b: DataFrame, ctx: Ctx) -> DataFrame:
    # by address first: records never meet the ranges
    sums = b.groupBy("ip_num").agg(_sum("money", "bigint"))
    located = floor_lookup(sums, "ip_num", ctx["ip_ranges"], below_first=ctx.get("below_first", "clamp"))
    return located.groupBy("province").agg(_sum("money", "bigint", "amount"))


ORDER_BY_PROVINCE = MetricSpec(
    "order_by_province", ("province",), {"amount": "bigint"},
    _order_province_delta, lambda s, ctx: s.select("province", "amount"))


# --------------------------------------------------------------------------
# Payment indicators (AGG9-AGG11)
# --------------------------------------------------------------------------

DAILY_PAYMENT = MetricSpec(
    "daily_payment", ("day",), {"total": "bigint"},
    lambda b, ctx: b.groupBy("day").agg(_sum("money", "bigint", "total")),
    lambda s, ctx: s.select("day", "total"))


def _phone_delta(b: DataFrame, ctx: Ctx) -> DataFrame:
    return b.groupBy("month", "phone").agg(_sum("money", "bigint", "amount"),
                                          F.count(F.lit(1)).alias("orders"))


MONTHLY_PHONE_SUM = MetricSpec(
    "monthly_phone_sum", ("month", "phone"), {"amount": "bigint", "orders": "bigint"},
    _phone_delta, lambda s, ctx: s.select("month", "phone", "amount"))

MONTHLY_PHONE_AVG = MetricSpec(
    "monthly_phone_avg", ("month", "phone"), {"amount": "bigint", "orders": "bigint"},
    _phone_delta,
    lambda s, ctx: s.select("month", "phone",
                            (F.col("amount").cast("double") / F.col("orders")).alias("avg_amount")),
    state_name="monthly_phone_sum")


# --------------------------------------------------------------------------
# Word count (PRJ10, AGG14)
# --------------------------------------------------------------------------

def tokens(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """One row per token of each line, JVM ``split(" ")`` rules."""
    return lines.select(F.explode(java_split_tokens(value_col)).alias("value"))


WORD_COUNT = MetricSpec(
    "word_count", ("value",), {"count": "bigint"},
    lambda words, ctx: words.groupBy("value").agg(F.count(F.lit(1)).alias("count")),
    lambda s, ctx: s.select("value", "count"))


# --------------------------------------------------------------------------
# Counter layout (SNK1/SNK2 rows): hash key -> field -> number
# --------------------------------------------------------------------------

COUNTER_VALUE = "decimal(18,2)"


#: Writes of a counter within such a stretch of time are kept as one interval.
COUNTER_SLOT = "hour"


def counter_rows(base: DataFrame) -> DataFrame:
    """KPI base rows -> ``(key, field, value)`` increments in the counter
    layout: ``A-<day>`` with fields total/succ/money/cost, and ``B-<day>``
    with ``T:<hour><minute>`` (orders) and ``S:<hour><minute>`` (successes).
    Aggregated per batch first, so a sink sees one increment per field.  If
    the base rows have the time they arrived (``written``), increments are
    those of an hour, with the first and last time in it."""
    timed = "written" in base.columns
    slot = [F.date_trunc(COUNTER_SLOT, "written").alias("slot")] if timed else []
    times = [F.min("written").alias("first_update"), F.max("written").alias("last_update")] if timed else []
    keep = ["first_update", "last_update"] if timed else []

    def fields(entries: list):
        return F.inline(F.array(*[F.struct(name.alias("field"), F.col(c).cast(COUNTER_VALUE).alias("value"))
                                  for name, c in entries]))
    d = base.groupBy("day", *slot).agg(
        _sum("orders", "bigint", "total"), _sum("succ", "bigint"), _sum("fee", FEE_TYPE, "money"),
        _sum("cost_ms", "bigint", "cost"), *times)
    a = d.select(F.concat(F.lit("A-"), "day").alias("key"), *keep,
                 fields([(F.lit(c), c) for c in ("total", "succ", "money", "cost")]))
    m = base.groupBy("day", "hour", "minute", *slot).agg(_sum("orders", "bigint", "total"), _sum("succ", "bigint"), *times)
    hm = F.concat("hour", "minute")
    b = m.select(F.concat(F.lit("B-"), "day").alias("key"), *keep,
                 fields([(F.concat(F.lit("T:"), hm), "total"), (F.concat(F.lit("S:"), hm), "succ")]))
    return a.unionByName(b)


COUNTERS = MetricSpec(
    "counters", ("key", "field"), {"value": COUNTER_VALUE},
    lambda base, ctx: counter_rows(base),
    lambda s, ctx: s.select("key", "field", _dbl("value")))


# --------------------------------------------------------------------------
# Offset ledger (SNK10): until-offset per topic partition, combined by max
# --------------------------------------------------------------------------

def _ledger_delta(records: DataFrame, ctx: Ctx) -> DataFrame:
    return (records.groupBy("topic", "partition")
            .agg((F.max("offset") + 1).cast("bigint").alias("until_offset")))


OFFSET_LEDGER = MetricSpec(
    "offset_ledger", ("topic", "partition"), {"until_offset": "bigint"},
    _ledger_delta, lambda s, ctx: s.select("topic", "partition", "until_offset"),
    combine={"until_offset": "max"}, key_types={"partition": "int"})


# --------------------------------------------------------------------------
# Browse facts: views and distinct users by region and day (AGG13)
# --------------------------------------------------------------------------

#: A mask holds the users whose numbers differ in their last six bits only.
MASK_BITS = 6


def _region_users_delta(fact: DataFrame, ctx: Ctx) -> DataFrame:
    user = F.col("user_id").cast("bigint")
    bit = user.bitwiseAND(F.lit((1 << MASK_BITS) - 1)).cast("int")
    rows = fact.select(F.col("area_code").cast("bigint").alias("area_code"), "bdp_day",
                       F.shiftright(user, MASK_BITS).alias("word"),
                       F.call_function("shiftleft", F.lit(1).cast("bigint"), bit).alias("mask"))
    return (rows.groupBy("area_code", "bdp_day", "word")
            .agg(F.bit_or("mask").alias("mask"), F.count(F.lit(1)).alias("views")))


def _region_users(sums: DataFrame, ctx: Ctx) -> DataFrame:
    region = ctx["region"]
    j = sums.join(region, sums["area_code"] == region["region_code"], "left")
    place = [F.col("region_province_desc").alias("region_province"), F.col("region_city_desc").alias("region_city")]
    words = (j.groupBy(*place, "bdp_day", "word")   # areas of one city share users
             .agg(F.bit_or("mask").alias("mask"), F.sum("views").alias("views")))
    return (words.groupBy("region_province", "region_city", "bdp_day")
            .agg(F.coalesce(F.sum(F.bit_count("mask")), F.lit(0)).cast("bigint").alias("user_count"),
                 F.sum("views").cast("bigint").alias("view_count"))
            .select("region_province", "region_city", "user_count", "view_count", "bdp_day"))


#: Users are kept as exact bit masks of 64 numbers each, which batches put together with
#: ``or``: as small as a bitmap where numbers are dense, one row a user where they are
#: sparse.  Areas are resolved when the result is read.
BROWSE_REGION_USERS = MetricSpec(
    "browse_region_users", ("area_code", "bdp_day", "word"), {"mask": "bigint", "views": "bigint"},
    _region_users_delta, _region_users, combine={"mask": "or"},
    key_types={"area_code": "bigint", "word": "bigint"})


TOPUP_METRICS = {m.name: m for m in (DAILY_OVERVIEW, MINUTE_TREND, HOURLY_PROVINCE_FAILURES,
                                     PROVINCE_SUCCESS, PROVINCE_TOP10, HOURLY_AMOUNT)}
ORDER_METRICS = {m.name: m for m in (ORDER_TOTAL, ORDER_BY_CATEGORY, ORDER_BY_PROVINCE)}
PAYMENT_METRICS = {m.name: m for m in (DAILY_PAYMENT, MONTHLY_PHONE_SUM, MONTHLY_PHONE_AVG)}
