"""Registered queries: ``name -> fn(spark, sf_dir) -> DataFrame``.

Each query reads the whole test tables through the fixture derivations in
:mod:`.fixtures` and runs the library's operators on them.  Column names and
types match the oracle SQL in :mod:`.oracle`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pyspark.sql import functions as F

from ..operators import browse as B
from ..operators import metrics as M
from ..operators.lookup import containment_join
from ..operators.parse import orders_base, parse_topup_json, parse_topups, payments_base, topup_part
from ..session import scratch_path
from ..sources.catalog import run_named
from ..sources.dims import (judge_code_lines, judge_ip_lines, parse_code_dim, parse_ip_ranges, read_code_dim,
                            read_ip_ranges)
from . import fixtures as fx

Query = Callable[[SparkSession, str], DataFrame]


def topup_ctx(spark: SparkSession, sf_dir: str) -> dict:
    return {"city_dim": parse_code_dim(fx.city_lines(spark, sf_dir))}


def _topup(spec: M.MetricSpec) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        base = parse_topups(fx.topup_json(spark, sf_dir))
        return spec.batch(base, topup_ctx(spark, sf_dir))
    run.__name__ = spec.name
    return run


def _orders(spec: M.MetricSpec) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        base = orders_base(fx.order_lines(spark, sf_dir))
        ctx = {"ip_ranges": parse_ip_ranges(fx.ip_range_lines(spark, sf_dir))}
        return spec.batch(base, ctx)
    run.__name__ = spec.name
    return run


def _payments(spec: M.MetricSpec) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return spec.batch(payments_base(fx.payment_json(spark, sf_dir)))
    run.__name__ = spec.name
    return run


def daily_overview(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: JSON top-ups -> per-day orders, successes, amount, time."""
    return _topup(M.DAILY_OVERVIEW)(spark, sf_dir)


def browse_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG12 over the browse fact."""
    return B.browse_stats(fx.browse_fact(spark, sf_dir))


def views_per_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC8: an entry of the named SQL catalogue over the browse fact."""
    return run_named(spark, "views_per_day", views={"views": fx.browse_fact(spark, sf_dir)})


def topup_quarantine_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base, quarantine and other interfaces add up to the input.  Every 50th
    record is cut short and every 70th loses its service name."""
    parts = topup_part(parse_topup_json(fx.damaged_topup_json(spark, sf_dir)))
    names = ("base", "quarantine", "other")
    counts = parts.agg(F.count(F.lit(1)).alias("input"), *[F.count_if(F.col("part") == p).alias(p) for p in names])
    return counts.unpivot([], ["input", *names], "part", "n")


def browse_region_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JN4 + AGG13."""
    return B.browse_region_stats(fx.browse_fact(spark, sf_dir), fx.region_dim(spark, sf_dir))


def word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ10 + AGG14 in batch over every line of every document."""
    return M.WORD_COUNT.batch(M.tokens(fx.text_lines(spark, sf_dir)))


def ip_containment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JN3: amount per province by closed-interval containment (NULL = miss)."""
    base = orders_base(fx.order_lines(spark, sf_dir))
    ranges = parse_ip_ranges(fx.ip_range_lines(spark, sf_dir))
    located = containment_join(base, "ip_num", ranges)
    return located.groupBy("province").agg(F.sum("money").cast("bigint").alias("amount"))


def city_dim_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC4: write the city code file as text, read it back with the reader."""
    path = scratch_path(spark, "dims", "city")
    fx.city_lines(spark, sf_dir).write.text(path)
    return read_code_dim(spark, path)


def ip_range_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC5: write the IP range file as text, read it back with the reader."""
    path = scratch_path(spark, "dims", "ip")
    fx.ip_range_lines(spark, sf_dir).write.text(path)
    return read_ip_ranges(spark, path).select("start_ip", "end_ip", "province",
                                              "start_num", "end_num")


def dim_line_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC4 + SRC5: lines of both dimension files by what becomes of them (damaged files)."""
    city = judge_code_lines(fx.damaged_city_lines(spark, sf_dir), order_col="pos").withColumn("file", F.lit("city"))
    ip = judge_ip_lines(fx.damaged_ip_range_lines(spark, sf_dir)).withColumn("file", F.lit("ip"))
    both = city.select("file", "reason").unionByName(ip.select("file", "reason"))
    return both.groupBy("file", F.coalesce("reason", F.lit("used")).alias("reason")).agg(F.count(F.lit(1)).alias("n"))


def queries() -> dict[str, Query]:
    q: dict[str, Query] = {}
    for spec in M.TOPUP_METRICS.values():
        q[spec.name] = _topup(spec)
    for spec in M.ORDER_METRICS.values():
        q[spec.name] = _orders(spec)
    for spec in M.PAYMENT_METRICS.values():
        q[spec.name] = _payments(spec)
    for fn in (browse_stats, browse_region_stats, views_per_day, topup_quarantine_balance, word_count, ip_containment,
               city_dim_parse, ip_range_parse, dim_line_balance):
        q[fn.__name__] = fn
    from . import stream_queries as S

    for fn in (S.stream_overview, S.stream_orders, S.stream_payments, S.browse_region_stream, S.upsert_failures, S.upsert_province, S.upsert_hour,
               S.counter_merge, S.counter_ttl, S.offset_ledger, S.offset_restore, S.ledger_resume,
               S.word_count_stream, S.word_count_complete, S.quarantine_append, S.json_append, S.catalog_overwrite,
               S.catalog_overwrite_region):
        q[fn.__name__] = fn
    return q
