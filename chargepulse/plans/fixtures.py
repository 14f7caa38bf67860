"""Input shapes derived in Spark from the test tables (FIXTURES.md F1-F9).

The test tables are TPC-H-like parquet files plus an ``events`` table.  The
library's inputs are topic records (JSON or delimited text in ``value``),
dimension text lines and catalog tables; each function below derives one of
them from the tables, deterministically and without sampling, so a query's
work grows with the tables.  Every derivation is a narrow projection (or a
join for the browse fact), so it fuses with the parsing that follows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

STAMP = "yyyyMMddHHmmssSSS"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read a test table."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# F1 -- top-up notifications as JSON text
def _topup_value():
    et = F.col("event_type")
    k = F.get_json_object("props", "$.k").try_cast("bigint")
    receive = F.timestamp_millis(F.unix_millis(F.col("ts").cast("timestamp")) + k * 100)
    rec = F.struct(
        F.when(et == "purchase", "reChargeNotifyReq")
        .when(et == "error", "RECHARGENOTIFYREQ")
        .otherwise("sendRechargeReq").alias("serviceName"),
        F.when(et == "purchase", "0000").otherwise("9999").alias("bussinessRst"),
        F.col("value").cast("string").alias("chargefee"),
        F.concat(F.date_format("ts", STAMP),
                 F.lpad(F.col("event_id").cast("string"), 8, "0")).alias("requestId"),
        F.date_format(receive, STAMP).alias("receiveNotifyTime"),
        (F.col("user_id") % 30).cast("string").alias("provinceCode"),
    )
    return F.to_json(rec).alias("value")


def _positions(topic: str):
    return [F.lit(topic).alias("topic"),
            (F.col("event_id") % 4).cast("int").alias("partition"),
            F.floor(F.col("event_id") / 4).cast("bigint").alias("offset")]


def topup_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.select(_topup_value(), F.col("ts"))


def damaged_topup_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F1 with every 50th record cut short and the service name of every 70th renamed."""
    e = table(spark, sf_dir, "events")
    v = _topup_value()
    return e.select(F.when(F.col("event_id") % 50 == 0, F.substring(v, 1, 20))
                    .when(F.col("event_id") % 70 == 0, F.regexp_replace(v, "serviceName", "service"))
                    .otherwise(v).alias("value"))


def topup_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F1 as topic records: ``topic, partition, offset, value`` (+ ``ts``)."""
    e = table(spark, sf_dir, "events")
    return e.select(*_positions("topup"), _topup_value(),
                    F.col("ts"))


def late_topup_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F1 as topic records with a time of arrival: a third of the records each comes at once,
    45 and 90 hours late, or, on even days of the month, at once, 20 and 100 hours late."""
    e = table(spark, sf_dir, "events")
    even, third = F.dayofmonth("ts") % 2 == 0, F.col("event_id") % 3
    hours = F.when(third == 0, 0).when(third == 1, F.when(even, 20).otherwise(45)).otherwise(F.when(even, 100).otherwise(90))
    at = F.timestamp_millis(F.unix_millis(F.col("ts").cast("timestamp")) + hours * 3_600_000)
    return e.select(*_positions("topup"), _topup_value(), at.alias("timestamp"))


# F2 -- city code file lines "code name"
def city_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation")
    return n.select(F.concat_ws(" ", F.col("n_nationkey").cast("string"), "n_name").alias("value"))


def damaged_city_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F2 with odd lines, numbered by ``pos``: every fourth code has a second line with
    another name, every fifth lost its name and every seventh is empty."""
    n = table(spark, sf_dir, "nation")
    key, name = F.col("n_nationkey"), F.col("n_name")
    line = (F.when(key % 7 == 0, F.lit("")).when(key % 5 == 0, key.cast("string"))
            .otherwise(F.concat_ws(" ", key.cast("string"), name)))
    first = n.select(line.alias("value"), key.cast("bigint").alias("pos"))
    second = n.where(key % 4 == 0).select(F.concat_ws(" ", key.cast("string"), F.concat(F.lit("NEW-"), name)).alias("value"),
                                          (key + 1000).cast("bigint").alias("pos"))
    return first.unionByName(second)


# F3 -- order lines "time ip goods_type detail money"
def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    ip = F.concat_ws(".", F.lit("10"), (F.col("user_id") % 64).cast("string"),
                     (F.col("event_id") % 256).cast("string"),
                     (F.col("event_id") % 7).cast("string"))
    return e.select(F.concat_ws(
        " ", F.date_format("ts", "yyyyMMddHHmmss"), ip, "event_type",
        F.col("event_id").cast("string"), F.floor("value").cast("string")).alias("value"),
        F.col("ts"))


def _range_lo():
    return (F.lit(167772160) + (F.col("n_nationkey") * 2 + 4) * 65536
            + F.col("n_nationkey") * 1024).cast("bigint")


# F4 -- IP range file lines "start|end|f2|f3|f4|f5|province"
def ip_range_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..functions.ip import long_to_ip

    n = table(spark, sf_dir, "nation")
    lo = _range_lo()
    hi = lo + 65536 - 1 + 32768
    return n.select(F.concat_ws("|", long_to_ip(lo), long_to_ip(hi), F.lit("x"),
                                F.lit("x"), F.lit("x"), F.lit("x"), "n_name").alias("value"))


def damaged_ip_range_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F4 with every fourth line cut to three fields and every fifth with a bad start."""
    lines = ip_range_lines(spark, sf_dir)
    name = F.element_at(F.split("value", r"\|"), 7)
    key = table(spark, sf_dir, "nation").select("n_nationkey", F.col("n_name").alias("_n"))
    j = lines.join(key, name == F.col("_n"))
    return j.select(F.when(F.col("n_nationkey") % 4 == 0, F.substring_index("value", "|", 3))
                    .when(F.col("n_nationkey") % 5 == 0, F.concat(F.lit("999."), "value")).otherwise(F.col("value")).alias("value"))


# F5 -- payments as JSON text
def payment_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    rec = F.struct(
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("date"),
        F.concat(F.lit("138"), F.lpad(F.col("o_custkey").cast("string"), 8, "0"))
        .alias("phoneNum"),
        F.floor("o_totalprice").cast("string").alias("money"),
    )
    return o.select(F.to_json(rec).alias("value"))


# F6 -- browse fact (mid_actlog_view_goods)
def browse_fact(spark: SparkSession, sf_dir: str, lineitem: DataFrame | None = None,
                orders: DataFrame | None = None, day: str | None = None) -> DataFrame:
    """The fact from the test tables, or from given copies of the two large ones; with
    ``day`` (``yyyyMMdd``) that day only, as a range of the stored time."""
    li = lineitem if lineitem is not None else table(spark, sf_dir, "lineitem")
    o = orders if orders is not None else table(spark, sf_dir, "orders")
    if day is not None:
        begin = F.to_timestamp_ntz(F.lit(day), F.lit("yyyyMMdd"))
        li = li.where((F.col("l_shipdate") >= begin) & (F.col("l_shipdate") < begin + F.expr("INTERVAL 1 DAY")))
    li = li.select("l_orderkey", "l_suppkey", "l_linenumber", "l_returnflag", "l_linestatus", "l_shipdate")
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    j = (li.join(o.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
         .join(s, F.col("l_suppkey") == F.col("s_suppkey")))
    return j.select(
        # every fifth supplier has a code outside the dimension
        F.when(F.col("s_suppkey") % 5 == 0, F.col("s_nationkey") + 100)
        .otherwise(F.col("s_nationkey")).alias("area_code"),
        F.col("l_returnflag").alias("os"),
        F.col("l_linestatus").alias("network_type"),
        F.col("l_linenumber").alias("category_id"),
        F.when(F.col("o_custkey") % 7 != 0, F.col("o_custkey")).alias("user_id"),
        F.date_format("l_shipdate", "yyyyMMdd").alias("bdp_day"),
    )


# F7 -- region dimension
def region_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    return n.join(r, n.n_regionkey == r.r_regionkey).select(
        F.col("n_nationkey").alias("region_code"),
        F.col("r_name").alias("region_province_desc"),
        F.col("n_name").alias("region_city_desc"))


# F8 -- topic records with positions
def topic_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.select(*_positions("events"),
                    F.to_json(F.struct("event_id", "event_type", "value")).alias("value"))


# F9 -- text lines
def text_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    return d.select(F.explode(F.split("text", "\n")).alias("value"))
