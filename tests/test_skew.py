"""A third of all rows on one key: results stay whole and exact, and the
plans pre-aggregate before shuffling (no raw hot-key rows cross a shuffle)."""

from pyspark.sql import functions as F

from chargepulse.operators import metrics as M
from chargepulse.operators.lookup import floor_range_join
from chargepulse.operators.parse import parse_topups


def _hot_topups(spark, n=30000):
    # one province code and one minute hold a third of the rows
    rows = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("7")).otherwise((F.col("id") % 29).cast("string"))
        .alias("code"),
        F.when(F.col("id") % 3 == 0, F.lit("20240101101010000"))
        .otherwise(F.format_string("2024010%d10%02d%02d000", F.col("id") % 9 + 1,
                                   F.col("id") % 60, F.col("id") % 60)).alias("rid"),
        (F.col("id") % 2 == 0).alias("ok"))
    value = F.to_json(F.struct(
        F.lit("reChargeNotifyReq").alias("serviceName"),
        F.when(F.col("ok"), "0000").otherwise("9999").alias("bussinessRst"),
        F.lit("1.50").alias("chargefee"), F.col("rid").alias("requestId"),
        F.col("rid").alias("receiveNotifyTime"), F.col("code").alias("provinceCode")))
    return rows.select(value.alias("value"))


def test_hot_province_and_minute(spark):
    base = parse_topups(_hot_topups(spark))
    dim = spark.createDataFrame([("7", "Hot")], "code string, name string")
    prov = {r.city: (r.orders, r.succ_orders) for r in
            M.PROVINCE_SUCCESS.batch(base, {"city_dim": dim}).collect()}
    assert prov["Hot"][0] == 10000 + sum(1 for i in range(30000) if i % 3 and i % 29 == 7)
    assert sum(o for o, _ in prov.values()) == 30000
    minutes = M.MINUTE_TREND.batch(base)
    assert minutes.agg(F.sum("total")).first()[0] == 30000
    plan = minutes._jdf.queryExecution().executedPlan().toString()
    # partial aggregation sits below the exchange
    assert plan.index("partial_sum") > plan.index("Exchange")


def test_hot_ip_bucket(spark):
    ranges = spark.createDataFrame([(0, "low"), (167772160, "ten"), (167837696, "ten-one")],
                                   "start_num long, province string")
    facts = spark.range(60000).select(
        F.when(F.col("id") % 3 == 0, F.lit(167772161))
        .otherwise(F.col("id") * 70001 % (1 << 32)).alias("ip_num"))
    out = floor_range_join(facts, "ip_num", ranges)
    assert out.count() == 60000
    got = {r.province: r["count"] for r in out.groupBy("province").count().collect()}
    assert got["ten"] >= 20000 and sum(got.values()) == 60000
