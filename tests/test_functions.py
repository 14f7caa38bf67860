
from chargepulse.functions import (compact_ts_millis, duration_ms, ip_to_long,
                                   java_split_tokens, long_to_ip, pct_one_decimal,
                                   split_topic_partition)
from chargepulse.functions.ip import with_ip_num


def _one(spark, expr, data, schema="s string"):
    return [r[0] for r in spark.createDataFrame(data, schema).select(expr).collect()]


def test_ip_to_long_valid_and_invalid(spark):
    data = [("10.1.2.3",), ("0.0.0.0",), ("255.255.255.255",), ("010.001.2.3",),
            ("256.1.1.1",), ("1.2.3",), ("a.b.c.d",), ("",), (None,), ("1.2.3.4.5",)]
    got = _one(spark, ip_to_long("s"), data)
    assert got == [167838211, 0, 4294967295, 167838211, None, None, None, None, None, None]


def test_ip_lenient_fold_matches_original_closure(spark):
    assert _one(spark, ip_to_long("s", strict=False), [("10.1.2.3",), ("1.2.3",)]) == [
        167838211, (1 << 16) | (2 << 8) | 3]


def test_with_ip_num_and_inverse(spark):
    df = spark.createDataFrame([("10.1.2.3",), ("1.2.300.4",)], "ip string")
    rows = with_ip_num(df, "ip").select("ip_num", long_to_ip("ip_num").alias("back")).collect()
    assert rows[0]["ip_num"] == 167838211 and rows[0]["back"] == "10.1.2.3"
    assert rows[1]["ip_num"] is None


def test_compact_stamp_and_duration(spark):
    got = _one(spark, duration_ms("a", "b"),
               [("20240101000007179000001", "20240101000014079"),
                ("20231231235959999", "20240101000000001"),
                ("2024010100000", "20240101000014079")], "a string, b string")
    assert got == [6900, 2, None]
    ms = _one(spark, compact_ts_millis("s"), [("19700101000000123",)])
    assert ms == [123]


def test_pct_half_up(spark):
    got = _one(spark, pct_one_decimal("a", "b"),
               [(1, 3), (2, 3), (1, 8), (3, 8), (0, 0), (5, 5)], "a long, b long")
    # 33.33 -> 33.3, 66.67 -> 66.7, 12.5 -> 12.5, 37.5 -> 37.5, 0/0 -> NULL
    assert got == [33.3, 66.7, 12.5, 37.5, None, 100.0]
    # permille ties round up: 1/16 = 6.25 % -> 6.3
    assert _one(spark, pct_one_decimal("a", "b"), [(1, 16)], "a long, b long") == [6.3]


def test_java_split_rules(spark):
    data = [("a  b  ",), ("",), ("   ",), (" a",), ("a b",), ("a  ",)]
    got = _one(spark, java_split_tokens("s"), data)
    assert got == [["a", "", "b"], [""], [], ["", "a"], ["a", "b"], ["a "]]


def test_topic_partition_keys_with_dashes(spark):
    t, p = split_topic_partition("k")
    rows = spark.createDataFrame([("top-up-events-3",), ("events-12",), ("bad",)], "k string") \
        .select(t.alias("t"), p.alias("p")).collect()
    assert [(r.t, r.p) for r in rows] == [("top-up-events", 3), ("events", 12), (None, None)]
