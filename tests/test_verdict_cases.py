"""Cases in which results were once wrong: expiry, quarantine, odd dates, overlaps."""

import datetime as dt

import pytest

from chargepulse.operators.lookup import containment_join
from chargepulse.operators.parse import (other_interfaces, parse_topup_json, payments_base, payments_quarantine,
                                         topup_kpi_base, topup_quarantine)
from chargepulse.streaming.sinks import starting_offsets
from chargepulse.streaming.state import KeyedState


def test_expired_group_starts_again(spark, tmpdir_str):
    st = KeyedState(spark, tmpdir_str + "/s", ["key"], {"v": "bigint"}, ttl=dt.timedelta(hours=48))
    t0 = dt.datetime(2024, 1, 1)
    st.merge(spark.createDataFrame([("a", 5)], "key string, v long"), 0, t0)
    st.merge(spark.createDataFrame([("a", 1)], "key string, v long"), 1, t0 + dt.timedelta(hours=60))
    assert [r.v for r in st.read().collect()] == [1]


def test_topups_balance(spark):
    good = ('{"serviceName":"reChargeNotifyReq","bussinessRst":"0000","chargefee":"1","requestId":'
            '"20240101000000000","receiveNotifyTime":"20240101000001000","provinceCode":"1"}')
    lines = [good, "not json", None, good.replace("serviceName", "x"), good.replace("bussinessRst", "x"),
             good.replace("reChargeNotifyReq", "sendRechargeReq"), "{}"]
    parsed = parse_topup_json(spark.createDataFrame([(x,) for x in lines], "value string"))
    counts = [f(parsed).count() for f in (topup_kpi_base, topup_quarantine, other_interfaces)]
    assert counts == [1, 5, 1] and sum(counts) == len(lines)


def test_odd_payment_dates_go_to_quarantine(spark):
    rows = [('{"date":"%s","phoneNum":"1","money":"3"}' % d,) for d in
            ("2024-03-05 10:00:00", "2024/03/05 10:00:00", "2024-13-45 00:00:00", "x")]
    df = spark.createDataFrame([*rows, ('{"phoneNum":"1","money":"3"}',), (None,)], "value string")
    assert payments_base(df).count() == 1 and payments_quarantine(df).count() == 5


def test_overlapping_ranges_are_rejected(spark):
    ranges = spark.createDataFrame([(10, 20, "a"), (15, 30, "b")], "start_num long, end_num long, province string")
    with pytest.raises(ValueError, match="overlapping"):
        containment_join(spark.createDataFrame([(17,)], "ip long"), "ip", ranges)


def test_parsers_leave_the_session_as_it_is(spark):
    key = "spark.sql.optimizer.enableJsonExpressionOptimization"
    before = spark.conf.get(key)
    parse_topup_json(spark.createDataFrame([("{}",)], "value string")).count()
    assert spark.conf.get(key) == before


def test_starting_offsets_of_one_topic(spark):
    ledger = spark.createDataFrame([("g", "a", 0, 5), ("g", "a", 1, 7), ("g", "b", 0, 9)],
                                   "group_id string, topic string, partition int, until_offset long")
    assert starting_offsets(spark, ledger, "a") == '{"a":{"0":5,"1":7}}'
