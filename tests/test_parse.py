import json

import pytest

from chargepulse.operators.parse import (orders_base, orders_quarantine, parse_topup_json,
                                         parse_topups, payments_base, payments_quarantine,
                                         require_clean, topup_quarantine)


def _rec(**kw):
    base = {"serviceName": "reChargeNotifyReq", "bussinessRst": "0000", "chargefee": "49.90",
            "requestId": "20240101103015123000001", "receiveNotifyTime": "20240101103016000",
            "provinceCode": "7"}
    base.update(kw)
    return json.dumps({k: v for k, v in base.items() if v is not ...})


def _df(spark, values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_topup_parse_buckets_and_kpis(spark):
    rows = parse_topups(_df(spark, [_rec()])).collect()
    r = rows[0]
    assert (r.day, r.hour, r.minute, r.province_code) == ("20240101", "2024010110", "202401011030", "7")
    assert (r.orders, r.succ, float(r.fee), r.cost_ms) == (1, 1, 49.9, 877)


def test_service_filter_is_case_insensitive_and_drops_others(spark):
    vals = [_rec(serviceName="RECHARGENOTIFYREQ"), _rec(serviceName="sendRechargeReq"),
            _rec(serviceName=...)]
    assert parse_topups(_df(spark, vals)).count() == 1


def test_failure_rows_have_zero_fee_and_cost(spark):
    r = parse_topups(_df(spark, [_rec(bussinessRst="9999", chargefee="oops")])).first()
    assert (r.succ, float(r.fee), r.cost_ms) == (0, 0.0, 0)


def test_numeric_fee_and_bad_rows_quarantined(spark):
    vals = [json.loads(_rec()) | {"chargefee": 12.5}, json.loads(_rec()) | {"chargefee": "x"},
            json.loads(_rec()) | {"requestId": "2024"}]
    df = _df(spark, [json.dumps(v) for v in vals])
    good = parse_topups(df).collect()
    assert [float(r.fee) for r in good] == [12.5]
    assert topup_quarantine(parse_topup_json(df)).count() == 2
    with pytest.raises(ValueError):
        require_clean(topup_quarantine(parse_topup_json(df)), "top-up")


def test_order_lines_short_and_bad(spark):
    df = _df(spark, ["20240101103015 10.1.2.3 book d1 100", "20240101 10.1.2.3 book",
                     "20240101 10.1.2.3 book d1 1x", "t 999.1.1.1 food d2 5"])
    good = orders_base(df).collect()
    assert [(r.goods_type, r.money, r.ip_num) for r in good] == [
        ("book", 100, 167838211), ("food", 5, None)]
    assert orders_quarantine(df).count() == 2


def test_payments(spark):
    df = _df(spark, ['{"date":"2024-03-05 10:00:00","phoneNum":"13800000001","money":"30"}',
                     '{"date":"2024-03","phoneNum":"1","money":"3"}',
                     '{"date":"2024-03-05","phoneNum":"1","money":"3.5"}'])
    good = payments_base(df).collect()
    assert [(r.month, r.day, r.phone, r.money) for r in good] == [
        ("2024-03", "2024-03-05", "13800000001", 30)]
    assert payments_quarantine(df).count() == 2
