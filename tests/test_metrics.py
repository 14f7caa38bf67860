"""Property checks over the registered queries (sf 0.001)."""

from conftest import SF_SMALL

from chargepulse.plans.registry import queries


def _rows(spark, name):
    return queries()[name](spark, SF_SMALL).collect()


def test_order_totals_agree(spark):
    total = _rows(spark, "order_total")[0].amount
    assert sum(r.amount for r in _rows(spark, "order_by_category")) == total
    assert sum(r.amount for r in _rows(spark, "order_by_province")) == total


def test_minute_trend_sums_to_daily(spark):
    daily = {r.day: (r.total, r.succ) for r in _rows(spark, "daily_overview")}
    acc = {}
    for r in _rows(spark, "minute_trend"):
        t, s = acc.get(r.day, (0, 0))
        acc[r.day] = (t + r.total, s + r.succ)
    assert acc == daily


def test_failures_plus_successes_equal_orders(spark):
    orders = sum(r.total for r in _rows(spark, "daily_overview"))
    succ = sum(r.succ for r in _rows(spark, "daily_overview"))
    fails = sum(r.fail_count for r in _rows(spark, "hourly_province_failures"))
    assert fails + succ == orders


def test_top10_is_prefix_of_sorted_provinces(spark):
    allp = sorted(_rows(spark, "province_success"), key=lambda r: (-r.orders, r.city))
    top = _rows(spark, "province_top10")
    assert [r.city for r in top] == [r.city for r in allp[:10]]


def test_monthly_avg_consistent_with_sum(spark):
    s = {(r.month, r.phone): r.amount for r in _rows(spark, "monthly_phone_sum")}
    a = {(r.month, r.phone): r.avg_amount for r in _rows(spark, "monthly_phone_avg")}
    assert s.keys() == a.keys()
    assert all(a[k] <= s[k] for k in s)
