"""DuckDB SQL equal to each registered query, written directly against the
test tables (the fixture derivations folded in)."""

from __future__ import annotations

# Top-up notifications kept by the interface filter, in direct form.
_TOPUP = """
  SELECT strftime(ts, '%Y%m%d') AS day, strftime(ts, '%Y%m%d%H') AS hour,
         strftime(ts, '%Y%m%d%H%M') AS minute,
         CAST(user_id % 30 AS VARCHAR) AS province_code,
         CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS succ,
         CASE WHEN event_type = 'purchase' THEN CAST(value AS DECIMAL(18,2)) ELSE 0 END AS fee,
         CASE WHEN event_type = 'purchase'
              THEN CAST(json_extract_string(props, '$.k') AS BIGINT) * 100 ELSE 0 END AS cost_ms
  FROM events WHERE event_type IN ('purchase', 'error')
"""

_CITY = "SELECT CAST(n_nationkey AS VARCHAR) AS code, n_name AS name FROM nation"

_PROVINCE = f"""
  SELECT coalesce(c.name, t.province_code) AS city, CAST(count(*) AS BIGINT) AS orders,
         CAST(sum(t.succ) AS BIGINT) AS succ_orders
  FROM ({_TOPUP}) t LEFT JOIN ({_CITY}) c ON c.code = t.province_code
  GROUP BY 1
"""

_PROVINCE_OUT = f"""
  SELECT city, orders, succ_orders,
         CAST((succ_orders * 2000 + orders) // (2 * orders) AS DOUBLE) / 10.0 AS succ_pct
  FROM ({_PROVINCE})
"""

# Order lines in direct form: address number and integer amount.
_ORDERS = """
  SELECT event_type AS goods_type,
         167772160 + (user_id % 64) * 65536 + (event_id % 256) * 256 + (event_id % 7) AS ip,
         CAST(floor(value) AS BIGINT) AS money
  FROM events
"""

_RANGES = """
  SELECT CAST(167772160 + (n_nationkey * 2 + 4) * 65536 + n_nationkey * 1024 AS BIGINT) AS lo,
         CAST(167772160 + (n_nationkey * 2 + 4) * 65536 + n_nationkey * 1024
              + 65536 - 1 + 32768 AS BIGINT) AS hi,
         n_name AS province
  FROM nation
"""

_PAYMENTS = """
  SELECT strftime(o_orderdate, '%Y-%m') AS month, strftime(o_orderdate, '%Y-%m-%d') AS day,
         '138' || lpad(CAST(o_custkey AS VARCHAR), 8, '0') AS phone,
         CAST(floor(o_totalprice) AS BIGINT) AS money
  FROM orders
"""

_BROWSE = """
  SELECT CASE WHEN s.s_suppkey % 5 = 0 THEN s.s_nationkey + 100 ELSE s.s_nationkey END AS area_code, l.l_returnflag AS os, l.l_linestatus AS network_type,
         l.l_linenumber AS category_id,
         CASE WHEN o.o_custkey % 7 <> 0 THEN o.o_custkey END AS user_id,
         strftime(l.l_shipdate, '%Y%m%d') AS bdp_day
  FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey
  JOIN orders o ON l.l_orderkey = o.o_orderkey
"""

_REGION = """
  SELECT n_nationkey AS region_code, r_name AS region_province_desc, n_name AS region_city_desc
  FROM nation JOIN region ON n_regionkey = r_regionkey
"""

_LINES = "SELECT unnest(string_split(text, chr(10))) AS line FROM documents"

_TOKENS = f"""
  SELECT unnest(CASE WHEN line = '' THEN ['']
                     WHEN rtrim(line, ' ') = '' THEN []::VARCHAR[]
                     ELSE string_split(rtrim(line, ' '), ' ') END) AS value
  FROM ({_LINES})
"""


def _dotted(x: str) -> str:
    return (f"CAST(({x}) >> 24 AS VARCHAR) || '.' || CAST((({x}) >> 16) & 255 AS VARCHAR) || '.' "
            f"|| CAST((({x}) >> 8) & 255 AS VARCHAR) || '.' || CAST(({x}) & 255 AS VARCHAR)")


ORACLE: dict[str, str] = {
    "daily_overview": f"""
      SELECT day, CAST(count(*) AS BIGINT) AS total, CAST(sum(succ) AS BIGINT) AS succ,
             CAST(sum(fee) AS DOUBLE) AS money, CAST(sum(cost_ms) AS BIGINT) AS cost_ms
      FROM ({_TOPUP}) GROUP BY day""",
    "minute_trend": f"""
      SELECT day, hour, minute, CAST(count(*) AS BIGINT) AS total,
             CAST(sum(succ) AS BIGINT) AS succ
      FROM ({_TOPUP}) GROUP BY day, hour, minute""",
    "hourly_province_failures": f"""
      SELECT coalesce(c.name, t.province_code) AS city, t.hour,
             CAST(count(*) AS BIGINT) AS fail_count
      FROM ({_TOPUP}) t LEFT JOIN ({_CITY}) c ON c.code = t.province_code
      WHERE t.succ = 0 GROUP BY 1, 2""",
    "province_success": _PROVINCE_OUT,
    "province_top10": f"SELECT * FROM ({_PROVINCE_OUT}) ORDER BY orders DESC, city LIMIT 10",
    "hourly_amount": f"""
      SELECT hour, CAST(sum(succ) AS BIGINT) AS succ_orders, CAST(sum(fee) AS DOUBLE) AS amount
      FROM ({_TOPUP}) GROUP BY hour""",
    "order_total": f"SELECT CAST(sum(money) AS BIGINT) AS amount FROM ({_ORDERS})",
    "order_by_category": f"""
      SELECT goods_type, CAST(sum(money) AS BIGINT) AS amount FROM ({_ORDERS}) GROUP BY 1""",
    "order_by_province": f"""
      WITH r AS ({_RANGES}), o AS ({_ORDERS})
      SELECT coalesce(r.province, (SELECT province FROM r ORDER BY lo LIMIT 1)) AS province,
             CAST(sum(o.money) AS BIGINT) AS amount
      FROM o ASOF LEFT JOIN r ON o.ip >= r.lo GROUP BY 1""",
    "daily_payment": f"""
      SELECT day, CAST(sum(money) AS BIGINT) AS total FROM ({_PAYMENTS}) GROUP BY 1""",
    "monthly_phone_sum": f"""
      SELECT month, phone, CAST(sum(money) AS BIGINT) AS amount
      FROM ({_PAYMENTS}) GROUP BY 1, 2""",
    "monthly_phone_avg": f"""
      SELECT month, phone, CAST(sum(money) AS DOUBLE) / count(*) AS avg_amount
      FROM ({_PAYMENTS}) GROUP BY 1, 2""",
    "browse_stats": f"""
      SELECT area_code, os, network_type, category_id AS category,
             count(user_id) AS user_count, count(*) AS view_count, bdp_day
      FROM ({_BROWSE}) GROUP BY area_code, os, network_type, category_id, bdp_day""",
    "browse_region_stats": f"""
      SELECT rd.region_province_desc AS region_province, rd.region_city_desc AS region_city,
             count(DISTINCT f.user_id) AS user_count, count(*) AS view_count, f.bdp_day
      FROM ({_BROWSE}) f LEFT JOIN ({_REGION}) rd ON rd.region_code = f.area_code
      GROUP BY 1, 2, f.bdp_day""",
    "word_count": f"SELECT value, count(*) AS count FROM ({_TOKENS}) GROUP BY value",
    "ip_containment": f"""
      WITH r AS ({_RANGES}), o AS ({_ORDERS})
      SELECT r.province, CAST(sum(o.money) AS BIGINT) AS amount
      FROM o LEFT JOIN r ON o.ip BETWEEN r.lo AND r.hi GROUP BY 1""",
    "city_dim_parse": _CITY,
    "ip_range_parse": f"""
      SELECT {_dotted('lo')} AS start_ip, {_dotted('hi')} AS end_ip, province,
             lo AS start_num, hi AS end_num
      FROM ({_RANGES})""",
}


_COUNTERS = f"""
  WITH t AS ({_TOPUP}),
  d AS (SELECT day, count(*) AS total, sum(succ) AS succ, sum(fee) AS money,
               sum(cost_ms) AS cost FROM t GROUP BY day),
  m AS (SELECT day, hour, minute, count(*) AS total, sum(succ) AS succ
        FROM t GROUP BY day, hour, minute)
  SELECT 'A-' || day AS key, 'total' AS field, CAST(total AS DOUBLE) AS value, day FROM d
  UNION ALL SELECT 'A-' || day, 'succ', CAST(succ AS DOUBLE), day FROM d
  UNION ALL SELECT 'A-' || day, 'money', CAST(money AS DOUBLE), day FROM d
  UNION ALL SELECT 'A-' || day, 'cost', CAST(cost AS DOUBLE), day FROM d
  UNION ALL SELECT 'B-' || day, 'T:' || hour || minute, CAST(total AS DOUBLE), day FROM m
  UNION ALL SELECT 'B-' || day, 'S:' || hour || minute, CAST(succ AS DOUBLE), day FROM m
"""

# Counters of the last life of each day's hash: records arrive late, 48 hours without
# one end a life, and a hash is gone 48 hours after the last one (clock: latest arrival).
_ARRIVAL = """ts + to_hours(CASE event_id % 3 WHEN 0 THEN 0
    WHEN 1 THEN CASE WHEN date_part('day', ts) % 2 = 0 THEN 20 ELSE 45 END ELSE CASE WHEN date_part('day', ts) % 2 = 0 THEN 100 ELSE 90 END END)"""
_LATE = f"""
  SELECT t.*, {_ARRIVAL} AS arrived
  FROM ({_TOPUP.replace("SELECT strftime", "SELECT event_id, ts, strftime", 1)}) t
"""
_ALIVE = f"""
  WITH w AS (SELECT *, lag(arrived) OVER (PARTITION BY day ORDER BY arrived) AS prev FROM ({_LATE})),
  life AS (SELECT day, max(CASE WHEN prev IS NULL OR arrived - prev >= INTERVAL 48 HOURS THEN arrived END) AS birth,
                  max(arrived) AS last FROM w GROUP BY day),
  clock AS (SELECT max({_ARRIVAL}) AS now FROM events)
  SELECT w.* FROM w JOIN life ON w.day = life.day AND w.arrived >= life.birth, clock
  WHERE life.last + INTERVAL 48 HOURS > clock.now
"""

_LEDGER = """
  SELECT 'events' AS topic, CAST(event_id % 4 AS INTEGER) AS partition,
         CAST(max(event_id // 4) + 1 AS BIGINT) AS until_offset
  FROM events GROUP BY 2
"""

_PAYMENT_JSON = """
  SELECT strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS date,
         CAST(CAST(floor(o_totalprice) AS BIGINT) AS VARCHAR) AS money,
         '138' || lpad(CAST(o_custkey AS VARCHAR), 8, '0') AS phoneNum
  FROM orders
"""

ORACLE.update({
    "views_per_day": f"""
      SELECT bdp_day, count(*) AS view_count, count(DISTINCT user_id) AS user_count
      FROM ({_BROWSE}) GROUP BY bdp_day""",
    "topup_quarantine_balance": """
      WITH e AS (SELECT event_type, event_id % 50 = 0 OR event_id % 70 = 0 AS damaged FROM events)
      SELECT 'input' AS part, count(*) AS n FROM e
      UNION ALL SELECT 'quarantine', count(*) FROM e WHERE damaged
      UNION ALL SELECT 'base', count(*) FROM e WHERE NOT damaged AND event_type IN ('purchase', 'error')
      UNION ALL SELECT 'other', count(*) FROM e WHERE NOT damaged AND event_type NOT IN ('purchase', 'error')""",
    "stream_overview": ORACLE["daily_overview"],
    "stream_orders": ORACLE["order_by_province"],
    "stream_payments": ORACLE["daily_payment"],
    "upsert_failures": ORACLE["hourly_province_failures"],
    "upsert_province": ORACLE["province_success"],
    "upsert_hour": ORACLE["hourly_amount"],
    "word_count_stream": ORACLE["word_count"],
    "catalog_overwrite": ORACLE["browse_stats"],
    "counter_merge": f"SELECT key, field, value FROM ({_COUNTERS})",
    "counter_ttl": f"SELECT key, field, value FROM ({_COUNTERS.replace(_TOPUP, _ALIVE)})",
    "offset_ledger": f"SELECT 'chargepulse' AS group_id, * FROM ({_LEDGER})",
    "offset_restore": f"""
      SELECT topic, '{{"' || topic || '":{{'
             || string_agg('"' || CAST(partition AS VARCHAR) || '":' || CAST(until_offset AS VARCHAR),
                           ',' ORDER BY partition) || '}}}}' AS starting_offsets
      FROM ({_LEDGER}) GROUP BY topic""",
    "ledger_resume": ORACLE["daily_overview"],
    "word_count_complete": ORACLE["word_count"],
    "catalog_overwrite_region": ORACLE["browse_region_stats"],
    "browse_region_stream": ORACLE["browse_region_stats"],
    "quarantine_append": """
      SELECT CASE WHEN event_id % 50 <> 0 THEN strftime(ts, '%Y%m%d%H%M%S%g') || lpad(CAST(event_id AS VARCHAR), 8, '0') END
               AS request_id,
             CASE WHEN event_id % 50 <> 0 THEN CASE WHEN event_type = 'purchase' THEN '0000' ELSE '9999' END END AS result_code,
             CASE WHEN event_id % 50 <> 0 THEN CAST(user_id % 30 AS VARCHAR) END AS province_code
      FROM events WHERE event_id % 50 = 0 OR event_id % 70 = 0""",
    "dim_line_balance": """
      WITH c AS (
        SELECT n_nationkey AS k, CASE WHEN n_nationkey % 7 = 0 OR n_nationkey % 5 = 0 THEN 'malformed'
               WHEN n_nationkey % 4 = 0 THEN 'replaced' ELSE 'used' END AS reason FROM nation
        UNION ALL SELECT n_nationkey, 'used' FROM nation WHERE n_nationkey % 4 = 0),
      i AS (SELECT CASE WHEN n_nationkey % 4 = 0 THEN 'short' WHEN n_nationkey % 5 = 0 THEN 'bad start'
                   ELSE 'used' END AS reason FROM nation)
      SELECT 'city' AS file, reason, count(*) AS n FROM c GROUP BY reason
      UNION ALL SELECT 'ip', reason, count(*) FROM i GROUP BY reason""",
    "json_append": f"SELECT * FROM ({_PAYMENT_JSON}) UNION ALL SELECT * FROM ({_PAYMENT_JSON})",
})


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
