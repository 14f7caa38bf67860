from pyspark.sql import functions as F

from chargepulse.operators.lookup import (code_name_lookup, containment_join, floor_range_join,
                                          floor_ranges, overlapping_ranges)


def _ranges(spark, rows):
    return spark.createDataFrame(rows, "start_num long, end_num long, province string")


def _facts(spark, ips):
    return spark.createDataFrame([(i, ip) for i, ip in enumerate(ips)], "id int, ip_num long")


RANGES = [(100, 199, "A"), (300, 399, "B"), (70000, 80000, "C")]


def test_floor_lookup_edges(spark):
    facts = _facts(spark, [5, 100, 150, 250, 300, 69999, 70000, 4294967295, None])
    got = {r.id: r.province for r in
           floor_range_join(facts, "ip_num", _ranges(spark, RANGES)).collect()}
    # below the first start -> first range (clamp); gaps -> previous start; last open-ended
    assert got == {0: "A", 1: "A", 2: "A", 3: "A", 4: "B", 5: "B", 6: "C", 7: "C", 8: None}


def test_floor_lookup_below_first_null(spark):
    facts = _facts(spark, [5, 100])
    got = {r.id: r.province for r in floor_range_join(
        facts, "ip_num", _ranges(spark, RANGES), below_first="null").collect()}
    assert got == {0: None, 1: "A"}


def test_floor_lookup_one_row_per_fact_and_hash_join(spark):
    facts = spark.range(0, 200000, 7).select(F.col("id").alias("ip_num"))
    out = floor_range_join(facts, "ip_num", _ranges(spark, RANGES))
    assert out.count() == facts.count()
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "NestedLoop" not in plan


def test_floor_ranges_cover_space_across_blocks(spark):
    starts = [(1 << 16) * 3 + 5, (1 << 16) * 3 + 9, (1 << 16) * 40, 7]
    r = spark.createDataFrame([(s, str(i)) for i, s in enumerate(starts)],
                              "start_num long, province string")
    iv = sorted((x.lo, x.hi) for x in floor_ranges(r).collect())
    assert iv == [(0, (1 << 16) * 3 + 4), ((1 << 16) * 3 + 5, (1 << 16) * 3 + 8),
                  ((1 << 16) * 3 + 9, (1 << 16) * 40 - 1), ((1 << 16) * 40, (1 << 32) - 1)]


def test_containment_miss_is_null(spark):
    facts = _facts(spark, [5, 150, 250, 399, 75000, 90000])
    got = {r.id: r.province for r in
           containment_join(facts, "ip_num", _ranges(spark, RANGES)).collect()}
    assert got == {0: None, 1: "A", 2: None, 3: "B", 4: "C", 5: None}


def test_overlap_detection(spark):
    assert overlapping_ranges(_ranges(spark, RANGES)).count() == 0
    bad = _ranges(spark, RANGES + [(350, 500, "D")])
    assert [(r.lo, r.next_lo) for r in overlapping_ranges(bad).collect()] == [(300, 350)]


def test_code_name_lookup_fallback(spark):
    fact = spark.createDataFrame([("1",), ("2",), ("99",)], "code string")
    dim = spark.createDataFrame([("1", "Beijing"), ("2", "Shanghai")], "code string, name string")
    got = sorted(r.city for r in code_name_lookup(fact, dim, "code").collect())
    assert got == ["99", "Beijing", "Shanghai"]


def test_floor_lookup_equals_the_range_join(spark):
    import random

    from chargepulse.operators.lookup import floor_lookup, floor_range_join

    rnd = random.Random(11)
    starts = [(rnd.randrange(1 << 32), f"p{i}") for i in range(60)] + [(5 << 16, "edge"), (5 << 16, "aaa"), (None, "none"),
                                                                      ((1 << 32) - 1, "last"), (7 << 16, None)]
    ranges = spark.createDataFrame(starts, "start_num long, province string")
    nums = [rnd.randrange(1 << 32) for _ in range(500)] + [s + d for s, _ in starts if s for d in (-1, 0, 1)] + [0, None]
    facts = spark.createDataFrame([(n, i) for i, n in enumerate(nums) if n is None or 0 <= n < 1 << 32], "ip_num long, v long")
    for below in ("clamp", "null"):
        want = floor_range_join(facts, "ip_num", ranges, below_first=below).select("ip_num", "v", "province")
        got = floor_lookup(facts, "ip_num", ranges, below_first=below).select("ip_num", "v", "province")
        assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
    none = floor_lookup(facts, "ip_num", ranges.limit(0))
    assert {r.province for r in none.collect()} == {None}


def test_records_do_not_meet_the_ranges(spark):
    """Orders are summed by address before any window or join."""
    from chargepulse.operators import metrics as M

    base = spark.range(1000).select((F.col("id") % 10).alias("ip_num"), F.lit(1).cast("bigint").alias("money"))
    ranges = spark.createDataFrame([(0, "a"), (5, "b")], "start_num long, province string")
    assert {r.province: r.amount for r in M.ORDER_BY_PROVINCE.batch(base, {"ip_ranges": ranges}).collect()} == {"a": 500, "b": 500}
