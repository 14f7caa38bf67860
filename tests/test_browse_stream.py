"""Distinct users by region and day as a stream (AGG13): exact masks, put together by batches."""

import random

from conftest import SF_SMALL
from pyspark.sql import functions as F

from chargepulse.operators import metrics as M
from chargepulse.operators.browse import browse_region_stats
from chargepulse.plans.registry import queries
from chargepulse.session import scratch_path
from chargepulse.streaming.jobs import BROWSE_SCHEMA, browse_job

REGION = "region_code bigint, region_province_desc string, region_city_desc string"
#: 2 and 3 are one city; 9 is no area.
AREAS = [(1, "P", "a"), (2, "P", "b"), (3, "P", "b"), (4, None, None)]


def _set(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def _facts(spark, seed, n=400):
    rng = random.Random(seed)
    users = [None, 0, 1, 63, 64, 65, -1, -64, -65, (1 << 63) - 1, -(1 << 63), *range(1000, 1100)]
    rows = [(rng.choice([1, 2, 3, 4, 9, None]), rng.choice(["20240101", "20240102", None]), rng.choice(users)) for _ in range(n)]
    rows += [(2, "20240105", None), (9, "20240105", 7)]
    return spark.createDataFrame(rows, BROWSE_SCHEMA)


def test_masks_count_as_distinct_does(spark):
    region = spark.createDataFrame(AREAS, REGION)
    for seed in range(3):
        facts = _facts(spark, seed)
        want = _set(browse_region_stats(facts, region))
        assert _set(M.BROWSE_REGION_USERS.batch(facts, {"region": region})) == want
    assert M.BROWSE_REGION_USERS.batch(facts.limit(0), {"region": region}).count() == 0


def test_batches_that_share_users_and_a_replay(spark):
    region = spark.createDataFrame(AREAS, REGION)
    facts = _facts(spark, 7).unionByName(_facts(spark, 8))
    job = browse_job(spark, scratch_path(spark, "t", "bstate"), region, fold_every=2)
    job.open("query")
    parts = facts.persist().randomSplit([1.0, 1.0, 1.0], 5)
    for batch, part in ((0, 0), (1, 1), (1, 1), (2, 2)):   # batch 1, which holds a fold, comes twice
        job.handle(parts[part], batch)
    assert _set(job.result("browse_region_users")) == _set(browse_region_stats(facts, region))


def test_one_row_for_64_neighbours(spark):
    facts = spark.range(6400).select(F.lit(1).alias("area_code"), F.lit("d").alias("bdp_day"), F.col("id").alias("user_id"))
    delta = M.BROWSE_REGION_USERS.delta(facts, {})
    assert delta.count() == 100
    assert delta.agg(F.sum(F.bit_count("mask"))).first()[0] == 6400


def test_stream_query_equals_batch(spark):
    q = queries()
    assert _set(q["browse_region_stream"](spark, SF_SMALL)) == _set(q["browse_region_stats"](spark, SF_SMALL))
