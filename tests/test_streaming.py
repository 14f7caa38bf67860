"""Streaming = batch, replay safety and the ledger (sf 0.001)."""

from conftest import SF_SMALL
from pyspark.sql import functions as F

from chargepulse.plans import fixtures as fx
from chargepulse.plans.registry import queries
from chargepulse.session import scratch_path
from chargepulse.sources.dims import parse_ip_ranges
from chargepulse.sources.streams import (max_records_per_trigger, record_file_stream,
                                         text_stream)
from chargepulse.streaming.jobs import order_job, payment_job
from chargepulse.streaming.sinks import starting_offsets


def _set(df):
    return sorted(tuple(r) for r in df.collect())


def test_stream_overview_equals_batch(spark):
    q = queries()
    assert _set(q["stream_overview"](spark, SF_SMALL)) == _set(q["daily_overview"](spark, SF_SMALL))


def test_upserts_equal_batch_after_replay(spark):
    q = queries()
    assert _set(q["upsert_hour"](spark, SF_SMALL)) == _set(q["hourly_amount"](spark, SF_SMALL))
    assert _set(q["upsert_province"](spark, SF_SMALL)) == _set(q["province_success"](spark, SF_SMALL))


def test_word_count_stream_equals_batch(spark):
    q = queries()
    assert _set(q["word_count_stream"](spark, SF_SMALL)) == _set(q["word_count"](spark, SF_SMALL))


def _order_records(spark):
    lines = fx.order_lines(spark, SF_SMALL)
    return lines.select(F.lit("orders").alias("topic"), F.lit(0).alias("partition"),
                        F.monotonically_increasing_id().alias("offset"), "value")


def test_order_and_payment_streams_equal_batch(spark):
    src = scratch_path(spark, "t", "orders")
    _order_records(spark).repartition(3).write.parquet(src)
    ranges = parse_ip_ranges(fx.ip_range_lines(spark, SF_SMALL))
    job = order_job(spark, scratch_path(spark, "t", "ostate"), ranges)
    q = job.start(record_file_stream(spark, src), scratch_path(spark, "t", "ockpt"),
                  trigger={"availableNow": True})
    q.awaitTermination(600)
    assert len(job.batches_seen) == 3
    batch = queries()
    for name in ("order_total", "order_by_category", "order_by_province"):
        assert _set(job.result(name)) == _set(batch[name](spark, SF_SMALL)), name

    psrc = scratch_path(spark, "t", "pay")
    fx.payment_json(spark, SF_SMALL).repartition(3).write.text(psrc)
    pjob = payment_job(spark, scratch_path(spark, "t", "pstate"))
    q = pjob.start(text_stream(spark, psrc, 1), scratch_path(spark, "t", "pckpt"),
                   trigger={"availableNow": True})
    q.awaitTermination(600)
    for name in ("daily_payment", "monthly_phone_sum", "monthly_phone_avg"):
        assert _set(pjob.result(name)) == _set(batch[name](spark, SF_SMALL)), name


def test_restart_redelivers_nothing(spark):
    src = scratch_path(spark, "t", "pay2")
    ckpt = scratch_path(spark, "t", "pay2ckpt")
    state = scratch_path(spark, "t", "pay2state")
    fx.payment_json(spark, SF_SMALL).repartition(2).write.text(src)
    for _ in range(2):   # second run resumes from the checkpoint
        job = payment_job(spark, state)
        job.start(text_stream(spark, src, 1), ckpt, trigger={"availableNow": True}).awaitTermination(600)
    assert _set(job.result("daily_payment")) == _set(queries()["daily_payment"](spark, SF_SMALL))


def test_ledger_and_starting_offsets(spark):
    led = queries()["offset_ledger"](spark, SF_SMALL)
    rows = {r.partition: r.until_offset for r in led.collect()}
    assert rows == {p: 250 for p in range(4)}
    assert starting_offsets(spark, led) == '{"events":{"0":250,"1":250,"2":250,"3":250}}'


def test_rate_limit_total():
    assert max_records_per_trigger(100, 1, 3) == 300
    assert max_records_per_trigger(2, 3, 4) == 24


def test_counter_ttl_is_the_last_life(spark):
    q = queries()
    merged = {(r.key, r.field): r.value for r in q["counter_merge"](spark, SF_SMALL).collect()}
    alive = {(r.key, r.field): r.value for r in q["counter_ttl"](spark, SF_SMALL).collect()}
    assert alive and {k for k, _ in alive} < {k for k, _ in merged}
    assert {k[2:] for k, _ in alive} == {k[2:] for k, _ in alive if k[0] == "A"}
    # a revived day has lost what was written before its gap, a day without a gap nothing
    totals = [(merged[k, f], v) for (k, f), v in alive.items() if f == "total"]
    assert any(v < all_ for all_, v in totals) and any(v == all_ for all_, v in totals)


def test_observed_positions_and_many_partitions(spark):
    from chargepulse.streaming.jobs import offset_tracking_job

    for parts, topics in ((4, 1), (100, 1), (3, 2)):
        rec = spark.range(1000).select(
            F.concat(F.lit("t"), F.col("id") % topics).alias("topic"), (F.col("id") % parts).cast("int").alias("partition"),
            F.col("id").alias("offset"), F.lit("x").alias("value"))
        src = scratch_path(spark, "t", "observed")
        rec.repartition(2).write.parquet(src)
        job = offset_tracking_job(spark, scratch_path(spark, "t", "obstate"))
        job.start(record_file_stream(spark, src), scratch_path(spark, "t", "obckpt"),
                  trigger={"availableNow": True}).awaitTermination(600)
        want = rec.groupBy("topic", "partition").agg((F.max("offset") + 1).alias("o"))
        assert _set(job.ledger_table()) == _set(want)


def test_triggers_follow_bytes(spark):
    src = scratch_path(spark, "t", "bytes")
    _order_records(spark).repartition(4).write.parquet(src)
    seen = []
    for size in (1, 1 << 30):
        job = order_job(spark, scratch_path(spark, "t", "bstate"), parse_ip_ranges(fx.ip_range_lines(spark, SF_SMALL)))
        job.start(record_file_stream(spark, src, max_bytes_per_trigger=size), scratch_path(spark, "t", "bckpt"),
                  trigger={"availableNow": True}).awaitTermination(600)
        seen.append(len(job.batches_seen))
    assert seen == [4, 1]


def test_word_count_complete_mode_and_console(spark, capsys):
    from chargepulse.streaming.jobs import WordCountJob
    from chargepulse.streaming.sinks import console

    src = scratch_path(spark, "t", "wc")
    spark.createDataFrame([("a b a",), ("b  c ",), ("",)], "value string") \
        .repartition(2).write.text(src)
    job = WordCountJob(spark, scratch_path(spark, "t", "wcstate"))
    job.start(text_stream(spark, src, 1), scratch_path(spark, "t", "wcckpt"),
              output_mode="complete", trigger={"availableNow": True}).awaitTermination(600)
    assert {r.value: r["count"] for r in job.result().collect()} == {
        "a": 2, "b": 2, "c": 1, "": 2}
    q = console(WordCountJob.counts(text_stream(spark, src)).coalesce(1), "complete")
    q.processAllAvailable()
    q.stop()


def test_offset_tracking_job(spark):
    from chargepulse.streaming.jobs import offset_tracking_job

    src = scratch_path(spark, "t", "topic")
    fx.topic_records(spark, SF_SMALL).repartition(3).write.parquet(src)
    job = offset_tracking_job(spark, scratch_path(spark, "t", "otstate"), show_rows=2)
    job.start(record_file_stream(spark, src), scratch_path(spark, "t", "otckpt"),
              trigger={"availableNow": True}).awaitTermination(600)
    assert {r.partition: r.until_offset for r in job.ledger_table().collect()} == {
        p: 250 for p in range(4)}


def test_fresh_checkpoint_refuses_old_state(spark):
    import pytest

    src = scratch_path(spark, "t", "gen")
    state = scratch_path(spark, "t", "genstate")
    fx.payment_json(spark, SF_SMALL).repartition(2).write.text(src)
    job = payment_job(spark, state)
    job.start(text_stream(spark, src, 1), scratch_path(spark, "t", "genckpt1"),
              trigger={"availableNow": True}).awaitTermination(600)
    job2 = payment_job(spark, state)
    with pytest.raises(ValueError):
        job2.start(text_stream(spark, src, 1), scratch_path(spark, "t", "genckpt2"),
                   trigger={"availableNow": True})
    job2.start(text_stream(spark, src, 1), scratch_path(spark, "t", "genckpt3"),
               trigger={"availableNow": True}, reset_state=True).awaitTermination(600)
    assert _set(job2.result("daily_payment")) == _set(queries()["daily_payment"](spark, SF_SMALL))


def test_stream_quarantines_bad_records(spark):
    src = scratch_path(spark, "t", "payq")
    good = ['{"date":"2024-03-05 10:00:00","phoneNum":"1","money":"30"}',
            '{"date":"2024-04-01 00:00:00","phoneNum":"1","money":"5"}']
    bad = ['{"date":"2024-03-05","phoneNum":"1","money":"x"}', 'not json']
    for i, chunk in enumerate([good[:1] + bad[:1], good[1:] + bad[1:]]):
        spark.createDataFrame([(v,) for v in chunk], "value string").coalesce(1) \
            .write.mode("append").text(src)
    job = payment_job(spark, scratch_path(spark, "t", "payqstate"))
    job.start(text_stream(spark, src, 1), scratch_path(spark, "t", "payqckpt"),
              trigger={"availableNow": True}).awaitTermination(600)
    assert sorted(map(tuple, job.result("monthly_phone_sum").collect())) == [
        ("2024-03", "1", 30), ("2024-04", "1", 5)]
    assert job.quarantined().count() == 2


def test_starting_offsets_many_partitions_and_topics(spark):
    from chargepulse.streaming.sinks import ledger_from_legacy

    legacy = spark.createDataFrame(
        [("top-up-events-10", 7), ("top-up-events-2", 5), ("orders-0", 1), ("orders-1", 3)],
        "tp_key string, until_offset long")
    got = starting_offsets(spark, ledger_from_legacy(legacy))
    import json
    assert json.loads(got) == {"top-up-events": {"2": 5, "10": 7}, "orders": {"0": 1, "1": 3}}
    assert '"2":5,"10":7' in got
