"""Recorded topics as a stream with start positions."""

import json

import pytest
from pyspark.sql import functions as F

from chargepulse.session import scratch_path
from chargepulse.sources.segments import SegmentReader, record_segments, segment_stream
from chargepulse.streaming.jobs import offset_tracking_job
from chargepulse.streaming.sinks import append_files, starting_offsets


def _records(spark, lo, hi, partitions):
    ids = spark.range(lo, hi).crossJoin(spark.range(partitions).withColumnRenamed("id", "p"))
    return ids.select(F.lit("t").alias("topic"), F.col("p").cast("int").alias("partition"), F.col("id").alias("offset"),
                      F.concat_ws("-", "p", "id").alias("value"))


def _read(spark, path, start, ckpt, out):
    q = append_files(segment_stream(spark, path, start).select("partition", "offset", "value"), out, ckpt, {"availableNow": True})
    q.awaitTermination(300)
    assert q.exception() is None
    return sorted((r.partition, r.offset) for r in spark.read.parquet(out).collect())


def test_positions_and_new_partitions(spark):
    path, ckpt, out = (scratch_path(spark, "seg", n) for n in ("topic", "ckpt", "out"))
    record_segments(_records(spark, 0, 100, 2), path, 30)
    start = json.dumps({"t": {"0": 40, "1": 100}})
    assert _read(spark, path, start, ckpt, out) == [(0, i) for i in range(40, 100)]
    # goes on from the checkpoint, with a partition that is new
    record_segments(_records(spark, 100, 150, 2), path, 30)
    record_segments(_records(spark, 0, 20, 3).where("partition = 2"), path, 30)
    want = [(0, i) for i in range(40, 150)] + [(1, i) for i in range(100, 150)] + [(2, i) for i in range(20)]
    assert _read(spark, path, "earliest", ckpt, out) == want


def test_a_part_of_a_segment_is_read_by_offsets(spark):
    path = scratch_path(spark, "seg", "topic")
    record_segments(_records(spark, 0, 100, 1), path, 1000)
    reader = SegmentReader(path, "earliest")
    assert reader.latestOffset() == {"0": 100}
    (part,) = reader.partitions({"0": 10}, {"0": 13})
    assert [r for b in reader.read(part) for r in b.column(2).to_pylist()] == [10, 11, 12]
    assert reader.partitions({"0": 100}, {"0": 100}) == []
    with pytest.raises(ValueError):
        SegmentReader(path, json.dumps({"a": {}, "b": {}}))


def test_nothing_recorded(spark):
    path, ckpt, out = (scratch_path(spark, "seg", n) for n in ("none", "ckpt", "out"))
    q = append_files(segment_stream(spark, path), out, ckpt, {"availableNow": True})
    q.awaitTermination(300)
    assert q.exception() is None


def test_resume_from_the_ledger(spark):
    path, state = scratch_path(spark, "seg", "topic"), scratch_path(spark, "seg", "state")
    job = offset_tracking_job(spark, state)
    record_segments(_records(spark, 0, 50, 2), path, 20)
    job.start(segment_stream(spark, path), scratch_path(spark, "seg", "c"), {"availableNow": True}).awaitTermination(300)
    record_segments(_records(spark, 50, 70, 2), path, 20)
    stream = segment_stream(spark, path, starting_offsets(spark, job.ledger_table(), "t"))
    again = offset_tracking_job(spark, state)
    with pytest.raises(ValueError, match="fresh checkpoint"):
        again.start(stream, scratch_path(spark, "seg", "c"), {"availableNow": True})
    again.start(stream, scratch_path(spark, "seg", "c"), {"availableNow": True}, resume=True).awaitTermination(300)
    assert again.log.gen == 1
    assert sorted(map(tuple, again.ledger_table().collect())) == [("t", 0, 70), ("t", 1, 70)]
    spans = again.log.rows().select("gen", F.inline("positions")).orderBy("gen", "partition").collect()
    assert [(r.gen, r.partition, r.until_offset) for r in spans] == [(0, 0, 50), (0, 1, 50), (1, 0, 70), (1, 1, 70)]
