"""Word counts of many triggers: bounded by bytes for each core, whole tables read once."""

import datetime as dt

from chargepulse.functions.text import java_split_tokens
from chargepulse.plans import stream_queries as S
from chargepulse.session import scratch_path
from chargepulse.sources.streams import text_stream
from chargepulse.streaming.jobs import WordCountJob
from chargepulse.streaming.state import CommitLog

LINES = [" ".join(f"w{(i * k) % 97}" for k in range(1, 9)) + " " * (i % 3) for i in range(160)]


def _expected():
    out = {}
    for line in LINES:
        for w in line.rstrip(" ").split(" "):
            out[w] = out.get(w, 0) + 1
    return out


def _lines(spark):
    return spark.createDataFrame([(x,) for x in LINES], "value string").coalesce(1)


def test_triggers_follow_the_cores(spark, monkeypatch):
    jobs = []

    class Kept(WordCountJob):
        def __init__(self, *args):
            super().__init__(*args)
            jobs.append(self)

    size = sum(len(x) + 1 for x in LINES)
    monkeypatch.setattr(S, "WordCountJob", Kept)
    monkeypatch.setattr(S.fx, "text_lines", lambda spark, _: _lines(spark))
    monkeypatch.setattr(S, "ROWS_PER_FILE", 10)       # 16 files
    monkeypatch.setattr(S, "TRIGGER_BYTES", size // 7)
    cores = spark.sparkContext.defaultParallelism
    for query in (S.word_count_stream, S.word_count_complete):
        assert {r.value: r["count"] for r in query(spark, "").collect()} == _expected()
        assert 1 < len(jobs[-1].batches_seen) <= -(-8 // cores) + 1


def test_complete_mode_reads_the_newest_table_alone(spark):
    src = scratch_path(spark, "t", "whole")
    _lines(spark).write.option("maxRecordsPerFile", 40).text(src)
    job = WordCountJob(spark, scratch_path(spark, "t", "wholestate"))
    job.start(text_stream(spark, src, 1), scratch_path(spark, "t", "wholeckpt"), output_mode="complete",
              trigger={"availableNow": True}).awaitTermination(600)
    assert job.batches_seen == [0, 1, 2, 3]
    assert [r.batch for r in job.log.valid().collect()] == [3]
    assert {r.value: r["count"] for r in job.result().collect()} == _expected()


def test_commit_keeps_positions(spark):
    log = CommitLog(spark, scratch_path(spark, "t", "commitlog"))
    log.open("q")
    at = dt.datetime(2026, 1, 2, 3, 4, 5, 678901, tzinfo=dt.timezone.utc)
    log.commit(0, False, at)
    log.commit(1, False, at + dt.timedelta(hours=1), [('a "b"\\é', 0, 1 << 40), (None, 2, 5)])
    assert {tuple(r) for r in log.positions().collect()} == {('a "b"\\é', 0, 1 << 40), (None, 2, 5)}
    assert log.clock() == at + dt.timedelta(hours=1)
    assert [tuple(r)[:3] for r in log.rows().orderBy("batch").collect()] == [("q", False, 0)] * 2


def test_tokens_drop_trailing_separators_only(spark):
    rows = ["", " ", "   ", " a", "a  ", "a  b ", "a\t ", "a\n", "é  ", None]
    df = spark.createDataFrame([(x,) for x in rows], "value string")
    got = [r[0] for r in df.select(java_split_tokens("value")).collect()]
    assert got == [[""], [], [], ["", "a"], ["a"], ["a", "", "b"], ["a\t"], ["a\n"], ["é"], None]
    assert [r[0] for r in df.select(java_split_tokens("value", "|")).collect()][:4] == [[""], [" "], ["   "], [" a"]]
