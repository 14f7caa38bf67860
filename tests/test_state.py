"""Deltas, commits, folds and expiry."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from chargepulse.operators.metrics import MetricSpec
from chargepulse.streaming.state import CommitLog, KeyedState

T0 = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
H = dt.timedelta(hours=1)


def _delta(spark, rows):
    return (spark.createDataFrame([(k, f, float(v)) for k, f, v in rows],
                                  "key string, field string, value double")
            .withColumn("value", F.col("value").cast("decimal(18,2)")))


def _table(st, now=None):
    return {(r.key, r.field): float(r.value) for r in st.read(now=now).collect()}


def _counters(spark, path, **kw):
    return KeyedState(spark, path, ["key", "field"], {"value": "decimal(18,2)"}, **kw)


def test_merge_accumulates_and_replay_is_idempotent(spark, tmpdir_str):
    st = _counters(spark, tmpdir_str + "/c")
    assert _table(st) == {}
    st.merge(_delta(spark, [("A", "total", 1), ("A", "money", 2.5)]), 0, T0)
    st.merge(_delta(spark, [("A", "total", 2), ("B", "total", 1)]), 1, T0)
    first = _table(st)
    st.merge(_delta(spark, [("A", "total", 2), ("B", "total", 1)]), 1, T0)  # replay
    assert _table(st) == first == {("A", "total"): 3.0, ("A", "money"): 2.5, ("B", "total"): 1.0}


def test_uncommitted_batch_does_not_count(spark, tmpdir_str):
    st = _counters(spark, tmpdir_str + "/c")
    st.merge(_delta(spark, [("A", "total", 1)]), 0, T0)
    st.write(_delta(spark, [("A", "total", 5)]), 1, T0)  # crashed before its commit
    assert _table(st) == {("A", "total"): 1.0}
    st.merge(_delta(spark, [("A", "total", 7)]), 1, T0)  # delivered again
    assert _table(st) == {("A", "total"): 8.0}


def test_state_does_not_need_success_markers(spark, tmpdir_str):
    conf = spark._jsc.hadoopConfiguration()
    key = "mapreduce.fileoutputcommitter.marksuccessfuljobs"
    before = conf.get(key)
    conf.set(key, "false")
    try:
        st = _counters(spark, tmpdir_str + "/c", fold_every=2)
        for b in range(3):
            st.merge(_delta(spark, [("A", "total", 1)]), b, T0)
        assert _table(st) == {("A", "total"): 3.0}
    finally:
        conf.set(key, before) if before else conf.unset(key)


def test_ttl_is_per_key_group_not_per_row(spark, tmpdir_str):
    st = _counters(spark, tmpdir_str + "/c", ttl=48 * H, ttl_keys=["key"])
    st.merge(_delta(spark, [("B-1", "T:1", 1), ("B-2", "T:1", 1)]), 0, T0)
    # 30 h later only B-1 is written again, with a different field
    st.merge(_delta(spark, [("B-1", "T:2", 1)]), 1, T0 + 30 * H)
    # 60 h after T0: B-2 (last write T0) has expired; B-1's quiet field T:1 survives
    st.merge(_delta(spark, [("B-3", "T:1", 1)]), 2, T0 + 60 * H)
    assert set(_table(st)) == {("B-1", "T:1"), ("B-1", "T:2"), ("B-3", "T:1")}
    # expiry also applies on read, with no new write
    assert set(_table(st, now=T0 + 79 * H)) == {("B-3", "T:1")}


@pytest.mark.parametrize("gap, left", [(dt.timedelta(hours=47, minutes=59), 6.0), (48 * H, 1.0), (60 * H, 1.0)])
def test_a_life_ends_after_the_ttl(spark, tmpdir_str, gap, left):
    st = _counters(spark, tmpdir_str + "/c", ttl=48 * H, ttl_keys=["key"])
    st.merge(_delta(spark, [("a", "f", 5)]), 0, T0 + 23 * H)
    st.merge(_delta(spark, [("a", "f", 1)]), 1, T0 + 23 * H + gap)
    assert _table(st) == {("a", "f"): left}
    assert _table(st, now=T0 + 23 * H + gap + 48 * H) == {}


def test_lives_by_brute_force(spark, tmpdir_str):
    """Random writes in random order over batches, with folds; the times come with the delta."""
    rnd = random.Random(3)
    writes = [(rnd.choice("abcdef"), rnd.choice("xy"), rnd.randint(1, 9), T0 + rnd.randint(0, 900) * H) for _ in range(120)]
    writes.sort(key=lambda w: w[3])
    st = _counters(spark, tmpdir_str + "/c", ttl=48 * H, ttl_keys=["key"], fold_every=4)
    for b in range(10):
        own = writes[b * 12:b * 12 + 12]
        rnd.shuffle(own)
        df = spark.createDataFrame([(k, f, v, t, t) for k, f, v, t in own],
                                   "key string, field string, value int, first_update timestamp, last_update timestamp")
        st.merge(df, b, max(w[3] for w in own))
    want, alive = {}, {}
    for k, f, v, t in writes:
        if k in alive and t - alive[k] >= 48 * H:
            want = {x: y for x, y in want.items() if x[0] != k}
        want[k, f] = want.get((k, f), 0) + v
        alive[k] = t
    now = writes[-1][3]
    assert _table(st) == {x: float(v) for x, v in want.items() if alive[x[0]] + 48 * H > now}


def test_max_combine(spark, tmpdir_str):
    st = KeyedState(spark, tmpdir_str + "/l", ["topic", "partition"], {"until_offset": "bigint"},
                    combine={"until_offset": "max"}, key_types={"partition": "int"}, fold_every=3)
    for b, off in enumerate([10, 30, 20, 40]):
        st.merge(spark.createDataFrame([("t", 0, off)], "topic string, partition int, until_offset long"), b, T0)
    assert [tuple(r)[:3] for r in st.read().collect()] == [("t", 0, 40)]


def test_keyless_state(spark, tmpdir_str):
    st = KeyedState(spark, tmpdir_str + "/g", [], {"amount": "bigint"})
    st.merge(spark.range(5).select(F.col("id").alias("amount")), 0, T0)
    st.merge(spark.range(3).select(F.col("id").alias("amount")), 1, T0)
    assert st.read().first().amount == 13


def test_folds_change_nothing(spark, tmpdir_str):
    rnd = random.Random(7)
    batches = [[(f"k{rnd.randint(0, 9)}", rnd.randint(1, 5)) for _ in range(20)] for _ in range(8)]
    plain = KeyedState(spark, tmpdir_str + "/plain", ["k"], {"v": "bigint"}, fold_every=1000)
    folded = KeyedState(spark, tmpdir_str + "/folded", ["k"], {"v": "bigint"}, fold_every=3)
    for b, rows in enumerate(batches):
        df = spark.createDataFrame(rows, "k string, v long")
        plain.merge(df, b, T0)
        folded.merge(df, b, T0)
        if b in (4, 5, 6):   # a delta, a fold, and a delta after it delivered again
            folded.merge(df, b, T0)
        assert sorted(map(tuple, folded.read().select("k", "v").collect())) == \
            sorted(map(tuple, plain.read().select("k", "v").collect()))
    # reading starts at the newest fold
    assert sorted(r.batch for r in folded.log.valid().collect()) == [5, 6, 7]


def test_null_and_odd_keys_agree_with_batch(spark, tmpdir_str):
    spec = MetricSpec("by_day", ("day", "phone"), {"n": "bigint"},
                      lambda base, ctx: base.groupBy("day", "phone").agg(F.sum("n").alias("n")),
                      lambda s, ctx: s.select("day", "phone", "n"))
    rows = [("d1", "a", 1), (None, "a", 2), (None, None, 4), ("d2", None, 8), (None, "a", 16), ("d1", "a", 32),
            ("~null", "", 64), ("", "a\n/=", 128)]
    st = KeyedState.for_metric(spark, tmpdir_str, spec, fold_every=2)
    for b in (*range(len(rows)), len(rows) - 1):  # the last batch twice, as after a restart
        st.merge(spec.delta(spark.createDataFrame(rows[b:b + 1], "day string, phone string, n long"), {}), b, T0)
    want = spec.batch(spark.createDataFrame(rows, "day string, phone string, n long"))
    assert sorted(map(repr, spec.result(st.read(), {}).collect())) == sorted(map(repr, want.collect()))


def test_generations(spark, tmpdir_str):
    def opened(query, **kw):
        log = CommitLog(spark, tmpdir_str + "/log")
        log.open(query, **kw)
        return KeyedState(spark, tmpdir_str + "/s", ["k"], {"v": "bigint"}, log=log, fold_every=2)

    def add(st, b, v):
        fold = st.write(spark.createDataFrame([("a", v)], "k string, v long"), b, T0)
        st.log.commit(b, fold, T0, [("t", 0, 10 * v)])

    def value(st):
        return [r.v for r in st.read().collect()]
    first = opened("q1")
    add(first, 0, 1), add(first, 1, 2), add(first, 2, 4)
    with pytest.raises(ValueError, match="fresh checkpoint"):
        opened("q2")
    second = opened("q2", resume=True)
    assert second.log.gen == 1 and value(second) == [7]
    add(second, 0, 8), add(second, 1, 16)
    again = opened("q2")
    assert again.log.gen == 1 and value(again) == [31]
    assert [tuple(r) for r in again.log.positions().collect()] == [("t", 0, 160)]
    third = opened("q3", reset=True)
    add(third, 0, 32)
    add(third, 1, 64)
    assert value(third) == [96] == value(opened("q3"))
    assert [tuple(r) for r in third.log.positions().collect()] == [("t", 0, 640)]
