"""Registered queries of the streaming part.

Records are derived from the test tables and written as files under the session's
checkpoint folder, in place of a topic; a stream reads them with triggers bounded in
bytes, so the number of micro-batches follows the data and the trigger, not the table.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import metrics as M
from ..operators.browse import browse_region_stats, browse_stats
from ..operators.parse import parse_topup_json, topup_quarantine
from ..session import scratch_path
from ..sources.catalog import read_json, read_table, save_bucketed
from ..sources.dims import parse_code_dim, parse_ip_ranges
from ..sources.segments import record_segments, segment_stream
from ..sources.streams import record_file_stream, text_stream
from ..streaming.jobs import (BROWSE_SCHEMA, IndicatorJob, WordCountJob, browse_job, offset_tracking_job, order_job,
                              payment_job, topup_job)
from ..streaming.sinks import (append_files, append_table, create_partitioned_table, ledger_from_legacy,
                               ledger_rows, newest_partition, overwrite_insert, starting_offsets,
                               starting_offsets_by_topic)
from . import fixtures as fx

#: Files that make up a trigger, and the size at which the stand-in files are cut.
TRIGGER_BYTES = 64 << 20
ROWS_PER_FILE = 50_000
GROUP_ID = "chargepulse"


def _await(q) -> None:
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))


def _run_records(spark: SparkSession, job: IndicatorJob, records: DataFrame, name: str) -> IndicatorJob:
    """Write topic records as files and let the job read all of them."""
    src = scratch_path(spark, "streams", name)
    records.write.option("maxRecordsPerFile", ROWS_PER_FILE).parquet(src)
    stream = record_file_stream(spark, src, max_bytes_per_trigger=TRIGGER_BYTES)
    _await(job.start(stream, scratch_path(spark, "ckpt", name), trigger={"availableNow": True}))
    return job


def _run_lines(spark: SparkSession, job, lines: DataFrame, name: str, trigger_bytes: int = TRIGGER_BYTES, **kw):
    """Write text lines as files and let the job read all of them."""
    src = scratch_path(spark, "streams", name)
    lines.write.option("maxRecordsPerFile", ROWS_PER_FILE).text(src)
    stream = text_stream(spark, src, max_bytes_per_trigger=trigger_bytes)
    _await(job.start(stream, scratch_path(spark, "ckpt", name), trigger={"availableNow": True}, **kw))
    return job


def _topups(spark: SparkSession, sf_dir: str, metrics, name: str, records=fx.topup_records, **kw) -> IndicatorJob:
    job = topup_job(spark, scratch_path(spark, "state", name), parse_code_dim(fx.city_lines(spark, sf_dir)),
                    metrics=metrics, **kw)
    return _run_records(spark, job, records(spark, sf_dir), name)


# --------------------------------------------------------- indicators, whole jobs

def stream_overview(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The top-up job: all indicators fanned out per micro-batch, offsets committed;
    returns the accumulated daily overview."""
    return _topups(spark, sf_dir, None, "overview", counters=False).result("daily_overview")


def stream_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The order job over a text stream; returns the amount per province."""
    job = order_job(spark, scratch_path(spark, "state", "orders"), parse_ip_ranges(fx.ip_range_lines(spark, sf_dir)))
    return _run_lines(spark, job, fx.order_lines(spark, sf_dir).select("value"), "orders").result("order_by_province")


def stream_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The payment job over a text stream; returns the daily total."""
    job = payment_job(spark, scratch_path(spark, "state", "payments"))
    return _run_lines(spark, job, fx.payment_json(spark, sf_dir).select("value"), "payments").result("daily_payment")


def browse_region_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG13 as a stream: distinct users by region and day, kept as exact bit masks.  Facts
    of odd categories come after a first run, with the same users and days, and a second
    run goes on from the checkpoint."""
    src, ckpt = scratch_path(spark, "streams", "browse"), scratch_path(spark, "ckpt", "browse")
    fact = fx.browse_fact(spark, sf_dir)
    job = browse_job(spark, scratch_path(spark, "state", "browse"), fx.region_dim(spark, sf_dir))
    for odd in (0, 1):
        part = fact.where(F.col("category_id") % 2 == odd).select(F.col("area_code").cast("bigint"), "bdp_day",
                                                                   F.col("user_id").cast("bigint"))
        part.write.mode("append").option("maxRecordsPerFile", ROWS_PER_FILE).parquet(src)
        stream = record_file_stream(spark, src, schema=BROWSE_SCHEMA, max_bytes_per_trigger=TRIGGER_BYTES)
        _await(job.start(stream, ckpt, trigger={"availableNow": True}))
    return job.result("browse_region_users")


# ------------------------------------------------------ single indicators, counters

def _upsert(key: str, name: str):
    spec = M.TOPUP_METRICS[name]

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _topups(spark, sf_dir, [spec], key, counters=False).result(name)
    run.__name__ = key
    return run


#: SNK4-SNK6: one indicator accumulated by a stream.
upsert_failures = _upsert("upsert_failures", "hourly_province_failures")
upsert_province = _upsert("upsert_province", "province_success")
upsert_hour = _upsert("upsert_hour", "hourly_amount")


def counter_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK1/SNK2: the counter layout accumulated by a stream."""
    return _topups(spark, sf_dir, [], "counters", counter_ttl=None).result("counters")


def counter_ttl(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK3/STR7: counters that die 48 h after their last write and start again at the
    next.  Records arrive at once and up to 100 hours late, so a day's counters are written
    again after less and after more than 48 hours; the clock is the latest arrival."""
    job = _topups(spark, sf_dir, [], "expiring", records=fx.late_topup_records, counter_ttl=dt.timedelta(hours=48))
    return job.result("counters")


# ------------------------------------------------------------------ ledger

def _ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    job = offset_tracking_job(spark, scratch_path(spark, "state", "ledger"))
    return _run_records(spark, job, fx.topic_records(spark, sf_dir), "ledger").ledger_table()


def offset_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK10: until-offset per topic partition, as committed by a stream."""
    return ledger_rows(_ledger(spark, sf_dir), GROUP_ID).drop("tp_key")


def offset_restore(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK11 + FN11: legacy ``topic-partition`` entries -> startingOffsets."""
    legacy = ledger_rows(_ledger(spark, sf_dir), GROUP_ID).select("tp_key", "until_offset")
    return starting_offsets_by_topic(ledger_from_legacy(legacy))


def ledger_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC1 + SNK11 + STR4: the top-up job reads recorded segments of a topic, stops, and
    goes on under a fresh checkpoint from the offsets of its ledger, when the topic has
    more segments and a partition more.  Returns the daily overview: nothing lost or
    counted twice."""
    topic, state = scratch_path(spark, "topics", "topup"), scratch_path(spark, "state", "resumed")
    records = fx.topup_records(spark, sf_dir).drop("ts")
    middle = records.agg(F.floor(F.max("offset") / 2)).first()[0] or 0
    last = F.col("partition") == 3
    job = topup_job(spark, state, parse_code_dim(fx.city_lines(spark, sf_dir)), counters=False)
    for run, part in enumerate((~last & (F.col("offset") <= middle), last | (F.col("offset") > middle))):
        record_segments(records.where(part), topic, ROWS_PER_FILE)
        start = "earliest" if run == 0 else starting_offsets(spark, job.ledger_table(), "topup")
        stream = segment_stream(spark, topic, start)
        _await(job.start(stream, scratch_path(spark, "ckpt", f"resumed-{run}"), trigger={"availableNow": True},
                         resume=run > 0))
    return job.result("daily_overview")


# -------------------------------------------------------------- word count

def _word_count(spark: SparkSession, sf_dir: str, output_mode: str) -> DataFrame:
    """A trigger writes all words it meets (in complete mode: all words so far) and makes a
    version of each state partition, so it is bounded by bytes for each core, not in all."""
    job = WordCountJob(spark, scratch_path(spark, "state", "words"))
    size = TRIGGER_BYTES * spark.sparkContext.defaultParallelism
    return _run_lines(spark, job, fx.text_lines(spark, sf_dir), "words", size, output_mode=output_mode).result()


def word_count_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC3/SRC9 stand-in (text files replayed), PRJ10, AGG14 in Spark's state store,
    update mode into a keyed table."""
    return _word_count(spark, sf_dir, "update")


def word_count_complete(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR5: word count in complete mode, each trigger giving the whole table."""
    return _word_count(spark, sf_dir, "complete")


def quarantine_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR6: malformed top-ups appended to files by a stream in append mode, whose sink
    has a commit log of its own.  More records come after the first run, and a second
    run goes on from the checkpoint; every malformed record is there once."""
    src, out = scratch_path(spark, "streams", "damaged"), scratch_path(spark, "quarantine", "topup")
    ckpt = scratch_path(spark, "ckpt", "quarantine")
    records = fx.damaged_topup_json(spark, sf_dir)
    late = F.pmod(F.xxhash64("value"), F.lit(2)) == 1
    for part in (~late, late):
        records.where(part).write.mode("append").option("maxRecordsPerFile", ROWS_PER_FILE).text(src)
        bad = topup_quarantine(parse_topup_json(text_stream(spark, src, max_bytes_per_trigger=TRIGGER_BYTES)))
        bad = bad.select("request_id", "result_code", "province_code")
        _await(append_files(bad, out, ckpt, {"availableNow": True}))
    return spark.read.parquet(out)


# ------------------------------------------------------------ file sinks

def json_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC6 + SNK7: payments written as JSON lines, read back once with the fields'
    schema, appended twice to a table (rows doubled)."""
    src = scratch_path(spark, "json", "payments")
    fx.payment_json(spark, sf_dir).write.text(src)
    df = read_json(spark, src, "date string, money string, phoneNum string").persist()
    name = "payments_" + src.rsplit("/", 1)[-1]
    path = scratch_path(spark, "tables", name, unique=False)
    try:
        append_table(df, name, path)
        append_table(df, name, path)
    finally:
        df.unpersist()
    return spark.table(name)


def _mart(spark: SparkSession, name: str, stats: DataFrame) -> str:
    """An empty table like ``stats``, partitioned by day."""
    path = scratch_path(spark, "tables", name)
    table = f"{name}_{path.rsplit('/', 1)[-1]}"
    create_partitioned_table(stats, table, ["bdp_day"], path)
    return table


def catalog_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK8: browse stats inserted into a table partitioned by day, then the newest day
    computed from its own records and overwritten; the other days are kept."""
    stats = browse_stats(fx.browse_fact(spark, sf_dir))
    mart = _mart(spark, "views_by_device", stats)
    overwrite_insert(stats, mart)
    newest = newest_partition(spark, mart)
    if newest is not None:
        overwrite_insert(browse_stats(fx.browse_fact(spark, sf_dir, day=newest)), mart, tasks=1)
    return read_table(spark, mart)


def catalog_overwrite_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC7 + JN4 + AGG13 + SNK8: the second mart.  Both large tables are saved in the
    catalog by buckets of the order key, read from there and joined without a shuffle;
    users and views by region go into a table partitioned by day."""
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    tables = {}
    for name, key, cols in (("lineitem", "l_orderkey", ["l_orderkey", "l_suppkey", "l_linenumber", "l_returnflag",
                                                        "l_linestatus", "l_shipdate"]),
                            ("orders", "o_orderkey", ["o_orderkey", "o_custkey"])):
        path = scratch_path(spark, "tables", name)
        tables[name] = f"{name}_{path.rsplit('/', 1)[-1]}"
        save_bucketed(fx.table(spark, sf_dir, name).select(*cols), tables[name], key, buckets, path)
    fact = fx.browse_fact(spark, sf_dir, *(read_table(spark, tables[n]) for n in ("lineitem", "orders")))
    stats = browse_region_stats(fact, fx.region_dim(spark, sf_dir))
    mart = _mart(spark, "views_by_region", stats)
    overwrite_insert(stats, mart)
    return read_table(spark, mart)
