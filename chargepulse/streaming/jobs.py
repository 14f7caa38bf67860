"""Streaming jobs: one ``foreachBatch`` handler fans a micro-batch out to
several indicator states (SNK12), then commits it with its offsets (SNK10).

The query checkpoint delivers an unfinished micro-batch again with the same id
and data (STR3/STR4); its deltas are overwritten and count once it is in the
commit log (:mod:`.state`).  A batch is parsed once and kept while the
indicators and the quarantine read it; the offsets it reaches are observed
while it is parsed, so nothing is scanned for them.
"""

from __future__ import annotations

import datetime as dt
import threading
from collections.abc import Callable, Sequence

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import metrics as M
from ..operators.parse import parse_order_lines, parse_payment_json, parse_topup_json, topup_kpi_base, topup_quarantine
from .state import CommitLog, KeyedState, read_folder, utc_now

Clock = Callable[[int], dt.datetime]

COUNTER_TTL = dt.timedelta(hours=48)
POSITION_COLS = {"topic", "partition", "offset"}
#: Partitions of the first topic of a batch whose offsets are observed one by one.
OBSERVED_PARTITIONS = 64


class StreamJob:
    """A query whose batches are handled under a commit log."""

    def __init__(self, spark: SparkSession, state_root: str, clock: Clock = utc_now):
        self.spark = spark
        self.state_root = state_root.rstrip("/")
        self.clock = clock
        self.log = CommitLog(spark, f"{self.state_root}/commits")
        self.batches_seen: list[int] = []
        self._open = threading.Event()
        self._refused = False

    def open(self, query_id: str, resume: bool = False, reset_state: bool = False) -> None:
        """Take up the generation of a query; batches wait for it."""
        self.log.open(query_id, resume, reset_state)
        self._open.set()

    def _run(self, batch: DataFrame, batch_id: int) -> None:
        if not self._open.wait(600) or self._refused:
            raise RuntimeError("the query's generation is not open")
        self.handle(batch, batch_id)
        self.batches_seen.append(batch_id)

    def handle(self, batch: DataFrame, batch_id: int) -> None:
        raise NotImplementedError

    def _start(self, writer, checkpoint: str, trigger: dict | None, query_name: str | None, resume: bool,
               reset_state: bool) -> StreamingQuery:
        self._open.clear()
        self._refused = False
        w = writer.foreachBatch(self._run).option("checkpointLocation", checkpoint)
        if query_name:
            w = w.queryName(query_name)
        q = w.trigger(**(trigger or {"processingTime": "1 second"})).start()
        try:
            self.open(str(q.id), resume, reset_state)
        except ValueError:
            self._refused = True
            self._open.set()
            try:
                q.stop()
            except StreamingQueryException:  # the batch that waited for the generation
                pass
            raise
        return q


class IndicatorJob(StreamJob):
    """Accumulate a set of :class:`MetricSpec` over micro-batches.

    ``parse`` turns the raw batch (``value`` column, optionally topic positions and a
    ``timestamp`` of arrival) into parsed rows that keep the columns named to it;
    ``base`` and ``quarantine`` select from them.  ``ctx`` carries dimensions.  ``ttl``
    maps a metric name to ``(timedelta, group key columns)`` for expiring metrics.
    """

    def __init__(self, spark: SparkSession, state_root: str, parse: Callable[..., DataFrame],
                 metrics: Sequence[M.MetricSpec], base: Callable[[DataFrame], DataFrame] = lambda parsed: parsed,
                 quarantine: Callable[[DataFrame], DataFrame] | None = None, ctx: dict | None = None,
                 clock: Clock = utc_now, ttl: dict[str, tuple[dt.timedelta, Sequence[str]]] | None = None,
                 ledger: bool = True, fold_every: int = 20):
        super().__init__(spark, state_root, clock)
        self.parse, self.base, self.quarantine = parse, base, quarantine
        self.metrics = list(metrics)
        self.ctx = dict(ctx or {})
        self.ledger = ledger
        self.fold_every = fold_every
        self.states: dict[str, KeyedState] = {}
        for spec in self.metrics:
            if spec.store not in self.states:
                t = (ttl or {}).get(spec.name)
                self.states[spec.store] = KeyedState.for_metric(
                    spark, self.state_root, spec, ttl=t[0] if t else None, ttl_keys=t[1] if t else None,
                    fold_every=fold_every, log=self.log)

    # -------------------------------------------------------------- handler
    def handle(self, batch: DataFrame, batch_id: int) -> None:
        """The ``foreachBatch`` function: parse once, write every indicator's delta and
        the quarantine from driver threads (independent Spark jobs), then commit."""
        now = self.clock(batch_id)
        keep = [c for c in ("topic", "partition", "offset", "timestamp") if c in batch.columns]
        seen = Observation(f"batch-{batch_id}")
        parsed = self.parse(batch, keep=keep).observe(seen, *_observed(keep)).persist()
        try:
            base = self.base(parsed)
            first = {spec.store: spec for spec in reversed(self.metrics)}
            work = [(lambda st=self.states[store], spec=spec: st.write(spec.delta(base, self.ctx), batch_id, now))
                    for store, spec in first.items()]
            if self.quarantine is not None:
                work.append(lambda: self._write_quarantine(parsed, batch_id))
            if not work:
                work.append(lambda: parsed.write.format("noop").mode("overwrite").save())
            run_concurrently(work)
            found = seen.get
            positions = _positions(found, parsed) if self.ledger and POSITION_COLS <= set(keep) else []
            clock = found.get("timestamp") or now
            self.log.commit(batch_id, (batch_id + 1) % self.fold_every == 0, clock, positions)
        finally:
            parsed.unpersist()

    def _write_quarantine(self, parsed: DataFrame, batch_id: int) -> None:
        """Malformed records of this batch, kept for inspection; overwritten
        if the batch is delivered again."""
        bad = self.quarantine(parsed)
        self._bad_schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in bad.schema)
        bad.write.mode("overwrite").parquet(f"{self.state_root}/quarantine/gen={self.log.gen}/batch={batch_id}")

    def quarantined(self) -> DataFrame:
        """Quarantined records of all committed batches (``batch`` column included)."""
        schema = getattr(self, "_bad_schema", None)
        path = f"{self.state_root}/quarantine"
        rows = read_folder(self.spark, path, f"{schema}, gen int, batch bigint") if schema else self.spark.read.parquet(path)
        return rows.join(self.log.valid(after_fold=False).select("gen", "batch"), ["gen", "batch"], "left_semi")

    def start(self, source: DataFrame, checkpoint: str, trigger: dict | None = None, query_name: str | None = None,
              resume: bool = False, reset_state: bool = False) -> StreamingQuery:
        """Start the stream.  ``trigger`` e.g. ``{"processingTime": "1 second"}``
        (STR1) or ``{"availableNow": True}`` for a bounded catch-up run.

        A fresh checkpoint on a used state raises, as its batches could count twice,
        unless the source starts where the ledger ends (``resume``) or the state starts
        anew (``reset_state``).
        """
        return self._start(source.writeStream, checkpoint, trigger, query_name, resume, reset_state)

    # ----------------------------------------------------------------- read
    def result(self, name: str, now: dt.datetime | None = None) -> DataFrame:
        """Published rows of one indicator.  Of an expiring state, groups not written
        for its ttl at ``now`` (default: the latest committed clock) are hidden."""
        spec = next(s for s in self.metrics if s.name == name)
        return spec.result(self.states[spec.store].read(now=now).drop("last_update"), self.ctx)

    def ledger_table(self) -> DataFrame:
        """topic, partition, until_offset of the committed batches."""
        return self.log.positions()


def _observed(keep: Sequence[str]) -> list:
    """What is observed of a batch: rows, time of the latest record, and offsets by partition."""
    cols = [F.count(F.lit(1)).alias("rows")]
    if "timestamp" in keep:
        cols.append(F.max("timestamp").alias("timestamp"))
    if POSITION_COLS <= set(keep):
        cols += [F.min("topic").alias("topic"), F.max("topic").alias("last_topic"), F.max("partition").alias("last"),
                 *[F.max(F.when(F.col("partition") == p, F.col("offset"))).alias(f"offset_{p}")
                   for p in range(OBSERVED_PARTITIONS)]]
    return cols


def _positions(found: dict, parsed: DataFrame) -> list[tuple]:
    """(topic, partition, until_offset) of a batch.  More topics or partitions than are
    observed are counted from the kept rows."""
    if not found["rows"]:
        return []
    if found["topic"] == found["last_topic"] and found["last"] < OBSERVED_PARTITIONS:
        return [(found["topic"], p, found[f"offset_{p}"] + 1) for p in range(OBSERVED_PARTITIONS)
                if found[f"offset_{p}"] is not None]
    return [tuple(r) for r in M.OFFSET_LEDGER.delta(parsed, {}).collect()]  # one row a partition


def run_concurrently(tasks: Sequence[Callable[[], object]], max_workers: int = 8) -> list:
    """Run independent Spark actions from a small driver thread pool and
    re-raise the first failure after all have finished."""
    if len(tasks) <= 1:
        return [t() for t in tasks]
    from concurrent.futures import ThreadPoolExecutor

    with ThreadPoolExecutor(max_workers=min(max_workers, len(tasks))) as pool:
        futures = [pool.submit(t) for t in tasks]
        errors = [f.exception() for f in futures]
    for e in errors:
        if e is not None:
            raise e
    return [f.result() for f in futures]


# ---------------------------------------------------------------- factories

def topup_job(spark: SparkSession, state_root: str, city_dim: DataFrame,
              metrics: Sequence[M.MetricSpec] | None = None, counters: bool = True,
              counter_ttl: dt.timedelta | None = COUNTER_TTL, clock: Clock = utc_now,
              **kw) -> IndicatorJob:
    """Top-up notifications: the five indicators plus the counter layout
    whose day groups (``A-<day>``, ``B-<day>``) expire 48 h after their last
    write.  The city dimension is cached for the job's lifetime."""
    dim = city_dim.persist()
    specs = list(metrics if metrics is not None else M.TOPUP_METRICS.values())
    ttl = {}
    if counters:
        specs.append(M.COUNTERS)
        if counter_ttl is not None:
            ttl[M.COUNTERS.name] = (counter_ttl, ("key",))
    kw.setdefault("quarantine", topup_quarantine)
    return IndicatorJob(spark, state_root, parse_topup_json, specs, base=topup_kpi_base,
                        ctx={"city_dim": dim}, clock=clock, ttl=ttl, **kw)


def _ok(parsed: DataFrame) -> DataFrame:
    return parsed.where("ok")


def _not_ok(parsed: DataFrame) -> DataFrame:
    return parsed.where(~F.col("ok"))


def order_job(spark: SparkSession, state_root: str, ip_ranges: DataFrame,
              clock: Clock = utc_now, **kw) -> IndicatorJob:
    """Order lines: total, per category, per province by IP range.  The
    parsed range list is read once and kept for the job's lifetime."""
    ranges = ip_ranges.select("start_num", "province").persist()
    kw.setdefault("quarantine", _not_ok)
    return IndicatorJob(spark, state_root, parse_order_lines, list(M.ORDER_METRICS.values()), base=_ok,
                        ctx={"ip_ranges": ranges}, clock=clock, **kw)


def payment_job(spark: SparkSession, state_root: str, clock: Clock = utc_now,
                **kw) -> IndicatorJob:
    """Payments: daily total, monthly sum and average per phone."""
    kw.setdefault("quarantine", _not_ok)
    return IndicatorJob(spark, state_root, parse_payment_json, list(M.PAYMENT_METRICS.values()), base=_ok,
                        clock=clock, **kw)


BROWSE_SCHEMA = "area_code bigint, bdp_day string, user_id bigint"


def _browse_rows(facts: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    return facts.select("area_code", "bdp_day", "user_id", *keep)


def browse_job(spark: SparkSession, state_root: str, region: DataFrame, clock: Clock = utc_now,
               **kw) -> IndicatorJob:
    """Browse facts: views and exact distinct users by region and day, as they arrive.
    The region dimension is joined when a result is read."""
    return IndicatorJob(spark, state_root, _browse_rows, [M.BROWSE_REGION_USERS], ctx={"region": region},
                        clock=clock, **kw)


# ---------------------------------------------------------------- word count

class WordCountJob(StreamJob):
    """Structured Streaming word count (PRJ10, AGG14, STR5/STR6).

    Spark's own state store keeps the running counts; each trigger's changed
    rows (``update`` mode) or the whole table (``complete`` mode) carry
    absolute counts, folded with ``max`` as counts only grow.  A whole table
    stands for all before it, so reading takes the newest one alone.
    """

    def __init__(self, spark: SparkSession, state_root: str, clock: Clock = utc_now, fold_every: int = 20):
        super().__init__(spark, f"{state_root.rstrip('/')}/word_count", clock)
        self.fold_every = fold_every
        self.whole = False
        self.state = KeyedState(spark, f"{self.state_root}/table", ["value"], {"count": "bigint"},
                                combine={"count": "max"}, fold_every=fold_every, log=self.log)

    @staticmethod
    def counts(lines: DataFrame) -> DataFrame:
        return M.tokens(lines).groupBy("value").agg(F.count(F.lit(1)).alias("count"))

    def handle(self, batch: DataFrame, batch_id: int) -> None:
        now = self.clock(batch_id)
        self.log.commit(batch_id, self.state.write(batch, batch_id, now, summed=True, whole=self.whole), now)

    def start(self, lines: DataFrame, checkpoint: str, output_mode: str = "update", trigger: dict | None = None,
              reset_state: bool = False) -> StreamingQuery:
        """Start the stream.  A new checkpoint takes its number of state store partitions
        from ``spark.sql.shuffle.partitions`` of the session that read ``lines``."""
        self.whole = output_mode == "complete"
        return self._start(self.counts(lines).writeStream.outputMode(output_mode), checkpoint, trigger, None, False,
                           reset_state)

    def result(self) -> DataFrame:
        return self.state.read().select("value", "count")


# ---------------------------------------------------------------- offsets only

def offset_tracking_job(spark: SparkSession, state_root: str, clock: Clock = utc_now,
                        show_rows: int = 0, **kw) -> IndicatorJob:
    """Consume a topic, optionally print the first ``show_rows`` values of
    each batch (SNK9, bounded), and record the offset ledger (SNK10)."""

    def parse(records: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        if show_rows:
            records.select("value").show(show_rows, truncate=False)
        return records.select(*keep)

    return IndicatorJob(spark, state_root, parse, [], clock=clock, ledger=True, **kw)
