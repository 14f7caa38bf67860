"""Keyed state of streams as per-batch deltas (SNK1-SNK6, SNK3/STR7, STR3, AGG16).

A batch writes its aggregated delta to a folder of its own,

    <path>/deltas/gen=<g>/batch=<n>/     keys, measures, first_update, last_update

overwritten if the batch is delivered again, and then a row in the commit log

    <log>/gen=<g>/batch=<n>/             query id, fold, since, clock, positions

Reading takes the deltas of committed batches only and adds them up by key, so
a batch counts once however often it ran, and a batch that failed half-way does
not count.  The log's own row is the commit: no marker of the file committer is
needed.  Every ``fold_every``-th batch writes the sums of all before it with its
own delta; reading starts there.  Older folders stay and are not read again.

A *generation* is the life of one query checkpoint, whose batch ids start at 0.

With a ``ttl`` a key group (e.g. a whole day's hash) dies when no row of it is
written for that long, and starts from nothing at its next write.  Writes are
kept as intervals in blocks of half a ttl, whose writes are connected by their
width; the last life of a group begins at its last gap of a ttl or more between
blocks.  Sums, first and last times add up over batches in any order.
"""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

POSITION = "struct<topic:string,partition:int,until_offset:bigint>"
LOG = f"query string, fold boolean, since int, clock timestamp, positions array<{POSITION}>, gen int, batch bigint"
TIMES = {"first_update": F.min, "last_update": F.max}
#: How measures of batches are put together.
COMBINE = {"sum": F.sum, "max": F.max, "or": F.bit_or}


def read_folder(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A Parquet folder, or no rows if nothing was written yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


class CommitLog:
    """One row for each finished batch, written after everything else of the batch."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.gen, self.since, self.query = 0, 0, ""

    def rows(self) -> DataFrame:
        return read_folder(self.spark, self.path, LOG)

    def open(self, query: str, resume: bool = False, reset: bool = False) -> None:
        """Find the generation of a query.  A query that is new to a used log starts a
        further one; this needs ``resume`` (its source goes on where the log ends) or
        ``reset`` (older generations no longer count)."""
        seen = self.rows().groupBy("query").agg(F.max("gen").alias("gen"), F.max("since").alias("since"))
        own = seen.where(F.col("query") == query).first()
        last = seen.agg(F.max("gen").alias("gen"), F.max("since").alias("since")).first()
        self.query = query
        if own is not None:
            self.gen, self.since = own["gen"], own["since"]
        elif last["gen"] is None:
            self.gen = self.since = 0
        elif resume or reset:
            self.gen = last["gen"] + 1
            self.since = self.gen if reset else last["since"]
        else:
            raise ValueError(f"fresh checkpoint, but batches of another one are committed under {self.path}; "
                             "start from its ledger with resume=True, with reset_state=True, or elsewhere")

    def commit(self, batch: int, fold: bool, clock: dt.datetime, positions: Sequence[tuple] = ()) -> None:
        reached = json.dumps([dict(zip(("topic", "partition", "until_offset"), p, strict=True)) for p in positions])
        row = [F.lit(self.query), F.lit(fold), F.lit(self.since), F.lit(clock), F.from_json(F.lit(reached), f"array<{POSITION}>")]
        names = [c.split()[0] for c in LOG.split(", ")]
        # literals, so that no Python worker takes part in a batch's commit
        (self.spark.range(0, 1, 1, 1).select(*[v.alias(n) for v, n in zip(row, names, strict=False)])
         .write.mode("overwrite").parquet(f"{self.path}/gen={self.gen}/batch={batch}"))

    def valid(self, before: int | None = None, after_fold: bool = True) -> DataFrame:
        """Committed batches that count: from the newest fold on, and of this generation
        only those below ``before``."""
        rows = self.rows()
        if before is not None:
            rows = rows.where((F.col("gen") < self.gen) | ((F.col("gen") == self.gen) & (F.col("batch") < before)))
        newest = rows.agg(F.max("since").alias("since"), F.max(F.when(
            F.col("fold"), F.struct("gen", "batch"))).alias("fold")).first()
        since, fold = max(newest["since"] or 0, self.since), newest["fold"]
        rows = rows.where(F.col("gen") >= since)
        if not after_fold or fold is None or fold["gen"] < since:
            return rows
        return rows.where((F.col("gen") > fold["gen"]) | ((F.col("gen") == fold["gen"]) & (F.col("batch") >= fold["batch"])))

    def clock(self) -> dt.datetime | None:
        """Latest clock of a committed batch."""
        t = self.valid(after_fold=False).agg(F.max("clock").cast("string")).first()[0]
        return dt.datetime.fromisoformat(t).replace(tzinfo=dt.timezone.utc) if t else None

    def positions(self) -> DataFrame:
        """topic, partition, until_offset over all batches that count."""
        p = self.valid(after_fold=False).select(F.inline("positions"))
        return p.groupBy("topic", "partition").agg(F.max("until_offset").alias("until_offset"))


class KeyedState:
    """A keyed table of additive measures, folded from deltas when it is read.

    ``measures`` maps column -> SQL type; ``combine`` maps column -> ``sum`` (default),
    ``max`` or ``or`` (bit masks).  ``ttl`` with ``ttl_keys`` (the columns of one expiring group; default all
    keys) enables expiry.  States of one job share its ``log``.
    """

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], measures: dict[str, str],
                 combine: dict[str, str] | None = None, ttl: dt.timedelta | None = None,
                 ttl_keys: Sequence[str] | None = None, fold_every: int = 20, log: CommitLog | None = None,
                 key_types: dict[str, str] | None = None):
        self.spark, self.path = spark, path.rstrip("/")
        self.keys, self.measures, self.combine = list(keys), dict(measures), dict(combine or {})
        self.ttl, self.ttl_keys = ttl, list(ttl_keys) if ttl_keys else list(keys)
        self.fold_every = max(1, fold_every)
        self.log = log or CommitLog(spark, f"{self.path}/commits")
        types = key_types or {}
        cols = [f"`{k}` {types.get(k, 'string')}" for k in self.keys] + [f"`{m}` {t}" for m, t in self.measures.items()]
        if ttl is not None:
            cols.append("_block bigint")
        self.schema = ", ".join([*cols, *(f"{t} timestamp" for t in TIMES)])

    @classmethod
    def for_metric(cls, spark: SparkSession, root: str, spec, **kw) -> KeyedState:
        """State for a :class:`chargepulse.operators.metrics.MetricSpec`."""
        kw.setdefault("key_types", spec.key_types)
        return cls(spark, f"{root.rstrip('/')}/{spec.store}", spec.keys, spec.measures, spec.combine, **kw)

    def _combined(self) -> list:
        return [COMBINE[self.combine.get(m, "sum")](m).cast(t).alias(m) for m, t in self.measures.items()]

    def _sum(self, df: DataFrame) -> DataFrame:
        block = ["_block"] if self.ttl is not None else []
        return df.groupBy(*self.keys, *block).agg(*self._combined(), *[f(t).alias(t) for t, f in TIMES.items()])

    # ------------------------------------------------------------------ read
    def _rows(self, before: int | None = None) -> DataFrame:
        """Sums of the committed batches (by block with a ttl)."""
        deltas = read_folder(self.spark, f"{self.path}/deltas", f"{self.schema}, gen int, batch bigint")
        done = self.log.valid(before).select("gen", "batch")
        return self._sum(deltas.join(done, ["gen", "batch"], "left_semi"))

    def read(self, now: dt.datetime | None = None) -> DataFrame:
        """Keys, measures and last_update of all committed batches.  With a ttl only the
        last life of a group counts, and groups dead at ``now`` (default: the latest
        committed clock) are hidden."""
        rows = self._rows()
        if self.ttl is not None:
            now = now or self.log.clock()
            rows = self.last_life(rows, now) if now else rows
            rows = rows.groupBy(*self.keys).agg(*self._combined(), F.max("last_update").alias("last_update"))
        return rows.select(*self.keys, *self.measures, "last_update")

    def last_life(self, rows: DataFrame, now: dt.datetime) -> DataFrame:
        """Rows of each group's last life, if the group is alive at ``now``."""
        ttl = F.lit(self.ttl)
        group = F.struct(*[F.col(k) for k in self.ttl_keys]) if self.ttl_keys else F.struct(F.lit(0).alias("all"))
        rows = rows.withColumn("_group", group)
        blocks = rows.groupBy("_group", "_block").agg(*[f(t).alias(t) for t, f in TIMES.items()])
        # intervals by block; the latest end so far tells whether a gap comes before the next
        so_far = Window.partitionBy("_group").orderBy("first_update").rowsBetween(Window.unboundedPreceding, -1)
        blocks = blocks.withColumn("_end", F.max("last_update").over(so_far))
        begins = F.when(F.col("_end").isNull() | (F.col("first_update") >= F.col("_end") + ttl), F.col("first_update"))
        lives = blocks.groupBy("_group").agg(F.max(begins).alias("_birth"), F.max("last_update").alias("_last"))
        lives = lives.where(F.col("_last") + ttl > F.lit(_aware(now)).cast("timestamp"))
        on = rows["_group"].eqNullSafe(lives["_group"]) & (rows["first_update"] >= lives["_birth"])
        return rows.join(lives, on, "left_semi").drop("_group")

    # ----------------------------------------------------------------- write
    def write(self, delta: DataFrame, batch_id: int, now: dt.datetime, summed: bool = False,
              whole: bool = False) -> bool:
        """Write the batch's delta, not yet committed; returns whether it holds a fold.
        ``delta`` has keys and measures, any number of rows per key, and may have the
        times of its writes as ``first_update`` and ``last_update``, at most a quarter of
        the ttl apart; else ``now`` is the time of all.  A ``summed`` delta has one row per
        key; a ``whole`` one has the final measures of every key, so it is a fold and no
        older batch is read."""
        at = F.lit(_aware(now)).cast("timestamp")
        times = [F.coalesce(F.col(t), at).alias(t) if t in delta.columns else at.alias(t) for t in TIMES]
        d = delta.select(*self.keys, *[F.col(m).cast(t).alias(m) for m, t in self.measures.items()], *times)
        if self.ttl is not None:
            half = int(self.ttl / dt.timedelta(microseconds=2))
            d = d.withColumn("_block", F.floor(F.unix_micros("first_update") / F.lit(half)).cast("bigint"))
        d = d if summed else self._sum(d)
        fold = whole or (batch_id + 1) % self.fold_every == 0
        if fold and not whole:
            older = self._rows(before=batch_id)
            if self.ttl is not None:
                older = self.last_life(older, now)
            d = self._sum(older.select(*d.columns).unionByName(d))
        names = [c.split()[0].strip("`") for c in self.schema.split(", ")]
        d.select(*names).write.mode("overwrite").parquet(f"{self.path}/deltas/gen={self.log.gen}/batch={batch_id}")
        return fold

    def merge(self, delta: DataFrame, batch_id: int, now: dt.datetime) -> int:
        """Write and commit a batch of a state that has a log of its own."""
        fold = self.write(delta, batch_id, now)
        self.log.commit(batch_id, fold, _aware(now))
        return batch_id


def _aware(t: dt.datetime) -> dt.datetime:
    """Naive clock values are taken as UTC."""
    return t if t.tzinfo is not None else t.replace(tzinfo=dt.timezone.utc)


def utc_now(_batch_id: int | None = None) -> dt.datetime:
    """Default clock for live streams: wall clock at batch start (driver)."""
    return dt.datetime.now(dt.timezone.utc)
