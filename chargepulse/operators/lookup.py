"""Dimension lookups (JN1-JN3).

* :func:`code_name_lookup` -- code -> name with fallback to the code (JN1, FN10).
* :func:`floor_range_join` -- IP -> the range with the greatest start <= IP
  (JN2), as an equi-join on a 16-bit IP bucket plus a range residual, so it
  plans as a hash join instead of a nested-loop join.
* :func:`containment_join` -- IP within ``[lo, hi]`` (JN3), same technique.

Whether a side is broadcast is left to the planner's byte threshold and to
adaptive execution, which also splits skewed buckets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MAX_IPV4 = (1 << 32) - 1


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


# --------------------------------------------------------------------------
# JN1: code -> name with fallback
# --------------------------------------------------------------------------

def code_name_lookup(fact: DataFrame, dim: DataFrame, code_col: str,
                     out_col: str = "city", dim_code: str = "code",
                     dim_name: str = "name") -> DataFrame:
    """Left join ``fact`` to a code->name dimension; unmatched codes keep the
    code itself as the name (``coalesce(name, code)``).

    ``dim`` must be unique on ``dim_code`` (see
    :func:`chargepulse.sources.dims.parse_code_dim`).
    """
    d = dim.select(F.col(dim_code).alias("_dim_code"), F.col(dim_name).alias("_dim_name"))
    joined = fact.join(d, fact[code_col] == d["_dim_code"], "left")
    return (joined.withColumn(out_col, F.coalesce(F.col("_dim_name"), F.col(code_col)))
            .drop("_dim_code", "_dim_name"))


# --------------------------------------------------------------------------
# Range lookups on IPv4 numbers
# --------------------------------------------------------------------------

def with_next_start(df: DataFrame, lo_col: str = "lo") -> DataFrame:
    """Add ``next_lo`` (the next larger-or-equal ``lo`` in sort order, NULL for
    the last) and ``is_first`` (no smaller ``lo``) without a global sort.

    ``lead`` runs inside 16-bit blocks of ``lo`` (a block holds at most 65,536
    distinct starts); the last row of a block takes the first ``lo`` of the
    next non-empty block from a block summary with at most 65,536 rows (one
    ordered task over a bounded table).  If ``df`` already has ``_blk`` and
    is partitioned by it, no further shuffle is added for the block steps.
    ``lo`` must lie in ``[0, 2^32)``.
    """
    r = df
    if "_blk" not in r.columns:
        r = r.withColumn("_blk", F.shiftright(F.col(lo_col), 16)).repartition("_blk")
    in_blk = Window.partitionBy("_blk").orderBy(lo_col)
    r = (r.withColumn("_next_in_blk", F.lead(lo_col).over(in_blk))
         .withColumn("_first_in_blk", F.row_number().over(in_blk) == 1))
    blocks = r.groupBy("_blk").agg(F.min(lo_col).alias("_blk_first"))
    across = Window.orderBy("_blk")
    blocks = blocks.select(
        "_blk",
        F.lead("_blk_first").over(across).alias("_next_blk_first"),
        F.lag("_blk").over(across).isNull().alias("_first_blk"),
    )
    r = r.join(F.broadcast(blocks), "_blk")
    return (r.withColumn("next_lo", F.coalesce(F.col("_next_in_blk"), F.col("_next_blk_first")))
            .withColumn("is_first", F.col("_first_blk") & F.col("_first_in_blk"))
            .drop("_blk", "_next_in_blk", "_first_in_blk", "_next_blk_first", "_first_blk"))


def floor_ranges(ranges: DataFrame, start_col: str = "start_num",
                 value_col: str = "province", below_first: str = "clamp") -> DataFrame:
    """Start-only ranges -> disjoint ``[lo, hi]`` intervals covering
    ``[first start, 2^32)``; with ``below_first='clamp'`` the first interval
    also covers ``[0, first start)`` (an address below every start maps to
    the first range, as the original search did), with ``'null'`` it does not.

    Equal starts are resolved deterministically (smallest value wins).  One
    shuffle (by 16-bit block) serves the de-duplication and the block-local
    ordering.
    """
    if below_first not in ("clamp", "null"):
        raise ValueError("below_first must be 'clamp' or 'null'")
    # start numbers come from ip_to_long, so they are NULL or in [0, 2^32)
    r = (ranges.where(F.col(start_col).isNotNull())
         .select(F.col(start_col).alias("lo"), F.col(value_col).alias("value"))
         .withColumn("_blk", F.shiftright("lo", 16)).repartition("_blk")
         .groupBy("_blk", "lo").agg(F.min("value").alias("value")))
    r = with_next_start(r, "lo")
    hi = F.coalesce(F.col("next_lo") - 1, F.lit(MAX_IPV4).cast("bigint"))
    lo = F.col("lo")
    if below_first == "clamp":
        lo = F.when(F.col("is_first"), F.lit(0).cast("bigint")).otherwise(lo)
    return r.select(lo.alias("lo"), hi.alias("hi"), F.col("lo").alias("range_start"),
                    F.col("value"))


def bucket_ranges(intervals: DataFrame, bits: int = 16) -> DataFrame:
    """Explode each ``[lo, hi]`` interval into the ``bits``-bit buckets it
    touches.  For disjoint intervals the result has at most
    ``n + 2^(32-bits)`` rows, which bounds what gets broadcast."""
    return intervals.withColumn(
        "bucket", F.explode(F.sequence(F.shiftright("lo", bits), F.shiftright("hi", bits))))


def _bucket_join(fact: DataFrame, ip_col: str, bucketed: DataFrame, out_col: str,
                 bits: int) -> DataFrame:
    b = bucketed.select("bucket", F.col("lo").alias("_lo"), F.col("hi").alias("_hi"),
                        F.col("value").alias("_val"))
    f = fact.withColumn("_ipb", F.shiftright(F.col(ip_col), bits))
    cond = (f["_ipb"] == b["bucket"]) & f[ip_col].between(b["_lo"], b["_hi"])
    return (f.join(b, cond, "left")
            .withColumnRenamed("_val", out_col)
            .drop("_ipb", "bucket", "_lo", "_hi"))


def floor_range_join(fact: DataFrame, ip_col: str, ranges: DataFrame,
                     start_col: str = "start_num", value_col: str = "province",
                     out_col: str = "province", below_first: str = "clamp",
                     bits: int = 16) -> DataFrame:
    """JN2: attach to each fact row the value of the range with the greatest
    start <= ``ip_col``; the last range is open-ended.  Facts with a NULL
    address get NULL.  Output has exactly one row per fact row.

    An equi-join on the bucket; a skewed bucket is split by AQE.
    """
    iv = bucket_ranges(floor_ranges(ranges, start_col, value_col, below_first), bits)
    return _bucket_join(fact, ip_col, iv, out_col, bits)


def floor_lookup(sums: DataFrame, ip_col: str, ranges: DataFrame, start_col: str = "start_num",
                 value_col: str = "province", out_col: str = "province", below_first: str = "clamp") -> DataFrame:
    """JN2 for rows that were summed by address: addresses and range starts are put in
    order together within 16-bit blocks, and an address takes the last start before it.  A
    block begins with the last start of the blocks before it, from a list of at most 65,536
    blocks.  No range is repeated, and a block holds at most 65,536 addresses and as many
    starts, however many records there were.  Same edges as :func:`floor_range_join`."""
    if below_first not in ("clamp", "null"):
        raise ValueError("below_first must be 'clamp' or 'null'")
    starts = (ranges.where(F.col(start_col).isNotNull()).groupBy(F.col(start_col).cast("bigint").alias("_num"))
              .agg(F.struct(F.min(value_col).alias("v")).alias("_start")))
    kind = starts.schema["_start"].dataType
    both = (sums.withColumn("_num", F.col(ip_col).cast("bigint")).withColumn("_start", F.lit(None).cast(kind))
            .withColumn("_fact", F.lit(True))
            .unionByName(starts.withColumn("_fact", F.lit(False)), allowMissingColumns=True)
            .withColumn("_blk", F.shiftright("_num", 16)))
    inside = Window.partitionBy("_blk").orderBy("_num", "_fact").rowsBetween(Window.unboundedPreceding, 0)
    both = both.withColumn("_found", F.last("_start", ignorenulls=True).over(inside))
    blocks = both.where(F.col("_blk").isNotNull()).groupBy("_blk").agg(
        F.max_by("_start", F.when(F.col("_start").isNotNull(), F.col("_num"))).alias("_last"),
        F.min_by("_start", F.when(F.col("_start").isNotNull(), F.col("_num"))).alias("_first"))
    in_order = Window.orderBy("_blk")
    blocks = blocks.select(
        "_blk", F.last("_last", ignorenulls=True).over(in_order.rowsBetween(Window.unboundedPreceding, -1)).alias("_before"),
        F.first("_first", ignorenulls=True).over(
            in_order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("_first"))
    blocks = blocks.withColumnRenamed("_blk", "_of")
    # at most 65,536 rows
    found = both.where("_fact").join(F.broadcast(blocks), F.col("_blk") == F.col("_of"), "left")
    at = F.coalesce("_found", "_before", *(["_first"] if below_first == "clamp" else []))
    return (found.withColumn(out_col, at["v"])
            .drop("_num", "_start", "_fact", "_blk", "_found", "_of", "_before", "_first"))


def containment_join(fact: DataFrame, ip_col: str, ranges: DataFrame,
                     lo_col: str = "start_num", hi_col: str = "end_num",
                     value_col: str = "province", out_col: str = "province",
                     bits: int = 16) -> DataFrame:
    """JN3: value of the closed interval ``[lo, hi]`` containing the address,
    NULL when none does.  Overlapping intervals are rejected, as a fact row
    could match twice (one job over the intervals, see
    :func:`overlapping_ranges`)."""
    bad = overlapping_ranges(ranges, lo_col, hi_col).limit(3).collect()
    if bad:
        raise ValueError(f"overlapping ranges, e.g. {bad}")
    iv = (ranges.where(F.col(lo_col).isNotNull() & F.col(hi_col).isNotNull()
                       & (F.col(lo_col) <= F.col(hi_col)))
          .select(F.col(lo_col).alias("lo"), F.col(hi_col).alias("hi"),
                  F.col(value_col).alias("value")))
    return _bucket_join(fact, ip_col, bucket_ranges(iv, bits), out_col, bits)


def overlapping_ranges(ranges: DataFrame, lo_col: str = "start_num",
                       hi_col: str = "end_num") -> DataFrame:
    """Intervals that overlap their successor in start order (empty when all
    intervals are disjoint).  Sorted by ``lo``, intervals are disjoint iff
    every ``hi`` is below the next ``lo``, so one neighbour comparison per
    interval suffices -- no pairwise comparison."""
    iv = (ranges.select(F.col(lo_col).alias("lo"), F.col(hi_col).alias("hi"))
          .where(F.col("lo").between(0, MAX_IPV4) & (F.col("lo") <= F.col("hi"))))
    return (with_next_start(iv, "lo").where(F.col("hi") >= F.col("next_lo"))
            .select("lo", "hi", "next_lo"))
