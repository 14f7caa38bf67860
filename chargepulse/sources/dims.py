"""Dimension text files (SRC4, SRC5).

Both readers are ``spark.read.text`` + ``split`` + ``get``; the parse
functions also accept any DataFrame with a ``value`` column so a dimension
can come from a table instead of a file.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.ip import with_ip_num


def judge_code_lines(lines: DataFrame, value_col: str = "value", order_col: str | None = None) -> DataFrame:
    """``code name`` lines -> ``value, code, name, reason``: why a line is not used, or
    NULL.  ``malformed``: no code or no name.  ``replaced``: a later line (by
    ``order_col``) has the same code.  Without an order, lines that give one code
    different names are all ``ambiguous``; equal lines count as one, the others are
    ``replaced``."""
    parts = F.split(F.col(value_col), " ")
    code, name = F.get(parts, 0), F.get(parts, 1)
    order = F.col(order_col) if order_col else F.lit(0)
    d = lines.select(F.col(value_col).alias("value"), code.alias("code"), name.alias("name"), order.alias("_ord"))
    good = F.coalesce((F.col("code") != "") & (F.col("name") != ""), F.lit(False))
    of_code = Window.partitionBy("_key")
    d = d.withColumn("_key", F.when(good, F.col("code")))
    # lines without a code or a name share no group
    d = d.withColumn("_key", F.struct("_key", F.when(F.col("_key").isNull(), F.xxhash64("value", "_ord", F.rand(7)))))
    several = F.min("name").over(of_code) != F.max("name").over(of_code)
    later = F.row_number().over(of_code.orderBy(F.desc("_ord"), F.desc("name"))) > 1
    reason = F.when(~good, "malformed")
    if not order_col:
        reason = reason.when(several, "ambiguous")
    return d.withColumn("reason", reason.when(later, "replaced")).select("value", "code", "name", "reason")


def parse_code_dim(lines: DataFrame, value_col: str = "value",
                   order_col: str | None = None) -> DataFrame:
    """``code name`` lines (single-space separated) -> ``(code, name)`` unique on
    ``code``: the lines that :func:`judge_code_lines` finds nothing against."""
    return judge_code_lines(lines, value_col, order_col).where("reason IS NULL").select("code", "name")


def read_code_dim(spark: SparkSession, path: str) -> DataFrame:
    """Read a ``code name`` text file.  File position is taken from
    ``monotonically_increasing_id`` at read time, which follows line order
    within a file split (dimension files of this kind are one split)."""
    lines = spark.read.text(path).withColumn("_pos", F.monotonically_increasing_id())
    return parse_code_dim(lines, order_col="_pos")


def judge_ip_lines(lines: DataFrame, value_col: str = "value", start_field: int = 0, end_field: int = 1,
                   value_field: int = 6) -> DataFrame:
    """Pipe-delimited IP range lines -> ``value, start_ip, end_ip, province, start_num,
    end_num, reason``: ``short`` (fewer fields), ``bad start`` (no address) or NULL."""
    parts = F.split(F.col(value_col), r"\|")
    start, end, val = (F.get(parts, start_field), F.get(parts, end_field),
                       F.get(parts, value_field))
    d = (lines.select(F.col(value_col).alias("value"), start.alias("start_ip"), end.alias("end_ip"), val.alias("province"))
         .transform(lambda d: with_ip_num(d, "start_ip", "start_num"))
         .transform(lambda d: with_ip_num(d, "end_ip", "end_num")))
    return d.withColumn("reason", F.when(F.col("province").isNull(), "short").when(F.col("start_num").isNull(), "bad start"))


def parse_ip_ranges(lines: DataFrame, value_col: str = "value",
                    start_field: int = 0, end_field: int = 1,
                    value_field: int = 6) -> DataFrame:
    """Pipe-delimited IP range lines -> ``start_ip, end_ip, province,
    start_num, end_num`` (numbers NULL when the address is malformed).
    Field 0 is the start address, field 1 the end address, field 6 the
    province; shorter lines are left out (:func:`judge_ip_lines` gives them)."""
    return (judge_ip_lines(lines, value_col, start_field, end_field, value_field)
            .where(F.col("province").isNotNull()).drop("value", "reason"))


def read_ip_ranges(spark: SparkSession, path: str) -> DataFrame:
    return parse_ip_ranges(spark.read.text(path))
