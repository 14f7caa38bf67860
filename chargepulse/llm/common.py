"""Helpers shared by the training-data operators."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    """The named columns of a Parquet table; other columns are never read."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*cols)


def stored(df: DataFrame, what: str) -> DataFrame:
    """``df`` written as Parquet in the shared folder and read back: later steps
    neither recompute it nor lose it with an executor."""
    spark = df.sparkSession
    path = scratch_path(spark, "llm", what)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, name: str) -> str:
    """``name``, or a variant of it that is no column of ``df``."""
    have = {c.lower() for c in df.columns}
    while name.lower() in have:
        name = f"{name}_{uuid.uuid4().hex[:6]}"
    return name


def ascii_lower(c: Column) -> Column:
    """A-Z to a-z; every other character stays."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def batches_of(df: DataFrame, *cols: Column) -> DataFrame:
    """Projection given to a Python operator."""
    return df.select(*cols)
