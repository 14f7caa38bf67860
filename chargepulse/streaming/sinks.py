"""Sinks (SNK7-SNK11).

Counters and upserts (SNK1-SNK6) live in :mod:`.state`.  Here: relational
append, catalog overwrite, console output and the offset ledger.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import split_topic_partition


def append_jdbc(df: DataFrame, url: str, table: str, properties: dict[str, str],
                num_partitions: int | None = None) -> None:
    """SNK7: append rows to a relational table.  Each task opens its own
    connection; ``num_partitions`` caps concurrent connections.  Appending
    twice stores the rows twice."""
    w = df if num_partitions is None else df.coalesce(num_partitions)
    w.write.mode("append").jdbc(url, table, properties=properties)


def append_table(df: DataFrame, table: str, path: str | None = None) -> None:
    """SNK7 on the catalog: append to ``table`` (created on first use, as an
    external Parquet table at ``path`` when given)."""
    spark = df.sparkSession
    if spark.catalog.tableExists(table):
        # columns go by name, as a relational append matches them
        df.select(*spark.table(table).columns).write.insertInto(table, overwrite=False)
        return
    w = df.write.mode("append").format("parquet")
    if path:
        w = w.option("path", path)
    w.saveAsTable(table)


def create_partitioned_table(df: DataFrame, table: str, partition_cols: list[str],
                             path: str | None = None) -> None:
    """Create an empty partitioned Parquet table with ``df``'s schema."""
    w = df.limit(0).write.mode("overwrite").format("parquet").partitionBy(*partition_cols)
    if path:
        w = w.option("path", path)
    w.saveAsTable(table)


def overwrite_insert(df: DataFrame, table: str, tasks: int | None = None) -> None:
    """SNK8: positional ``INSERT OVERWRITE`` with dynamic partitions: those present in
    ``df`` are replaced, the others kept.  The mode is an option of this write alone, so
    the session's setting and other writes do not matter; partitions that are new are
    entered in the catalog.  A partition is one file; ``tasks`` (default: the session's
    shuffle partitions, not coalesced, as opening files is most of the work) write them."""
    spark = df.sparkSession
    columns = spark.catalog.listColumns(table)
    keys = [c.name for c in columns if c.isPartition]
    if not keys:
        raise ValueError(f"{table} has no partitions")
    place = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where(
        (F.col("col_name") == "Location") & F.col("data_type").isNotNull()).first()["data_type"]
    tasks = tasks or int(spark.conf.get("spark.sql.shuffle.partitions"))
    (df.toDF(*[c.name for c in columns]).repartition(tasks, *keys).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*keys).parquet(place))
    spark.catalog.recoverPartitions(table)
    spark.catalog.refreshTable(table)


def newest_partition(spark: SparkSession, table: str) -> str | None:
    """Largest value of a table's one partition column, from the catalog alone."""
    found = spark.sql(f"SHOW PARTITIONS {table}").agg(F.max("partition")).first()[0]
    return None if found is None else found.split("=", 1)[1]


def append_files(stream_df: DataFrame, path: str, checkpoint: str, trigger: dict | None = None):
    """STR6: rows of a stream appended to Parquet files.  The sink keeps its own log of
    the files of each batch, which readers of ``path`` follow, so a batch that is
    delivered again appends nothing."""
    return (stream_df.writeStream.outputMode("append").format("parquet").option("path", path)
            .option("checkpointLocation", checkpoint).trigger(**(trigger or {"processingTime": "1 second"})).start())


def console(stream_df: DataFrame, output_mode: str = "complete", truncate: bool = False):
    """SNK9: print each trigger's result on the driver console (deployment
    and demos only: the printed rows pass through the driver)."""
    return (stream_df.writeStream.outputMode(output_mode).format("console")
            .option("truncate", str(truncate).lower()).start())


# ---------------------------------------------------------------- ledger

def ledger_rows(ledger: DataFrame, group_id: str) -> DataFrame:
    """State of the offset ledger -> ``group_id, topic, partition,
    until_offset, tp_key`` (``tp_key`` is the legacy ``<topic>-<partition>``
    field name)."""
    return ledger.select(
        F.lit(group_id).alias("group_id"), "topic", "partition", "until_offset",
        F.concat_ws("-", "topic", F.col("partition").cast("string")).alias("tp_key"))


def starting_offsets_by_topic(ledger: DataFrame, topic_col: str = "topic",
                              partition_col: str = "partition",
                              offset_col: str = "until_offset") -> DataFrame:
    """SNK11: ledger rows -> one row per topic with the ``startingOffsets``
    JSON Spark's Kafka source takes, e.g. ``{"t":{"0":12,"1":9}}``.
    One list per topic is collected, bounded by its partition count."""
    entries = F.array_sort(F.collect_list(F.struct(F.col(partition_col).alias("p"),
                                                   F.col(offset_col).alias("o"))))
    as_map = F.map_from_entries(F.transform(
        entries, lambda e: F.struct(e["p"].cast("string"), e["o"])))
    return (ledger.groupBy(topic_col).agg(as_map.alias("_m"))
            .select(F.col(topic_col).alias("topic"),
                    F.to_json(F.create_map(F.col(topic_col), F.col("_m"))).alias("starting_offsets")))


def ledger_from_legacy(df: DataFrame, key_col: str = "tp_key",
                       offset_col: str = "until_offset") -> DataFrame:
    """Legacy ``<topic>-<partition> -> offset`` entries -> ledger columns
    (FN11; topics containing dashes are kept whole)."""
    topic, part = split_topic_partition(key_col)
    return df.select(topic.alias("topic"), part.alias("partition"),
                     F.col(offset_col).cast("bigint").alias("until_offset"))


def starting_offsets(spark: SparkSession, ledger: DataFrame, topic: str | None = None) -> str:
    """The ``startingOffsets`` option for a fresh checkpoint: per-topic maps
    merged into one JSON object (driver side; size = partition count).  With
    ``topic`` only that topic's, as a source that reads one topic needs."""
    import json

    merged: dict = {}
    if topic is not None:
        ledger = ledger.where(F.col("topic") == topic)
    for row in starting_offsets_by_topic(ledger).collect():
        merged.update(json.loads(row["starting_offsets"]))
    return json.dumps(merged, separators=(",", ":"))
