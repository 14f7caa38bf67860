"""Stream sources (SRC1, SRC2, SRC3, SRC9).

Deployment sources are Kafka topics and sockets; tests use file streams with
the same column shape (``value`` plus ``topic, partition, offset`` for topic
records).  Resume after a restart comes from the query's checkpoint
location; an offset ledger (``streaming.sinks``) can seed a *new* checkpoint.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

RECORD_SCHEMA = "topic string, partition int, offset bigint, value string, timestamp timestamp"


def max_records_per_trigger(rate_per_partition: int, batch_seconds: float,
                            partitions: int) -> int:
    """SRC2: a per-partition rate ceiling over a batch interval, as the
    per-trigger total Spark's Kafka source takes (``maxOffsetsPerTrigger``)."""
    return int(rate_per_partition * batch_seconds * partitions)


def topic_stream(spark: SparkSession, brokers: str, topic: str,
                 starting_offsets: str = "earliest",
                 max_offsets_per_trigger: int | None = None,
                 options: dict[str, str] | None = None) -> DataFrame:
    """SRC1: subscribe to a topic; key/value decoded as strings.

    ``starting_offsets`` applies only to a fresh checkpoint: ``earliest`` or
    a JSON map from :func:`chargepulse.streaming.sinks.starting_offsets`.
    Subscribing (not assigning) picks up partitions added later.  Needs the
    Kafka connector on the classpath.
    """
    r = (spark.readStream.format("kafka")
         .option("kafka.bootstrap.servers", brokers)
         .option("subscribe", topic)
         .option("startingOffsets", starting_offsets))
    if max_offsets_per_trigger:
        r = r.option("maxOffsetsPerTrigger", str(max_offsets_per_trigger))
    for k, v in (options or {}).items():
        r = r.option(k, v)
    return r.load().selectExpr("CAST(key AS STRING) AS key", "CAST(value AS STRING) AS value",
                               "topic", "partition", "offset", "timestamp")


def _sized(reader, max_files_per_trigger: int | None, max_bytes_per_trigger: int | None):
    """Bound a file stream's triggers by files or, if given, by bytes (Spark takes one)."""
    if max_bytes_per_trigger:
        return reader.option("maxBytesPerTrigger", str(max_bytes_per_trigger))
    return reader.option("maxFilesPerTrigger", str(max_files_per_trigger)) if max_files_per_trigger else reader


def record_file_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = 1,
                       schema: str = RECORD_SCHEMA, fmt: str = "parquet",
                       max_bytes_per_trigger: int | None = None) -> DataFrame:
    """Stand-in for a topic: a folder of record files with the topic shape."""
    r = spark.readStream.schema(schema).format(fmt)
    return _sized(r, max_files_per_trigger, max_bytes_per_trigger).load(path)


def text_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None,
                max_bytes_per_trigger: int | None = None) -> DataFrame:
    """SRC3 stand-in / SRC9: lines of text files as ``value`` rows.  With
    ``max_files_per_trigger`` and a processing-time trigger this replays a
    folder at a fixed pace."""
    return _sized(spark.readStream.format("text"), max_files_per_trigger, max_bytes_per_trigger).load(path)


def socket_lines(spark: SparkSession, host: str, port: int) -> DataFrame:
    """SRC3: lines from a socket (deployment only; not for tests)."""
    return (spark.readStream.format("socket").option("host", host)
            .option("port", str(port)).load())


def publish_lines(df: DataFrame, brokers: str, topic: str) -> None:
    """SRC9 publish side: write a ``value`` column to a topic in one batch job
    (executors write in parallel; no per-line pacing on the driver)."""
    (df.selectExpr("CAST(value AS STRING) AS value").write.format("kafka")
     .option("kafka.bootstrap.servers", brokers).option("topic", topic).save())
