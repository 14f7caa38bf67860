"""Recorded topics: segments with offsets, read as a stream from given positions (SRC1, SRC9).

A recorded topic is a folder of Parquet segments, each with consecutive offsets of one
partition in order:

    <path>/p=<partition>/part-*.parquet     topic, partition, offset, value, timestamp

The stream's position is an offset per partition, as a topic's is.  It starts at
``earliest`` or at the positions that an offset ledger gives (the JSON of
:func:`chargepulse.streaming.sinks.starting_offsets`); a partition that has none yet,
or appears later, is read from its beginning.  Where segments begin and end is taken from
the statistics in their footers, so planning a batch reads no records, and a task reads
the row groups of one segment that hold wanted offsets.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from .streams import RECORD_SCHEMA

FORMAT = "topic_segments"


def record_segments(records: DataFrame, path: str, rows_per_segment: int) -> None:
    """Append topic records to a recorded topic, cut into segments."""
    have = set(records.columns)
    cols = [F.col(c) if c in have else F.lit(None).cast(t).alias(c)
            for c, t in (c.split() for c in RECORD_SCHEMA.split(", "))]
    (records.select(*cols, F.col("partition").alias("p")).repartitionByRange("partition", "offset")
     .sortWithinPartitions("partition", "offset").write.mode("append").partitionBy("p")
     .option("maxRecordsPerFile", rows_per_segment).parquet(path))


def segment_stream(spark: SparkSession, path: str, starting_offsets: str = "earliest") -> DataFrame:
    """Stream a recorded topic.  ``starting_offsets`` applies to a fresh checkpoint only; a
    trigger takes what is recorded by then."""
    spark.dataSource.register(SegmentSource)
    return spark.readStream.format(FORMAT).option("startingOffsets", starting_offsets).load(path)


def files_of(path: str):
    """(file system, folder) of a path or URI."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


class SegmentPart(InputPartition):
    """Offsets ``[first, until)`` of one segment."""

    def __init__(self, path: str, first: int, until: int):
        super().__init__((path, first, until))


class SegmentSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return RECORD_SCHEMA

    def streamReader(self, schema) -> SegmentReader:
        return SegmentReader(self.options["path"], self.options.get("startingOffsets", "earliest"))


class SegmentReader(DataSourceStreamReader):
    def __init__(self, path: str, starting_offsets: str):
        self.path = path
        given = {} if starting_offsets == "earliest" else json.loads(starting_offsets)
        if len(given) > 1:
            raise ValueError("positions of one topic are needed")
        self.first = {str(p): int(o) for offsets in given.values() for p, o in offsets.items()}
        self.known: dict[str, tuple[str, int, int]] = {}

    def segments(self) -> list[tuple[str, str, int, int]]:
        """(path, partition, first offset, offset after the last) of every segment; the
        footers of new ones are read."""
        from pyarrow import fs
        from pyarrow import parquet as pq

        files, root = files_of(self.path)
        for f in files.get_file_info(fs.FileSelector(root, recursive=True, allow_not_found=True)):
            if f.type != fs.FileType.File or f.path in self.known or not f.base_name.startswith("part-"):
                continue
            if "/_temporary/" in f.path:  # a write that has not ended
                continue
            with files.open_input_file(f.path) as at:
                meta = pq.ParquetFile(at).metadata
            column = meta.schema.names.index("offset")
            stats = [meta.row_group(g).column(column).statistics for g in range(meta.num_row_groups)]
            if stats:
                partition = f.path.rsplit("/p=", 1)[1].split("/")[0]
                self.known[f.path] = (partition, min(s.min for s in stats), max(s.max for s in stats) + 1)
        return [(path, *x) for path, x in self.known.items()]

    def initialOffset(self) -> dict:
        return self.first

    def latestOffset(self) -> dict:
        end: dict[str, int] = dict(self.first)
        for _, p, _, until in self.segments():
            end[p] = max(end.get(p, 0), until)
        return end

    def partitions(self, start: dict, end: dict) -> list[SegmentPart]:
        parts = []
        for path, p, first, until in self.segments():
            lo, hi = max(first, start.get(p, 0)), min(until, end.get(p, 0))
            if lo < hi:
                parts.append(SegmentPart(path, lo, hi))
        return parts

    def read(self, partition: SegmentPart) -> Iterator:
        import pyarrow as pa
        from pyarrow import compute as pc
        from pyarrow import parquet as pq

        path, first, until = partition.value
        files, _ = files_of(self.path)
        names = [c.split()[0] for c in RECORD_SCHEMA.split(", ")]
        kinds = [pa.string(), pa.int32(), pa.int64(), pa.string(), pa.timestamp("us", "UTC")]
        with files.open_input_file(path) as at:
            segment = pq.ParquetFile(at)
            column = segment.metadata.schema.names.index("offset")
            for g in range(segment.metadata.num_row_groups):
                stats = segment.metadata.row_group(g).column(column).statistics
                if stats.max < first or stats.min >= until:
                    continue
                for batch in segment.iter_batches(row_groups=[g], columns=names):
                    offset = batch.column("offset")
                    batch = batch.filter(pc.and_(pc.greater_equal(offset, first), pc.less(offset, until)))
                    yield pa.RecordBatch.from_arrays([batch.column(n).cast(k) for n, k in zip(names, kinds, strict=True)],
                                                     names=names)
