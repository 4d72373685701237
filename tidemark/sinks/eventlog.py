"""Event log writer and replay position.

Where a Kafka connector is on the classpath the same frame can be written
with ``format('kafka')``; here the log is a Parquet table with Kafka's record
layout (topic, partition, offset, key, value), partitioned by topic and
partition so readers prune to the partitions they own.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.schemas import SOURCE_RECORD
from tidemark.session import path_exists


def write_event_log(
    records: DataFrame, root: str, mode: str = "append", by_size: bool = False, make: Callable[[DataFrame], DataFrame] | None = None
) -> None:
    """Append a batch of log records; each (topic, partition) folder gets the
    batch's records for that partition in files of consecutive offset ranges, so
    a partition that holds most of the log is written by many tasks. ``by_size``: the
    ranges' number is not fixed, so small ones are put together and files follow from the
    batch's size, for a log that is streamed: a stream pays for every few files. ``make`` turns rows (topic, partition, offset and
    what it needs) into records behind the dealing, so that what follows from a row is not moved."""
    n = [] if by_size else [int(records.sparkSession.conf.get("spark.sql.shuffle.partitions"))]
    names = [f.name for f in SOURCE_RECORD.fields]
    rows = records if make else records.select(*names)
    dealt = rows.repartitionByRange(*n, "topic", "partition", "offset").sortWithinPartitions("topic", "partition", "offset")
    (
        (make(dealt) if make else dealt)
        .select(*names)
        .write.mode(mode)
        .option("compression", "zstd")
        .partitionBy("topic", "partition")
        .parquet(root)
    )


def read_event_log(spark: SparkSession, root: str) -> DataFrame:
    """Batch read with the pinned record schema (partition columns typed by
    the schema, not inferred)."""
    return spark.read.schema(SOURCE_RECORD).option("basePath", root).parquet(root)


def stream_event_log(spark: SparkSession, root: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """The log as a stream: a file source with the record schema; the rate
    limit of the publisher becomes ``maxFilesPerTrigger`` on the reader."""
    r = spark.readStream.schema(SOURCE_RECORD).option("basePath", root)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", int(max_files_per_trigger))
    return r.parquet(root)


def write_replay_position(spark: SparkSession, path: str, manifest: str, last_event_id: str) -> None:
    """One-row position table bound to the manifest it belongs to; Spark's
    commit protocol makes the overwrite atomic for readers."""
    spark.createDataFrame([(manifest, last_event_id)], "manifest string, last_event_id string").coalesce(1).write.mode(
        "overwrite"
    ).parquet(path)


def read_replay_position(spark: SparkSession, path: str, manifest: str) -> str | None:
    """Last acknowledged event id, or None when no position was written.
    A position written for another manifest is an error."""
    if not path_exists(spark, path):
        return None
    rows = spark.read.schema("manifest string, last_event_id string").parquet(path).limit(2).collect()
    if not rows:
        return None
    if rows[0]["manifest"] != manifest:
        raise ValueError("checkpoint belongs to another manifest")
    return rows[0]["last_event_id"]
