"""Offset bookkeeping over an ordered log: dense positions, partition ends,
checkpoints and the first hole of each partition.

None of these puts one log partition into one task. A topic may have a
handful of partitions while holding most of the data, so per-partition
windows (``row_number``/``lag`` over the partition) are avoided: positions
come from a range-partitioned sort plus per-block counts, and holes from an
anti join on (topic, partition, offset), which spreads over all offsets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.schemas import ADVANCING


def dense_index(
    df: DataFrame,
    group_cols: list[str],
    order_cols: list[str | Column],
    out: str = "idx",
    num_partitions: int | None = None,
    keep: list[str] | None = None,
) -> DataFrame:
    """0-based position of every row inside its group, in ``order_cols`` order.

    Equivalent to ``row_number() over (partition by group order by order) - 1``
    but scalable when a group is huge: a range shuffle (sampled bounds, so a
    hot group is split over many tasks), per-task block counts, prefix sums of
    those counts over the (small) block table, and a join back. ``order_cols``
    must be a total order within a group (rows equal on every ordering column
    must be identical rows). ``keep`` names the columns to go on with, if not all.

    The tagged blocks are read twice (counts, then positions). Range bounds
    come from sampling and two plans over the same input may draw different
    ones, so the tagged frame is always written as a table to the shared
    checkpoint folder: both reads see the same blocks, and a lost executor
    re-reads rather than re-tags. The positions themselves are a view of that
    table: the block starts (one row per block and group in it) are stored too
    and broadcast behind a size check, so no row is shuffled a second time.
    """
    from tidemark.session import guarded_broadcast, materialize

    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.col(c) if isinstance(c, str) else c for c in [*group_cols, *order_cols]]
    tagged = materialize(
        df.repartitionByRange(n, *keys)
        .sortWithinPartitions(*keys)
        .select(*(dict.fromkeys([*group_cols, *keep]) if keep else ["*"]))
        .withColumn("_blk", F.spark_partition_id())
        .withColumn("_mid", F.monotonically_increasing_id()),
        "dense-index",
        "zstd",
    )
    blocks = tagged.groupBy("_blk", *group_cols).agg(
        F.count(F.lit(1)).alias("_n"), F.min("_mid").alias("_first")
    )
    before = Window.partitionBy(*group_cols).orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
    starts = materialize(
        blocks.withColumn("_start", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n"), "block-starts"
    )
    return (
        tagged.join(guarded_broadcast(starts), on=["_blk", *group_cols], how="inner")
        .withColumn(out, (F.col("_start") + F.col("_mid") - F.col("_first")).cast("long"))
        .drop("_blk", "_mid", "_first", "_start")
    )


def partition_ends(log: DataFrame) -> DataFrame:
    """End offset (max offset + 1) and record count per (topic, partition)."""
    return log.groupBy("topic", "partition").agg(
        (F.max("offset") + 1).alias("end_offset"), F.count(F.lit(1)).alias("records")
    )


def checkpoints_from_ledger(ledger: DataFrame, group_col: str | None = "consumer_group") -> DataFrame:
    """next_offset per (group, topic, partition): one past the highest offset
    that took an advancing disposition."""
    keys = ([group_col] if group_col else []) + ["topic", "partition"]
    return (
        ledger.where(F.col("disposition").isin(*ADVANCING))
        .groupBy(*keys)
        .agg((F.max("offset") + 1).alias("next_offset"))
    )


def first_hole(live: DataFrame, base: DataFrame) -> DataFrame:
    """Smallest missing offset at or above ``next0`` per (topic, partition).

    ``live``: distinct (topic, partition, offset) with offset >= next0.
    ``base``: (topic, partition, next0) for every partition present in
    ``live``. A candidate is next0 or any live offset + 1; the hole is the
    least candidate that is not itself live. The anti join is keyed on the
    offset, so it spreads evenly however large one partition is.
    """
    cands = live.select("topic", "partition", (F.col("offset") + 1).alias("offset")).unionByName(
        base.select("topic", "partition", F.col("next0").alias("offset"))
    )
    missing = cands.join(live.select("topic", "partition", "offset"), ["topic", "partition", "offset"], "left_anti")
    return missing.groupBy("topic", "partition").agg(F.min("offset").alias("hole"))
