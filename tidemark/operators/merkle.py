"""A digest of an ordered plan that no task computes alone: a Merkle tree over fixed ranges of positions.

A leaf is the SHA-256 of RANGE consecutive event ids, each with a newline behind it; a node that of FANOUT digests below it, likewise.
Any changed, added, lost or moved event changes the root. The nodes that make up exactly the first p positions, and
the digest of the events behind the last whole range, prove a prefix: a few hundred digests whatever the plan's length.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import scalar as fn
from tidemark.session import materialize

RANGE = 1024
FANOUT = 64
# Level of the events behind the last whole range of a prefix.
REST = -1


class PrefixError(ValueError):
    pass


def _digest(value: str, order: str) -> Column:
    return F.sha2(F.expr(f"listagg(concat({value}, '\\n'), '') WITHIN GROUP (ORDER BY {order})"), 256)


def merkle_tree(events: DataFrame) -> DataFrame:
    """(level, idx, events, digest) of events (event_id, position from 0, without gaps): every level, the root last.

    No group holds more than RANGE events or FANOUT nodes. Levels are stored, as each is read by the next.
    """
    leaves = events.select(fn.pack_id("event_id").alias("_id"), "position", F.floor(F.col("position") / RANGE).cast("bigint").alias("idx"))
    # Moved as bytes, made text again where the range is digested.
    dealt = leaves.repartition("idx").select(fn.unpack_id("_id").alias("event_id"), "position", "idx")
    level = materialize(
        dealt.groupBy("idx").agg(F.count(F.lit(1)).alias("events"), _digest("event_id", "position").alias("digest")), "merkle-0"
    )
    nodes, tree, k = level.count(), level.withColumn("level", F.lit(0)), 0
    while nodes > 1:
        k += 1
        grouped = level.withColumnRenamed("idx", "below").withColumn("idx", F.floor(F.col("below") / FANOUT).cast("bigint"))
        level = materialize(grouped.groupBy("idx").agg(F.sum("events").alias("events"), _digest("digest", "below").alias("digest")), f"merkle-{k}")
        nodes = level.count()
        tree = tree.unionByName(level.withColumn("level", F.lit(k)))
    return tree.select("level", "idx", "events", "digest")


def merkle_root(tree: DataFrame) -> DataFrame:
    """One row: events, ranges, root."""
    return tree.agg(
        F.coalesce(F.sum(F.when(F.col("level") == 0, F.col("events"))), F.lit(0)).cast("bigint").alias("events"),
        F.count(F.when(F.col("level") == 0, 1)).alias("ranges"),
        F.max_by("digest", "level").alias("merkle_root"),
    )


def prefix_proof(events: DataFrame, tree: DataFrame, length: int) -> DataFrame:
    """(level, idx, digest) that stand for exactly the first ``length`` positions: at most FANOUT - 1 nodes a level."""
    span = F.lit(RANGE).cast("bigint") * F.pow(F.lit(FANOUT), F.col("level")).cast("bigint")
    whole = F.floor(F.lit(length) / span)
    above = F.floor(F.lit(length) / (span * FANOUT)) * FANOUT
    top = tree.agg(F.max("level").alias("top"))
    nodes = tree.join(F.broadcast(top)).where((F.col("idx") < whole) & ((F.col("idx") >= above) | (F.col("level") == F.col("top"))))
    begun = length // RANGE * RANGE
    rest = events.where((F.col("position") >= begun) & (F.col("position") < length)).agg(_digest("event_id", "position").alias("digest"))
    return nodes.select("level", "idx", "digest").unionByName(
        rest.where("digest is not null").select(F.lit(REST).alias("level"), F.lit(length // RANGE).cast("bigint").alias("idx"), "digest")
    )


def verify_prefix(events: DataFrame, tree: DataFrame, proof: DataFrame, length: int) -> None:
    """Raise unless the plan's first ``length`` events are those that ``proof`` was made for."""
    mine = prefix_proof(events, tree, length)
    both = mine.withColumn("side", F.lit(1)).unionByName(proof.select("level", "idx", "digest").withColumn("side", F.lit(2)))
    differs = both.groupBy("level", "idx", "digest").agg(F.count_distinct("side").alias("n")).where("n < 2").limit(1).count()
    if differs:
        raise PrefixError(f"the first {length} events are not those that were acknowledged")


def resume_behind(events: DataFrame, tree: DataFrame, proof: DataFrame, length: int) -> DataFrame:
    """Events from position ``length`` on, once the skipped ones are proved."""
    verify_prefix(events, tree, proof, length)
    return events.where(F.col("position") >= length)
