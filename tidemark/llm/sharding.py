"""Sharding with jump consistent hashing (Lamping and Veach, 2014).

A key's shard follows from the key and the number of shards alone: no ring
table, and with one more shard a key either stays or moves into the new shard.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import shuffle_partitions
from tidemark.session import materialize

# Fixed values of the published algorithm.
MULTIPLIER = Decimal(2862933555777941757)
TWO_31 = 2147483648.0
TWO_33 = Decimal(8589934592)
TWO_64 = Decimal(18446744073709551616)

_UNSIGNED = T.DecimalType(20, 0)


def jump_shard(key: Column, shards: int) -> tuple[Column, Column]:
    """Shard of a long key among ``shards``, and among ``shards + 1``.

    The generator's state is an unsigned 64-bit number; DECIMAL(38) holds its
    product without overflow. Every step moves the candidate up by one at least, so
    ``shards`` steps always suffice, and steps after the end change nothing.
    """
    if shards < 1:
        raise ValueError("shards must be positive")
    k = key.cast(_UNSIGNED)
    start = F.struct(
        F.when(key < 0, k + F.lit(TWO_64)).otherwise(k).cast(_UNSIGNED).alias("k"),
        F.lit(-1).cast("bigint").alias("b"),
        F.lit(0).cast("bigint").alias("j"),
    )

    def step(acc: Column, _: Column) -> Column:
        product = (acc["k"] * F.lit(MULTIPLIER)).cast(T.DecimalType(38, 0)) + F.lit(1)
        k1 = (product % F.lit(TWO_64)).cast(_UNSIGNED)
        high = F.floor(k1 / F.lit(TWO_33)).cast("double")
        jump = (acc["j"] + 1).cast("double") * (F.lit(TWO_31) / (high + F.lit(1.0)))
        moved = F.struct(k1.alias("k"), acc["j"].alias("b"), F.floor(jump).cast("bigint").alias("j"))
        return F.when(acc["j"] < shards, moved).otherwise(acc)

    end = F.aggregate(F.sequence(F.lit(1), F.lit(shards)), start, step)
    both = F.transform(
        F.array(end),
        lambda e: F.struct(
            e["b"].cast("int").alias("now"),
            F.when(e["j"] == shards, F.lit(shards)).otherwise(e["b"]).cast("int").alias("grown"),
        ),
    )[0]
    return both["now"], both["grown"]


def shard_documents(docs: DataFrame, shards: int = 24, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard for every row.

    The law is ``key``: doc_id and the number of shards decide. ``slot`` numbers a
    shard's rows from 0 without a gap in the order (doc_id, size, text_crc32).
    A null doc_id counts as key 0; a null text has size 8 and checksum 0. Rows equal in
    all of these get neighbouring slots. Further columns of ``docs`` are not read.

    The numbering never sorts a shard in one task: narrow rows are dealt out by range
    of (shard, order), with a row number that splits runs of equal keys, and written
    once; a table of one row per (shard, block), at most ``shards`` plus the number of
    blocks long, then gives each block its first slot.
    """
    spark = docs.sparkSession
    body = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    key = F.col(f"`{id_col}`").cast("bigint")
    now, grown = jump_shard(F.coalesce(key, F.lit(0)), shards)
    narrow = docs.select(
        key.alias("doc_id"),
        (F.octet_length(body) + F.lit(8)).cast("bigint").alias("size"),
        F.crc32(F.encode(body, "UTF-8")).alias("text_crc32"),
        F.struct(now.alias("now"), grown.alias("grown")).alias("s"),
        F.monotonically_increasing_id().alias("rid"),
    )
    narrow = materialize(
        narrow.select("doc_id", "size", "text_crc32", F.col("s.now").alias("shard"), F.col("s.grown").alias("grown_shard"), "rid"),
        "shards",
    )
    order = [F.col("shard"), F.col("doc_id").asc_nulls_first(), F.col("size"), F.col("text_crc32"), F.col("rid")]
    dealt = materialize(
        narrow.repartitionByRange(shuffle_partitions(spark), *order)
        .sortWithinPartitions(*order)
        .withColumn("block", F.spark_partition_id())
        .withColumn("at", F.monotonically_increasing_id()),
        "shard-blocks",
    )
    sizes = dealt.groupBy("shard", "block").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.withColumn("start", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    return (
        dealt.join(F.broadcast(starts), ["shard", "block"])
        .select(
            "doc_id",
            "size",
            "text_crc32",
            F.lit("key").alias("law"),
            "shard",
            (F.col("start") + F.col("at") - F.col("first")).alias("slot"),
            "grown_shard",
        )
    )
