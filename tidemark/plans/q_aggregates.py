"""Aggregations bound to the driver tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tidemark.functions import scalar as fn
from tidemark.operators import merkle
from tidemark.operators.offsets import partition_ends
from tidemark.plans import bindings as B
from tidemark.plans.bindings import _event_id_sql, _object_key_sql, with_ctes
from tidemark.plans.catalog import query
from tidemark.plans.q_joins import ACTUAL_SQL, stored_prices
from tidemark.plans.replay import build_events, digest_tree, plan_positions
from tidemark.session import materialize, scratch_path
from tidemark.sinks import archive_drain as AD
from tidemark.sinks.files import file_content_digest

EID = _event_id_sql("schema_version", "provider", "symbol", "trading_date")


@query("agg_manifest_files", with_ctes(ACTUAL_SQL, "bars_big"))
def q_agg_manifest_files(spark, sf_dir):
    return file_content_digest(B.bars_big(spark, sf_dir))


def _merkle_sql(source: str, levels: int = 4) -> str:
    """Range digests and the levels above them, plainly: the root is the first level with one node."""
    ctes = [
        f"p AS (SELECT {EID} AS event_id, row_number() OVER (ORDER BY trading_date, symbol) - 1 AS position FROM {source})",
        f"l0 AS (SELECT position // {merkle.RANGE} AS k, sha256(string_agg(event_id || chr(10), '' ORDER BY position)) AS d FROM p GROUP BY position // {merkle.RANGE})",
    ]
    for i in range(1, levels):
        ctes.append(f"l{i} AS (SELECT k // {merkle.FANOUT} AS k, sha256(string_agg(d || chr(10), '' ORDER BY l{i - 1}.k)) AS d FROM l{i - 1} GROUP BY l{i - 1}.k // {merkle.FANOUT})")
    tops = " UNION ALL ".join(f"SELECT {i} AS l, count(*) AS n, max(d) AS d FROM l{i}" for i in range(levels))
    return ", ".join(ctes) + f"""
        SELECT (SELECT count(*) FROM p) AS events, (SELECT count(*) FROM l0) AS ranges,
               (SELECT d FROM ({tops}) t WHERE n = 1 ORDER BY l LIMIT 1) AS merkle_root"""


@query("agg_ordered_digest", with_ctes("SELECT 1", "bars_big").replace("\nSELECT 1", ", " + _merkle_sql("bars_big")))
def q_agg_ordered_digest(spark, sf_dir):
    """Digest of the whole ordered replay plan as the root of a tree over ranges of positions."""
    # The identity fields are put in order and stored; an event's id is made where its range is digested.
    positions = plan_positions(B.bars_big(spark, sf_dir).select(*fn.IDENTITY))
    return merkle.merkle_root(merkle.merkle_tree(positions.select(fn.event_id(*fn.IDENTITY).alias("event_id"), "position")))


@query(
    "agg_digest_tree",
    with_ctes(
        f"""SELECT count(*) AS days, sha256(string_agg(day_sha256 || chr(10), '' ORDER BY trading_date)) AS tree_sha256
            FROM (SELECT trading_date, sha256(string_agg(event_id || chr(10), '' ORDER BY symbol)) AS day_sha256
                  FROM (SELECT {EID} AS event_id, symbol, strftime(trading_date, '%Y-%m-%d') AS trading_date FROM bars_big) e
                  GROUP BY trading_date) d""",
        "bars_big",
    ),
)
def q_agg_digest_tree(spark, sf_dir):
    return digest_tree(build_events(B.bars_big(spark, sf_dir)))


@query("agg_outbox_status", with_ctes("SELECT status, count(*) AS tasks FROM outbox GROUP BY status", "outbox"))
def q_agg_outbox_status(spark, sf_dir):
    return B.outbox(spark, sf_dir).groupBy("status").agg(F.count(F.lit(1)).alias("tasks"))


@query(
    "agg_sum_offsets",
    with_ctes(
        """SELECT topic, sum(end_offset) AS source_events, count(*) AS partitions FROM
             (SELECT topic, partition, max(offset) + 1 AS end_offset FROM log_redelivered GROUP BY topic, partition) e
           GROUP BY topic""",
        "log_redelivered",
    ),
)
def q_agg_sum_offsets(spark, sf_dir):
    ends = partition_ends(B.log_redelivered(spark, sf_dir))
    return ends.groupBy("topic").agg(F.sum("end_offset").alias("source_events"), F.count(F.lit(1)).alias("partitions"))


@query(
    "agg_archive_objects",
    with_ctes(
        f"""SELECT count(DISTINCT object_key) AS archived_objects, count(*) AS logical_prices,
                   count(DISTINCT object_key) = count(*) AS one_object_per_price
            FROM (SELECT {_object_key_sql('provider', 'symbol', 'trading_date', EID)} AS object_key FROM bars_big) k""",
        "bars_big",
    ),
)
def q_agg_archive_objects(spark, sf_dir):
    """Objects of the archive that a drain has written, against the prices it was given."""
    prices = stored_prices(spark, sf_dir).withColumn("schema_version", F.col("schema_version").cast("int"))
    out = scratch_path(spark, "archive")
    AD.drain(prices, out, max_attempts=1, now=dt.datetime(2024, 1, 1))
    # Counted as the 32 bytes of a digest each, not as text.
    key = F.unhex(F.sha2(fn.object_key("provider", "symbol", "trading_date", "event_id"), 256)).alias("object_key")
    held = AD.read_batches(spark, out).select(key)
    both = held.unionByName(prices.select(F.lit(1).alias("price")), allowMissingColumns=True)
    objects, given = F.count_distinct("object_key"), F.count("price")
    return both.agg(objects.alias("archived_objects"), given.alias("logical_prices"), (objects == given).alias("one_object_per_price"))
