"""Parquet archive of stored prices and the archive task state machine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import scalar as fn
from tidemark.schemas import EVENT_FIELDS
from tidemark.session import materialize, path_exists
from tidemark.sources.files import read_archive

# Layouts: the reference's key layout is one object per event under
# provider=/symbol=/year=/date=. On a large archive that is one file per price
# and one folder per symbol-day, so the default here is one folder per
# (provider, year) whose files hold contiguous symbol ranges sorted by
# (symbol, trading_date): a symbol read prunes row groups by Parquet min/max
# statistics, and the folder count is bounded by the calendar, not by the
# symbol catalogue. "per_date" keeps the reference's folder depth.
LAYOUTS = {
    "compact": ["provider", "year"],
    "per_date": ["provider", "symbol", "year", "date"],
}


def archive_rows(prices: DataFrame) -> DataFrame:
    """The twelve event columns + partition columns + logical object key."""
    return prices.select(
        *EVENT_FIELDS,
        F.year("trading_date").cast("string").alias("year"),
        fn.iso_date("trading_date").alias("date"),
        fn.object_key("provider", "symbol", "trading_date", "event_id").alias("object_key"),
    )


def write_archive(prices: DataFrame, root: str, layout: str = "compact", mode: str = "overwrite") -> None:
    """zstd Parquet under ``root`` partitioned by the layout's columns.

    One shuffle with the REBALANCE hint on (partition columns, symbol): AQE
    splits a skewed key (a hot symbol) and merges small partitions, with no
    extra sampling pass over an expensive input; each task sorts its rows by
    (symbol, date), so a file holds few symbols in order and row groups prune
    by min/max. Files per folder are bounded by the task count.

    A batch adds to what the archive holds: with ``mode`` overwrite, the folders
    that the batch touches are replaced by their rows and the batch's, one per
    event. So an incremental write keeps earlier prices and a retried one
    changes nothing. The merged rows are stored before the folders they come from
    are replaced.
    """
    parts = LAYOUTS[layout]
    rows = archive_rows(prices).drop("object_key")
    spark = prices.sparkSession
    if mode == "overwrite" and path_exists(spark, root):
        rows = materialize(rows, "archive-batch", "zstd")
        touched = rows.select(*[F.col(c).alias(f"_{c}") for c in parts]).distinct()
        same_folder = [F.col(c) == F.col(f"_{c}") for c in parts]
        held = read_archive(spark, root).join(touched, same_folder, "left_semi")
        held = held.join(rows.select("event_id"), "event_id", "left_anti")
        rows = materialize(rows.unionByName(held.select(*rows.columns)), "archive-merged", "zstd")
    order = list(dict.fromkeys([*parts, "symbol", "trading_date"]))
    dealt = fn.without_ids(rows).hint("rebalance", *list(dict.fromkeys([*parts, "symbol"]))).sortWithinPartitions(*order)
    (
        fn.with_ids(dealt)
        .select(*rows.columns)
        .write.mode(mode)
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "zstd")
        .partitionBy(*parts)
        .parquet(root)
    )


def archive_state(attempts: DataFrame, max_attempts: int) -> DataFrame:
    """Final outbox state per event from its attempt log.

    ``attempts``: event_id, attempt (1-based), ok (bool). Attempts past the
    first success or past ``max_attempts`` never ran. archived = some attempt
    <= max succeeded; failed = max attempts ran and all failed; else pending
    (attempts left). One partial aggregate per event.
    """
    ran = attempts.where(F.col("attempt") <= max_attempts)
    agg = ran.groupBy("event_id").agg(
        F.min(F.when(F.col("ok"), F.col("attempt"))).alias("first_ok"),
        F.max("attempt").alias("last_attempt"),
        F.max(F.when(~F.col("ok"), F.col("attempt"))).alias("last_fail"),
    )
    attempt_count = F.coalesce(F.col("first_ok"), F.col("last_attempt"))
    status = (
        F.when(F.col("first_ok").isNotNull(), F.lit("archived"))
        .when(F.col("last_attempt") >= max_attempts, F.lit("failed"))
        .otherwise(F.lit("pending"))
    )
    return agg.select("event_id", status.alias("status"), attempt_count.cast("int").alias("attempt_count"))
