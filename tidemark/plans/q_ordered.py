"""Window-style, sort, top-k and set operators bound to the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import validation as V
from tidemark.operators.offsets import dense_index
from tidemark.plans import bindings as B
from tidemark.plans.bindings import _event_id_sql, with_ctes
from tidemark.plans.catalog import query
from tidemark.plans.q_core import (
    ORDER_FILES_SQL,
    REQUESTED_SQL,
    event_reason_sql,
    order_manifest_files,
    parse_date_sql,
    requested_symbols,
)
from tidemark.plans.replay import REPLAY_ORDER, build_events, plan_positions, slice_resume
from tidemark.session import guarded_broadcast

EID = _event_id_sql("schema_version", "provider", "symbol", "trading_date")


@query(
    "win_duplicate_date",
    with_ctes(
        """SELECT symbol, trading_date, line_no,
                  line_no > min(line_no) OVER (PARTITION BY symbol, trading_date) AS is_duplicate
           FROM bars_dirty""",
        "bars_dirty",
    ),
)
def q_win_duplicate_date(spark, sf_dir):
    d = V.duplicate_flag(B.bars_dirty(spark, sf_dir), ["symbol", "trading_date"], "line_no")
    return d.select("symbol", "trading_date", "line_no", "is_duplicate")


@query(
    "win_first_writer",
    with_ctes(
        f"""SELECT provider, symbol, p_date AS trading_date, topic AS w_topic, partition AS w_partition, offset AS w_offset
            FROM (SELECT *, row_number() OVER (PARTITION BY provider, symbol, p_date ORDER BY topic, partition, offset) AS rn
                  FROM (SELECT *, {parse_date_sql('trading_date')} AS p_date, {event_reason_sql('log')} AS reason FROM log) l
                  WHERE reason IS NULL) x
            WHERE rn = 1""",
        "log",
    ),
)
def q_win_first_writer(spark, sf_dir):
    """First valid record per logical key by (topic, partition, offset):
    a partial aggregate (min of a struct), not a window over the key."""
    j = V.val_event_contract(B.log(spark, sf_dir)).where(F.col("reject_reason").isNull())
    w = j.groupBy("provider", "symbol", F.col("p_trading_date").alias("trading_date")).agg(
        F.min(F.struct("topic", "partition", "offset")).alias("w")
    )
    return w.select(
        "provider",
        "symbol",
        "trading_date",
        F.col("w.topic").alias("w_topic"),
        F.col("w.partition").alias("w_partition"),
        F.col("w.offset").alias("w_offset"),
    )


@query(
    "win_line_number",
    with_ctes(
        """SELECT file_symbol, trading_date, line_no,
                  row_number() OVER (PARTITION BY file_symbol ORDER BY line_no, trading_date) + 1 AS line_number
           FROM bars_dirty""",
        "bars_dirty",
    ),
)
def q_win_line_number(spark, sf_dir):
    d = B.bars_dirty(spark, sf_dir)
    n = dense_index(d, ["file_symbol"], ["line_no", "trading_date"], out="_i")
    return n.select("file_symbol", "trading_date", "line_no", (F.col("_i") + 2).alias("line_number"))


@query(
    "win_replay_position",
    with_ctes(
        f"""SELECT {EID} AS event_id, row_number() OVER (ORDER BY trading_date, symbol) - 1 AS position
            FROM bars_big""",
        "bars_big",
    ),
)
def q_win_replay_position(spark, sf_dir):
    ev = B.bars_big(spark, sf_dir).select(
        F.col("trading_date"), "symbol", F.sha2(F.concat_ws("|", F.lit("1"), "provider", "symbol", F.date_format("trading_date", "yyyy-MM-dd")), 256).alias("event_id")
    )
    return plan_positions(ev).select("event_id", "position")


@query(
    "sort_rows_by_date",
    with_ctes(
        "SELECT symbol, trading_date, row_number() OVER (PARTITION BY symbol ORDER BY trading_date) AS row_in_file FROM bars_big",
        "bars_big",
    ),
)
def q_sort_rows_by_date(spark, sf_dir):
    b = B.bars_big(spark, sf_dir).select("symbol", "trading_date")
    n = dense_index(b, ["symbol"], ["trading_date"], out="_i")
    return n.select("symbol", "trading_date", (F.col("_i") + 1).alias("row_in_file"))


@query(
    "sort_replay",
    with_ctes(
        f"""SELECT {EID} AS event_id, strftime(trading_date, '%Y-%m-%d') AS trading_date, symbol FROM bars_big
            ORDER BY trading_date, symbol""",
        "bars_big",
    ),
)
def q_sort_replay(spark, sf_dir):
    ev = build_events(B.bars_big(spark, sf_dir))
    return ev.orderBy(*REPLAY_ORDER).select("event_id", "trading_date", "symbol")


@query(
    "sort_manifest",
    f"""SELECT manifest_id, array_to_string(list_sort(list(symbol)), ',') AS files_by_symbol
        FROM ({ORDER_FILES_SQL}) f GROUP BY manifest_id""",
)
def q_sort_manifest(spark, sf_dir):
    f = order_manifest_files(spark, sf_dir)
    return f.groupBy("manifest_id").agg(
        F.array_join(F.array_sort(F.collect_list("symbol")), ",").alias("files_by_symbol")
    )


@query(
    "topk_next_task",
    with_ctes(
        f"""SELECT event_id, created_at FROM outbox
            WHERE attempt_count < 2 AND (status = 'pending' OR
                  (status = 'processing' AND claimed_at < TIMESTAMP '{B.OUTBOX_NOW}' - INTERVAL 5 MINUTE))
            ORDER BY created_at, event_id LIMIT 10""",
        "outbox",
    ),
)
def q_topk_next_task(spark, sf_dir):
    c = V.flt_claimable(B.outbox(spark, sf_dir), F.lit(B.OUTBOX_NOW).cast("timestamp_ntz"), max_attempts=2)
    # The limit is the feature: the oldest claimable tasks (top-k, no full sort).
    return c.orderBy("created_at", "event_id").limit(10).select("event_id", "created_at")


@query(
    "slice_resume",
    with_ctes(
        f"""SELECT {EID} AS event_id, trading_date, symbol FROM bars_big
            WHERE (trading_date, symbol) > (DATE '1998-01-01', 'S5')""",
        "bars_big",
    ),
)
def q_slice_resume(spark, sf_dir):
    b = B.bars_big(spark, sf_dir)
    ev = b.select(
        F.sha2(F.concat_ws("|", F.col("schema_version").cast("string"), "provider", "symbol", F.date_format("trading_date", "yyyy-MM-dd")), 256).alias("event_id"),
        "trading_date",
        "symbol",
    )
    return slice_resume(ev, "1998-01-01", "S5")


# --------------------------------------------------------------------- sets
@query(
    "set_union_files",
    with_ctes(
        """SELECT provider, symbol, count(*) AS rows FROM (
             SELECT provider, symbol, trading_date FROM bars UNION ALL SELECT provider, symbol, trading_date FROM bars_big) u
           GROUP BY provider, symbol""",
        "bars",
        "bars_big",
    ),
)
def q_set_union_files(spark, sf_dir):
    u = B.bars(spark, sf_dir).select("provider", "symbol", "trading_date").unionByName(
        B.bars_big(spark, sf_dir).select("provider", "symbol", "trading_date")
    )
    return u.groupBy("provider", "symbol").agg(F.count(F.lit(1)).alias("rows"))


@query(
    "set_unique_symbols",
    f"""SELECT manifest_id, count(DISTINCT symbol) = count(*) AS unique_symbols,
               count(DISTINCT path) = count(*) AS unique_paths
        FROM ({ORDER_FILES_SQL}) f GROUP BY manifest_id""",
)
def q_set_unique_symbols(spark, sf_dir):
    f = order_manifest_files(spark, sf_dir)
    return f.groupBy("manifest_id").agg(
        (F.count_distinct("symbol") == F.count(F.lit(1))).alias("unique_symbols"),
        (F.count_distinct("path") == F.count(F.lit(1))).alias("unique_paths"),
    )


@query(
    "set_scan_sharing",
    f"""SELECT 'S' || CAST(l_suppkey AS VARCHAR) AS symbol, count(*) AS vendor_rows
        FROM lineitem WHERE 'S' || CAST(l_suppkey AS VARCHAR) IN ({REQUESTED_SQL})
        GROUP BY l_suppkey""",
)
def q_set_scan_sharing(spark, sf_dir):
    """One scan of the shared vendor table serves every requested symbol."""
    li = B.table(spark, sf_dir, "lineitem").select(F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("symbol"))
    kept = li.join(guarded_broadcast(requested_symbols(spark, sf_dir)), "symbol", "left_semi")
    return kept.groupBy("symbol").agg(F.count(F.lit(1)).alias("vendor_rows"))
