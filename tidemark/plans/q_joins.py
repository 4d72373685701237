"""Join operators bound to the driver tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tidemark.functions import scalar as fn
from tidemark.operators import validation as V
from tidemark.operators.offsets import partition_ends
from tidemark.plans import bindings as B
from tidemark.plans.bindings import _event_id_sql, with_ctes
from tidemark.plans.catalog import query
from tidemark.plans.q_core import event_reason_sql, parse_date_sql, parse_dec_sql
from tidemark.session import guarded_broadcast, scratch_path
from tidemark.sinks import price_table
from tidemark.sinks.files import file_content_digest

KEY = ["provider", "symbol", "trading_date"]


def stored_prices(spark, sf_dir):
    """The supplier bars as a stored price table with identity hashes."""
    b = B.bars_big(spark, sf_dir)
    return b.select(fn.event_id("schema_version", "provider", "symbol", "trading_date").alias("event_id"), "*")


_TABLES: dict[tuple[str, str], tuple[str, int]] = {}


def stored_table(spark, sf_dir) -> tuple[str, int]:
    """Name and buckets of the stored prices' table, written once per session like the log."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _TABLES:
        name, buckets = f"stored_prices_{uuid.uuid4().hex[:12]}", int(spark.conf.get("spark.sql.shuffle.partitions"))
        price_table.open_table(spark, name, scratch_path(spark, "price-table"), buckets)
        price_table.add_prices(stored_prices(spark, sf_dir).withColumn("schema_version", F.col("schema_version").cast("int")), name, buckets)
        _TABLES[key] = name, buckets
    return _TABLES[key]


STORED_SQL = f"SELECT {_event_id_sql('schema_version', 'provider', 'symbol', 'trading_date')} AS event_id, * FROM bars_big"


@query(
    "join_existing_price",
    with_ctes(
        f"""SELECT l.topic, l.partition, l.offset, s.event_id IS NOT NULL AS has_stored,
                   s.close AS stored_close, s.close IS NOT DISTINCT FROM l.p_close AS same_close
            FROM (SELECT *, {parse_date_sql('trading_date')} AS p_date, {parse_dec_sql('close')} AS p_close,
                         {event_reason_sql('log')} AS reason FROM log) l
            LEFT JOIN ({STORED_SQL}) s
              ON s.provider = l.provider AND s.symbol = l.symbol AND s.trading_date = l.p_date
            WHERE l.reason IS NULL""",
        "log",
        "bars_big",
    ),
)
def q_join_existing_price(spark, sf_dir):
    j = V.val_event_contract(B.log(spark, sf_dir)).where(F.col("reject_reason").isNull())
    ev = j.select("topic", "partition", "offset", "provider", "symbol", F.col("p_trading_date").alias("trading_date"), "p_close")
    met = price_table.meet_prices(ev, *stored_table(spark, sf_dir), ["event_id", "close"])
    return met.withColumnRenamed("close", "stored_close").select(
        "topic",
        "partition",
        "offset",
        F.col("event_id").isNotNull().alias("has_stored"),
        "stored_close",
        F.col("stored_close").eqNullSafe(F.col("p_close")).alias("same_close"),
    )


@query(
    "join_checkpoint",
    with_ctes(
        """SELECT l.topic, l.partition, l.offset, coalesce(c.next_offset, 0) AS next0,
                  l.offset < coalesce(c.next_offset, 0) AS is_stale
           FROM log l LEFT JOIN checkpoints c ON l.topic = c.topic AND l.partition = c.partition""",
        "checkpoints",
    ),
)
def q_join_checkpoint(spark, sf_dir):
    lg = B.log(spark, sf_dir)
    ck = guarded_broadcast(B.checkpoints(spark, sf_dir))
    j = lg.join(ck, ["topic", "partition"], "left").withColumn("next0", F.coalesce("next_offset", F.lit(0).cast("long")))
    return j.select("topic", "partition", "offset", "next0", (F.col("offset") < F.col("next0")).alias("is_stale"))


@query(
    "join_outbox_price",
    with_ctes(
        f"""SELECT o.event_id, o.object_key, p.symbol, p.trading_date, p.close
            FROM outbox o JOIN ({STORED_SQL}) p ON o.event_id = p.event_id
            WHERE o.attempt_count < 2 AND (o.status = 'pending' OR
                  (o.status = 'processing' AND o.claimed_at < TIMESTAMP '{B.OUTBOX_NOW}' - INTERVAL 5 MINUTE))""",
        "outbox",
        "bars_big",
    ),
)
def q_join_outbox_price(spark, sf_dir):
    claimed = V.flt_claimable(B.outbox(spark, sf_dir), F.lit(B.OUTBOX_NOW).cast("timestamp_ntz"), max_attempts=2)
    p = stored_prices(spark, sf_dir).select("event_id", "symbol", "trading_date", "close")
    return claimed.join(p, "event_id", "inner").select("event_id", "object_key", "symbol", "trading_date", "close")


# ---------------------------------------------------------------- manifests
def expected_manifest(spark, sf_dir, bars=None):
    """What a manifest promises for every supplier's file. Damage by fixed rule
    on the supplier key: tampered digest, wrong count, wrong first/last date,
    a file that was never written (suppliers without bars), an unsafe path."""
    s = B.table(spark, sf_dir, "supplier").select("s_suppkey")
    sym = F.concat(F.lit("S"), F.col("s_suppkey").cast("string"))
    actual = file_content_digest(B.bars_big(spark, sf_dir) if bars is None else bars)
    k = F.col("s_suppkey") % 11
    exp = s.withColumn("symbol", sym).join(actual, "symbol", "left")
    return exp.select(
        "symbol",
        F.when(k == 10, F.concat(F.lit("../"), F.col("symbol"), F.lit(".csv")))
        .otherwise(F.concat(F.col("symbol"), F.lit(".csv")))
        .alias("path"),
        F.when(k == 3, F.sha2(F.col("symbol"), 256)).otherwise(F.coalesce("sha256", F.sha2(F.col("symbol"), 256))).alias("sha256"),
        F.when(k == 5, F.col("row_count") + 1).otherwise(F.coalesce("row_count", F.lit(1).cast("long"))).alias("row_count"),
        F.when(k == 7, F.date_add("first_date", 1)).otherwise(F.coalesce("first_date", F.lit("2000-01-01").cast("date"))).alias("first_date"),
        F.when(k == 8, F.date_add("last_date", -1)).otherwise(F.coalesce("last_date", F.lit("2000-01-01").cast("date"))).alias("last_date"),
    )


def actual_files(spark, sf_dir):
    a = file_content_digest(B.bars_big(spark, sf_dir))
    return a.select(
        F.concat(F.col("symbol"), F.lit(".csv")).alias("path"),
        F.col("symbol").alias("a_symbol"),
        F.col("sha256").alias("a_sha256"),
        F.col("row_count").alias("a_row_count"),
        F.col("first_date").alias("a_first_date"),
        F.col("last_date").alias("a_last_date"),
    )


def verify_failures(expected, actual):
    """One failure per expected file, first in the fixed order: unsafe path,
    missing, checksum, encoding, header, rows, row count, symbol, first date, last date."""
    j = expected.join(actual, "path", "left")
    for c, sound in (("a_header", F.lit(HEADER)), ("a_utf8", F.lit(True)), ("a_fault", F.lit(None).cast("string"))):
        if c not in j.columns:
            j = j.withColumn(c, sound)
    reason = (
        F.when(V.unsafe_path(F.col("path")), F.concat(F.lit("unsafe path "), F.col("path")))
        .when(F.col("a_sha256").isNull(), F.concat(F.lit("missing "), F.col("path")))
        .when(F.col("a_sha256") != F.col("sha256"), F.concat(F.lit("checksum mismatch for "), F.col("path")))
        .when(~F.col("a_utf8"), F.concat(F.col("path"), F.lit(" is not UTF-8")))
        .when(F.col("a_header") != F.lit(HEADER), F.concat(F.col("path"), F.lit(" has a non-canonical header")))
        .when(F.col("a_fault").isNotNull(), F.concat("a_fault", F.lit(" in "), "path"))
        .when(F.col("a_row_count") != F.col("row_count"), F.concat(F.lit("row count mismatch for "), F.col("path")))
        .when(F.col("a_symbol") != F.col("symbol"), F.concat(F.lit("symbol mismatch for "), F.col("path")))
        .when(F.col("a_first_date") != F.col("first_date"), F.concat(F.lit("first date mismatch for "), F.col("path")))
        .when(F.col("a_last_date") != F.col("last_date"), F.concat(F.lit("last date mismatch for "), F.col("path")))
    )
    return j.select("symbol", "path", reason.alias("failure"))


HEADER = "symbol,trading_date,open,high,low,close,volume,currency"


def canon(x: str) -> str:
    return f"regexp_replace(CAST(CAST({x} AS DECIMAL(20,8)) AS VARCHAR), '\\.?0+$', '')"


ACTUAL_SQL = f"""
  SELECT symbol, count(*) AS row_count, min(trading_date) AS first_date, max(trading_date) AS last_date,
         sha256('{HEADER}' || chr(10) || string_agg(concat_ws(',', symbol, strftime(trading_date, '%Y-%m-%d'),
                {canon('open')}, {canon('high')}, {canon('low')}, {canon('close')}, CAST(volume AS VARCHAR), currency)
                || chr(10), '' ORDER BY trading_date)) AS sha256
  FROM bars_big GROUP BY symbol
"""
EXPECTED_SQL = f"""
  SELECT s.symbol,
         CASE WHEN s_suppkey % 11 = 10 THEN '../' || s.symbol || '.csv' ELSE s.symbol || '.csv' END AS path,
         CASE WHEN s_suppkey % 11 = 3 THEN sha256(s.symbol) ELSE coalesce(a.sha256, sha256(s.symbol)) END AS sha256,
         CASE WHEN s_suppkey % 11 = 5 THEN a.row_count + 1 ELSE coalesce(a.row_count, 1) END AS row_count,
         CASE WHEN s_suppkey % 11 = 7 THEN CAST(a.first_date + 1 AS DATE) ELSE coalesce(a.first_date, DATE '2000-01-01') END AS first_date,
         CASE WHEN s_suppkey % 11 = 8 THEN CAST(a.last_date - 1 AS DATE) ELSE coalesce(a.last_date, DATE '2000-01-01') END AS last_date
  FROM (SELECT s_suppkey, 'S' || CAST(s_suppkey AS VARCHAR) AS symbol FROM supplier) s
  LEFT JOIN actual a ON a.symbol = s.symbol
"""
VERIFY_SQL_BODY = """
  SELECT e.symbol, e.path,
    CASE WHEN e.path IS NULL OR length(e.path) = 0 OR starts_with(e.path, '/')
              OR regexp_matches(e.path, '(^|/)\\.\\.(/|$)') OR regexp_matches(e.path, '^[A-Za-z]:') THEN 'unsafe path ' || e.path
         WHEN a.sha256 IS NULL THEN 'missing ' || e.path
         WHEN a.sha256 <> e.sha256 THEN 'checksum mismatch for ' || e.path
         WHEN a.row_count <> e.row_count THEN 'row count mismatch for ' || e.path
         WHEN a.symbol <> e.symbol THEN 'symbol mismatch for ' || e.path
         WHEN a.first_date <> e.first_date THEN 'first date mismatch for ' || e.path
         WHEN a.last_date <> e.last_date THEN 'last date mismatch for ' || e.path END AS failure
  FROM expected e LEFT JOIN (SELECT *, symbol || '.csv' AS path FROM actual) a ON a.path = e.path
"""


def manifest_sql(body: str) -> str:
    base = with_ctes("SELECT 1", "bars_big")
    ctes = base[len("WITH ") : base.rindex("\nSELECT 1")]
    return f"WITH {ctes},\nactual AS ({ACTUAL_SQL}),\nexpected AS ({EXPECTED_SQL})\n{body}"


@query("join_manifest_actual", manifest_sql(VERIFY_SQL_BODY))
def q_join_manifest_actual(spark, sf_dir):
    return verify_failures(expected_manifest(spark, sf_dir), actual_files(spark, sf_dir))


@query(
    "join_expected_manifest",
    manifest_sql(
        """SELECT coalesce(e.path, b.path) AS path, e.path IS NULL AS only_built, b.path IS NULL AS only_expected,
                  (e.sha256 IS DISTINCT FROM b.sha256 OR e.row_count IS DISTINCT FROM b.row_count
                   OR e.first_date IS DISTINCT FROM b.first_date OR e.last_date IS DISTINCT FROM b.last_date
                   OR e.symbol IS DISTINCT FROM b.symbol) AS differs
           FROM expected e FULL OUTER JOIN (SELECT *, symbol || '.csv' AS path FROM actual) b ON e.path = b.path"""
    ),
)
def q_join_expected_manifest(spark, sf_dir):
    e = expected_manifest(spark, sf_dir)
    b = file_content_digest(B.bars_big(spark, sf_dir)).withColumn("path", F.concat(F.col("symbol"), F.lit(".csv")))
    cols = ["symbol", "sha256", "row_count", "first_date", "last_date"]
    j = e.select("path", *[F.col(c).alias(f"e_{c}") for c in cols], F.lit(True).alias("_e")).join(
        b.select("path", *[F.col(c).alias(f"b_{c}") for c in cols], F.lit(True).alias("_b")), "path", "full"
    )
    differs = F.lit(False)
    for c in cols:
        differs = differs | ~F.col(f"e_{c}").eqNullSafe(F.col(f"b_{c}"))
    return j.select(
        "path", F.col("_e").isNull().alias("only_built"), F.col("_b").isNull().alias("only_expected"), differs.alias("differs")
    )


@query(
    "join_lag",
    with_ctes(
        """SELECT e.topic, e.partition, e.end_offset, coalesce(c.next_offset, 0) AS next_offset,
                  e.end_offset - coalesce(c.next_offset, 0) AS lag
           FROM (SELECT topic, partition, max(offset) + 1 AS end_offset FROM log_redelivered GROUP BY topic, partition) e
           LEFT JOIN checkpoints c ON e.topic = c.topic AND e.partition = c.partition""",
        "log_redelivered",
        "checkpoints",
    ),
)
def q_join_lag(spark, sf_dir):
    ends = partition_ends(B.log_redelivered(spark, sf_dir)).drop("records")
    ck = B.checkpoints(spark, sf_dir)
    j = ends.join(ck, ["topic", "partition"], "left").withColumn("next_offset", F.coalesce("next_offset", F.lit(0).cast("long")))
    return j.select("topic", "partition", "end_offset", "next_offset", (F.col("end_offset") - F.col("next_offset")).alias("lag"))


@query(
    "join_archive_backlog",
    with_ctes(
        f"""SELECT p.event_id, p.symbol, p.trading_date FROM ({STORED_SQL}) p
            WHERE NOT EXISTS (SELECT 1 FROM outbox o WHERE o.event_id = p.event_id AND o.status = 'archived')""",
        "outbox",
        "bars_big",
    ),
)
def q_join_archive_backlog(spark, sf_dir):
    archived = B.outbox(spark, sf_dir).where(F.col("status") == "archived").select("event_id")
    p = stored_prices(spark, sf_dir).select("event_id", "symbol", "trading_date")
    return p.join(archived, "event_id", "left_anti")


@query(
    "join_fk_orphans",
    with_ctes(
        f"""SELECT o.event_id, o.object_key FROM outbox o
            WHERE NOT EXISTS (SELECT 1 FROM ({STORED_SQL}) p WHERE p.event_id = o.event_id AND p.trades > 1)""",
        "outbox",
        "bars_big",
    ),
)
def q_join_fk_orphans(spark, sf_dir):
    prices = stored_prices(spark, sf_dir).where(F.col("trades") > 1).select("event_id")
    return B.outbox(spark, sf_dir).join(prices, "event_id", "left_anti").select("event_id", "object_key")


@query(
    "join_fan_out",
    with_ctes(
        """SELECT l.topic, l.partition, l.offset, h.snapshot_id AS header_snapshot_id,
                  h.schema_version AS header_schema_version, h.currency AS header_currency
           FROM log l JOIN (SELECT provider, max(snapshot_id) AS snapshot_id, CAST(max(schema_version) AS INTEGER) AS schema_version,
                                   max(currency) AS currency FROM log GROUP BY provider) h
             ON l.provider = h.provider""",
        "log",
    ),
)
def q_join_fan_out(spark, sf_dir):
    lg = B.log(spark, sf_dir)
    header = lg.groupBy("provider").agg(
        F.max("snapshot_id").alias("header_snapshot_id"),
        F.max("schema_version").cast("int").alias("header_schema_version"),
        F.max("currency").alias("header_currency"),
    )
    # One header row per provider: bounded by the provider catalog, checked.
    return lg.join(guarded_broadcast(header), "provider", "inner").select(
        "topic", "partition", "offset", "header_snapshot_id", "header_schema_version", "header_currency"
    )
