"""Flagship query, scalar functions and predicates, bound to the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import scalar as fn
from tidemark.functions.codec import WIRE_FIELDS
from tidemark.operators import validation as V
from tidemark.plans import bindings as B
from tidemark.plans.bindings import _event_id_sql, _object_key_sql, with_ctes
from tidemark.plans.catalog import query
from tidemark.session import guarded_broadcast


def canon_sql(x: str) -> str:
    return f"regexp_replace(CAST(CAST({x} AS DECIMAL(20,8)) AS VARCHAR), '\\.?0+$', '')"


def row_reason_sql(expected: str = "symbol") -> str:
    return f"""CASE
      WHEN symbol <> {expected} THEN '{V.MSG_MULTIPLE_SYMBOLS}'
      WHEN line_no > min(line_no) OVER (PARTITION BY symbol, trading_date)
        THEN '{V.MSG_DUPLICATE_PREFIX}' || symbol || ' date: ' || strftime(trading_date, '%Y-%m-%d')
      WHEN least(open, high, low, close) <= 0 THEN '{V.MSG_NOT_POSITIVE}'
      WHEN low > high THEN '{V.MSG_LOW_ABOVE_HIGH}'
      WHEN low > least(open, close) OR high < greatest(open, close) THEN '{V.MSG_DAILY_RANGE}'
      WHEN volume < 0 THEN '{V.MSG_NEGATIVE_VOLUME}'
    END"""


DEC_RE = fn.DECIMAL_TEXT_PATTERN.replace("'", "''")


def parse_date_sql(x: str) -> str:
    return (
        f"(CASE WHEN regexp_matches({x}, '{fn.ISO_DATE_PATTERN}') THEN TRY_CAST({x} AS DATE) "
        f"WHEN regexp_matches({x}, '{fn.BASIC_DATE_PATTERN}') THEN CAST(try_strptime({x}, '%Y%m%d') AS DATE) END)"
    )


def parse_dec_sql(x: str) -> str:
    return f"(CASE WHEN regexp_matches({x}, '{DEC_RE}') THEN TRY_CAST({x} AS DECIMAL(20,8)) END)"


def event_reason_sql(src: str) -> str:
    """SQL twin of the event contract over a frame with wire columns."""
    pd_ = parse_date_sql("trading_date")
    po, ph, pl, pc = (parse_dec_sql(c) for c in ("open", "high", "low", "close"))
    text_ok = " AND ".join(
        [f"{pd_} IS NOT NULL"] + [f"coalesce(regexp_matches({c}, '{DEC_RE}'), false)" for c in ("open", "high", "low", "close")]
    )
    prices_ok = " AND ".join(f"{p} IS NOT NULL" for p in (po, ph, pl, pc))
    required = " AND ".join(
        [f"coalesce(length({c}) > 0, false)" for c in ("event_id", "provider", "symbol", "currency", "snapshot_id")]
        + ["schema_version >= 1"]
    )
    wide = " OR ".join(
        ["schema_version > 2147483647"] + [f"coalesce(length({c}) > {w}, false)" for c, w in V.WIDTHS.items()]
    )
    return f"""CASE
      WHEN NOT ({text_ok}) THEN '{V.EV_BAD_TEXT}'
      WHEN NOT ({prices_ok}) THEN '{V.EV_OUT_OF_RANGE}'
      WHEN NOT ({required}) THEN '{V.EV_MISSING_IDENTITY}'
      WHEN event_id <> {_event_id_sql("schema_version", "provider", "symbol", pd_)} THEN '{V.EV_WRONG_ID}'
      WHEN currency <> upper(currency) OR length(currency) <> 3 THEN '{V.EV_BAD_CURRENCY}'
      WHEN symbol <> upper(symbol) THEN '{V.EV_LOWER_SYMBOL}'
      WHEN volume < 0 OR least({po}, {ph}, {pl}, {pc}) <= 0 THEN '{V.EV_NOT_POSITIVE}'
      WHEN {pl} > least({po}, {pc}) OR {ph} < greatest({po}, {pc}) THEN '{V.EV_BOUNDS}'
      WHEN {wide} THEN '{V.EV_OUT_OF_RANGE}'
    END"""


# ------------------------------------------------------------------ flagship
ENTRY_SQL = with_ctes(
    f"""SELECT {_event_id_sql("schema_version", "provider", "symbol", "trading_date")} AS event_id,
       schema_version, provider, symbol, trading_date, open, high, low, close, volume, currency,
       snapshot_id, {row_reason_sql()} AS reject_reason
    FROM bars""",
    "bars",
)


def entry_bars(spark, sf_dir):
    """events -> daily bars -> row contract -> identity hash, in replay order."""
    judged = V.val_row_contract(B.bars(spark, sf_dir))
    return judged.select(
        fn.event_id("schema_version", "provider", "symbol", "trading_date").alias("event_id"),
        "schema_version",
        "provider",
        "symbol",
        "trading_date",
        "open",
        "high",
        "low",
        "close",
        "volume",
        "currency",
        "snapshot_id",
        "reject_reason",
    ).orderBy("trading_date", "symbol")


query("entry_bars", ENTRY_SQL)(entry_bars)


# ------------------------------------------------------------------ scalars
@query(
    "fn_event_id",
    with_ctes(
        f"SELECT symbol, trading_date, {_event_id_sql('schema_version', 'provider', 'symbol', 'trading_date')} AS event_id FROM bars_big",
        "bars_big",
    ),
)
def q_fn_event_id(spark, sf_dir):
    b = B.bars_big(spark, sf_dir)
    return b.select("symbol", "trading_date", fn.event_id("schema_version", "provider", "symbol", "trading_date").alias("event_id"))


@query("fn_sha256_bytes", "SELECT doc_id, sha256(text) AS text_sha256, n_chars FROM documents")
def q_fn_sha256(spark, sf_dir):
    d = B.table(spark, sf_dir, "documents")
    return d.select("doc_id", fn.sha256_hex("text").alias("text_sha256"), "n_chars")


@query(
    "fn_canonical_decimal",
    with_ctes(
        f"""SELECT symbol, trading_date, {canon_sql('open')} AS open_text, {canon_sql('high')} AS high_text,
                   {canon_sql('low')} AS low_text, {canon_sql('close')} AS close_text,
                   {canon_sql('CAST(volume AS DECIMAL(20,8)) / 100')} AS lots_text
            FROM bars_big""",
        "bars_big",
    ),
)
def q_fn_canonical_decimal(spark, sf_dir):
    b = B.bars_big(spark, sf_dir)
    return b.select(
        "symbol",
        "trading_date",
        *[fn.canonical_decimal(c).alias(f"{c}_text") for c in ("open", "high", "low", "close")],
        fn.canonical_decimal(fn.to_price("volume") / 100).alias("lots_text"),
    )


@query(
    "fn_parse_decimal",
    with_ctes(
        f"""SELECT topic, partition, offset, {parse_dec_sql('open')} AS open, {parse_dec_sql('high')} AS high,
                   {parse_dec_sql('low')} AS low, {parse_dec_sql('close')} AS close,
                   {parse_dec_sql("' ' || close || 'e0 '")} AS close_padded
            FROM log""",
        "log",
    ),
)
def q_fn_parse_decimal(spark, sf_dir):
    lg = B.log(spark, sf_dir)
    return lg.select(
        "topic",
        "partition",
        "offset",
        *[fn.parse_decimal(c).alias(c) for c in ("open", "high", "low", "close")],
        fn.parse_decimal(F.concat(F.lit(" "), F.col("close"), F.lit("e0 "))).alias("close_padded"),
    )


@query(
    "fn_parse_date",
    with_ctes(
        f"""SELECT topic, partition, offset, {parse_date_sql('trading_date')} AS trading_date,
                   {parse_date_sql("replace(trading_date, '-', '')")} AS basic_date,
                   {parse_date_sql("trading_date || 'T00:00:00'")} AS with_time
            FROM log""",
        "log",
    ),
)
def q_fn_parse_date(spark, sf_dir):
    lg = B.log(spark, sf_dir)
    return lg.select(
        "topic",
        "partition",
        "offset",
        fn.parse_date("trading_date").alias("trading_date"),
        fn.parse_date(F.regexp_replace("trading_date", "-", "")).alias("basic_date"),
        fn.parse_date(F.concat("trading_date", F.lit("T00:00:00"))).alias("with_time"),
    )


LONG_RE = fn.LONG_TEXT_PATTERN


@query(
    "fn_parse_long",
    f"""SELECT c_custkey,
               CASE WHEN regexp_matches(substr(c_name, 10), '{LONG_RE}') THEN TRY_CAST(substr(c_name, 10) AS BIGINT) END AS number,
               CASE WHEN regexp_matches(c_name, '{LONG_RE}') THEN TRY_CAST(c_name AS BIGINT) END AS whole_name
        FROM customer""",
)
def q_fn_parse_long(spark, sf_dir):
    c = B.table(spark, sf_dir, "customer")
    return c.select(
        "c_custkey",
        fn.parse_long(F.substring("c_name", 10, 1 << 20)).alias("number"),
        fn.parse_long("c_name").alias("whole_name"),
    )


@query("fn_iso_date", "SELECT event_id, strftime(CAST(ts AS DATE), '%Y-%m-%d') AS iso_date FROM events")
def q_fn_iso_date(spark, sf_dir):
    e = B.table(spark, sf_dir, "events")
    return e.select("event_id", fn.iso_date(F.to_date("ts")).alias("iso_date"))


@query(
    "fn_year",
    "SELECT o_orderkey, CAST(year(CAST(o_orderdate AS DATE)) AS INTEGER) AS year FROM orders",
)
def q_fn_year(spark, sf_dir):
    o = B.table(spark, sf_dir, "orders")
    return o.select("o_orderkey", fn.year_of(F.to_date("o_orderdate")).alias("year"))


@query(
    "fn_upper_trim",
    """SELECT c_custkey, upper(trim('  ' || lower(c_mktsegment) || ' ')) AS segment,
              lower(trim(' ' || c_mktsegment || '  ')) AS segment_lower FROM customer""",
)
def q_fn_upper_trim(spark, sf_dir):
    c = B.table(spark, sf_dir, "customer")
    return c.select(
        "c_custkey",
        fn.upper_trim(F.concat(F.lit("  "), F.lower("c_mktsegment"), F.lit(" "))).alias("segment"),
        fn.lower_trim(F.concat(F.lit(" "), F.col("c_mktsegment"), F.lit("  "))).alias("segment_lower"),
    )


def order_symbol_lists(spark, sf_dir):
    """Per order: the symbols of its suppliers as a vendor would type them.
    One order has a bounded number of lines, so the list is bounded."""
    li = B.table(spark, sf_dir, "lineitem")
    return li.groupBy("l_orderkey").agg(
        F.collect_list(F.concat(F.lit(" s"), F.col("l_suppkey").cast("string"), F.lit(" "))).alias("symbols")
    )


ORDER_SYMBOLS_SQL = "SELECT l_orderkey, list(' s' || CAST(l_suppkey AS VARCHAR) || ' ') AS symbols FROM lineitem GROUP BY l_orderkey"


@query(
    "fn_normalize_symbols",
    f"""SELECT l_orderkey, array_to_string(list_sort(list_transform(symbols, lambda x: upper(trim(x)))), ',') AS symbols,
               len(list_distinct(list_transform(symbols, lambda x: upper(trim(x))))) = len(symbols) AS unique_symbols
        FROM ({ORDER_SYMBOLS_SQL}) s""",
)
def q_fn_normalize_symbols(spark, sf_dir):
    s = order_symbol_lists(spark, sf_dir)
    return s.select(
        "l_orderkey",
        F.array_join(fn.normalize_symbols("symbols"), ",").alias("symbols"),
        fn.symbols_unique("symbols").alias("unique_symbols"),
    )


@query(
    "fn_snapshot_id",
    "SELECT doc_id, source || '-' || substr(sha256(text), 1, 12) AS snapshot_id FROM documents",
)
def q_fn_snapshot_id(spark, sf_dir):
    d = B.table(spark, sf_dir, "documents")
    return d.select("doc_id", fn.snapshot_id("source", fn.sha256_hex("text")).alias("snapshot_id"))


@query(
    "fn_object_key",
    with_ctes(
        f"""SELECT symbol, trading_date,
               {_object_key_sql('provider', 'symbol', 'trading_date', _event_id_sql('schema_version', 'provider', 'symbol', 'trading_date'))} AS object_key
            FROM bars_big""",
        "bars_big",
    ),
)
def q_fn_object_key(spark, sf_dir):
    b = B.bars_big(spark, sf_dir)
    eid = fn.event_id("schema_version", "provider", "symbol", "trading_date")
    return b.select("symbol", "trading_date", fn.object_key("provider", "symbol", "trading_date", eid).alias("object_key"))


@query(
    "fn_dlq_key",
    with_ctes("SELECT topic || ':' || CAST(partition AS VARCHAR) || ':' || CAST(offset AS VARCHAR) AS dlq_key FROM log", "log"),
)
def q_fn_dlq_key(spark, sf_dir):
    return B.log(spark, sf_dir).select(fn.dlq_key("topic", "partition", "offset").alias("dlq_key"))


def log_value_sql() -> str:
    cols = " || '|' || ".join(
        f"CAST({c} AS VARCHAR)" if c in ("schema_version", "volume") else c for c in B.WIRE_COLS
    )
    return f"encode({cols})"


def wire_hex_sql(cols: dict[str, str]) -> str:
    """SQL twin of the proto3 encoding as upper-case hex: ``cols`` gives each wire
    field's SQL. Texts of up to 127 bytes and numbers from 0 up, as the bindings have."""
    parts = []
    for name, number, kind in WIRE_FIELDS:
        x = cols[name]
        if kind == "string":
            parts.append(f"CASE WHEN {x} <> '' THEN '{number << 3 | 2:02X}' || lpad(hex(strlen({x})), 2, '0') || hex({x}) ELSE '' END")
        else:
            v = f"CAST({x} AS BIGINT)"
            groups = f"""array_to_string([lpad(hex((({v} >> (7 * i)) & 127) + CASE WHEN ({v} >> (7 * i + 7)) > 0 THEN 128 ELSE 0 END), 2, '0')
                         FOR i IN [0, 1, 2, 3, 4, 5, 6, 7] IF i = 0 OR ({v} >> (7 * i)) > 0], '')"""
            parts.append(f"CASE WHEN {v} <> 0 THEN '{number << 3:02X}' || {groups} ELSE '' END")
    return "(" + " || ".join(parts) + ")"


def log_value():
    return F.concat_ws("|", *[F.col(c).cast("string") for c in B.WIRE_COLS]).cast("binary")


@query(
    "fn_dlq_envelope",
    with_ctes(
        f"""SELECT topic, partition, offset,
               CAST(json_object('error', reason, 'error_type', 'InvalidMarketEvent',
                    'key_base64', to_base64(encode(symbol)), 'schema_version', 1,
                    'source', json_object('offset', offset, 'partition', partition, 'topic', topic),
                    'value_base64', to_base64({log_value_sql()})) AS VARCHAR) AS payload
            FROM (SELECT *, {event_reason_sql('log')} AS reason FROM log) j
            WHERE reason IS NOT NULL""",
        "log",
    ),
)
def q_fn_dlq_envelope(spark, sf_dir):
    j = V.val_event_contract(B.log(spark, sf_dir).withColumn("value", log_value()))
    bad = j.where(F.col("reject_reason").isNotNull())
    return bad.select(
        "topic",
        "partition",
        "offset",
        fn.dlq_envelope(
            "topic", "partition", "offset", "key", "value", F.lit("InvalidMarketEvent"), "reject_reason"
        ).alias("payload"),
    )


@query(
    "fn_build_event",
    with_ctes(
        f"""SELECT {_event_id_sql('schema_version', 'provider', 'symbol', 'trading_date')} AS event_id,
               CAST(schema_version AS BIGINT) AS schema_version, provider, symbol,
               strftime(trading_date, '%Y-%m-%d') AS trading_date,
               {canon_sql('open')} AS open, {canon_sql('high')} AS high, {canon_sql('low')} AS low,
               {canon_sql('close')} AS close, volume, currency, snapshot_id
            FROM bars_big""",
        "bars_big",
    ),
)
def q_fn_build_event(spark, sf_dir):
    from tidemark.plans.replay import build_events

    return build_events(B.bars_big(spark, sf_dir))


@query(
    "fn_canonical_row",
    with_ctes(
        f"""SELECT symbol, strftime(trading_date, '%Y-%m-%d') AS trading_date_text,
               concat_ws(',', symbol, strftime(trading_date, '%Y-%m-%d'), {canon_sql('open')}, {canon_sql('high')},
                         {canon_sql('low')}, {canon_sql('close')}, CAST(volume AS VARCHAR), currency) AS csv_line
            FROM bars_big""",
        "bars_big",
    ),
)
def q_fn_canonical_row(spark, sf_dir):
    from tidemark.sinks.files import canonical_line

    b = B.bars_big(spark, sf_dir)
    return b.select("symbol", fn.iso_date("trading_date").alias("trading_date_text"), canonical_line().alias("csv_line"))


@query(
    "fn_truncate_error",
    "SELECT doc_id, substr(text, 1, 2000) AS error, length(substr(text, 1, 2000)) AS error_chars FROM documents",
)
def q_fn_truncate_error(spark, sf_dir):
    d = B.table(spark, sf_dir, "documents")
    t = fn.truncate_error("text")
    return d.select("doc_id", t.alias("error"), F.length(t).alias("error_chars"))


# --------------------------------------------------------------- predicates
def requested_symbols(spark, sf_dir, region: int = 2):
    """The symbols a request names: suppliers of one region (nation is a
    fixed 25-row dimension; the symbol list grows with the suppliers)."""
    s = B.table(spark, sf_dir, "supplier")
    n = B.table(spark, sf_dir, "nation").where(F.col("n_regionkey") == region)
    return s.join(guarded_broadcast(n), s.s_nationkey == n.n_nationkey, "left_semi").select(
        F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("symbol")
    )


REQUESTED_SQL = """SELECT 'S' || CAST(s_suppkey AS VARCHAR) AS symbol FROM supplier
                   WHERE s_nationkey IN (SELECT n_nationkey FROM nation WHERE n_regionkey = 2)"""


@query(
    "flt_symbol",
    with_ctes(
        f"""SELECT symbol, trading_date, close FROM bars_big
            WHERE upper(trim(' ' || lower(symbol) || ' ')) IN ({REQUESTED_SQL})""",
        "bars_big",
    ),
)
def q_flt_symbol(spark, sf_dir):
    b = B.bars_big(spark, sf_dir).withColumn("name", F.concat(F.lit(" "), F.lower("symbol"), F.lit(" ")))
    kept = V.flt_symbol(b, requested_symbols(spark, sf_dir))
    return kept.select("symbol", "trading_date", "close")


@query(
    "flt_date_interval",
    with_ctes(
        "SELECT symbol, trading_date, close FROM bars_big WHERE trading_date BETWEEN DATE '1996-01-01' AND DATE '1996-12-31'",
        "bars_big",
    ),
)
def q_flt_date_interval(spark, sf_dir):
    b = B.bars_big(spark, sf_dir)
    return V.flt_date_interval(b, "1996-01-01", "1996-12-31").select("symbol", "trading_date", "close")


@query(
    "flt_empty_symbol",
    with_ctes(
        f"""SELECT symbol FROM ({REQUESTED_SQL}) r
            WHERE symbol NOT IN (SELECT symbol FROM bars_big
                                 WHERE trading_date BETWEEN DATE '1996-03-01' AND DATE '1996-03-07')""",
        "bars_big",
    ),
)
def q_flt_empty_symbol(spark, sf_dir):
    b = V.flt_date_interval(B.bars_big(spark, sf_dir), "1996-03-01", "1996-03-07")
    return requested_symbols(spark, sf_dir).join(b.select("symbol"), "symbol", "left_anti")


@query(
    "flt_claimable",
    with_ctes(
        f"""SELECT event_id, status, attempt_count FROM outbox
            WHERE attempt_count < 2 AND (status = 'pending' OR
                  (status = 'processing' AND claimed_at < TIMESTAMP '{B.OUTBOX_NOW}' - INTERVAL 5 MINUTE))""",
        "outbox",
    ),
)
def q_flt_claimable(spark, sf_dir):
    o = B.outbox(spark, sf_dir)
    return V.flt_claimable(o, F.lit(B.OUTBOX_NOW).cast("timestamp_ntz"), max_attempts=2).select(
        "event_id", "status", "attempt_count"
    )


@query(
    "val_row_contract",
    with_ctes(
        f"SELECT file_symbol, symbol, trading_date, line_no, {row_reason_sql('file_symbol')} AS reject_reason FROM bars_dirty",
        "bars_dirty",
    ),
)
def q_val_row_contract(spark, sf_dir):
    d = B.bars_dirty(spark, sf_dir)
    j = V.val_row_contract(d, expected_symbol=F.col("file_symbol"))
    return j.select("file_symbol", "symbol", "trading_date", "line_no", "reject_reason")


@query(
    "val_event_contract",
    with_ctes(f"SELECT topic, partition, offset, {event_reason_sql('log')} AS reject_reason FROM log", "log"),
)
def q_val_event_contract(spark, sf_dir):
    j = V.val_event_contract(B.log(spark, sf_dir))
    return j.select("topic", "partition", "offset", "reject_reason")


def order_requests(spark, sf_dir):
    """One dataset request per order: its suppliers as symbols, its order date
    to its last ship date, currency from the order status."""
    o = B.table(spark, sf_dir, "orders")
    li = B.table(spark, sf_dir, "lineitem")
    per = li.groupBy("l_orderkey").agg(
        F.collect_list(F.concat(F.lit(" s"), F.col("l_suppkey").cast("string"), F.lit(" "))).alias("symbols"),
        F.max(F.to_date("l_shipdate")).alias("end_date"),
    )
    return o.join(per, o.o_orderkey == per.l_orderkey, "inner").select(
        F.col("o_orderkey").alias("request_id"),
        (F.col("o_orderkey") % 5).cast("int").alias("schema_version"),
        F.when(F.col("o_orderstatus") == "P", F.concat(F.lit("Order-"), F.col("o_orderkey").cast("string")))
        .otherwise(F.concat(F.lit("order-"), F.col("o_orderkey").cast("string")))
        .alias("dataset_id"),
        F.lit("lineitem").alias("provider"),
        "symbols",
        F.to_date("o_orderdate").alias("start_date"),
        "end_date",
        F.when(F.col("o_orderstatus") == "O", F.lit("usd")).otherwise(F.lit("usdx")).alias("currency"),
    )


ORDER_REQUESTS_SQL = """
  SELECT o_orderkey AS request_id, CAST(o_orderkey % 5 AS INTEGER) AS schema_version,
         CASE WHEN o_orderstatus = 'P' THEN 'Order-' ELSE 'order-' END || CAST(o_orderkey AS VARCHAR) AS dataset_id,
         'lineitem' AS provider, symbols, CAST(o_orderdate AS DATE) AS start_date, end_date,
         CASE WHEN o_orderstatus = 'O' THEN 'usd' ELSE 'usdx' END AS currency
  FROM orders JOIN (SELECT l_orderkey, list(' s' || CAST(l_suppkey AS VARCHAR) || ' ') AS symbols,
                           max(CAST(l_shipdate AS DATE)) AS end_date
                    FROM lineitem GROUP BY l_orderkey) l ON o_orderkey = l_orderkey
"""


@query(
    "val_request",
    f"""SELECT request_id,
          CASE WHEN schema_version < 1 THEN '{V.RQ_VERSION}'
               WHEN NOT regexp_matches(dataset_id, '{fn.DATASET_ID_PATTERN}') THEN '{V.RQ_DATASET}'
               WHEN len(symbols) < 1 THEN '{V.RQ_NO_SYMBOLS}'
               WHEN len(list_distinct(list_transform(symbols, lambda x: upper(trim(x))))) <> len(symbols) THEN '{V.RQ_DUP_SYMBOLS}'
               WHEN length(currency) <> 3 THEN '{V.RQ_CURRENCY}'
               WHEN start_date > end_date THEN '{V.RQ_INTERVAL}' END AS reject_reason,
          array_to_string(list_sort(list_transform(symbols, lambda x: upper(trim(x)))), ',') AS norm_symbols,
          upper(currency) AS norm_currency
        FROM ({ORDER_REQUESTS_SQL}) r""",
)
def q_val_request(spark, sf_dir):
    r = V.val_request(order_requests(spark, sf_dir))
    return r.select("request_id", "reject_reason", F.array_join("norm_symbols", ",").alias("norm_symbols"), "norm_currency")


def order_manifest_files(spark, sf_dir):
    """One snapshot manifest per order, one file entry per line: symbol, path,
    a content hash (damaged for some lines) and a row count."""
    li = B.table(spark, sf_dir, "lineitem")
    sym = F.concat(F.lit("S"), F.col("l_suppkey").cast("string"))
    return li.select(
        F.col("l_orderkey").alias("manifest_id"),
        sym.alias("symbol"),
        F.concat(sym, F.lit(".csv")).alias("path"),
        F.when(F.col("l_linenumber") == 7, F.upper(fn.sha256_hex(sym))).otherwise(fn.sha256_hex(sym)).alias("sha256"),
        (F.col("l_quantity").cast("long") - 3).alias("row_count"),
    )


ORDER_FILES_SQL = """
  SELECT l_orderkey AS manifest_id, 'S' || CAST(l_suppkey AS VARCHAR) AS symbol,
         'S' || CAST(l_suppkey AS VARCHAR) || '.csv' AS path,
         CASE WHEN l_linenumber = 7 THEN upper(sha256('S' || CAST(l_suppkey AS VARCHAR)))
              ELSE sha256('S' || CAST(l_suppkey AS VARCHAR)) END AS sha256,
         CAST(l_quantity AS BIGINT) - 3 AS row_count
  FROM lineitem
"""


@query(
    "val_manifest",
    f"""SELECT manifest_id, count(*) AS files, count(DISTINCT symbol) AS distinct_symbols,
               count(DISTINCT path) AS distinct_paths,
               CASE WHEN min(file_reason) IS NOT NULL THEN min(file_reason)
                    WHEN count(DISTINCT symbol) <> count(*) OR count(DISTINCT path) <> count(*) THEN '{V.MF_UNIQUE}'
               END AS reject_reason
        FROM (SELECT *, CASE WHEN NOT regexp_matches(sha256, '{fn.SHA256_PATTERN}') THEN '{V.MF_SHA}'
                             WHEN row_count <= 0 THEN '{V.MF_ROWS}' END AS file_reason
              FROM ({ORDER_FILES_SQL}) f) j
        GROUP BY manifest_id""",
)
def q_val_manifest(spark, sf_dir):
    m = V.val_manifest(order_manifest_files(spark, sf_dir), ["manifest_id"])
    return m.select("manifest_id", "files", "distinct_symbols", "distinct_paths", "reject_reason")


def page_paths(spark, sf_dir):
    """Relative paths taken from page URLs (path part after the host), some
    made unsafe by a fixed rule."""
    p = B.table(spark, sf_dir, "pages")
    path = F.regexp_extract("url", r"^https?://[^/]+/([^?#]*)", 1)
    return p.select(
        "page_id",
        F.when(F.col("page_id") % 9 == 4, F.concat(F.lit("../"), path))
        .when(F.col("page_id") % 9 == 7, F.concat(F.lit("/"), path))
        .when(F.col("page_id") % 9 == 8, F.concat(path, F.lit("/../../x")))
        .otherwise(path)
        .alias("path"),
    )


PAGE_PATHS_SQL = """
  SELECT page_id, CASE WHEN page_id % 9 = 4 THEN '../' || p WHEN page_id % 9 = 7 THEN '/' || p
                       WHEN page_id % 9 = 8 THEN p || '/../../x' ELSE p END AS path
  FROM (SELECT page_id, regexp_extract(url, '^https?://[^/]+/([^?#]*)', 1) AS p FROM pages) s
"""


@query(
    "val_paths",
    f"""SELECT page_id, path,
               (path IS NULL OR length(path) = 0 OR starts_with(path, '/')
                OR regexp_matches(path, '(^|/)\\.\\.(/|$)') OR regexp_matches(path, '^[A-Za-z]:')) AS unsafe
        FROM ({PAGE_PATHS_SQL}) s""",
)
def q_val_paths(spark, sf_dir):
    p = page_paths(spark, sf_dir)
    return p.select("page_id", "path", V.unsafe_path(F.col("path")).alias("unsafe"))
