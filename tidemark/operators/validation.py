"""Row and event contracts.

Each contract is one chained ``when`` that yields the *first* failing rule in
the fixed order, so a row carries exactly one reason (NULL = valid). The
reference stops at the first bad row of a file; here every row is judged in one
pass and the file verdict is the reason of its first failing row in date order
(``first_failure``).
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import scalar as fn
from tidemark.schemas import PRICE_FIELDS

# Row-contract messages, in rule order.
MSG_MULTIPLE_SYMBOLS = "a file contains multiple symbols"
MSG_DUPLICATE_PREFIX = "duplicate "  # + "{symbol} date: {YYYY-MM-DD}"
MSG_NOT_POSITIVE = "prices must be positive"
MSG_LOW_ABOVE_HIGH = "low must not exceed high"
MSG_DAILY_RANGE = "OHLC values violate the daily range"
MSG_NEGATIVE_VOLUME = "volume must be non-negative"

# Event-contract messages, in rule order.
EV_NOT_DECODABLE = "payload is not valid MarketEvent protobuf"
EV_BAD_TEXT = "event contains an invalid date or decimal"
EV_OUT_OF_RANGE = "event contains a value out of the stored range"
EV_MISSING_IDENTITY = "event is missing required identity fields"
EV_WRONG_ID = "event_id does not match the logical event identity"
EV_BAD_CURRENCY = "currency must be a three-letter uppercase code"
EV_LOWER_SYMBOL = "symbol must be uppercase"
EV_NOT_POSITIVE = "OHLC prices must be positive and volume non-negative"
EV_BOUNDS = "OHLC bounds are inconsistent"

# Stored column widths (enforced as predicates; Spark has no
# VARCHAR(n) check on Parquet).
WIDTHS = {"provider": 64, "symbol": 16, "event_id": 64, "currency": 3, "snapshot_id": 128}
INT32_MAX = 2**31 - 1


def _min_price(df_cols: Iterable[str] = PRICE_FIELDS) -> Column:
    return F.least(*[F.col(c) for c in df_cols])


def duplicate_flag(df: DataFrame, key: list[str], order_col: str) -> DataFrame:
    """Add ``is_duplicate``: a later row (by ``order_col``) of an already seen key.

    Skew-safe: the first position per key is a partial aggregate (map-side
    combine shrinks a hot key to one row per task) joined back on the key, so
    no window ever has to hold one key's rows in one task.
    """
    first = df.groupBy(*key).agg(F.min(order_col).alias("_first_pos"))
    return (
        df.join(first, on=key, how="left")
        .withColumn("is_duplicate", F.col(order_col) > F.col("_first_pos"))
        .drop("_first_pos")
    )


def row_contract_reason(expected_symbol: Column) -> Column:
    """First failing row rule; expects typed columns and ``is_duplicate``."""
    o, h, lo, c = (F.col(x) for x in ("open", "high", "low", "close"))
    return (
        F.when(F.col("symbol") != expected_symbol, F.lit(MSG_MULTIPLE_SYMBOLS))
        .when(
            F.col("is_duplicate"),
            F.concat(F.lit(MSG_DUPLICATE_PREFIX), F.col("symbol"), F.lit(" date: "), fn.iso_date("trading_date")),
        )
        .when(_min_price() <= 0, F.lit(MSG_NOT_POSITIVE))
        .when(lo > h, F.lit(MSG_LOW_ABOVE_HIGH))
        .when((lo > F.least(o, c)) | (h < F.greatest(o, c)), F.lit(MSG_DAILY_RANGE))
        .when(F.col("volume") < 0, F.lit(MSG_NEGATIVE_VOLUME))
    )


def val_row_contract(
    rows: DataFrame,
    expected_symbol: Column | None = None,
    order_col: str = "line_no",
) -> DataFrame:
    """Judge typed OHLCV rows; adds ``reject_reason`` (NULL when valid).

    ``rows`` needs symbol, trading_date, open..close, volume and an ordering
    column (source position); duplicates are later rows of the same
    (symbol, trading_date). ``expected_symbol`` defaults to the row's own
    symbol (one file per symbol).
    """
    expected = expected_symbol if expected_symbol is not None else F.col("symbol")
    flagged = duplicate_flag(rows, ["symbol", "trading_date"], order_col)
    return flagged.withColumn("reject_reason", row_contract_reason(expected)).drop("is_duplicate")


def first_failure(judged: DataFrame, group: list[str]) -> DataFrame:
    """Per group (e.g. file): the reason of the first failing row in date order.

    ``min_by`` is a partial aggregate, so this is one small shuffle.
    """
    return (
        judged.where(F.col("reject_reason").isNotNull())
        .groupBy(*group)
        .agg(
            F.min_by(
                "reject_reason", F.struct("trading_date", F.col("line_no"))
            ).alias("first_reason"),
            F.count(F.lit(1)).alias("failing_rows"),
        )
    )


def parse_wire_event(wire: DataFrame) -> DataFrame:
    """Typed columns ``p_*`` parsed from the wire text fields."""
    out = wire.withColumn("p_trading_date", fn.parse_date("trading_date"))
    for c in PRICE_FIELDS:
        out = out.withColumn(f"p_{c}", fn.parse_decimal(c))
    return out


def event_contract_reason(decodable: Column | None = None) -> Column:
    """First failing event rule on a frame from ``parse_wire_event``."""
    prices_ok = F.col("p_open").isNotNull()
    for c in PRICE_FIELDS[1:]:
        prices_ok = prices_ok & F.col(f"p_{c}").isNotNull()
    text_ok = F.col("p_trading_date").isNotNull()
    for c in PRICE_FIELDS:
        # What parsed is a decimal; only what did not is looked at again.
        text_ok = text_ok & (F.col(f"p_{c}").isNotNull() | F.coalesce(F.col(c).rlike(fn.DECIMAL_TEXT_PATTERN), F.lit(False)))
    required = F.lit(True)
    for c in ("event_id", "provider", "symbol", "currency", "snapshot_id"):
        required = required & F.coalesce(F.length(F.col(c)) > 0, F.lit(False))
    required = required & (F.col("schema_version") >= 1)
    expected_id = fn.event_id("schema_version", "provider", "symbol", "p_trading_date")
    too_wide = F.col("schema_version") > INT32_MAX
    for c, w in WIDTHS.items():
        too_wide = too_wide | F.coalesce(F.length(F.col(c)) > w, F.lit(False))
    po, ph, pl, pc = (F.col(f"p_{x}") for x in ("open", "high", "low", "close"))
    chain = F.when(F.lit(False), F.lit(None).cast("string"))
    if decodable is not None:
        chain = F.when(~decodable, F.lit(EV_NOT_DECODABLE))
    return (
        chain.when(~text_ok, F.lit(EV_BAD_TEXT))
        .when(~prices_ok, F.lit(EV_OUT_OF_RANGE))
        .when(~required, F.lit(EV_MISSING_IDENTITY))
        .when(F.col("event_id") != expected_id, F.lit(EV_WRONG_ID))
        .when((F.col("currency") != F.upper("currency")) | (F.length("currency") != 3), F.lit(EV_BAD_CURRENCY))
        .when(F.col("symbol") != F.upper("symbol"), F.lit(EV_LOWER_SYMBOL))
        .when((F.col("volume") < 0) | (F.least(po, ph, pl, pc) <= 0), F.lit(EV_NOT_POSITIVE))
        .when((pl > F.least(po, pc)) | (ph < F.greatest(po, pc)), F.lit(EV_BOUNDS))
        .when(too_wide, F.lit(EV_OUT_OF_RANGE))
    )


def val_event_contract(wire: DataFrame, decodable: Column | None = None) -> DataFrame:
    """Wire events -> typed events + ``reject_reason`` (NULL when valid).

    Output keeps the wire columns it was given and adds the typed twelve
    fields under their own names prefixed ``p_`` plus ``reject_reason``.
    """
    parsed = parse_wire_event(wire)
    return parsed.withColumn("reject_reason", fn.fenced(event_contract_reason(decodable)))


def typed_event_columns() -> list[Column]:
    """The twelve typed event fields from a ``val_event_contract`` frame."""
    return [
        F.col("event_id"),
        F.col("schema_version").cast("int").alias("schema_version"),
        F.col("provider"),
        F.col("symbol"),
        F.col("p_trading_date").alias("trading_date"),
        F.col("p_open").alias("open"),
        F.col("p_high").alias("high"),
        F.col("p_low").alias("low"),
        F.col("p_close").alias("close"),
        F.col("volume"),
        F.col("currency"),
        F.col("snapshot_id"),
    ]


# Request-contract messages, in rule order.
RQ_VERSION = "schema_version must be at least 1"
RQ_DATASET = "dataset_id does not match ^[a-z0-9][a-z0-9-]+$"
RQ_NO_SYMBOLS = "symbols must not be empty"
RQ_DUP_SYMBOLS = "symbols must be unique"
RQ_CURRENCY = "currency must be 3 characters"
RQ_INTERVAL = "start_date must not be after end_date"


def request_reason() -> Column:
    """First failing rule of a dataset request row."""
    return (
        F.when(F.col("schema_version") < 1, F.lit(RQ_VERSION))
        .when(~F.col("dataset_id").rlike(fn.DATASET_ID_PATTERN), F.lit(RQ_DATASET))
        .when(F.size("symbols") < 1, F.lit(RQ_NO_SYMBOLS))
        .when(~fn.symbols_unique("symbols"), F.lit(RQ_DUP_SYMBOLS))
        .when(F.length("currency") != 3, F.lit(RQ_CURRENCY))
        .when(F.col("start_date") > F.col("end_date"), F.lit(RQ_INTERVAL))
    )


def val_request(requests: DataFrame) -> DataFrame:
    """Adds ``reject_reason`` and the normalised symbols/currency."""
    return requests.select(
        "*",
        request_reason().alias("reject_reason"),
        fn.normalize_symbols("symbols").alias("norm_symbols"),
        F.upper("currency").alias("norm_currency"),
    )


# Manifest-contract messages.
MF_SHA = "sha256 must be 64 lowercase hex characters"
MF_ROWS = "row_count must be positive"
MF_UNIQUE = "manifest files must have unique symbols and paths"
MF_REQUEST_SHA = "request_sha256 must be 64 lowercase hex characters"


def manifest_file_reason() -> Column:
    return F.when(~F.col("sha256").rlike(fn.SHA256_PATTERN), F.lit(MF_SHA)).when(
        F.col("row_count") <= 0, F.lit(MF_ROWS)
    )


def val_manifest(files: DataFrame, manifest_key: list[str]) -> DataFrame:
    """Exploded manifest files -> per-manifest verdict.

    Uniqueness of symbols and paths is ``count`` vs ``count(distinct)`` per
    manifest (partial aggregates; no collect of the file list).
    """
    judged = files.withColumn("file_reason", manifest_file_reason())
    return judged.groupBy(*manifest_key).agg(
        F.count(F.lit(1)).alias("files"),
        F.count_distinct("symbol").alias("distinct_symbols"),
        F.count_distinct("path").alias("distinct_paths"),
        F.min("file_reason").alias("first_file_reason"),
    ).withColumn(
        "reject_reason",
        F.when(F.col("first_file_reason").isNotNull(), F.col("first_file_reason")).when(
            (F.col("distinct_symbols") != F.col("files")) | (F.col("distinct_paths") != F.col("files")),
            F.lit(MF_UNIQUE),
        ),
    )


def unsafe_path(path: Column) -> Column:
    """A manifest path that escapes the snapshot folder: absolute, or with a
    '..' segment, or empty."""
    return (
        path.isNull()
        | (F.length(path) == 0)
        | path.startswith("/")
        | path.rlike(r"(^|/)\.\.(/|$)")
        | path.rlike(r"^[A-Za-z]:")
    )


def missing_columns(columns: Iterable[str], required: Iterable[str]) -> list[str]:
    """Required names absent from a header (trimmed, lower-cased), sorted."""
    present = {c.strip().lower() for c in columns}
    return sorted(set(required) - present)


def flt_symbol(df: DataFrame, symbols: DataFrame, name_col: str = "name") -> DataFrame:
    """Keep vendor rows whose ``name`` (trim, upper) is a requested symbol.

    One pass for all symbols: a left-semi join against the requested list
    (bounded by the request, checked before broadcasting).
    """
    from tidemark.session import guarded_broadcast

    if name_col not in df.columns:
        return df
    keyed = df.withColumn("_sym", fn.upper_trim(name_col))
    return keyed.join(
        guarded_broadcast(symbols.select(F.col("symbol").alias("_sym"))), on="_sym", how="left_semi"
    ).drop("_sym")


def flt_date_interval(df: DataFrame, start, end, col: str = "trading_date") -> DataFrame:
    return df.where(F.col(col).between(F.lit(start).cast("date"), F.lit(end).cast("date")))


def flt_claimable(outbox: DataFrame, now: Column, max_attempts: int, stale_minutes: int = 5) -> DataFrame:
    """Outbox rows a worker may claim: attempts left and pending, or a
    processing lease older than ``stale_minutes``."""
    stale_before = now - F.expr(f"INTERVAL {int(stale_minutes)} MINUTES")
    return outbox.where(
        (F.col("attempt_count") < max_attempts)
        & (
            (F.col("status") == "pending")
            | ((F.col("status") == "processing") & (F.col("claimed_at") < stale_before))
        )
    )
