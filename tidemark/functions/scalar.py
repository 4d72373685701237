"""Scalar column functions. Every one is a built-in expression tree, so it stays
inside whole-stage codegen; nothing here runs Python per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.schemas import PRICE_TYPE

# Fixed values (must equal the reference's for identical results):
#   identity hash text  = "{schema_version}|{provider}|{symbol}|{YYYY-MM-DD}"
#   archive object key  = "market-prices/provider={provider}/symbol={symbol}/year={yyyy}/date={YYYY-MM-DD}/{event_id}.parquet"
#   dead-letter key     = "{topic}:{partition}:{offset}"
#   snapshot id         = "{dataset_id}-{first 12 hex of the request sha256}"
#   error text limit    = 2000 characters
#   dataset id pattern  = ^[a-z0-9][a-z0-9-]+$
#   sha256 hex pattern  = ^[0-9a-f]{64}$
ARCHIVE_PREFIX = "market-prices"
ERROR_TEXT_LIMIT = 2000
DATASET_ID_PATTERN = r"^[a-z0-9][a-z0-9-]+$"
SHA256_PATTERN = r"^[0-9a-f]{64}$"

# Text accepted as a decimal: optional blanks and sign, digits with an optional
# point, optional exponent. NaN, Infinity and digit underscores are refused.
DECIMAL_TEXT_PATTERN = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"
# Text accepted as an integer.
LONG_TEXT_PATTERN = r"^\s*[+-]?[0-9]+\s*$"
# Dates: extended ISO form, or the basic eight-digit form.
ISO_DATE_PATTERN = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
BASIC_DATE_PATTERN = r"^[0-9]{8}$"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def fenced(x) -> Column:
    """``x`` unchanged, but worked out where it stands: a filter on it is not moved below, where
    the optimizer would write out its whole derivation at every use, and a constant is not folded into what reads it."""
    return F.when(F.spark_partition_id() >= 0, _c(x))


def iso_date(d) -> Column:
    """date -> 'YYYY-MM-DD'."""
    return F.date_format(_c(d), "yyyy-MM-dd")


def event_id(schema_version, provider, symbol, trading_date) -> Column:
    """sha256 hex of 'version|provider|symbol|YYYY-MM-DD' for a date column.

    ``concat_ws`` skips NULLs, so the caller validates required fields first.
    """
    return event_id_text(schema_version, provider, symbol, iso_date(trading_date))


def event_id_text(schema_version, provider, symbol, trading_date_text) -> Column:
    """Identity hash when the date is already ISO text (wire form)."""
    return F.sha2(
        F.concat_ws("|", _c(schema_version).cast("string"), _c(provider), _c(symbol), _c(trading_date_text)),
        256,
    )


def pack_id(x) -> Column:
    """A text as bytes behind a mark: 64 lower-case hex digits as their 32 bytes, any other as its UTF-8. Equal
    for equal texts only, and half as long to move."""
    raw = F.unhex(_c(x))
    short = (F.length(_c(x)) == 64) & F.lower(F.hex(raw)).eqNullSafe(_c(x))
    return F.when(short, F.concat(F.lit(b"\x01"), raw)).otherwise(F.concat(F.lit(b"\x00"), F.encode(_c(x), "UTF-8")))


def unpack_id(x) -> Column:
    """The text that ``pack_id`` packed."""
    short = F.substring(_c(x), 1, 1) == F.lit(b"\x01")
    rest = F.substring(_c(x), 2, 1 << 30)
    return F.when(short, F.lower(F.hex(rest))).otherwise(F.decode(rest, "UTF-8"))


# What stands for a row's event id where it moves: the fields that it follows from, or the id itself where it does not.
IDENTITY = ["schema_version", "provider", "symbol", "trading_date"]


def without_ids(rows: DataFrame) -> DataFrame:
    """``rows`` (event_id and the IDENTITY fields) with ``_plain`` and ``_id`` for event_id: ``_id`` holds it only where
    it does not follow from the row's fields, so rows move and are stored without 64 digits that no codec shortens."""
    plain = F.col("event_id").eqNullSafe(event_id(*IDENTITY))
    return rows.select(*[c for c in rows.columns if c != "event_id"], plain.alias("_plain"), F.when(~plain, pack_id("event_id")).alias("_id"))


def with_ids(rows: DataFrame) -> DataFrame:
    """``rows`` of ``without_ids`` with their event ids."""
    made = F.when(F.col("_plain"), event_id(*IDENTITY)).otherwise(unpack_id("_id"))
    return rows.withColumn("event_id", made).drop("_plain", "_id")


def sha256_hex(x) -> Column:
    return F.sha2(_c(x), 256)


def canonical_decimal(d) -> Column:
    """DECIMAL(20,8) -> text without trailing zeros and without exponent.

    The cast of a scale-8 decimal always has a point, so stripping trailing zeros
    and then the point is exact ('100.00000000' -> '100',
    '102.50000000' -> '102.5', '0.00000000' -> '0').
    """
    return F.rtrim(F.rtrim(_c(d).cast(PRICE_TYPE).cast("string"), F.lit("0")), F.lit("."))


# Nearly all prices are written so: what both patterns accept and no more than is stored, told by one look at the text.
_PLAIN_DECIMAL = r"^[0-9]{1,12}(\.[0-9]{1,8})?$"
# A digit other than zero behind the eighth decimal: storing it would round.
_TOO_FINE = r"\.[0-9]{8}[0-9]*[1-9]"


def parse_decimal(text) -> Column:
    """Text -> DECIMAL(20,8), NULL when not a finite decimal, out of range, or
    finer than eight decimals: a price is kept exactly or refused, never rounded."""
    t = _c(text)
    kept = t.rlike(_PLAIN_DECIMAL) | (t.rlike(DECIMAL_TEXT_PATTERN) & ~t.rlike(_TOO_FINE))
    return F.when(kept, t.try_cast(PRICE_TYPE))


def decimal_problem(text) -> Column:
    """NULL when ``text`` parses; else 'invalid_decimal' or 'out_of_range'."""
    t = _c(text)
    return (
        F.when(t.isNull() | ~t.rlike(DECIMAL_TEXT_PATTERN), F.lit("invalid_decimal"))
        .when(t.try_cast(PRICE_TYPE).isNull() | t.rlike(_TOO_FINE), F.lit("out_of_range"))
    )


def parse_date(text) -> Column:
    """ISO text -> date; accepts 'YYYY-MM-DD' and 'YYYYMMDD' only."""
    t = _c(text)
    return (
        F.when(t.rlike(ISO_DATE_PATTERN), t.try_cast("date"))
        .when(t.rlike(BASIC_DATE_PATTERN), F.try_to_date(t, "yyyyMMdd"))
    )


def parse_long(text) -> Column:
    t = _c(text)
    return F.when(t.rlike(LONG_TEXT_PATTERN), t.try_cast("bigint"))


def year_of(d) -> Column:
    return F.year(_c(d))


def upper_trim(x) -> Column:
    return F.upper(F.trim(_c(x)))


def lower_trim(x) -> Column:
    return F.lower(F.trim(_c(x)))


def normalize_symbols(arr) -> Column:
    """Trim + upper every symbol, then sort."""
    return F.array_sort(F.transform(_c(arr), lambda s: F.upper(F.trim(s))))


def symbols_unique(arr) -> Column:
    norm = F.transform(_c(arr), lambda s: F.upper(F.trim(s)))
    return F.size(F.array_distinct(norm)) == F.size(norm)


def snapshot_id(dataset_id, request_sha) -> Column:
    return F.concat(_c(dataset_id), F.lit("-"), F.substring(_c(request_sha), 1, 12))


def object_key(provider, symbol, trading_date, eid) -> Column:
    td = _c(trading_date)
    return F.concat(
        F.lit(f"{ARCHIVE_PREFIX}/provider="),
        _c(provider),
        F.lit("/symbol="),
        _c(symbol),
        F.lit("/year="),
        F.year(td).cast("string"),
        F.lit("/date="),
        iso_date(td),
        F.lit("/"),
        _c(eid),
        F.lit(".parquet"),
    )


def dlq_key(topic, partition, offset) -> Column:
    return F.concat_ws(":", _c(topic), _c(partition).cast("string"), _c(offset).cast("string"))


def base64_text(b) -> Column:
    """Base64 without line breaks (Spark's encoder wraps long values)."""
    return F.regexp_replace(F.base64(_c(b)), r"[\r\n]", "")


def dlq_envelope(topic, partition, offset, key, value, error_type, error) -> Column:
    """Compact JSON dead-letter envelope with keys in sorted order."""
    return F.to_json(
        F.struct(
            _c(error).alias("error"),
            _c(error_type).alias("error_type"),
            base64_text(F.coalesce(_c(key), F.lit(b"").cast("binary"))).alias("key_base64"),
            F.lit(1).alias("schema_version"),
            F.struct(
                _c(offset).cast("long").alias("offset"),
                _c(partition).cast("int").alias("partition"),
                _c(topic).alias("topic"),
            ).alias("source"),
            base64_text(_c(value)).alias("value_base64"),
        )
    )


def truncate_error(e) -> Column:
    return F.substring(_c(e), 1, ERROR_TEXT_LIMIT)


def to_price(x) -> Column:
    return _c(x).cast(PRICE_TYPE)
