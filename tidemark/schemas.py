"""Fixed schemas of the data model. Nothing canonical is ever inferred."""

from __future__ import annotations

from pyspark.sql import types as T

PRICE_TYPE = T.DecimalType(20, 8)

# Canonical CSV column order.
CANONICAL_COLUMNS = ("symbol", "trading_date", "open", "high", "low", "close", "volume", "currency")

# The twelve event fields in wire order (field numbers 1..12).
EVENT_FIELDS = (
    "event_id",
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
)
PRICE_FIELDS = ("open", "high", "low", "close")
LOGICAL_KEY = ("provider", "symbol", "trading_date")

# Canonical OHLCV row (typed).
CANONICAL_ROW = T.StructType(
    [
        T.StructField("symbol", T.StringType()),
        T.StructField("trading_date", T.DateType()),
        T.StructField("open", PRICE_TYPE),
        T.StructField("high", PRICE_TYPE),
        T.StructField("low", PRICE_TYPE),
        T.StructField("close", PRICE_TYPE),
        T.StructField("volume", T.LongType()),
        T.StructField("currency", T.StringType()),
    ]
)

# Wire event: prices and date are text, as on the wire.
WIRE_EVENT = T.StructType(
    [
        T.StructField("event_id", T.StringType()),
        T.StructField("schema_version", T.LongType()),
        T.StructField("provider", T.StringType()),
        T.StructField("symbol", T.StringType()),
        T.StructField("trading_date", T.StringType()),
        T.StructField("open", T.StringType()),
        T.StructField("high", T.StringType()),
        T.StructField("low", T.StringType()),
        T.StructField("close", T.StringType()),
        T.StructField("volume", T.LongType()),
        T.StructField("currency", T.StringType()),
        T.StructField("snapshot_id", T.StringType()),
    ]
)

# Validated event (typed), also the archive row layout.
EVENT = T.StructType(
    [
        T.StructField("event_id", T.StringType()),
        T.StructField("schema_version", T.IntegerType()),
        T.StructField("provider", T.StringType()),
        T.StructField("symbol", T.StringType()),
        T.StructField("trading_date", T.DateType()),
        T.StructField("open", PRICE_TYPE),
        T.StructField("high", PRICE_TYPE),
        T.StructField("low", PRICE_TYPE),
        T.StructField("close", PRICE_TYPE),
        T.StructField("volume", T.LongType()),
        T.StructField("currency", T.StringType()),
        T.StructField("snapshot_id", T.StringType()),
    ]
)

# Source record: the row layout of a Kafka source.
SOURCE_RECORD = T.StructType(
    [
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
    ]
)

SNAPSHOT_FILE = T.StructType(
    [
        T.StructField("symbol", T.StringType()),
        T.StructField("path", T.StringType()),
        T.StructField("sha256", T.StringType()),
        T.StructField("row_count", T.LongType()),
        T.StructField("first_date", T.DateType()),
        T.StructField("last_date", T.DateType()),
    ]
)

MANIFEST = T.StructType(
    [
        T.StructField("schema_version", T.IntegerType()),
        T.StructField("snapshot_id", T.StringType()),
        T.StructField("request_sha256", T.StringType()),
        T.StructField("dataset_id", T.StringType()),
        T.StructField("provider", T.StringType()),
        T.StructField("currency", T.StringType()),
        T.StructField("requested_start_date", T.DateType()),
        T.StructField("requested_end_date", T.DateType()),
        T.StructField("generated_at", T.TimestampType()),
        T.StructField("files", T.ArrayType(SNAPSHOT_FILE)),
    ]
)

REQUEST = T.StructType(
    [
        T.StructField("schema_version", T.IntegerType()),
        T.StructField("dataset_id", T.StringType()),
        T.StructField("provider", T.StringType()),
        T.StructField("symbols", T.ArrayType(T.StringType())),
        T.StructField("start_date", T.DateType()),
        T.StructField("end_date", T.DateType()),
        T.StructField("currency", T.StringType()),
    ]
)

# Dispositions, one per record.
INSERTED, DUPLICATE, CONFLICT, INVALID, STALE, GAP = (
    "inserted",
    "duplicate",
    "conflict",
    "invalid",
    "stale_offset",
    "gap",
)
# Dispositions that advance the partition's next offset.
ADVANCING = (INSERTED, DUPLICATE, CONFLICT, INVALID)
DEAD_LETTER = (INVALID, CONFLICT)
