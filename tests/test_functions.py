"""Scalar functions against golden values and the parsing decisions."""

from __future__ import annotations

import datetime as dt
import decimal

from pyspark.sql import functions as F

from tidemark.functions import scalar as fn


def one(spark, col, value=None, schema="x string"):
    df = spark.createDataFrame([(value,)], schema)
    return df.select(col.alias("r")).first()["r"]


def test_event_id_golden(spark):
    rows = [
        (1, "plotly-github", "AAPL", dt.date(2013, 2, 8), "3c7949458f443dc494e032ca142226b14f6a53e66f9b4c543e22377a032e22b0"),
        (1, "synthetic-test-fixture", "AAPL", dt.date(2024, 1, 2), "4347995e448243ea0fd0a6ab7b4132c20082adad4de4fef98b11274ab01c677f"),
        (1, "ci-fixture", "AAPL", dt.date(2026, 8, 5), "d1d1df4a774ce8a222a67b228a6ef2d4ac128049403280e920ef768498e92a28"),
    ]
    df = spark.createDataFrame(rows, "v int, p string, s string, d date, want string")
    got = df.select(fn.event_id("v", "p", "s", "d").alias("got"), "want").collect()
    assert all(r.got == r.want for r in got)


def test_canonical_decimal(spark):
    cases = {"468.30": "468.3", "100": "100", "0.5000": "0.5", "1e3": "1000", " 12 ": "12", "0.00": "0", "-0.50": "-0.5"}
    df = spark.createDataFrame([(k,) for k in cases], "x string")
    got = dict(df.select("x", fn.canonical_decimal(fn.parse_decimal("x")).alias("c")).collect())
    assert got == cases


def test_parse_decimal_refuses_nan_underscore_and_range(spark):
    df = spark.createDataFrame([("NaN",), ("1_000",), ("Infinity",), ("abc",), ("1" * 15,), ("1.123456789",)], "x string")
    got = {r.x: (r.v, r.p) for r in df.select("x", fn.parse_decimal("x").alias("v"), fn.decimal_problem("x").alias("p")).collect()}
    assert got["NaN"] == (None, "invalid_decimal")
    assert got["1_000"] == (None, "invalid_decimal")
    assert got["Infinity"] == (None, "invalid_decimal")
    assert got["abc"] == (None, "invalid_decimal")
    assert got["1" * 15] == (None, "out_of_range")
    assert got["1.123456789"] == (None, "out_of_range")  # a ninth decimal is refused, not rounded


def test_parse_date_forms(spark):
    cases = {
        "2024-01-02": dt.date(2024, 1, 2),
        "20240102": dt.date(2024, 1, 2),
        "2024-1-2": None,
        "2024": None,
        " 2024-01-02": None,
        "2024-01-02T00:00:00": None,
        "2024-02-30": None,
    }
    df = spark.createDataFrame([(k,) for k in cases], "x string")
    got = dict(df.select("x", fn.parse_date("x").alias("d")).collect())
    assert got == cases


def test_parse_long(spark):
    df = spark.createDataFrame([("42",), (" -7 ",), ("1_000",), ("4.0",)], "x string")
    got = dict(df.select("x", fn.parse_long("x").alias("v")).collect())
    assert got == {"42": 42, " -7 ": -7, "1_000": None, "4.0": None}


def test_dlq_envelope_fixture(spark):
    df = spark.createDataFrame(
        [("prices", 0, 0, None, bytearray(b"not-protobuf"))],
        "topic string, partition int, offset long, key binary, value binary",
    )
    row = df.select(
        fn.dlq_key("topic", "partition", "offset").alias("k"),
        fn.dlq_envelope("topic", "partition", "offset", "key", "value", F.lit("InvalidMarketEvent"), F.lit("boom")).alias("j"),
    ).first()
    assert row.k == "prices:0:0"
    assert row.j == (
        '{"error":"boom","error_type":"InvalidMarketEvent","key_base64":"","schema_version":1,'
        '"source":{"offset":0,"partition":0,"topic":"prices"},"value_base64":"bm90LXByb3RvYnVm"}'
    )


def test_base64_has_no_line_breaks(spark):
    df = spark.createDataFrame([(bytearray(b"x" * 500),)], "b binary")
    assert "\n" not in df.select(fn.base64_text("b").alias("t")).first().t


def test_object_key_and_snapshot_id(spark):
    df = spark.createDataFrame([("plotly-github", "AAPL", dt.date(2013, 2, 8), "abc")], "p string, s string, d date, e string")
    key = df.select(fn.object_key("p", "s", "d", "e").alias("k")).first().k
    assert key == "market-prices/provider=plotly-github/symbol=AAPL/year=2013/date=2013-02-08/abc.parquet"
    sid = one(spark, fn.snapshot_id(F.lit("us-large-cap-v1"), F.lit("9bd1f15a683fc697e815b948975060fcdd5349d625fe88be504d30c5fe575bc2")))
    assert sid == "us-large-cap-v1-9bd1f15a683f"


def test_normalize_symbols(spark):
    df = spark.createDataFrame([([" spy", "aapl ", "Msft"],), (["a", " A"],)], "s array<string>")
    got = [(r.n, r.u) for r in df.select(fn.normalize_symbols("s").alias("n"), fn.symbols_unique("s").alias("u")).collect()]
    assert got == [(["AAPL", "MSFT", "SPY"], True), (["A", "A"], False)]
