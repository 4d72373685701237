"""Row/event/request contracts at their boundaries, first failure in rule order."""

from __future__ import annotations

import datetime as dt
import hashlib
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from tidemark.operators import validation as V

ROW_SCHEMA = (
    "symbol string, trading_date date, open decimal(20,8), high decimal(20,8), low decimal(20,8), "
    "close decimal(20,8), volume long, currency string, line_no long"
)


def judge_rows(spark, rows, expected="AAPL"):
    df = spark.createDataFrame(rows, ROW_SCHEMA)
    return V.val_row_contract(df, expected_symbol=F.lit(expected)).orderBy("line_no").collect()


def r(o, h, lo, c, v, day=2, sym="AAPL", line=1):
    return (sym, dt.date(2024, 1, day), D(o), D(h), D(lo), D(c), v, "USD", line)


@pytest.mark.parametrize(
    "row,reason",
    [
        # Boundaries: one unit of the last stored decimal, and equality, which passes.
        (r("50.00000001", "50", "49.5", "49.75", 12), V.MSG_DAILY_RANGE),
        (r("49.5", "50", "49.5", "50.00000001", 12), V.MSG_DAILY_RANGE),
        (r("49.49999999", "50", "49.5", "50", 12), V.MSG_DAILY_RANGE),
        (r("7.25", "7.24999999", "7.25", "7.25", 12), V.MSG_LOW_ABOVE_HIGH),
        (r("0.00000001", "3", "0", "2", 12), V.MSG_NOT_POSITIVE),
        (r("61", "62.5", "60.125", "61.5", -(2**62)), V.MSG_NEGATIVE_VOLUME),
        (r("61", "62.5", "60.125", "61.5", 7, sym="aapl"), V.MSG_MULTIPLE_SYMBOLS),
        (r("0.00000001", "0.00000001", "0.00000001", "0.00000001", 0), None),
        (r("61", "61", "61", "61", 2**62), None),
    ],
)
def test_row_contract_cases(spark, row, reason):
    assert judge_rows(spark, [row])[0].reject_reason == reason


def test_duplicate_date_is_second_row(spark):
    got = judge_rows(spark, [r("33", "34.5", "32.25", "33.75", 8, line=1), r("31", "31.5", "30", "30.5", 9, line=2)])
    assert [g.reject_reason for g in got] == [None, "duplicate AAPL date: 2024-01-02"]


def test_first_failure_per_file(spark):
    rows = [
        r("33", "34.5", "32.25", "33.75", -4, day=9, line=1),
        r("0", "5.5", "0", "5", 6, day=11, line=2),
        r("41", "42", "40.5", "41.5", 3, day=10, line=3),
    ]
    df = spark.createDataFrame(rows, ROW_SCHEMA)
    j = V.val_row_contract(df)
    ff = V.first_failure(j, ["symbol"]).first()
    assert ff.first_reason == V.MSG_NEGATIVE_VOLUME and ff.failing_rows == 2


def eid(v, p, s, d):
    return hashlib.sha256(f"{v}|{p}|{s}|{d}".encode()).hexdigest()


WIRE = (
    "event_id string, schema_version long, provider string, symbol string, trading_date string, open string, "
    "high string, low string, close string, volume long, currency string, snapshot_id string"
)


def sample(**kw):
    base = dict(
        schema_version=1, provider="fixture", symbol="AAPL", trading_date="2024-01-02", open="100.00", high="103.00",
        low="99.00", close="102.00", volume=1000, currency="USD", snapshot_id="fixture-v1",
    )
    base.update(kw)
    if "event_id" not in kw:
        base["event_id"] = eid(base["schema_version"], base["provider"], base["symbol"], base["trading_date"])
    return tuple(base[k] for k in ["event_id", "schema_version", "provider", "symbol", "trading_date", "open", "high", "low", "close", "volume", "currency", "snapshot_id"])


@pytest.mark.parametrize(
    "kw,reason",
    [
        ({}, None),
        ({"event_id": "wrong"}, V.EV_WRONG_ID),
        ({"low": "104"}, V.EV_BOUNDS),
        ({"currency": "usd"}, V.EV_BAD_CURRENCY),
        ({"currency": "123"}, None),
        ({"symbol": "aapl"}, V.EV_LOWER_SYMBOL),
        ({"trading_date": "2024-1-2"}, V.EV_BAD_TEXT),
        ({"open": "NaN"}, V.EV_BAD_TEXT),
        ({"open": "1" * 16}, V.EV_OUT_OF_RANGE),
        ({"provider": ""}, V.EV_MISSING_IDENTITY),
        ({"schema_version": 0}, V.EV_MISSING_IDENTITY),
        ({"volume": -1}, V.EV_NOT_POSITIVE),
        ({"open": "0"}, V.EV_NOT_POSITIVE),
        ({"trading_date": "20240102", "event_id": eid(1, "fixture", "AAPL", "2024-01-02")}, None),
        ({"symbol": "A" * 17}, V.EV_OUT_OF_RANGE),
    ],
)
def test_event_contract_cases(spark, kw, reason):
    df = spark.createDataFrame([sample(**kw)], WIRE)
    assert V.val_event_contract(df).first().reject_reason == reason


def test_request_contract(spark):
    rows = [
        (1, "us-large-cap-v1", "p", ["aapl", " spy "], dt.date(2024, 1, 1), dt.date(2024, 2, 1), "usd"),
        (0, "x-1", "p", ["A"], dt.date(2024, 1, 1), dt.date(2024, 2, 1), "usd"),
        (1, "Bad", "p", ["A"], dt.date(2024, 1, 1), dt.date(2024, 2, 1), "usd"),
        (1, "ok-1", "p", [], dt.date(2024, 1, 1), dt.date(2024, 2, 1), "usd"),
        (1, "ok-1", "p", ["a", "A "], dt.date(2024, 1, 1), dt.date(2024, 2, 1), "usd"),
        (1, "ok-1", "p", ["A"], dt.date(2024, 1, 1), dt.date(2024, 2, 1), "us"),
        (1, "ok-1", "p", ["A"], dt.date(2024, 3, 1), dt.date(2024, 2, 1), "usd"),
    ]
    df = spark.createDataFrame(rows, "schema_version int, dataset_id string, provider string, symbols array<string>, start_date date, end_date date, currency string")
    got = [(x.reject_reason, x.norm_symbols, x.norm_currency) for x in V.val_request(df).collect()]
    assert got[0] == (None, ["AAPL", "SPY"], "USD")
    assert [g[0] for g in got[1:]] == [V.RQ_VERSION, V.RQ_DATASET, V.RQ_NO_SYMBOLS, V.RQ_DUP_SYMBOLS, V.RQ_CURRENCY, V.RQ_INTERVAL]


def test_header_and_paths(spark):
    assert V.missing_columns(["Date", " Open"], ["date", "open", "high", "low", "close", "volume"]) == ["close", "high", "low", "volume"]
    df = spark.createDataFrame([("AAPL.csv",), ("../x.csv",), ("/etc/x",), ("a/../../b",), ("",), ("a..b.csv",)], "p string")
    got = [x.u for x in df.select(V.unsafe_path(F.col("p")).alias("u")).collect()]
    assert got == [False, True, True, True, True, False]


def test_manifest_contract(spark):
    rows = [
        ("m1", "AAPL", "AAPL.csv", "a" * 64, 3),
        ("m1", "SPY", "SPY.csv", "b" * 64, 3),
        ("m2", "AAPL", "AAPL.csv", "a" * 64, 3),
        ("m2", "AAPL", "B.csv", "a" * 64, 3),
        ("m3", "X", "X.csv", "Z" * 64, 3),
        ("m4", "X", "X.csv", "a" * 64, 0),
    ]
    df = spark.createDataFrame(rows, "m string, symbol string, path string, sha256 string, row_count long")
    got = {x.m: x.reject_reason for x in V.val_manifest(df, ["m"]).collect()}
    assert got == {"m1": None, "m2": V.MF_UNIQUE, "m3": V.MF_SHA, "m4": V.MF_ROWS}


def test_claimable(spark):
    now = dt.datetime(2024, 1, 1, 0, 10)
    rows = [
        ("a", "pending", 0, None),
        ("b", "pending", 2, None),
        ("c", "processing", 0, dt.datetime(2024, 1, 1, 0, 1)),
        ("d", "processing", 0, dt.datetime(2024, 1, 1, 0, 8)),
        ("e", "archived", 0, None),
    ]
    df = spark.createDataFrame(rows, "event_id string, status string, attempt_count int, claimed_at timestamp")
    got = sorted(x.event_id for x in V.flt_claimable(df, F.lit(now), max_attempts=2).collect())
    assert got == ["a", "c"]
