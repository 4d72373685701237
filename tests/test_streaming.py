"""Streaming consumer: drain, redelivery, restart with the same checkpoint."""

from __future__ import annotations

import hashlib
import tempfile

from pyspark.sql import functions as F

from tidemark.functions import codec
from tidemark.operators import ledger as L
from tidemark.sinks import eventlog as EL
from tidemark.streaming.consumer import start_consumer

WIRE = (
    "topic string, partition int, offset long, key binary, event_id string, schema_version long, provider string, "
    "symbol string, trading_date string, open string, high string, low string, close string, volume long, "
    "currency string, snapshot_id string"
)


def eid(day, symbol="AAPL"):
    return hashlib.sha256(f"1|fixture|{symbol}|{day}".encode()).hexdigest()


def rec(offset, day, close="102.00", partition=0, valid=True):
    return ("prices", partition, offset, bytearray(b"AAPL"), eid(day) if valid else "wrong", 1, "fixture", "AAPL", day,
            "100.00", "103.00", "99.00", close, 1000, "USD", "fixture-v1")


def publish(spark, root, rows):
    df = spark.createDataFrame(rows, WIRE)
    EL.write_event_log(codec.encode(df).select("topic", "partition", "offset", "key", "value"), root, mode="append")


def drain(spark, log_root, ledger_root, ckpt):
    q = start_consumer(spark, log_root, ledger_root, ckpt, max_files_per_trigger=1)
    q.awaitTermination()


def state(spark, ledger_root):
    led = L.read_ledger(spark, ledger_root)
    prices = L.prices_view(led).count()
    ck = {(r.topic, r.partition): r.next_offset for r in L.checkpoint_view(led).collect()}
    dlq = L.dlq_view(led).count()
    return prices, ck, dlq


def test_drain_restart_and_replay_converge(spark):
    base = tempfile.mkdtemp(prefix="tidemark-stream-", dir="/tmp")
    log_root, ledger_root, ckpt = f"{base}/log", f"{base}/ledger", f"{base}/ckpt"
    # wave 1: a price, its redelivery, an invalid record
    publish(spark, log_root, [rec(0, "2024-01-02"), rec(0, "2024-01-02"), rec(1, "2024-01-03", valid=False)])
    drain(spark, log_root, ledger_root, ckpt)
    assert state(spark, ledger_root) == (1, {("prices", 0): 2}, 1)
    # wave 2 arrives with a hole at offset 3: offset 4 waits
    publish(spark, log_root, [rec(2, "2024-01-04"), rec(4, "2024-01-08")])
    drain(spark, log_root, ledger_root, ckpt)  # restart on the same checkpoint
    assert state(spark, ledger_root) == (2, {("prices", 0): 3}, 1)
    # wave 3 fills the hole; the held record is applied; a conflict on day 2
    publish(spark, log_root, [rec(3, "2024-01-05"), rec(5, "2024-01-02", close="1.00")])
    drain(spark, log_root, ledger_root, ckpt)
    assert state(spark, ledger_root) == (4, {("prices", 0): 6}, 2)
    # a full replay of everything at the same offsets changes nothing
    publish(spark, log_root, [rec(0, "2024-01-02"), rec(2, "2024-01-04"), rec(3, "2024-01-05")])
    drain(spark, log_root, ledger_root, ckpt)
    assert state(spark, ledger_root) == (4, {("prices", 0): 6}, 2)
    led = L.read_ledger(spark, ledger_root)
    assert led.groupBy("topic", "partition", "offset").count().where(F.col("count") > 1).count() == 0
