"""Cases in which rows were once lost or changed: each failed before its fix."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidemark.operators.offsets import dense_index
from tidemark.schemas import EVENT, SOURCE_RECORD
from tidemark.sinks.archive import write_archive
from tidemark.sinks.eventlog import read_replay_position, write_event_log, write_replay_position
from tidemark.sources.files import read_archive
from tidemark.streaming.consumer import process_batch


def test_positions_do_not_depend_on_exchange_reuse(spark):
    spark.conf.set("spark.sql.exchange.reuse", "false")
    try:
        li = spark.read.parquet("/root/testdata/sf0.01/lineitem.parquet").withColumn("g", F.col("l_orderkey") % 4)
        got = dense_index(li, ["g"], ["l_orderkey", "l_linenumber"], out="pos")
        rows = got.groupBy("g").agg(F.count("*").alias("n"), F.min("pos").alias("a"), F.max("pos").alias("b"), F.countDistinct("pos").alias("d"))
        want = {r.g: r["count"] for r in li.groupBy("g").count().collect()}
        for r in rows.collect():
            assert (r.n, r.a, r.b, r.d) == (want[r.g], 0, want[r.g] - 1, want[r.g])
    finally:
        spark.conf.unset("spark.sql.exchange.reuse")


def price(spark, symbol, day):
    values = {
        "event_id": f"{symbol}-{day}", "symbol": symbol, "provider": "p", "trading_date": dt.date(2024, 1, day),
    }

    def value(f):
        if f.name in values:
            return values[f.name]
        kind = f.dataType.simpleString()
        return Decimal(1) if kind.startswith("decimal") else 1 if kind in ("int", "bigint") else "x"

    return spark.createDataFrame([tuple(value(f) for f in EVENT.fields)], EVENT)


@pytest.mark.parametrize("layout", ["compact", "per_date"])
def test_archive_batches_add_up_and_retries_change_nothing(spark, tmp_path, layout):
    root = f"{tmp_path}/archive"
    first = price(spark, "A", 2).unionByName(price(spark, "B", 3))
    write_archive(first, root, layout)
    for _ in range(2):
        write_archive(price(spark, "C", 4), root, layout)
        assert {r.event_id for r in read_archive(spark, root).collect()} == {"A-2", "B-3", "C-4"}
        assert read_archive(spark, root).count() == 3


def test_unreadable_held_records_and_positions_are_errors(spark, tmp_path):
    root = f"{tmp_path}/ledger"
    folder = tmp_path / "ledger" / "_held" / "batch_id=0"
    folder.mkdir(parents=True)
    (folder / "part-0.parquet").write_bytes(b"not parquet")
    records = spark.createDataFrame([], SOURCE_RECORD)
    with pytest.raises(Exception):
        process_batch(spark, records, 1, root, "g")
    position = tmp_path / "position"
    assert read_replay_position(spark, str(position), "m") is None
    position.mkdir()
    (position / "part-0.parquet").write_bytes(b"not parquet")
    with pytest.raises(Exception):
        read_replay_position(spark, str(position), "m")
    write_replay_position(spark, f"{tmp_path}/good", "m", "e1")
    assert read_replay_position(spark, f"{tmp_path}/good", "m") == "e1"


def test_event_log_partition_is_written_by_many_tasks(spark, tmp_path):
    import os

    log = spark.range(4000).select(
        F.lit("t").alias("topic"), F.lit(0).alias("partition"), F.col("id").alias("offset"),
        F.lit(b"k").alias("key"), F.lit(b"v").alias("value"),
    )
    log = log.select(*[F.col(f.name) if f.name in log.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in SOURCE_RECORD.fields])
    write_event_log(log, f"{tmp_path}/log")
    files = [f for _, _, names in os.walk(f"{tmp_path}/log") for f in names if f.endswith(".parquet")]
    assert len(files) > 1
    assert spark.read.parquet(f"{tmp_path}/log").select("offset").distinct().count() == 4000


def test_prices_are_kept_exactly_or_refused(spark):
    from tidemark.functions import scalar as fn

    texts = ["0.123456789", "0.123456780", "1.12345678", "1.000000000", "5.00000000001", "7"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = df.select("t", fn.parse_decimal("t").alias("d"), fn.decimal_problem("t").alias("p")).collect()
    assert [r.d is None for r in got] == [True, False, False, False, True, False]
    assert [r.p for r in got] == ["out_of_range", None, None, None, "out_of_range", None]
    assert all(r.d == Decimal(r.t) for r in got if r.d is not None)
