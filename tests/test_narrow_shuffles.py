"""What the log, the engine and the price table move: each of these once moved or stored every field of every record."""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import functions as F
from test_data_loss import price
from test_dispositions import SCHEMA, ev, random_batches, rec

from tidemark.operators import dispositions as D
from tidemark.operators import ledger as L
from tidemark.operators.offsets import dense_index
from tidemark.plans import bindings as B
from tidemark.plans.q_jobs import ledger
from tidemark.sinks import archive_drain as AD
from tidemark.sinks import price_table as P


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_positions_are_a_view_without_a_second_shuffle(spark):
    df = spark.range(2000).select((F.col("id") % 3).alias("g"), (F.col("id") * 7 % 2000).alias("k"), F.lit("wide").alias("text"))
    out = dense_index(df, ["g"], ["k"], keep=["text"])
    assert "Exchange hashpartitioning" not in physical(out)
    assert sorted(out.columns) == ["g", "idx", "text"]
    want = [(g, i) for g in range(3) for i in range(len(range(g, 2000, 3)))]
    assert sorted((r.g, r.idx) for r in out.collect()) == want


def test_the_log_is_stored_in_narrow_columns(spark, sf_dir):
    for frame in (B.log(spark, sf_dir), B.log_redelivered(spark, sf_dir)):
        read = " ".join(re.findall(r"ReadSchema: struct<([^>]*)>", physical(frame)))
        assert "l_extendedprice" in read and "event_id" not in read and "trading_date" not in read
        # the lost offsets and the partition ends are broadcast, no record is shuffled
        assert "Exchange hashpartitioning(partition" not in physical(frame)


def test_carried_columns_come_with_the_same_verdicts(spark):
    recs, cks = random_batches(12, seed=3)
    df = spark.createDataFrame(recs, SCHEMA).withColumn("mine", F.concat(F.lit("m"), F.col("seq").cast("string")))
    ck = spark.createDataFrame(cks, "topic string, partition int, next_offset long")
    place = ["topic", "partition", "offset", "seq"]
    verdict = lambda out: sorted(tuple(r) for r in out.select(*place, "disposition", F.coalesce("error", F.lit(""))).collect())
    narrow = D.apply_events(df, ck, carry=["mine"])
    assert verdict(narrow) == verdict(D.apply_events(df, ck))
    assert "t_close" not in narrow.columns and all(r.mine == f"m{r.seq}" for r in narrow.collect())


def test_event_ids_come_back_and_stored_prices_are_told_apart(spark):
    good, bad = ev(), ev(day="2024-01-03", valid=False)
    first = D.apply_events(spark.createDataFrame([rec(0, 0, good), rec(1, 1, bad)], SCHEMA))
    assert {r.offset: r.t_event_id for r in first.collect()} == {0: good["event_id"], 1: "wrong"}
    stored = L.prices_view(first)
    ck = D.next_offsets(first)
    again = spark.createDataFrame([rec(2, 2, good)], SCHEMA)
    other = stored.withColumn("event_id", F.lit("other"))
    for prices, want in ((stored, "duplicate"), (other, "conflict"), (stored.withColumn("volume", F.lit(None).cast("long")), "conflict")):
        assert [r.disposition for r in D.apply_events(again, ck, prices).collect()] == [want]


def test_a_batch_of_prices_is_shuffled_once(spark, tmp_path):
    one = price(spark, "A", 1).drop("trading_date", "event_id")
    days = spark.range(300).select(
        F.date_add(F.lit(dt.date(2020, 1, 1)), F.col("id").cast("int")).alias("trading_date"), F.col("id").cast("string").alias("event_id")
    )
    prices = days.crossJoin(one)
    P.open_table(spark, "prices_once", f"{tmp_path}/prices", 4)
    try:
        P.add_prices(prices.where("event_id < '2'"), "prices_once", 4)
        new = P.new_prices(prices.unionByName(prices.withColumn("event_id", F.concat("event_id", F.lit("x")))), "prices_once", 4)
        assert physical(new.hint("merge")).count("Exchange hashpartitioning") == 1
        assert {r.event_id for r in new.collect()} == {str(i) for i in range(300) if not str(i) < "2"}
    finally:
        spark.sql("DROP TABLE IF EXISTS prices_once")


def test_ledger_prices_are_shuffled_once_to_their_buckets(spark, sf_dir, tmp_path):
    prices = L.prices_view(ledger(spark, sf_dir))
    P.open_table(spark, "ledger_prices_once", f"{tmp_path}/prices", 8, prices.schema)
    try:
        new = P.new_prices(prices, "ledger_prices_once", 8)
        assert physical(new.hint("merge")).count("Exchange hashpartitioning") == 1
        assert new.count() == prices.count() > 0
    finally:
        spark.sql("DROP TABLE IF EXISTS ledger_prices_once")


def test_bars_take_first_and_last_prices_without_the_later_columns(spark, sf_dir):
    bars = B.bars_big(spark, sf_dir)
    aggregate = [line for line in physical(bars).splitlines() if "SortAggregate" in line]
    assert aggregate and not any("l_returnflag" in line or "l_tax" in line for line in aggregate)


def test_repeated_prices_are_archived_once(spark, tmp_path):
    two = price(spark, "A", 2).unionByName(price(spark, "B", 3))
    now = dt.datetime(2024, 1, 1)
    assert AD.drain(two.unionByName(two), f"{tmp_path}/archive", 2, now) == 2
    three = two.unionByName(two).unionByName(price(spark, "C", 4))
    assert AD.drain(three, f"{tmp_path}/archive", 2, now) == 1
    assert AD.read_batches(spark, f"{tmp_path}/archive").count() == 3
