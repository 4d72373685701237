"""Event ids, object keys and digests are made where they are read: no shuffle or scratch table moves their text."""

from __future__ import annotations

import datetime as dt
import glob

from pyspark.sql import functions as F
from test_data_loss import price

from tidemark.functions import scalar as fn
from tidemark.plans import q_aggregates, q_composite, q_sources
from tidemark.sinks import archive_drain as AD

NOW = dt.datetime(2024, 1, 1)


def own(spark, symbols, days=2):
    """Prices whose ids follow from their fields."""
    one = price(spark, "A", 1).drop("trading_date", "event_id", "symbol")
    keys = spark.createDataFrame([(s, dt.date(2020, 1, 1) + dt.timedelta(days=d)) for s in symbols for d in range(days)], "symbol string, trading_date date")
    return keys.crossJoin(one).withColumn("event_id", fn.event_id(*fn.IDENTITY))


def test_ids_come_back_as_they_were(spark):
    odd = ["a" * 64, "A" * 64, "g" * 64, "", "x", "é", None, "ab" * 31 + "a"]
    df = spark.createDataFrame([(x,) for x in odd], "x string").select("x", fn.pack_id("x").alias("p"))
    back = df.select("x", fn.unpack_id("p").alias("y"), F.length("p").alias("n")).collect()
    assert len(back) == len(odd) and all(r.x == r.y for r in back)
    assert {r.x: r.n for r in back}["a" * 64] == 33
    rows = own(spark, ["A"], 1)
    both = rows.unionByName(rows.withColumn("event_id", F.lit("odd"))).unionByName(rows.withColumn("event_id", F.lit(None).cast("string")))
    slim = fn.without_ids(both)
    assert "event_id" not in slim.columns and slim.where("_plain and _id is null").count() == 1
    key = lambda r: r.event_id or ""
    assert sorted(fn.with_ids(slim).select(*both.columns).collect(), key=key) == sorted(both.collect(), key=key)


def test_claims_store_no_text_that_follows_from_the_price(spark, tmp_path):
    root, mine = f"{tmp_path}/archive", own(spark, ["A", "B"])
    mixed = mine.unionByName(price(spark, "C", 1).select(*mine.columns))
    assert AD.drain(mixed, root, 2, NOW) == 5
    stored = spark.read.parquet(f"{root}/claims/batch=1")
    assert "event_id" not in stored.columns and "object_key" not in stored.columns and stored.where("_id is not null").count() == 1
    want = {(r.event_id, r.k) for r in mixed.select("event_id", fn.object_key("provider", "symbol", "trading_date", "event_id").alias("k")).collect()}
    assert {(r.event_id, r.object_key) for r in AD.outbox_state(spark, root, 2).collect()} == want
    assert AD.drain(mixed, root, 2, NOW) == 0
    assert {r.event_id for r in AD.archived_ids(spark, root, mixed).collect()} == {e for e, _ in want}


def test_claims_of_an_earlier_release_are_read(spark, tmp_path):
    root, mine = f"{tmp_path}/archive", own(spark, ["A"], 1)
    key = fn.object_key("provider", "symbol", "trading_date", "event_id").alias("object_key")
    mine.select("event_id", key, F.lit(1).alias("attempt"), F.lit(NOW).cast("timestamp_ntz").alias("claimed_at")).write.parquet(f"{root}/claims/batch=1")
    [was] = AD.outbox_state(spark, root, 2).collect()
    assert (was.event_id, was.object_key, was.status) == (*mine.select("event_id", key).first(), "processing")
    assert AD.drain(mine, root, 2, NOW) == 0 and AD.drain(mine, root, 2, NOW + dt.timedelta(minutes=6)) == 1
    [now] = AD.outbox_state(spark, root, 2).collect()
    assert (now.status, now.attempt_count) == ("archived", 2)


def test_files_of_a_batch_hold_ranges_of_symbols_of_their_own(spark, tmp_path):
    """An event's key names one or two files of a batch, not all of its folder."""
    name, root = "spark.sql.adaptive.coalescePartitions.enabled", f"{tmp_path}/archive"
    was = spark.conf.get(name)
    spark.conf.set(name, "false")
    try:
        AD.drain(own(spark, [f"S{k:03d}" for k in range(160)], 3), root, 2, NOW)
    finally:
        spark.conf.set(name, was)
    files = sorted((r.least_symbol, r.greatest_symbol) for r in AD.listing(spark, root).collect())
    assert len(files) > 2
    assert all(a[1] < b[0] for a, b in zip(files, files[1:]))


def test_the_plan_is_put_in_order_without_ids(spark, sf_dir, monkeypatch):
    seen = []
    real = q_aggregates.plan_positions
    monkeypatch.setattr(q_aggregates, "plan_positions", lambda rows: seen.append(rows.columns) or real(rows))
    assert q_aggregates.q_agg_ordered_digest(spark, sf_dir).count() == 1
    assert seen == [fn.IDENTITY]


def test_manifest_documents_are_written_compressed(spark, sf_dir, tmp_path, monkeypatch):
    monkeypatch.setattr(q_sources, "scratch_path", lambda _spark, name: f"{tmp_path}/{name}")
    for query, name in ((q_sources.q_src_manifest, "manifests"), (q_sources.q_val_manifest_document, "manifest-documents")):
        assert query(spark, sf_dir).count() > 0
        parts = glob.glob(f"{tmp_path}/{name}/part-*")
        assert parts and all(p.endswith(".gz") for p in parts)


def test_the_report_repeats_no_record(spark, sf_dir):
    """Two distinct counts in one aggregate would expand every record of every part."""
    plan = q_composite.q_op_verify_convergence(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan
