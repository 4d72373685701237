"""Merkle tree over replay positions; the bucketed price table."""

from __future__ import annotations

import datetime as dt
import hashlib

import pytest
from pyspark.sql import functions as F
from test_data_loss import price

from tidemark.operators import merkle as M
from tidemark.sinks import price_table as P


def plan(spark, n, changed=None):
    ids = spark.range(n).select(F.col("id").alias("position"), F.concat(F.lit("e"), F.col("id")).alias("event_id"))
    return ids if changed is None else ids.withColumn("event_id", F.when(F.col("position") == changed, "other").otherwise(F.col("event_id")))


def sha(parts):
    return hashlib.sha256("".join(p + "\n" for p in parts).encode()).hexdigest()


def brute_root(ids, width, fanout):
    level = [sha(ids[i : i + width]) for i in range(0, len(ids), width)]
    ranges = len(level)
    while len(level) > 1:
        level = [sha(level[i : i + fanout]) for i in range(0, len(level), fanout)]
    return len(ids), ranges, level[0] if level else None


@pytest.mark.parametrize("n", [0, 1, 8, 9, 100])
def test_root_matches_brute_force(spark, monkeypatch, n):
    monkeypatch.setattr(M, "RANGE", 4)
    monkeypatch.setattr(M, "FANOUT", 3)
    assert tuple(M.merkle_root(M.merkle_tree(plan(spark, n))).first()) == brute_root([f"e{i}" for i in range(n)], 4, 3)


def test_prefix_proof_finds_any_change(spark, monkeypatch):
    monkeypatch.setattr(M, "RANGE", 4)
    monkeypatch.setattr(M, "FANOUT", 3)
    events = plan(spark, 60)
    tree = M.merkle_tree(events)
    proof = M.prefix_proof(events, tree, 43)
    rows = proof.collect()
    assert len(rows) <= 3 * (M.FANOUT - 1) + 1 and sum(r.level == M.REST for r in rows) == 1
    # a longer plan with the same beginning resumes; a changed, or shorter, beginning does not
    longer = plan(spark, 75)
    assert [r.position for r in M.resume_behind(longer, M.merkle_tree(longer), proof, 43).orderBy("position").collect()] == list(range(43, 75))
    for other in (plan(spark, 60, changed=42), plan(spark, 60, changed=5), plan(spark, 40)):
        with pytest.raises(M.PrefixError):
            M.resume_behind(other, M.merkle_tree(other), proof, 43)
    same = plan(spark, 60, changed=43)
    assert M.resume_behind(same, M.merkle_tree(same), proof, 43).count() == 17


def test_stored_prices_are_met_in_place(spark, tmp_path):
    path, one = f"{tmp_path}/prices", price(spark, "A", 1).drop("trading_date", "event_id", "symbol")
    days = spark.range(400).select(
        F.date_add(F.lit(dt.date(2020, 1, 1)), F.col("id").cast("int")).alias("trading_date"),
        F.concat(F.lit("S"), F.col("id") % 7).alias("symbol"),
        F.col("id").cast("string").alias("event_id"),
    )
    prices = days.crossJoin(one)
    P.open_table(spark, "prices_in_place", path, 4)
    try:
        P.add_prices(prices.where("event_id < '3'"), "prices_in_place", 4)
        P.add_prices(prices.unionByName(prices), "prices_in_place", 4)
        P.add_prices(prices, "prices_in_place", 4)
        assert spark.table("prices_in_place").count() == 400
        batch = prices.where("symbol = 'S1'").select(*P.KEY).unionByName(
            spark.createDataFrame([("p", "new", dt.date(2020, 1, 1))], "provider string, symbol string, trading_date date")
        )
        out = P.meet_prices(batch, "prices_in_place", 4, ["event_id"])
        assert out.where("event_id is null").count() == 1 and out.count() == prices.where("symbol = 'S1'").count() + 1
        plan = out._jdf.queryExecution().executedPlan().toString()
        # the only exchange is the batch's: the stored side goes from its scan to the join in place
        assert plan.count("Exchange hashpartitioning") == 1 and plan.index("FileScan parquet") > plan.index("Exchange hashpartitioning")
        # opened again, with its buckets
        spark.sql("DROP TABLE prices_in_place")
        assert P.open_table(spark, "prices_in_place", path, 4).count() == 400
        spark.sql("DROP TABLE prices_in_place")
        with pytest.raises(ValueError, match="has 4 buckets"):
            P.open_table(spark, "prices_in_place", path, 8)
    finally:
        spark.sql("DROP TABLE IF EXISTS prices_in_place")
