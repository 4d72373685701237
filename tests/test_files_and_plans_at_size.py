"""What grows with files, folders and expressions: numbers of files, plans and stored columns of the jobs at size."""

from __future__ import annotations

import glob

import pytest
from pyspark.sql import functions as F

from tidemark.functions import codec
from tidemark.functions import scalar as fn
from tidemark.operators import validation as V
from tidemark.plans import replay as R
from tidemark.plans import snapshot as S
from tidemark.session import few_listing_tasks
from tidemark.sinks import eventlog as EL
from tidemark.sinks import price_table as P
from tidemark.sinks.files import file_content_digest, write_canonical_csv
from tidemark.sources.files import SourceError

PARSED = "date '2024-01-01' + cast(id % 30 as int) AS trading_date"


def _optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def _bars(spark, n=60):
    return spark.range(n).selectExpr(
        "1 AS schema_version", "'p' AS provider", "concat('S', id div 30) AS symbol", PARSED,
        *(f"cast({v} AS decimal(20,8)) AS {c}" for c, v in (("open", 2), ("high", 4), ("low", 1), ("close", 3))),
        "cast(5 AS bigint) AS volume", "'USD' AS currency", "'s-1' AS snapshot_id",
    )


def test_files_of_a_small_log_do_not_follow_from_shuffle_partitions(spark, tmp_path):
    records = spark.range(4000).selectExpr(
        "'t' AS topic", "cast(id % 4 AS int) AS partition", "id div 4 AS offset", "cast('k' AS binary) AS key", "cast('v' AS binary) AS value"
    )
    EL.write_event_log(records, f"{tmp_path}/log", by_size=True)
    assert len(glob.glob(f"{tmp_path}/log/*/*/*.parquet")) == 4
    assert EL.read_event_log(spark, f"{tmp_path}/log").distinct().count() == 4000


def test_a_filter_on_the_verdict_does_not_write_out_the_contract(spark):
    wire = R.build_events(_bars(spark))
    kept = V.val_event_contract(wire).where(F.col("reject_reason").isNull())
    filters = [line for line in _optimized(kept).splitlines() if "Filter" in line]
    assert filters and not any("RLIKE" in line for line in filters)
    assert kept.count() == 60


def test_a_constant_provider_does_not_move_the_stored_prices(spark, tmp_path):
    prices = _bars(spark).select(fn.event_id("schema_version", "provider", "symbol", "trading_date").alias("event_id"), "*")
    P.open_table(spark, "prices_of_one_provider", f"{tmp_path}/prices", 4)
    try:
        P.add_prices(prices, "prices_of_one_provider", 4)
        batch = _bars(spark).select(F.lit("p").alias("provider"), "symbol", "trading_date")
        out = P.meet_prices(batch, "prices_of_one_provider", 4, ["event_id"])
        assert out._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
        assert out.where(F.col("event_id").isNotNull()).count() == 60
    finally:
        spark.sql("DROP TABLE prices_of_one_provider")


def test_facts_of_a_file_move_with_its_first_line_only(spark, tmp_path):
    write_canonical_csv(_bars(spark), f"{tmp_path}/s")
    stats = S.actual_file_stats(spark, f"{tmp_path}/s")
    exchange = _optimized(stats).split("RepartitionByExpression")[1]
    assert "CASE WHEN (coalesce(line_no" in exchange
    rows = {r["path"]: r for r in stats.collect()}
    want = {r["symbol"]: r["sha256"] for r in file_content_digest(_bars(spark)).collect()}
    assert {p[5:]: r["a_sha256"] for p, r in rows.items()} == want
    assert all(r["a_utf8"] and r["a_row_count"] == 30 and r["a_fault"] is None for r in rows.values())


def test_verified_events_are_read_from_the_files_once(spark, tmp_path):
    write_canonical_csv(_bars(spark), f"{tmp_path}/s")
    manifest = file_content_digest(_bars(spark)).withColumn("path", F.concat(F.lit("file="), "symbol"))
    events = R.verified_events(spark, manifest, f"{tmp_path}/s", 1, "p", "s-1")
    assert events.count() == 60 and not any(f.endswith(".csv") for f in events.inputFiles())


def test_a_file_beside_the_manifest_needs_the_header(spark, tmp_path):
    write_canonical_csv(_bars(spark), f"{tmp_path}/s")
    manifest = file_content_digest(_bars(spark)).withColumn("path", F.concat(F.lit("file="), "symbol"))
    (tmp_path / "s" / "file=X").mkdir()
    (tmp_path / "s" / "file=X" / "part-0.csv").write_text("Symbol,trading_date,open,high,low,close,volume,currency\n")
    with pytest.raises(SourceError, match="non-canonical header"):
        R.verified_events(spark, manifest, f"{tmp_path}/s", 1, "p", "s-1")


def test_payloads_are_made_behind_the_numbering(spark):
    records = R.to_log_records(R.build_events(_bars(spark)), "t", 4, codec.encode_event())
    stored = [line for line in _optimized(records).splitlines() if "Relation" in line]
    assert stored and not any("_payload" in line for line in stored)


def test_long_and_negative_fields_are_encoded_as_the_library_does(spark):
    cls = codec.message_class()
    cases = [(length, volume) for length in (1, 127, 128, 129, 16383, 16384) for volume in (0, 1, 127, 128, 300, -1, -(1 << 63), (1 << 63) - 1)]
    empty = {n: "" for n, _, kind in codec.WIRE_FIELDS if kind == "string"}
    rows = [{**empty, "schema_version": k * 100, "symbol": "é" + "x" * length, "volume": volume} for k, (length, volume) in enumerate(cases)]
    schema = ", ".join(f"{n} {'string' if kind == 'string' else 'bigint'}" for n, _, kind in codec.WIRE_FIELDS)
    frame = spark.createDataFrame([tuple(r[n] for n, _, _ in codec.WIRE_FIELDS) for r in rows], schema)
    got = {(r["symbol"], r["volume"]): bytes(r["value"]) for r in codec.encode(frame).collect()}
    assert all(got[r["symbol"], r["volume"]] == cls(**r).SerializeToString(deterministic=True) for r in rows)


def test_canonical_decimals_need_no_pattern(spark):
    texts = ["0", "100", "102.5", "-0.00000001", "1000.1000", "999999999999.99999999", None]
    frame = spark.createDataFrame([(t,) for t in texts], "t string").select("t", fn.canonical_decimal(F.col("t").cast("decimal(20,8)")).alias("c"))
    assert "regexp" not in _optimized(spark.range(1).select(fn.canonical_decimal(F.rand().cast("decimal(20,8)"))))
    assert [r["c"] for r in frame.collect()] == ["0", "100", "102.5", "-0.00000001", "1000.1", "999999999999.99999999", None]


def test_many_folders_are_listed_by_few_tasks(spark):
    key = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before = spark.conf.get(key)
    with few_listing_tasks(spark):
        assert int(spark.conf.get(key)) <= 4 * spark.sparkContext.defaultParallelism
    assert spark.conf.get(key) == before


def test_canonical_files_are_listed_by_few_tasks(spark, tmp_path):
    """One task a folder was started to look for headers: a job of as many tasks as symbols."""
    import datetime as dt
    from decimal import Decimal as D

    from tidemark.sinks.files import write_canonical_csv
    from tidemark.sources.files import read_canonical_csv

    n = 4 * spark.sparkContext.defaultParallelism + 40
    prices = "symbol string, trading_date date, open decimal(20,8), high decimal(20,8), low decimal(20,8), close decimal(20,8), volume long, currency string"
    rows = [(f"S{i}", dt.date(2024, 1, 2 + k), D(10), D(12), D(9), D(11), 5, "USD") for i in range(n) for k in range(2)]
    out = f"{tmp_path}/canonical"
    write_canonical_csv(spark.createDataFrame(rows, prices), out)
    sc = spark.sparkContext
    sc.setJobGroup("canonical-listing", "canonical-listing")
    try:
        back = read_canonical_csv(spark, out)
        assert back.where("parse_error is null").count() == 2 * n
    finally:
        sc._jsc.sc().clearJobGroup()
    tracker = sc.statusTracker()
    stages = [s for j in tracker.getJobIdsForGroup("canonical-listing") for s in tracker.getJobInfo(j).stageIds]
    tasks = [i.numTasks for i in map(tracker.getStageInfo, stages) if i]
    assert tasks and max(tasks) < n
